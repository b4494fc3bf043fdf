"""Chat formatting by minimum-cost role repair.

The legal-turn automaton: a conversation may start with one system turn, then user
and assistant turns alternate, user first, and the last turn is the assistant's. A
turn that does not fit can be merged into the turn before, given another role, or
have empty turns inserted before it; each has a cost, and dynamic programming
chooses the cheapest repair of the whole conversation (fewest output turns among
equals, then the first in the order of its roles: system, user, assistant). The result is rendered turn by turn.

The state of the automaton is the role of the last output turn (or the start), so a
stretch of turns is a small min-plus matrix from state to state, and matrices of
adjacent stretches multiply. Beside each row stands the order of its best role
sequences, which multiplies as well, so ties fall alike however turns are dealt. Rows are range-partitioned and sorted by
conversation and turn; a conversation may span any number of partitions. A first pass
gives the matrices of the first and last conversation of each partition (two rows a
partition reach the driver), which fixes the states at the borders; a second pass
repairs every stretch between them on its own.

Output: one row per turn that came in or was inserted, with ``segment``, its share of
the rendered conversation: the segments of a conversation in order of ``position``
are the rendered text. A merged turn continues the output turn before it.

Defined results: conversations are ordered by turn (null first), equal turns by role and
text (its first ``HEAD`` characters, then a hash of all of it); repeated rows count as turns; a null or unknown role must be relabelled;
null text is empty; rows with a null conversation id form one conversation. The
template's markers in a text are broken up by a space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapweave.session import shared_dir

# Roles, their other names, and the legal successors of each state.
SYSTEM, USER, ASSISTANT, START = 0, 1, 2, 3
ROLES = ("system", "user", "assistant")
ALIASES = {"human": USER, "prompter": USER, "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT}
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
# Costs of one repair, in whole numbers.
MERGE, RELABEL, NAME, INSERT = 2, 7, 1, 3  # NAME: a role for a turn that has none known
HEAD = 64
COUNT = 1 << 28  # cost * COUNT + output turns: cheapest first, then fewest turns
NEVER = 1 << 58


def role_of(name: str | None) -> int:
    """Known role, or -1."""
    x = (name or "").strip().lower()
    return ROLES.index(x) if x in ROLES else ALIASES.get(x, -1)


def _inserted(a: int, b: int) -> tuple[int, ...] | None:
    """Fewest empty turns that lead legally from state ``a`` to a turn of role ``b``."""
    paths = [()]
    for _ in range(3):
        for path in paths:
            if b in LEGAL[path[-1] if path else a]:
                return path
        paths = [p + (r,) for p in paths for r in LEGAL[p[-1] if p else a]]
    return None


def _steps() -> dict[int, list[list[tuple[int, str, tuple[int, ...]]]]]:
    """For each incoming role (-1 unknown): [state][new role] -> (value, action, inserted roles)."""
    table = {}
    for role in (-1, SYSTEM, USER, ASSISTANT):
        rows = []
        for state in (SYSTEM, USER, ASSISTANT, START):
            row = []
            for new in (SYSTEM, USER, ASSISTANT):
                change = 0 if new == role else RELABEL if role >= 0 else NAME
                word = "keep" if new == role else "relabel"
                options = []
                path = _inserted(state, new)
                if path is not None:
                    options.append(((change + INSERT * len(path)) * COUNT + 1 + len(path), word, path))
                if state == new:
                    options.append(((change + MERGE) * COUNT, "merge" if new == role else "relabel+merge", ()))
                row.append(min(options, default=(NEVER, "", ())))
            rows.append(row)
        table[role] = rows
    return table


STEPS = _steps()
STEP_INSERTED = {r: np.array([[len(c[2]) for c in row] for row in rows], np.int64) for r, rows in STEPS.items()}
STEP_VALUES = {r: np.array([[c[0] for c in row] for row in rows], np.int64) for r, rows in STEPS.items()}
#: after the last turn: roles to insert until the assistant has spoken
ENDING = {ASSISTANT: (), USER: (ASSISTANT,), SYSTEM: (USER, ASSISTANT)}
END_VALUES = np.array([len(ENDING[s]) * (INSERT * COUNT + 1) for s in (SYSTEM, USER, ASSISTANT)], np.int64)


def matrix(roles: list[int]) -> np.ndarray:
    """(4, 3) values from each entry state to each last role over a non-empty stretch."""
    return matrices(roles)[0]


def _joined(value: np.ndarray, rank: np.ndarray, step: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, ...]:
    """One product: (rows, 3) values and ranks times a (3, 3) step. Gives values, ranks and the state passed through.

    Of equal sums the one whose first half ranks first is taken; the new rank compares first halves, then ``order``.
    """
    every = value[:, :, None] + step[None]
    by = (every * 4 + rank[:, :, None]).argmin(1)
    best = np.minimum(np.take_along_axis(every, by[:, None], 1)[:, 0], NEVER)
    place = np.take_along_axis(rank, by, 1) * 3 + order[by, np.arange(3)]
    return best, place.argsort(1).argsort(1), by


IN_ORDER = np.tile(np.arange(3), (4, 1))  # after one turn: the order of the roles


def matrices(roles: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``matrix`` and, of the same cheapest paths, their ranks by entry state and the turns they insert."""
    m, rank, inserted = STEP_VALUES[roles[0]].copy(), IN_ORDER, STEP_INSERTED[roles[0]].copy()
    for r in roles[1:]:
        m, rank, by = _joined(m, rank, STEP_VALUES[r][:3], IN_ORDER[:3])
        inserted = np.take_along_axis(inserted, by, 1) + STEP_INSERTED[r][by, np.arange(3)]
    return m, rank, inserted


def repair(roles: list[int], entry: int, leave: int | None) -> list[tuple[int, str, tuple[int, ...]]]:
    """(new role, action, inserted roles) per turn of the cheapest repair.

    ``leave`` is the role to end on, or None where the conversation ends.
    """
    value, rank, back = STEP_VALUES[roles[0]][entry:entry + 1], IN_ORDER[:1], []
    for r in roles[1:]:
        value, rank, by = _joined(value, rank, STEP_VALUES[r][:3], IN_ORDER[:3])
        back.append(by[0])
    at = int(((value + END_VALUES) * 4 + rank).argmin()) if leave is None else leave
    path = [at]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    path.reverse()
    out, state = [], entry
    for r, new in zip(roles, path):
        _, action, inserted = STEPS[r][state][new]
        out.append((new, action, inserted))
        state = new
    return out


def _safe(text: str | None) -> str:
    return (text or "").replace("<|im_", "<| im_")


def _open(role: int, first: bool) -> str:
    return ("" if first else "<|im_end|>\n") + f"<|im_start|>{ROLES[role]}\n"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list, list, list]]:
    """(id of one row, turns, roles, texts) of each conversation in a sorted partition."""
    now, turns, roles, texts = None, [], [], []
    for batch in batches:
        ids = batch.column(0)
        values = ids.to_pylist()
        for i, (c, turn, role, text) in enumerate(zip(values, *(batch.column(k).to_pylist() for k in (1, 2, 3)))):
            if now is None or c != now[0]:
                if now is not None:
                    yield now[1], turns, roles, texts
                now, turns, roles, texts = (c, ids.slice(i, 1)), [], [], []
            turns.append(turn)
            roles.append(role)
            texts.append(text)
    if now is not None:
        yield now[1], turns, roles, texts


def repaired(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """conv_id, position, turn, role, action, out_turn, out_role, segment; turn and role are null for inserted turns."""
    spark = turns.sparkSession
    shared_dir(spark)  # registers the shared folder for checkpoints if the session names none
    t = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
                     F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # ranges and order have the same columns, so the order is one, whatever the ranges; equal rows may be parted
    order = ["conv_id", "turn", "role", F.substring("text", 1, HEAD), F.xxhash64("text")]
    rows = (t.withColumn("at", F.monotonically_increasing_id()).repartitionByRange(parts, *order, "at")
            .sortWithinPartitions(*order).drop("at").checkpoint())

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, edge, last, n = TaskContext.get().partitionId(), [], None, 0
        value = lambda cid, names: (cid, len(names), np.stack(
            matrices([role_of(x) for x in names])).ravel().tolist())
        for cid, _, names, _ in _pieces(batches):
            last, n = (cid, names), n + 1
            if n == 1:
                edge.append((0, *value(*last)))
        if n > 1:
            edge.append((n - 1, *value(*last)))
        if edge:
            number, ids, counts, values = zip(*edge)
            yield pa.RecordBatch.from_arrays(
                [pa.array([task] * len(edge), pa.int32()), pa.array(number, pa.int32()), pa.concat_arrays(ids),
                 pa.array(counts, pa.int64()), pa.array(values, pa.list_(pa.int64()))],
                ["task", "piece", "conv_id", "n", "values"])

    summaries = T.StructType([*T.StructType.fromDDL("task int, piece int").fields, rows.schema["conv_id"],
                              *T.StructType.fromDDL("n bigint, values array<bigint>").fields])
    edges = sorted(rows.mapInArrow(summary, summaries).collect(), key=lambda r: (r["task"], r["piece"]))
    borders = _stitch([(r["task"], r["piece"], r["conv_id"], r["n"], *np.array(r["values"]).reshape(3, 4, 3)) for r in edges])
    schema = T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL(
        "position bigint, turn bigint, role string, action string, out_turn bigint, out_role string, "
        "segment string").fields])

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for k, (cid, numbers, names, texts) in enumerate(_pieces(batches)):
            entry, leave, done, position = borders.get((task, k), (START, None, 0, 0))
            out, count = [], done
            for number, name, words, (new, action, inserted) in zip(
                    numbers, names, texts, repair([role_of(x) for x in names], entry, leave)):
                for r in inserted:
                    out.append((position, None, None, "insert", count, ROLES[r], _open(r, count == 0)))
                    position, count = position + 1, count + 1
                if action.endswith("merge"):
                    segment = "\n" + _safe(words)
                else:
                    segment, count = _open(new, count == 0) + _safe(words), count + 1
                out.append((position, number, name, action, count - 1, ROLES[new], segment))
                position += 1
            if leave is None:
                for r in ENDING[ROLES.index(out[-1][5])]:
                    out.append((position, None, None, "insert", count, ROLES[r], _open(r, False)))
                    position, count = position + 1, count + 1
                out[-1] = (*out[-1][:6], out[-1][6] + "<|im_end|>\n")
            for a in range(0, len(out), 2000):
                cols = list(zip(*out[a:a + 2000]))
                same = cid.take(pa.array([0] * len(cols[0]), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [same, *[pa.array(c, ty) for c, ty in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string(),
                                                                     pa.int64(), pa.string(), pa.string()))]],
                    schema.names)

    return rows.mapInArrow(render, schema)


def _stitch(edges: list[tuple]) -> dict[tuple[int, int], tuple[int, int | None, int, int]]:
    """(task, piece) -> entry state, role to end on (None at the end), output turns and positions before.

    Only conversations that span tasks need it. A position is given to each turn and to
    every turn inserted.
    """
    out, i = {}, 0
    while i < len(edges):
        j = i + 1
        while j < len(edges) and edges[j][2] == edges[i][2]:
            j += 1
        chain = edges[i:j]
        if len(chain) > 1:
            value, rank, back = chain[0][4][START:], chain[0][5][START:], []
            for _, _, _, _, m, order, _ in chain[1:]:
                value, rank, by = _joined(value, rank, m[:3], order[:3])
                back.append(by[0])
            ends = [int(((value + END_VALUES) * 4 + rank).argmin())]
            for b in reversed(back):
                ends.append(int(b[ends[-1]]))
            ends.reverse()
            entry, turns, position = START, 0, 0
            for k, ((task, piece, _, n, m, _, inserted), leave) in enumerate(zip(chain, ends)):
                out[task, piece] = (entry, None if k == len(chain) - 1 else leave, turns, position)
                turns += int(m[entry, leave]) % COUNT
                position += n + int(inserted[entry, leave])
                entry = leave
        i = j
    return out
