"""Mixture-controlled packing of tokenised documents into fixed windows.

Every source is a queue of tokens. Window after window, each queue is granted its
target share of the window; what a grant rounds off stays as the queue's deficit
and is carried to the next window (deficit round-robin with the token as quantum).
A queue that runs dry leaves its share to the others.

The deficits are worked out in closed form instead of window by window, so no task
waits for another: a token of queue s falls due at (i + 1/2) / rate_s, the
tokens due by time t are C_s(t) = min(size_s, floor(rate_s * t + 1/2)), and the
boundary of window w is the time at which their sum is w times the window, found by
bisection. C_s at two boundaries gives what queue s sends to the window; w * share_s
minus C_s is its deficit there, and stays below one token. Any task can work out
any boundary from the queue sizes alone.

Documents keep the order of the scan: tokenising tasks number their tokens per
queue, totals per task and queue are summed up in a window over tasks, and no text
or token is shuffled at all. Documents are cut at window boundaries. The last,
partial window is cut into sequences whose lengths are powers of two, so nothing is
padded.

Defined results: a null text is a document of the end token alone; a null source is
a queue of its own; repeated rows are packed each; an empty table gives no row.
Beyond ``MAX_QUEUES`` sources the smallest ones share the last queue.
"""

from __future__ import annotations

import json
import os
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapweave.llm.common import stored

WINDOW = 4096
END_ID = 2
CELLS = 1_000_000  # windows x queues whose boundaries are held at a time
MAX_QUEUES = 4096
THIN = 8  # windows a token on the way from a document's first token to its last
BROADCAST_ROWS = 200_000  # of (task, queue) offsets, some 50 bytes each
CACHE_CHUNKS = 500_000
CACHE_WORDS = 500_000
IDS = [f"<{n}I" for n in range(65)]  # of a word, by the number of its tokens
# Control characters that str.split() takes as white space and Unicode's White_Space doesn't.
NOT_SPACE = "\x1c\x1d\x1e\x1f"
# Punctuation that is a token run of its own after a word (an apostrophe isn't: it starts contractions).
TAIL = ".,!?;:|%&*#$()"


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next one from U+0100."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in kept]
    return {b: chr(b) for b in kept} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class Chunks(dict):
    """White-space chunk -> token ids (little-endian unsigned 32-bit).

    For tokenizers that lower-case, and whose tokens hold no white space and do not
    join letters with punctuation. So a chunk's ids are put together from those of its
    lower-case word and its trailing punctuation, and only words are ever tokenised.
    A byte-level vocabulary's merges are applied to a word of letters directly, as
    normalising and splitting would leave it as it is. Words are kept apart from chunks,
    as one word stands in many chunks; either cache starts anew when full.
    """

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        split = (json.loads(tokenizer_json).get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.words, self.merges = {}, None
        if split and split[-1]["type"] == "ByteLevel" and not split[-1].get("add_prefix_space"):
            self.merges = self.tokenizer.model
            letters = byte_letters()
            self.letters = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(0x80, 0x130)}

    def word(self, word: str) -> bytes:
        """Ids of lower-case letters below U+0130."""
        got = self.words.get(word)
        if got is None:
            if self.merges is None:
                got = self.encode(word)
            else:
                tokens = self.merges.tokenize(word if word.isascii() else word.translate(self.letters))
                got = struct.pack(IDS[len(tokens)] if len(tokens) < len(IDS) else f"<{len(tokens)}I", *[t.id for t in tokens])
            if len(self.words) >= CACHE_WORDS:
                self.words.clear()
            self.words[word] = got
        return got

    def encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, chunk: str) -> bytes:
        if len(chunk) > 64:
            return self.encode(chunk)
        got = None
        if max(chunk) < "\u0130":  # below it lower() maps letter by letter and nothing combines
            word = chunk.lower().rstrip(TAIL)
            if word == chunk:
                word = chunk  # one string object for both caches
            if word.isalpha():
                tail = chunk[len(word):]
                got = self.word(word) + self[tail] if tail else self.word(word)
        if got is None:
            got = self.encode(chunk)
        if len(self) >= CACHE_CHUNKS:
            self.clear()
        self[chunk] = got
        return got

    def ids(self, text: str) -> bytes:
        if any(c in text for c in NOT_SPACE):
            return self.encode(text)
        return b"".join(map(self.__getitem__, text.split()))


def tokenised(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text",
              source: str = "source", end_id: int = END_ID) -> DataFrame:
    """Stored table doc_id, source, task, task_start (tokens of its queue before it in its task), n, ids."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()  # a vocabulary file; executors get its text, not its path
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"),
                    F.col(text).alias("text"))
    schema = T.StructType([d.schema["doc_id"], d.schema["source"], *T.StructType.fromDDL(
        "task int, task_start bigint, n bigint, ids binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, task, sent = Chunks(spec), TaskContext.get().partitionId(), {}
        end = np.array([end_id], "<u4").tobytes()
        for whole in batches:
            for a in range(0, whole.num_rows, 1000):
                batch = whole.slice(a, 1000)
                starts, sizes, data = [], [], []
                for s, t in zip(batch.column(1).to_pylist(), batch.column(2)):
                    ids = chunks.ids(t.as_py() or "") + end
                    starts.append(sent.get(s, 0))
                    sizes.append(len(ids) // 4)
                    sent[s] = starts[-1] + sizes[-1]
                    data.append(ids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([task] * len(sizes), pa.int32()),
                     pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(data, pa.binary())], schema.names)

    return stored(d.mapInArrow(run, schema), "packing-tokens")


class Mixture:
    """Window boundaries of queues with given sizes and rates."""

    def __init__(self, sizes: list[int], rates: list[float], window: int):
        self.sizes, self.window = np.array(sizes, np.int64), window
        self.rates = np.maximum(np.array(rates, np.float64), 1e-12)
        self.rates = self.rates / self.rates.sum() * window  # time runs in windows
        self.total = int(self.sizes.sum())
        self.windows = -(-self.total // window)
        self.end = float(np.where(self.sizes > 0, (self.sizes + 1) / self.rates, 0.0).max()) + 1.0

    def due(self, t: np.ndarray) -> np.ndarray:
        """Tokens of each queue due by each time: (times, queues)."""
        return np.minimum(self.sizes, np.floor(t[:, None] * self.rates + 0.5)).astype(np.int64)

    def before(self, w: np.ndarray) -> np.ndarray:
        """Tokens of each queue in the windows before each of ``w``: (windows, queues)."""
        goal = np.minimum(w * self.window, self.total)
        lo, hi = np.zeros(len(w)), np.full(len(w), self.end)
        for _ in range(200):
            mid = (lo + hi) / 2
            if ((mid <= lo) | (mid >= hi)).all():
                break
            low = self.due(mid).sum(1) <= goal
            lo, hi = np.where(low, mid, lo), np.where(low, hi, mid)
        have, more = self.due(lo), self.due(hi)
        # queues whose tokens fall due at the same moment are served in queue order
        short = goal - have.sum(1)
        room = np.cumsum(more - have, 1)
        return have + np.clip(short[:, None] - (room - (more - have)), 0, more - have)

    def tail(self) -> list[tuple[int, int]]:
        """(start, length) of the power-of-two sequences in the last, partial window."""
        rest, at, out = self.total % self.window, 0, []
        for bit in range(rest.bit_length() - 1, -1, -1):
            if rest >> bit & 1:
                out.append((at, 1 << bit))
                at += 1 << bit
        return out

    def blocks(self, first: np.ndarray, last: np.ndarray) -> Iterator[np.ndarray]:
        """All windows from ``first`` to ``last`` (inclusive) in order, at most ``CELLS`` (windows x queues) at a time.

        A block that breaks off inside such a range begins the next one with its last window.
        """
        most, got, size = max(2, CELLS // len(self.sizes)), [], 0
        order = np.argsort(first, kind="stable")
        starts, ends = first[order], np.maximum.accumulate(last[order])
        new = np.flatnonzero(np.concatenate(([True], starts[1:] > ends[:-1])))
        for at, end in zip(starts[new].tolist(), ends[np.concatenate((new[1:], [len(ends)])) - 1].tolist()):
            while True:
                got.append(np.arange(at, min(end + 1, at + most - size)))
                size += len(got[-1])
                if size < most:
                    break
                yield np.concatenate(got)
                at, got, size = int(got[-1][-1]), [], 0
                if at == end:
                    break
        if got:
            yield np.concatenate(got)

    def near(self, queue: np.ndarray, x: np.ndarray) -> np.ndarray:
        """About the window of each queue's token ``x``."""
        out, step = [], max(1, CELLS // len(self.sizes))
        for a in range(0, len(x), step):
            when = np.clip((x[a:a + step] + 0.5) / self.rates[queue[a:a + step]], 0, self.end)
            out.append(self.due(when).sum(1) // self.window)
        return np.concatenate(out)

    def cut(self, queue: np.ndarray, start: np.ndarray, n: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Pieces (row, from, length, sequence_id, offset) of documents given by queue, start and size.

        A document whose tokens lie in few of the windows between its first and last one (of a rare source) is
        looked up token by token, so its cost is its tokens and not the corpus.
        """
        first, last = self.near(queue, start), self.near(queue, start + n)
        thin = last - first > THIN * n
        if not thin.any():
            return sorted(self._cut(queue, start, n, first, last))
        row = np.concatenate([np.flatnonzero(~thin), np.repeat(np.flatnonzero(thin), n[thin])])
        begin = np.concatenate([start[~thin], *[np.arange(a, a + m) for a, m in zip(start[thin], n[thin])]])
        size = np.concatenate([n[~thin], np.ones(int(n[thin].sum()), np.int64)])
        due = self.near(queue[row], begin)  # a single token lies about where it falls due, the next one far behind
        pieces = sorted((int(row[r]), int(begin[r] - start[row[r]]) + a, m, w, o) for r, a, m, w, o in self._cut(
            queue[row], begin, size, due, np.where(thin[row], due, last[row])))
        out: list[tuple[int, int, int, int, int]] = []
        for r, a, m, w, o in pieces:
            if out and out[-1][0] == r and out[-1][1] + out[-1][2] == a and out[-1][3] == w and out[-1][4] + out[-1][2] == o:
                r, a, before, w, o = out.pop()
                m += before
            out.append((r, a, m, w, o))
        return out

    def _cut(self, queue: np.ndarray, start: np.ndarray, n: np.ndarray, first: np.ndarray,
             last: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """``first``, ``last``: about the windows of the first token and of the one after the last."""
        first, last = np.clip(first - 2, 0, self.windows), np.clip(last + 3, 0, self.windows)
        tail, out = self.tail(), []
        done, ends = start.astype(np.int64), start + n  # tokens before done are cut
        for needed in self.blocks(first, last):
            edges = self.before(needed)
            sent = np.cumsum(np.diff(edges, axis=0), 1)
            lows, highs = np.searchsorted(needed, first), np.searchsorted(needed, last, "right")
            for row in np.flatnonzero((done < ends) & (highs - lows > 1)).tolist():
                q, x, end, lo = int(queue[row]), int(done[row]), int(ends[row]), int(lows[row])
                column = edges[lo:highs[row], q]
                while x < end and column[0] <= x < column[-1]:
                    k = int(np.searchsorted(column, x, "right")) - 1
                    stop = min(end, int(column[k + 1]))
                    w, before = int(needed[lo + k]), int(sent[lo + k, q] - (column[k + 1] - column[k]))
                    offset = before + x - int(column[k])
                    if tail and w == self.windows - 1:
                        for j, (a, size) in enumerate(tail):
                            u, v = max(offset, a), min(offset + stop - x, a + size)
                            if u < v:
                                out.append((row, x + u - offset - int(start[row]), v - u, w + j, u - a))
                    else:
                        out.append((row, x - int(start[row]), stop - x, w, offset))
                    x = stop
                done[row] = x
        if (done < ends).any():
            raise ValueError("tokens outside the windows expected for their document")
        return out


def pack(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", source: str = "source",
         end_id: int = END_ID, window: int = WINDOW, weights: dict[str | None, float] | None = None) -> DataFrame:
    """Pieces: doc_id, source, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    ``weights`` are target shares per source (missing ones get none until the others
    run dry); by default every window has the proportions of the whole corpus.
    """
    tokens = tokenised(docs, tokenizer_path, doc_id, text, source, end_id)
    by_task = tokens.groupBy("source", "task").agg(F.sum("n").alias("n"))
    top = by_task.groupBy("source").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "source").limit(MAX_QUEUES - 1)
    queues = sorted(((r["source"], r["n"]) for r in top.collect()), key=lambda r: (r[0] is None, r[0]))
    names = [s for s, _ in queues]
    shared = len(names)  # the queue of all other sources
    number = docs.sparkSession.createDataFrame(
        [(s, i) for i, s in enumerate(names)], "source string, queue int")  # MAX_QUEUES rows
    queued = (by_task.join(F.broadcast(number), by_task["source"].eqNullSafe(number["source"]), "left")
              .select(by_task["source"], "task", "n", F.coalesce("queue", F.lit(shared)).alias("queue")))
    order = Window.partitionBy("queue").orderBy("task", "source").rowsBetween(Window.unboundedPreceding, -1)
    base = stored(queued.withColumn("base", F.coalesce(F.sum("n").over(order), F.lit(0))), "packing-base")
    rest = base.filter(F.col("queue") == shared).agg(F.sum("n")).first()[0] or 0
    sizes = [n for _, n in queues] + [rest]
    rates = [float(n) for n in sizes] if weights is None else \
        [float(weights.get(s, 0.0)) for s in names] + [float(rest > 0) * 1e-9]
    if not sum(sizes):
        sizes, rates = [1], [1.0]
    side = base.select(F.col("source").alias("s"), F.col("task").alias("k"), "queue", "base")
    side = F.broadcast(side) if base.count() <= BROADCAST_ROWS else side
    placed = (tokens.join(side, tokens["source"].eqNullSafe(F.col("s")) & (tokens["task"] == F.col("k")))
              .select("doc_id", "source", "queue", (F.col("base") + F.col("task_start")).alias("at"), "n", "ids"))
    schema = T.StructType([placed.schema["doc_id"], placed.schema["source"], *T.StructType.fromDDL(
        "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixture = Mixture(sizes, rates, window)
        for whole in batches:
            for a in range(0, whole.num_rows, 1000):
                batch = whole.slice(a, 1000)
                n = batch.column(4).to_numpy()
                pieces = mixture.cut(batch.column(2).to_numpy(), batch.column(3).to_numpy(), n)
                rows, starts, lengths, sequences, offsets = map(list, zip(*pieces))
                data = batch.column(5)
                ids = [memoryview(data[r].as_buffer())[4 * s:4 * (s + m)].tobytes()
                       for r, s, m in zip(rows, starts, lengths)]
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(starts, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(ids, pa.binary()), pa.array(n[rows], pa.int64()),
                     pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())], schema.names)

    return placed.mapInArrow(run, schema)
