"""N-gram Jaccard join through prefixes of token combinations.

A text's set holds a 64-bit hash of every distinct shingle. Two sets link when their Jaccard
similarity reaches ``percent``. Equal sets are folded to one node first (128-bit keys).

Prefixes. All tokens have one global order, rare first: by the count of the token's cell in an
array of ``CELLS`` counts over the distinct sets, then by hash. By that count a token is rare
(class 1), frequent (class 2) or very frequent (class 3); classes 2 and 3 are parted further by
hash into as many parts as the set size allows. A set needs at least t common tokens with any
partner, so it may miss ``n - t``. Its prefix is extended until the sum over all parts of
``max(0, tokens in the part - k + 1)`` exceeds ``n - t`` (k the class): if every part had fewer
than k common tokens, more than ``n - t`` would be missing. So two linked sets share a
k-token combination of class k in their prefixes, and those combinations are indexed: single
tokens for rare ones, pairs and triples for frequent ones. Their number is linear in the set.

Lengths. The smaller set of a pair is in the power-of-two band of its size and offers the short
index prefix (its partners are no smaller); the larger one probes the one or two bands that its
partners may be in. The cells' counts steer only the cost: any order gives the same links.

Verification. In a bucket of equal combinations every set is first verified against the
bucket's smallest index set, its hub, which is linear. Buckets of one hub form a group. While
links are found and a group still holds several components, all sets outside the component of
another hub are verified against that (``HUB_ROUNDS`` times at most, linear as well). Sets
that are then still in different components of a group are compared with each other in blocks.
Pairs within a component are never listed; no link between components is lost, so the
components are exact. Each check compares sizes, then parity sketches (they bound the
similarity from above), then the sets themselves.
Copies of frequent combinations are dealt over ``SALTS`` keys.

Texts are read three or more times (set keys, sketches and cell counts; combinations; sets of
pairs that their sketches allow) and never shuffled. To the driver: the cell counts and a bitmap of the nodes in pairs
(``BITMAP`` bits, whatever the corpus; where it is full more sets are shuffled, none is lost).

Defined results: a text without words (or null) has an empty set and is linked with nothing, its
component is its own id; with fewer words than a shingle the whole sequence is the one token;
repeated rows stay rows; null ids become a component's id only if all its ids are null; other
columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapweave.llm.common import stored
from snapweave.llm.simhash import components

SHINGLE_WORDS = 5
PERCENT = 80
CELL_BITS, CHUNK_BITS = 21, 16
CELLS = 1 << CELL_BITS
BITMAP = 1 << 25
SALTS = 16
HUB_ROUNDS = 1
STEPS = 3
BLOCK = 512
FLUSH = SLICE = 1 << 20
ROWS = 1000  # texts whose combinations or sets are handed on at a time
_U = np.uint64


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Every 64-bit number spread over all bits (a bijection for each salt)."""
    x = x + _U(0x9E3779B97F4A7C15 * (2 * salt + 1) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
# a random number for each byte; A-Z have those of a-z
BYTES = mixed(np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint64), 9)
BASE = _U(0xA24BAED4963EE407)
POWERS = np.cumprod(np.full(256, BASE))


def word_hashes(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of a buffer; a word also ends at each of ``breaks``.

    A word's hash is a polynomial of random numbers for its bytes, spread over all bits.
    """
    space = SPACE[data]
    begins = ~space
    after_letter = ~space[:-1]
    after_letter[breaks[(breaks > 0) & (breaks < len(data))] - 1] = False
    begins[1:] &= ~after_letter
    kept = np.flatnonzero(~space)
    if not len(kept):
        return np.zeros(0, np.uint64), kept
    first = np.flatnonzero(begins[kept])
    length = np.diff(np.append(first, len(kept)))
    place = np.arange(len(kept)) - np.repeat(first, length)
    longest = int(length.max())
    power = POWERS if longest <= len(POWERS) else np.cumprod(np.full(longest, BASE))
    h = np.add.reduceat(BYTES[data[kept]] * power[place], first)
    return mixed(h + length.astype(np.uint64)), kept[first]


def token_sets(texts: pa.Array, shingle_words: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text, worked out for ``SLICE`` bytes of texts at a time."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE, "right")) - 1)
        lo, hi, hashes, starts = int(offsets[row]), int(offsets[end]), [], []
        while lo < hi:  # a text longer than a slice is cut at white space
            stop = min(hi, lo + SLICE)
            while stop < hi and not SPACE[data[stop - 1]]:
                gap = np.flatnonzero(SPACE[data[stop:stop + SLICE]])
                stop = min(hi, stop + int(gap[0]) + 1 if len(gap) else stop + SLICE)
            h, s = word_hashes(data[lo:stop], offsets[row:end] - lo)
            hashes.append(h)
            starts.append(s + lo)
            lo = stop
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        first = np.searchsorted(np.concatenate(starts) if starts else np.zeros(0, np.int64), offsets[row:end + 1])
        whole = _shingled(h, shingle_words)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= shingle_words:
                x = np.sort(whole[a:b - shingle_words + 1])
                yield x[np.concatenate(([True], x[1:] != x[:-1]))]
            else:
                yield _shingled(h[a:b], b - a)
        row = end


def _shingled(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words."""
    m = len(h) - k + 1
    if m < 1 or not k:
        return np.zeros(0, np.uint64)
    total = np.full(m, k, np.uint64)
    for j in range(k):
        total = (total + h[j:j + m]) * _U(0xD6E8FEB86659FD93 + 2 * j)
    return mixed(total)


def set_keys(tokens: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit keys of a set."""
    return tuple(int(mixed(tokens, s).sum(dtype=np.uint64).astype(np.int64)) for s in (1, 2))


def sketch(tokens: np.ndarray) -> bytes:
    """Parity of the tokens in each of 256 or more cells, four to eight times as many as tokens.

    The cells in which two sketches differ are at most as many as the tokens that only one of the sets holds. The
    number of cells is a power of two; halves put together by XOR are the sketch of half the size.
    """
    bits = max(256, 4 << (len(tokens) - 1).bit_length()) if len(tokens) else 256
    return np.packbits((np.bincount((tokens & _U(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def folded(x: bytes, width: int) -> bytes:
    """A sketch brought down to ``width`` bytes."""
    value, n = int.from_bytes(x), len(x)
    while n > width:
        n //= 2
        value = value >> 8 * n ^ value & (1 << 8 * n) - 1
    return value.to_bytes(n)


def sketches_differ(x: bytes, y: bytes) -> int:
    """Least number of tokens that only one of two sets holds."""
    width = min(len(x), len(y))
    return (int.from_bytes(folded(x, width)) ^ int.from_bytes(folded(y, width))).bit_count()


class Prefixes:
    """Token combinations of a set, from the cell counts and the similarity."""

    def __init__(self, counts: np.ndarray, percent: int = PERCENT):
        self.counts, self.percent = counts, percent
        mean = float(counts.mean()) if len(counts) else 0.0
        self.frequent = int(mean + 5 * mean ** 0.5) + 16
        self.very_frequent = 32 * self.frequent
        self.shift = _U(64 - (len(counts).bit_length() - 1))

    def roles(self, n: int) -> list[tuple[int, int, int]]:
        """(band, tokens that may be missing as the larger set, as the smaller one or -1)."""
        p = self.percent
        least = -(-p * n // 100)  # smallest partner
        out = []
        for band in range(least.bit_length() - 1, n.bit_length()):
            smallest = max(1 << band, least)
            probe = n - -(-p * (n + smallest) // (100 + p))
            index = n - -(-p * 2 * n // (100 + p)) if band == n.bit_length() - 1 else -1
            out.append((band, probe, index))
        return out

    def of(self, tokens: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
        """Combinations' hashes, whether each is in the index prefix, and whether its tokens are frequent."""
        n, p = len(tokens), self.percent
        if 100 * n < p * (n + 1):
            return [], [], []  # so small a set links with equal ones only
        count = self.counts[tokens >> self.shift]
        order = np.lexsort((tokens, count))
        t, count = tokens[order], count[order]
        rare = int(np.searchsorted(count, self.frequent))
        very = int(np.searchsorted(count, self.very_frequent))
        hashes, indexed, hot = [], [], []
        for band, probe, index in self.roles(n):
            single = min(rare, probe + 1)
            hashes.append(mixed(t[:single], 3 + band))
            indexed.append(np.arange(single) <= index)
            hot.append(np.zeros(single, bool))
            if single <= probe:
                found = self._combined(t[rare:].tolist(), very - rare, band, probe - rare, index - rare)
                values = np.array([v for v, _ in found], np.uint64)
                hashes.append(mixed(values, 3 + band))
                indexed.append(np.array([i for _, i in found], bool))
                hot.append(np.ones(len(found), bool))
        return hashes, indexed, hot

    @staticmethod
    def _combined(t: list[int], very: int, band: int, probe: int, index: int) -> list[tuple[int, bool]]:
        """Combinations among frequent tokens ``t`` until more than ``probe`` are covered; the flag holds
        for those within the prefix that covers more than ``index``."""
        parts: dict[tuple[int, int], list[int]] = defaultdict(list)
        several = max(1, (1 << band) // 16)
        out, covered = [], 0
        for i, x in enumerate(t):
            k = 2 if i < very else 3
            own = parts[k, x % several]
            for others in combinations(own, k - 1):
                out.append((sum((y * y + k) * 0x9E3779B97F4A7C15 for y in (*others, x)) & 0xFFFFFFFFFFFFFFFF,
                            covered <= index))
            own.append(x)
            covered += len(own) >= k
            if covered > probe:
                break
        return out


def _keyed(docs: DataFrame, shingle_words: int) -> DataFrame:
    """One row a document (doc_id, k1, k2, size, and as data the sketch of a set that its task had not met before),
    and rows (chunk, data) with a task's cell counts."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *T.StructType.fromDDL(
        "k1 bigint, k2 bigint, size bigint, chunk int, data binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, waiting, held = set(), [], 0
        counts = np.zeros(CELLS, np.uint32)

        def count() -> None:
            if waiting:
                counts[:] += np.bincount(np.concatenate(waiting), minlength=CELLS).astype(np.uint32)
                waiting.clear()

        kind = None
        for batch in batches:
            rows = []
            kind = batch.column(0).type
            for tokens in token_sets(batch.column(1), shingle_words):
                keys = set_keys(tokens)
                new = len(tokens) > 0 and keys not in seen
                rows.append((*keys, len(tokens), sketch(tokens) if new else None))
                if new:
                    seen.add(keys)
                    waiting.append((tokens >> _U(64 - CELL_BITS)).astype(np.int32))
                    held += len(tokens)
                    if held >= FLUSH:
                        count()
                        held = 0
            n, cols = len(rows), list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in cols[:3]],
                                              pa.nulls(n, pa.int32()), pa.array(cols[3], pa.binary())], schema.names)
        count()
        for c in range(CELLS >> CHUNK_BITS if kind is not None else 0):
            part = counts[c << CHUNK_BITS:(c + 1) << CHUNK_BITS]
            if part.any():
                planes = part.view(np.uint8).reshape(-1, 4).T.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, kind), *[pa.nulls(1, pa.int64())] * 3, pa.array([c], pa.int32()),
                     pa.array([pa.compress(planes, "zstd", asbytes=True)], pa.binary())], schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _summed(cells: DataFrame) -> np.ndarray:
    """Sum of all tasks' cell counts, chunk by chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                planes = pa.decompress(data, 4 << CHUNK_BITS, "zstd", asbytes=True)
                part = np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view(np.uint32)[:, 0]
                total[chunk] = total.get(chunk, 0) + part.astype(np.uint64)
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()),
                 pa.array([np.minimum(x, 0xFFFFFFFF).astype(np.uint32).tobytes() for x in total.values()], pa.binary())],
                ["chunk", "cells"])

    counts = np.zeros(CELLS, np.uint32)
    for r in cells.repartitionById(CELLS >> CHUNK_BITS, F.col("chunk")).mapInArrow(run, "chunk int, cells binary").collect():
        counts[r["chunk"] << CHUNK_BITS:(r["chunk"] + 1) << CHUNK_BITS] = np.frombuffer(r["cells"], np.uint32)
    return counts


def _combinations(docs: DataFrame, prefixes: Prefixes, clashing: frozenset[int], shingle_words: int) -> DataFrame:
    """(sig, node, meta) of the distinct sets of every task; meta orders index rows first, then by size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in _parts(batches):
            out: tuple[list, list, list] = ([], [], [])
            for tokens in token_sets(part, shingle_words):
                node = _node(set_keys(tokens), clashing)
                if not len(tokens) or node in seen:
                    continue
                seen.add(node)
                for h, i, f in zip(*prefixes.of(tokens)):
                    out[0].append(h.astype(np.int64))
                    out[1].append(np.full(len(h), node))
                    out[2].append((~i).astype(np.int64) << 40 | len(tokens) << 1 | f)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in out],
                ["sig", "node", "meta"])

    return docs.select("text").mapInArrow(run, "sig bigint, node bigint, meta bigint")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Array]:
    """The texts, ``ROWS`` at a time."""
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            yield batch.column(0).slice(a, ROWS)


def _node(keys: tuple[int, int], clashing: frozenset[int]) -> int:
    """A set's node: its first key, or the second where different sets share the first."""
    return keys[1] if keys[0] in clashing else keys[0]


def _members(sigs: DataFrame) -> DataFrame:
    """Rows of shared combinations: sig, node, size, indexed, hub, hub_size, hub_indexed and hot.

    The hub is the smallest index set of the rows dealt to one key. A set whose copies lie in several tasks
    comes from each of them; one row of it is kept.
    """
    salt = F.when(F.col("meta") % 2 == 1, F.pmod("node", F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    together = Window.partitionBy("sig", "salt").orderBy("meta", "node")
    size = lambda c: F.shiftright(c, 1).bitwiseAND(F.lit((1 << 39) - 1))
    return (sigs.withColumn("salt", salt)
            .select("sig", "node", "meta", F.first("node").over(together).alias("hub"),
                    F.first("meta").over(together).alias("hub_meta"), F.lag("node").over(together).alias("before"))
            .filter("before IS NULL OR before <> node")
            .filter("hub_meta < (1L << 40) AND node <> hub OR meta % 2 = 1")
            .select("sig", "node", size(F.col("meta")).alias("size"), (F.col("meta") < 1 << 40).alias("indexed"),
                    "hub", size(F.col("hub_meta")).alias("hub_size"), (F.col("hub_meta") < 1 << 40).alias("hub_indexed"),
                    (F.col("meta") % 2 == 1).alias("hot")))


def _bitmap(nodes: DataFrame, bits: int = BITMAP) -> np.ndarray:
    """One bit for each node's residue, in at most ``bits`` / 8 bytes."""
    at = F.pmod("node", F.lit(bits)) + 1  # Spark's bitmaps count from 1
    out = np.zeros(bits // 8, np.uint8)
    for r in (nodes.select(F.bitmap_bucket_number(at).alias("b"), F.bitmap_bit_position(at).alias("p"))
              .groupBy("b").agg(F.bitmap_construct_agg("p").alias("m")).collect()):
        part = np.frombuffer(r["m"], np.uint8)
        out[(r["b"] - 1) * 4096:][:len(part)] = part
    return out


def _bit(bitmap: np.ndarray, node: int) -> bool:
    at = node % (len(bitmap) * 8)
    return bool(bitmap[at >> 3] >> (at & 7) & 1)


def _sets(docs: DataFrame, bitmap: np.ndarray, clashing: frozenset[int], shingle_words: int) -> DataFrame:
    """(node, tokens) of the sets whose node the bitmap names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in _parts(batches):
            nodes, sets = [], []
            for tokens in token_sets(part, shingle_words):
                node = _node(set_keys(tokens), clashing)
                if len(tokens) and node not in seen and _bit(bitmap, node):
                    seen.add(node)
                    nodes.append(node)
                    sets.append(tokens.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))],
                                             ["node", "tokens"])

    return docs.select("text").mapInArrow(run, "node bigint, tokens array<bigint>")


def _possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches allow the similarity."""

    @F.arrow_udf("boolean")
    def allowed(sizes: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([sketches_differ(p.as_py(), q.as_py()) * (100 + percent) <= s.as_py() * (100 - percent)
                         for s, p, q in zip(sizes, x, y)], pa.bool_())

    left = nodes.select(F.col("node").alias("a"), F.col("size").alias("m"), F.col("sketch").alias("x"))
    right = nodes.select(F.col("node").alias("b"), F.col("size").alias("n"), F.col("sketch").alias("y"))
    return (pairs.join(left, "a").join(right, "b").filter(F.least("m", "n") * 100 >= F.greatest("m", "n") * percent)
            .filter(allowed(F.col("m") + F.col("n"), F.col("x"), F.col("y"))).select("a", "b"))


class Verifier:
    """Exact check of candidate pairs. Sets of texts are worked out when a pair first needs them, and stored."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, clashing: frozenset[int], shingle_words: int, percent: int):
        self.docs, self.nodes, self.clashing = docs, nodes, clashing
        self.shingle_words, self.percent = shingle_words, percent
        self.sets: DataFrame | None = None

    def links(self, pairs: DataFrame) -> DataFrame:
        """Stored: of pairs (a, b) that sizes and sketches allow, those whose sets reach the similarity."""
        pairs = stored(pairs, "ngram-possible")
        missing = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        if self.sets is not None:
            missing = missing.join(self.sets.select("node"), "node", "left_anti")
        missing = stored(missing, "ngram-missing")
        if self.sets is None or not missing.isEmpty():
            more = stored(_sets(self.docs, _bitmap(missing), self.clashing, self.shingle_words)
                          .join(missing, "node", "left_semi").dropDuplicates(["node"]), "ngram-sets")
            self.sets = more if self.sets is None else self.sets.unionByName(more)
        left = self.sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
        right = self.sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
        common = F.size(F.array_intersect("x", "y"))
        similar = common * (100 + self.percent) >= (F.size("x") + F.size("y")) * self.percent
        return stored(pairs.join(left, "a").join(right, "b").filter(similar).select("a", "b"), "ngram-links")


def _groups(members: DataFrame) -> DataFrame:
    """(hub, node, size, indexed): buckets of one hub put together, the hub included.

    Frequent combinations were dealt over several keys; here each has one hub again. Those of a single set are left out.
    """
    hot = members.filter("hot")
    one = (hot.groupBy("sig").agg(F.min(F.when(F.col("hub_indexed"), F.struct("hub_size", "hub"))).alias("h"),
                                  F.min("node").alias("lo"), F.max("node").alias("hi"))
           .filter("h IS NOT NULL AND lo <> hi")
           .select("sig", F.col("h.hub").alias("hub"), F.col("h.hub_size").alias("hub_size")))
    rest = members.filter("NOT hot")
    rows = rest.select("hub", "node", "size", "indexed").unionByName(
        hot.drop("hub", "hub_size").join(one, "sig").select("hub", "node", "size", "indexed"))
    # from the buckets, not from the rows: the join above is made once
    hubs = rest.select("hub", "hub_size").unionByName(one.select("hub", "hub_size")).select(
        "hub", F.col("hub").alias("node"), F.col("hub_size").alias("size"), F.lit(True).alias("indexed"))
    return rows.unionByName(hubs).groupBy("hub", "node", "size").agg(F.max("indexed").alias("indexed"))


def _near_roots(links: DataFrame, steps: int = STEPS) -> DataFrame:
    """Stored (node, root): the smallest node within ``steps`` links, a part of the component.

    Enough to leave out pairs inside a star; the components themselves are worked out once, at the end.
    """
    both = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "ngram-both")
    roots = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
        "node", F.least("node", "low").alias("root"))
    for _ in range(steps - 1):
        near = both.join(roots.withColumnsRenamed({"node": "b", "root": "low"}), "b").select("a", "low")
        roots = near.groupBy(F.col("a").alias("node")).agg(F.min("low").alias("root"))  # each node is two links from itself
    return stored(roots, "ngram-roots")


def _open(groups: DataFrame, links: DataFrame) -> DataFrame:
    """Stored: rows of the groups that hold several components, as far as ``_near_roots`` tells, with the root of each."""
    placed = groups.join(_near_roots(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = (placed.groupBy("hub").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
               .filter("lo <> hi").select("hub"))
    return stored(placed.join(several, "hub"), "ngram-open")


def _across(rows: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components of a group that sizes and sketches allow, ``a`` no smaller than ``b``.

    A group's rows are dealt over blocks of about ``BLOCK``; each pair of blocks is a unit of work of its own.
    """
    n = rows.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = (rows.join(n, "hub").join(nodes.select("node", "sketch"), "node")
             .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("hub", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node",
                     "size", "indexed", "root", "sketch")
             .repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j"))

    def unit(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        node, size, root, own = (group[c].to_numpy() for c in ("node", "size", "root", "own"))
        small = group["indexed"].to_numpy()
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        width = min(len(x) for x in group["sketch"].to_pylist())
        cells = np.array([np.frombuffer(folded(x, width), np.uint64) for x in group["sketch"].to_pylist()])
        out: tuple[list, list] = ([], [])
        for x in range(len(node)):
            fits = small & (root != root[x]) & (size <= size[x]) & (size * 100 >= size[x] * percent)
            if i != j:
                fits &= own != own[x]
            at = np.flatnonzero(fits)
            if len(at):
                differ = np.bitwise_count(cells[at] ^ cells[x]).sum(1, dtype=np.int64)
                at = at[differ * (100 + percent) <= (size[at] + size[x]) * (100 - percent)]
                out[0].append(np.full(len(at), node[x]))
                out[1].append(node[at])
        return tuple(np.concatenate(c) if c else np.zeros(0, np.int64) for c in out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys = np.stack([table[c].to_numpy() for c in ("hub", "i", "j")]) if len(batch) else np.zeros((3, 0))
            edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), len(batch)]
            for a, b in zip(edges, edges[1:]):
                part = table.slice(a, b - a)
                if held and part.num_rows and any(held[0][c][0] != part[c][0] for c in ("hub", "i", "j")):
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, unit(pa.concat_tables(held)))), ["a", "b"])
                    held = []
                if part.num_rows:
                    held.append(part)
        if held:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, unit(pa.concat_tables(held)))), ["a", "b"])

    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def linked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle_words: int = SHINGLE_WORDS,
           percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id (smallest id reachable by links)."""
    if not 70 <= percent <= 99:
        raise ValueError("percent must be 70 to 99: below, frequent tokens need other parts")
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    first = stored(_keyed(d, shingle_words), "ngram-keys")
    keys = first.filter("size IS NOT NULL").select("doc_id", "k1", "k2", "size")
    # different sets with one key: about N**2 / 2**65 of N sets
    clashing = frozenset(r["k1"] for r in keys.groupBy("k1").agg(F.min("k2").alias("x"), F.max("k2").alias("y"))
                         .filter("x <> y").select("k1").collect())
    node = F.when(F.col("k1").isin(list(clashing)), F.col("k2")).otherwise(F.col("k1")) if clashing else F.col("k1")
    nodes = (first.filter("size > 0 AND data IS NOT NULL").select(node.alias("node"), "size", F.col("data").alias("sketch"))
             .dropDuplicates(["node"]))
    prefixes = Prefixes(_summed(first.filter("chunk IS NOT NULL").select("chunk", F.col("data").alias("cells"))), percent)
    members = stored(_members(_combinations(d, prefixes, clashing, shingle_words)), "ngram-members")

    pairs = (members.filter("hub_indexed AND node <> hub").filter(
        F.least("size", "hub_size") * 100 >= F.greatest("size", "hub_size") * percent)
        .select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct())
    verifier = Verifier(d, nodes, clashing, shingle_words, percent)
    links = found = verifier.links(_possible(pairs, nodes, percent))
    groups = stored(_groups(members), "ngram-groups")
    several = _open(groups, links)
    fits = f"big.size >= small.size AND small.indexed AND small.size * 100 >= big.size * {percent}"
    for turn in range(HUB_ROUNDS):
        if found.isEmpty() or several.isEmpty():
            break
        # another hub for each group: whatever lies in another component is verified against it
        hubs = (several.filter("indexed").groupBy("hub").agg(F.min_by(
            F.struct("node", "size", "root", "indexed"), F.xxhash64("node", F.lit(turn))).alias("h")).select("hub", "h.*"))
        pairs = []
        for big, small in ((several.alias("big"), hubs.alias("small")), (hubs.alias("big"), several.alias("small"))):
            pairs.append(big.join(small, F.expr(f"big.hub = small.hub AND big.root <> small.root AND {fits}"))
                         .select(F.col("big.node").alias("a"), F.col("small.node").alias("b")))
        found = verifier.links(_possible(pairs[0].unionByName(pairs[1]).distinct(), nodes, percent))
        links = stored(links.unionByName(found), "ngram-links")
        several = _open(groups, links)
    found = verifier.links(_across(several, nodes, percent))
    roots = stored(components(links.unionByName(found), "ngram-cc"), "ngram-roots")

    rows = keys.withColumn("node", node)
    ids = rows.filter("size > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"))
    rooted = ids.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # a set may belong to a third of all rows: its rows are dealt over SALTS keys
    salted = (rooted.join(smallest, "root").select("node", "component_id")
              .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    whole = (rows.filter("size > 0").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
             .join(salted, ["node", "salt"]).select("doc_id", F.col("size").alias("n_shingles"), "component_id"))
    return whole.unionByName(rows.filter("size = 0").select("doc_id", F.col("size").alias("n_shingles"),
                                                            F.col("doc_id").alias("component_id")))
