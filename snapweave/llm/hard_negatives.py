"""Hard-negative mining over Hilbert-ordered Parquet blocks with zone maps.

Components become integers floor(scale * x); a row's score for an anchor is the integer inner
product. Per anchor, its first ``POSITIVES`` other rows of its label (score down, id up) are its
positives; each opens a window [ceil(low% of its score), floor(high% of it)], and the first
``NEGATIVES`` rows of other labels inside the window are returned.

Index. All rows are ordered along a Hilbert curve through all dimensions (``BITS`` bits each) and
written as Parquet blocks of at most ``BLOCK_ROWS`` rows, each with the minimum and maximum of
every dimension (its zone map) and its labels. Interval arithmetic over the zone map bounds the
scores an anchor can have in the block: from ``sum(min(a*lo, a*hi))`` to ``sum(max(a*lo, a*hi))``.

Search. For the positives, the anchor's own block, its neighbourhood on the curve, gives a first
last-place score and so a lower limit. Zone maps alone then tell which blocks an anchor's positives,
and afterwards its windows, may touch; only those are read, in units of up to ``CHUNK`` anchors
and 8 blocks, whose best rows are merged.
The bounds discard nothing that belongs to the result, so the result is exact; how many blocks
they discard depends on how far the data cluster (hardly any for random directions).

Nothing is collected but the value range of each dimension and the number of blocks.

Defined results: rows with a null label or vector, or a null or non-finite component take no part;
shorter vectors count as filled with zeros; a null id is no anchor and comes last among ties;
rows with equal ids are different rows (place in the stored table breaks the tie); an anchor
without positives, or a window without rows, gives none; scores beyond 64 bits count as the
largest (smallest) long. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapweave.llm.common import stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW_PERCENT, HIGH_PERCENT = 30, 90
BITS = 4
BLOCK_ROWS = 512
CHUNK = 4096  # anchors of a unit; a power of two
ZONES = 1024  # zone maps of a planning unit, about
LARGEST = (1 << 63) - 1
NO_ID = LARGEST  # stands for a null id inside blocks


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of integer cells (rows x dimensions, ``bits`` bits each), as byte rows.

    The axes-to-transpose form: every bit level undoes its exchange and inversion, then a Gray code.
    """
    x = cells.astype(np.uint32).copy()
    dims = x.shape[1]
    for level in range(bits - 1, 0, -1):
        low = np.uint32((1 << level) - 1)
        for i in range(dims):
            inverted = (x[:, i] >> np.uint32(level) & np.uint32(1)).astype(bool)
            swapped = np.where(inverted, 0, (x[:, 0] ^ x[:, i]) & low).astype(np.uint32)
            x[:, 0] ^= np.where(inverted, low, swapped)
            x[:, i] ^= swapped
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    flips = np.zeros(len(x), np.uint32)
    for level in range(bits - 1, 0, -1):
        flips ^= np.where(x[:, dims - 1] >> np.uint32(level) & np.uint32(1), np.uint32((1 << level) - 1), np.uint32(0))
    x ^= flips[:, None]
    planes = [(x >> np.uint32(level) & np.uint32(1)).astype(np.uint8) for level in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes, axis=1), axis=1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of ``a`` and ``b``, exact up to the range of a long."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2.0 ** 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    exact = a.astype(object) @ b.T.astype(object)
    return np.clip(exact, -LARGEST - 1, LARGEST).astype(np.int64)


def score_bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that rows within [low, high] can have, anchors x blocks."""
    a, low, high = (m.astype(np.float64) for m in (a, low, high))
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    slack = 1e-12 * (np.abs(a) @ np.maximum(np.abs(low), np.abs(high)).T)  # beyond 2**53 sums are rounded
    slack[slack < 1e-3] = 0.0
    return up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack


def best(score: np.ndarray, ids: np.ndarray, ats: np.ndarray, inside: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the first ``k`` rows of ``inside``: score down, then id, then place."""
    if len(inside) > k:
        least = np.partition(score[inside], len(inside) - k)[len(inside) - k]
        inside = inside[score[inside] >= least]
    return inside[np.lexsort((ats[inside], ids[inside], -score[inside]))[:k]]


def _matrix(column: list[bytes], dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.int64).reshape(-1, dims)


def prepared(rows: DataFrame, vec_id: str, vector: str, label: str | Column, scale: int) -> tuple[DataFrame, int]:
    """Rows that take part, stored: at, id, label, q (integers as bytes) and their place on the curve; dimensions."""
    label = F.col(label) if isinstance(label, str) else label
    real = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    whole = rows.select(F.col(vec_id).cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.when(
        real, F.transform(vector, lambda x: F.floor(x.cast("double") * scale))).alias("v"))
    whole = whole.filter("label IS NOT NULL AND v IS NOT NULL")
    spans = whole.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    ranges = {r["d"]: (r["lo"], r["hi"]) for r in spans.collect()}
    dims = max(1, len(ranges))
    # a vector shorter than the longest counts as filled with zeros
    lo = np.array([min(0, ranges[d][0]) if d in ranges else 0 for d in range(dims)], np.float64)
    hi = np.array([max(0, ranges[d][1]) if d in ranges else 0 for d in range(dims)], np.float64)

    @F.arrow_udf("struct<q:binary,curve:binary>")
    def placed(vectors: pa.Array) -> pa.Array:
        q = np.zeros((len(vectors), dims), np.int64)
        for i, v in enumerate(vectors):
            x = v.values.to_numpy(zero_copy_only=False) if v.is_valid else ()
            q[i, :len(x)] = x
        cells = ((q - lo) / np.maximum(hi - lo, 1) * ((1 << BITS) - 1)).astype(np.uint32)
        return pa.StructArray.from_arrays(
            [pa.array([r.tobytes() for r in q], pa.binary()),
             pa.array([r.tobytes() for r in hilbert_keys(cells)], pa.binary())], ["q", "curve"])

    found = whole.select("id", "label", placed("v").alias("p")).select("id", "label", "p.q", "p.curve")
    return stored(found.withColumn("at", F.monotonically_increasing_id()), "hard-rows"), dims


def blocked(rows: DataFrame, dims: int) -> DataFrame:
    """Stored blocks along the curve: block, ids, ats, labels, data, lo, hi."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def cut(last: bool) -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(waiting).combine_chunks() if waiting else None
            waiting.clear()
            at = 0
            while whole is not None and (whole.num_rows - at >= BLOCK_ROWS or last and whole.num_rows > at):
                part = whole.slice(at, BLOCK_ROWS)
                at += part.num_rows
                data = _matrix(part["q"].to_pylist(), dims)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part["id"].fill_null(NO_ID).to_pylist()], pa.list_(pa.int64())),
                     *[pa.array([part[c].to_pylist()], pa.list_(pa.int64())) for c in ("at", "label")],
                     *[pa.array([m.tobytes()], pa.binary()) for m in (data, data.min(0), data.max(0))]],
                    ["ids", "ats", "labels", "data", "lo", "hi"])
            if whole is not None and whole.num_rows > at:
                waiting.extend(whole.slice(at).to_batches())

        for batch in batches:
            waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= BLOCK_ROWS:
                yield from cut(False)
        yield from cut(True)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["curve", "id", "at"]
    packed = (rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "at", "label", "q")
              .mapInArrow(pack, "ids array<bigint>, ats array<bigint>, labels array<bigint>, data binary, lo binary, hi binary"))
    return stored(packed.withColumn("block", F.monotonically_increasing_id()), "hard-blocks")


def _anchors(blocks: DataFrame, dims: int, every: int, positives: int) -> DataFrame:
    """Stored anchors in curve order, with a lower limit of their last positive's score from their own block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for b in batch.to_pylist():
                ids, ats, labels = (np.array(b[c], np.int64) for c in ("ids", "ats", "labels"))
                data = _matrix([b["data"]], dims)
                own = np.flatnonzero((ids % every == 0) & (ids != NO_ID))
                if not len(own):
                    continue
                score = products(data[own], data)
                for row, i in zip(score, own):
                    others = np.flatnonzero((labels == labels[i]) & (ats != ats[i]))
                    first = best(row, ids, ats, others, positives)
                    limit = int(row[first[-1]]) if len(first) == positives else -LARGEST - 1
                    out.append((int(ats[i]), int(ids[i]), int(labels[i]), data[i].tobytes(), [limit], [LARGEST]))
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.binary()),
                 *[pa.array(c, pa.list_(pa.int64())) for c in cols[4:]]], ["at", "id", "label", "q", "lows", "highs"])

    found = blocks.select("ids", "ats", "labels", "data").mapInArrow(
        run, "at bigint, id bigint, label bigint, q binary, lows array<bigint>, highs array<bigint>")
    return stored(found.withColumn("chunk", F.shiftright(F.monotonically_increasing_id(), CHUNK.bit_length() - 1)),
                  "hard-anchors")


def _chosen(anchors: DataFrame, blocks: DataFrame, dims: int, same: bool) -> DataFrame:
    """(chunk, block) pairs in which some anchor's windows may have a row, by zone maps alone.

    A task takes one chunk and about ``ZONES`` zone maps, each once: anchors are not repeated for every map.
    """
    spread = max(1, -(-blocks.count() // ZONES))
    zones = blocks.select("block", "lo", "hi", F.array_distinct("labels").alias("held"),
                          F.pmod(F.xxhash64("block"), F.lit(spread)).alias("for_zone"))
    maps = zones.crossJoin(F.broadcast(anchors.select(F.col("chunk").alias("for_chunk")).distinct()))
    asking = anchors.select("chunk", "label", "q", "lows", "highs",
                            F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(spread - 1).cast("bigint"))).alias("zone"))

    def run(key, asked: pa.Table, zone: pa.Table) -> pa.Table:
        some, held = asked.select(["label", "q", "lows", "highs"]).to_pylist(), [set(x) for x in zone["held"].to_pylist()]
        low, high = (_matrix(zone[c].to_pylist(), dims) for c in ("lo", "hi"))
        wanted = np.zeros(len(held), bool)
        for start in range(0, len(some) if held else 0, 256):
            part = some[start:start + 256]
            least, most = score_bounds(_matrix([a["q"] for a in part], dims), low, high)
            for i, a in enumerate(part):
                for lo, hi in zip(a["lows"], a["highs"]):
                    for j in np.flatnonzero(~wanted & (most[i] >= lo) & (least[i] <= hi)):
                        wanted[j] = a["label"] in held[j] if same else bool(held[j] - {a["label"]})
        found = zone["block"].to_numpy()[wanted]
        return pa.Table.from_arrays([pa.array([key[0].as_py()] * len(found), pa.int64()), pa.array(found, pa.int64())],
                                    ["chunk", "block"])

    return (asking.groupBy("chunk", "zone").cogroup(maps.groupBy("for_chunk", "for_zone"))
            .applyInArrow(run, "chunk bigint, block bigint"))


def _read(anchors: DataFrame, blocks: DataFrame, dims: int, same: bool, k: int) -> DataFrame:
    """First ``k`` rows of each anchor's windows: at, window, place, id, row_at, score."""
    pairs = stored(_chosen(anchors, blocks, dims, same).withColumn("unit", F.shiftright("block", 3)), "hard-pairs")
    needed = (pairs.withColumnsRenamed({"chunk": "for_chunk", "unit": "for_unit"})
              .join(blocks.select("block", "ids", "ats", "labels", "data"), "block"))
    asking = pairs.select("chunk", "unit").distinct().join(anchors, "chunk")

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        ids, ats, labels = (np.array([x for r in right[c].to_pylist() for x in r], np.int64) for c in ("ids", "ats", "labels"))
        data = _matrix(right["data"].to_pylist(), dims)
        asked = left.select(["at", "label", "q", "lows", "highs"]).to_pylist()
        out: list[tuple] = []
        for start in range(0, len(asked), 256):
            part = asked[start:start + 256]
            for a, score in zip(part, products(_matrix([a["q"] for a in part], dims), data)):
                fits = (labels == a["label"]) & (ats != a["at"]) if same else labels != a["label"]
                for w, (lo, hi) in enumerate(zip(a["lows"], a["highs"])):
                    for i in best(score, ids, ats, np.flatnonzero(fits & (score >= lo) & (score <= hi)), k):
                        out.append((a["at"], w, int(ids[i]), int(ats[i]), int(score[i])))
        cols = list(zip(*out)) or [()] * 5
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in cols], ["at", "w", "id", "row_at", "score"])

    found = (asking.groupBy("chunk", "unit").cogroup(needed.groupBy("for_chunk", "for_unit"))
             .applyInArrow(run, "at bigint, w bigint, id bigint, row_at bigint, score bigint"))
    place = F.row_number().over(Window.partitionBy("at", "w").orderBy(F.desc("score"), "id", "row_at"))
    return found.withColumn("place", place).filter(F.col("place") <= k)


def mined(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
          every: int = 100, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
          low_percent: int = LOW_PERCENT, high_percent: int = HIGH_PERCENT) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    held, dims = prepared(rows, vec_id, vector, label, scale)
    blocks = blocked(held, dims)
    anchors = _anchors(blocks, dims, every, positives)
    first = stored(_read(anchors, blocks, dims, True, positives)
                   .select("at", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "hard-positives")
    exact = F.col("positive_score").cast("decimal(25,0)")
    low = F.ceil(exact * low_percent / 100).cast("bigint")
    high = F.floor(exact * high_percent / 100).cast("bigint")
    windows = (first.groupBy("at").agg(F.sort_array(F.collect_list(F.struct(
        "place", low.alias("low"), high.alias("high")))).alias("s"))
        .select("at", F.col("s.low").alias("lows"), F.col("s.high").alias("highs")))
    asking = stored(anchors.drop("lows", "highs").join(windows, "at"), "hard-windows")
    found = _read(asking, blocks, dims, False, negatives)
    named = (first.join(asking.select("at", F.col("id").alias("anchor_id")), "at")
             .withColumn("w", (F.col("place") - 1).cast("bigint")).drop("place"))
    public = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return (found.select("at", "w", F.col("place").alias("rank"), F.col("id").alias("negative_id"),
                         F.col("score").alias("negative_score"))
            .join(named, ["at", "w"])
            .select("anchor_id", public("positive_id"), "rank", public("negative_id"), "positive_score", "negative_score"))
