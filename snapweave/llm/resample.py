"""Target-distribution importance resampling, ranked by parallel sorting by regular sampling.

Weights. Words of a text (ASCII digits, letters, everything beyond ASCII; A-Z lowered) form
runs of 1 to ``max_words`` words; a run falls in the bucket crc32 % ``BUCKETS`` of its UTF-8
bytes. Counting the buckets over all documents and over all target texts gives one array of
integer gains, ``BUCKETS`` long whatever the corpus; a text's weight is the sum of the gains
at its runs' buckets, taken from the array in one step.

Draw. Every document adds Gumbel noise of its id to its weight, and the highest scores win.
The scored rows (no texts) are sorted within each partition and written as runs; every
``stride``-th row of each run is a sample. The sorted samples give the splitters, each run's
rows are exchanged by the segment they fall in, and segments are sorted on their own. The
rows of the segments before it (one count a segment) plus the place in its segment is a row's
exact rank. Segments behind the last drawn rank are not exchanged at all. The order is
(score, doc_id, place in its run), so that any number of equal rows can be split.

Driver: ``BUCKETS`` counts, at most one sample per ``stride`` rows (``SAMPLES_A_SEGMENT`` a
segment and one a run), one count a segment.

Defined results: a null or wordless text has no features and weight 0; a null id counts as the
text "" in the noise and comes after all others among ties; repeated rows are ranked one by one
next to each other; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_right
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapweave.llm.common import stored

BUCKETS = 10_000
MAX_WORDS = 1
MIN_FEATURES = 20
DRAWN_PERCENT = 10
NOISE_PREFIX = "2024:"
SAMPLES_A_SEGMENT = 64

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # every byte of a character beyond ASCII is 0x80 or more
_TEXT_SLICE = 1 << 20  # words of a long text are hashed in slices of so many


def features(text: str | None, max_words: int = MAX_WORDS) -> Iterator[np.ndarray]:
    """Buckets of the text's runs of words, repeats included, in slices."""
    words = map(re.Match.group, _WORD.finditer((text or "").encode().translate(_LOWER)))
    crc = zlib.crc32
    part: list[int] = []
    before: deque[bytes] = deque(maxlen=max_words)
    for word in words:
        part.append(crc(word))
        if max_words > 1:
            before.append(word)
            last = list(before)
            part.extend(crc(b" ".join(last[-k:])) for k in range(2, len(last) + 1))
        if len(part) >= _TEXT_SLICE:
            yield np.array(part, np.int64) % BUCKETS
            part = []
    yield np.array(part, np.int64) % BUCKETS


def bucket_counts(texts: DataFrame, text: str = "text", max_words: int = MAX_WORDS) -> np.ndarray:
    """Features of all texts by bucket: each task sums its own, one row a bucket and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for t in batch.column(0):
                for buckets in features(t.as_py(), max_words):
                    total += np.bincount(buckets, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    for r in (texts.select(text).mapInArrow(run, "bucket int, n bigint").groupBy("bucket")
              .agg(F.sum("n").alias("n")).collect()):
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed ratio of shares) for every bucket."""
    whole, aim = float(corpus.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    return np.array([math.floor(1000.0 * math.log((t + 1.0) * whole / ((s + 1.0) * aim)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(doc_id: str | Column, prefix: str = NOISE_PREFIX) -> Column:
    """floor of 1000 x Gumbel noise drawn from the SHA-256 of the id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    digest = F.sha2(F.concat(F.lit(prefix), F.coalesce(c.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def scored(docs: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text",
           max_words: int = MAX_WORDS) -> DataFrame:
    """doc_id, n_features, weight and score of every row."""

    @F.arrow_udf("struct<n:bigint,weight:bigint>")
    def weigh(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            n, w = [], []
            for t in texts:
                size = total = 0
                for buckets in features(t.as_py(), max_words):
                    size += len(buckets)
                    total += int(gain[buckets].sum())
                n.append(size)
                w.append(total)
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(w, pa.int64())], ["n", "weight"])

    found = docs.select(F.col(doc_id).alias("doc_id"), weigh(text).alias("f"))
    return found.select("doc_id", F.col("f.n").alias("n_features"), F.col("f.weight").alias("weight"),
                        (F.col("f.weight") + noise("doc_id")).alias("score"))


def ranked(rows: DataFrame, eligible: Column, drawn_percent: int = DRAWN_PERCENT) -> DataFrame:
    """``rows`` (doc_id, score, ...) with the exact ``rank`` of the drawn ones, null for all others.

    Drawn are floor(drawn_percent * N / 100) of the N eligible rows: highest score, then smallest doc_id.
    """
    spark = rows.sparkSession
    columns = [c for c in rows.columns if c != "rank"]
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    runs = stored(rows.select(*columns, eligible.alias("_in")).sortWithinPartitions(F.desc("_in"), *order)
                  .withColumn("_at", F.monotonically_increasing_id()), "resample-runs")
    inside = runs.filter("_in")
    n = inside.count()
    drawn = n * drawn_percent // 100
    nobody = F.lit(None).cast("bigint").alias("rank")
    if not drawn:
        return runs.select(*columns, nobody)
    segments = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stride = max(1, n // (segments * SAMPLES_A_SEGMENT))
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))  # the row's place in its run
    samples = inside.filter(place % stride == stride // 2).select("doc_id", "score", "_at").toArrow()
    key = lambda score, i, at: (-score, i is None, 0 if i is None else i, at)
    regular = sorted(map(key, *(samples.column(c).to_pylist() for c in ("score", "doc_id", "_at"))))
    splitters = [regular[len(regular) * k // segments] for k in range(1, segments)] if regular else []

    @F.arrow_udf("int")
    def segment(score: pa.Array, ids: pa.Array, at: pa.Array) -> pa.Array:
        return pa.array([bisect_right(splitters, k) for k in map(
            key, score.to_pylist(), ids.to_pylist(), at.to_pylist())], pa.int32())

    dealt = stored(inside.withColumn("_segment", segment("score", "doc_id", "_at")), "resample-dealt")
    counts = {r["_segment"]: r["count"] for r in dealt.groupBy("_segment").count().collect()}
    before, total = {}, 0
    for s in sorted(counts):
        before[s] = total
        total += counts[s]
    needed = [s for s in before if before[s] < drawn]
    first = F.create_map(*[F.lit(x) for s in needed for x in (s, before[s])])
    taken = F.col("_segment") <= max(needed)

    def count_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at = None, 0  # rows come sorted by segment, so a place is a running number
        for batch in batches:
            places = []
            for s in batch.column(batch.num_columns - 1).to_pylist():
                now, at = (s, at + 1) if s == now else (s, 1)
                places.append(at)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(places, pa.int64())],
                                             [*batch.schema.names[:-1], "_place"])

    kept = [*columns, "_first"]
    merged = (dealt.filter(taken).withColumn("_first", first[F.col("_segment")])
              .repartitionById(segments, F.col("_segment")).sortWithinPartitions("_segment", *order, "_at")
              .select(*kept, "_segment"))
    placed = merged.mapInArrow(count_up, T.StructType([*[merged.schema[c] for c in kept],
                                                       T.StructField("_place", T.LongType())]))
    rank = F.col("_first") + F.col("_place")
    return (placed.select(*columns, F.when(rank <= drawn, rank).alias("rank"))
            .unionByName(dealt.filter(~taken).select(*columns, nobody))
            .unionByName(runs.filter("NOT _in").select(*columns, nobody)))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text",
             max_words: int = MAX_WORDS, min_features: int = MIN_FEATURES,
             drawn_percent: int = DRAWN_PERCENT) -> DataFrame:
    """Every row's doc_id, n_features, weight, score and rank (null if not drawn)."""
    gain = gains(bucket_counts(docs, text, max_words), bucket_counts(target, text, max_words))
    # the least number of words is asked of the text, so with runs of up to k words n words count more than once
    least = sum(max(0, min_features - k) for k in range(max_words))
    return ranked(scored(docs, gain, doc_id, text, max_words), F.col("n_features") >= least, drawn_percent)
