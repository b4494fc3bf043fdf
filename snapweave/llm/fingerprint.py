"""Document fingerprints: a homomorphic multiset hash over paragraphs.

A paragraph (a line of the text) is hashed to a wide vector: ``STRONG`` lanes of 64
bits from two keyed 128-bit hashes of the paragraph, and ``LANES`` lanes of 32 bits
in which each pair of neighbouring words of the paragraph adds or subtracts one in
the lane its hash names. A text's fingerprint is the sum of its paragraphs'
vectors, modulo 2**64 and 2**32. So it does not depend on the order of the
paragraphs, the fingerprint of a union is the sum, and a paragraph is inserted or
deleted by adding or subtracting its vector (``add``, ``subtract``).

Equality is decided by all lanes. Likeness uses the word lanes: they are a signed
sketch of the word pairs, so the cosine of two of them estimates the share of word
pairs in common; it is cut to 0..1 and is 1 for equal fingerprints.

Defined results: a null text counts as empty, an empty text is one empty
paragraph. Rows with a null id come first in id order, repeated ids are ordered by
text; every row has a successor (the first row after the last; itself if alone).
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRONG = 4
LANES = 64
CACHE_WORDS = 300_000
BREAK = 0x6A09E667F3BCC909  # stands for a paragraph's edge among word hashes


class Words(dict):
    """Word -> 64-bit hash."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        got = self[word] = xxhash.xxh64_intdigest(word, 7)
        return got


def vector(text: str, words: Words) -> np.ndarray:
    """Sum of the paragraph vectors of ``text``: STRONG + LANES unsigned numbers."""
    strong = [0] * STRONG
    hashes: list[int] = [BREAK]
    for paragraph in text.split("\n"):
        data = paragraph.encode()
        a, b = xxhash.xxh3_128_intdigest(data, 1), xxhash.xxh3_128_intdigest(data, 2)
        strong[0] += a >> 64
        strong[1] += a & 0xFFFFFFFFFFFFFFFF
        strong[2] += b >> 64
        strong[3] += b & 0xFFFFFFFFFFFFFFFF
        hashes.extend(map(words.__getitem__, paragraph.split()))
        hashes.append(BREAK)
    h = np.array(hashes, np.uint64)
    edge = (h[:-1] == BREAK) & (h[1:] == BREAK)  # an empty paragraph has no word pair
    pair = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(0x165667B1))
    pair = ((pair ^ (pair >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93))[~edge] >> np.uint64(40)
    sign = 1.0 - 2.0 * ((pair >> np.uint64(10)) & np.uint64(1)).astype(np.float64)
    lanes = np.bincount((pair % np.uint64(LANES)).astype(np.int64), weights=sign, minlength=LANES)
    return np.concatenate([np.array([s & 0xFFFFFFFFFFFFFFFF for s in strong], np.uint64),
                           lanes.astype(np.int64).astype(np.uint32).astype(np.uint64)])


def add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a + b  # modulo 2**64
    out[STRONG:] &= np.uint64(0xFFFFFFFF)
    return out


def subtract(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = a - b
    out[STRONG:] &= np.uint64(0xFFFFFFFF)
    return out


def to_hex(v: np.ndarray) -> str:
    return v[:STRONG].astype(">u8").tobytes().hex() + v[STRONG:].astype(">u4").tobytes().hex()


def from_hex(s: str) -> np.ndarray:
    raw = bytes.fromhex(s)
    return np.concatenate([np.frombuffer(raw[:8 * STRONG], ">u8").astype(np.uint64),
                           np.frombuffer(raw[8 * STRONG:], ">u4").astype(np.uint64)])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0..1; 1 for equal fingerprints."""
    if (a == b).all():
        return 1.0
    x = a[STRONG:].astype(np.uint32).astype(np.int32).astype(np.float64)
    y = b[STRONG:].astype(np.uint32).astype(np.int32).astype(np.float64)
    norm = float(x @ x) * float(y @ y)
    return max(0.0, min(1.0, float(x @ y) / norm ** 0.5)) if norm else 0.0


def fingerprint(text: str | Column) -> Column:
    """Fingerprint of a text column as hexadecimal digits."""

    @F.arrow_udf("string")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = Words()
        for texts in batches:
            yield pa.array([to_hex(vector(t.as_py() or "", words)) for t in texts], pa.string())

    return of(text)


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as many first characters of ``following``."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def edited_vector(own: np.ndarray, text: str, new: str, words: Words) -> np.ndarray:
    """Fingerprint of ``new`` from that of ``text``: only the paragraphs from the cut on are exchanged."""
    cut = len(text) - len(text) // 4
    start = text.rfind("\n", 0, cut) + 1
    return add(subtract(own, vector(text[start:], words)), vector(new[start:], words))


def with_successor(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, text, bucket, guest) dealt out by id range, sorted, each bucket ending with its successor.

    The ids alone are range-partitioned first; the smallest id of every range is
    collected (one per partition). The row at the start of a range is also sent, as
    a guest, to the range before it, so texts are shuffled once.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = (d.select("doc_id").repartitionByRange(parts, "doc_id").groupBy(F.spark_partition_id())
              .agg(F.min("doc_id").alias("first"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).collect())
    starts = sorted(r["first"] for r in ranges if r["first"] is not None)
    any_null = any(r["nulls"] for r in ranges)
    last = max(0, len(starts) - 1)

    @F.arrow_udf("array<struct<bucket:int,guest:boolean>>")
    def places(ids: pa.Array) -> pa.Array:
        out = []
        for value in ids:
            x = value.as_py()
            b = 0 if x is None else max(0, bisect_right(starts, x) - 1)
            own = [{"bucket": b, "guest": False}]
            if x is None or (x == starts[0] and not any_null):
                own.append({"bucket": last, "guest": True})
            elif x == starts[b] and b:
                own.append({"bucket": b - 1, "guest": True})
            out.append(own)
        return pa.array(out, pa.list_(pa.struct([("bucket", pa.int32()), ("guest", pa.bool_())])))

    return (d.select("doc_id", "text", F.explode(places("doc_id")).alias("at"))
            .select("doc_id", "text", "at.bucket", "at.guest")
            .repartitionById(parts, F.col("bucket")).sortWithinPartitions("bucket", "guest", "doc_id", "text"))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = with_successor(docs, doc_id, text)
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), *T.StructType.fromDDL(
        "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held = Words(), None  # held: the row that waits for its successor
        for batch in batches:
            out, owners = [], []
            for i, (t, bucket, guest) in enumerate(zip(batch.column(1), batch.column(2).to_pylist(),
                                                       batch.column(3).to_pylist())):
                if guest and (held is None or held[3] != bucket):
                    continue  # the range's last row already has its successor
                now = t.as_py()
                own = vector(now, words)
                if held is not None and held[3] == bucket:
                    before, text_before, own_before, _ = held
                    new = edited(text_before, now)
                    fresh = edited_vector(own_before, text_before, new, words)
                    owners.append(before)
                    out.append((len(text_before), hashlib.sha256(new.encode()).hexdigest(), to_hex(own_before),
                                to_hex(fresh), likeness(own_before, fresh), likeness(own_before, own)))
                held = None if guest else (batch.column(0).slice(i, 1), now, own, bucket)
            cols = list(zip(*out)) or [()] * 6
            ids = pa.concat_arrays(owners) if owners else batch.column(0).slice(0, 0)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cols[0], pa.int64()), *[pa.array(c, pa.string()) for c in cols[1:4]],
                 *[pa.array(c, pa.float64()) for c in cols[4:]]], schema.names)

    return rows.mapInArrow(run, schema)
