import hashlib
import math
import random
import re
import zlib

from pyspark.sql import functions as F

from snapweave.llm import resample


def brute(rows, target, percent=10, least=20):
    def words(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    def buckets(t):
        return [zlib.crc32(w.encode()) % 10000 for w in words(t)]

    s, t = [0] * 10000, [0] * 10000
    for _, x in rows:
        for b in buckets(x):
            s[b] += 1
    for x in target:
        for b in buckets(x):
            t[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10000) / ((s[b] + 1) * (sum(t) + 10000))))
            for b in range(10000)]
    out = []
    for i, x in rows:
        own = buckets(x)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in own)
        out.append([i, len(own), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    inside = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = len(inside) * percent // 100
    rank = {id(r): k + 1 for k, r in enumerate(inside) if k < drawn}
    return sorted((tuple(map(str, r + [rank.get(id(r))])) for r in out))


def texts(rng, n):
    words = [f"w{k}" for k in range(400)] + ["Über", "ÄNDERN", "naïve", "中文", "A1", "x-y", "it's"]
    return [" ".join(rng.choices(words, k=rng.randint(0, 90))) for _ in range(n)]


def test_ranks_match_brute_force(spark, docs_of):
    rng = random.Random(2)
    rows = list(enumerate(texts(rng, 600))) + [(700, None), (701, ""), (702, " \n-"), (None, "a b " * 30)]
    rows += [(800, "same row " * 20)] * 40 + [(7, rows[7][1])]  # repeated rows
    rows.append((900, "long word " * 700_000))
    target = texts(rng, 30)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    docs = docs_of(rows).repartition(5)
    got = resample.resample(docs, aim).collect()
    assert sorted(tuple(map(str, (r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]))) for r in got) \
        == brute(rows, target)


def test_equal_rows_are_split_and_ranked_one_by_one(spark):
    rows = spark.range(5000).select((F.col("id") % 3).alias("doc_id"), F.lit(5).cast("bigint").alias("score"),
                                    F.lit("x").alias("note")).repartition(6)
    got = resample.ranked(rows, F.lit(True), 50).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 2501))
    by_rank = [r["doc_id"] for r in sorted((r for r in got if r["rank"]), key=lambda r: r["rank"])]
    assert by_rank == sorted(by_rank) and all(r["note"] == "x" for r in got)


def test_segments_are_even_and_undrawn_ones_are_not_exchanged(spark):
    rows = spark.range(40_000).select(F.col("id").alias("doc_id"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("score"))
    out = resample.ranked(rows, F.lit(True), 10)
    sizes = [r["count"] for r in out.filter("rank is not null").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000
    moved = out.groupBy().agg(F.count("rank").alias("n"), F.max("rank").alias("m")).first()
    assert (moved["n"], moved["m"]) == (4000, 4000)


def test_runs_of_several_words():
    got = sorted(b for part in resample.features("B a\tc", 2) for b in part.tolist())
    assert got == sorted(zlib.crc32(x) % 10000 for x in (b"b", b"a", b"c", b"b a", b"a c"))


def test_empty_tables_and_few_rows(spark, docs_of):
    none = spark.createDataFrame([], "text string")
    assert resample.resample(docs_of([]), none).count() == 0
    few = resample.resample(docs_of([(1, "a " * 30), (2, None)]), none).collect()
    assert [r["rank"] for r in few] == [None, None]
