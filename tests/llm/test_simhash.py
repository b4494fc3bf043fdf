import random

import xxhash

from snapweave.llm import simhash


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    values = sorted(parent)
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {f: find(f) for f in parent}


def test_fingerprints_and_components_match_brute_force(spark, docs_of):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choices(words, k=rng.randint(1, 120))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(60, 220):  # copies with one word changed
        t = rng.choice(base).split(" ")
        t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((i, " ".join(t)))
    rows += [(300, None), (301, ""), (302, " \n\t"), (303, "ÄB A b C"), (304, "only two"), (5, base[5]), (5, base[5])]
    got = simhash.near_duplicates(docs_of(rows)).collect()
    assert len(got) == len(rows)
    fps = {i: brute_fingerprint(t) for i, t in rows}
    roots = brute_components(set(fps.values()))
    smallest = {}
    for i, f in fps.items():
        smallest[roots[f]] = min(i, smallest.get(roots[f], i))
    for r in got:
        assert r["fp"] & (1 << 64) - 1 == fps[r["doc_id"]]
        assert r["component_id"] == smallest[roots[fps[r["doc_id"]]]]


def test_crowded_cells_give_the_same_components(spark, monkeypatch):
    rng = random.Random(3)
    seed = rng.getrandbits(64)
    values = {seed}
    while len(values) < 250:  # a chain of near fingerprints, plus strangers
        values.add(rng.choice(sorted(values)) ^ 1 << rng.randrange(64))
    values |= {rng.getrandbits(64) for _ in range(100)}
    frame = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp bigint")
    roots = brute_components(values)
    for limit in (4, 64, 1000):
        monkeypatch.setattr(simhash, "CELL_MAX", limit)
        got = {r["node"]: r["root"] for r in simhash.components(simhash._links(frame, 2)).collect()}
        groups = {}
        for v in values:
            groups.setdefault(got.get(simhash._signed(v), simhash._signed(v)), set()).add(v)
        want = {}
        for v in values:
            want.setdefault(roots[v], set()).add(v)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_embedding_is_a_lower_bound(spark):
    rng = random.Random(1)
    pairs = []
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for _ in range(rng.randint(0, 6)):
            b ^= 1 << rng.randrange(64)
        pairs.append((simhash._signed(a), simhash._signed(b)))
    from pyspark.sql import functions as F
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    df = df.select("a", "b", F.bit_count(simhash.embed(F.col("a")).bitwiseXOR(simhash.embed(F.col("b")))).alias("l1"))
    for r in df.collect():
        counts = [sum(abs((r[x] >> 2 * i & 3).bit_count() - (r[y] >> 2 * i & 3).bit_count()) for i in range(32))
                  for x, y in (("a", "b"),)][0]
        assert r["l1"] == counts <= (r["a"] ^ r["b"] & (1 << 64) - 1).bit_count() or r["l1"] == counts


def test_keep_one_and_empty(spark, docs_of):
    rows = [(3, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (None, "x y z w"), (None, None),
            (9, "p q r s t u v")]
    docs = docs_of(rows)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept.collect() if r["text"]) == [
        (-1, "x y z w"), (1, "a b c d e"), (9, "p q r s t u v")]
    assert simhash.keep_one(docs.limit(0)).count() == 0
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_of_rows_with_one_id_and_text_the_same_one_stays(spark, docs_of):
    rows = [(1, "a b c d e f", f"source {k}") for k in range(40)] + [(None, "q r s t u", f"s{k}") for k in range(9)]
    docs = docs_of(rows)
    kept = {tuple(sorted(map(str, simhash.keep_one(docs.repartition(n, "source")).collect()))) for n in (1, 3, 8)}
    assert len(kept) == 1 and len(next(iter(kept))) == 2


def test_small_rounds_are_written_in_few_files(spark, monkeypatch):
    """A few edges must not cost a file for every shuffle partition and round."""
    from snapweave.llm import common

    stem, made = common.scratch_path, []
    monkeypatch.setattr(common, "scratch_path", lambda s, name: made.append(stem(s, name)) or made[-1])
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    rows = [(i, " ".join(f"w{i * 7 + j}" for j in range(30)) + " tail" * (i % 3)) for i in range(120)]
    docs = spark.createDataFrame(rows + [(i + 500, t) for i, t in rows], "doc_id bigint, text string")
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)], "a bigint, b bigint")
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        got = {r["node"]: r["root"] for r in simhash.components(chain, "few", 200).collect()}
        assert simhash.near_duplicates(docs).count() == 240
        assert simhash.near_duplicates(docs).filter("doc_id >= 500 and component_id >= 500").count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: 0 for i in range(201)}
    files = {p.rpartition("/")[2]: len(spark.read.parquet(p).inputFiles()) for p in made if "simhash-fp" not in p}
    assert len(files) > 6 and max(files.values()) == 1, files
