import random

import numpy as np
import pytest

from snapweave.llm import ngram_join as nj


def brute_set(text, k=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    words = [w for w in low.split(" ") if w]
    return {" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def brute(rows, percent=80):
    sets = [brute_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return sorted(str((d, len(sets[i]), low.get(find(i)) if sets[i] else d)) for i, (d, _) in enumerate(rows))


def near_copies(rng, base, n, words, most):
    out = []
    for _ in range(n):
        t = rng.choice(base).split(" ")
        for _ in range(rng.randint(0, most)):
            at = rng.randrange(len(t) + 1)
            t[at:at + rng.randint(0, 2)] = rng.choices(words, k=rng.randint(0, 2))
        out.append(" ".join(t))
    return out


def corpus(rng):
    words = [f"w{i}" for i in range(500)]
    base = [" ".join(rng.choices(words, k=rng.randint(1, 250))) for _ in range(50)]
    passage = " ".join(rng.choices(words, k=60))
    texts = base + near_copies(rng, base, 300, words, 4)
    texts += [passage + " " + " ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(120)]  # a frequent passage
    texts += near_copies(rng, [" ".join(rng.choices(words, k=150))], 200, words, 3)  # one large group
    rows = list(enumerate(texts))
    rows += [(2000, None), (2001, ""), (2002, " \n\t"), (2003, "A b C d"), (2004, "a B c D"), (2005, "a b c"),
             (7, texts[7]), (None, texts[9]), (None, "lone words that nobody else has at all here"),
             (2006, "Äpfel äpfel ä"), (2007, "äpfel äpfel ä")]
    return rows + [(3000 + i, texts[3]) for i in range(150)]


def as_rows(frame):
    return sorted(str((r["doc_id"], r["n_shingles"], r["component_id"])) for r in frame.collect())


def test_components_match_brute_force(spark, docs_of):
    rows = corpus(random.Random(4))
    assert as_rows(nj.linked(docs_of(rows).repartition(7))) == brute(rows)


def test_other_similarity_and_frequent_classes_match_brute_force(spark, docs_of, monkeypatch):
    # every token frequent or very frequent: only pairs and triples are indexed
    inner = nj.Prefixes.__init__

    def crowded(self, counts, percent=80):
        inner(self, counts, percent)
        self.frequent, self.very_frequent = 1, 5
    monkeypatch.setattr(nj.Prefixes, "__init__", crowded)
    rows = corpus(random.Random(8))
    assert as_rows(nj.linked(docs_of(rows).repartition(3), percent=90)) == brute(rows, 90)


@pytest.mark.parametrize("frequent,very", [(10**9, 10**9), (0, 10**9), (0, 0), (3, 6)])
def test_linked_sets_share_a_combination(frequent, very):
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 9, 256).astype(np.uint32)
    p = nj.Prefixes(counts)
    p.frequent, p.very_frequent = frequent, very
    checked = 0
    for n in [*range(4, 40), 63, 64, 65, 79, 80, 127, 128, 129, 160, 300, 1000]:
        for _ in range(12):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
            drop = int(rng.integers(0, n // 4 + 1))
            more = int(rng.integers(0, n // 4 + 1))
            b = np.unique(np.concatenate([rng.permutation(a)[:n - drop],
                                          rng.integers(0, 1 << 63, more, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]))
            common = len(np.intersect1d(a, b))
            if 100 * common < 80 * (len(a) + len(b) - common) or common == len(a) == len(b):
                continue
            big, small = (a, b) if len(a) >= len(b) else (b, a)
            probe = set(np.concatenate(p.of(big)[0]).tolist())
            h, i, _ = p.of(small)
            index = set(np.concatenate(h)[np.concatenate(i)].tolist())
            assert probe & index, (n, len(a), len(b), common)
            checked += 1
    assert checked > 100


def test_combinations_stay_linear():
    rng = np.random.default_rng(2)
    p = nj.Prefixes(np.ones(256, np.uint32))
    for frequent, very in ((0, 10**9), (0, 0)):
        p.frequent, p.very_frequent = frequent, very
        for n in (100, 1000, 30_000):
            got = np.concatenate(p.of(np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)))[0])
            assert len(got) < 6 * n


def test_same_first_key_of_different_sets_is_told_apart(spark, docs_of, monkeypatch):
    real = nj.set_keys
    monkeypatch.setattr(nj, "set_keys", lambda t: (real(t)[0] % 50, real(t)[1]))
    rows = corpus(random.Random(4))[:200]
    assert as_rows(nj.linked(docs_of(rows))) == brute(rows)


def test_tokens_match_the_words(monkeypatch):
    rng = random.Random(3)
    texts = ["", None, " ", "a", "A b", "a  b\tc\nd e", "a b c d e f", "x" * 3000 + " y", "Ä ä É \u00a0 z\u2003w 中文 字 é f g"]
    texts += [" ".join(rng.choices(["Aa", "aA", "b", "cc", "Ünï"], k=rng.randint(0, 40))) for _ in range(200)]
    for size in (1 << 20, 16):
        monkeypatch.setattr(nj, "SLICE", size)
        got = list(nj.token_sets(nj.pa.array(["skipped", *texts])[1:]))
        assert [len(g) for g in got] == [len(brute_set(t)) for t in texts]
        by_set = {}
        for t, g in zip(texts, got):
            assert by_set.setdefault(frozenset(brute_set(t)), g.tobytes()) == g.tobytes()
        assert len(set(by_set.values())) == len(by_set)


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(8)
    for _ in range(300):
        a = np.unique(rng.integers(0, 1 << 63, int(rng.integers(1, 400)), dtype=np.uint64))
        b = np.unique(np.concatenate([rng.permutation(a)[:int(rng.integers(0, len(a) + 1))],
                                      rng.integers(0, 1 << 63, int(rng.integers(1, 300)), dtype=np.uint64)]))
        differ = len(np.setxor1d(a, b))
        assert nj.sketches_differ(nj.sketch(a), nj.sketch(b)) <= differ
        assert nj.sketches_differ(nj.sketch(a), nj.sketch(a)) == 0


def test_blocks_and_no_hub_rounds_give_the_same(spark, docs_of, monkeypatch):
    rows = corpus(random.Random(12))
    monkeypatch.setattr(nj, "BLOCK", 7)
    monkeypatch.setattr(nj, "HUB_ROUNDS", 0)
    assert as_rows(nj.linked(docs_of(rows).repartition(4))) == brute(rows)


@pytest.mark.parametrize("frequent", [10**9, 0])
def test_copies_in_several_tasks_give_each_combination_once(spark, docs_of, frequent):
    prefixes = nj.Prefixes(np.ones(256, np.uint32))
    prefixes.frequent, prefixes.very_frequent = frequent, 10**9
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    text = " ".join(rng.choices(words, k=90))
    texts = [text] * 60 + near_copies(rng, [text], 30, words, 2)

    def members(tasks):
        docs = docs_of(list(enumerate(texts))).select("text").repartition(tasks)
        return nj._members(nj._combinations(docs, prefixes, frozenset(), 5))
    alone, dealt = members(1).collect(), members(9).collect()
    assert len({(r["sig"], r["node"]) for r in dealt}) == len(dealt) > 100
    assert sorted(alone) == sorted(dealt)


def test_frequent_combinations_of_one_set_make_no_group(spark):
    rows = [(1, 10, 100, True, 10, 100, True, True), (2, 10, 100, True, 10, 100, True, True),
            (2, 11, 110, False, 11, 110, False, True), (3, 12, 90, False, 12, 90, False, True)]
    members = spark.createDataFrame(rows, "sig bigint, node bigint, size bigint, indexed boolean, hub bigint, "
                                          "hub_size bigint, hub_indexed boolean, hot boolean")
    assert nj._groups(members.filter("sig <> 2")).count() == 0
    groups = nj._groups(members)
    assert sorted(map(tuple, groups.collect())) == [(10, 10, 100, True), (10, 11, 110, False)]
    assert groups._jdf.queryExecution().optimizedPlan().toString().count("Join Inner") == 1


def test_bitmap_names_every_node(spark):
    nodes = [0, 1, 4095, 4096, 32767, 32768, nj.BITMAP - 1, nj.BITMAP, -1, -nj.BITMAP, 1 << 62]
    bitmap = nj._bitmap(spark.createDataFrame([(n,) for n in nodes], "node bigint"))
    assert all(nj._bit(bitmap, n) for n in nodes)
    assert not any(nj._bit(bitmap, n) for n in (2, 4094, 32766, -2))


def test_empty_table_and_long_text(spark, docs_of):
    assert nj.linked(docs_of([])).count() == 0
    long = " ".join(f"w{i * 7919 % 100_003}" for i in range(200_000))
    rows = [(1, long), (2, long + " end"), (3, "short text of six words here")]
    assert as_rows(nj.linked(docs_of(rows))) == brute(rows)
