import random
import time
import zlib

import numpy as np
from tokenizers import Tokenizer

from snapweave.llm import packing, queries


def check(rows, pieces, tokenizer, window, weights=None):
    want = {}
    for i, t, s in rows:
        want.setdefault((i, s), []).append(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])
    total = sum(len(x) for v in want.values() for x in v)
    assert sum(p["length"] for p in pieces) == total and all(p["length"] > 0 for p in pieces)
    by_seq = {}
    for p in pieces:
        by_seq.setdefault(p["sequence_id"], []).append(p)
        assert any(list(np.frombuffer(p["ids"], "<u4")) == x[p["start"]:p["start"] + p["length"]] and p["doc_tokens"] == len(x)
                   for x in want[p["doc_id"], p["source"]])
    assert sorted(by_seq) == list(range(len(by_seq)))
    for s in by_seq.values():
        at = 0
        for p in sorted(s, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at == window or at & (at - 1) == 0 and at < window
    return by_seq


def test_pieces_are_an_exact_round_trip(spark, docs_of):
    rng, path = random.Random(7), queries.tokenizer_path()
    tokenizer = Tokenizer.from_file(path)
    vocabulary = "the of Überraschung naïve can't 12,345 <|endoftext|> ß漢字 x\x1cy İstanbul ΣΑΣ a\u00a0b e\u0301".split(" ")
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60))) + rng.choice(["", "\n", "\t\u2003z"]),
             rng.choice(["hot"] * 6 + ["a", "b", "c", None])) for i in range(300)]
    rows += [(900, None, "a"), (901, "", None), (902, "word " * 5000, "b"), (None, "null id", "a"), (5, rows[5][1], rows[5][2])]
    docs = docs_of(rows).repartition(5)
    pieces = packing.pack(docs, path, window=256).collect()
    by_seq = check(rows, pieces, tokenizer, 256)
    # every full window has each source's share to within a token, rounding of the others aside
    sizes = {}
    for p in pieces:
        sizes[p["source"]] = sizes.get(p["source"], 0) + p["length"]
    total, sent = sum(sizes.values()), dict.fromkeys(sizes, 0)
    for w in range(total // 256):
        for p in by_seq[w]:
            sent[p["source"]] += p["length"]
        for s, n in sizes.items():
            assert abs(sent[s] - n / total * 256 * (w + 1)) <= 2


def test_target_weights_and_empty(spark, docs_of):
    path = queries.tokenizer_path()
    rows = [(i, "one two three four " * 30, "big" if i % 4 else "small") for i in range(80)]
    pieces = packing.pack(docs_of(rows), path, window=128, weights={"big": 1.0, "small": 1.0}).collect()
    by_seq = check(rows, pieces, Tokenizer.from_file(path), 128)
    first = [sum(p["length"] for p in by_seq[w] if p["source"] == "small") for w in range(10)]
    assert all(abs(x - 64) <= 1 for x in first)  # equal shares until the small source runs dry
    assert packing.pack(docs_of([]), path).count() == 0


def test_query_crc(spark):
    sf = "/root/testdata/sf0.001"
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    ids = {r["doc_id"]: tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2]
           for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    for r in queries.op9_packing(spark, sf).collect():
        part = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]


def test_a_rare_source_takes_bounded_memory(monkeypatch):
    # one document of two tokens in a source of its own beside 20,000 windows of a large corpus
    sizes, window = [1_000_000, 2, 280_003], 64
    mixture = packing.Mixture(sizes, [float(n) for n in sizes], window)
    queue = np.array([0, 1, 2, 0, 2, 0])
    start, n = np.array([5, 0, 0, 600_000, 280_000, 999_990]), np.array([300, 2, 200, 1, 3, 10])
    asked, whole = [], mixture.before
    monkeypatch.setattr(mixture, "before", lambda w: asked.append(len(w) * len(sizes)) or whole(w))
    pieces = {cells: monkeypatch.setattr(packing, "CELLS", cells, raising=False) or mixture.cut(queue, start, n)
              for cells in (10**9, 600)}
    assert pieces[600] == pieces[10**9] and len({p[3] for p in pieces[600] if p[0] == 1}) == 2
    assert [sum(p[2] for p in pieces[600] if p[0] == r) for r in range(len(n))] == n.tolist()
    assert max(asked[1:]) <= 600


def test_a_rare_document_costs_its_tokens_and_not_the_corpus():
    rng = np.random.default_rng(4)
    seconds, cut = [], []
    for windows in (300, 3_000, 1_000_000):
        sizes = [int(x) for x in rng.multinomial(windows * 4096, np.ones(20) / 20)] + [2000, 3]
        mixture = packing.Mixture(sizes, [float(s) for s in sizes], 4096)
        queue, start, n = np.array([20, 20, 21, 3]), np.array([0, 1500, 0, 500]), np.array([1500, 500, 3, 900])
        began = time.time()
        got = mixture.cut(queue, start, n)
        seconds.append(time.time() - began)
        if windows < 10_000:
            assert got == sorted(mixture._cut(queue, start, n, mixture.near(queue, start), mixture.near(queue, start + n)))
        for row, size in enumerate(n):
            own = [p for p in got if p[0] == row]
            assert [p[1] for p in own] == np.cumsum([0, *[p[2] for p in own]])[:-1].tolist() and sum(p[2] for p in own) == size
        cut.append(len(got))
    assert seconds[2] < 5 and cut[2] > 2000
