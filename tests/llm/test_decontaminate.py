import random
from itertools import combinations

from snapweave.llm import decontaminate as dc


def brute(docs, items):
    """(doc, item, alignment, start, words) of every window that agrees in 11 of 13 words, and of whole short items."""
    found = set()
    for d, t in docs:
        a = dc.WORD.findall((t or "").lower())
        for i, u in items:
            b = dc.WORD.findall((u or "").lower())
            n = min(13, len(b))
            allowed = 2 if n == 13 else 1 if n >= 8 else 0
            for x in range(len(a) - n + 1):
                for y in range(len(b) - n + 1 if b else 0):
                    if sum(p != q for p, q in zip(a[x:x + n], b[y:y + n])) <= allowed:
                        found.add((d, i, y - x, x, n))
    return found


def test_masks_find_every_placing_of_two_substitutions():
    for wrong in combinations(range(dc.WINDOW), dc.MAX_SUBSTITUTIONS):
        assert any(not any(s + o in wrong for o in m) for m in dc.MASKS for s in range(dc.WINDOW - m[-1])), wrong


def test_short_items_of_every_length(spark, docs_of):
    w = [f"w{i}" for i in range(12)]
    items = [(n, " ".join(f"{x}of{n}" for x in w[:n])) for n in range(1, 13)]
    rows, want = [], set()
    for n, t in items:
        for wrong in (0, 1, 2):
            parts = t.split()
            for k in range(min(n, wrong)):
                parts[-1 - 2 * k if n > 2 * k else 0] = "else"
            rows.append((100 * wrong + n, "before it " + " ".join(parts) + " after it"))
            if wrong <= (1 if n >= 8 else 0):
                want.add((100 * wrong + n, n))
    rows.append((900, " ".join(items[9][1].split()[:9])))  # one word short at the document's end
    got = dc.overlaps(docs_of(rows).coalesce(1), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    assert all((r["doc_start"], r["doc_end"], r["item_start"]) == (2, 2 + r["item_id"], 0) for r in got)
    asked = [(1, "what is the capital city of france today"), (2, "who wrote hamlet alone")]
    texts = [(1, "Tell me: what is the capital town of France today?"), (2, "asked who wrote Hamlet alone."), (3, "who wrote it")]
    found = dc.overlaps(docs_of(texts), spark.createDataFrame(asked, "item_id bigint, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(1, 1), (2, 2)}


def test_spans_match_brute_force(spark, docs_of, monkeypatch):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)] + ["the"] * 10
    items = [(i, " ".join(rng.choices(words, k=rng.randint(13, 40)))) for i in range(12)]
    items += [(30 + n, " ".join(rng.choices(words, k=n))) for n in range(1, 13)] * 2
    items += [(20, None), (21, ""), (22, items[3][1]), (None, "n1 n2 n3 n4 n5 n6")]
    rows = []
    for d in range(80):
        t = rng.choices(words + ["other", "Words"], k=rng.randint(0, 60))
        item = (rng.choice(items[:36])[1]).split()
        lo = rng.randrange(max(1, len(item) - 12))
        part = item[lo:lo + rng.randint(8, 40)]
        for _ in range(rng.randint(0, 3)):
            part[rng.randrange(len(part))] = rng.choice(words)
        at = rng.randint(0, len(t))
        rows.append((d, " ".join(t[:at] + part + t[at:])))
    rows += [(90, None), (91, ""), (92, "N1 n2, n3; n4 n5 n6!"), (5, rows[5][1])]
    got = dc.overlaps(docs_of(rows), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    windows = brute(rows, items)
    want = set()
    for d, i, diag, x, n in windows:
        want |= {(d, i, diag, p) for p in range(x, x + n)}
    have = {(r["doc_id"], r["item_id"], r["item_start"] - r["doc_start"], p)
            for r in got for p in range(r["doc_start"], r["doc_end"])}
    assert have == want and want
    assert sum(r["doc_id"] == 5 for r in got) % 2 == 0
    # the flag says the same, also with the benchmark in many blocks
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    docs = docs_of(rows)
    leaking = {d for d, *_ in windows}
    assert {r["doc_id"] for r in dc.without_leaks(docs, bench).collect()} == {d for d, _ in rows} - leaking
    monkeypatch.setattr(dc.blocks, "__defaults__", (*dc.blocks.__defaults__[:2], 200))
    assert {r["doc_id"] for r in dc.without_leaks(docs, bench).collect()} == {d for d, _ in rows} - leaking
    again = dc.overlaps(docs, bench).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    parts = list(dc.blocks(bench, block_chars=200))
    assert len(parts) > 3 and sum(len(ids) for ids, *_ in parts) == len([1 for _, t in items if t is not None])


def test_windows_stay_inside_their_document(spark, docs_of):
    w = [f"w{i}" for i in range(40)]
    clean = " ".join(f"c{i}" for i in range(20))
    # first, middle and last row start and end inside the item; 11 and 12 words are no overlap of 13
    rows = [(1, " ".join(w[2:30])), (2, clean), (3, " ".join(w[1:20])), (4, clean), (5, " ".join(w[3:14])),
            (6, " ".join(w[28:])), (7, " ".join(w[:12])), (8, ""), (9, "x " + " ".join(w[20:38]))]
    docs = docs_of(rows).coalesce(1)
    bench = spark.createDataFrame([(1, " ".join(w))], "item_id bigint, text string")
    got = {(r["doc_id"], r["doc_start"], r["doc_end"], r["item_start"]) for r in dc.overlaps(docs, bench).collect()}
    assert got == {(1, 0, 28, 2), (3, 0, 19, 1), (9, 0, 19, 19)}
    assert {r["doc_id"] for r in dc.without_leaks(docs, bench).collect()} == {2, 4, 5, 6, 7, 8}


def test_scripts_without_spaces(spark, docs_of):
    assert dc.WORD.findall("Über_1 x漢字かなカナ ไทย, don't") == ["Über_1", "x", *"漢字かなカナไทย", "don", "t"]
    zh, th = "数据清洗需要完整地检查每一个文档的内容是否重复", "กขคงจฉชซฌญฎฏฐฑฒณดตถท"
    assert len(set(zh)) > 20
    rows = [(1, "前面的话" + zh[3:20] + "后面还有别的话。"), (2, "前面" + zh[3:15] + "后面"), (3, "x " + th[2:8] + "ๆ" + th[9:17]),
            (4, zh[2:9] + "错" + zh[10:17])]
    bench = spark.createDataFrame([(1, zh), (2, th), (3, "完全不同的句子")], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"], r["doc_start"], r["doc_end"], r["item_start"], r["agreeing"])
           for r in dc.overlaps(docs_of(rows), bench).collect()}
    # the two substitutions may lie at the ends of a span
    assert got == {(1, 1, 2, 23, 1, 17), (2, 1, 0, 16, 1, 12), (3, 2, 0, 16, 1, 14), (4, 1, 0, 15, 2, 14)}


def test_empty_tables(spark, docs_of):
    docs, none = docs_of([(1, "a b c")]), spark.createDataFrame([], "item_id bigint, text string")
    assert dc.overlaps(docs, none).count() == 0
    assert dc.overlaps(docs.limit(0), none).count() == 0
    assert dc.without_leaks(docs, none).count() == 1
