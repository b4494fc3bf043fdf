import itertools
import math
import random

import duckdb
import numpy as np

from snapweave.llm import hard_negatives as hn
from snapweave.llm import queries

SCHEMA = "vec_id bigint, embedding array<float>, label int, score int, block string"


def brute(rows):
    kept = []
    for n, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in v]
        kept.append((n, i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, q))
    out = []
    late = lambda i: (i is None, i or 0)
    for n, i, label, q in kept:
        if i is None or i % 100:
            continue
        scores = sorted(((-sum(x * y for x, y in zip(q, r)), late(j), j, k, m) for k, j, m, r in kept if k != n),
                        key=lambda r: r[:2])
        for s, _, j, _, _ in [r for r in scores if r[4] == label][:5]:
            window = [(t, o) for t, _, o, _, m in scores if m != label and 30 * -s <= 100 * -t <= 90 * -s][:10]
            out += [(i, j, k + 1, o, -s, -t) for k, (t, o) in enumerate(window)]
    return sorted(map(str, out))


def mined(spark, rows, parts=4):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(parts)
    label = queries.F.when(queries.F.col("vec_id") % 7 == 0, (queries.F.col("label") + 1) % 10).otherwise(queries.F.col("label"))
    return sorted(str(tuple(r)) for r in hn.mined(frame, label=label).collect())


def vectors(rng, n, dims=8, groups=6):
    centres = rng.normal(0, 1, (groups, dims))
    return [(i, [float(np.float32(x)) for x in centres[i % groups] + rng.normal(0, .3, dims)], int(rng.integers(0, 4)))
            for i in range(n)]


def test_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = [k.tobytes() for k in hn.hilbert_keys(cells, bits)]
        assert len(set(keys)) == len(keys)
        walk = cells[sorted(range(len(keys)), key=keys.__getitem__)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_bounds_hold_and_are_reached():
    rng = np.random.default_rng(0)
    a, rows = rng.integers(-99, 99, (20, 6)), rng.integers(-99, 99, (50, 6))
    least, most = hn.score_bounds(a, rows.min(0)[None], rows.max(0)[None])
    s = hn.products(a, rows)
    assert (s >= least).all() and (s <= most).all()
    one = hn.score_bounds(a, rows[:1], rows[:1])
    assert (one[0] == s[:, :1]).all() and (one[1] == s[:, :1]).all()
    huge = np.array([[1 << 40, -(1 << 40)]])
    assert hn.products(huge, huge).tolist() == [[hn.LARGEST]] and hn.products(huge, np.array([[1, 1]])).tolist() == [[0]]


def test_result_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK_ROWS", 32)
    rows = vectors(np.random.default_rng(3), 900)
    nan = float("nan")
    rows += [(1000, None, 1), (1100, [1.0] * 8, None), (1200, [1.0, None] * 4, 2), (1300, [nan] * 8, 2),
             (1301, [float("inf")] * 8, 2), (None, [.5] * 8, 1), (None, [.5] * 8, 3), (1400, [], 1), (1500, [.5, .5], 2)]
    rows += [(2000 + i, rows[5][1], i % 4) for i in range(300)]  # one vector, many ids
    rows += [(100, rows[100][1], rows[100][2])] * 2  # repeated anchors
    random.Random(1).shuffle(rows)
    assert mined(spark, rows) == brute(rows)


def test_zone_maps_leave_blocks_unread(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in np.eye(6)[i % 6] * 3 + rng.normal(0, .05, 6)], i % 6) for i in range(1200)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    held, dims = hn.prepared(frame, "vec_id", "embedding", "label", 256)
    blocks = hn.blocked(held, dims)
    anchors = hn._anchors(blocks, dims, 100, 5)
    pairs = hn._chosen(anchors.withColumn("chunk", queries.F.col("id")), blocks, dims, True).count()
    assert pairs < 0.5 * anchors.count() * blocks.count()


def test_sql_says_the_same(spark):
    rows = vectors(np.random.default_rng(7), 700, 16)
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INT)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", rows)
    assert mined(spark, rows) == sorted(str(r) for r in con.execute(queries.ORACLE["op11_hard_negatives"]).fetchall())


def test_empty_and_tiny_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []
    assert mined(spark, [(100, [1.0], 1), (1, [1.0], 1), (2, [.5], 2)]) == brute([(100, [1.0], 1), (1, [1.0], 1), (2, [.5], 2)])


def test_planning_takes_each_chunk_and_each_zone_map_once(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK_ROWS", 16)
    monkeypatch.setattr(hn, "ZONES", 8)
    frame = spark.createDataFrame([(*r, 1, "x") for r in vectors(np.random.default_rng(9), 600)], SCHEMA)
    held, dims = hn.prepared(frame, "vec_id", "embedding", "label", 256)
    blocks = hn.blocked(held, dims)
    anchors = hn._anchors(blocks, dims, 100, 5)
    chosen = hn._chosen(anchors, blocks, dims, True)
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    # no row holds a whole chunk or zone, to be repeated for every other; they meet as groups of rows
    assert "collect_list" not in plan and "FlatMapCoGroupsInArrow" in plan
    # small zones choose the blocks that one zone of all maps chooses
    monkeypatch.setattr(hn, "ZONES", 1 << 20)
    assert sorted(map(tuple, chosen.collect())) == sorted(map(tuple, hn._chosen(anchors, blocks, dims, True).collect()))
