import numpy as np
from pyspark.sql import functions as F

from snapweave.llm import langid, queries


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    net = langid.ByteConvNet(["a", "b", "c"], rng)
    for p in net.weights():
        p += 0  # same arrays
    codes = langid.windows_of(bytes(rng.integers(32, 120, 4 * langid.WINDOW, dtype=np.uint8)))
    y = np.array([0, 1, 2, 1])

    def loss():
        return -np.log(net.probabilities(codes)[np.arange(4), y].astype(np.float64)).mean()
    for p, g in zip(net.weights(), net.gradients(codes, y)):
        flat, grad = p.reshape(-1), g.reshape(-1)
        for k in np.argsort(-np.abs(grad))[:3]:
            keep = flat[k]
            flat[k] = keep + 1e-3
            up = loss()
            flat[k] = keep - 1e-3
            down = loss()
            flat[k] = keep
            assert abs((up - down) / 2e-3 - grad[k]) < 0.05 * max(0.05, abs(grad[k]))


def test_whole_texts_and_defined_results(spark, docs_of):
    words = {"xx": "alpha beta gamma delta", "yy": "òmicron ñandu çedilla über"}
    data = [((words[x] + " ") * 8).encode()[k:k + 200].decode(errors="ignore") for x in words for k in range(20)]
    net = langid.train([d.encode() for d in data], ["xx"] * 20 + ["yy"] * 20, epochs=8)
    long = words["xx"] * 5 + " " + (words["yy"] + " ") * 3000
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, long), (5, words["xx"] * 9), (6, "漢字"), (5, words["xx"] * 9)]
    docs = docs_of(rows)
    got = sorted((r["doc_id"], r["p"]["lang"], r["p"]["score"]) for r in
                 docs.select("doc_id", langid.predicted("text", net).alias("p")).collect())
    assert [g[:2] for g in got[:5]] == [(1, "und"), (2, "und"), (3, "und"), (4, "yy"), (5, "xx")]
    assert all(0 <= g[2] <= 1 for g in got) and got[4] == got[5]
    # the applied network equals the mean over all windows done one by one
    codes = langid.windows_of(long.encode())
    p = sum(net.probabilities(codes[i:i + 1])[0] * min(langid.WINDOW, len(long.encode()) - i * langid.WINDOW)
            for i in range(len(codes))) / len(long.encode())
    assert abs(p.max() - got[3][2]) < 1e-5


def test_no_labels_and_empty(spark, docs_of):
    docs = docs_of([(1, "text")]).withColumn("lang", F.lit(None).cast("string"))
    assert langid.fit(docs, F.lit(True)) is None
    assert docs.select(langid.predicted("text", None).alias("p")).first()["p"]["lang"] == "und"
    assert langid.fit(docs.limit(0), F.lit(True)) is None


def test_query_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    r = queries.op8_language(spark, sf).join(docs, "doc_id").filter("held_out")
    n, right = r.select(F.count("*"), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert right / n > 0.97
