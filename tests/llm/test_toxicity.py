import numpy as np
from pyspark.sql import functions as F

from snapweave.llm import queries, toxicity as tx
from snapweave.llm.common import fold


def model_of(spark):
    docs = spark.createDataFrame([("the idiot and the moron are stupid losers in the trash",)] * 3, "text string")
    return tx.language_model(tx.char_counts(docs))


def test_counts_cover_all_documents(spark):
    texts = ["ab ab", None, "", "Äb!", "1 2"]
    got = tx.char_counts(spark.createDataFrame([(t,) for t in texts], "text string"))
    want = np.zeros((27, 27, 27))
    for t in texts:
        codes = [0]
        for c in tx.fold(t) + " ":
            k = ord(c) - 96 if "a" <= c <= "z" else 0
            if k or codes[-1]:
                codes.append(k)
        for a, b, c in zip(codes, codes[1:], codes[2:]):
            want[a, b, c] += 1
    assert (got == want).all()


def test_decoder_restores_obfuscated_words(spark):
    model = model_of(spark)
    for written in ("1d10t", "id1ot", "i d i o t", "i.d.i.o.t", "idiooot", "IDI0T", "i-d-i-o-t"):
        assert "idiot" in tx.restore(f"the {written} and", model), written
    assert tx.restore("stup1d l o s e r s", model) == "stupid losers"
    assert tx.restore("plain words stay, as they are.", model) == "plain words stay, as they are."
    assert tx.restore(None, model) == "" == tx.restore("", model)


def test_edges_and_look_alike_letters(spark):
    model = model_of(spark)
    for form in ("(%s)", "@%s", "&%s", "<%s>", "1%s", "%s2", "[%s]", '"%s"', "(%s", "$%s$"):
        for word in ("idiot", "moron", "losers"):
            assert word in tx.token_words(form % word, model), form
    assert tx.restore("the (idiot) and <moron>", model) == "the (idiot) and <moron>"
    assert "idiot" in tx.restore("1 d 1 o t", model) and "idiot" in tx.restore("an i\nd\ni\no\nt", model)
    assert tx.fold("idi\u043et \u0456diot m\u03bfron") == "idiot idiot moron"
    assert tx.fold("\u0441\u043b\u043e\u0432\u043e Stra\u00dfe") == " strasse"  # a word wholly in another script is no Latin one
    assert tx.restore("(plain) @words 5th a1 <b>, 3 & 4", model) is not None


def test_viterbi_is_the_best_path(spark):
    model = model_of(spark)

    def best(span):
        paths = [("", 0.0)]
        for choices in tx.lattice(span):
            paths = [(s + c, v - cost) for s, v in paths for c, cost in choices]
        def value(sent):
            codes, total = [0, 0], 0.0
            for c in sent:
                k = 0 if c == " " else ord(c) - 96
                if k == 0 and codes[-1] == 0:
                    continue
                total += model[codes[-2], codes[-1], k]
                codes.append(k)
            return total + (model[codes[-2], codes[-1], 0] if codes[-1] else 0.0)
        return max(v + value(s) for s, v in paths), value, paths
    for span in ("1d1ot", "m0r-on", "ttr4sh", "l.o.s3r"):
        top, value, paths = best(span)
        got = tx.decode(span, model)
        assert max(v + value(s) for s, v in paths if s.strip() == got.strip()) > top - 1e-9


def test_long_tokens_take_linear_time(spark):
    model = model_of(spark)
    for text in ("!" * 200_000, "a" * 50_000, "1" * 100_000, "a." * 20_000, "x1" * 10_000):
        tx.restore(text, model)


def test_scores_on_planted_rows(spark):
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = f"the garden of number{i} and the weather is fine today, {'you ' + ['idiot', 'moron'][i // 4 % 2] if bad else 'friend'} said x{i % 37}"
        rows.append((i, text))
        labels.append((i, int(bad)))
    rows += [(910 + k, f"the garden ({w}) said, or <b>{w}</b>, @{w} &{w} 1{w}") for k, w in enumerate(("idiot", "friend", "number"))]
    rows += [(900, None), (901, ""), (902, "12 34 !!"), (903, "the garden i d 1 o t said"), (904, "die Straße — 漢字")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    scorer = tx.fit(docs, spark.createDataFrame(labels + [(None, 1), (7, None)], "doc_id bigint, toxic int"), fold("doc_id", 5) != 0)
    got = {r["doc_id"]: r["s"] for r in docs.select("doc_id", tx.scored("text", scorer).alias("s")).collect()}
    assert all((got[i] >= 0.5) == (i % 4 == 0) for i in range(400))
    assert got[910] >= 0.5 > max(got[911], got[912])
    assert got[903] >= 0.5 and max(got[900], got[901], got[902], got[904]) < 0.5


def test_no_labels_and_empty_tables(spark, docs_of):
    docs = docs_of([(1, "a text"), (2, None)])
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    one = spark.createDataFrame([(1, 1)], "doc_id bigint, toxic int")
    for labels, low in ((none, True), (one, False)):
        s = docs.select(tx.scored("text", tx.fit(docs, labels, F.lit(True))).alias("s")).collect()
        assert all((r["s"] < 0.5) == low for r in s)
    assert docs.limit(0).select(tx.scored("text", tx.fit(docs.limit(0), none, F.lit(True)))).count() == 0


def test_query_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    r = queries.op1_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out")
    n, right = r.select(F.count("*"), F.sum((F.col("predicted") == F.col("toxic")).cast("int"))).first()
    assert right / n > 0.95
