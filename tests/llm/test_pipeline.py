import corpus_pipeline as cp
from snapweave.llm import decontaminate, queries, simhash
from snapweave.llm.common import stored, table

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = table(spark, SF, "documents")
    columns, kept = docs.columns, []
    for name, stage in cp.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
        docs = stored(stage(spark, docs, SF), name)
        assert docs.columns == columns
        after = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert after <= set(before)
        kept.append((name, before, after))
    _, before, after = kept[2]  # one document of each component: the smallest id
    frame = spark.createDataFrame(list(before.items()), "doc_id bigint, text string")
    assert {r["component_id"] for r in simhash.near_duplicates(frame).collect()} == after
    _, before, after = kept[3]
    frame = spark.createDataFrame(list(before.items()), "doc_id bigint, text string")
    leaks = {r["doc_id"] for r in decontaminate.overlaps(frame, table(spark, SF, "benchmark")).collect()}
    assert after == set(before) - leaks
    pieces = cp.run(spark, SF)
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == after


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls everywhere, repeats, extra columns with clashing names, and no row at all."""
    src = table(spark, SF, "documents").limit(40).withColumn("score", cp.F.lit(1)).withColumn("row_hash", cp.F.lit("x"))
    odd = spark.createDataFrame([(None,) * 7, (1, None, None, None, None, None, None), (2, "", "en", "s", 0, 1, "y"),
                                 (3, "word " * 20_000, "en", None, 1, 1, "y"), (3, "word " * 20_000, "en", None, 1, 1, "y")],
                                "doc_id bigint, text string, lang string, source string, n_chars bigint, score int, row_hash string")
    for docs in (src.select(odd.columns).unionByName(odd), odd.limit(0)):
        for _, stage in cp.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            assert out.count() <= docs.count()
        assert cp.STAGES[-1][1](spark, docs, SF).selectExpr("count(distinct sequence_id)").first()[0] >= (docs.count() > 0)


def test_oracle_of_op10(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    want = con.execute(queries.ORACLE["op10_warc"]).df().sort_values("page_id").reset_index(drop=True)
    got = queries.op10_warc(spark, SF).toPandas().sort_values("page_id").reset_index(drop=True)
    assert list(got.columns) == list(want.columns)
    assert (got.astype(object).where(got.notna(), None).values == want.astype(object).where(want.notna(), None).values).all()


def test_whole_texts_go_to_python_in_small_batches(spark):
    from snapweave.llm import common

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "10000")
        cp.drop_near_duplicates(spark, spark.createDataFrame([(1, "a b c d")], "doc_id bigint, text string"), SF)
        assert int(spark.conf.get(name)) == common.BATCH_ROWS
        spark.conf.set(name, "50")
        common.small_batches(spark)
        assert spark.conf.get(name) == "50"
    finally:
        spark.conf.set(name, before)
