"""Registered queries: name -> function(spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (or data Spark derives from them) in
full; the matching DuckDB SQL lives in ``snapweave.oracle``.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapweave.contracts import ALL_PRS, OPEN_PO, find_contract
from snapweave.functions import (composite_key, iso_week, iso_year, key_complete, normalize_key,
                                 report_monday, to_numeric, week_from_logical_date, weeks_from_spec)
from snapweave.operators import quality as dq
from snapweave.operators.compact import compact_rows
from snapweave.operators.header import body_rows, detect_headers, filled_cells
from snapweave.operators.upsert import KEY_COLS, count_rows, read_stored, row_count_changes, upsert
from snapweave.operators.resolve import extract
from snapweave.plans import cards, models
from snapweave.plans.jobs import BranchFailures, quarantined, run_datasets, run_weeks
from snapweave.plans.runlog import read_log
from snapweave.plans.snapshot import transform
from snapweave.session import shared_dir
from snapweave.sources.grid import read_extracts
from snapweave.sources.landing import list_landed
from snapweave.sources.seeds import load_rates
from snapweave.streaming.ingest import ingest_available
from weekfixtures.files import land_grid, land_workbooks
from weekfixtures.grids import grid_from_extract
from weekfixtures.tables import all_prs_extract, open_po_extract, read_table

Query = Callable[[SparkSession, str], DataFrame]


def snapshot_open_po(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform(open_po_extract(spark, sf_dir), OPEN_PO, load_rates(spark))


def snapshot_all_prs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform(all_prs_extract(spark, sf_dir), ALL_PRS, load_rates(spark))


def stg_open_po(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.stg_open_po(snapshot_open_po(spark, sf_dir))


def stg_all_prs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.stg_all_prs(snapshot_all_prs(spark, sf_dir))


def mart_open_po_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.mart_open_po_weekly(stg_open_po(spark, sf_dir))


def mart_top_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.mart_top_suppliers(stg_open_po(spark, sf_dir))


def mart_top_suppliers_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.ranked_suppliers(mart_top_suppliers(spark, sf_dir))


def _card(name: str) -> Query:
    mart = {"weekly": models.mart_open_po_weekly, "suppliers": models.mart_top_suppliers}[cards.CARDS[name][0]]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The card, read from its stored mart."""
        stored = models.materialize(mart(stg_open_po(spark, sf_dir)), shared_dir(spark, "marts", unique=True) + "/mart")
        return cards.run_card(spark, name, stored, stored)
    run.__name__ = f"card_{name}"
    return run


def open_po_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_from_extract(open_po_extract(spark, sf_dir), OPEN_PO)


def _file_info(grid: DataFrame) -> DataFrame:
    return grid.select("dataset", "report_year", "report_week", "file").distinct()


def grid_header_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = open_po_grid(spark, sf_dir)
    heads = detect_headers(grid, OPEN_PO.header_texts)
    return _file_info(grid).join(heads.select("file", "header_idx", "header_hits"), "file")


def grid_junk_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = open_po_grid(spark, sf_dir)
    body = body_rows(grid, OPEN_PO.header_texts)
    kept = filled_cells(F.col("cells")) >= 2
    return body.groupBy("dataset", "report_year", "report_week", "file").agg(
        F.count_if(kept).alias("body_rows"), F.count_if(~kept).alias("junk_rows"))


def grid_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(open_po_grid(spark, sf_dir), OPEN_PO).drop("_absent", "_order")


def grid_snapshot_all_prs(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = grid_from_extract(all_prs_extract(spark, sf_dir), ALL_PRS)
    return transform(extract(grid, ALL_PRS), ALL_PRS, load_rates(spark)).drop("_absent")


def grid_snapshot_open_po(spark: SparkSession, sf_dir: str) -> DataFrame:
    snap = transform(extract(open_po_grid(spark, sf_dir), OPEN_PO), OPEN_PO, load_rates(spark))
    return snap.drop("_absent")


# --- cleaning functions over the whole extract ---------------------------

def to_numeric_messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = open_po_extract(spark, sf_dir)
    return e.select(F.col("order_quantity").alias("raw_quantity"), to_numeric("order_quantity").alias("order_quantity"),
                    F.col("net_price").alias("raw_price"), to_numeric("net_price").alias("net_price"))


def normalize_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = open_po_extract(spark, sf_dir)
    return e.select(F.col("po_number").alias("raw_po_number"), F.col("po_item").alias("raw_po_item"),
                    normalize_key("po_number").alias("po_number_key"), normalize_key("po_item").alias("po_item_key"))


def zero_pad_material(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = open_po_extract(spark, sf_dir)
    return e.select(F.col("material").alias("raw_material"), normalize_key("material", 8).alias("material"))


def composite_key_incomplete_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = open_po_extract(spark, sf_dir)
    parts = [normalize_key(k) for k in OPEN_PO.key]
    return e.filter(key_complete(parts)).select("report_year", "report_week", composite_key(parts).alias("key"))


def iso_week_monday(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("order_date")).distinct()
    return d.select("order_date", iso_year("order_date").alias("iso_year"), iso_week("order_date").alias("iso_week"),
                    report_monday(iso_week("order_date"), iso_year("order_date")).alias("monday"))


def week_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    span = o.groupBy(iso_year("o_orderdate").alias("report_year")).agg(
        F.min(iso_week("o_orderdate")).alias("lo"), F.max(iso_week("o_orderdate")).alias("hi"))
    spec = F.concat_ws("-", F.col("lo").cast("string"), F.col("hi").cast("string"))
    return span.select("report_year", F.explode(weeks_from_spec(spec)).alias("report_week"))


# --- compaction ---------------------------------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber"]


def compact_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_rows(read_table(spark, sf_dir, "lineitem", spread=True), LINE_KEY, ["l_shipdate"], keep="last")


def compact_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_rows(read_table(spark, sf_dir, "lineitem", spread=True), LINE_KEY, ["l_shipdate"], keep="first")


def compact_null_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = open_po_extract(spark, sf_dir).drop("_order", "_block")
    return compact_rows(e, ["po_number"], ["po_item"], keep="last")


# --- data quality -------------------------------------------------------------

def _keyed_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = open_po_extract(spark, sf_dir)
    parts = [normalize_key(k) for k in OPEN_PO.key]
    return e.filter(key_complete(parts)).select("report_year", "report_week", composite_key(parts).alias("key"))


def dq_unique_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = dq.unique_keys_report(_keyed_extract(spark, sf_dir), KEY_COLS).select(F.lit("extract").alias("stage"), "*")
    after = dq.unique_keys_report(snapshot_open_po(spark, sf_dir), KEY_COLS).select(F.lit("snapshot").alias("stage"), "*")
    return before.unionByName(after)


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    snap = snapshot_open_po(spark, sf_dir)
    return dq.not_null_report(snap, snap.columns)


def dq_row_count_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.row_count_delta_report(snapshot_open_po(spark, sf_dir))


def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.freshness_report(snapshot_open_po(spark, sf_dir))


def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.relationships_report(stg_open_po(spark, sf_dir), load_rates(spark))


def dq_model_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules of all four models, one pass a model."""
    po, prs = _kept(stg_open_po(spark, sf_dir)), stg_all_prs(spark, sf_dir)
    week = ["report_year", "report_week"]
    rules = {
        "stg_open_po": (po, ["row_id"], ["row_id", *week, "key"], True),
        "stg_all_prs": (prs, ["row_id"], ["row_id", *week, "key"], True),
        "mart_open_po_weekly": (models.mart_open_po_weekly(po), week, week, True),
        "mart_top_suppliers": (models.mart_top_suppliers(po), [*week, "supplier"], [*week, "supplier"], False),
    }
    reports = [dq.table_report(df, unique, not_null, dated, nulls_equal=False).select(F.lit(name).alias("model"), "*")
               for name, (df, unique, not_null, dated) in rules.items()]
    return reduce(DataFrame.unionByName, reports)


# --- upserts through the sink ----------------------------------------------------

def _upserted(spark: SparkSession, *loads: DataFrame) -> DataFrame:
    """The stored table after loading the snapshots one after the other."""
    table = shared_dir(spark, "tables", unique=True) + "/open_po"
    for snap in loads:
        upsert(spark, snap, table, shared_dir(spark, "staging", "open_po", unique=True))
    return read_stored(spark, table)


def _kept(df: DataFrame) -> DataFrame:
    """A frame that several steps read, worked out once and stored."""
    return models.materialize(df, shared_dir(df.sparkSession, "inputs", unique=True) + "/rows")


def _upsert_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All weeks (last row per key), then a second load: weeks from 20 on, built from
    the older rows (first per key), lines with a known rate."""
    ext = _kept(open_po_extract(spark, sf_dir))
    rates = load_rates(spark)
    incoming = transform(ext, OPEN_PO, rates, keep="first").filter(
        (F.col("report_week") >= 20) & F.col("rate_to_eur").isNotNull())
    return transform(ext, OPEN_PO, rates), incoming


def upsert_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, incoming = _upsert_inputs(spark, sf_dir)
    again = _kept(incoming)
    return _upserted(spark, stored, again, again)


def upsert_partial_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, incoming = _upsert_inputs(spark, sf_dir)
    return _upserted(spark, stored, incoming.select("report_year", "report_week", "key", "net_price"))


def upsert_rates_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All weeks without rates, then weeks from 20 on with them: the columns are added."""
    ext = _kept(open_po_extract(spark, sf_dir))
    later = transform(ext, OPEN_PO, load_rates(spark)).filter(F.col("report_week") >= 20)
    return _upserted(spark, transform(ext, OPEN_PO), later)


# --- landing, backfill, stream -------------------------------------------------

def _landed_open_po(spark: SparkSession, sf_dir: str) -> str:
    """Write the open_po extract files for ``sf_dir``."""
    root = shared_dir(spark, "landing", unique=True)
    return land_grid(open_po_grid(spark, sf_dir), root, width=len(OPEN_PO.fields))


def landed_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files in path order: their place in the listing, key and whether they hold bytes."""
    root = _landed_open_po(spark, sf_dir)
    files = list_landed(spark, root).select("path", "length")
    key = F.regexp_extract("path", "/(dataset=[^/]+/year=[^/]+/week=[^/]+/extract=[^/]+)/[^/]+$", 1)
    # one row a file, not a row of data
    return files.select(F.row_number().over(Window.orderBy("path")).alias("place"), key.alias("key"),
                        (F.col("length") > 0).alias("filled"))


def _backfilled(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Land the extracts, replay weeks 1-53 of every year from the files in one job -> table, run log."""
    root = _landed_open_po(spark, sf_dir)
    table = shared_dir(spark, "tables", unique=True) + "/open_po"
    log = shared_dir(spark, "runlog", unique=True)
    run_weeks(spark, f"{root}/dataset=open_po", "open_po", table, "1-53", load_rates(spark), log_path=log)
    return table, log


def backfill_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_stored(spark, _backfilled(spark, sf_dir)[0])


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows a backfill left out for an incomplete key, as they were extracted."""
    table, _ = _backfilled(spark, sf_dir)
    return quarantined(spark, table).select("report_year", "report_week", *OPEN_PO.names)


def run_log_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages a backfill logged, with the rows each took and gave."""
    _, log = _backfilled(spark, sf_dir)
    return read_log(spark, log).select("module", "stage", "rows_in", "rows_out", "status")


def stream_ingest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the extracts, ingest them with a file stream (available-now), read the table."""
    root = _landed_open_po(spark, sf_dir)
    base = shared_dir(spark, "stream", unique=True)
    ingest_available(spark, root, "open_po", f"{base}/open_po", f"{base}/_checkpoint", load_rates(spark))
    return read_stored(spark, f"{base}/open_po")


def xlsx_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the extracts as workbooks with real date cells, read them back and build the snapshot."""
    root = shared_dir(spark, "landing", unique=True)
    dates = tuple(i for i, name in enumerate(OPEN_PO.names) if name == "delivery_date")
    land_workbooks(open_po_grid(spark, sf_dir), root, dates)
    grid = read_extracts(spark, f"{root}/dataset=open_po", contract=OPEN_PO)
    return transform(extract(grid, OPEN_PO), OPEN_PO, load_rates(spark)).drop("_absent")


def snapshot_rates_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot with the rates read from a CSV file."""
    path = shared_dir(spark, "seeds", unique=True) + "/rates"
    load_rates(spark).coalesce(1).write.option("header", True).csv(path)
    return transform(open_po_extract(spark, sf_dir), OPEN_PO, load_rates(spark, path))


def snapshot_contract_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot of a dataset by a contract read from a YAML file."""
    from snapweave.files import SharedFiles

    folder = shared_dir(spark, "contracts", unique=True)
    fields = {f.name: {"header": f.headers[0], "aliases": list(f.headers[1:]), "required": f.required, "numeric": f.numeric,
                       "pad": f.width} for f in ALL_PRS.fields}
    SharedFiles(spark).put(f"{folder}/all_prs.yml", json.dumps({"name": "all_prs", "key": list(ALL_PRS.key), "columns": fields}))
    contract = find_contract(spark, "all_prs", folder)
    return transform(all_prs_extract(spark, sf_dir), contract, load_rates(spark))


def stored_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the stored table after two loads, as the sink counts them, by year."""
    stored, incoming = _upsert_inputs(spark, sf_dir)
    table = shared_dir(spark, "tables", unique=True) + "/open_po"
    for snap in (stored, incoming):
        upsert(spark, snap, table, shared_dir(spark, "staging", "open_po", unique=True))
    total = count_rows(spark, table)
    return read_stored(spark, table).groupBy("report_year").agg(F.count("*").alias("rows")).withColumn(
        "table_rows", F.lit(total).cast("bigint"))


def reload_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks of a second, smaller load: rows staged now and by the load before, and whether that is allowed."""
    stored, incoming = _upsert_inputs(spark, sf_dir)
    table = shared_dir(spark, "tables", unique=True) + "/open_po"
    for snap in (stored, incoming):
        upsert(spark, snap, table, shared_dir(spark, "staging", "open_po", unique=True))
    return row_count_changes(spark, table)


def mart_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly mart kept up to date over two loads: built whole, then refreshed for the weeks of the second."""
    table = shared_dir(spark, "tables", unique=True) + "/open_po"
    mart = shared_dir(spark, "marts", unique=True) + "/weekly"
    for snap in _upsert_inputs(spark, sf_dir):
        upsert(spark, snap, table, shared_dir(spark, "staging", "open_po", unique=True))
        models.refresh_mart(spark, table, "mart_open_po_weekly", mart)
    return read_stored(spark, mart)


def logical_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO week (and its year) of every logical date."""
    d = read_table(spark, sf_dir, "orders").select("o_orderdate").distinct()
    return d.select(F.col("o_orderdate").alias("logical_date"), week_from_logical_date("o_orderdate").alias("report_week"),
                    iso_year("o_orderdate").alias("report_year"))


def dq_report_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.date_counts(snapshot_open_po(spark, sf_dir), "report_date")


def card_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every card's rows, counted by card, after the check that they read mart columns only."""
    stg = _kept(stg_open_po(spark, sf_dir))
    base = shared_dir(spark, "marts", unique=True)
    weekly = models.materialize(models.mart_open_po_weekly(stg), f"{base}/weekly")
    suppliers = models.materialize(models.mart_top_suppliers(stg), f"{base}/suppliers")
    found = cards.check_card_contract(spark, weekly, suppliers)
    counts = [cards.run_card(spark, name, weekly, suppliers).agg(F.count("*").alias("rows")).select(
        F.lit(name).alias("card"), F.lit(", ".join(columns)).alias("columns"), "rows") for name, columns in found.items()]
    return reduce(DataFrame.unionByName, counts)


def branches_side_by_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both datasets as branches: open_po loads, all_prs is handed files of the other layout and fails alone."""
    root = _landed_open_po(spark, sf_dir)
    base = shared_dir(spark, "tables", unique=True)
    tables = {ds: f"{base}/{ds}" for ds in ("open_po", "all_prs")}
    try:
        results = run_datasets(spark, dict.fromkeys(tables, f"{root}/dataset=open_po"), tables, load_rates(spark))
    except BranchFailures as e:
        results = e.results
    outcome = spark.createDataFrame([(r.dataset, r.rows, r.error is not None) for r in results],
                                    "dataset string, loaded bigint, failed boolean")
    rows = read_stored(spark, tables["open_po"]).agg(F.count("*").alias("stored")).withColumn("dataset", F.lit("open_po"))
    return outcome.join(rows, "dataset", "left")


QUERIES: dict[str, Query] = {
    "snapshot_open_po": snapshot_open_po,
    "snapshot_all_prs": snapshot_all_prs,
    "stg_open_po": stg_open_po,
    "stg_all_prs": stg_all_prs,
    "mart_open_po_weekly": mart_open_po_weekly,
    "mart_top_suppliers": mart_top_suppliers,
    "mart_top_suppliers_ranked": mart_top_suppliers_ranked,
    "card_weekly_open_value": _card("weekly_open_value"),
    "card_weekly_line_count": _card("weekly_line_count"),
    "card_kpi_latest": _card("kpi_latest_week"),
    "card_top_suppliers": _card("top_suppliers_latest"),
    "grid_header_detect": grid_header_detect,
    "grid_junk_filter": grid_junk_filter,
    "grid_resolve": grid_resolve,
    "grid_snapshot_open_po": grid_snapshot_open_po,
    "grid_snapshot_all_prs": grid_snapshot_all_prs,
    "to_numeric_messy": to_numeric_messy,
    "normalize_keys": normalize_keys,
    "zero_pad_material": zero_pad_material,
    "composite_key_incomplete_drop": composite_key_incomplete_drop,
    "iso_week_monday": iso_week_monday,
    "week_sequence": week_sequence,
    "compact_last": compact_last,
    "compact_first": compact_first,
    "compact_null_sort": compact_null_sort,
    "dq_unique_keys": dq_unique_keys,
    "dq_not_null": dq_not_null,
    "dq_row_count_delta": dq_row_count_delta,
    "dq_freshness": dq_freshness,
    "dq_relationships": dq_relationships,
    "dq_model_tests": dq_model_tests,
    "upsert_twice": upsert_twice,
    "upsert_partial_columns": upsert_partial_columns,
    "upsert_rates_later": upsert_rates_later,
    "landed_listing": landed_listing,
    "backfill_weeks": backfill_weeks,
    "quarantine_rows": quarantine_rows,
    "run_log_status": run_log_status,
    "stream_ingest_snapshot": stream_ingest_snapshot,
    "xlsx_snapshot": xlsx_snapshot,
    "snapshot_rates_csv": snapshot_rates_csv,
    "snapshot_contract_file": snapshot_contract_file,
    "stored_row_count": stored_row_count,
    "reload_row_counts": reload_row_counts,
    "mart_refresh": mart_refresh,
    "logical_week": logical_week,
    "dq_report_dates": dq_report_dates,
    "card_columns": card_columns,
    "branches_side_by_side": branches_side_by_side,
}
