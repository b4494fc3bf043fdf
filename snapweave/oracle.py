"""Reference SQL (DuckDB dialect) for every registered query.

Each statement recomputes a query from the raw tables with plain SQL, so the
Spark result can be checked row for row. Helpers below spell out the same
cleaning rules as ``snapweave.functions`` in SQL.
"""

from __future__ import annotations

from snapweave.contracts import ALL_PRS, OPEN_PO, Contract
from snapweave.sources.seeds import RATES
from weekfixtures.tables import BLOCK_ORDERS, CURRENCIES, ROW_ORDER


def zfill(x: str, w: int) -> str:
    return (f"(CASE WHEN {x} = '' THEN {x} WHEN length({x}) >= {w} THEN {x} "
            f"WHEN {x} LIKE '+%' OR {x} LIKE '-%' THEN left({x}, 1) || lpad(substr({x}, 2), {w - 1}, '0') "
            f"ELSE lpad({x}, {w}, '0') END)")


def pad(x: str, w: int) -> str:
    return f"lpad({x}, CAST(greatest(length({x}), {w}) AS INTEGER), '0')"


def norm_key(x: str, w: int | None = None) -> str:
    t = f"coalesce(regexp_replace(CAST({x} AS VARCHAR), '^\\s+|\\s+$', '', 'g'), '')"
    t = f"upper(regexp_replace({t}, '^([0-9]+)\\.0$', '\\1'))"
    return zfill(t, w) if w else t


def to_num(x: str) -> str:
    s = (f"regexp_replace(replace(regexp_replace({x}, '\\s+', '', 'g'), ',', '.'), "
         f"'([0-9])_([0-9])', '\\1\\2', 'g')")
    return (f"(CASE WHEN regexp_full_match({s}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') "
            f"THEN TRY_CAST({s} AS DOUBLE) "
            f"WHEN regexp_full_match(lower({s}), '[+-]?inf(inity)?') "
            f"THEN (CASE WHEN {s} LIKE '-%' THEN '-inf'::DOUBLE ELSE 'inf'::DOUBLE END) END)")


def monday(year: str, week: str) -> str:
    return f"(CAST(date_trunc('week', make_date({year}, 1, 4)) AS DATE) + CAST(({week} - 1) * 7 AS INTEGER))"


RATES_CTE = "rates AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{c}', CAST({r} AS DOUBLE))" for c, r in RATES) + ") t(currency, rate_to_eur))"

CURRENCY_LIST = "[" + ", ".join(f"'{c}'" for c in CURRENCIES) + "]"

ORDER_COLS = ", ".join(ROW_ORDER)
ORDER_DESC = ", ".join(f"{c} DESC" for c in ROW_ORDER)

LINES_CTE = f"""lines AS (
  SELECT {', '.join('l.' + c for c in ROW_ORDER)}, o.o_orderdate, p.p_name, s.s_name, s.s_nationkey, c.c_name,
         CAST(isoyear(o.o_orderdate) AS INTEGER) AS report_year,
         CAST(week(o.o_orderdate) AS INTEGER) AS report_week,
         CAST(floor(l.l_orderkey / {BLOCK_ORDERS}) AS BIGINT) AS _block
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"""


def _number(prefix: str) -> str:
    n = f"('{prefix}' || {pad('CAST(l_orderkey AS VARCHAR)', 7)})"
    return f"(CASE WHEN l_partkey % 5 = 0 THEN ' ' || {n} || '  ' ELSE {n} END)"


ITEM = ("(CASE WHEN (l_orderkey * 7 + l_linenumber) % 97 = 0 THEN NULL "
        "WHEN l_suppkey % 11 = 0 THEN CAST(l_linenumber * 10 AS VARCHAR) || '.0' "
        "ELSE CAST(l_linenumber * 10 AS VARCHAR) END)")
MATERIAL = f"(CASE WHEN l_partkey % 2 = 0 THEN {pad('CAST(l_partkey AS VARCHAR)', 8)} ELSE CAST(l_partkey AS VARCHAR) END)"
QTY_TXT = "CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR)"
QTY = f"(CASE WHEN l_partkey % 2 = 0 THEN replace({QTY_TXT}, '.', ',') ELSE {QTY_TXT} END)"
PRICE = ("(CASE WHEN l_suppkey % 2 = 0 THEN translate(format('{:,.2f}', l_extendedprice), ',.', ' ,') "
         "ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END)")
CURRENCY = (f"(CASE WHEN l_orderkey % 53 = 0 THEN NULL WHEN l_orderkey % 59 = 0 THEN 'CHF' "
            f"ELSE {CURRENCY_LIST}[l_suppkey % 4 + 1] END)")
PLANT = "('P' || CAST((s_nationkey % 3 + 1) * 100 AS VARCHAR))"
SHIP = "strftime(l_shipdate, '%Y-%m-%d')"

EXTRACT_SELECT = {
    "open_po": f"""SELECT {_number('45')} AS po_number, {ITEM} AS po_item, {MATERIAL} AS material,
    p_name AS material_description, s_name AS supplier, {QTY} AS order_quantity, {PRICE} AS net_price,
    {CURRENCY} AS currency, {SHIP} AS delivery_date, {PLANT} AS plant, c_name AS requisitioner,
    report_year, report_week, _block, {ORDER_COLS}
  FROM lines""",
    "all_prs": f"""SELECT {_number('10')} AS pr_number, {ITEM} AS pr_item, {MATERIAL} AS material,
    p_name AS material_description, {QTY} AS requested_quantity, c_name AS requisitioner,
    s_name AS responsible, {SHIP} AS release_date, {PLANT} AS plant,
    report_year, report_week, _block, {ORDER_COLS}
  FROM lines""",
}

CONTRACTS = {"open_po": OPEN_PO, "all_prs": ALL_PRS}


def extract_ctes(dataset: str) -> str:
    """``lines`` and ``<dataset>_ext`` CTE bodies (no leading WITH)."""
    return f"{LINES_CTE},\n{dataset}_ext AS ({EXTRACT_SELECT[dataset]})"


def snapshot_ctes(dataset: str, with_rates: bool = True, keep: str = "last", name: str | None = None,
                  with_extract: bool = True) -> str:
    """CTEs up to ``<dataset>_snap``: the cleaned, deduplicated, stamped snapshot."""
    c: Contract = CONTRACTS[dataset]
    typed_cols = []
    for spec in c.fields:
        if spec.numeric:
            typed_cols.append(f"{to_num(spec.name)} AS {spec.name}")
        elif spec.width:
            typed_cols.append(f"{norm_key(spec.name, spec.width)} AS {spec.name}")
        else:
            typed_cols.append(spec.name)
    parts = [norm_key(k) for k in c.key]
    key = " || '|' || ".join(parts)
    complete = " AND ".join(f"{p} <> ''" for p in parts)
    order = ORDER_DESC if keep == "last" else ORDER_COLS
    snap = name or f"{dataset}_snap"
    ctes = [extract_ctes(dataset)] if with_extract else []
    ctes += [f"""{snap}_typed AS (
  SELECT {', '.join(typed_cols)}, {key} AS key, report_year, report_week, {ORDER_COLS}
  FROM {dataset}_ext WHERE {complete})""", f"""{snap}_dedup AS (
  SELECT * FROM {snap}_typed
  QUALIFY row_number() OVER (PARTITION BY report_year, report_week, key ORDER BY {order}) = 1)"""]
    def base(a: str) -> str:
        cols = ", ".join(f"{a}{f}" for f in c.names)
        return (f"SELECT {cols}, {a}key, strftime({monday(a + 'report_year', a + 'report_week')}, '%Y-%m-%d') "
                f"AS report_date, {a}report_week, {a}report_year")
    if with_rates and dataset == "open_po":
        if with_extract:
            ctes.append(RATES_CTE)
        ctes.append(f"""{snap} AS (
  {base('d.')}, r.rate_to_eur, d.order_quantity * d.net_price * r.rate_to_eur AS line_value_eur
  FROM {snap}_dedup d LEFT JOIN rates r ON d.currency = r.currency)""")
    else:
        ctes.append(f"{snap} AS ({base('')} FROM {snap}_dedup)")
    return ",\n".join(ctes)


SNAP_FIELDS = {
    "open_po": ", ".join(OPEN_PO.names) + ", key, report_date, report_week, report_year, rate_to_eur, line_value_eur",
    "all_prs": ", ".join(ALL_PRS.names) + ", key, report_date, report_week, report_year",
}


def _snap_sql(dataset: str) -> str:
    return f"WITH {snapshot_ctes(dataset)}\nSELECT {SNAP_FIELDS[dataset]} FROM {dataset}_snap"


ROW_ID = "CAST(report_year AS VARCHAR) || '-' || CAST(report_week AS VARCHAR) || '-' || key"
STG = {
    "open_po": (f"{ROW_ID} AS row_id, report_year, report_week, key, po_number, po_item, material, "
                "material_description, supplier, order_quantity, net_price, currency, rate_to_eur, "
                "line_value_eur, CAST(report_date AS DATE) AS report_date"),
    "all_prs": (f"{ROW_ID} AS row_id, report_year, report_week, key, pr_number, pr_item, material, "
                "material_description, requested_quantity, requisitioner, responsible, "
                "CAST(report_date AS DATE) AS report_date"),
}


def stg_ctes(dataset: str) -> str:
    return f"{snapshot_ctes(dataset)},\nstg_{dataset} AS (SELECT {STG[dataset]} FROM {dataset}_snap)"


VALUE_EUR = ("sum(TRY_CAST(order_quantity AS DECIMAL(18,2)) * TRY_CAST(net_price AS DECIMAL(18,2)) "
             "* TRY_CAST(rate_to_eur AS DECIMAL(9,4)))")
MART_CTES = f"""{stg_ctes('open_po')},
mart_open_po_weekly AS (
  SELECT report_year, report_week, max(report_date) AS report_date, count(*) AS line_count,
         CAST(sum(TRY_CAST(order_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_quantity,
         CAST({VALUE_EUR} AS DOUBLE) AS total_value_eur
  FROM stg_open_po GROUP BY report_year, report_week),
mart_top_suppliers AS (
  SELECT report_year, report_week, supplier, count(*) AS line_count, CAST({VALUE_EUR} AS DOUBLE) AS value_eur
  FROM stg_open_po GROUP BY report_year, report_week, supplier)"""


# The four cards, written out on their own: latest week = greatest (year, week).
_LAST_WEEK = "ORDER BY report_year DESC, report_week DESC LIMIT 1"
CARD_SQL = {
    "weekly_open_value": "SELECT report_year, report_week, total_value_eur FROM mart_open_po_weekly",
    "weekly_line_count": "SELECT report_year, report_week, line_count FROM mart_open_po_weekly",
    "kpi_latest_week": ("SELECT report_year, report_week, line_count, total_quantity, total_value_eur "
                        f"FROM mart_open_po_weekly {_LAST_WEEK}"),
    "top_suppliers_latest": f"""SELECT supplier, value_eur FROM (
  SELECT s.*, row_number() OVER (ORDER BY (value_eur IS NULL) DESC, value_eur DESC, supplier ASC NULLS FIRST) AS place
  FROM mart_top_suppliers s
  JOIN (SELECT report_year, report_week FROM mart_top_suppliers {_LAST_WEEK}) w USING (report_year, report_week))
WHERE place <= 10""",
}


def _card_sql(name: str) -> str:
    return f"WITH {MART_CTES}\n{CARD_SQL[name]}"


def grid_ctes(dataset: str = "open_po") -> str:
    """The dataset's extract laid out as files of grid rows, as in
    ``grid_from_extract``: title (odd weeks), header (aliases when week % 3 = 0),
    data rows in row order, two junk rows."""
    c = CONTRACTS[dataset]
    fields = c.names
    nulls = ", ".join(["NULL"] * (len(fields) - 1))
    headers = "[" + ", ".join(f"'{s.headers[0]}'" for s in c.fields) + "]"
    aliases = "[" + ", ".join(f"'{s.headers[:2][-1]}'" for s in c.fields) + "]"
    start = "(CASE WHEN report_week % 2 = 1 THEN 2 ELSE 1 END)"
    file_cols = "dataset, report_year, report_week, file"
    mon = f"strftime({monday('report_year', 'report_week')}, '%Y-%m-%d')"
    return f"""{extract_ctes(dataset)},
g_data AS (
  SELECT '{dataset}' AS dataset, report_year, report_week,
         format('{{}}_{{}}_W{{:02d}}_b{{}}', '{dataset}', report_year, report_week, _block) AS file,
         CAST(row_number() OVER (PARTITION BY report_year, report_week, _block ORDER BY {ORDER_COLS}) - 1
              + {start} AS INTEGER) AS row_idx,
         {', '.join(fields)}, [{', '.join(fields)}] AS cells
  FROM {dataset}_ext),
g_files AS (SELECT {file_cols}, count(*) AS n FROM g_data GROUP BY ALL),
grid AS (
  SELECT {file_cols}, row_idx, cells FROM g_data
  UNION ALL SELECT {file_cols}, 0, ['Report Date: ' || {mon}, {nulls}] FROM g_files WHERE report_week % 2 = 1
  UNION ALL SELECT {file_cols}, CAST({start} - 1 AS INTEGER),
                   CASE WHEN report_week % 3 = 0 THEN {aliases} ELSE {headers} END FROM g_files
  UNION ALL SELECT {file_cols}, CAST({start} + n AS INTEGER), ['Total', {nulls}] FROM g_files
  UNION ALL SELECT {file_cols}, CAST({start} + n + 1 AS INTEGER), ['*** End of report ***', {nulls}] FROM g_files),
g_head AS (
  SELECT {file_cols}, row_idx AS header_idx,
         CAST(len(list_distinct(list_filter(list_transform(cells, lambda x: trim(x)),
              lambda x: list_contains({c.header_texts}, x)))) AS INTEGER) AS header_hits
  FROM grid WHERE row_idx < 15
  QUALIFY row_number() OVER (PARTITION BY file ORDER BY header_hits DESC, row_idx) = 1)"""


GRID_BODY = """SELECT g.dataset, g.report_year, g.report_week, g.file,
         count(*) FILTER (WHERE len(list_filter(g.cells, lambda x: x IS NOT NULL)) >= 2) AS body_rows,
         count(*) FILTER (WHERE len(list_filter(g.cells, lambda x: x IS NOT NULL)) < 2) AS junk_rows
  FROM grid g JOIN g_head h ON g.file = h.file WHERE g.row_idx > h.header_idx
  GROUP BY ALL"""


def _ext(select: str, where: str = "") -> str:
    return f"WITH {extract_ctes('open_po')}\nSELECT {select} FROM open_po_ext {where}"


LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _compact_lines(keep: str) -> str:
    rest = [c for c in LINE_COLS if c not in ("l_orderkey", "l_linenumber", "l_shipdate")]
    if keep == "last":
        order = "(l_shipdate IS NULL) DESC, l_shipdate DESC, " + ", ".join(f"{c} DESC NULLS LAST" for c in rest)
    else:
        order = "(l_shipdate IS NULL) ASC, l_shipdate ASC, " + ", ".join(f"{c} ASC NULLS FIRST" for c in rest)
    return (f"SELECT {', '.join(LINE_COLS)} FROM lineitem "
            f"QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) = 1")


EXT_COLS = OPEN_PO.names + ["report_year", "report_week"]


def _compact_null_sort() -> str:
    rest = [c for c in EXT_COLS if c not in ("po_number", "po_item")]
    order = "(po_item IS NULL) DESC, po_item DESC, " + ", ".join(f"{c} DESC NULLS LAST" for c in rest)
    return (f"WITH {extract_ctes('open_po')}\nSELECT {', '.join(EXT_COLS)} FROM open_po_ext "
            f"QUALIFY row_number() OVER (PARTITION BY po_number ORDER BY {order}) = 1")


_PARTS = [norm_key(k) for k in OPEN_PO.key]
_KEY = " || '|' || ".join(_PARTS)
_COMPLETE = " AND ".join(f"{p} <> ''" for p in _PARTS)
SNAP_COLS = SNAP_FIELDS["open_po"].split(", ")

_DQ_UNIQUE = f"""WITH {snapshot_ctes('open_po')},
g1 AS (SELECT count(*) AS n FROM open_po_snap_typed GROUP BY report_year, report_week, key),
g2 AS (SELECT count(*) AS n FROM open_po_snap GROUP BY report_year, report_week, key)
SELECT 'extract' AS stage, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows,
       CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS dup_rows FROM g1
UNION ALL
SELECT 'snapshot', CAST(coalesce(sum(n), 0) AS BIGINT), CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) FROM g2"""

_DQ_NOT_NULL = (f"WITH {snapshot_ctes('open_po')}\nSELECT count(*) AS rows, "
                + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS nulls_{c}" for c in SNAP_COLS)
                + " FROM open_po_snap")

_DQ_DELTA = f"""WITH {snapshot_ctes('open_po')},
w AS (SELECT report_year, report_week, count(*) AS rows,
             lag(count(*)) OVER (ORDER BY report_year, report_week) AS prev_rows
      FROM open_po_snap GROUP BY report_year, report_week),
p AS (SELECT *, CASE WHEN prev_rows IS NULL OR prev_rows = 0 THEN CAST(0 AS DOUBLE)
                     ELSE abs(rows - prev_rows) / prev_rows END AS pct FROM w)
SELECT report_year, report_week, rows, prev_rows, pct, pct <= 0.5 AS passed FROM p"""

_DQ_FRESH = f"""WITH {snapshot_ctes('open_po')},
f AS (SELECT report_year, report_week, count(*) AS rows,
             count(*) FILTER (WHERE report_date IS DISTINCT FROM
                              strftime({monday('report_year', 'report_week')}, '%Y-%m-%d')) AS stale_rows
      FROM open_po_snap GROUP BY report_year, report_week)
SELECT *, rows > 0 AND stale_rows = 0 AS passed FROM f"""

_DQ_REL = f"""WITH {stg_ctes('open_po')}
SELECT currency, count(*) AS rows FROM stg_open_po s
WHERE currency IS NOT NULL AND NOT EXISTS (SELECT 1 FROM rates r WHERE r.currency = s.currency)
GROUP BY currency"""


def _upsert_sql(partial: bool) -> str:
    keys = ["report_year", "report_week", "key"]
    src_cols = keys + ["net_price"] if partial else SNAP_COLS
    src = ", ".join(src_cols)
    sel = []
    for c in SNAP_COLS:
        if c in keys:
            sel.append(f"coalesce(s.{c}, t.{c}) AS {c}")
        elif c in src_cols:
            sel.append(f"CASE WHEN s.key IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}")
        else:
            sel.append(f"t.{c} AS {c}")
    in_touched = ("EXISTS (SELECT 1 FROM touched x WHERE x.report_year = {a}.report_year "
                  "AND x.report_week = {a}.report_week)")
    return f"""WITH {snapshot_ctes('open_po')},
{snapshot_ctes('open_po', keep='first', name='open_po_first', with_extract=False)},
stored AS (SELECT * FROM open_po_snap),
incoming AS (SELECT {src} FROM open_po_first WHERE report_week >= 20 AND rate_to_eur IS NOT NULL),
touched AS (SELECT DISTINCT report_year, report_week FROM incoming),
old AS (SELECT * FROM stored WHERE {in_touched.format(a='stored')}),
merged AS (SELECT {', '.join(sel)} FROM old t FULL OUTER JOIN incoming s
           ON t.report_year = s.report_year AND t.report_week = s.report_week AND t.key = s.key)
SELECT {', '.join(SNAP_COLS)} FROM stored WHERE NOT {in_touched.format(a='stored')}
UNION ALL SELECT {', '.join(SNAP_COLS)} FROM merged"""


def _dq_models() -> str:
    """Each rule of each model as its own count over the model."""
    week = ["report_year", "report_week"]
    rules = {"stg_open_po": (["row_id"], ["row_id", *week, "key"], True),
             "stg_all_prs": (["row_id"], ["row_id", *week, "key"], True),
             "mart_open_po_weekly": (week, week, True),
             "mart_top_suppliers": ([*week, "supplier"], [*week, "supplier"], False)}
    out = []
    for model, (unique, not_null, dated) in rules.items():
        bad = {"rows": "0", **{f"not_null({c})": f"(SELECT count(*) FROM {model} WHERE {c} IS NULL)" for c in not_null}}
        if dated:
            bad["report_date"] = (f"(SELECT count(*) FROM {model} WHERE report_date IS DISTINCT FROM "
                                  f"CAST({monday('report_year', 'report_week')} AS DATE))")
        some = " AND ".join(f"{c} IS NOT NULL" for c in unique)
        bad[f"unique({', '.join(unique)})"] = (
            f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {model} WHERE {some} "
            f"GROUP BY {', '.join(unique)} HAVING count(*) > 1))")
        out += [f"SELECT '{model}' AS model, '{check}' AS \"check\", (SELECT count(*) FROM {model}) AS rows, "
                f"CAST({n} AS BIGINT) AS bad_rows, {n} = 0 AS passed" for check, n in bad.items()]
    prs = snapshot_ctes("all_prs").replace(LINES_CTE + ",", "", 1)
    return (f"WITH {MART_CTES},\n{prs},\nstg_all_prs AS (SELECT {STG['all_prs']} FROM all_prs_snap)\n"
            + "\nUNION ALL ".join(out))


ORACLE: dict[str, str] = {
    "snapshot_open_po": _snap_sql("open_po"),
    "snapshot_all_prs": _snap_sql("all_prs"),
    "stg_open_po": f"WITH {stg_ctes('open_po')}\nSELECT * FROM stg_open_po",
    "stg_all_prs": f"WITH {stg_ctes('all_prs')}\nSELECT * FROM stg_all_prs",
    "mart_open_po_weekly": f"WITH {MART_CTES}\nSELECT * FROM mart_open_po_weekly",
    "mart_top_suppliers": f"WITH {MART_CTES}\nSELECT * FROM mart_top_suppliers",
    "mart_top_suppliers_ranked": f"""WITH {MART_CTES}
SELECT *, row_number() OVER (PARTITION BY report_year, report_week
  ORDER BY value_eur DESC NULLS FIRST, supplier ASC NULLS FIRST) AS supplier_rank FROM mart_top_suppliers""",
    "card_weekly_open_value": _card_sql("weekly_open_value"),
    "card_weekly_line_count": _card_sql("weekly_line_count"),
    "card_kpi_latest": _card_sql("kpi_latest_week"),
    "card_top_suppliers": _card_sql("top_suppliers_latest"),
    "grid_header_detect": f"WITH {grid_ctes()}\nSELECT * FROM g_head",
    "grid_junk_filter": f"WITH {grid_ctes()}\n{GRID_BODY}",
    "grid_resolve": (f"WITH {grid_ctes()}\nSELECT dataset, report_year, report_week, file, row_idx, "
                     + ", ".join(OPEN_PO.names) + " FROM g_data"),
    "grid_snapshot_open_po": _snap_sql("open_po"),
    "grid_snapshot_all_prs": _snap_sql("all_prs"),
    "to_numeric_messy": _ext(f"order_quantity AS raw_quantity, {to_num('order_quantity')} AS order_quantity, "
                             f"net_price AS raw_price, {to_num('net_price')} AS net_price"),
    "normalize_keys": _ext(f"po_number AS raw_po_number, po_item AS raw_po_item, "
                           f"{norm_key('po_number')} AS po_number_key, {norm_key('po_item')} AS po_item_key"),
    "zero_pad_material": _ext(f"material AS raw_material, {norm_key('material', 8)} AS material"),
    "composite_key_incomplete_drop": _ext(f"report_year, report_week, {_KEY} AS key", f"WHERE {_COMPLETE}"),
    "iso_week_monday": """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS order_date FROM orders)
SELECT order_date, CAST(isoyear(order_date) AS INTEGER) AS iso_year, CAST(week(order_date) AS INTEGER) AS iso_week,
       """ + monday("isoyear(order_date)", "week(order_date)") + """ AS monday FROM d""",
    "week_sequence": """WITH s AS (SELECT CAST(isoyear(o_orderdate) AS INTEGER) AS report_year,
                  CAST(min(week(o_orderdate)) AS INTEGER) AS lo, CAST(max(week(o_orderdate)) AS INTEGER) AS hi
           FROM orders GROUP BY 1)
SELECT report_year, CAST(unnest(range(lo, hi + 1)) AS INTEGER) AS report_week FROM s""",
    "compact_last": _compact_lines("last"),
    "compact_first": _compact_lines("first"),
    "compact_null_sort": _compact_null_sort(),
    "dq_unique_keys": _DQ_UNIQUE,
    "dq_not_null": _DQ_NOT_NULL,
    "dq_row_count_delta": _DQ_DELTA,
    "dq_freshness": _DQ_FRESH,
    "dq_relationships": _DQ_REL,
    "upsert_twice": _upsert_sql(False),
    "upsert_partial_columns": _upsert_sql(True),
    "upsert_rates_later": f"""WITH {snapshot_ctes('open_po')}
SELECT {', '.join(c for c in SNAP_COLS if c not in ('rate_to_eur', 'line_value_eur'))},
       CASE WHEN report_week >= 20 THEN rate_to_eur END AS rate_to_eur,
       CASE WHEN report_week >= 20 THEN line_value_eur END AS line_value_eur FROM open_po_snap""",
    "quarantine_rows": _ext(f"report_year, report_week, {', '.join(OPEN_PO.names)}", f"WHERE NOT ({_COMPLETE})"),
    "run_log_status": f"""WITH {snapshot_ctes('open_po')},
n AS (SELECT (SELECT count(*) FROM open_po_ext) AS ext, (SELECT count(*) FROM open_po_snap_typed) AS typed,
             (SELECT count(*) FROM open_po_snap) AS snap)
SELECT 'open_po' AS module, 'files' AS stage, 0 AS rows_in, 0 AS rows_out, 'PASSED' AS status FROM n
UNION ALL SELECT 'open_po', 'quarantine', ext, ext - typed, 'PASSED' FROM n
UNION ALL SELECT 'open_po', 'load', ext, snap, 'PASSED' FROM n
UNION ALL SELECT 'open_po', 'row_counts', 0, 0, 'PASSED' FROM n""",
    "dq_model_tests": _dq_models(),
    "landed_listing": f"""WITH {LINES_CTE},
keys AS (SELECT DISTINCT format('dataset=open_po/year={{}}/week={{}}/extract=open_po_{{}}_W{{:02d}}_b{{}}', report_year,
                report_week, report_year, report_week, _block) AS key FROM lines)
SELECT CAST(row_number() OVER (ORDER BY key || '/') AS INTEGER) AS place, key, true AS filled FROM keys""",
    "xlsx_snapshot": _snap_sql("open_po"),
    "snapshot_rates_csv": _snap_sql("open_po"),
    "snapshot_contract_file": _snap_sql("all_prs"),
    "stored_row_count": f"""WITH t AS ({_upsert_sql(False)})
SELECT report_year, count(*) AS rows, (SELECT count(*) FROM t) AS table_rows FROM t GROUP BY 1""",
    "reload_row_counts": f"""WITH {snapshot_ctes('open_po')},
{snapshot_ctes('open_po', keep='first', name='open_po_first', with_extract=False)},
a AS (SELECT report_year, report_week, count(*) AS prev_rows FROM open_po_snap GROUP BY 1, 2),
b AS (SELECT report_year, report_week, count(*) AS rows FROM open_po_first
      WHERE report_week >= 20 AND rate_to_eur IS NOT NULL GROUP BY 1, 2)
SELECT report_year, report_week, rows, prev_rows, abs(rows - prev_rows) / prev_rows AS pct,
       abs(rows - prev_rows) / prev_rows <= 0.5 AS passed FROM b JOIN a USING (report_year, report_week)""",
    "mart_refresh": f"""WITH t AS ({_upsert_sql(False)})
SELECT report_year, report_week, CAST(max(report_date) AS DATE) AS report_date, count(*) AS line_count,
       CAST(sum(TRY_CAST(order_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_quantity,
       CAST({VALUE_EUR} AS DOUBLE) AS total_value_eur
FROM t GROUP BY report_year, report_week""",
    "logical_week": """SELECT DISTINCT o_orderdate AS logical_date, CAST(week(o_orderdate) AS INTEGER) AS report_week,
       CAST(isoyear(o_orderdate) AS INTEGER) AS report_year FROM orders""",
    "dq_report_dates": f"""WITH {snapshot_ctes('open_po')}
SELECT report_date, count(*) AS rows FROM open_po_snap GROUP BY 1""",
    "card_columns": f"""WITH {snapshot_ctes('open_po')},
weeks AS (SELECT DISTINCT report_year, report_week FROM open_po_snap),
last AS (SELECT DISTINCT supplier FROM open_po_snap
         WHERE report_year * 100 + report_week = (SELECT max(report_year * 100 + report_week) FROM weeks))
SELECT 'weekly_open_value' AS card, 'report_year, report_week, total_value_eur' AS columns, (SELECT count(*) FROM weeks) AS rows
UNION ALL SELECT 'weekly_line_count', 'report_year, report_week, line_count', (SELECT count(*) FROM weeks)
UNION ALL SELECT 'kpi_latest_week', 'report_year, report_week, line_count, total_quantity, total_value_eur',
       least(1, (SELECT count(*) FROM weeks))
UNION ALL SELECT 'top_suppliers_latest', 'supplier, value_eur', least(10, (SELECT count(*) FROM last))""",
    "branches_side_by_side": f"""WITH {snapshot_ctes('open_po')},
n AS (SELECT count(*) AS n FROM open_po_snap)
SELECT 'open_po' AS dataset, n AS loaded, false AS failed, n AS stored FROM n
UNION ALL SELECT 'all_prs', NULL, true, NULL""",
    "backfill_weeks": _snap_sql("open_po"),
    "stream_ingest_snapshot": _snap_sql("open_po"),
}
