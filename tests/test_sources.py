"""Seeds and wide text extracts."""

import os

from snapweave.contracts import OPEN_PO
from snapweave.operators.enrich import enrich_rates
from snapweave.operators.resolve import extract
from snapweave.sources.grid import read_text_grid
from snapweave.sources.seeds import RATES, load_rates

from test_grid import HEAD, write_csv

SEED = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "snapweave", "seeds", "rates.csv")


def test_rates_from_csv_equal_builtin_seed(spark):
    rows = sorted((r.currency, r.rate_to_eur) for r in load_rates(spark, SEED).collect())
    assert rows == sorted(RATES)


def test_absent_rates_file_means_no_enrichment(spark, tmp_path):
    assert load_rates(spark, str(tmp_path / "missing.csv")) is None
    df = spark.createDataFrame([("EUR", 1.0, 2.0)], "currency string, order_quantity double, net_price double")
    assert enrich_rates(df, None).columns == df.columns


def test_duplicate_rates_are_refused(spark, tmp_path):
    import pytest

    from snapweave.sources.seeds import SeedError

    p = tmp_path / "rates.csv"
    p.write_text("currency,rate_to_eur\nEUR,1.0\nEUR,1.1\n")
    with pytest.raises(SeedError):
        load_rates(spark, str(p))


def test_wide_file_headers_far_right(spark, tmp_path):
    pad = [f"extra {i}" for i in range(70)]
    row = ["x"] * 70 + ["4500000001", "10", "5", "d", "S", "1", "2", "EUR", "2026-07-14", "P100", "Ann"]
    write_csv(tmp_path / "dataset=open_po/year=2026/week=29/wide.csv", [pad + HEAD, row])
    got = extract(read_text_grid(spark, str(tmp_path)), OPEN_PO).first()
    assert got.po_number == "4500000001" and got.requisitioner == "Ann"
