import datetime as dt
import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from marketlake import constants as C
from marketlake.functions import scalar as S
from marketlake.functions.predicates import any_not_null, search, valid_symbol
from marketlake.plans import marts, staging
from marketlake.schemas import RAW, RAW_PRICES
from marketlake.sources import shaping
from marketlake.sources.calendar import date_spine
from marketlake.sources.raw import values_df

NS = 1_704_067_200_000_000_000  # 2024-01-01


def day(text):
    return dt.date.fromisoformat(text)


def one(df):
    return df.first()


def test_constants_have_the_known_sizes():
    assert len(C.MACRO_SERIES) == 96
    assert {s for ids in C.MACRO_CATEGORIES.values() for s in ids} == set(C.MACRO_SERIES)
    assert len(C.MACRO_CATEGORIES) == 12
    assert len(set(C.ETF_SYMBOLS)) == 113
    assert len(C.VALUATION_FIELDS) == 35
    assert len(C.LINE_ITEMS) == 37
    assert set(RAW) == {
        "prices", "company_info", "macro_indicators", "financial_statements", "valuation_metrics",
    }


def test_nanoseconds_floor(spark):
    df = spark.createDataFrame([(NS,), (NS + 1_000_000_000 - 1,), (-1,), (0,)], "ns long")
    got = df.select(S.ns_to_date("ns").alias("d"), S.ns_to_ts("ns").alias("t")).collect()
    assert [r.d for r in got] == [day("2024-01-01")] * 2 + [day("1969-12-31"), day("1970-01-01")]
    assert got[1].t == dt.datetime(2024, 1, 1, 0, 0, 0, 999999)
    assert got[2].t == dt.datetime(1969, 12, 31, 23, 59, 59, 999999)


def test_rounding_casts_and_ratios(spark):
    df = spark.createDataFrame([(1.5, 2.5, -2.5, 1e30)], "a double, b double, c double, d double")
    row = one(df.select(*[S.to_bigint(c).alias(c) for c in "abcd"]))
    assert (row.a, row.b, row.c, row.d) == (2, 3, -3, None)
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0), (-1.0, -2.0)], "n double, r double")
    got = df.select(S.safe_div("n", "r").alias("q"), S.margin("n", "r").alias("m")).collect()
    assert [(r.q, r.m) for r in got] == [(None, None), (0.25, 0.25), (0.5, None)]


def test_sentinels(spark):
    values = [1e18, 1.1e18, -2e18, math.inf, math.nan, None, 3.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.v for r in S.null_sentinels(df, ["v"]).collect()]
    assert got == [1e18, None, None, None, None, None, 3.0]
    text = spark.createDataFrame([("Infinity",), ("x",), ("2.5",)], "v string")
    assert [r.v for r in S.null_sentinels(text, ["v"]).collect()] == [None, None, 2.5]


def test_calendar(spark):
    days = marts.dim_date(spark)
    span = days.agg(F.min("date_key"), F.max("date_key"), F.count("*")).first()
    assert tuple(span) == (day("2009-01-01"), day("2028-03-01"), 7000)
    sunday = one(days.where(F.col("date_key") == day("2024-01-07")))
    assert sunday.day_of_week == 0 and sunday.day_name == "Sun" and sunday.month_name == "Jan"
    assert sunday.week_of_year == 1 and not sunday.is_weekday
    assert sunday.fiscal_quarter_label == "Q1 2024"
    assert date_spine(spark, "2020-02-28", 3).count() == 3


def test_observations(spark):
    text = '{"observations":[{"date":"2024-01-01","value":"5.33"},{"date":"2024-01-02","value":"."}]}'
    df = spark.createDataFrame([("DFF", text), ("NEW1", text)], "series_id string, body string")
    got = {r.series_id: r for r in shaping.shape_observations(df, "body").collect()}
    assert len(got) == 2
    assert got["DFF"].series_name == "Fed Funds Rate" and got["DFF"].value == 5.33
    assert got["DFF"].date == day("2024-01-01")
    assert got["NEW1"].series_name == "NEW1"


def test_wide_prices(spark):
    cols = [f"{t}|{f}" for t in ("A", "B") for f in shaping.PRICE_FIELDS]
    rows = [(day("2024-01-02"), 1.0, 2.0, 0.5, 0.9, 10, None, 2.0, 1.0, 1.0, 5)]
    schema = "date date, " + ", ".join(
        f"`{c}` {'long' if c.endswith('volume') else 'double'}" for c in cols
    )
    got = shaping.wide_prices_to_long(spark.createDataFrame(rows, schema), ["A", "B"]).collect()
    assert [(r.ticker, r.close, r.volume) for r in got] == [("A", 1.0, 10)]
    assert got[0].extracted_at is not None


def test_statement_matrix_and_pivot_are_inverse(spark):
    matrix = spark.createDataFrame(
        [("Total Revenue", 200.0, 150.0), ("Gross Profit", 80.0, None), ("Net Income", 20.0, 10.0)],
        "line_item string, `2023-12-31` double, `2022-12-31` double",
    )
    long = shaping.statement_to_eav(matrix, "A", "income_statement", "annual")
    assert long.count() == 5
    wide = marts.int_fundamentals_pivoted(long).orderBy("period_end_date").collect()
    assert [r.total_revenue for r in wide] == [150.0, 200.0]
    assert wide[1].gross_margin == 0.4 and wide[1].net_margin == 0.1
    assert wide[1].operating_margin is None and wide[0].gross_margin is None


def test_pivot_edge_rows(spark):
    rows = [
        ("A", "income_statement", "annual", day("2023-12-31"), "Total Revenue", 0.0),
        ("A", "income_statement", "annual", day("2023-12-31"), "Gross Profit", 5.0),
        ("B", "balance_sheet", "annual", day("2023-12-31"), "Inventory", 5.0),
        ("C", "balance_sheet", "annual", day("2023-12-31"), "Total Revenue", 9.0),
        ("C", "balance_sheet", "annual", day("2023-12-31"), "Total Assets", 7.0),
    ]
    df = spark.createDataFrame(
        rows,
        "ticker string, statement_type string, frequency string, period_end_date date, "
        "line_item string, value double",
    )
    got = {r.ticker: r for r in marts.int_fundamentals_pivoted(df).collect()}
    assert set(got) == {"A", "C"} and got["A"].gross_margin is None
    assert got["C"].total_revenue == 9.0
    typed = {r.ticker: r for r in marts.int_fundamentals_pivoted(df, typed_items=True).collect()}
    assert typed["C"].total_revenue is None and typed["C"].total_assets == 7.0


def test_union_statements(spark):
    matrix = spark.createDataFrame([("A", "X", 1.0)], "ticker string, line_item string, `2023-12-31` double")
    parts = {(k, f): matrix for k in C.STATEMENT_TYPES for f in C.FREQUENCIES}
    got = shaping.union_statements(parts)
    assert got.select("statement_type", "frequency").distinct().count() == 6 == got.count()


def test_universe(spark):
    a = values_df(spark, [(0, "BRK.B"), (1, "AAPL"), (2, "SPY")], "pos int, ticker string")
    a = a.withColumn("ticker", S.normalize_symbol("ticker"))
    b = values_df(spark, [(0, "SPY"), (1, "QQQ")], "pos int, ticker string")
    universe = shaping.ordered_distinct_union(a, b, "ticker")
    assert [r.ticker for r in universe.collect()] == ["BRK-B", "AAPL", "SPY", "QQQ"]
    etfs = shaping.etf_symbols(spark)
    assert {r.ticker for r in shaping.exclude_keys(universe, etfs, "ticker").collect()} == {"BRK-B", "AAPL"}
    inside, outside = shaping.split_by_membership(universe, etfs, "ticker")
    assert (inside.count(), outside.count()) == (2, 2)
    ok = values_df(spark, [("BRK-B",), ("brk",), ("A.B",), ("ABCDEFGHIJK",)], "s string")
    assert [r[0] for r in ok.select(valid_symbol("s")).collect()] == [True, False, False, False]


def test_ranges(spark):
    days = date_spine(spark, "2024-01-01", 31).withColumnRenamed("date_key", "d")
    pick = lambda **kw: [r.d.day for r in shaping.select_range(days, "d", **kw).orderBy("d").collect()]
    assert pick(start="2024-01-05", end="2024-01-08") == [5, 6, 7]
    assert pick(after=day("2024-01-27"), as_of="2024-01-30") == [28, 29]
    assert pick(lookback_days=3, as_of="2024-01-10") == [7, 8, 9]
    with pytest.raises(ValueError):
        shaping.select_range(days, "d")


def test_range_filter_reaches_the_scan(spark, tmp_path):
    date_spine(spark, "2024-01-01", 31).write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    picked = shaping.select_range(df, "date_key", start="2024-01-05", end="2024-01-08")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date_key,2024-01-05)" in plan


def test_valuation_and_company_rows_fill_missing_tickers(spark):
    info = spark.createDataFrame(
        [Row(ticker="A", extracted_at=dt.datetime(2024, 1, 1), **{f: 2e18 if f == "beta" else 1.0 for f in C.VALUATION_FIELDS})]
    )
    universe = values_df(spark, [("A",), ("B",)], "ticker string")
    got = {r.ticker: r for r in shaping.valuation_rows(universe, info, day("2024-03-01")).collect()}
    assert got["A"].trailingPE == 1.0 and got["A"].beta is None
    assert got["B"].trailingPE is None and got["B"].snapshot_date == day("2024-03-01")
    companies = spark.createDataFrame(
        [("A", "Alpha", "Tech", None, 1.0, None)],
        "ticker string, company_name string, sector string, industry string, market_cap double, extracted_at timestamp_ntz",
    )
    rows = {r.ticker: r for r in shaping.company_rows(universe, companies).collect()}
    assert rows["A"].company_name == "Alpha" and rows["B"].company_name is None


def test_staging_prices(spark):
    rows = [
        (NS, "A", 1.0, 1.0, 1.0, 1.0, 10, NS),
        (NS, "A", 2.0, 1.0, 1.0, 1.0, 10, NS + 10**9),  # later copy of the same day
        (NS, "B", None, 1.0, 1.0, 1.0, 10, NS),
        (NS, "C", 1.0, 1.0, 1.0, 1.0, 0, NS),
        (NS, "D", 1.0, 1.0, 1.0, 1.0, None, NS),
        (NS, "E", math.nan, 1.0, 1.0, 1.0, 5, NS),
    ]
    raw = spark.createDataFrame(rows, RAW_PRICES)
    got = staging.stg_prices(raw).collect()
    assert [(r.ticker, r.close_price, r.price_date) for r in got] == [("A", 2.0, day("2024-01-01"))]
    assert staging.stg_prices(raw, dedupe=False).count() == 2


def test_staging_companies(spark):
    raw = spark.createDataFrame(
        [("A", "Alpha", None, None, 1.5, None)],
        "ticker string, company_name string, sector string, industry string, market_cap double, extracted_at timestamp",
    )
    row = one(staging.stg_companies(raw))
    assert (row.sector, row.industry, row.market_cap_usd) == ("Unknown", "Unknown", 2)


def test_search_is_literal_and_null_safe(spark):
    df = spark.createDataFrame(
        [("A.B", "Alpha (x)", None), ("CC", None, "beta")], "ticker string, name string, sector string"
    )
    hit = lambda term: {r.ticker for r in search(df, term, ["ticker"], ["name", "sector"]).collect()}
    assert hit("(X") == {"A.B"} and hit("a.b") == {"A.B"} and hit("BETA") == {"CC"} and hit(".*") == set()
    assert any_not_null(df, ["name", "sector"]).count() == 2


def test_display(spark):
    df = spark.createDataFrame(
        [("A", 1_250_000_000_000, 1234567), ("B", None, 5)], "t string, cap long, n long"
    )
    shown = S.display_columns(df, billions=["cap"], counts=["n"], labels={"cap": "Mkt Cap"}).collect()
    assert [(r["Mkt Cap"], r.n) for r in shown] == [("$1250.0B", "1,234,567"), ("—", "5")]
    sizes = spark.createDataFrame([(200e9,), (10e9,), (2e9,), (1e9,), (None,)], "c double")
    assert [r[0] for r in sizes.select(S.size_bucket("c")).collect()] == [
        "Mega", "Large", "Mid", "Small", "ETFs / N/A",
    ]
