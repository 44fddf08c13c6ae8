import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlake.operators import aggregates as A
from marketlake.operators import quality as Q
from marketlake.plans import catalog

D = dt.date


@pytest.fixture(scope="module")
def good(spark):
    rows = [("A", D(2024, 1, 1), 10.0, "annual"), ("B", D(2024, 1, 2), 11.0, "quarterly")]
    return spark.createDataFrame(rows, "k string, d date, v double, f string")


@pytest.fixture(scope="module")
def bad(spark):
    rows = [
        ("A", D(2024, 1, 1), -1.0, "annual"), ("A", D(2024, 1, 1), 0.0, "weekly"),
        (None, D(2024, 3, 1), 99.0, None), ("Z", None, None, "annual"),
    ]
    return spark.createDataFrame(rows, "k string, d date, v double, f string")


CHECKS = {
    "not_null": (lambda df: Q.expect_not_null(df, "k"), 1),
    "null_counts": (lambda df: Q.null_counts(df, ["k", "d", "v", "f"]), 4),
    "unique": (lambda df: Q.expect_unique(df, "k"), 1),
    "key": (lambda df: Q.expect_key(df, ["k", "d"]), 1),
    "accepted": (lambda df: Q.expect_in(df, "f", ["annual", "quarterly"]), 1),
    "future": (lambda df: Q.expect_not_future(df, "d", "2024-02-01"), 1),
    "bounds": (lambda df: Q.expect_between(df, "v", 0, 50, strict_low=True), 3),
    "fresh": (lambda df: Q.expect_fresh(df, "d", 3, "2024-03-10").where("as_of > '2024-03-01'"), 1),
    "rules": (
        lambda df: Q.range_violations(
            df, ["k"], {"low": ("v", 0, None, True), "high": ("v", None, 50, False)}
        ),
        3,
    ),
}


@pytest.mark.parametrize("name", CHECKS)
def test_bad_rows_are_reported(bad, name):
    check, n = CHECKS[name]
    assert check(bad).count() == n


@pytest.mark.parametrize("name", [n for n in CHECKS if n != "fresh"])
def test_clean_rows_pass(good, name):
    assert CHECKS[name][0](good).isEmpty()


def test_freshness_boundary(good):
    assert Q.expect_fresh(good, "d", 3, "2024-01-05").isEmpty()
    row = Q.expect_fresh(good, "d", 3, "2024-01-06").first()
    assert row.days_since == 4 and row.latest_d == D(2024, 1, 2)


def test_orphans(good, bad):
    dim = good.select("k")
    assert [r.k for r in Q.expect_fk(bad.dropna(subset=["k"]), dim, "k").collect()] == ["Z"]


def test_coverage(spark):
    rows = [
        ("TOP", D(2024, 1, 15)), ("A", D(2024, 1, 10)), ("B", D(2024, 1, 9)),
        ("C", D(2023, 11, 1)), ("FDS", D(2023, 12, 1)),
    ]
    df = spark.createDataFrame(rows, "ticker string, price_date date")
    excluded = spark.createDataFrame([("FDS",)], "ticker string")
    got = Q.coverage_lag(df, "ticker", "price_date", 5, excluded).collect()
    assert [(r.ticker, r.days_behind) for r in got] == [("C", 75), ("B", 6)]


def test_anchors(spark):
    facts = spark.createDataFrame(
        [("A", 100.0, 5.0), ("B", 100.0, 5.0), ("C", 100.0, 5.0), ("D", 100.0, None)],
        "k string, rev double, eps double",
    )
    base = spark.createDataFrame(
        [("A", 100.05, 5.005), ("B", 101.0, None), ("C", None, 5.02), ("D", None, None)],
        "k string, expected_rev double, expected_eps double",
    )
    limits = {"rev": ("relative", 0.001), "eps": ("absolute", 0.01)}
    assert {r.k for r in Q.anchors_changed(facts, base, ["k"], limits).collect()} == {"B", "C"}


def test_profiles_and_top_k(spark, bad):
    profile = A.non_null_profile(bad, ["k", "v"])
    assert {r.column_name: r.non_null for r in profile.collect()} == {"k": 3, "v": 3}
    assert A.fields_with_data(profile).first() == (2, 2)
    assert sorted(r.null_fields for r in A.null_counts_per_row(bad, [], ["k", "d", "v", "f"]).collect()) == [0, 0, 2, 2]
    assert [r.v for r in A.top_k(bad, "v", 2).collect()] == [99.0, 0.0]
    assert [r.v for r in A.top_k(bad, "v", 1, ascending=True).collect()] == [-1.0]
    assert A.counts_by(bad, "f").collect()[-1] == ("annual", 2)
    assert [r.k for r in A.distinct_values(bad, "k").collect()] == ["A", "Z"]
    plan = A.top_k(bad, "v", 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_digest(good):
    d = A.digest(good)
    assert d["row_count"] == 2 and d["numeric"] == ["v"] and d["types"]["d"] == "date"
    assert len(d["sample"]) == 2


def test_catalogue_filters(spark):
    security = spark.createDataFrame(
        [("A", "Alpha", "Tech", "Chips", 300 * 10**9), ("B", "Beta", "Banks", "Lending", None)],
        "ticker string, company_name string, sector string, industry string, market_cap_usd long",
    )
    pick = lambda **kw: [r.ticker for r in catalog.find_securities(security, **kw).collect()]
    assert pick(term="alp") == ["A"] and pick(sector="Banks") == ["B"] and pick(bucket="Mega") == ["A"]
    assert pick(bucket="ETFs / N/A") == ["B"] and pick() == ["A", "B"]
    series = spark.createDataFrame([("DFF", "Fed Funds Rate"), ("XX", "Else")], "series_id string, series_name string")
    assert [r.series_id for r in catalog.find_series(series, category="Other").collect()] == ["XX"]
    assert [r.series_id for r in catalog.find_series(series, "interest").collect()] == ["DFF"]
