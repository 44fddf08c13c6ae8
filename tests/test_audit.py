"""One pass over a table finds the same broken rules as a frame for each rule."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlake import schemas as S
from marketlake.operators import audit
from marketlake.operators import quality as Q
from marketlake.plans import questions
from marketlake.plans import warehouse as WH
from tests.test_warehouse import land, price_rows

D = dt.date
SCHEMA = "k string, d date, v double, f string"
AS_OF = "2024-02-01"


def rules(spark):
    held = spark.createDataFrame([("A",), ("B",), ("B",), (None,)], "k string")
    return audit.Rules(
        rows={"value": F.col("v").isNull(), "low": Q.outside(F.col("v"), 0, 50, True),
              "f": ~F.col("f").isin("annual"), "future": F.col("d") > F.lit(AS_OF).cast("date")},
        known={"known": ("k", held)},
        unique=("key", ["k", "d"]),
        fresh={"fresh": audit.Fresh("d", 3, AS_OF)},
        coverage=("coverage", audit.Coverage("k", "d", 5, ["X"])),
    )


def one_by_one(spark, df):
    """The same rules, each by a scan of its own."""
    held = spark.createDataFrame([("A",), ("B",)], "k string")
    excluded = spark.createDataFrame([("X",)], "k string")
    frames = {
        "value": Q.expect_not_null(df, "v"), "low": Q.expect_between(df, "v", 0, 50, strict_low=True),
        "f": Q.expect_in(df, "f", ["annual"]), "future": Q.expect_not_future(df, "d", AS_OF),
        "known": Q.expect_fk(df, held, "k"), "key": Q.expect_key(df, ["k", "d"]),
        "fresh": Q.expect_fresh(df, "d", 3, AS_OF), "coverage": Q.coverage_lag(df, "k", "d", 5, excluded),
    }
    return {name for name, frame in frames.items() if not frame.isEmpty()}


ROW = st.tuples(
    st.sampled_from(["A", "B", "C", "X", None]),
    st.sampled_from([D(2024, 1, 1), D(2024, 1, 30), D(2024, 1, 31), D(2024, 3, 1), None]),
    st.sampled_from([0.0, 1.0, 50.0, 51.0, None]),
    st.sampled_from(["annual", "weekly", None]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(ROW, max_size=5))
def test_one_pass_finds_what_single_checks_find(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r.rule: r.broken for r in audit.broken(df, rules(spark)).collect()}
    assert len(found) == 8
    assert {name for name, n in found.items() if n} == one_by_one(spark, df)


def test_counts_by_key_and_by_row(spark):
    rows = [("A", D(2024, 1, 1), None, "annual")] * 3 + [("B", D(2024, 1, 2), None, "annual")]
    df = spark.createDataFrame(rows, SCHEMA)
    value = {"value": F.col("v").isNull()}
    keyed = audit.broken(df, audit.Rules(rows=value, unique=("key", ["k"])))
    assert {r.rule: r.broken for r in keyed.collect()} == {"value": 2, "key": 1}
    plain = audit.broken(df, audit.Rules(rows=value))
    assert plain.collect() == [("value", 4)]
    assert "hashpartitioning" not in plain._jdf.queryExecution().executedPlan().toString()
    nulls = spark.createDataFrame([(None, None, 1.0, "annual")] * 2, SCHEMA)
    exempt = audit.Rules(unique=("key", ["k"]), null_free=True)
    assert audit.broken(nulls, exempt).first().broken == 0
    assert audit.broken(nulls, audit.Rules(unique=("key", ["k"]))).first().broken == 1


def test_limits_are_refused(spark):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        audit.broken(df, audit.Rules(rows={str(i): F.lit(True) for i in range(63)}))
    with pytest.raises(ValueError):
        audit.broken(df, audit.Rules(coverage=("c", audit.Coverage("k", "d", 5))))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("audited"))
    land(spark, base, "prices", price_rows(["A", "B"], 0, 12, 10**9))
    now = dt.datetime(2024, 1, 12)
    land(spark, base, "company_info", [(t, t, "Tech", None, 5e9, now) for t in "AB"])
    WH.build(spark, base)
    return base


def test_the_warehouse_in_one_pass_a_table(spark, lake):
    """The same names as frame by frame; later also with anchors that have moved."""
    def single(as_of):
        return {n for n, df in WH.checks(spark, lake, as_of).items() if not df.isEmpty()}

    assert set(WH.broken_checks(spark, lake, "2024-01-12")) == single("2024-01-12")
    late = WH.broken_checks(spark, lake, "2024-03-12")
    assert set(late) == single("2024-03-12") and "fresh fact_daily_prices" in late
    early = WH.broken_checks(spark, lake, "2024-01-05")
    assert set(early) == single("2024-01-05")
    assert early["future prices"].count() == 14

    fact = WH.stored_marts(spark, lake)["fact_daily_prices"]
    anchors = questions.baseline_extract(fact).withColumn("expected_close", F.lit(1.0))
    assert WH.record_anchors(spark, lake, "fact_daily_prices", anchors) > 0
    assert "anchors fact_daily_prices" in WH.broken_checks(spark, lake, "2024-01-12")


def test_every_rule_of_a_stored_fact_in_one_scan(spark, lake):
    t = WH.staging_views(spark, lake) | WH.stored_marts(spark, lake)
    asked = WH.table_rules(t, "fact_daily_prices", "2024-01-12")
    plan = audit.broken(t["fact_daily_prices"], asked)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2  # the fact, and the securities it refers to
    assert S.KEYS["fact_daily_prices"] == asked.unique[1]


def test_rules_cover_all_standing_checks(spark, lake):
    t = WH.staging_views(spark, lake) | WH.stored_marts(spark, lake)
    named = set()
    for name in t:
        r = WH.table_rules(t, name, "2024-01-12")
        named |= {*r.rows, *r.known, *r.fresh}
        named |= {r.unique[0]} if r.unique else set()
        named |= {r.coverage[0]} if r.coverage else set()
    standing = {n for n in WH.checks(spark, lake, "2024-01-12") if not n.startswith("anchors ")}
    assert named == standing
