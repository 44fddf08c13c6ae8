import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from marketlake.functions.quantiles import exact_quantiles
from marketlake.operators import joins as J
from marketlake.operators import reshape as R
from marketlake.operators import windows as W
from marketlake.plans import events, marts, questions, staging
from marketlake.schemas import RAW_PRICES
from tests.helpers import NS_DAY, as_set, daily_prices

D = dt.date


@pytest.fixture(scope="module")
def walk(spark):
    """A long gappy series and a few short ones."""
    rng = random.Random(7)
    rows = []
    for ticker, n in (("LONG", 900), ("MID", 60), ("ONE", 1)):
        d, price = D(2020, 1, 1), 100.0
        for _ in range(n):
            price *= 1 + rng.uniform(-0.1, 0.11)
            rows.append((ticker, d, price, rng.randint(1, 1000)))
            d += dt.timedelta(days=rng.choice([1, 1, 1, 3]))
    return spark.createDataFrame(
        rows, "ticker string, price_date date, close_price double, volume long"
    ).repartition(4).cache()


def test_hand_worked_returns(spark):
    ns = lambda text: (D.fromisoformat(text) - D(1970, 1, 1)).days * NS_DAY
    rows = [
        (ns(d), "A", c, c, c, c, v, 0)
        for d, c, v in [
            ("2024-01-02", 100.0, 10), ("2024-01-03", 110.0, 10), ("2024-01-04", 99.0, 10),
            ("2024-01-05", 120.0, 0), ("2024-01-08", None, 10),
        ]
    ]
    prices = staging.stg_prices(spark.createDataFrame(rows, RAW_PRICES))
    returns = marts.int_daily_returns(prices)
    security = spark.createDataFrame([("A",)], "ticker string")
    fact = marts.fact_daily_prices(returns, security, marts.dim_date(spark)).orderBy("price_date").collect()
    assert [r.price_date.day for r in fact] == [3, 4]
    first, second = fact
    assert math.isclose(first.daily_return, 0.1) and first.week_52_high == 110 and first.week_52_low == 100
    assert first.rolling_30d_vol_annualized is None and first.pct_of_52w_high == 1.0
    assert math.isclose(second.daily_return, -0.1) and second.pct_of_52w_high == 0.9
    assert math.isclose(second.rolling_30d_vol_annualized, 0.1414213562 * math.sqrt(252), rel_tol=1e-6)
    total = W.cumulative_return(spark.createDataFrame(fact)).orderBy("price_date").collect()
    assert math.isclose(total[1].cumulative_return, -0.01)


def brute(rows, n, fn):
    return [fn(rows[max(0, i - n + 1): i + 1]) for i in range(len(rows))]


def test_block_extremes_equal_brute_force(walk):
    frames = {"hi": ("max", 252), "lo": ("min", 252), "hi70": ("max", 70), "avg": ("avg", 30)}
    got = W.with_rolling(walk, ["ticker"], "price_date", "close_price", frames)
    for ticker in ("LONG", "MID", "ONE"):
        rows = got.where(F.col("ticker") == ticker).orderBy("price_date").collect()
        closes = [r.close_price for r in rows]
        assert [r.hi for r in rows] == brute(closes, 252, max)
        assert [r.lo for r in rows] == brute(closes, 252, min)
        assert [r.hi70 for r in rows] == brute(closes, 70, max)
        want = brute(closes, 30, lambda x: sum(x) / len(x))
        assert all(math.isclose(r.avg, w) for r, w in zip(rows, want))


def test_segments_give_the_same_result(walk):
    whole = W.price_analytics(walk)
    cut = W.price_analytics(walk, segment_rows=300)
    assert as_set(whole, 9) == as_set(cut, 9)
    plain = W.daily_return(walk, ["ticker"], "price_date", "close_price")
    assert as_set(plain) == as_set(
        W.daily_return(walk, ["ticker"], "price_date", "close_price", segment_rows=7)
    )
    with pytest.raises(ValueError):
        W.price_analytics(walk, segment_rows=100)


def test_cumulative_return_telescopes(walk):
    returns = W.price_analytics(walk)
    total = W.cumulative_return(returns, bucket=F.trunc("price_date", "month"))
    base = walk.groupBy("ticker").agg(F.min_by("close_price", "price_date").alias("base"))
    gap = F.abs(F.col("cumulative_return") - (F.col("close_price") / F.col("base") - 1))
    assert total.join(base, "ticker").agg(F.max(gap)).first()[0] < 1e-6
    assert as_set(total, 8) == as_set(W.cumulative_return(returns), 8)


def test_analytics_take_one_shuffle(walk):
    plan = W.price_analytics(walk)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(ticker") == 1


def test_event_study_hand_case(spark):
    prices = daily_prices(
        spark, [("A", "2024-01-05", 100.0), ("A", "2024-01-08", 103.0), ("A", "2024-01-10", 95.0)]
    )
    study = events.event_study(prices, "volume_at_least", 0).orderBy("event_date").collect()
    assert [r.event_date.day for r in study] == [5, 8]  # the last day has no later row
    assert study[0].d1 is None and math.isclose(study[0].d3, 0.03) and math.isclose(study[0].d5, -0.05)
    assert study[0].d30 is None


def test_event_study_forms_agree(walk):
    prices = W.price_analytics(walk).withColumn("pct_of_52w_high", marts.pct_of_high())
    for kind, x in (("return_up", 5.0), ("return_down", 5.0), ("near_high", 3.0), ("near_low", 3.0),
                    ("volume_spike", 1.5), ("volume_at_least", 500)):
        a = events.event_study(prices, kind, x)
        assert as_set(a, 9) == as_set(events.event_study_by_join(prices, kind, x), 9)
    assert events.event_study(prices, "return_up", 5.0, ["MID"]).select("ticker").distinct().count() == 1
    with pytest.raises(ValueError):
        events.event_study(prices, "nonsense", 1)


def test_event_summary_and_fan(spark):
    study = spark.createDataFrame(
        [(float(i) / 100, None) for i in (1, 2, 4, -3)], "d1 double, d3 double"
    ).withColumns({f"d{d}": F.lit(None).cast("double") for d in (5, 30, 90, 180, 365, 730)})
    row = events.event_summary(study).collect()
    assert len(row) == 1
    r = row[0]
    assert (r.horizon, r.avg_pct, r.median_pct, r.positive_pct, r.best_pct, r.worst_pct) == (
        "1D", 1.0, 1.5, 75.0, 4.0, -3.0)
    fan = events.event_fan(study).first()
    assert math.isclose(fan.p50, 1.5) and math.isclose(fan.p25, 0.0, abs_tol=1e-9)


@pytest.mark.parametrize("accuracy", [3, 50, 10_000])
def test_quantiles_equal_percentile(spark, accuracy):
    rng = random.Random(accuracy)
    rows = [("ties", float(rng.choice([1, 2, 2, 2, 9]))) for _ in range(500)]
    rows += [("wide", rng.gauss(0, 1) ** 5) for _ in range(3000)]
    rows += [("one", 3.0), ("two", 1.0), ("two", 2.0), ("two", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = {"a": 0.0, "b": 0.1, "c": 0.25, "d": 0.5, "e": 0.9, "f": 1.0}
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", probs, accuracy).collect()}
    want = df.groupBy("g").agg(*[F.percentile("v", p).alias(n) for n, p in probs.items()])
    for r in want.collect():
        for name in probs:
            assert math.isclose(got[r.g][name], r[name], rel_tol=1e-9, abs_tol=1e-12), (r.g, name)


def test_asof_join_equals_brute_force(spark):
    rng = random.Random(3)
    when = lambda: D(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 900))
    left = [(k, when(), i) for i, k in enumerate("aab" * 60)]
    right = list({(k, when()): None for k in "ab" * 15})
    right = [(k, d, float(i)) for i, (k, d) in enumerate(right)]
    l = spark.createDataFrame(left, "k string, d date, i int")
    r = spark.createDataFrame(right, "k string, d date, v double")
    got = {x.i: x for x in J.asof_join(l, r, "d", ["k"], ["v"]).collect()}
    assert len(got) == len(left)
    for k, d, i in left:
        known = max(((rd, v) for rk, rd, v in right if rk == k and rd <= d), default=(None, None))
        assert (got[i].d_known, got[i].v) == known


def test_macro_joins(spark):
    prices = daily_prices(spark, [("A", f"2024-01-0{i}", 100.0 + i) for i in range(1, 8)])
    macro = spark.createDataFrame(
        [("S", D(2024, 1, 2), 1.0), ("S", D(2024, 1, 5), -1.0), ("T", D(2024, 1, 1), 9.0)],
        "series_id string, observation_date date, value double",
    )
    assert J.join_macro(prices, macro, "S").count() == 2
    asof = J.join_macro_asof(prices, macro, "S", F.lit("2024-01-31").cast("date"))
    got = [r.macro_value for r in asof.orderBy("price_date").collect()]
    assert got == [None, 1.0, 1.0, 1.0, -1.0, -1.0, -1.0]
    held = questions.return_when_negative(prices, macro, "S", F.lit("2024-01-31").cast("date")).first()
    assert held.days == 3


def test_samples_and_diffs(spark):
    keys = spark.createDataFrame([(f"K{i}",) for i in range(40)], "k string")
    sample = W.hash_sample(keys, "k", 5).collect()
    assert len(sample) == 5 and sample == W.hash_sample(keys.orderBy(F.desc("k")), "k", 5).collect()
    a = spark.createDataFrame([("A", 1.0), ("B", 2.0), ("C", 3.0)], "k string, v double")
    b = spark.createDataFrame([("A", 1.005), ("B", 2.5), ("D", 1.0)], "k string, v double")
    assert [(r.k, r.prior_v, r.v) for r in W.changed_since(a, b, ["k"], "v", 0.01).collect()] == [("B", 2.0, 2.5)]


def test_melt_corr_trend(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 2.0, None), (2, 2.0, 4.1, 1.0), (3, 3.0, 5.9, 5.0)], "x int, a double, b double, c double"
    )
    assert R.melt_series(df, "x").count() == 9
    assert R.melt_series(df, "x", color="a").columns == df.columns
    assert R.melt_series(df, "x", chart="bar").columns == df.columns
    named = df.withColumn("t", F.lit("A"))
    assert R.melt_series(named, "x").columns == named.columns
    corr = {(r.column_a, r.column_b): r.correlation for r in R.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert corr[("a", "a")] == 1.0 and corr[("a", "b")] == corr[("b", "a")] and corr[("b", "c")] > 0.9
    line = R.ols_trend(df, "a", "b").first()
    assert math.isclose(line.slope, 1.95) and line.points == 3
