import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlake import constants as C
from marketlake import schemas as S
from marketlake.plans import warehouse as WH
from marketlake.plans.incremental import build_fact
from marketlake.sources import tables as T
from marketlake.sources.shaping import latest_by
from tests.helpers import NS_DAY, as_set

D = dt.date
START = (D(2024, 1, 1) - D(1970, 1, 1)).days


def price_rows(tickers, first, last, loaded):
    return [
        ((START + n) * NS_DAY, t, 100.0 + n % 7, 1.0, 1.0, 1.0, 10, loaded)
        for t in tickers for n in range(first, last)
    ]


def land(spark, base, name, rows, overwrite=False):
    T.load(spark.createDataFrame(rows, S.RAW[name]), f"{base}/raw/{name}", overwrite)


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("lake"))
    now = dt.datetime(2024, 2, 9)
    land(spark, folder, "prices", price_rows(["A", "B"], 0, 40, 10**9))
    land(spark, folder, "company_info",
         [("A", "Alpha", "Tech", None, 5e9, now), ("B", "Beta", None, None, None, now)])
    land(spark, folder, "macro_indicators",
         [("DFF", "Fed Funds Rate", (START + n) * NS_DAY, 5.0 + n, 10**9) for n in range(40)])
    land(spark, folder, "financial_statements",
         [("A", "income_statement", "annual", (START - 1) * NS_DAY, item, v, (START + 38) * NS_DAY)
          for item, v in (("Total Revenue", 200.0), ("Net Income", 20.0))])
    land(spark, folder, "valuation_metrics",
         [(t, D(2024, 2, 9), *[1.5] * len(C.VALUATION_FIELDS), now) for t in ("A", "B", "ORPHAN")])
    WH.build(spark, folder)
    return folder


def test_marts_are_queryable(spark, base):
    names = WH.register_views(spark, base)
    assert set(S.KEYS) < set(names) and "stg_prices" in names
    row = spark.sql(
        "select sector, count(*) n, round(avg(net_margin), 2) m from fact_daily_prices f "
        "join dim_security using (ticker) left join fact_fundamentals using (ticker) "
        "group by sector order by sector"
    ).collect()
    assert [(r.sector, r.n, r.m) for r in row] == [("Tech", 39, 0.1), ("Unknown", 39, None)]
    assert spark.table("fact_valuation_snapshot").columns == S.FACT_VALUATION_SNAPSHOT
    assert spark.table("fact_valuation_snapshot").first().market_cap == 2


def test_checks_pass_on_clean_data(spark, base):
    found = {name: df for name, df in WH.checks(spark, base, "2024-02-10").items()}
    assert sum(len(v) for v in WH.NOT_NULL.values()) == 35
    assert len(found) == 11 + 3 + 3 + 4 + 4 + 5 + 3 + 3
    assert [name for name, df in found.items() if not df.isEmpty()] == []


def test_second_build_adds_what_changed(spark, base):
    before = WH.stored_marts(spark, base)["fact_daily_prices"].count()
    land(spark, base, "prices", price_rows(["A"], 40, 42, 10**12))
    land(spark, base, "macro_indicators",
         [("DFF", "Fed Funds Rate", (START + n) * NS_DAY, 5.0 + n + (n == 3), 10**9)
          for n in range(41)], overwrite=True)
    written = WH.build(spark, base)
    assert written["fact_daily_prices"] == 2
    assert written["fact_macro_readings"] == 2  # one new day, one restated
    assert written["fact_fundamentals"] == written["fact_valuation_snapshot"] == 0
    marts = WH.stored_marts(spark, base)
    assert marts["fact_daily_prices"].count() == before + 2
    assert marts["fact_macro_readings"].where("value = 9").count() == 2
    kept = {name: as_set(marts[name], 9) for name in S.KEYS}
    WH.build(spark, base, full_refresh=True)
    assert {n: as_set(WH.stored_marts(spark, base)[n], 9) for n in S.KEYS} == kept


def test_late_restated_and_new_history_arrives(spark, tmp_path):
    folder, late = str(tmp_path), 10**13
    land(spark, folder, "prices", price_rows(["A"], 0, 30, 10**9))
    land(spark, folder, "company_info", [(t, t, "Tech", None, 1e9, None) for t in ("A", "N")])
    macro = [("DFF", "Fed", (START + n) * NS_DAY, 5.0, 10**9) for n in range(20)]
    land(spark, folder, "macro_indicators", macro)
    WH.build(spark, folder)
    old = (D(2008, 3, 3) - D(1970, 1, 1)).days
    rows = [((old + n) * NS_DAY, "N", 50.0 + n, 1.0, 1.0, 1.0, 10, late) for n in range(10)]
    land(spark, folder, "prices", rows + [((START + 7) * NS_DAY, "A", 222.0, 1.0, 1.0, 1.0, 10, late)])
    reloaded = [(*r[:4], late) for r in macro] + [("CPI", "Prices", 22_000 * NS_DAY, 1.0, late)]
    land(spark, folder, "macro_indicators", reloaded, overwrite=True)
    written = WH.build(spark, folder)
    marts = WH.stored_marts(spark, folder)
    assert marts["fact_daily_prices"].where("ticker = 'N'").count() == 9
    assert marts["fact_daily_prices"].where("close_price = 222").count() == 1
    assert written["fact_macro_readings"] == 1  # new load times alone change nothing
    kept = as_set(marts["fact_daily_prices"], 9)
    assert all(df.isEmpty() for n, df in WH.checks(spark, folder, "2024-02-01").items() if n.startswith("days"))
    assert WH.build(spark, folder)["fact_daily_prices"] == 0
    WH.build(spark, folder, full_refresh=True)
    assert as_set(WH.stored_marts(spark, folder)["fact_daily_prices"], 9) == kept
    WH.build(spark, folder, full_refresh=True, calendar=("2024-01-01", 366))
    found = WH.checks(spark, folder, "2024-02-01")
    assert found["days stg_prices"].count() == 10 and found["days stg_macro_indicators"].count() == 1


def test_facts_without_data_are_absent_until_loaded(spark, tmp_path):
    folder = str(tmp_path)
    land(spark, folder, "prices", price_rows(["A"], 0, 5, 10**9))
    land(spark, folder, "company_info", [("A", "Alpha", "Tech", None, 5e9, None)])
    written = WH.build(spark, folder)
    assert written["fact_daily_prices"] == 4 and written["fact_fundamentals"] == 0
    assert "fact_fundamentals" not in WH.register_views(spark, folder)
    assert "key fact_daily_prices" in WH.checks(spark, folder, "2024-01-06")
    empty = WH.stored_marts(spark, folder)["fact_daily_prices"].limit(0)
    path = f"{folder}/marts/fact_daily_prices"
    with pytest.raises(ValueError):
        build_fact(spark, path, empty, "fact_daily_prices", full_refresh=True)
    assert WH.stored_marts(spark, folder)["fact_daily_prices"].count() == 4


def test_copies_collapse_before_the_shuffle(spark):
    """A third of all rows on one key: copies are combined map-side."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id"
    )
    picked = latest_by(rows, ["k"], ["id"])
    assert picked.where("k = 0").first().id == 2997 and picked.count() == 2001
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning(k")
