"""Registered queries: name -> (spark, folder) -> DataFrame, over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake import constants as C
from marketlake.functions import scalar as S
from marketlake.functions.predicates import select_events, valid_symbol
from marketlake.operators import aggregates as A
from marketlake.operators import audit
from marketlake.operators import joins as J
from marketlake.operators import merge as M
from marketlake.operators import quality as Q
from marketlake.operators import reshape as R
from marketlake.operators import windows as W
from marketlake.plans import backfill, catalog, events, marts, price_state, questions, staging
from marketlake.sources import shaping
from marketlake.sources.raw import values_df
from marketlake.workload import market as MK

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

AS_OF = "2001-09-01"
SPLIT = "1999-06-30"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *cols: str, places: int = 6) -> DataFrame:
    """Doubles to six places, so that two engines agree to the last digit."""
    return df.withColumns({c: F.round(c, places) for c in cols})


def rounded_all(df: DataFrame) -> DataFrame:
    return rounded(df, *[name for name, kind in df.dtypes if kind == "double"])


def day(text: str):
    return F.lit(text).cast("date")


# ---- sources and shaping ---------------------------------------------------


@query
def observations_from_json(spark, sf):
    shaped = shaping.shape_observations(MK.observation_payloads(spark, sf), "payload")
    return rounded(shaped.drop("extracted_at"), "value")


@query
def prices_wide_to_long(spark, sf):
    wide = MK.wide_prices(spark, sf)
    return rounded_all(shaping.wide_prices_to_long(wide, MK.PRIORITIES).drop("extracted_at"))


@query
def statement_unpivot_eav(spark, sf):
    matrix = MK.statement_matrix(spark, sf, "annual")
    long = shaping.statement_to_eav(matrix, F.col("ticker"), "income_statement", "annual")
    return rounded(long.drop("extracted_at"), "value", places=2)


@query
def statements_union(spark, sf):
    matrices = {freq: MK.statement_matrix(spark, sf, freq) for freq in C.FREQUENCIES}
    items = dict(zip(C.STATEMENT_TYPES, (C.INCOME_ITEMS, C.BALANCE_ITEMS, C.CASH_FLOW_ITEMS)))
    parts = {
        (kind, freq): matrices[freq].where(F.col("line_item").isin(list(items[kind])))
        for kind in C.STATEMENT_TYPES
        for freq in C.FREQUENCIES
    }
    return rounded(shaping.union_statements(parts).drop("extracted_at"), "value", places=2)


@query
def valuation_left_fill(spark, sf):
    newest = questions.latest_snapshot(MK.raw_valuations(spark, sf)).drop("snapshot_date")
    universe = MK.companies(spark, sf).select("ticker")
    return rounded_all(shaping.valuation_rows(universe, newest, dt.date(2024, 3, 1)))


@query
def company_left_fill(spark, sf):
    universe = MK.raw_valuations(spark, sf).select("ticker").distinct()
    return rounded(shaping.company_rows(universe, MK.raw_companies(spark, sf)), "market_cap", places=2)


@query
def sentinel_to_null(spark, sf):
    raw = MK.raw_valuations(spark, sf).select("ticker", "snapshot_date", "trailingPE", "forwardPE")
    return rounded_all(S.null_sentinels(raw, ["trailingPE", "forwardPE"]))


def _symbols(spark, sf):
    text = F.concat(F.upper(F.substring("c_mktsegment", 1, 3)), F.lit("."), F.col("c_custkey").cast("string"))
    return MK.table(spark, sf, "customer").select("c_custkey", text.alias("raw_symbol"))


@query
def symbol_normalize(spark, sf):
    return _symbols(spark, sf).withColumn("symbol", S.normalize_symbol("raw_symbol"))


@query
def symbol_valid(spark, sf):
    return _symbols(spark, sf).withColumns(
        {"raw_ok": valid_symbol("raw_symbol"), "ok": valid_symbol(S.normalize_symbol("raw_symbol"))}
    )


def _listed(df, index_sql):
    """Distinct symbols of a table with their place in its list."""
    indices = df.select(F.expr(index_sql).alias("pos")).distinct()
    return indices.select(MK.ticker("pos").alias("ticker"), "pos")


@query
def universe_ordered_union(spark, sf):
    a = _listed(MK.table(spark, sf, "orders"), "o_custkey div 100")
    b = _listed(MK.table(spark, sf, "part"), "p_partkey div 133")
    return shaping.ordered_distinct_union(a, b, "ticker")


def _funds(spark, sf):
    """Securities without a size stand for funds."""
    return MK.companies(spark, sf).where(F.col("market_cap_usd").isNull()).select("ticker")


@query
def equities_left_anti(spark, sf):
    kept = shaping.exclude_keys(MK.closes(spark, sf), _funds(spark, sf), "ticker")
    return rounded(kept.select("ticker", "price_date", "close_price"), "close_price")


@query
def members_left_semi(spark, sf):
    inside, _ = shaping.split_by_membership(MK.closes(spark, sf), _funds(spark, sf), "ticker")
    return rounded(inside.select("ticker", "price_date", "close_price"), "close_price")


def _quotes(spark, sf):
    return rounded(MK.closes(spark, sf).select("ticker", "price_date", "close_price"), "close_price")


@query
def range_explicit(spark, sf):
    return shaping.select_range(_quotes(spark, sf), "price_date", "1997-01-01", "1998-01-01")


@query
def range_after_max(spark, sf):
    return shaping.select_range(
        _quotes(spark, sf), "price_date", after=dt.date(2001, 3, 31), as_of=AS_OF
    )


@query
def range_lookback(spark, sf):
    return shaping.select_range(_quotes(spark, sf), "price_date", lookback_days=365, as_of=AS_OF)


@query
def series_union_all(spark, sf):
    raw = MK.observations(spark, sf).select("series_id", "day", "value")
    frames = [raw.where(F.col("series_id") == s) for s in MK.SERIES.values()]
    return rounded(shaping.concat(frames), "value")


@query
def date_spine(spark, sf):
    """Every calendar day with the number of price rows on it."""
    spine = MK.calendar(spark).select("date_key")
    per_day = MK.closes(spark, sf).groupBy("price_date").agg(F.count("*").alias("n"))
    return spine.join(per_day, F.col("date_key") == F.col("price_date"), "left").select(
        "date_key", F.coalesce("n", F.lit(0)).alias("price_rows")
    )


# ---- incremental -----------------------------------------------------------


@query
def highwater_max_date(spark, sf):
    return M.high_water(MK.price_days(spark, sf), "price_date")


@query
def lowwater_min_date(spark, sf):
    return M.low_water(MK.price_days(spark, sf), "price_date")


@query
def incremental_new_rows(spark, sf):
    rows = _quotes(spark, sf)
    return M.incremental_rows(rows, rows.where(F.col("price_date") <= day(SPLIT)), "price_date")


@query
def incremental_changed_rows(spark, sf):
    """Upsert scope: rows new or restated by key, whatever their day."""
    rows = _quotes(spark, sf)
    restated = F.dayofmonth("price_date") == 15
    old = rows.where(F.col("price_date") <= day(SPLIT)).withColumn(
        "close_price", F.when(restated, F.col("close_price") - 1).otherwise(F.col("close_price"))
    )
    return M.incremental_rows(rows, old, "price_date", "upsert", ["ticker", "price_date"])


@query
def merge_upsert(spark, sf):
    rows = _quotes(spark, sf)
    tgt = rows.where(F.col("price_date") <= day(SPLIT))
    src = rows.where(F.col("price_date") >= day("1999-01-01")).withColumn(
        "close_price", F.col("close_price") * 2
    )
    return M.merge_by_key(tgt, src, ["ticker", "price_date"])


@query
def schema_sync_union(spark, sf):
    """An old target (one column gone since, one not there yet) beside new rows."""
    rows = MK.closes(spark, sf)
    old = rows.where(F.col("price_date") <= day(SPLIT)).select(
        "ticker", "price_date", "close_price", F.col("extracted_at").alias("retired")
    )
    new = rows.where(F.col("price_date") > day(SPLIT)).select(
        "ticker", "price_date", "close_price", "volume"
    )
    return rounded(M.sync_columns(old, new.schema).unionByName(new), "close_price")


@query
def backfill_window(spark, sf):
    rows = _quotes(spark, sf)
    tgt = rows.where(F.col("price_date") >= day("1997-01-01"))
    return M.backfill_rows(rows, tgt, "ticker", "price_date", "1995-06-01")


GAPS_FROM = "1994-12-01"


def _market_gaps(spark, sf, prices):
    days = backfill.market_days(spark, prices, GAPS_FROM)
    return backfill.gaps(prices, days, MK.companies(spark, sf))


@query
def price_gaps(spark, sf):
    """Runs of market days that each known ticker lacks."""
    return _market_gaps(spark, sf, MK.price_days(spark, sf))


@query
def backfill_landed(spark, sf):
    """What a source has in the gaps, where a quarter of most tickers is missing."""
    rows = _quotes(spark, sf)
    hole = F.col("price_date").between("1997-03-01", "1997-05-31") & (F.col("ticker") != "C0")
    return backfill.in_gaps(rows, "price_date", _market_gaps(spark, sf, rows.where(~hole)))


@query
def price_tails(spark, sf):
    tails = price_state.tails(MK.closes(spark, sf))
    points = tails.select("ticker", "first_day", "last_day", F.inline("tail"))
    return points.groupBy("ticker", "first_day", "last_day").agg(
        F.count("*").alias("rows_kept"), F.min("price_date").alias("kept_from"),
        F.round(F.sum(F.col("close_price").cast("decimal(20,6)")).cast("double"), 4).alias("close_sum"),
    )


@query
def tail_refresh(spark, sf):
    """Rows to merge when the second half lands along with late days of the first."""
    raw = MK.raw_prices(spark, sf)
    day_of = S.ns_to_date("date")
    late = (F.dayofmonth(day_of) == 15) & (F.year(day_of) == 1998)
    lands = (day_of > day(SPLIT)) | late
    old = price_state.tails(price_state.closes_of(raw.where(~lands)))
    returns, _ = price_state.refresh(raw, raw.where(lands), old)
    return rounded_all(returns)


# ---- scalars ---------------------------------------------------------------


@query
def ns_epoch_to_date(spark, sf):
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    return MK.table(spark, sf, "events").select(
        "event_id",
        S.ns_to_date(micros * 1000).alias("day"),
        S.ns_to_ts(micros * 1000).alias("at"),
        S.ns_to_date(-micros * 1000).alias("mirrored_day"),
    )


@query
def cast_bigint_round(spark, sf):
    halves = F.floor(F.col("value") * 2) / 2
    return MK.table(spark, sf, "events").select(
        "event_id",
        S.to_bigint(halves).alias("rounded"),
        S.to_bigint(-halves).alias("rounded_negative"),
    )


@query
def coalesce_unknown(spark, sf):
    return MK.companies(spark, sf).select("ticker", "company_name", "sector", "industry", "market_cap_usd")


@query
def safe_ratio(spark, sf):
    ratio = S.safe_div("l_extendedprice", F.col("l_discount"))
    return MK.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(ratio, 4).alias("ratio")
    )


@query
def derived_margins(spark, sf):
    wide = marts.int_fundamentals_pivoted(MK.statements(spark, sf))
    return rounded(
        wide.select("ticker", "period_end_date", "frequency", *C.MARGINS), *C.MARGINS
    )


@query
def dim_date(spark, sf):
    """The calendar with every attribute, and the price rows of each day."""
    per_day = MK.closes(spark, sf).groupBy("price_date").agg(F.count("*").alias("n"))
    days = MK.calendar(spark).join(per_day, F.col("date_key") == F.col("price_date"), "left")
    return days.withColumn("price_rows", F.coalesce("n", F.lit(0))).drop("price_date", "n")


@query
def hash_sample_topn(spark, sf):
    """Five hash-picked securities, with their rows of one fixed month."""
    sample = W.hash_sample(MK.companies(spark, sf), "ticker", 5)
    d = F.col("price_date")
    month = _quotes(spark, sf).where((d >= day("1998-06-01")) & (d < day("1998-07-01")))
    return month.join(F.broadcast(sample), "ticker")


@query
def display_format(spark, sf):
    return catalog.display_securities(MK.security(spark, sf))


@query
def display_series(spark, sf):
    return catalog.display_series(catalog.series_catalog(MK.fact_macro(spark, sf)))


@query
def series_category(spark, sf):
    series = catalog.series_catalog(MK.fact_macro(spark, sf))
    return catalog.with_category(series).select("series_id", "series_name", "category")


# ---- staging ---------------------------------------------------------------


@query
def stg_prices(spark, sf):
    return rounded_all(MK.prices(spark, sf))


@query
def stg_macro(spark, sf):
    return rounded_all(MK.macro(spark, sf))


@query
def stg_statements(spark, sf):
    return rounded(MK.statements(spark, sf), "value", places=2)


@query
def stg_valuations(spark, sf):
    return rounded_all(MK.valuations(spark, sf))


# ---- dimensions and facts --------------------------------------------------


@query
def dim_security(spark, sf):
    return MK.security(spark, sf)


@query
def fact_daily_prices(spark, sf):
    return rounded_all(MK.fact_prices(spark, sf))


@query
def fact_macro(spark, sf):
    return rounded(MK.fact_macro(spark, sf), "value")


@query
def fundamentals_pivot(spark, sf):
    return rounded_all(marts.int_fundamentals_pivoted(MK.statements(spark, sf)))


@query
def fact_fundamentals(spark, sf):
    return rounded_all(MK.fact_fundamentals(spark, sf))


@query
def fact_valuation(spark, sf):
    return rounded_all(MK.fact_valuations(spark, sf))


# ---- windows ---------------------------------------------------------------


@query
def daily_returns(spark, sf):
    returns = W.daily_return(_quotes(spark, sf), ["ticker"], "price_date", "close_price")
    return rounded(returns, "daily_return")


@query
def rolling_52w_high_low(spark, sf):
    frames = {"week_52_high": ("max", C.TRADING_DAYS), "week_52_low": ("min", C.TRADING_DAYS)}
    return W.with_rolling(_quotes(spark, sf), ["ticker"], "price_date", "close_price", frames)


@query
def rolling_vol_annualized(spark, sf):
    return rounded_all(questions.volatility(MK.fact_prices(spark, sf)))


@query
def moving_average(spark, sf):
    """Computed over segments of each series rather than whole series."""
    frames = {"moving_avg_30d": ("avg", 30)}
    closes = MK.closes(spark, sf).select("ticker", "price_date", "close_price")
    averaged = W.with_rolling(
        closes, ["ticker"], "price_date", "close_price", frames, segment_rows=512
    )
    return rounded_all(averaged)


@query
def cumulative_return(spark, sf):
    fact = MK.fact_prices(spark, sf)
    return rounded_all(questions.compare_cumulative(fact, day("2001-08-01")))


@query
def cumulative_return_full(spark, sf):
    """Whole history, summed per year first and carried over between years."""
    kept = MK.fact_prices(spark, sf).select("ticker", "price_date", "daily_return")
    year = F.trunc("price_date", "year")
    return rounded_all(W.cumulative_return(kept, bucket=year).drop("daily_return"))


@query
def snapshot_diff(spark, sf):
    """First-loaded against last-loaded close of each ticker and day."""
    loads = MK.closes(spark, sf).select("ticker", "price_date", "close_price")
    first = _every_copy(spark, sf).groupBy("ticker", "price_date").agg(
        F.min_by("close_price", "extracted_at").alias("close_price")
    )
    return rounded_all(
        W.changed_since(first, loads, ["ticker", "price_date"], "close_price", 0.01)
    )


def _every_copy(spark, sf):
    """Every copy of every price row, before de-duplication."""
    return staging.stg_prices(MK.raw_prices(spark, sf), dedupe=False)


# ---- events ----------------------------------------------------------------


def _events(kind, x):
    def run(spark, sf):
        hits = select_events(MK.fact_prices(spark, sf), kind, x)
        return rounded_all(hits.select("ticker", "price_date", "daily_return", "close_price", "volume"))

    return run


EVENT_KINDS = {
    "event_up": ("return_up", 20.0),
    "event_down": ("return_down", 20.0),
    "event_near_high": ("near_high", 5.0),
    "event_near_low": ("near_low", 5.0),
    "event_volume_spike": ("volume_spike", 1.8),
    "event_volume_at_least": ("volume_at_least", 900.0),
}
for _name, _args in EVENT_KINDS.items():
    QUERIES[_name] = _events(*_args)


@query
def event_forward_range_join(spark, sf):
    return rounded_all(events.forward_range(MK.fact_prices(spark, sf), "return_up", 20.0))


@query
def event_forward_equi(spark, sf):
    return rounded_all(events.event_study_by_join(MK.fact_prices(spark, sf), "return_up", 20.0))


def _study(spark, sf):
    return events.event_study(MK.fact_prices(spark, sf), "return_up", 20.0)


@query
def event_study(spark, sf):
    return rounded_all(_study(spark, sf))


@query
def event_summary(spark, sf):
    return events.event_summary(_study(spark, sf))


@query
def event_fan(spark, sf):
    return rounded_all(events.event_fan(_study(spark, sf)))


# ---- joins -----------------------------------------------------------------


@query
def macro_same_day(spark, sf):
    beside = questions.returns_beside_macro(MK.fact_prices(spark, sf), MK.fact_macro(spark, sf), "DFF")
    return rounded_all(beside)


@query
def macro_asof(spark, sf):
    fact = MK.fact_prices(spark, sf).select("ticker", "price_date", "daily_return")
    known = J.join_macro_asof(fact, MK.fact_macro(spark, sf), "CPIAUCSL", day(AS_OF))
    return rounded_all(known)


@query
def asof_by_key(spark, sf):
    """Each price row with the last annual or quarterly revenue known by its day."""
    quotes = MK.closes(spark, sf).select("ticker", "price_date", "close_price")
    periods = MK.fact_fundamentals(spark, sf).where(F.col("frequency") == "quarterly").select(
        "ticker", F.col("period_end_date").alias("price_date"), "total_revenue"
    )
    joined = J.asof_join(quotes, periods, "price_date", ["ticker"], ["total_revenue"])
    return rounded_all(joined)


# ---- aggregates, catalogue -------------------------------------------------


@query
def series_catalog(spark, sf):
    return catalog.series_catalog(MK.fact_macro(spark, sf))


@query
def summary_stats(spark, sf):
    return catalog.summary_stats(
        spark, MK.fact_prices(spark, sf), MK.fact_macro(spark, sf), MK.fact_fundamentals(spark, sf)
    )


@query
def counts_by_category(spark, sf):
    securities = A.counts_by(MK.companies(spark, sf), "sector")
    series = A.counts_by(catalog.with_category(catalog.series_catalog(MK.fact_macro(spark, sf))), "category")
    tag = lambda df, kind, col: df.select(F.lit(kind).alias("kind"), F.col(col).alias("label"), "n")
    return tag(securities, "sector", "sector").unionByName(tag(series, "category", "category"))


@query
def distinct_sorted(spark, sf):
    return A.distinct_values(MK.companies(spark, sf), "industry")


@query
def statements_profile(spark, sf):
    return catalog.profile_statements(MK.statements(spark, sf))


@query
def statement_counts(spark, sf):
    return catalog.statement_counts(MK.statements(spark, sf))


@query
def non_null_profile(spark, sf):
    return A.non_null_profile(MK.valuations(spark, sf), list(C.VALUATION_FIELDS.values()))


@query
def null_counts_per_row(spark, sf):
    fields = list(C.VALUATION_FIELDS.values())
    return A.null_counts_per_row(MK.valuations(spark, sf), ["ticker", "snapshot_date"], fields)


@query
def melt_series(spark, sf):
    """Daily highest and lowest close of the market as two chart series."""
    market = MK.closes(spark, sf).groupBy("price_date").agg(
        F.max("close_price").alias("top_close"), F.min("close_price").alias("low_close")
    )
    return rounded(R.melt_series(market, "price_date"), "value")


@query
def corr_matrix(spark, sf):
    cols = ["close_price", "volume", "daily_return", "rolling_30d_vol_annualized"]
    return rounded_all(R.corr_matrix(MK.fact_prices(spark, sf), cols))


@query
def ols_trend(spark, sf):
    points = MK.closes(spark, sf).select(
        "ticker", F.datediff("price_date", day("1995-01-01")).alias("x"), "close_price"
    )
    return rounded_all(R.ols_trend(points, "x", "close_price", ["ticker"]))


@query
def security_list(spark, sf):
    return catalog.security_list(MK.security(spark, sf))


@query
def catalog_search(spark, sf):
    return catalog.find_securities(MK.companies(spark, sf), "a").drop("extracted_at")


@query
def series_search(spark, sf):
    series = catalog.series_catalog(MK.fact_macro(spark, sf))
    return catalog.find_series(series, "rate").select("series_id", "series_name", "category")


@query
def market_cap_buckets(spark, sf):
    sized = MK.companies(spark, sf).select("ticker", "market_cap_usd", S.size_bucket("market_cap_usd").alias("bucket"))
    return sized


@query
def topk_metric(spark, sf):
    return rounded_all(questions.top_growth(MK.fact_valuations(spark, sf)))


# ---- quality ---------------------------------------------------------------


@query
def dq_not_null(spark, sf):
    checked = {
        "prices": MK.raw_prices(spark, sf).select("ticker", "date", "close", "volume"),
        "statements": MK.raw_statements(spark, sf).select("ticker", "line_item", "value"),
        "macro": MK.raw_macro(spark, sf).select("series_id", "date", "value"),
    }
    return shaping.concat(
        [
            Q.null_counts(df, df.columns).withColumn("table_name", F.lit(name))
            for name, df in checked.items()
        ]
    )


@query
def dq_unique(spark, sf):
    return Q.expect_unique(MK.raw_prices(spark, sf), "ticker")


@query
def pk_duplicates(spark, sf):
    return Q.expect_key(MK.raw_prices(spark, sf), ["ticker", "date"])


@query
def dq_accepted_values(spark, sf):
    return Q.expect_in(MK.table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query
def dq_orphans(spark, sf):
    orphans = Q.expect_fk(MK.valuations(spark, sf), MK.companies(spark, sf), "ticker")
    return orphans.select("ticker", "snapshot_date")


@query
def freshness(spark, sf):
    checks = [
        ("prices", MK.price_days(spark, sf), "price_date", 3, AS_OF),
        ("macro", MK.macro(spark, sf), "observation_date", 5, "2001-07-28"),
        ("valuations", MK.valuations(spark, sf), "snapshot_date", 3, "2024-03-01"),
        ("statements", MK.statements(spark, sf), "extracted_at", 10, "2024-02-01"),
    ]
    return shaping.concat(
        [
            Q.expect_fresh(df, col, limit, as_of)
            .withColumnRenamed(f"latest_{col}", "latest")
            .withColumn("table_name", F.lit(name))
            for name, df, col, limit, as_of in checks
        ]
    )


@query
def dq_future(spark, sf):
    late = Q.expect_not_future(MK.closes(spark, sf), "price_date", "2001-06-30")
    return late.select("ticker", "price_date")


@query
def dq_bounds(spark, sf):
    """All range rules, one pass over each fact."""
    daily = Q.range_violations(
        MK.fact_prices(spark, sf),
        ["ticker", "price_date"],
        {
            "close > 0": ("close_price", 0, None, True),
            "volume >= 0": ("volume", 0, None, False),
            "return in bounds": ("daily_return", -0.5, 0.5, False),
        },
    )
    periods = Q.range_violations(
        MK.fact_fundamentals(spark, sf),
        ["ticker", "period_end_date"],
        {
            "revenue >= 0": ("total_revenue", 0, None, False),
            "assets >= 0": ("total_assets", 0, None, False),
        },
    )
    both = daily.withColumnRenamed("price_date", "day").unionByName(
        periods.withColumnRenamed("period_end_date", "day")
    )
    return rounded(both, "value")


@query
def coverage_by_key(spark, sf):
    excluded = values_df(spark, [(t,) for t in [*C.COVERAGE_EXCLUSIONS, "C0"]], "ticker string")
    return Q.coverage_lag(MK.fact_prices(spark, sf), "ticker", "price_date", 5, excluded)


def _price_rules(spark, sf):
    f = F.col
    return audit.Rules(
        rows={
            "values": f("close_price").isNull() | f("daily_return").isNull(),
            "close > 0": Q.outside(f("close_price"), 0, None, True),
            "return in bounds": Q.outside(f("daily_return"), -0.05, 0.05),
            "future": f("price_date") > F.lit("2001-06-30").cast("date"),
        },
        known={"orphans": ("ticker", MK.valuations(spark, sf).select("ticker"))},
        unique=("key", ["ticker", "price_date"]),
        fresh={"fresh": audit.Fresh("price_date", 3, AS_OF)},
        coverage=("coverage", audit.Coverage("ticker", "price_date", 5, [*C.COVERAGE_EXCLUSIONS, "C0"])),
    )


@query
def audit_tables(spark, sf):
    """All rules of the price fact, of raw prices and of macro readings, each table read once."""
    f = F.col
    raw = audit.Rules(
        rows={
            "raw values": f("close").isNull() | f("volume").isNull(),
            "raw close": Q.outside(f("close"), 1000, 100000),
        },
        unique=("raw key", ["ticker", "date"]),
    )
    macro = audit.Rules(
        rows={"macro values": f("value").isNull(), "macro range": Q.outside(f("value"), 0, None)},
        fresh={"macro fresh": audit.Fresh("observation_date", 5, "2001-07-28")},
    )
    return audit.broken_in_all([
        (MK.fact_prices(spark, sf), _price_rules(spark, sf)),
        (MK.raw_prices(spark, sf), raw),
        (MK.macro(spark, sf), macro),
    ])


@query
def baseline_tolerance(spark, sf):
    """Every close against a baseline that is off for some rows and unset for some."""
    facts = MK.closes(spark, sf).select("ticker", "price_date", "close_price", "volume")
    shift = F.when(F.col("volume") % 10 == 1, F.lit(0.02)).otherwise(F.lit(0.001))
    base = facts.select(
        "ticker",
        "price_date",
        F.when(F.col("volume") % 7 != 0, F.col("close_price") + shift).alias("expected_close_price"),
    )
    moved = Q.anchors_changed(
        facts, base, ["ticker", "price_date"], {"close_price": ("absolute", 0.01)}
    )
    delta = F.abs(F.col("close_price") - F.col("expected_close_price"))
    return rounded_all(moved.withColumn("delta", delta))


@query
def baseline_tolerance_rel(spark, sf):
    facts = MK.fact_fundamentals(spark, sf)
    month = F.month("period_end_date")
    base = facts.select(
        "ticker", "period_end_date", "frequency",
        F.when(month != 3, F.col("total_revenue") * F.when(month == 6, 1.002).otherwise(1.0005))
        .alias("expected_total_revenue"),
        (F.col("net_income") * F.when(month == 9, 0.99).otherwise(1.0)).alias("expected_net_income"),
        (F.col("diluted_eps") + F.when(F.year("period_end_date") == 1999, 0.05).otherwise(0.0))
        .alias("expected_diluted_eps"),
    )
    tolerances = {
        "total_revenue": ("relative", 0.001),
        "net_income": ("relative", 0.001),
        "diluted_eps": ("absolute", 0.01),
    }
    keys = ["ticker", "period_end_date", "frequency"]
    return rounded_all(Q.anchors_changed(facts, base, keys, tolerances))


# ---- analyst questions -----------------------------------------------------


@query
def sector_avg_return(spark, sf):
    averages = questions.sector_avg_return(
        MK.fact_prices(spark, sf), MK.companies(spark, sf), day("2001-08-01")
    )
    return rounded_all(averages)


@query
def near_high_topk(spark, sf):
    return rounded_all(questions.near_high(MK.fact_prices(spark, sf)))


@query
def return_when_macro_negative(spark, sf):
    held = questions.return_when_negative(
        MK.fact_prices(spark, sf), MK.fact_macro(spark, sf), "T10Y2Y", day(AS_OF)
    )
    return rounded(held, "compounded_return", places=3)


@query
def fundamental_trend(spark, sf):
    trend = questions.fundamental_trend(
        MK.fact_fundamentals(spark, sf), ["total_revenue", "net_income"], day("2001-12-31")
    )
    return rounded_all(trend)


@query
def return_on_equity(spark, sf):
    return rounded_all(questions.return_on_equity(MK.fact_fundamentals(spark, sf)))


@query
def lowest_ratio_topk(spark, sf):
    return rounded_all(questions.lowest_ratio(MK.fact_valuations(spark, sf), _funds(spark, sf)))


@query
def margin_compare(spark, sf):
    return rounded_all(questions.margin_compare(MK.fact_fundamentals(spark, sf)))


@query
def fcf_yield_topk(spark, sf):
    return rounded_all(questions.fcf_yield(MK.fact_valuations(spark, sf)))


@query
def industry_compare(spark, sf):
    return rounded_all(
        questions.industry_compare(MK.fact_valuations(spark, sf), MK.companies(spark, sf))
    )


@query
def ratio_low_date(spark, sf):
    return rounded_all(questions.ratio_low(MK.fact_valuations(spark, sf), day("2024-03-01")))


@query
def baseline_extract(spark, sf):
    return questions.baseline_extract(MK.fact_prices(spark, sf))


@query
def fundamentals_baseline(spark, sf):
    return questions.fundamentals_baseline(MK.fact_fundamentals(spark, sf))
