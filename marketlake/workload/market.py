"""The market tables, derived by Spark from the given Parquet tables.

orders -> RAW prices (one row per order; a block of 100 customers is a ticker, so
tickers grow with the data), customer -> companies, lineitem -> statements, part ->
valuations, events -> macro readings. Layers above them come from the library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake import constants as C
from marketlake.functions.scalar import date_to_ns
from marketlake.plans import marts, staging
from marketlake.sources.shaping import macro_names

CALENDAR = ("1995-01-01", 2800)
LOAD_NS = 1_700_000_000_000_000_000
LOADED = "2024-02-01 06:00:00"
# event type -> macro series; the last one is in no catalogue
SERIES = {
    "click": "DFF", "view": "CPIAUCSL", "purchase": "T10Y2Y", "signup": "UNRATE", "error": "XNEW",
}
PERIOD_YEARS = list(range(1995, 2002))
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ticker(index_sql: str):
    return F.concat(F.lit("C"), F.expr(index_sql).cast("string"))


def loaded_at():
    return F.lit(LOADED).cast("timestamp_ntz")


def raw_prices(spark, sf):
    price = F.lit(1000) + F.col("o_totalprice") / 717
    return table(spark, sf, "orders").select(
        date_to_ns("o_orderdate").alias("date"),
        ticker("o_custkey div 100").alias("ticker"),
        F.when(F.col("o_orderkey") % 97 != 0, price).alias("close"),
        (price * 1.01).alias("high"),
        (price * 0.99).alias("low"),
        (price * 0.995).alias("open"),
        (F.col("o_orderkey") * 7919 % 1000).alias("volume"),
        (F.lit(LOAD_NS) + F.col("o_orderkey") * 1_000_000_000).alias("extracted_at"),
    )


def raw_companies(spark, sf):
    """Sizes spread over four magnitudes; some sectors, industries, sizes missing."""
    blocks = (
        table(spark, sf, "customer")
        .groupBy(F.expr("c_custkey div 100").alias("i"))
        .agg(
            F.max_by("c_nationkey", "c_custkey").alias("n_nationkey"),
            F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"),
        )
    )
    places = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    scale = F.element_at(F.array(*[F.lit(10.0**k) for k in (3, 4, 5, 6)]),
                         (F.col("i") % 4 + 1).cast("int"))
    return blocks.join(F.broadcast(places), "n_nationkey").select(
        ticker("i").alias("ticker"),
        F.concat(F.lit("Company "), F.col("i").cast("string")).alias("company_name"),
        F.when(F.col("i") % 7 != 0, F.col("r_name")).alias("sector"),
        F.when(F.col("i") % 5 != 0, F.col("n_name")).alias("industry"),
        F.when(F.col("i") % 6 != 0, F.col("balance") * scale).alias("market_cap"),
        loaded_at().alias("extracted_at"),
    )


def _line_cells(spark, sf):
    """lineitem reduced to supplier block x quarter x line item."""
    ship = F.col("l_shipdate").cast("date")
    return (
        table(spark, sf, "lineitem")
        .groupBy(
            F.expr("l_suppkey div 7").alias("i"),
            F.trunc(ship, "quarter").alias("q"),
            (F.col("l_partkey") % len(C.LINE_ITEMS)).cast("int").alias("item"),
        )
        .agg(
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("amount"),
            F.count("*").alias("n"),
        )
    )


def line_item(index):
    return F.element_at(F.array(*[F.lit(name) for name in C.LINE_ITEMS]), index + 1)


def statement_type(index):
    first, second = len(C.INCOME_ITEMS), len(C.INCOME_ITEMS) + len(C.BALANCE_ITEMS)
    kinds = C.STATEMENT_TYPES
    return F.when(index < first, kinds[0]).when(index < second, kinds[1]).otherwise(kinds[2])


def raw_statements(spark, sf):
    quarters = _line_cells(spark, sf).select(
        "i", F.last_day(F.add_months("q", 2)).alias("period"), "item", "amount", "n"
    )
    years = quarters.groupBy(
        "i", F.make_date(F.year("period"), F.lit(12), F.lit(31)).alias("period"), "item"
    ).agg(F.sum("amount").alias("amount"), F.sum("n").alias("n"))

    def shaped(cells, frequency):
        return cells.select(
            ticker("i").alias("ticker"),
            statement_type(F.col("item")).alias("statement_type"),
            F.lit(frequency).alias("frequency"),
            date_to_ns("period").alias("period_end_date"),
            line_item(F.col("item")).alias("line_item"),
            F.when(F.col("n") % 5 != 0, F.col("amount").cast("double")).alias("value"),
            F.lit(LOAD_NS).alias("extracted_at"),
        )

    return shaped(quarters, "quarterly").unionByName(shaped(years, "annual"))


def raw_valuations(spark, sf):
    cells = (
        table(spark, sf, "part")
        .groupBy(F.expr("p_partkey div 133").alias("i"), "p_size")
        .agg(
            F.max("p_retailprice").alias("hi"),
            F.min("p_retailprice").alias("lo"),
            F.count("*").alias("n"),
            F.sum(F.col("p_retailprice").cast("decimal(18,2)")).cast("double").alias("total"),
        )
    )
    hi, lo, n = F.col("hi"), F.col("lo"), F.col("n")
    fields = {name: hi / (k + 2) for k, name in enumerate(C.VALUATION_RATIOS)}
    fields |= {
        name: F.col("total") * (1000 * (k + 1)) + 0.5 for k, name in enumerate(C.VALUATION_AMOUNTS)
    }
    fields |= {
        "beta": lo / 1000,
        "trailingPE": F.when(n % 4 == 0, F.lit(1e19)).otherwise(hi / 50),
        "revenueGrowth": F.sqrt((hi - lo) / hi),
        "debtToEquity": F.when(n % 3 != 0, F.sqrt(hi / lo)),
        "freeCashflow": (hi - 1000) * 1e6,
    }
    return cells.select(
        ticker("i").alias("ticker"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")).alias("snapshot_date"),
        *[fields[name].alias(name) for name in C.VALUATION_FIELDS],
        loaded_at().alias("extracted_at"),
    )


def observations(spark, sf):
    """events as (series, day, value): five series, one of them monthly."""
    kind = F.col("event_type")
    day = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("event_id") % 2404).cast("int"))
    series = F.create_map(*[F.lit(x) for pair in SERIES.items() for x in pair])[kind]
    return table(spark, sf, "events").select(
        "event_id",
        series.alias("series_id"),
        F.when(kind == "view", F.trunc(day, "month")).otherwise(day).alias("day"),
        (F.col("value") - 50).alias("value"),
    )


def raw_macro(spark, sf):
    daily = observations(spark, sf).groupBy("series_id", "day").agg(
        F.max_by("value", "event_id").alias("value"), F.max("event_id").alias("event_id")
    )
    return daily.join(F.broadcast(macro_names(spark)), "series_id", "left").select(
        "series_id",
        F.coalesce("name", "series_id").alias("series_name"),
        date_to_ns("day").alias("date"),
        F.when(F.col("event_id") % 13 != 0, F.col("value")).alias("value"),
        (F.lit(LOAD_NS) + F.col("event_id") * 1_000_000_000).alias("extracted_at"),
    )


def observation_payloads(spark, sf):
    """JSON payloads of at most 100 observations each; "." for every seventh."""
    obs = F.struct(
        F.date_format("day", "yyyy-MM-dd").alias("date"),
        F.when(F.col("event_id") % 7 == 0, ".").otherwise(F.col("value").cast("string")).alias("value"),
    )
    return (
        observations(spark, sf)
        .groupBy("series_id", F.expr("event_id div 100").alias("page"))
        .agg(F.to_json(F.struct(F.collect_list(obs).alias("observations"))).alias("payload"))
    )


def wide_prices(spark, sf):
    """Price matrix by day: five order priorities as tickers, five fields each."""
    day = F.col("o_orderdate").cast("date")
    price = F.col("o_totalprice")
    fields = {"close": F.max, "high": F.max, "low": F.min, "open": F.min, "volume": F.count}
    cells = [
        fn(F.when(F.col("o_orderpriority") == p, price)).alias(f"{p}|{name}")
        for p in PRIORITIES
        for name, fn in fields.items()
    ]
    return table(spark, sf, "orders").groupBy(day.alias("date")).agg(*cells)


def statement_matrix(spark, sf, frequency):
    """Statement matrix: line items by period columns, for every ticker."""
    cells = _line_cells(spark, sf)
    if frequency == "annual":
        period = F.make_date(F.year("q"), F.lit(12), F.lit(31))
        periods = [f"{y}-12-31" for y in PERIOD_YEARS]
    else:
        period = F.last_day(F.add_months("q", 2))
        ends = ("03-31", "06-30", "09-30", "12-31")
        periods = [f"{y}-{e}" for y in PERIOD_YEARS for e in ends]
    amount = {
        p: F.sum(F.when(period == F.lit(p).cast("date"), F.col("amount"))).cast("double").alias(p)
        for p in periods
    }
    return (
        cells.groupBy("i", "item")
        .agg(*amount.values())
        .select(ticker("i").alias("ticker"), line_item(F.col("item")).alias("line_item"), *periods)
    )


# ---- layers ----------------------------------------------------------------


CLOSES = ["close_price", "volume"]


def prices(spark, sf):
    return staging.stg_prices(raw_prices(spark, sf))


def closes(spark, sf):
    return staging.stg_prices(raw_prices(spark, sf), keep=CLOSES)


def price_days(spark, sf):
    """Every loaded copy: enough for first and last days, and no shuffle of rows."""
    return staging.stg_prices(raw_prices(spark, sf), dedupe=False, keep=[])


def companies(spark, sf):
    return staging.stg_companies(raw_companies(spark, sf))


def statements(spark, sf):
    return staging.stg_financial_statements(raw_statements(spark, sf))


def valuations(spark, sf):
    return staging.stg_valuation_metrics(raw_valuations(spark, sf))


def macro(spark, sf):
    return staging.stg_macro_indicators(raw_macro(spark, sf))


def calendar(spark):
    return marts.dim_date(spark, *CALENDAR)


def security(spark, sf):
    return marts.dim_security(companies(spark, sf), price_days(spark, sf))


def fact_prices(spark, sf):
    """The security filter only needs company tickers: no price range per ticker is
    computed for it."""
    returns = marts.int_daily_returns(closes(spark, sf))
    return marts.fact_daily_prices(returns, companies(spark, sf), calendar(spark))


def fact_macro(spark, sf):
    return marts.fact_macro_readings(macro(spark, sf), calendar(spark))


def fact_fundamentals(spark, sf):
    pivoted = marts.int_fundamentals_pivoted(statements(spark, sf))
    return marts.fact_fundamentals(pivoted, companies(spark, sf), calendar(spark))


def fact_valuations(spark, sf):
    return marts.fact_valuation_snapshot(valuations(spark, sf), companies(spark, sf))
