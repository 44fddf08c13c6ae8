"""The whole warehouse under one base folder: views, builds, checks.

    <base>/raw/<table>     what the loaders land (`sources.tables.load`)
    <base>/marts/<table>   dimensions and facts
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake import constants as C
from marketlake import schemas as S
from marketlake.operators import audit
from marketlake.operators import quality as Q
from marketlake.operators.merge import incremental_rows
from marketlake.plans import incremental, marts, price_state, staging
from marketlake.sources import ledger, published, tables
from marketlake.sources.raw import values_df

STAGING = {
    "stg_prices": ("prices", staging.stg_prices),
    "stg_companies": ("company_info", staging.stg_companies),
    "stg_macro_indicators": ("macro_indicators", staging.stg_macro_indicators),
    "stg_financial_statements": ("financial_statements", staging.stg_financial_statements),
    "stg_valuation_metrics": ("valuation_metrics", staging.stg_valuation_metrics),
}
MARTS = ["dim_date", "dim_security", *S.KEYS]
LEDGER = "_files_taken_in"
# facts but prices, with their RAW table and staging view
FACT_OF = {
    "fact_macro_readings": ("macro_indicators", "stg_macro_indicators"),
    "fact_fundamentals": ("financial_statements", "stg_financial_statements"),
    "fact_valuation_snapshot": ("valuation_metrics", "stg_valuation_metrics"),
}
# staged days that facts take only if the calendar has them
DAYS = {
    "stg_prices": "price_date",
    "stg_macro_indicators": "observation_date",
    "stg_financial_statements": "period_end_date",
}


def raw_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A RAW table, or an empty frame of its schema if nothing was loaded yet."""
    loaded = tables.read_table(spark, f"{base}/raw/{name}")
    return spark.createDataFrame([], S.RAW[name]) if loaded is None else loaded


def staging_views(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    return {view: make(raw_table(spark, base, raw)) for view, (raw, make) in STAGING.items()}


def stored_marts(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    found = {name: tables.read_table(spark, f"{base}/marts/{name}") for name in MARTS}
    return {
        name: df.drop(tables.MONTH) for name, df in found.items() if df is not None
    }


def fact_days(
    spark: SparkSession, base: str, name: str, first: dt.date | str | None = None, last: dt.date | str | None = None
) -> DataFrame | None:
    """The rows of a fact from one day to another, opening only the months between; None
    if the fact has not been built. `register_views` shows whole facts."""
    rows = tables.read_days(spark, f"{base}/marts/{name}", S.DATE_COLUMN[name], first, last)
    return None if rows is None else rows.drop(tables.MONTH)


def register_views(spark: SparkSession, base: str) -> list[str]:
    """Make staging and marts queryable by name in `spark.sql`."""
    frames = staging_views(spark, base) | stored_marts(spark, base)
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return sorted(frames)


def calendar_span(stg: dict[str, DataFrame], spans: DataFrame | None = None) -> tuple[str, int]:
    """First day and number of days of a calendar that holds the usual span and every
    day of the staged data; `spans` (first_day, last_day) stands for the prices."""
    first = dt.date.fromisoformat(C.CALENDAR_START)
    last = first + dt.timedelta(days=C.CALENDAR_ROWS - 1)
    ends = [stg[view].agg(F.min(day), F.max(day)) for view, day in DAYS.items()
            if spans is None or view != "stg_prices"]
    if spans is not None:
        ends.append(spans.agg(F.min("first_day"), F.max("last_day")))
    for low, high in (end.first() for end in ends):
        first, last = min(first, low or first), max(last, high or last)
    return first.isoformat(), (last - first).days + 1


def _since(rows: DataFrame, loaded_after: dt.datetime) -> DataFrame:
    """Rows loaded after a time, in either form of load times, and those without one."""
    extracted = F.col("extracted_at")
    if dict(rows.dtypes)["extracted_at"] == "bigint":
        limit = F.lit(int((loaded_after - dt.datetime(1970, 1, 1)).total_seconds()) * 10**9)
    else:
        limit = F.lit(loaded_after).cast("timestamp_ntz")
    return rows.where(extracted.isNull() | (extracted > limit))


def _intakes(
    spark: SparkSession, base: str, whole: bool, loaded_after: dt.datetime | None
) -> dict[str, ledger.Intake]:
    """What each RAW table brings: rows of files not taken in yet, or of later loads."""
    found = {}
    for name in S.RAW:
        empty = spark.createDataFrame([], S.RAW[name])
        taken = ledger.intake(spark, f"{base}/raw/{name}", f"{base}/marts/{LEDGER}", name, empty)
        if whole:
            taken = replace(taken, fresh=None)
        elif loaded_after is not None:
            taken = replace(taken, fresh=_since(taken.rows, loaded_after))
        found[name] = taken
    return found


def _staged(view: str, taken: ledger.Intake, keys: list[str], again: DataFrame | None) -> DataFrame:
    """Staged rows of all keys that new files touch, and of the tickers in `again`. A key's
    old rows come along, since a fact row may be made of several."""
    make = STAGING[view][1]
    rows = make(taken.rows)
    if taken.fresh is None:
        return rows
    touched = rows.join(make(taken.fresh).select(*keys).distinct(), keys, "left_semi")
    if again is None or "ticker" not in keys:
        return touched
    others = rows.join(make(taken.fresh).select(*keys).distinct(), keys, "left_anti")
    return touched.unionByName(others.join(again, "ticker", "left_semi"))


def build(
    spark: SparkSession,
    base: str,
    full_refresh: bool = False,
    loaded_after: dt.datetime | None = None,
    calendar: tuple[str, int] | None = None,
    scope: str = "upsert",
) -> dict[str, int]:
    """Bring every mart up to date with RAW; returns rows written per table.

    What is new is what lies in RAW files no build has taken in (`sources.ledger`),
    whatever its load times and days; `loaded_after` takes rows of later loads instead.
    Facts take new and changed rows by key, however old their days ("upsert"), or only
    rows newer than their newest day (`scope="global"`). Prices are refreshed from the
    tails kept beside their fact (`plans.price_state`). A ticker that has become a known
    security since the last build gets its whole history. The calendar spans the data
    unless `calendar` gives its first day and length; then all rows are looked at again.
    """
    if scope not in ("upsert", "global"):
        raise ValueError(f"scope is 'upsert' or 'global', not {scope!r}")
    path = lambda name: f"{base}/marts/{name}"
    fact = path("fact_daily_prices")
    intakes = _intakes(spark, base, full_refresh or calendar is not None, loaded_after)
    stg = {view: make(intakes[raw].rows) for view, (raw, make) in STAGING.items()}

    security = tables.read_table(spark, path("dim_security"))
    again = None
    if security is not None and not full_refresh:
        again = stg["stg_companies"].select("ticker").join(security, "ticker", "left_anti").distinct()
        again = None if again.isEmpty() else again

    prices, current = intakes["prices"], published.listing(spark, fact)
    old = None
    if prices.fresh is not None:
        old = published.read_side(spark, fact, current, price_state.SIDE)
    # nothing landed and no ticker has become known: the fact and its state stay
    quiet = lambda raw: (
        loaded_after is None and again is None
        and intakes[raw].fresh is not None and not intakes[raw].new_files
    )
    returns, tails, side = None, old, None
    if old is None or not quiet("prices"):
        known = None if old is None or again is None else again.join(old, "ticker", "left_semi")
        returns, tails = price_state.refresh(prices.rows, prices.fresh, old, known)
        side = {price_state.SIDE: f"{price_state.SIDE}={uuid.uuid4().hex}"}
        tails.write.parquet(f"{fact}/{side[price_state.SIDE]}")
        tails = spark.read.parquet(f"{fact}/{side[price_state.SIDE]}")

    spine = marts.dim_date(spark, *(calendar or calendar_span(stg, tails)))
    written = {"dim_date": tables.build_table(spine, path("dim_date"))}
    spans = tails.select(
        "ticker", F.col("first_day").alias("first_trading_date"),
        F.col("last_day").alias("last_trading_date"),
    )
    written["dim_security"] = tables.build_table(
        marts.security_with_spans(stg["stg_companies"], spans), path("dim_security")
    )
    calendar = tables.read_table(spark, path("dim_date"))
    security = tables.read_table(spark, path("dim_security"))

    if returns is not None and scope == "global" and not full_refresh:
        newest = tables.max_date(spark, fact, S.DATE_COLUMN["fact_daily_prices"])
        returns = returns if newest is None else returns.where(F.col("price_date") > F.lit(newest))
    staged = {
        name: _staged(view, intakes[raw], S.KEYS[name], again)
        for name, (raw, view) in FACT_OF.items() if not quiet(raw)
    }
    facts = {}
    if returns is not None:
        facts["fact_daily_prices"] = marts.fact_daily_prices(returns, security, calendar)
    if (macro := staged.get("fact_macro_readings")) is not None:
        facts["fact_macro_readings"] = marts.fact_macro_readings(macro, calendar)
    if (statements := staged.get("fact_fundamentals")) is not None:
        pivoted = marts.int_fundamentals_pivoted(statements)
        facts["fact_fundamentals"] = marts.fact_fundamentals(pivoted, security, calendar)
    if (valuations := staged.get("fact_valuation_snapshot")) is not None:
        facts["fact_valuation_snapshot"] = marts.fact_valuation_snapshot(valuations, security)
    for name in S.KEYS:
        written[name] = 0
        if name not in facts:
            continue
        df = facts[name]
        target = None if full_refresh else tables.read_table(spark, path(name))
        if target is not None and name != "fact_daily_prices":
            target = target.drop(tables.MONTH)
            if set(target.columns) == set(df.columns):
                values = [c for c in df.columns if c != "extracted_at"]
                df = incremental_rows(df, target, S.DATE_COLUMN[name], scope, S.KEYS[name], values)
        written[name] = incremental.build_fact(
            spark, path(name), df, name, full_refresh, side if name == "fact_daily_prices" else None
        )
    # only now, so that a build that failed is done again
    ledger.record(spark, path(LEDGER), {name: taken.new_files for name, taken in intakes.items()})
    return written


# columns that must hold a value, table by table
NOT_NULL = {
    "stg_prices": ["ticker", "price_date", "close_price", "volume"],
    "stg_companies": ["ticker", "sector"],
    "stg_macro_indicators": ["series_id", "observation_date", "value"],
    "stg_financial_statements": [
        "ticker", "statement_type", "frequency", "period_end_date", "line_item", "value",
    ],
    "stg_valuation_metrics": ["ticker", "snapshot_date"],
    "fact_daily_prices": ["ticker", "price_date", "close_price", "daily_return", "volume"],
    "dim_security": ["ticker", "sector"],
    "dim_date": ["date_key", "year", "is_weekday"],
    "fact_fundamentals": ["ticker", "period_end_date", "frequency"],
    "fact_valuation_snapshot": ["ticker", "snapshot_date"],
    "fact_macro_readings": ["series_id", "observation_date", "value"],
}
UNIQUE = {"stg_companies": "ticker", "dim_security": "ticker", "dim_date": "date_key"}
ACCEPTED = [
    ("stg_financial_statements", "statement_type", C.STATEMENT_TYPES),
    ("stg_financial_statements", "frequency", C.FREQUENCIES),
    ("fact_fundamentals", "frequency", C.FREQUENCIES),
]
FRESH_DAYS = [
    ("fact_daily_prices", "price_date", 3),
    ("fact_macro_readings", "observation_date", 5),
    ("fact_valuation_snapshot", "snapshot_date", 3),
    ("stg_financial_statements", "extracted_at", 10),
]
RANGES = {
    "fact_daily_prices": {
        "close > 0": ("close_price", 0, None, True),
        "volume >= 0": ("volume", 0, None, False),
        "return within 50%": ("daily_return", -0.5, 0.5, False),
    },
    "fact_fundamentals": {
        "revenue >= 0": ("total_revenue", 0, None, False),
        "assets >= 0": ("total_assets", 0, None, False),
    },
}
# names of the checks of facts that look at days to come, and at ranges
FUTURE = {"fact_daily_prices": "future prices", "fact_fundamentals": "future periods"}
IN_RANGE = {"fact_daily_prices": "price ranges", "fact_fundamentals": "fundamental ranges"}
COVERED_DAYS = 5

# how far a fact may move from its anchors
ANCHORS = {
    "fact_daily_prices": {"close_price": ("absolute", 0.01)},
    "fact_fundamentals": {
        "total_revenue": ("relative", 0.001),
        "net_income": ("relative", 0.001),
        "diluted_eps": ("absolute", 0.01),
    },
}


def record_anchors(spark: SparkSession, base: str, name: str, anchors: DataFrame) -> int:
    """Keep the anchors of a fact: its keys and `expected_<column>` for each column of
    `ANCHORS`, as `questions.baseline_extract` and `fundamentals_baseline` give them. They
    replace earlier ones and are compared by every `checks` from then on."""
    named = anchors.withColumnsRenamed({"expected_close": "expected_close_price"})
    columns = [*S.KEYS[name], *(f"expected_{c}" for c in ANCHORS[name])]
    return tables.build_table(named.select(*columns), f"{base}/anchors/{name}")


def anchor_checks(spark: SparkSession, base: str, t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Facts that have moved from their anchors, for each fact that has some."""
    kept = {name: tables.read_table(spark, f"{base}/anchors/{name}") for name in ANCHORS if name in t}
    return {
        f"anchors {name}": Q.anchors_changed(t[name], anchors, S.KEYS[name], ANCHORS[name])
        for name, anchors in kept.items() if anchors is not None
    }


def checks(spark: SparkSession, base: str, as_of: dt.date | str) -> dict[str, DataFrame]:
    """Every standing check by name, each the frame of its violations. Null checks
    of one table share a scan."""
    t = staging_views(spark, base) | stored_marts(spark, base)
    built = lambda declared: [entry for entry in declared if entry[0] in t]
    out = {f"not_null {n}": Q.null_counts(t[n], cols) for n, cols in built(NOT_NULL.items())}
    out |= {f"unique {n}": Q.expect_unique(t[n], col) for n, col in built(UNIQUE.items())}
    out |= {f"accepted {n}.{col}": Q.expect_in(t[n], col, ok) for n, col, ok in built(ACCEPTED)}
    out |= {f"key {n}": Q.expect_key(t[n], keys) for n, keys in built(S.KEYS.items())}
    out |= {
        f"fresh {n}": Q.expect_fresh(t[n], col, days, as_of) for n, col, days in built(FRESH_DAYS)
    }
    out |= {
        f"orphans {n}": Q.expect_fk(t[n], t["dim_security"], "ticker")
        for n in S.KEYS
        if n in t and "ticker" in S.KEYS[n]
    }
    if "dim_date" in t:
        out |= {f"days {v}": Q.expect_fk(t[v], t["dim_date"], day, "date_key") for v, day in DAYS.items()}
    if "fact_daily_prices" in t:
        out |= _price_checks(spark, t["fact_daily_prices"], as_of)
    if "fact_fundamentals" in t:
        out |= _fundamental_checks(t["fact_fundamentals"], as_of)
    return out | anchor_checks(spark, base, t)


def _price_checks(spark, prices: DataFrame, as_of) -> dict[str, DataFrame]:
    excluded = values_df(spark, [(x,) for x in C.COVERAGE_EXCLUSIONS], "ticker string")
    return {
        "future prices": Q.expect_not_future(prices, "price_date", as_of),
        "price ranges": Q.range_violations(prices, ["ticker", "price_date"], RANGES["fact_daily_prices"]),
        "coverage": Q.coverage_lag(prices, "ticker", "price_date", COVERED_DAYS, excluded),
    }


def _fundamental_checks(fundamentals: DataFrame, as_of) -> dict[str, DataFrame]:
    keys = S.KEYS["fact_fundamentals"]
    return {
        "future periods": Q.expect_not_future(fundamentals, "period_end_date", as_of),
        "fundamental ranges": Q.range_violations(fundamentals, keys, RANGES["fact_fundamentals"]),
    }


def table_rules(t: dict[str, DataFrame], name: str, as_of: dt.date | str) -> audit.Rules:
    """The checks of one table, under the names of `checks`, for one pass over it."""
    rows, known, unique, coverage = {}, {}, None, None
    if name in NOT_NULL:
        rows[f"not_null {name}"] = audit.any_of([F.col(c).isNull() for c in NOT_NULL[name]])
    for table, col, values in ACCEPTED:
        if table == name:
            rows[f"accepted {name}.{col}"] = ~F.col(col).isin(values)
    if name in RANGES:
        ranges = [Q.outside(F.col(c).cast("double"), *limits) for c, *limits in RANGES[name].values()]
        rows[IN_RANGE[name]] = audit.any_of(ranges)
        rows[FUTURE[name]] = F.col(S.DATE_COLUMN[name]) > F.lit(as_of).cast("date")
    if name in S.KEYS:
        unique = (f"key {name}", S.KEYS[name])
        if "ticker" in S.KEYS[name]:
            known[f"orphans {name}"] = ("ticker", t["dim_security"].select("ticker"))
    elif name in UNIQUE:
        unique = (f"unique {name}", [UNIQUE[name]])
    if name in DAYS and "dim_date" in t:
        known[f"days {name}"] = (DAYS[name], t["dim_date"].select("date_key"))
    if name == "fact_daily_prices":
        coverage = ("coverage", audit.Coverage("ticker", "price_date", COVERED_DAYS, C.COVERAGE_EXCLUSIONS))
    fresh = {f"fresh {n}": audit.Fresh(col, days, as_of) for n, col, days in FRESH_DAYS if n == name}
    return audit.Rules(rows, known, unique, name in UNIQUE, fresh, coverage)


def broken_checks(spark: SparkSession, base: str, as_of: dt.date | str) -> dict[str, DataFrame]:
    """Those of `checks` that are broken, each the frame of its violations. Which they are
    comes from one pass over each table (`operators.audit`), all in one job; a frame is
    only computed if the caller reads it. Anchors are compared by their own join."""
    t = staging_views(spark, base) | stored_marts(spark, base)
    frames = checks(spark, base, as_of)
    counted = audit.broken_in_all([(df, table_rules(t, name, as_of)) for name, df in t.items()])
    # a row for each check
    names = {r["rule"] for r in counted.where("broken > 0").collect()}
    names |= {n for n, df in frames.items() if n.startswith("anchors ") and not df.isEmpty()}
    return {name: df for name, df in frames.items() if name in names}
