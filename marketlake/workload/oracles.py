"""The same answers in SQL, over the same tables, written without the library.

`CTES` are named building blocks; `_sql(body, *names)` puts the named blocks, and
those they rest on, in front of a query.
"""

from __future__ import annotations

import re

from marketlake import constants as C
from marketlake.workload import market as MK

AS_OF = "DATE '2001-09-01'"
SPLIT = "DATE '1999-06-30'"
LOAD_NS = MK.LOAD_NS

# ---- helpers ---------------------------------------------------------------


def _quoted(items) -> str:
    return ", ".join("'" + str(x).replace("'", "''") + "'" for x in items)


def _values(rows) -> str:
    return ", ".join(f"({_quoted(row)})" for row in rows)


def _r(*cols: str, places: int = 6) -> str:
    return ", ".join(f"round({c}, {places}) AS {c}" for c in cols)


def _ns_date(c: str) -> str:
    return f"DATE '1970-01-01' + CAST({c} // 86400000000000 AS INTEGER)"


def _date_ns(c: str) -> str:
    return f"date_diff('day', DATE '1970-01-01', {c}) * 86400000000000"


def _ns_ts(c: str) -> str:
    return f"make_timestamp({c} // 1000)"


# ---- gaps ------------------------------------------------------------------


def _gap_days(prices: str) -> str:
    return f"""
      SELECT day, row_number() OVER (ORDER BY day) AS number FROM (
        SELECT DISTINCT price_date AS day FROM {prices} WHERE price_date >= DATE '1994-12-01'
        UNION ALL
        SELECT day FROM (SELECT CAST(range AS DATE) AS day FROM range(
            DATE '1994-12-01', (SELECT min(price_date) FROM {prices}), INTERVAL 1 DAY))
        WHERE dayofweek(day) NOT IN (0, 6))"""


def _lacking(prices: str, days: str) -> str:
    return f"""
      SELECT c.ticker, day, number,
             number - row_number() OVER (PARTITION BY c.ticker ORDER BY number) AS island
      FROM companies c, {days}
      WHERE (c.ticker, day) NOT IN (SELECT (ticker, price_date) FROM {prices})"""


# ---- RAW -------------------------------------------------------------------

_RATIOS = list(C.VALUATION_RATIOS)
_AMOUNTS = list(C.VALUATION_AMOUNTS)


def _valuation_fields() -> str:
    fields = {name: f"hi / {k + 2}" for k, name in enumerate(_RATIOS)}
    fields |= {name: f"total * {1000 * (k + 1)} + 0.5" for k, name in enumerate(_AMOUNTS)}
    fields["beta"] = "lo / 1000"
    fields["trailingPE"] = "CASE WHEN n % 4 = 0 THEN 1e19 ELSE hi / 50 END"
    fields["revenueGrowth"] = "sqrt((hi - lo) / hi)"
    fields["debtToEquity"] = "CASE WHEN n % 3 <> 0 THEN sqrt(hi / lo) END"
    fields["freeCashflow"] = "(hi - 1000) * 1e6"
    return ", ".join(f'{fields[name]} AS "{name}"' for name in C.VALUATION_FIELDS)


def _sentinel(c: str) -> str:
    return f"CASE WHEN abs({c}) <= 1e18 THEN {c} END"


_SERIES_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MK.SERIES.items())
_ITEM_LIST = f"[{_quoted(C.LINE_ITEMS)}]"
_N_INCOME = len(C.INCOME_ITEMS)
_N_BALANCE = _N_INCOME + len(C.BALANCE_ITEMS)
_KIND_CASE = (
    f"CASE WHEN item < {_N_INCOME} THEN 'income_statement' "
    f"WHEN item < {_N_BALANCE} THEN 'balance_sheet' ELSE 'cash_flow' END"
)


def _statement_select(source: str, frequency: str) -> str:
    return f"""
      SELECT 'C' || i AS ticker, {_KIND_CASE} AS statement_type, '{frequency}' AS frequency,
             period AS period_end_date, {_ITEM_LIST}[item + 1] AS line_item,
             CASE WHEN n % 5 <> 0 THEN CAST(amount AS DOUBLE) END AS value
      FROM {source}"""


CTES = {
    "raw_prices": f"""
      SELECT {_date_ns('CAST(o_orderdate AS DATE)')} AS date,
             'C' || (o_custkey // 100) AS ticker,
             CASE WHEN o_orderkey % 97 <> 0 THEN 1000 + o_totalprice / 717 END AS close,
             (1000 + o_totalprice / 717) * CAST(1.01 AS DOUBLE) AS high,
             (1000 + o_totalprice / 717) * CAST(0.99 AS DOUBLE) AS low,
             (1000 + o_totalprice / 717) * CAST(0.995 AS DOUBLE) AS open,
             o_orderkey * 7919 % 1000 AS volume,
             {LOAD_NS} + o_orderkey * 1000000000 AS extracted_at
      FROM orders""",
    "typed_prices": f"""
      SELECT ticker, {_ns_date('date')} AS price_date, open AS open_price, high AS high_price,
             low AS low_price, close AS close_price, volume,
             {_ns_ts('extracted_at')} AS extracted_at
      FROM raw_prices WHERE close IS NOT NULL AND volume > 0""",
    "prices": """
      SELECT * FROM typed_prices
      QUALIFY row_number() OVER (PARTITION BY ticker, price_date ORDER BY extracted_at DESC) = 1""",
    "raw_companies": f"""
      SELECT 'C' || i AS ticker, 'Company ' || i AS company_name,
             CASE WHEN i % 7 <> 0 THEN r_name END AS sector,
             CASE WHEN i % 5 <> 0 THEN n_name END AS industry,
             CASE WHEN i % 6 <> 0 THEN
               balance * CAST([1000, 10000, 100000, 1000000][i % 4 + 1] AS DOUBLE) END AS market_cap,
             TIMESTAMP '{MK.LOADED}' AS extracted_at
      FROM (SELECT c_custkey // 100 AS i, arg_max(c_nationkey, c_custkey) AS nk,
                   CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DOUBLE) AS balance
            FROM customer GROUP BY 1)
      JOIN nation ON nk = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "companies": """
      SELECT ticker, company_name, coalesce(sector, 'Unknown') AS sector,
             coalesce(industry, 'Unknown') AS industry,
             CAST(round(market_cap) AS BIGINT) AS market_cap_usd, extracted_at
      FROM raw_companies""",
    "funds": "SELECT ticker FROM companies WHERE market_cap_usd IS NULL",
    "line_cells": f"""
      SELECT l_suppkey // 7 AS i, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS q,
             l_partkey % {len(C.LINE_ITEMS)} AS item,
             sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS amount, count(*) AS n
      FROM lineitem GROUP BY ALL""",
    "quarter_cells": """
      SELECT i, last_day(q + INTERVAL 2 MONTH) AS period, item, amount, n FROM line_cells""",
    "year_cells": """
      SELECT i, make_date(year(q), 12, 31) AS period, item, sum(amount) AS amount, sum(n) AS n
      FROM line_cells GROUP BY ALL""",
    "raw_statements": (
        _statement_select("quarter_cells", "quarterly")
        + " UNION ALL "
        + _statement_select("year_cells", "annual")
    ),
    "statements": f"""
      SELECT *, {_ns_ts(str(LOAD_NS))} AS extracted_at FROM raw_statements WHERE value IS NOT NULL""",
    "raw_valuations": f"""
      SELECT 'C' || i AS ticker, DATE '2024-01-01' + p_size AS snapshot_date,
             {_valuation_fields()}, TIMESTAMP '{MK.LOADED}' AS extracted_at
      FROM (SELECT p_partkey // 133 AS i, p_size, max(p_retailprice) AS hi,
                   min(p_retailprice) AS lo, count(*) AS n,
                   CAST(sum(CAST(p_retailprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
            FROM part GROUP BY ALL)""",
    "valuations": "SELECT ticker, snapshot_date, "
    + ", ".join(
        f"{_sentinel(chr(34) + f + chr(34))} AS {name}"
        for f, name in {**C.VALUATION_RATIOS, **C.VALUATION_RISK}.items()
    )
    + ", "
    + ", ".join(
        f'CAST(round({_sentinel(chr(34) + f + chr(34))}) AS BIGINT) AS {name}'
        for f, name in C.VALUATION_AMOUNTS.items()
    )
    + ", extracted_at FROM raw_valuations",
    "observations": f"""
      SELECT event_id, series_id,
             CASE WHEN event_type = 'view' THEN CAST(date_trunc('month', d) AS DATE) ELSE d END AS day,
             value - 50 AS value
      FROM (SELECT *, DATE '1995-01-01' + CAST(event_id % 2404 AS INTEGER) AS d,
                   CASE event_type {_SERIES_CASE} END AS series_id FROM events)""",
    "names": f"SELECT * FROM (VALUES {_values(C.MACRO_SERIES.items())}) t(series_id, name)",
    "categories": "SELECT * FROM (VALUES "
    + _values((s, cat) for cat, ids in C.MACRO_CATEGORIES.items() for s in ids)
    + ") t(series_id, category)",
    "raw_macro": """
      SELECT series_id, coalesce(name, series_id) AS series_name, day AS observation_date,
             CASE WHEN event_id % 13 <> 0 THEN value END AS value, event_id
      FROM (SELECT series_id, day, arg_max(value, event_id) AS value, max(event_id) AS event_id
            FROM observations GROUP BY ALL)
      LEFT JOIN names USING (series_id)""",
    "macro": f"""
      SELECT series_id, series_name, observation_date, value,
             {_ns_ts(f'({LOAD_NS} + event_id * 1000000000)')} AS extracted_at
      FROM raw_macro WHERE value IS NOT NULL""",
    "spine": f"""
      SELECT DATE '{MK.CALENDAR[0]}' + CAST(range AS INTEGER) AS date_key
      FROM range({MK.CALENDAR[1]})""",
    "calendar": """
      SELECT date_key, CAST(year(date_key) AS INTEGER) AS year,
             CAST(quarter(date_key) AS INTEGER) AS quarter,
             CAST(month(date_key) AS INTEGER) AS month,
             CAST(weekofyear(date_key) AS INTEGER) AS week_of_year,
             CAST(dayofweek(date_key) AS INTEGER) AS day_of_week,
             strftime(date_key, '%a') AS day_name, strftime(date_key, '%b') AS month_name,
             dayofweek(date_key) NOT IN (0, 6) AS is_weekday,
             'Q' || quarter(date_key) || ' ' || year(date_key) AS fiscal_quarter_label
      FROM spine""",
    "dim_security": """
      SELECT c.ticker, company_name, sector, industry, market_cap_usd, first_trading_date,
             last_trading_date, extracted_at AS last_updated_at
      FROM companies c LEFT JOIN (
        SELECT ticker, min(price_date) AS first_trading_date, max(price_date) AS last_trading_date
        FROM prices GROUP BY ticker) p USING (ticker)""",
    "returns": """
      SELECT * FROM (
        SELECT *, stddev_samp(daily_return) OVER (PARTITION BY ticker ORDER BY price_date
                    ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) * sqrt(252)
                  AS rolling_30d_vol_annualized
        FROM (
          SELECT ticker, price_date, close_price, volume,
                 (close_price - lag(close_price) OVER w) / nullif(lag(close_price) OVER w, 0)
                   AS daily_return,
                 max(close_price) OVER (PARTITION BY ticker ORDER BY price_date
                   ROWS BETWEEN 251 PRECEDING AND CURRENT ROW) AS week_52_high,
                 min(close_price) OVER (PARTITION BY ticker ORDER BY price_date
                   ROWS BETWEEN 251 PRECEDING AND CURRENT ROW) AS week_52_low
          FROM prices WINDOW w AS (PARTITION BY ticker ORDER BY price_date)))
      WHERE daily_return IS NOT NULL""",
    "fact": """
      SELECT ticker, price_date, close_price, volume, daily_return, rolling_30d_vol_annualized,
             week_52_high, week_52_low,
             round(close_price / nullif(week_52_high, 0), 4) AS pct_of_52w_high
      FROM returns JOIN (SELECT ticker FROM companies) USING (ticker)
      JOIN spine ON price_date = date_key""",
    "fact_macro": """
      SELECT series_id, series_name, observation_date, value, extracted_at
      FROM macro JOIN spine ON observation_date = date_key""",
    "pivoted": "SELECT *, "
    + ", ".join(
        f"CASE WHEN total_revenue > 0 THEN {num} / total_revenue END AS {m}"
        for m, num in C.MARGINS.items()
    )
    + " FROM (SELECT ticker, period_end_date, frequency, "
    + ", ".join(
        f"max(CASE WHEN line_item = '{item}' THEN value END) AS {name}"
        for item, name in C.LINE_ITEMS.items()
    )
    + " FROM statements GROUP BY ALL) WHERE total_revenue IS NOT NULL"
    " OR total_assets IS NOT NULL OR operating_cash_flow IS NOT NULL",
    "fundamentals": """
      SELECT p.* FROM pivoted p JOIN (SELECT ticker FROM companies) USING (ticker)
      JOIN spine ON period_end_date = date_key""",
    "fact_valuations": """
      SELECT v.* EXCLUDE (trailing_annual_dividend_yield, extracted_at)
      FROM valuations v JOIN (SELECT ticker FROM companies) USING (ticker)""",
    "latest_valuations": """
      SELECT * FROM fact_valuations
      QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY snapshot_date DESC) = 1""",
    "pairs": """
      SELECT e.ticker, e.price_date AS event_date, e.daily_return AS event_return,
             date_diff('day', e.price_date, f.price_date) AS days_forward,
             f.price_date AS later_date, f.close_price AS later_close, e.close_price AS event_close,
             (f.close_price - e.close_price) / e.close_price AS cum_return
      FROM fact e JOIN fact f ON f.ticker = e.ticker AND f.price_date > e.price_date
       AND f.price_date <= e.price_date + 730
      WHERE e.daily_return >= 0.2::DOUBLE""",
    "study": "SELECT ticker, event_date, round(event_return * 100, 2) AS event_return_pct, "
    + ", ".join(
        f"max(CASE WHEN days_forward = {d} THEN cum_return END) AS d{d}" for d in C.HORIZON_DAYS
    )
    + " FROM pairs GROUP BY ticker, event_date, event_return",
    "horizons": " UNION ALL ".join(
        f"SELECT '{label}' AS horizon, {d} AS days, d{d} AS ret FROM study WHERE d{d} IS NOT NULL"
        for label, d in zip(C.HORIZON_LABELS, C.HORIZON_DAYS)
    ),
    "series_catalog": """
      SELECT series_id, series_name, min(observation_date) AS first_observation,
             max(observation_date) AS last_observation, count(*) AS observation_count
      FROM fact_macro GROUP BY ALL""",
    "categorized": """
      SELECT s.*, coalesce(category, 'Other') AS category
      FROM series_catalog s LEFT JOIN categories USING (series_id)""",
    "quotes": "SELECT ticker, price_date, round(close_price, 6) AS close_price FROM prices",
    "symbols": """
      SELECT c_custkey, upper(substr(c_mktsegment, 1, 3)) || '.' || c_custkey AS raw_symbol
      FROM customer""",
    "per_day": "SELECT price_date, count(*) AS n FROM prices GROUP BY 1",
    "gap_days": _gap_days("prices"),
    "lacking": _lacking("prices", "gap_days"),
    "holed": """
      SELECT * FROM quotes
      WHERE NOT (price_date BETWEEN DATE '1997-03-01' AND DATE '1997-05-31' AND ticker <> 'C0')""",
    "holed_days": _gap_days("holed"),
    "holed_lacking": _lacking("holed", "holed_days"),
    "holed_gaps": """
      SELECT ticker, min(day) AS gap_start, max(day) AS gap_end FROM holed_lacking GROUP BY ticker, island""",
    "landing": f"""
      SELECT *, price_date > {SPLIT} OR (day(price_date) = 15 AND year(price_date) = 1998) AS lands
      FROM prices""",
    "touched": """
      SELECT ticker, price_date, bool_or(lands) OVER (PARTITION BY ticker ORDER BY price_date
               ROWS BETWEEN 251 PRECEDING AND CURRENT ROW) AS hit FROM landing""",
}

_WORD = re.compile(r"[A-Za-z_]+")


def _needed(text: str, seen: list[str], inside: str = "") -> None:
    """Names of the blocks `text` mentions, each after those it rests on."""
    for word in _WORD.findall(text):
        if word in CTES and word not in seen and word != inside:
            _needed(CTES[word], seen, word)
            seen.append(word)


def _sql(body: str) -> str:
    names: list[str] = []
    _needed(body, names)
    blocks = ",\n".join(f"{name} AS ({CTES[name]})" for name in names)
    return f"WITH {blocks}\n{body}" if names else body


# ---- queries ---------------------------------------------------------------

_FACT_COLS = (
    "ticker, price_date, volume, "
    + _r("close_price", "daily_return", "rolling_30d_vol_annualized", "week_52_high",
         "week_52_low", "pct_of_52w_high")
)
_PIVOT_COLS = "ticker, period_end_date, frequency, " + _r(*C.LINE_ITEMS.values(), *C.MARGINS)
_VAL_DOUBLES = [*C.VALUATION_RATIOS.values(), "beta"]
_VAL_COLS = "ticker, snapshot_date, " + ", ".join(C.VALUATION_AMOUNTS.values())


def _event(where: str, source: str = "fact") -> str:
    return f"""SELECT ticker, price_date, volume, {_r('daily_return', 'close_price')}
               FROM {source} WHERE {where}"""


def _fresh(name: str, source: str, col: str, limit: int, as_of: str) -> str:
    return f"""SELECT CAST(max({col}) AS DATE) AS latest, DATE '{as_of}' AS as_of,
      CAST(date_diff('day', CAST(max({col}) AS DATE), DATE '{as_of}') AS INTEGER) AS days_since,
      '{name}' AS table_name FROM {source}
      HAVING date_diff('day', CAST(max({col}) AS DATE), DATE '{as_of}') > {limit}"""


def _nulls(name: str, source: str, cols: list[str]) -> str:
    parts = [
        f"SELECT '{c}' AS column_name, count(*) AS nulls, '{name}' AS table_name FROM {source} "
        f"WHERE {c} IS NULL HAVING count(*) > 0"
        for c in cols
    ]
    return " UNION ALL ".join(parts)


def _matrix(source: str, frequency: str) -> str:
    return f"""SELECT 'C' || i AS ticker, {_KIND_CASE} AS statement_type,
      '{frequency}' AS frequency, period AS period_end_date, {_ITEM_LIST}[item + 1] AS line_item,
      round(CAST(amount AS DOUBLE), 2) AS value FROM {source}"""


def _corr() -> str:
    cols = ["close_price", "volume", "daily_return", "rolling_30d_vol_annualized"]
    return " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, "
        + ("1.0::DOUBLE" if a == b else f"round(corr({a}, {b}), 6)")
        + " AS correlation FROM fact"
        + (" HAVING count(*) > 0" if a == b else "")
        for a in cols
        for b in cols
    )


_BODIES = {
    "observations_from_json": """
      SELECT series_id, coalesce(name, series_id) AS series_name, day AS date,
             round(value, 6) AS value
      FROM observations LEFT JOIN names USING (series_id) WHERE event_id % 7 <> 0""",
    "prices_wide_to_long": """
      SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS ticker,
             round(max(o_totalprice), 6) AS close, round(max(o_totalprice), 6) AS high,
             round(min(o_totalprice), 6) AS low, round(min(o_totalprice), 6) AS open,
             count(*) AS volume
      FROM orders GROUP BY ALL""",
    "statement_unpivot_eav": f"""
      SELECT 'C' || i AS ticker, 'income_statement' AS statement_type, 'annual' AS frequency,
             period AS period_end_date, {_ITEM_LIST}[item + 1] AS line_item,
             round(CAST(amount AS DOUBLE), 2) AS value FROM year_cells""",
    "statements_union": _matrix("year_cells", "annual")
    + " UNION ALL "
    + _matrix("quarter_cells", "quarterly"),
    "valuation_left_fill": "SELECT c.ticker, DATE '2024-03-01' AS snapshot_date, "
    + ", ".join(f'round({_sentinel(chr(34) + f + chr(34))}, 6) AS "{f}"' for f in C.VALUATION_FIELDS)
    + """, r.extracted_at FROM companies c LEFT JOIN (SELECT * FROM raw_valuations QUALIFY
      row_number() OVER (PARTITION BY ticker ORDER BY snapshot_date DESC) = 1) r USING (ticker)""",
    "company_left_fill": """
      SELECT u.ticker, company_name, sector, industry, round(market_cap, 2) AS market_cap,
             r.extracted_at
      FROM (SELECT DISTINCT ticker FROM raw_valuations) u LEFT JOIN raw_companies r USING (ticker)""",
    "sentinel_to_null": f"""
      SELECT ticker, snapshot_date, round({_sentinel('"trailingPE"')}, 6) AS "trailingPE",
             round({_sentinel('"forwardPE"')}, 6) AS "forwardPE" FROM raw_valuations""",
    "symbol_normalize": """
      SELECT c_custkey, raw_symbol, replace(raw_symbol, '.', '-') AS symbol FROM symbols""",
    "symbol_valid": r"""
      SELECT c_custkey, raw_symbol, regexp_matches(raw_symbol, '^[A-Z0-9\-]{1,10}$') AS raw_ok,
             regexp_matches(replace(raw_symbol, '.', '-'), '^[A-Z0-9\-]{1,10}$') AS ok
      FROM symbols""",
    "universe_ordered_union": """
      SELECT ticker, CAST(list AS INTEGER) AS list, pos FROM (
        SELECT DISTINCT 'C' || (o_custkey // 100) AS ticker, 0 AS list, o_custkey // 100 AS pos
        FROM orders
        UNION ALL
        SELECT DISTINCT 'C' || (p_partkey // 133), 1, p_partkey // 133 FROM part)
      QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY list, pos) = 1""",
    "equities_left_anti": """
      SELECT * FROM quotes WHERE ticker NOT IN (SELECT ticker FROM funds)""",
    "members_left_semi": "SELECT * FROM quotes WHERE ticker IN (SELECT ticker FROM funds)",
    "range_explicit": """
      SELECT * FROM quotes WHERE price_date >= DATE '1997-01-01' AND price_date < DATE '1998-01-01'""",
    "range_after_max": f"""
      SELECT * FROM quotes WHERE price_date >= DATE '2001-04-01' AND price_date < {AS_OF}""",
    "range_lookback": f"""
      SELECT * FROM quotes WHERE price_date >= {AS_OF} - 365 AND price_date < {AS_OF}""",
    "series_union_all": "SELECT series_id, day, round(value, 6) AS value FROM observations",
    "date_spine": """
      SELECT date_key, coalesce(n, 0) AS price_rows
      FROM spine LEFT JOIN per_day ON price_date = date_key""",
    "highwater_max_date": "SELECT max(price_date) AS max_date FROM prices",
    "lowwater_min_date": "SELECT min(price_date) AS min_date FROM prices",
    "incremental_new_rows": f"""
      SELECT * FROM quotes WHERE price_date >
        (SELECT max(price_date) FROM quotes WHERE price_date <= {SPLIT})""",
    "incremental_changed_rows": f"""
      SELECT * FROM quotes WHERE price_date > {SPLIT} OR day(price_date) = 15""",
    "merge_upsert": f"""
      SELECT ticker, price_date, close_price FROM quotes WHERE price_date < DATE '1999-01-01'
      UNION ALL
      SELECT ticker, price_date, close_price * 2 FROM quotes
      WHERE price_date >= DATE '1999-01-01'""",
    "schema_sync_union": f"""
      SELECT ticker, price_date, round(close_price, 6) AS close_price,
             CASE WHEN price_date > {SPLIT} THEN volume END AS volume FROM prices""",
    "backfill_window": """
      SELECT q.* FROM quotes q LEFT JOIN (SELECT ticker, min(price_date) AS oldest FROM quotes
        WHERE price_date >= DATE '1997-01-01' GROUP BY 1) m USING (ticker)
      WHERE price_date >= DATE '1995-06-01' AND (oldest IS NULL OR price_date < oldest)""".replace(
        "q.*", "q.ticker, q.price_date, q.close_price"
    ),
    "price_gaps": """
      SELECT ticker, min(day) AS gap_start, max(day) AS gap_end, count(*) AS missing_days
      FROM lacking GROUP BY ticker, island""",
    "backfill_landed": """
      SELECT q.ticker, price_date, close_price FROM quotes q JOIN holed_gaps g
        ON q.ticker = g.ticker AND price_date BETWEEN gap_start AND gap_end""",
    "price_tails": """
      SELECT ticker, first_day, last_day, count(*) AS rows_kept, min(price_date) AS kept_from,
             round(CAST(sum(CAST(close_price AS DECIMAL(20, 6))) AS DOUBLE), 4) AS close_sum
      FROM (SELECT *, min(price_date) OVER p AS first_day, max(price_date) OVER p AS last_day,
                   row_number() OVER (PARTITION BY ticker ORDER BY price_date DESC) AS back
            FROM prices WINDOW p AS (PARTITION BY ticker))
      WHERE back <= 251 GROUP BY ALL""",
    "tail_refresh": f"""
      SELECT r.ticker, r.price_date, volume, {_r("close_price", "week_52_high", "week_52_low",
      "daily_return", "rolling_30d_vol_annualized")}
      FROM returns r JOIN touched t ON r.ticker = t.ticker AND r.price_date = t.price_date
      WHERE hit""",
    "ns_epoch_to_date": """
      SELECT event_id, CAST(ts AS DATE) AS day, ts AS at,
             CAST(make_timestamp(-epoch_us(ts)) AS DATE) AS mirrored_day FROM events""",
    "cast_bigint_round": """
      SELECT event_id, CAST(round(floor(value * 2) / 2) AS BIGINT) AS rounded,
             CAST(round(-floor(value * 2) / 2) AS BIGINT) AS rounded_negative FROM events""",
    "coalesce_unknown": """
      SELECT ticker, company_name, sector, industry, market_cap_usd FROM companies""",
    "safe_ratio": """
      SELECT l_orderkey, l_linenumber, l_partkey,
             round(l_extendedprice / nullif(l_discount, 0), 4) AS ratio FROM lineitem""",
    "derived_margins": f"SELECT ticker, period_end_date, frequency, {_r(*C.MARGINS)} FROM pivoted",
    "dim_date": """
      SELECT calendar.*, coalesce(n, 0) AS price_rows
      FROM calendar LEFT JOIN per_day ON price_date = date_key""",
    "hash_sample_topn": """
      SELECT q.ticker, price_date, close_price, bucket
      FROM quotes q JOIN (
        SELECT ticker, ('0x' || substr(md5(ticker), 1, 8))::BIGINT % 10000 AS bucket
        FROM companies ORDER BY bucket, ticker LIMIT 5) s USING (ticker)
      WHERE price_date >= DATE '1998-06-01' AND price_date < DATE '1998-07-01'""",
    "display_format": """
      SELECT ticker AS "Ticker", company_name AS "Company", sector AS "Sector",
             industry AS "Industry",
             coalesce(printf('$%.1fB', market_cap_usd / 1e9), '—') AS "Mkt Cap",
             strftime(first_trading_date, '%Y-%m-%d') AS "First",
             strftime(last_trading_date, '%Y-%m-%d') AS "Last" FROM dim_security""",
    "display_series": """
      SELECT series_id AS "Series ID", series_name AS "Name", category AS "Category",
             strftime(first_observation, '%Y-%m-%d') AS "First Obs.",
             strftime(last_observation, '%Y-%m-%d') AS "Last Obs.",
             format('{:,}', observation_count) AS "Observations" FROM categorized""",
    "series_category": "SELECT series_id, series_name, category FROM categorized",
    "stg_prices": f"""
      SELECT ticker, price_date, volume, extracted_at,
             {_r('open_price', 'high_price', 'low_price', 'close_price')} FROM prices""",
    "stg_macro": """
      SELECT series_id, series_name, observation_date, round(value, 6) AS value, extracted_at
      FROM macro""",
    "stg_statements": """
      SELECT ticker, statement_type, frequency, period_end_date, line_item,
             round(value, 2) AS value, extracted_at FROM statements""",
    "stg_valuations": f"SELECT {_VAL_COLS}, {_r(*_VAL_DOUBLES)}, extracted_at FROM valuations",
    "dim_security": "SELECT * FROM dim_security",
    "fact_daily_prices": f"SELECT {_FACT_COLS} FROM fact",
    "fact_macro": """
      SELECT series_id, series_name, observation_date, round(value, 6) AS value, extracted_at
      FROM fact_macro""",
    "fundamentals_pivot": f"SELECT {_PIVOT_COLS} FROM pivoted",
    "fact_fundamentals": f"SELECT {_PIVOT_COLS} FROM fundamentals",
    "fact_valuation": f"""SELECT {_VAL_COLS}, {_r(*[c for c in _VAL_DOUBLES
      if c != 'trailing_annual_dividend_yield'])} FROM fact_valuations""",
    "daily_returns": """
      SELECT ticker, price_date, close_price,
             round((close_price - lag(close_price) OVER w) / nullif(lag(close_price) OVER w, 0), 6)
               AS daily_return
      FROM quotes WINDOW w AS (PARTITION BY ticker ORDER BY price_date)""",
    "rolling_52w_high_low": """
      SELECT *, max(close_price) OVER w AS week_52_high, min(close_price) OVER w AS week_52_low
      FROM quotes WINDOW w AS (PARTITION BY ticker ORDER BY price_date
        ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)""",
    "rolling_vol_annualized": """
      SELECT ticker, price_date,
             round(rolling_30d_vol_annualized, 6) AS rolling_30d_vol_annualized FROM fact""",
    "moving_average": """
      SELECT ticker, price_date, round(close_price, 6) AS close_price,
             round(avg(close_price) OVER (PARTITION BY ticker ORDER BY price_date
               ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 6) AS moving_avg_30d FROM prices""",
    "cumulative_return": """
      SELECT ticker, price_date, round(exp(sum(ln(1 + daily_return)) OVER (
        PARTITION BY ticker ORDER BY price_date)) - 1, 6) AS cumulative_return
      FROM fact WHERE price_date > DATE '2001-08-01' - INTERVAL 12 MONTH""",
    "cumulative_return_full": """
      SELECT ticker, price_date, round(exp(sum(ln(1 + daily_return)) OVER (
        PARTITION BY ticker ORDER BY price_date)) - 1, 6) AS cumulative_return FROM fact""",
    "snapshot_diff": """
      SELECT ticker, price_date, round(p.close_price, 6) AS close_price,
             round(f.close_price, 6) AS prior_close_price,
             round(abs(p.close_price - f.close_price), 6) AS delta
      FROM prices p JOIN (SELECT ticker, price_date, arg_min(close_price, extracted_at)
        AS close_price FROM typed_prices GROUP BY ALL) f USING (ticker, price_date)
      WHERE abs(p.close_price - f.close_price) > 0.01""",
    "event_up": _event("daily_return >= 0.2::DOUBLE"),
    "event_down": _event("daily_return <= -0.2::DOUBLE"),
    "event_near_high": _event("pct_of_52w_high >= 0.95::DOUBLE"),
    "event_near_low": _event("close_price <= week_52_low * 1.05::DOUBLE"),
    "event_volume_spike": _event(
        "volume >= avg_volume * 1.8::DOUBLE",
        """(SELECT *, avg(volume) OVER (PARTITION BY ticker ORDER BY price_date
            ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS avg_volume FROM fact)""",
    ),
    "event_volume_at_least": _event("volume >= 900"),
    "event_forward_range_join": """
      SELECT ticker, event_date, count(*) AS later_rows, max(later_date) AS last_date,
             round((max(later_close) - event_close) / event_close, 6) AS best_return,
             round((min(later_close) - event_close) / event_close, 6) AS worst_return
      FROM pairs GROUP BY ticker, event_date, event_close""",
    "event_forward_equi": "SELECT ticker, event_date, event_return_pct, "
    + _r(*[f"d{d}" for d in C.HORIZON_DAYS]) + " FROM study",
    "event_study": "SELECT ticker, event_date, event_return_pct, "
    + _r(*[f"d{d}" for d in C.HORIZON_DAYS]) + " FROM study",
    "event_summary": """
      SELECT horizon, CAST(days AS INTEGER) AS days, round(avg(ret) * 100, 2) AS avg_pct,
             round(median(ret) * 100, 2) AS median_pct,
             round(count(*) FILTER (ret > 0) * 100.0::DOUBLE / count(*), 1) AS positive_pct,
             round(max(ret) * 100, 2) AS best_pct, round(min(ret) * 100, 2) AS worst_pct
      FROM horizons GROUP BY horizon, days""",
    "event_fan": "SELECT horizon, CAST(days AS INTEGER) AS days, "
    + ", ".join(
        f"round(quantile_cont(ret, {p / 100}) * 100, 6) AS p{p}" for p in (10, 25, 50, 75, 90)
    )
    + " FROM horizons GROUP BY horizon, days",
    "macro_same_day": """
      SELECT ticker, price_date, round(daily_return, 6) AS daily_return,
             round(value, 6) AS macro_value
      FROM fact JOIN fact_macro ON observation_date = price_date AND series_id = 'DFF'""",
    "macro_asof": """
      SELECT ticker, price_date, round(daily_return, 6) AS daily_return,
             observation_date AS known_since, round(value, 6) AS macro_value
      FROM fact ASOF LEFT JOIN (SELECT * FROM fact_macro WHERE series_id = 'CPIAUCSL') m
        ON price_date >= observation_date""",
    "asof_by_key": """
      SELECT p.ticker, price_date, round(close_price, 6) AS close_price,
             period_end_date AS price_date_known, round(total_revenue, 6) AS total_revenue
      FROM prices p ASOF LEFT JOIN (SELECT * FROM fundamentals WHERE frequency = 'quarterly') f
        ON p.ticker = f.ticker AND p.price_date >= f.period_end_date""",
    "series_catalog": "SELECT * FROM series_catalog",
    "summary_stats": """
      SELECT (SELECT count(DISTINCT ticker) FROM fact) AS equity_count,
             (SELECT count(DISTINCT series_id) FROM fact_macro) AS macro_series_count,
             (SELECT count(*) FROM fact) AS price_rows,
             (SELECT count(*) FROM fundamentals) AS fundamental_rows,
             (SELECT min(price_date) FROM fact) AS price_start,
             (SELECT max(price_date) FROM fact) AS price_end""",
    "counts_by_category": """
      SELECT 'sector' AS kind, sector AS label, count(*) AS n FROM companies GROUP BY ALL
      UNION ALL SELECT 'category', category, count(*) FROM categorized GROUP BY ALL""",
    "distinct_sorted": "SELECT DISTINCT industry FROM companies",
    "statements_profile": """
      SELECT count(*) AS total_rows, count(DISTINCT ticker) AS tickers,
             count(DISTINCT line_item) AS line_items, min(period_end_date) AS first_period,
             max(period_end_date) AS last_period FROM statements""",
    "statement_counts": """
      SELECT statement_type, frequency, count(*) AS n FROM statements GROUP BY ALL""",
    "non_null_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS non_null FROM valuations"
        for c in C.VALUATION_FIELDS.values()
    ),
    "null_counts_per_row": "SELECT ticker, snapshot_date, CAST("
    + " + ".join(f"({c} IS NULL)::INTEGER" for c in C.VALUATION_FIELDS.values())
    + " AS INTEGER) AS null_fields FROM valuations",
    "melt_series": """
      SELECT price_date, 'top_close' AS series, round(max(close_price), 6) AS value
      FROM prices GROUP BY 1
      UNION ALL
      SELECT price_date, 'low_close', round(min(close_price), 6) FROM prices GROUP BY 1""",
    "corr_matrix": _corr(),
    "ols_trend": """
      SELECT ticker, round(regr_slope(close_price, x), 6) AS slope,
             round(regr_intercept(close_price, x), 6) AS intercept,
             round(regr_r2(close_price, x), 6) AS r2, regr_count(close_price, x)::BIGINT AS points
      FROM (SELECT *, date_diff('day', DATE '1995-01-01', price_date) AS x FROM prices)
      GROUP BY ticker""",
    "security_list": """
      SELECT ticker, company_name, sector, industry, market_cap_usd, first_trading_date,
             last_trading_date FROM dim_security""",
    "catalog_search": """
      SELECT * EXCLUDE (extracted_at) FROM companies
      WHERE contains(ticker, 'A') OR contains(lower(company_name), 'a')
         OR contains(lower(sector), 'a') OR contains(lower(industry), 'a')""",
    "series_search": """
      SELECT series_id, series_name, category FROM categorized
      WHERE contains(series_id, 'RATE') OR contains(lower(series_name), 'rate')
         OR contains(lower(category), 'rate')""",
    "market_cap_buckets": """
      SELECT ticker, market_cap_usd,
             CASE WHEN market_cap_usd IS NULL THEN 'ETFs / N/A'
                  WHEN market_cap_usd >= 200e9 THEN 'Mega' WHEN market_cap_usd >= 10e9 THEN 'Large'
                  WHEN market_cap_usd >= 2e9 THEN 'Mid' ELSE 'Small' END AS bucket
      FROM companies""",
    "topk_metric": """
      SELECT ticker, snapshot_date, round(revenue_growth, 6) AS revenue_growth
      FROM latest_valuations WHERE revenue_growth IS NOT NULL
      ORDER BY latest_valuations.revenue_growth DESC, ticker LIMIT 10""",
    "dq_not_null": " UNION ALL ".join(
        [
            _nulls("prices", "raw_prices", ["ticker", "date", "close", "volume"]),
            _nulls("statements", "raw_statements", ["ticker", "line_item", "value"]),
            _nulls("macro", "raw_macro", ["series_id", "observation_date", "value"]),
        ]
    ),
    "dq_unique": """
      SELECT ticker, count(*) AS row_count FROM raw_prices GROUP BY 1 HAVING count(*) > 1""",
    "pk_duplicates": """
      SELECT ticker, date, count(*) AS row_count FROM raw_prices GROUP BY ALL HAVING count(*) > 1""",
    "dq_accepted_values": """
      SELECT o_orderpriority, count(*) AS row_count FROM orders
      WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1""",
    "dq_orphans": """
      SELECT ticker, snapshot_date FROM valuations
      WHERE ticker NOT IN (SELECT ticker FROM companies)""",
    "freshness": " UNION ALL ".join(
        [
            _fresh("prices", "prices", "price_date", 3, "2001-09-01"),
            _fresh("macro", "macro", "observation_date", 5, "2001-07-28"),
            _fresh("valuations", "valuations", "snapshot_date", 3, "2024-03-01"),
            _fresh("statements", "statements", "extracted_at", 10, "2024-02-01"),
        ]
    ),
    "dq_future": "SELECT ticker, price_date FROM prices WHERE price_date > DATE '2001-06-30'",
    "dq_bounds": """
      SELECT 'close > 0' AS rule, ticker, price_date AS day, round(close_price, 6) AS value
      FROM fact WHERE close_price <= 0
      UNION ALL SELECT 'volume >= 0', ticker, price_date, volume::DOUBLE FROM fact WHERE volume < 0
      UNION ALL SELECT 'return in bounds', ticker, price_date, round(daily_return, 6)
      FROM fact WHERE daily_return > 0.5 OR daily_return < -0.5
      UNION ALL SELECT 'revenue >= 0', ticker, period_end_date, round(total_revenue, 6)
      FROM fundamentals WHERE total_revenue < 0
      UNION ALL SELECT 'assets >= 0', ticker, period_end_date, round(total_assets, 6)
      FROM fundamentals WHERE total_assets < 0""",
    "coverage_by_key": """
      SELECT ticker, key_max_date, reference_max_date,
             CAST(date_diff('day', key_max_date, reference_max_date) AS INTEGER) AS days_behind
      FROM (SELECT ticker, max(price_date) AS key_max_date FROM fact GROUP BY 1)
      CROSS JOIN (SELECT max(price_date) AS reference_max_date FROM fact)
      WHERE ticker NOT IN ('FDS', 'C0')
        AND date_diff('day', key_max_date, reference_max_date) > 5""",
    "audit_tables": """
      SELECT unnest(['values', 'close > 0', 'return in bounds', 'future', 'orphans', 'key', 'fresh',
                     'coverage', 'raw values', 'raw close', 'raw key', 'macro values', 'macro range',
                     'macro fresh']) AS rule,
             unnest([
        (SELECT count(*) FROM fact WHERE close_price IS NULL OR daily_return IS NULL),
        (SELECT count(*) FROM fact WHERE close_price <= 0),
        (SELECT count(*) FROM fact WHERE daily_return > 0.05::DOUBLE OR daily_return < -0.05::DOUBLE),
        (SELECT count(*) FROM fact WHERE price_date > DATE '2001-06-30'),
        (SELECT count(*) FROM fact WHERE NOT EXISTS
           (SELECT 1 FROM valuations WHERE valuations.ticker = fact.ticker)),
        (SELECT count(*) FROM (SELECT 1 FROM fact GROUP BY ticker, price_date HAVING count(*) > 1)),
        (SELECT coalesce((date_diff('day', max(price_date), DATE '2001-09-01') > 3)::INTEGER, 0) FROM fact),
        (SELECT coalesce(max((date_diff('day', day, newest) > 5)::INTEGER), 0)
         FROM (SELECT ticker, max(price_date) AS day FROM fact GROUP BY 1)
         CROSS JOIN (SELECT max(price_date) AS newest FROM fact) WHERE ticker NOT IN ('FDS', 'C0')),
        (SELECT count(*) FROM (SELECT 1 FROM raw_prices GROUP BY ticker, date
                               HAVING bool_or(close IS NULL OR volume IS NULL))),
        (SELECT count(*) FROM (SELECT 1 FROM raw_prices GROUP BY ticker, date
                               HAVING bool_or(close < 1000 OR close > 100000))),
        (SELECT count(*) FROM (SELECT 1 FROM raw_prices GROUP BY ticker, date HAVING count(*) > 1)),
        (SELECT count(*) FROM macro WHERE value IS NULL),
        (SELECT count(*) FROM macro WHERE value < 0),
        (SELECT coalesce((date_diff('day', max(observation_date), DATE '2001-07-28') > 5)::INTEGER, 0)
         FROM macro)]) AS broken""",
    "baseline_tolerance": """
      SELECT ticker, price_date, round(close_price, 6) AS close_price,
             round(expected, 6) AS expected_close_price,
             round(abs(close_price - expected), 6) AS delta
      FROM (SELECT *, CASE WHEN volume % 7 <> 0 THEN close_price +
              CASE WHEN volume % 10 = 1 THEN 0.02::DOUBLE ELSE 0.001::DOUBLE END END AS expected
            FROM prices)
      WHERE abs(close_price - expected) > 0.01""",
    "baseline_tolerance_rel": f"""
      SELECT ticker, period_end_date, frequency, {_r('total_revenue', 'net_income', 'diluted_eps',
        'expected_total_revenue', 'expected_net_income', 'expected_diluted_eps')}
      FROM (SELECT *,
              CASE WHEN month(period_end_date) <> 3 THEN total_revenue *
                CASE WHEN month(period_end_date) = 6 THEN 1.002::DOUBLE ELSE 1.0005::DOUBLE END END
                AS expected_total_revenue,
              net_income * CASE WHEN month(period_end_date) = 9 THEN 0.99::DOUBLE ELSE 1 END
                AS expected_net_income,
              diluted_eps + CASE WHEN year(period_end_date) = 1999 THEN 0.05::DOUBLE ELSE 0 END
                AS expected_diluted_eps FROM fundamentals)
      WHERE abs(total_revenue - expected_total_revenue) > abs(expected_total_revenue) * 0.001::DOUBLE
         OR abs(net_income - expected_net_income) > abs(expected_net_income) * 0.001::DOUBLE
         OR abs(diluted_eps - expected_diluted_eps) > 0.01""",
    "sector_avg_return": """
      SELECT sector, round(avg(daily_return), 6) AS avg_daily_return, count(*) AS observations
      FROM fact JOIN companies USING (ticker)
      WHERE price_date >= DATE '2001-07-01' AND price_date < DATE '2001-08-01' GROUP BY 1""",
    "near_high_topk": """
      SELECT ticker, price_date, round(close_price, 6) AS close_price,
             round(week_52_high, 6) AS week_52_high, pct_of_52w_high
      FROM (SELECT * FROM fact
            QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY price_date DESC) = 1)
      ORDER BY pct_of_52w_high DESC, ticker LIMIT 10""",
    "return_when_macro_negative": """
      SELECT ticker, count(*) AS days,
             round(exp(sum(ln(1 + daily_return))) - 1, 3) AS compounded_return
      FROM fact ASOF JOIN (SELECT * FROM fact_macro WHERE series_id = 'T10Y2Y') m
        ON price_date >= observation_date
      WHERE m.value < 0 GROUP BY 1""",
    "fundamental_trend": f"""
      SELECT ticker, period_end_date, {_r('total_revenue', 'net_income')} FROM fundamentals
      WHERE frequency = 'annual' AND period_end_date > DATE '2001-12-31' - INTERVAL 48 MONTH""",
    "return_on_equity": """
      SELECT ticker, period_end_date, frequency,
             round(net_income / nullif(stockholders_equity, 0), 6) AS return_on_equity
      FROM fundamentals""",
    "lowest_ratio_topk": """
      SELECT ticker, snapshot_date, round(trailing_pe, 6) AS trailing_pe FROM latest_valuations
      WHERE trailing_pe > 0 AND ticker NOT IN (SELECT ticker FROM funds)
      ORDER BY latest_valuations.trailing_pe, ticker LIMIT 10""",
    "margin_compare": f"""
      SELECT ticker, period_end_date, {_r(*C.MARGINS)} FROM fundamentals
      WHERE frequency = 'quarterly'""",
    "fcf_yield_topk": """
      SELECT ticker, snapshot_date, free_cash_flow, market_cap,
             round(free_cash_flow::DOUBLE / nullif(market_cap, 0)::DOUBLE, 6) AS fcf_yield
      FROM latest_valuations WHERE market_cap <> 0
      ORDER BY free_cash_flow::DOUBLE / market_cap::DOUBLE DESC, ticker LIMIT 10""",
    "industry_compare": """
      SELECT v.ticker, snapshot_date, round(debt_to_equity, 6) AS debt_to_equity, industry
      FROM latest_valuations v JOIN companies USING (ticker)""",
    "ratio_low_date": """
      SELECT ticker, snapshot_date AS low_date, round(trailing_pe, 6) AS trailing_pe
      FROM fact_valuations
      WHERE trailing_pe IS NOT NULL AND snapshot_date > DATE '2024-03-01' - INTERVAL 12 MONTH
      QUALIFY row_number() OVER (PARTITION BY ticker
        ORDER BY fact_valuations.trailing_pe, snapshot_date) = 1""",
    "baseline_extract": """
      SELECT ticker, price_date, round(close_price, 4) AS expected_close FROM fact""",
    "fundamentals_baseline": """
      SELECT ticker, period_end_date, frequency, round(total_revenue, 2) AS expected_total_revenue,
             round(net_income, 2) AS expected_net_income,
             round(diluted_eps, 2) AS expected_diluted_eps
      FROM fundamentals WHERE frequency = 'annual'""",
}
_BODIES["dq_not_null"] = _BODIES["dq_not_null"].replace(
    "'observation_date' AS column_name", "'date' AS column_name"
)

ORACLES = {name: _sql(body) for name, body in _BODIES.items()}
