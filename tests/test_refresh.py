"""Builds by files taken in, published month lists, tails and backfill."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from marketlake import schemas as S
from marketlake.plans import backfill as B
from marketlake.plans import incremental as I
from marketlake.plans import price_state, questions
from marketlake.plans import warehouse as WH
from marketlake.sources import files, ledger, published
from marketlake.sources import tables as T
from tests.helpers import NS_DAY, as_set

D = dt.date
START = (D(2022, 1, 3) - D(1970, 1, 1)).days
FACT = "fact_daily_prices"


def price_rows(tickers, days, loaded, close=None):
    return [
        ((START + n) * NS_DAY, t, close or 100.0 + (n * 37 + len(t)) % 50, 1.0, 1.0, 1.0, 10, loaded)
        for t in tickers for n in days
    ]


def land(spark, base, name, rows, overwrite=False):
    T.load(spark.createDataFrame(rows, S.RAW[name]), f"{base}/raw/{name}", overwrite)


def companies(spark, base, tickers):
    land(spark, base, "company_info", [(t, t, "Tech", None, 1e9, None) for t in tickers], overwrite=True)


def fact(spark, base):
    return WH.stored_marts(spark, base)[FACT]


def equals_full_refresh(spark, base):
    kept = as_set(fact(spark, base), 9)
    WH.build(spark, base, full_refresh=True)
    assert as_set(fact(spark, base), 9) == kept


def macro_frame(spark, rows):
    return spark.createDataFrame(rows, "series_id string, observation_date date, value double")


# ---- published lists ---------------------------------------------------------


def test_second_writer_of_a_number_is_refused(spark, tmp_path):
    path = str(tmp_path)
    published.publish(spark, path, published.Listing(1, "{}", {"202401": "run=a"}))
    with pytest.raises(published.Conflict):
        published.publish(spark, path, published.Listing(1, "{}", {"202401": "run=b"}))
    assert published.listing(spark, path).parts == {"202401": "run=a"}
    assert not [n for n in files.names_in(spark, f"{path}/_lists") if n.startswith("_draft")]


def test_writers_at_once_all_count(spark, tmp_path):
    path = str(tmp_path)

    def add(name):
        def change(base):
            parts = dict(base.parts) if base else {}
            return published.Listing(schema="{}", parts={**parts, name: f"run={name}"})
        published.commit(spark, path, change)

    threads = [threading.Thread(target=add, args=(f"{i}",)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert set(published.listing(spark, path).parts) == {str(i) for i in range(8)}
    assert published.listing(spark, path).number == 8


def test_merge_killed_before_publication_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path, name = str(tmp_path / "f"), "fact_macro_readings"
    I.build_fact(spark, path, macro_frame(spark, [("S", D(2024, m, 1), 1.0) for m in (1, 2, 3)]), name)
    old = T.read_table(spark, path)
    change = macro_frame(spark, [("S", D(2024, 2, 1), 2.0), ("S", D(2024, 4, 1), 2.0)])

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(published, "publish", die)
        with pytest.raises(KeyboardInterrupt):
            I.build_fact(spark, path, change, name)
    rows = lambda: sorted((r.observation_date.month, r.value) for r in T.read_table(spark, path).collect())
    assert rows() == [(1, 1.0), (2, 1.0), (3, 1.0)]
    assert I.build_fact(spark, path, change, name) == 2
    assert rows() == [(1, 1.0), (2, 2.0), (3, 1.0), (4, 2.0)]
    assert old.count() == 3  # a reader of the old list goes on
    gone = published.sweep(spark, path, 1 << 60)
    assert len(gone) == 1 and rows() == [(1, 1.0), (2, 2.0), (3, 1.0), (4, 2.0)]


def test_merge_beside_another_writer_keeps_both(spark, tmp_path, monkeypatch):
    path, name = str(tmp_path / "f"), "fact_macro_readings"
    I.build_fact(spark, path, macro_frame(spark, [("S", D(2024, 1, 1), 1.0)]), name)
    real, first = published.publish, []

    def overtaken(spark_, path_, new):
        if not first:
            first.append(1)
            I.build_fact(spark, path, macro_frame(spark, [("T", D(2024, 1, 1), 5.0)]), name)
        real(spark_, path_, new)

    monkeypatch.setattr(published, "publish", overtaken)
    I.build_fact(spark, path, macro_frame(spark, [("S", D(2024, 1, 2), 2.0)]), name)
    got = {(r.series_id, r.observation_date.day, r.value) for r in T.read_table(spark, path).collect()}
    assert got == {("S", 1, 1.0), ("S", 2, 2.0), ("T", 1, 5.0)}


def test_old_lists_and_their_folders_go(spark, tmp_path):
    path, name = str(tmp_path / "f"), "fact_macro_readings"
    for value in range(6):
        I.build_fact(spark, path, macro_frame(spark, [("S", D(2024, 1, 1), float(value))]), name)
    assert len(files.names_in(spark, f"{path}/_lists")) == published.KEPT
    assert len([n for n in files.names_in(spark, path) if n.startswith("run=")]) == published.KEPT
    assert T.read_table(spark, path).first().value == 5.0


def test_table_of_versions_is_taken_over(spark, tmp_path):
    path, name = str(tmp_path / "f"), "fact_macro_readings"
    old = T.with_month(macro_frame(spark, [("S", D(2024, m, 1), 1.0) for m in (1, 2)]), "observation_date")
    T.clustered_write(old, T.next_version(spark, path), ["series_id"], T.MONTH)
    I.build_fact(spark, path, macro_frame(spark, [("S", D(2024, 2, 1), 2.0)]), name)
    assert sorted(r.value for r in T.read_table(spark, path).collect()) == [1.0, 2.0]
    assert published.listing(spark, path).number == 1


# ---- files taken in ----------------------------------------------------------


def test_late_batch_with_an_older_load_time_arrives(spark, tmp_path):
    base = str(tmp_path)
    companies(spark, base, ["A", "B"])
    land(spark, base, "prices", price_rows(["A", "B"], range(40), 10**12))
    land(spark, base, "macro_indicators", [("DFF", "Fed", (START + 1) * NS_DAY, 5.0, 10**12)])
    WH.build(spark, base)
    assert WH.build(spark, base)[FACT] == 0
    # landed now, but loaded before anything else; the first batch has no day 41
    land(spark, base, "prices", price_rows(["A"], [41, 42], 10**9))
    land(spark, base, "macro_indicators", [("DFF", "Fed", START * NS_DAY, 4.0, 10**9)])
    written = WH.build(spark, base)
    assert written[FACT] == 2 and written["fact_macro_readings"] == 1
    assert WH.build(spark, base)[FACT] == 0
    equals_full_refresh(spark, base)


def test_statement_items_that_land_apart_meet(spark, tmp_path):
    base = str(tmp_path)
    companies(spark, base, ["A"])
    land(spark, base, "prices", price_rows(["A"], range(3), 1))
    item = lambda name, v: ("A", "income_statement", "annual", START * NS_DAY, name, v, 1)
    land(spark, base, "financial_statements", [item("Total Revenue", 200.0)])
    WH.build(spark, base)
    land(spark, base, "financial_statements", [item("Net Income", 20.0)])
    assert WH.build(spark, base)["fact_fundamentals"] == 1
    row = WH.stored_marts(spark, base)["fact_fundamentals"].first()
    assert (row.total_revenue, row.net_margin) == (200.0, 0.1)


def test_ledger_names_files_once(spark, tmp_path):
    raw, path = str(tmp_path / "a b"), str(tmp_path / "ledger")
    empty = spark.createDataFrame([], "x long")
    assert ledger.intake(spark, raw, path, "t", empty).new_files == []
    T.load(spark.range(3).toDF("x"), raw)
    first = ledger.intake(spark, raw, path, "t", empty)
    assert first.fresh is None and first.rows.count() == 3
    ledger.record(spark, path, {"t": first.new_files})
    assert ledger.intake(spark, raw, path, "other", empty).fresh is None
    T.load(spark.range(10, 12).toDF("x"), raw)
    second = ledger.intake(spark, raw, path, "t", empty)
    assert sorted(r.x for r in second.fresh.collect()) == [10, 11] and second.rows.count() == 5
    assert not set(second.new_files) & set(first.new_files)
    ledger.record(spark, path, {"t": second.new_files})
    assert ledger.intake(spark, raw, path, "t", empty).fresh.isEmpty()


def test_ticker_that_becomes_known_gets_its_history(spark, tmp_path):
    base = str(tmp_path)
    companies(spark, base, ["A"])
    land(spark, base, "prices", price_rows(["A", "NEW"], range(30), 1))
    land(spark, base, "valuation_metrics",
         [("NEW", D(2022, 1, 4), *[1.5] * (len(S.RAW["valuation_metrics"]) - 3), dt.datetime(2022, 1, 4))])
    WH.build(spark, base)
    assert fact(spark, base).where("ticker = 'NEW'").isEmpty()
    companies(spark, base, ["A", "NEW"])
    written = WH.build(spark, base)
    assert written[FACT] == 29 and written["fact_valuation_snapshot"] == 1
    equals_full_refresh(spark, base)


# ---- anchors -----------------------------------------------------------------


def test_restated_history_breaks_its_anchors(spark, tmp_path):
    base, name = str(tmp_path), f"anchors {FACT}"
    companies(spark, base, ["A"])
    land(spark, base, "prices", price_rows(["A"], range(10), 1))
    WH.build(spark, base)
    assert name not in WH.checks(spark, base, "2022-01-20")
    anchors = questions.baseline_extract(fact(spark, base))
    assert WH.record_anchors(spark, base, FACT, anchors) == 9
    assert WH.checks(spark, base, "2022-01-20")[name].isEmpty()
    land(spark, base, "prices", price_rows(["A"], [5], 0, close=77.0))  # an older load loses
    WH.build(spark, base)
    assert WH.checks(spark, base, "2022-01-20")[name].isEmpty()
    land(spark, base, "prices", price_rows(["A"], [5], 10**9, close=77.0))
    WH.build(spark, base)
    moved = WH.checks(spark, base, "2022-01-20")[name].collect()
    assert [(r.ticker, r.close_price) for r in moved] == [("A", 77.0)]


# ---- tails -------------------------------------------------------------------


def test_one_day_refresh_reads_new_files_tails_and_the_last_month(spark, tmp_path):
    base = str(tmp_path)
    companies(spark, base, ["A", "BB"])
    land(spark, base, "prices", price_rows(["A", "BB"], range(500), 1))
    WH.build(spark, base)
    path = f"{base}/marts/{FACT}"
    before = published.listing(spark, path)
    land(spark, base, "prices", price_rows(["A", "BB"], [500], 2))
    taken = WH._intakes(spark, base, False, None)["prices"]
    returns, tails = price_state.refresh(
        taken.rows, taken.fresh, published.read_side(spark, path, before, price_state.SIDE))
    for frame in (returns, tails):
        read = {f.split(base)[1].split("/")[1] + "/" + f.split("/")[-2].split("=")[0] for f in frame.inputFiles()}
        assert read <= {"raw/v00001", "marts/tails"}
        assert len([f for f in frame.inputFiles() if "/raw/" in f]) == len(taken.new_files)
    assert returns.count() == 2
    # the merge: nothing but the touched month
    last = max(before.parts)
    assert {f.split("/")[-2] for f in published.read(spark, path, before, [last]).inputFiles()} == {f"month_key={last}"}
    assert WH.build(spark, base)[FACT] == 2
    after = published.listing(spark, path)
    assert {m for m in before.parts if before.parts[m] != after.parts[m]} <= {last}
    assert after.side != before.side
    equals_full_refresh(spark, base)


def test_days_of_a_fact_open_only_their_months(spark, tmp_path):
    base = str(tmp_path)
    assert WH.fact_days(spark, base, FACT, "2022-01-01") is None
    companies(spark, base, ["A", "BB"])
    land(spark, base, "prices", price_rows(["A", "BB"], range(120), 1))
    WH.build(spark, base)
    whole = fact(spark, base)
    for first, last, months in [
        ("2022-02-10", D(2022, 3, 5), {"202202", "202203"}),
        (None, "2022-01-20", {"202201"}),
        ("2022-04-29", None, {"202204", "202205"}),
    ]:
        found = WH.fact_days(spark, base, FACT, first, last)
        assert {f.split("/")[-2].split("=")[1] for f in found.inputFiles()} == months
        same = whole.where(F.col("price_date").between(str(first or "0001-01-01"), str(last or "9999-12-31")))
        assert as_set(found, 9) == as_set(same, 9) and not found.isEmpty()
        assert "PushedFilters: [IsNotNull(price_date)" in found._jdf.queryExecution().executedPlan().toString()
    assert as_set(WH.fact_days(spark, base, FACT), 9) == as_set(whole, 9)
    outside = WH.fact_days(spark, base, FACT, "2030-01-01")
    assert outside.isEmpty() and outside.columns == whole.columns


def test_tails_carry_new_short_and_sparse_tickers(spark, tmp_path):
    base = str(tmp_path)
    companies(spark, base, ["A", "BB", "CCC", "D"])
    land(spark, base, "prices", price_rows(["A"], range(0, 400), 1) + price_rows(["BB"], [0, 300, 399], 1))
    WH.build(spark, base)
    for step in range(3):
        days = range(400 + 3 * step, 403 + 3 * step)
        rows = price_rows(["A"], days, 2) + price_rows(["CCC"], days, 2)
        land(spark, base, "prices", rows + price_rows(["BB"], [401 + 3 * step], 2) * 2)
        WH.build(spark, base)
    land(spark, base, "prices", price_rows(["D"], [402], 2))  # a first row has no return
    WH.build(spark, base)
    land(spark, base, "prices", price_rows(["D"], [403], 2) + price_rows(["BB"], [409], 2))
    assert WH.build(spark, base)[FACT] == 2
    tails = published.read_side(spark, f"{base}/marts/{FACT}",
                                published.listing(spark, f"{base}/marts/{FACT}"), price_state.SIDE)
    sizes = {r.ticker: (r.n, str(r.first_day), str(r.last_day)) for r in
             tails.select("ticker", F.size("tail").alias("n"), "first_day", "last_day").collect()}
    day = lambda n: str(D(1970, 1, 1) + dt.timedelta(days=START + n))
    assert sizes["A"] == (251, day(0), day(408)) and sizes["D"] == (2, day(402), day(403))
    assert sizes["BB"] == (7, day(0), day(409))
    equals_full_refresh(spark, base)


def test_late_row_touches_251_rows_beyond_and_no_more(spark, tmp_path):
    base = str(tmp_path)
    companies(spark, base, ["A", "BB"])
    land(spark, base, "prices", price_rows(["A", "BB"], range(900), 1))
    WH.build(spark, base)
    path = f"{base}/marts/{FACT}"
    before = published.listing(spark, path)
    land(spark, base, "prices", price_rows(["A"], [300], 2, close=500.0) + price_rows(["BB"], [900], 2))
    assert WH.build(spark, base)[FACT] == 252 + 1
    after = published.listing(spark, path)
    changed = {m for m in before.parts if before.parts[m] != after.parts[m]}
    day = lambda n: f"{D(1970, 1, 1) + dt.timedelta(days=START + n):%Y%m}"
    assert {day(300), day(551)} <= changed and all(m >= day(300) for m in changed)
    assert not {m for m in changed if day(551) < m < day(899)}
    equals_full_refresh(spark, base)


# ---- backfill ----------------------------------------------------------------


def test_gaps_by_hand(spark):
    days = spark.createDataFrame([(D(2024, 1, d), d) for d in range(1, 8)], "day date, number int")
    have = spark.createDataFrame(
        [("A", D(2024, 1, d)) for d in (2, 3, 3, 6)] + [("B", D(2024, 1, d)) for d in range(1, 8)]
        + [("X", D(2024, 1, 1))], "ticker string, price_date date")
    names = spark.createDataFrame([("A",), ("B",), ("NONE",), ("A",)], "ticker string")
    got = {(r.ticker, r.gap_start.day, r.gap_end.day, r.missing_days) for r in B.gaps(have, days, names).collect()}
    assert got == {("A", 1, 1, 1), ("A", 4, 5, 2), ("A", 7, 7, 1), ("NONE", 1, 7, 7)}
    source = spark.createDataFrame(
        [(t, D(2024, 1, d)) for t in ("A", "B", "NONE") for d in range(1, 10)], "ticker string, day date")
    filled = B.in_gaps(source, "day", B.gaps(have, days, names))
    assert sorted((r.ticker, r.day.day) for r in filled.collect()) == (
        [("A", d) for d in (1, 4, 5, 7)] + [("NONE", d) for d in range(1, 8)])


def test_market_days_are_weekdays_only_before_the_first_row(spark):
    prices = spark.createDataFrame([("A", D(2024, 1, 8)), ("A", D(2024, 1, 10))], "ticker string, price_date date")
    rows = B.market_days(spark, prices, "2024-01-03").orderBy("number").collect()
    assert [(r.day.day, r.number) for r in rows] == [(3, 1), (4, 2), (5, 3), (8, 4), (10, 5)]
    assert [r.day.day for r in B.market_days(spark, prices, "2024-01-09").collect()] == [10]


def test_backfill_fills_gaps_and_equals_a_full_refresh(spark, tmp_path):
    base = str(tmp_path)
    companies(spark, base, ["A", "BB", "CCC"])
    whole = [n for n in range(0, 420) if (START + n + 3) % 7 < 5]  # weekdays
    hole = [n for n in whole if not 60 <= n < 75]
    land(spark, base, "prices", price_rows(["A"], [n for n in hole if n >= 30], 1) + price_rows(["BB"], whole[30:], 1))
    WH.build(spark, base)
    start = str(D(1970, 1, 1) + dt.timedelta(days=START))
    source = spark.createDataFrame(price_rows(["A", "BB", "CCC", "ELSE"], whole, 5, close=70.0), S.RAW["prices"])
    missing = B.price_gaps(spark, base, start)
    assert {r.ticker for r in missing.collect()} == {"A", "BB", "CCC"}
    written = B.backfill(spark, base, source, start)
    days = lambda t: fact(spark, base).where(F.col("ticker") == t).count()
    assert written["raw"] == missing_days(whole, hole)
    assert days("A") == days("BB") == days("CCC") == len(whole) - 1
    # rows that were there stay as they were
    assert fact(spark, base).where("ticker = 'A' and close_price = 70").count() < 60
    again = B.backfill(spark, base, source, start)
    assert again["raw"] == 0 and again[FACT] == 0
    equals_full_refresh(spark, base)


def missing_days(whole, hole):
    a = len(whole) - len([n for n in hole if n >= 30])
    return a + 30 + len(whole)
