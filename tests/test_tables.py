import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlake import schemas as S
from marketlake.operators import merge as M
from marketlake.plans import incremental as I
from marketlake.plans import marts, staging
from marketlake.schemas import RAW_PRICES
from marketlake.session import checkpoint_dir
from marketlake.sources import tables as T
from marketlake.streaming.loader import load_new_prices
from tests.helpers import NS_DAY, as_set

D = dt.date
NAME = "fact_daily_prices"


def raw_rows(tickers, first, last, loaded=0, close=None):
    """One raw row per ticker and day number (days since 2020-01-01)."""
    start = (D(2020, 1, 1) - D(1970, 1, 1)).days
    return [
        ((start + n) * NS_DAY, t, close or 100.0 + (n * 37 + len(t)) % 50, 1.0, 1.0, 1.0, 10, loaded)
        for t in tickers
        for n in range(first, last)
    ]


def raw_frame(spark, rows):
    return spark.createDataFrame(rows, RAW_PRICES)


@pytest.fixture(scope="module")
def dims(spark):
    security = spark.createDataFrame([("A",), ("BB",), ("CCC",)], "ticker string")
    return security, marts.dim_date(spark)


def full(raw, dims):
    return marts.fact_daily_prices(marts.int_daily_returns(staging.stg_prices(raw)), *dims)


def stored(spark, path):
    return T.read_table(spark, path).select(*S.FACT_DAILY_PRICES)


def test_load_append_overwrite_and_probes(spark, tmp_path):
    path = str(tmp_path / "prices")
    assert T.max_date(spark, path, "date") is None and T.read_table(spark, path) is None
    assert T.load(raw_frame(spark, raw_rows(["A"], 0, 5)), path) == 5
    assert T.load(raw_frame(spark, raw_rows(["A"], 5, 8)), path) == 3
    assert T.read_table(spark, path).count() == 8
    assert T.read_table(spark, path).columns[0] == "date"
    assert "DATE" in spark.read.parquet(T.current_version(spark, path)).columns
    assert T.max_date(spark, path, "date") == D(2020, 1, 8)
    assert T.min_date(spark, path, "date") == D(2020, 1, 1)
    with pytest.raises(ValueError):
        T.load(raw_frame(spark, []), path)
    assert T.load_if_any(raw_frame(spark, []), path) == 0
    assert T.load(raw_frame(spark, raw_rows(["A"], 0, 2)), path, overwrite=True) == 2
    assert T.read_table(spark, path).count() == 2


def test_unfinished_version_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    T.build_table(spark.range(3), path)
    (tmp_path / "t" / "v00002").mkdir()
    assert T.read_table(spark, path).count() == 3
    assert T.build_table(spark.range(4), path) == 4
    assert T.read_table(spark, path).count() == 4


def test_probe_reads_footers_only(spark, tmp_path):
    path = str(tmp_path / "t")
    T.build_table(spark.range(10), path)
    with T._footer_aggregates(spark):
        plan = T.read_table(spark, path).agg(F.max("id"))._jdf.queryExecution().executedPlan()
        assert "PushedAggregation: [MAX(id)]" in plan.toString()
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_clustered_write_prunes(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    assert T.clustered_write(df, path, ["k", "id"]) == 1000
    plan = T.clustered(df, ["k", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(k" in plan


def test_merge_by_key(spark):
    cols = "k string, d int, v double"
    tgt = spark.createDataFrame([("A", 1, 1.0), ("A", 2, 2.0)], cols)
    src = spark.createDataFrame([("A", 2, 9.0), ("B", 1, 3.0)], cols)
    merged = M.merge_by_key(tgt, src, ["k", "d"])
    assert as_set(merged) == as_set(
        spark.createDataFrame([("A", 1, 1.0), ("A", 2, 9.0), ("B", 1, 3.0)], cols)
    )
    assert as_set(M.merge_by_key(merged, src, ["k", "d"])) == as_set(merged)
    with pytest.raises(Exception, match="duplicate source key"):
        M.merge_by_key(tgt, src.unionByName(src), ["k", "d"]).collect()


def test_incremental_scopes(spark):
    cols = "s string, d date, v double"
    tgt = spark.createDataFrame([("DFF", D(2024, 2, 15), 5.0)], cols)
    src = spark.createDataFrame(
        [("DFF", D(2024, 2, 15), 5.0), ("DFF", D(2024, 2, 16), 5.1), ("CPI", D(2024, 2, 1), 3.0)], cols
    )
    new = M.incremental_rows(src, tgt, "d")
    assert [(r.s, r.d.day) for r in new.collect()] == [("DFF", 16)]
    changed = M.incremental_rows(src, tgt, "d", "upsert", ["s", "d"])
    assert {(r.s, r.d.day) for r in changed.collect()} == {("DFF", 16), ("CPI", 1)}
    again = M.merge_by_key(tgt, changed, ["s", "d"])
    assert M.incremental_rows(src, again, "d", "upsert", ["s", "d"]).isEmpty()
    assert M.incremental_rows(src, tgt.limit(0), "d").count() == 3  # empty target: everything
    with pytest.raises(ValueError):
        M.incremental_rows(src, tgt, "d", "other")


def test_sync_and_backfill(spark):
    old = spark.createDataFrame([("A", 1, "x")], "k string, v int, gone string")
    new = spark.createDataFrame([("B", 2, 3.0)], "k string, v long, w double")
    synced = M.sync_columns(old, new.schema)
    assert synced.dtypes == new.dtypes and synced.first() == ("A", 1, None)
    src = spark.createDataFrame(
        [(k, D(2020, 1, d)) for k in "ABC" for d in range(1, 10)], "k string, d date"
    )
    tgt = src.where("(k = 'A' and d >= '2020-01-05') or (k = 'B' and d >= '2020-01-02')")
    got = {(r.k, r.d.day) for r in M.backfill_rows(src, tgt, "k", "d", "2020-01-02").collect()}
    assert got == {("A", d) for d in (2, 3, 4)} | {("C", d) for d in range(2, 10)}


@pytest.mark.parametrize("tickers", [["A", "BB"]])
def test_incremental_build_equals_full_build(spark, dims, tmp_path, tickers):
    path = str(tmp_path / NAME)
    history = raw_rows(tickers, 0, 600) + raw_rows(["CCC"], 590, 600)
    # CCC is sparse: its 251 earlier rows lie far back
    history += raw_rows(["CCC"], 0, 100)
    fresh = raw_rows(tickers, 600, 620) + raw_rows(["CCC"], 610, 612)
    before, after = raw_frame(spark, history), raw_frame(spark, history + fresh)
    I.build_fact(spark, path, full(before, dims), NAME)
    high_water = T.max_date(spark, path, "price_date")
    new = marts.fact_daily_prices(I.returns_after(after, high_water), *dims)
    assert I.build_fact(spark, path, new, NAME) == new.count() == 42
    assert as_set(stored(spark, path), 9) == as_set(full(after, dims), 9)
    I.build_fact(spark, path, new, NAME)  # a repeated run changes nothing
    assert as_set(stored(spark, path), 9) == as_set(full(after, dims), 9)


def test_late_rows_are_merged(spark, dims, tmp_path):
    path = str(tmp_path / NAME)
    history = raw_rows(["A", "BB"], 0, 300)
    I.build_fact(spark, path, full(raw_frame(spark, history), dims), NAME)
    high_water = T.max_date(spark, path, "price_date")
    loaded = 10 * 10**9
    late = raw_rows(["A"], 280, 281, loaded, close=500.0) + raw_rows(["BB"], 300, 302, loaded)
    after = raw_frame(spark, history + late)
    changed = I.returns_changed(after, high_water, dt.datetime(1970, 1, 1, 0, 0, 5))
    I.build_fact(spark, path, marts.fact_daily_prices(changed, *dims), NAME)
    assert as_set(stored(spark, path), 9) == as_set(full(after, dims), 9)


def test_schema_change_and_full_refresh(spark, tmp_path):
    path = str(tmp_path / "fact_macro_readings")
    cols = "series_id string, series_name string, observation_date date, value double"
    a = spark.createDataFrame([("S", "s", D(2024, 1, 1), 1.0)], cols)
    I.build_fact(spark, path, a, "fact_macro_readings")
    b = spark.createDataFrame([("S", "s", D(2024, 2, 1), 2.0)], cols).drop("series_name")
    I.build_fact(spark, path, b.withColumn("note", F.lit("n")), "fact_macro_readings")
    rows = T.read_table(spark, path).orderBy("observation_date").collect()
    assert [(r.value, r.note) for r in rows] == [(1.0, None), (2.0, "n")]
    assert "series_name" not in rows[0].asDict()
    I.build_fact(spark, path, a, "fact_macro_readings", full_refresh=True)
    assert [r.value for r in T.read_table(spark, path).collect()] == [1.0]


def test_merge_rewrites_only_touched_months(spark, tmp_path):
    path = str(tmp_path / "fact_macro_readings")
    cols = "series_id string, observation_date date, value double"
    rows = [("S", D(2024, m, 1), float(m)) for m in range(1, 5)]
    I.build_fact(spark, path, spark.createDataFrame(rows, cols), "fact_macro_readings")
    stamp = lambda: {
        f.split("/")[-2]: f.split("/")[-1] for f in T.read_table(spark, path).inputFiles()
    }
    before = stamp()
    I.build_fact(
        spark, path, spark.createDataFrame([("S", D(2024, 3, 9), 9.0)], cols), "fact_macro_readings"
    )
    after = stamp()
    assert {m for m in before if before[m] != after[m]} == {"month_key=202403"}
    assert T.read_table(spark, path).count() == 5


def test_backfill_start(spark, tmp_path):
    path = str(tmp_path / "prices")
    assert I.backfill_start(spark, path, "2010-01-01") is None
    T.load(raw_frame(spark, raw_rows(["A"], 3, 5)), path)
    assert I.backfill_start(spark, path, "2010-01-01") == D(2020, 1, 4)
    assert I.backfill_start(spark, path, "2020-01-04") is None


def test_stream_of_files(spark, dims, tmp_path):
    drop, raw, fact = (str(tmp_path / n) for n in ("drop", "raw", NAME))
    run = lambda: load_new_prices(spark, drop, raw, fact, *dims, state_dir=str(tmp_path / "state"))
    first = raw_rows(["A", "BB"], 0, 40, loaded=10**9)
    raw_frame(spark, first).write.mode("append").parquet(drop)
    run()
    second = raw_rows(["A"], 40, 45, loaded=10**12) + raw_rows(["BB"], 30, 31, 10**12, close=7.0)
    raw_frame(spark, second).write.mode("append").parquet(drop)
    run()
    run()  # nothing new
    assert as_set(stored(spark, fact), 9) == as_set(full(raw_frame(spark, first + second), dims), 9)


def test_checkpoint_folder_is_never_guessed(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert checkpoint_dir(spark, "/other") == named
    else:
        assert checkpoint_dir(spark, "/shared") == "/shared"
        with pytest.raises(ValueError):
            checkpoint_dir(spark)


def test_leftovers_of_a_dead_overwrite_never_show(spark, tmp_path):
    path = str(tmp_path / "t")
    T.load(spark.range(5).toDF("x"), path)
    spark.range(3).toDF("X").write.parquet(f"{path}/v00002")
    (tmp_path / "t" / "v00002" / "_SUCCESS").unlink()
    assert T.load(spark.range(7).toDF("x"), path, overwrite=True) == 7
    assert T.read_table(spark, path).count() == 7
