import datetime as dt
import json

import pytest
from pyspark.sql import functions as F, types as T

from shelfwise import schemas
from shelfwise.operators import ingest, reports
from shelfwise.session import materialize, stage_dir
from shelfwise.sources import files, tables
from shelfwise.streaming.incremental import append_new_files

IDS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]


def _raw(tmp_path):
    wide, cal, prices = tmp_path / "wide.csv", tmp_path / "cal.csv", tmp_path / "prices.csv"
    wide.write_text(",".join(IDS) + ",d_1,d_2,d_3\n" + "r1,F1,FOODS_1,FOODS,CA_1,CA,0,3,1\n" + "r2,F1,FOODS_1,FOODS,TX_1,TX,2,0,0\n")
    head = "date,wm_yr_wk,weekday,wday,month,year,d,event_name_1,event_type_1,event_name_2,event_type_2,snap_CA,snap_TX,snap_WI"
    cal.write_text(
        head + "\n2011-12-31,11149,Saturday,1,12,2011,d_1,,,,,0,0,0\n2012-01-01,11149,Sunday,2,1,2012,d_2,NewYear,National,,,1,1,0\n"
        "2012-01-07,11150,Saturday,1,1,2012,d_3,,,,,1,0,1\n"
    )
    prices.write_text("store_id,item_id,wm_yr_wk,sell_price\nCA_1,F1,11149,1.5\nCA_1,F1,11149,2.5\nCA_1,F1,11150,3\n")
    return str(wide), str(cal), str(prices)


def _long(spark, tmp_path):
    wide, cal, prices = _raw(tmp_path)
    calendar = files.scan_calendar(spark, cal)
    price = ingest.last_price(files.scan_prices(spark, prices), "arrival")
    melted = ingest.melt_wide(files.scan_wide_csv(spark, wide), IDS[1:])
    return ingest.as_sales_long(ingest.enrich_sales(melted, calendar, price)), calendar, price


def test_wide_files_to_long_table(spark, tmp_path):
    long, calendar, _ = _long(spark, tmp_path)
    assert [f.dataType for f in long.schema] == [f.dataType for f in schemas.SALES_LONG]
    rows = {(r.store_id, r.d): r for r in long.collect()}
    assert len(rows) == 6
    assert rows[("CA_1", "d_2")].units_sold == 3 and rows[("CA_1", "d_2")].sell_price == 2.5  # the later price row wins
    assert rows[("CA_1", "d_2")].event_name_1 == "NewYear" and rows[("CA_1", "d_1")].event_name_1 is None
    assert rows[("TX_1", "d_1")].sell_price is None
    assert files.cutoff_date(calendar, "d_2") == dt.date(2012, 1, 1)


def test_partitioned_parquet_prunes_to_one_store(spark, tmp_path):
    long, _, _ = _long(spark, tmp_path)
    path = str(tmp_path / "long")
    files.write_parquet(long, path, partition_by=("store_id",))
    files.write_parquet(long.limit(0), path, partition_by=("store_id",))
    back = files.scan_parquet(spark, path, schemas.SALES_LONG)
    slice_ = ingest.store_slice(back, "CA_1").select("units_sold")
    assert slice_.count() == 3
    plan = slice_._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(store_id" in plan and "ReadSchema: struct<units_sold:smallint>" in plan


def test_star_tables_load_and_reload(spark, tmp_path):
    long, calendar, price = _long(spark, tmp_path)
    tables.create_star(spark, "retail")
    tables.create_star(spark, "retail")
    tables.append_rows(ingest.build_dim_date(calendar), "retail.dim_date")
    tables.append_rows(ingest.build_dim(long, "item_id", ["dept_id", "cat_id"]), "retail.dim_item")
    tables.append_rows(ingest.build_dim(long, "store_id", ["state_id"]), "retail.dim_store")
    for part in ("CA_1", "TX_1"):  # chunked appends
        tables.append_rows(long.where(F.col("store_id") == part), "retail.fact_sales")
    tables.append_rows(price, "retail.fact_prices")
    got = {n: spark.table(f"retail.{n}") for n in schemas.STAR_TABLES}
    assert got["fact_sales"].count() == 6 and got["dim_store"].count() == 2
    by_month = reports.sales_by_category_month(got["fact_sales"], got["dim_date"], got["dim_item"], got["fact_prices"])
    assert [tuple(r) for r in by_month.collect()] == [("FOODS", 2011, 12, 0, 0.0), ("FOODS", 2012, 1, 4, 10.5)]
    trend = reports.price_trend(got["fact_prices"], got["dim_date"], got["dim_item"]).collect()
    # The week across New Year counts in both years.
    assert [(r.year, r.avg_price, r.num_price_points, r.yoy_change, r.yoy_pct_change) for r in trend] == [(2011, 2.5, 1, None, None), (2012, 2.75, 2, 0.25, 10.0)]
    tables.replace_table(by_month, "retail.by_month")
    tables.replace_table(by_month.limit(1), "retail.by_month")
    assert spark.table("retail.by_month").count() == 1


def test_last_price_follows_arrival_not_size(spark, tmp_path):
    """The oldest file is the largest, so Spark reads it first or in a task of its own; a tie in time goes by name."""
    import os

    for name, price, copies, when in (("b.csv", 9.0, 3000, 100), ("c.csv", 1.0, 1, 200), ("a.csv", 5.0, 40, 200)):
        rows = "".join(f"S1,I{k % 7},11101,{price}\n" for k in range(copies * 7))
        (tmp_path / name).write_text("store_id,item_id,wm_yr_wk,sell_price\n" + rows)
        os.utime(tmp_path / name, (when, when))
    last = lambda by: {r.sell_price for r in ingest.last_price(files.scan_prices(spark, str(tmp_path), by), "arrival").collect()}
    assert last("time") == {1.0}  # a and c are of one time, c is the later name
    assert last("name") == {1.0}
    os.utime(tmp_path / "b.csv", (300, 300))
    assert last("time") == {9.0} and last("name") == {1.0}


def test_a_load_is_appended_once(spark):
    schema = schemas.STAR_TABLES["fact_sales"]
    rows = lambda *units: spark.createDataFrame([("a", "s", dt.date(2020, 1, 1), u) for u in units], schema)
    spark.sql("CREATE DATABASE IF NOT EXISTS loading")
    tables.create_loads(spark, "loading.fact", schema)
    assert tables.append_once(rows(1, 2), "loading.fact", "it's one") and not tables.append_once(rows(1, 2), "loading.fact", "it's one")
    # Cut short: rows without a ledger entry are not seen, and the next try replaces them.
    rows(7).createOrReplaceTempView("cut")
    spark.sql("INSERT OVERWRITE TABLE loading.fact PARTITION (load_id = 'two') SELECT * FROM cut")
    units = lambda: sorted(r.units_sold for r in tables.loaded_rows(spark, "loading.fact").collect())
    assert units() == [1, 2]
    tables.append_once(rows(3, 4), "loading.fact", "two")
    assert units() == [1, 2, 3, 4] and tables.completed_loads(spark, "loading.fact") == {"it's one", "two"}


def test_readers_keep_a_whole_version_during_replacement(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS versions")
    numbers = lambda a, b: spark.range(a, b).toDF("n")
    tables.replace_table(numbers(0, 3), "versions.result")
    reader = spark.table("versions.result")
    tables.replace_table(numbers(10, 14), "versions.result")
    assert sorted(r.n for r in reader.collect()) == [0, 1, 2]
    assert sorted(r.n for r in spark.table("versions.result").collect()) == [10, 11, 12, 13]
    with pytest.raises(Exception):  # noqa: B017  a new version that fails leaves the old one in place
        tables.replace_table(numbers(0, 2).select(F.raise_error(F.lit("broken")).alias("n")), "versions.result")
    assert spark.table("versions.result").count() == 4
    tables.replace_table(numbers(0, 1), "versions.result")
    tables.replace_table(numbers(0, 1), "versions.result")
    assert len([r for r in spark.sql("SHOW TABLES IN versions").collect() if "__v" in r.tableName]) == 2


def test_accumulated_sums_never_read_old_days(spark, tmp_path):
    from shelfwise.operators import segment

    panel = spark.createDataFrame([("a", "s", dt.date(2020, 1, d), d % 5, 100 * d) for d in range(1, 29)], "item_id string, store_id string, date date, units_sold bigint, revenue_cents bigint")
    days = str(tmp_path / "days")
    panel.write.partitionBy("date").parquet(days)
    sums = segment.SeriesAccumulator(str(tmp_path / "sums"))
    read = lambda first, last: spark.read.parquet(days).where(F.col("date").between(F.lit(dt.date(2020, 1, first)), F.lit(dt.date(2020, 1, last))))
    sums.add(read(1, 20), "old")
    sums.add(read(21, 28), "new")
    sums.add(read(21, 28), "new")
    merged, whole = sums.totals(spark), segment.series_totals(panel)
    assert [r.asDict() for r in merged.collect()] == [{k: r[k] for k in merged.columns} for r in whole.collect()]
    assert all("/sums/" in f for f in merged.inputFiles())


def test_footer_profile_reads_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(50_000).select(F.col("id").alias("n"), F.when(F.col("id") > 9, F.col("id") / 2).alias("x"), F.lit("t").alias("s")).write.parquet(path)
    got = {r.column_name: (r.n_rows, r.n_known, r.least, r.greatest) for r in files.footer_profile(spark, path).collect()}
    assert got == {"n": (50_000, 50_000, "0", "49999"), "x": (50_000, 49_990, "5.0", "24999.5"), "s": (50_000, 50_000, None, None)}
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    spark.conf.set("spark.sql.sources.useV1SourceList", "")
    try:
        plan = files.footer_aggregates(spark.read.parquet(path))._jdf.queryExecution().optimizedPlan().toString()
        plan += files.footer_aggregates(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.parquet.aggregatePushdown")
        spark.conf.unset("spark.sql.sources.useV1SourceList")
    assert "PushedAggregation: [COUNT(*)" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_zero_share_and_uplift(spark, tmp_path):
    long, calendar, _ = _long(spark, tmp_path)
    zero = {(r.store_id): (r.total_days, r.zero_days, r.zero_percentage) for r in reports.zero_sales_percentage(long).collect()}
    assert zero == {"CA_1": (3, 1, 33.33), "TX_1": (3, 2, 66.67)}
    dims = ingest.build_dim(long, "item_id", ["dept_id", "cat_id"]), ingest.build_dim(long, "store_id", ["state_id"])
    row = reports.snap_impact(long.select("item_id", "store_id", "date", "units_sold"), calendar, *dims).first()
    assert (row.avg_sales_snap, row.avg_sales_nonsnap, row.pct_uplift) == (2.0, 0.0, None)


def test_text_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5)], "k string, v double")
    files.write_csv(df, str(tmp_path / "csv"))
    assert files.scan_csv(spark, str(tmp_path / "csv"), df.schema).collect() == df.collect()
    files.write_json(df.select(F.to_json(F.struct("k", F.create_map("k", "v").alias("m")))), str(tmp_path / "json"))
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("m", T.MapType(T.StringType(), T.DoubleType()))])
    assert files.scan_json(spark, str(tmp_path / "json"), schema).first().m == {"a": 1.5}
    row = tables.with_iso_date(spark.createDataFrame([(dt.date(2020, 2, 29),)], "date date")).first()
    assert row.date_text == "2020-02-29" and row.date_back == row.date


def test_stage_tables_live_in_the_shared_folder(spark):
    df = spark.range(5).toDF("n")
    back = materialize(df, "demo")
    assert all(stage_dir(spark) in f for f in back.inputFiles()) and back.count() == 5
    assert spark.conf.get("spark.checkpoint.dir") == stage_dir(spark)


def test_stream_loads_each_file_once(spark, tmp_path):
    schema = schemas.STAR_TABLES["fact_sales"]
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def drop(day):
        spark.createDataFrame([("a", "s", dt.date(2020, 1, day), day)], schema).write.mode("append").parquet(source)

    drop(1)
    append_new_files(spark, schema, source, target, state)
    append_new_files(spark, schema, source, target, state)
    drop(2)
    append_new_files(spark, schema, source, target, state)
    assert [r.units_sold for r in spark.read.schema(schema).parquet(target).orderBy("date").collect()] == [1, 2]


def test_document_sections(spark):
    from shelfwise.plans import registry

    from tests.conftest import SF_DIR

    text = registry.queries()["summary_document"](spark, SF_DIR).first().document
    doc = json.loads(text)
    assert set(doc) == {"dataset", "training", "forecasting", "inventory", "cost_comparison", "newsvendor", "key_insight", "cost_assumptions"}
    assert doc["dataset"]["category_names"] == ["FOODS", "HOBBIES", "HOUSEHOLD"]
    assert doc["cost_assumptions"]["holding_cost_rate"] == 0.2
