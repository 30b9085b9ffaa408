import time

import pytest
from helpers import plan_of, tuples
from pyspark.sql import functions as F

from edupipe import schemas
from edupipe.session import fresh_path, materialise, shared_dir
from edupipe.sources import readers, writers


def test_json_arrays(spark):
    path = fresh_path(spark, "t")
    df = spark.createDataFrame([(1, "a"), (2, None), (3, 'q"\n')], "i int, s string").repartition(5)
    writers.write_json_array(df, path)
    assert tuples(readers.read_json(spark, path, df.schema)) == tuples(df)
    assert readers.read_json(spark, path).columns == ["i", "s"]


def test_csv_malformed_cells_become_null(spark):
    path = fresh_path(spark, "t")
    lines = [
        "id,user_id,timestamp,page,clicked_element,clicked_parameter,duration,location",
        '57,6,2025-04-05 18:05:16,/details,"""Save"" button",Scholarship ID: E,0.56,"-84.9, -122.9"',
        "x,7,2025-04-05 18:05:16,/faq,,,1.5,here",
        "58,8,2025-04-05 18:05:16,/faq,a,b,,there",
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    rows = readers.read_csv(spark, path, schemas.CLICK_HISTORY).orderBy("user_id").collect()
    assert rows[0]["clicked_element"] == '"Save" button' and rows[0]["location"] == "-84.9, -122.9"
    assert rows[1]["id"] is None and rows[1]["clicked_element"] is None
    assert rows[2]["duration"] is None


def test_latest_file_and_dataset(spark):
    folder = fresh_path(spark, "t")
    with pytest.raises(FileNotFoundError):
        readers.latest_dataset(spark, folder)
    for name in ("b_stem", "a_stem", "c_other"):
        writers.write_parquet(spark.range(1), f"{folder}/{name}", single_file=True)
        time.sleep(0.02)
    assert readers.latest_dataset(spark, folder, "_stem").endswith("/a_stem")
    assert readers.latest_dataset(spark, folder).endswith("/c_other")
    assert readers.latest_file(spark, f"{folder}/a_stem", (".parquet",)).endswith(".parquet")
    with pytest.raises(FileNotFoundError):
        readers.latest_file(spark, f"{folder}/a_stem", (".csv",))
    assert readers.path_exists(spark, folder) and not readers.path_exists(spark, folder + "/none")


def test_path_fields(spark):
    base = fresh_path(spark, "t")
    for day in ("2024-01-01", "latest"):
        spark.range(2).coalesce(1).write.option("header", True).csv(f"{base}/{day}")
    got = readers.with_path_fields(readers.read_csv(spark, f"{base}/*").select("*", "_metadata"))
    assert {r["date_folder"] for r in got.collect()} == {"2024-01-01"}
    assert got.where("file_name like 'part-%.csv'").count() == 2


def test_history_layout(spark):
    path = fresh_path(spark, "t")
    df = spark.sql("SELECT id, 'click' kind, CAST('2024-01-01' AS timestamp) + make_interval(0, 0, 0, 0, id) ts FROM range(48)")
    writers.write_history(df, path, "kind", "ts")
    writers.write_history(df, path, "kind", "ts")
    back = spark.read.parquet(path)
    assert back.count() == 96
    one_day = back.where("dt = '2024-01-02'")
    assert one_day.count() == 48 and "PartitionFilters: [isnotnull(dt" in plan_of(one_day)


def test_messages(spark):
    df = spark.createDataFrame([("t", 7, "é")], "topic string, u long, v string")
    row = writers.keyed_messages(df, "topic", "u", ["u", "v"]).first()
    assert (row["topic"], bytes(row["key"]), bytes(row["value"])) == ("t", b"7", '{"u":7,"v":"é"}'.encode())


def test_filters_reach_the_scan(spark):
    orders = readers.read_parquet(spark, "/root/testdata/sf0.001/orders.parquet")
    plan = plan_of(orders.where(F.col("o_orderstatus").isin("F", "P")).select("o_orderkey"))
    assert "PushedFilters: [In(o_orderstatus" in plan and "o_totalprice" not in plan


def test_shared_dir_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named or spark.sparkContext.getCheckpointDir())


def test_written_intermediates_leave_no_shuffle_files(spark):
    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (found.apply(i).getName() for i in range(found.length())) if name.startswith("shuffle_")}

    before = files()
    rows = materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    for _ in range(50):  # they are removed in the background
        if not files() - before:
            break
        time.sleep(0.1)
    assert files() <= before and rows.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
