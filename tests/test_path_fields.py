"""Path fields of all events, not of a few days."""

from conftest import FOLDER
from pyspark.sql import functions as F

from edupipe.catalog import QUERIES


def test_all_days_and_kinds(spark):
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    named = QUERIES["src_path_fields"](spark, FOLDER)
    days = events.where("event_type NOT IN ('view', 'error')").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("date_folder")).count()
    assert sorted(named.groupBy("date_folder").count().collect()) == sorted(days.collect())
    read = {path.rsplit("/", 2)[0].rsplit("/", 1)[1] + "/" + path.rsplit("/", 2)[1] for path in named.inputFiles()}
    kinds = {kind for kind in (folder.split("/event_type=")[1] for folder in read)}
    assert kinds == {r[0] for r in events.select("event_type").distinct().collect()}
    assert {folder for folder in read if folder.endswith("=view")} == {"day=undated/event_type=view"}
    assert len({folder.split("/")[0] for folder in read}) == events.select(F.to_date("ts")).distinct().count() + 1
