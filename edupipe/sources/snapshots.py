"""Several tables that fit together, published as one.

All tables of a version are written first; the version counts when its manifest is there, a small file that
is renamed into place as the last step.  Readers take the newest manifest, so they never see a version of
which a part is missing, and a version that was stopped half way leaves the one before it in force.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from edupipe.sources.readers import folder_names


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under another name and rename it: it is there whole or not at all."""
    jvm = spark.sparkContext._jvm
    target, draft = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.draft")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(draft, target):
        raise FileExistsError(f"{path} is there already")


def versions(spark: SparkSession, folder: str) -> list[int]:
    """The published versions, oldest first."""
    names = folder_names(spark, f"{folder}/manifests")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def publish(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str, version: int | None = None) -> int:
    """Write all ``tables`` as the next version and publish them together; returns its number.

    A version that was begun and not published is written over.
    """
    done = versions(spark, folder)
    version = (done[-1] + 1 if done else 1) if version is None else version
    if version in done:
        raise FileExistsError(f"version {version} is published")
    schemas = {}
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{folder}/versions/{version}/{name}")
        schemas[name] = json.loads(table.schema.json())
    _write_text(spark, f"{folder}/manifests/{version}.json", json.dumps({"version": version, "tables": schemas}))
    return version


def read_snapshot(spark: SparkSession, folder: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of the newest published version, or of the one given."""
    done = versions(spark, folder)
    if not done or (version is not None and version not in done):
        raise FileNotFoundError(f"no published version in {folder}")
    version = done[-1] if version is None else version
    text = "".join(r[0] for r in spark.read.text(f"{folder}/manifests/{version}.json", wholetext=True).collect())
    schemas = json.loads(text)["tables"]
    return {
        name: spark.read.schema(T.StructType.fromJson(schema)).parquet(f"{folder}/versions/{version}/{name}")
        for name, schema in schemas.items()
    }
