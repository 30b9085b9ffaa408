"""What the operators of this subpackage share: document keys and state of a worker process."""

from __future__ import annotations

import sys
import types
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edupipe.session import materialise

KEY = "dk"
BATCH_ROWS = 1000  # texts that travel to a worker at a time
INTEGERS = ("tinyint", "smallint", "int", "bigint")


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that sends at most ``BATCH_ROWS`` rows to a Python worker at a time.

    Rows here are whole texts: Spark's own default of ten thousand rows would put tens of
    megabytes into every buffer of every task, several times over.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(df.sparkSession.conf.get(setting))
    if rows <= 0 or rows > BATCH_ROWS:
        df.sparkSession.conf.set(setting, str(BATCH_ROWS))
    return df


def keyed(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` as (dk long, row struct): every row a document of its own, known by ``dk``.

    ``dk`` is ``key`` itself where that is an integer, never null and unique.  Otherwise rows
    are numbered and written once, so that a number stays with its row when tasks run again.
    Columns of the input live inside ``row`` and cannot clash with names used here.
    """
    small_batches(docs)
    if dict(docs.dtypes)[key] in INTEGERS:
        found = docs.agg(
            F.count("*").alias("rows"), F.count(key).alias("keys"), F.count_distinct(key).alias("kinds")
        ).first()
        if found["rows"] == found["keys"] == found["kinds"]:
            return docs.select(F.col(key).cast("long").alias(KEY), F.struct("*").alias("row"))
    numbered = docs.select(F.monotonically_increasing_id().alias(KEY), F.struct("*").alias("row"))
    return materialise(numbered, "numbered")


def whole_text(column: str = "row.text"):
    """The text as a string; null is empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def worker_state(name: str) -> dict[Any, Any]:
    """A dict that lives as long as the Python worker process, over all tasks it runs.

    Functions travel by value, so their module globals are made anew for every task.
    """
    holder = sys.modules.setdefault("_edupipe_worker_state", types.ModuleType("_edupipe_worker_state"))
    return holder.__dict__.setdefault(name, {})
