"""Remote tasks as a table, fetched in rounds that a ledger remembers.

Tasks are rows, dealt to partitions by Spark. A round asks each open task's fetcher for some pages, from where the ledger says
that the task stands, and appends every page with the cursor of the next; a failure ends a task's round, not the pages before it.
So a harvest that was stopped goes on behind the last page of each task and asks for none twice. Fetchers are as in remote.py.
One that raises Busy(seconds) says that the service wants a pause: all tasks wait that long before the next round.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..ship import to_workers

LEDGER = "task string, step int, page int, records array<string>, cursor string, found long, error string, attempt int, retry_at double"
_SCHEMA = pa.schema([
    ("task", pa.string()), ("step", pa.int32()), ("page", pa.int32()), ("records", pa.list_(pa.string())), ("cursor", pa.string()), ("found", pa.int64()), ("error", pa.string()), ("attempt", pa.int32()),
    ("retry_at", pa.float64()),
])
#: Failures in a row after which a task is given up.
ATTEMPTS = 5


class Busy(Exception):
    """Raised by a fetcher whose service asks for a pause of so many seconds."""

    def __init__(self, seconds: float):
        super().__init__(seconds)
        self.seconds = seconds


def _round(fetchers: tuple[str, ...], pages: int):
    """Fetch up to so many pages of each task, from its last row in the ledger on."""

    def one(steps, task, step, page, cursor, found, attempt):
        asked = 0
        while asked < pages:
            try:
                records, after = steps[step](json.loads(task), None if cursor is None else json.loads(cursor))
                records = list(records)
            except Exception as e:  # noqa: BLE001  one task's failure is its row's
                busy = isinstance(e, Busy)
                yield task, step, page, [], cursor, found, "busy" if busy else f"{type(e).__name__}: {e}", attempt if busy else attempt + 1, time.time() + e.seconds if busy else None
                return
            asked, found, attempt = asked + 1, found + len(records), 0
            cursor = None if after is None else json.dumps(after)
            yield task, step, page, records, cursor, found, None, 0, None
            page += 1
            if after is None:
                if found or step + 1 == len(steps):
                    return
                step, page = step + 1, 0

    def run(batches):
        steps = []
        for name in fetchers:
            module, _, function = name.strip().partition(":")
            steps.append(getattr(importlib.import_module(module), function))
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in ("task", "step", "page", "cursor", "found", "attempt"))):
                rows = list(one(steps, *row))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)

    return run


def standing(tasks: DataFrame, ledger: DataFrame, steps: int) -> DataFrame:
    """task, step, page, cursor, found, attempt of each open task, and retry_at: where its next page is to be asked."""
    last = Window.partitionBy("task").orderBy(F.desc("step"), F.desc("page"), F.desc("attempt"), F.desc_nulls_last("retry_at"))
    rows = tasks.select("task").distinct().join(ledger.withColumn("__n", F.row_number().over(last)).where("__n = 1"), "task", "left")
    failed, ended = F.col("error").isNotNull(), F.col("error").isNull() & F.col("cursor").isNull()
    done = ended & ((F.col("found") > 0) | (F.col("step") + 1 == steps)) | failed & (F.col("attempt") >= ATTEMPTS)
    open_ = rows.where("step is null").unionByName(rows.where(F.col("step").isNotNull() & ~done))
    next_step = F.coalesce(F.when(ended, F.col("step") + 1).otherwise(F.col("step")), F.lit(0)).cast("int")
    next_page = F.coalesce(F.when(ended, 0).when(failed, F.col("page")).otherwise(F.col("page") + 1), F.lit(0)).cast("int")
    return open_.select("task", next_step.alias("step"), next_page.alias("page"), "cursor", F.coalesce("found", F.lit(0).cast("long")).alias("found"), F.coalesce("attempt", F.lit(0)).cast("int").alias("attempt"), "retry_at")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The pages of a ledger, empty where none was written yet."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    return spark.read.schema(LEDGER).parquet(path) if there else spark.createDataFrame([], LEDGER)


def harvest(tasks: DataFrame, ledger: str, *fetch: str, pages: int = 50, rounds: int | None = None, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """task, step, page, record, error: the records of tasks (task as JSON), and a row for each task that found none or was given up.

    ledger is a folder that driver and executors share. Of several fetchers the next is asked where the one before found
    nothing. rounds: stop after so many, to go on another time; tasks that are still open then have no row but their records.
    """
    spark = tasks.sparkSession
    to_workers(spark)
    done = 0
    while rounds is None or done < rounds:
        open_ = standing(tasks, read_ledger(spark, ledger), len(fetch))
        state = open_.agg(F.count(F.lit(1)).alias("n"), F.max("retry_at").alias("at")).first()
        if not state.n:
            break
        if state.at is not None and state.at > time.time():
            wait(state.at - time.time())
        asked = open_.drop("retry_at").repartition("task").mapInArrow(_round(fetch, pages), LEDGER)
        asked.write.mode("append").parquet(ledger)
        done += 1
    pages_ = read_ledger(spark, ledger).join(tasks.select("task").distinct(), "task", "left_semi")
    told = pages_.select("task", "step", "page", F.explode("records").alias("record"), F.lit(None).cast("string").alias("error"))
    ends = pages_.groupBy("task").agg(F.max("found").alias("found"), F.max(F.struct("step", "page", "attempt", F.coalesce("error", F.lit("")).alias("error"), F.col("cursor").isNull().alias("ended"))).alias("l"))
    given_up = (F.col("l.error") != "") & (F.col("l.attempt") >= ATTEMPTS)
    nothing = (F.col("found") == 0) & (F.col("l.error") == "") & F.col("l.ended") & (F.col("l.step") + 1 == len(fetch))
    none = ends.where(given_up | nothing).select("task", F.col("l.step").alias("step"), F.col("l.page").alias("page"), F.lit(None).cast("string").alias("record"), F.when(given_up, F.col("l.error")).otherwise("no results found").alias("error"))
    return told.unionByName(none)
