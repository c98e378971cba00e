"""Remote catalogues as a data source (S21 to S27, C6): pages come from a function that the caller names; tasks are read side by side.

The library opens no connection itself. A fetcher is `module:function`, importable by the workers; it gets a task (a dict)
and a cursor (None at first) and returns (records as JSON texts, the next cursor or None). So one reader serves cursor
paging, page numbers and single records; waiting, retries and keys are the fetcher's.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..ship import to_workers

SCHEMA = "task string, page int, record string, error string"


class _Tasks(InputPartition):
    def __init__(self, tasks: list[dict]):
        self.tasks = tasks


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.tasks = json.loads(options["tasks"])
        self.fetchers = options["fetch"].split(",")
        self.per = int(options.get("tasksperpartition", "20"))

    def partitions(self) -> list[_Tasks]:
        return [_Tasks(self.tasks[k : k + self.per]) for k in range(0, len(self.tasks), self.per)]

    def read(self, partition: _Tasks) -> Iterator[tuple]:
        steps = []
        for name in self.fetchers:
            module, _, function = name.strip().partition(":")
            steps.append(getattr(importlib.import_module(module), function))
        for task in partition.tasks:
            key = json.dumps(task, sort_keys=True)
            try:
                found = False
                for fetch in steps:  # a cascade: the next way only if the one before found nothing
                    cursor, page = None, 0
                    while True:
                        records, cursor = fetch(task, cursor)
                        for r in records:
                            found = True
                            yield key, page, r, None
                        page += 1
                        if cursor is None:
                            break
                    if found:
                        break
                if not found:
                    yield key, 0, None, "no results found"
            except Exception as e:  # noqa: BLE001  one task's failure is its row's
                yield key, 0, None, f"{type(e).__name__}: {e}"


class RemoteRecords(DataSource):
    """task (as JSON), page, record (as JSON), error; a row for each record, and one for each task without any."""

    @classmethod
    def name(cls) -> str:
        return "remote_records"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def remote_records(spark: SparkSession, tasks: list[dict], *fetch: str, per_partition: int = 20) -> DataFrame:
    """The records of a list of tasks (an ISSN and a year, a DOI, a venue); of several fetchers the first that finds anything counts."""
    to_workers(spark)
    spark.dataSource.register(RemoteRecords)
    options = {"tasks": json.dumps(tasks), "fetch": ",".join(fetch), "tasksPerPartition": str(per_partition)}
    return spark.read.format("remote_records").options(**options).load()


def parsed(rows: DataFrame, schema: str) -> DataFrame:
    """The records by a schema, beside their task; tasks without records have NULL there and their error."""
    return rows.select(F.from_json("record", schema).alias("r"), "task", "error").select("r.*", "task", "error")
