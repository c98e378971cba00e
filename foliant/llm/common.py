"""What the text operators share: reading, scratch tables in the shared folder, Arrow helpers."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.bound import let
from ..scratch import Scratch
from ..ship import to_workers

__all__ = ["SPACE", "Scratch", "bound_batches", "columns_of", "id_and_text", "let", "map_arrow", "quoted", "records", "table", "whole_row"]

#: ASCII white space, as every contract on words and lines has it.
SPACE = r"[\x20\x09-\x0D]"
#: Bytes of one Arrow batch sent to a Python worker; bounds a worker's memory whatever the row length.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Limit Arrow batches by bytes, so that very long texts don't pile up in one batch."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    to_workers(spark)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the id as doc_id and the text, null as empty; other columns, whatever their names, go no further."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _hand_back() -> None:
    """Return freed memory to the system: workers live on from stage to stage, beside the JVM in one container."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def map_arrow(df: DataFrame, f, schema: str) -> DataFrame:
    def run(batches):
        yield from f(batches)
        _hand_back()

    bound_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def records(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[x.name], x.type) for x in schema], schema=schema)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def whole_row(docs: DataFrame) -> Column:
    """All columns as one struct named row, so that no name among them can clash with an operator's own."""
    return F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row")


def columns_of(docs: DataFrame, **new: Column) -> list[Column]:
    """The columns of docs out of whole_row() in their order, those named in new replaced; the other new ones follow."""
    own = [new[c].alias(c) if c in new else F.col(f"row.{quoted(c)}") for c in docs.columns]
    return own + [v.alias(c) for c, v in new.items() if c not in docs.columns]
