"""What the operators share: carried rows, written snapshots, partition counts, the word pattern."""

from __future__ import annotations

import ctypes
from math import ceil

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import fresh_dir

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: The name under which an operator carries its input row, so that no column of the input can clash.
ROW = "row"

#: What a Python worker keeps from task to task. Work of another kind clears it, to have the memory.
KEPT_BY_WORKER: dict[str, object] = {}


def give_back() -> None:
    """Free memory that the allocators of a Python worker hold goes back to the system, for the other workers.

    Workers outlive tasks and stages; numpy's and the tokenizer's memory comes from the C library, which keeps
    what was freed. Where that is another than GNU's, it decides for itself.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def begin_other_work() -> None:
    """What other work kept in this worker goes, and its memory with it."""
    KEPT_BY_WORKER.clear()
    give_back()


def carried(frame: DataFrame, **inner: Column) -> DataFrame:
    """The whole input row as one struct, beside the columns an operator works with."""
    row = F.struct(*[F.col(f"`{name}`") for name in frame.columns]).alias(ROW)
    return frame.select(row, *[column.alias(name) for name, column in inner.items()])


def delivered(frame: DataFrame, **added: Column) -> DataFrame:
    """The input columns again, followed by the operator's own, which replace any of the same name."""
    taken = {name.lower() for name in added}
    names = [field for field in frame.schema[ROW].dataType.names if field.lower() not in taken]
    return frame.select(
        *[F.col(f"{ROW}.`{name}`").alias(name) for name in names],
        *[column.alias(name) for name, column in added.items()],
    )


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read again: evaluated once, safe from lost executors."""
    spark = frame.sparkSession
    path = fresh_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def partitions(spark: SparkSession, amount: float, each: float) -> int:
    """Enough partitions for `amount` at `each` per partition, and no fewer than a shuffle has."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), ceil((amount or 0) / each))



def word_count(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
