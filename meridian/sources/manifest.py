"""A log of the partitions that are written, and work lists read from it.

The log is a table that is only appended to. An entry is committed after its partition is written whole, so that a partition without entry
is not there, whatever files a run that died has left: it is computed again and replaces them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meridian.sources import tables

ENTRY = "table string, key string, rows long, run string, at timestamp"


def _read(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def entries(spark: SparkSession, log: str, table: str, keys: str) -> DataFrame:
    """The finished partitions of a table: its ``keys`` (names and types), rows and run; of one written again the last entry."""
    found = _read(spark, log, ENTRY).where(F.col("table") == table)
    last = found.groupBy("key").agg(F.max_by(F.struct("rows", "run"), "at").alias("e"))
    return last.select(F.from_json("key", keys).alias("k"), "e").select("k.*", "e.rows", "e.run")


def pending(expected: DataFrame, log: str, table: str, overwrite: bool = False) -> DataFrame:
    """Expected partitions that have no entry; all of them with ``overwrite``. The columns of ``expected`` are the keys."""
    if overwrite:
        return expected
    done = entries(expected.sparkSession, log, table, _keys(expected))
    return expected.join(done.select(*expected.columns), expected.columns, "left_anti")


def _keys(df: DataFrame) -> str:
    return ", ".join(f"`{c}` {kind}" for c, kind in df.dtypes)


def commit(partitions: DataFrame, keys: list[str], log: str, table: str, run: str) -> None:
    """Append an entry for each of ``partitions`` (keys and rows)."""
    entry = partitions.select(F.lit(table).alias("table"), F.to_json(F.struct(*keys)).alias("key"), F.col("rows").cast("long").alias("rows"), F.lit(run).alias("run"), F.current_timestamp().alias("at"))
    entry.coalesce(1).write.mode("append").parquet(log)


def write(rows: DataFrame, partitions: DataFrame, path: str, log: str, table: str, run: str) -> None:
    """Write the rows of some partitions, then commit them; one without rows is committed with 0. Rows are counted in what is written."""
    keys = partitions.columns
    tables.write(rows, path, keys)
    there = _read(rows.sparkSession, path, rows.schema).join(partitions, keys, "left_semi")
    counts = there.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    commit(partitions.join(counts, keys, "left").na.fill(0, ["rows"]), keys, log, table, run)


def run(expected: DataFrame, compute: Callable[[DataFrame], DataFrame], path: str, log: str, table: str, by: str, name: str, overwrite: bool = False) -> int:
    """Compute and write what the log lacks of ``expected``, and return the number of batches.

    Each value of the key ``by`` (years, say: few enough to be listed on the driver) is a batch, which ``compute`` gets as a table of keys and
    which is committed as a whole; a run that dies loses the batch that it was in.
    """
    todo = pending(expected, log, table, overwrite)
    values = [r[0] for r in todo.select(by).distinct().orderBy(by).collect()]
    for value in values:
        # The work list of this batch is as it was at the start: entries of the batches before don't touch it.
        batch = expected.where(F.col(by).eqNullSafe(F.lit(value)))
        batch = pending(batch, log, table, overwrite)
        write(compute(batch), batch, path, log, table, name)
    return len(values)


def read(spark: SparkSession, path: str, log: str, table: str, schema: str | StructType, keys: str) -> DataFrame:
    """The rows of the finished partitions of a table."""
    done = entries(spark, log, table, keys).drop("rows", "run")
    return tables.without_nan(_read(spark, path, schema).join(done, done.columns, "left_semi"))
