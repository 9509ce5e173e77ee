"""Where shared intermediate data goes, and how much may be broadcast."""

from __future__ import annotations

import tempfile
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.text import quoted

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as ``spark.checkpoint.dir`` names it.

    Only a local session, where driver and executors are one machine, may fall
    back to a new temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="rowloom-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder, so later passes all see the same rows."""
    context, folder = df.sparkSession.sparkContext, shared_dir(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def _bytes(df: DataFrame, name: str) -> Column:
    c, dtype = quoted(name), df.schema[name].dataType
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        c = F.to_json(c)
    elif not isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.lit(16)
    return F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(16)


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Count rows and bytes, added up task by task; only a yes permits a broadcast."""
    width = reduce(add, (_bytes(df, n) for n in df.columns)).cast("bigint")
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("bytes")).first()
    return seen["n"] <= max_rows and (seen["bytes"] or 0) <= max_bytes
