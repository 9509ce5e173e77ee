"""What several operators of this folder need: stored tables, words, checked broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.session import fits_broadcast, shared_dir

SPACE = " \t\n\x0b\x0c\r"
#: Spark's own setting: shuffle files go when the write that needed them has ended.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPACES = r"[\x20\x09-\x0D]+"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    A task that is run anew reads the same rows, whatever executor is lost.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if its counted rows and bytes are within the bound."""
    return F.broadcast(df) if fits_broadcast(df) else df


#: A key is hot beyond this share of all rows, so that there are fewer hot keys than its inverse.
HOT_PARTS = 1024
LEAST_HOT = 1000


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, counts: DataFrame, by: Column) -> DataFrame:
    """Join of ``left`` with a ``right`` that has each key once; the rows of hot keys go to many tasks.

    ``counts`` has the keys and ``n``, how many rows of ``left`` each has at
    least. A key with over ``1 / HOT_PARTS`` of all counted rows is hot; there
    are fewer than ``HOT_PARTS`` of them, which bounds the broadcast. Their left
    rows are dealt by the whole number ``by``, their right rows repeated for
    each part. ``how`` is ``inner``, ``left`` or ``left_semi``.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    share = max(total // HOT_PARTS, LEAST_HOT)
    hot = counts.where(F.col("n") > share).select(*keys, F.ceil(F.col("n") / share).cast("int").alias("__parts"))
    hot = stored(hot.coalesce(1))
    if hot.isEmpty():
        return left.join(right, keys, how)
    hot = F.broadcast(hot)
    parts = F.coalesce("__parts", F.lit(1))
    dealt = left.withColumn("__by", by).join(hot, keys, "left").withColumn("__part", F.pmod("__by", parts).cast("int"))
    repeated = right.join(hot, keys, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1)))
    joined = dealt.drop("__by", "__parts").join(repeated.drop("__parts"), [*keys, "__part"], how)
    return joined.drop("__part")


def word_array(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))


def documents(spark, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")
