from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowloom.operators import joins
from rowloom.operators.joins import hot_keys, lookup_join
from rowloom.operators.sets import complement, union_parts


@pytest.fixture(params=["broadcast", "salted"])
def way(request, monkeypatch):
    if request.param == "salted":
        monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
        monkeypatch.setattr(joins, "LEAST_HOT", 20)
    return request.param


def skewed(spark):
    """A third of the rows has one key, some have none."""
    return spark.range(900, numPartitions=6).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 31 == 1, F.lit(None))
        .otherwise(F.col("id") % 50).cast("bigint").alias("k"),
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_equals_a_plain_join(spark, way, how):
    left = skewed(spark)
    right = spark.createDataFrame([(k, f"v{k}") for k in (7, 8, 9, None, 1000)], "k bigint, v string")
    plain = left.join(
        right.withColumnRenamed("k", "rk"), left.k.eqNullSafe(F.col("rk")), how
    ).drop("rk")
    got = lookup_join(left, right, ["k"], how)
    assert got.columns == plain.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, plain.collect()))


def test_hot_keys_are_counted(spark):
    """Half of the rows, and 0.9 % of them: as many parts as the target asks for; no other key is listed."""
    df = spark.range(100_000, numPartitions=5).select(
        F.when(F.col("id") % 2 == 0, F.lit(-1)).when(F.col("id") % 111 == 1, F.lit(-2)).otherwise(F.col("id")).alias("k")
    )
    counts = Counter(r.k for r in df.collect())
    assert {r.k: r["__parts"] for r in hot_keys(df, ["k"], least=100).collect()} == {
        k: -(-n // 100) for k, n in counts.items() if n > 100
    }
    assert hot_keys(df, ["k"], share=0.2, least=1).collect()[0]["__parts"] == 3


def test_no_task_joins_more_than_its_share(spark, monkeypatch):
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    left = spark.range(60_000, numPartitions=6).select(
        F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), (F.col("id") % 3).alias("v")
    )
    right = left.select("k").distinct()
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        tasks = lookup_join(left, right, ["k"], "left_semi", least=500).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sizes = [r["count"] for r in tasks]
    assert sum(sizes) == 60_000 and max(sizes) < 3 * 60_000 / 32


def test_key_types_have_to_agree(spark):
    with pytest.raises(ValueError, match="side"):
        lookup_join(skewed(spark), spark.sql("select 1 k"), ["k"], "left_anti")


def test_complement(spark, way):
    df = skewed(spark)
    taken = df.where("k = 7 or k is null")
    left = {r.id for r in complement(df, taken, ["k"]).collect()}
    assert left == {r.id for r in df.where("k != 7").collect()}
    assert complement(df, df, ["id"]).count() == 0


def test_union_matches_columns_by_name(spark):
    a, b = spark.sql("select 1 x, 'a' y"), spark.sql("select 'b' y, 2 x")
    assert [tuple(r) for r in union_parts([a, b]).collect()] == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        union_parts([])
