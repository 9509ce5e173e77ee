import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowloom.operators import split as split_module
from rowloom.operators.labels import UnknownLabelsError, split_sizes
from rowloom.operators.split import sample_rows, shuffle_rows, split_by_count, split_by_ratio
from rowloom.plans.dataset_split import train_test_split


def digest(seed, *key):
    return hashlib.md5(":".join([str(seed), *map(str, key)]).encode()).hexdigest()


def numbered(spark, n=500, partitions=4):
    return spark.range(0, n, 1, partitions).withColumn("label", F.col("id") % 3 == 0)


def rows(df):
    return Counter(map(tuple, df.collect()))


def brute_ratio(ids, ratio, seed):
    """Plain sort per class."""
    split = {}
    for label in (True, False):
        mine = sorted((i for i in ids if (i % 3 == 0) == label), key=lambda i: digest(seed, i))
        k = min(max(int(len(mine) * ratio), 1), len(mine) - 1)
        split |= {i: "train" if at < k else "test" for at, i in enumerate(mine)}
    return split


@pytest.mark.parametrize("ratio,seed", [(0.8, 42), (0.29, 1), (0.001, 7), (0.999, 7)])
def test_ratio_split_equals_a_sort_per_class(spark, ratio, seed):
    got = split_by_ratio(numbered(spark), "label", ratio, seed, ["id"])
    assert {r.id: r.split for r in got.collect()} == brute_ratio(range(500), ratio, seed)


def test_partitioning_does_not_matter_but_the_seed_does(spark):
    want = rows(split_by_ratio(numbered(spark), "label", key=["id"]))
    for partitions in (1, 7, 64):
        assert rows(split_by_ratio(numbered(spark, partitions=partitions), "label", key=["id"])) == want
    assert rows(split_by_ratio(numbered(spark), "label", seed=43, key=["id"])) != want


def test_narrowing_in_three_steps_gives_the_same(spark, monkeypatch):
    want = rows(split_by_ratio(numbered(spark), "label", key=["id"]))
    monkeypatch.setattr(split_module, "EXACT_ROWS", 0)
    monkeypatch.setattr(split_module, "FIRST_DIGITS", 1)
    monkeypatch.setattr(split_module, "NEXT_DIGITS", 2)
    assert rows(split_by_ratio(numbered(spark), "label", key=["id"])) == want


def copies_table(spark):
    """A third of the rows are copies of one row, the rest share two keys."""
    return spark.range(900).select(
        F.when(F.col("id") < 300, -1).otherwise(F.col("id")).alias("v"),
        F.when(F.col("id") < 300, "hot").otherwise((F.col("id") % 2).cast("string")).alias("k"),
        (F.col("id") % 3 == 0).alias("label"),
    )


@pytest.mark.parametrize("key", [None, ["k"], ["v"], ["v", "k"]])
@pytest.mark.parametrize("ratio", [0.1, 0.5, 0.77])
def test_copies_and_shared_keys_are_cut_exactly(spark, key, ratio):
    df = copies_table(spark)
    got = split_by_ratio(df, "label", ratio, 5, key)
    assert rows(got.drop("split")) == rows(df)
    sizes = {(r.label, r.split): r["count"] for r in got.groupBy("label", "split").count().collect()}
    for label, n in ((True, 300), (False, 600)):
        assert sizes[label, "train"] == int(n * ratio) and sizes[label, "test"] == n - int(n * ratio)


def test_all_rows_the_same(spark, monkeypatch):
    monkeypatch.setattr(split_module, "COPIES_PER_TASK_ROW", 7)
    df = spark.range(101).select(F.lit("x").alias("a"), F.lit(None).cast("int").alias("b"))
    for n in (0, 1, 50, 101):
        assert rows(sample_rows(df, n)) == Counter({("x", None): n} if n else {})


def test_rows_that_differ_in_microseconds_or_nulls_stay_apart(spark):
    df = spark.sql(
        "select timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0, id/1000000) t,"
        " if(id % 2 = 0, null, id) n, map('a', id) m from range(40)"
    )
    got = sample_rows(df, 20)
    texts = [r[0] for r in got.select(F.to_json(F.struct("n", "m"))).collect()]
    assert len(texts) == len(set(texts)) == 20
    assert got.select("t").distinct().count() == 20


def test_count_split(spark):
    df = numbered(spark)
    got = split_by_count(df, "label", 30, 50, 10, 20, key=["id"])
    sizes = {(r.label, r.split): r["count"] for r in got.groupBy("label", "split").count().collect()}
    assert sizes == {(True, "train"): 30, (False, "train"): 50, (True, "test"): 10, (False, "test"): 20}
    for label in (True, False):
        mine = sorted((i for i in range(500) if (i % 3 == 0) == label), key=lambda i: digest(42, i))
        test, train = (10, 30) if label else (20, 50)
        mark = {r.id: r.split for r in got.where(F.col("label") == label).collect()}
        assert mark == {i: "test" if at < test else "train" for at, i in enumerate(mine[: test + train])}


def test_rows_that_only_swap_a_null_are_no_copies(spark):
    df = spark.range(40).select(
        F.lit(1).alias("k"), F.when(F.col("id") < 20, "a").alias("x"), F.when(F.col("id") >= 20, "a").alias("y"),
        F.when(F.col("id") < 20, F.array(F.lit(None), F.lit(1))).otherwise(F.array(F.lit(1), F.lit(None))).alias("z"),
    )
    got = sample_rows(df, 30, key=["k"])
    counts = sorted(rows(got.select("x", "y", F.to_json("z"))).values())
    assert counts == [10, 20] and got.exceptAll(df).count() == 0


def test_both_cuts_inside_one_group_of_copies(spark):
    df = spark.range(600).select(F.lit(1).alias("v"), (F.col("id") < 300).alias("label"))
    got = split_by_count(df, "label", 100, 7, 50, 3)
    sizes = {(r.label, r.split): r["count"] for r in got.groupBy("label", "split").count().collect()}
    assert sizes == {(True, "train"): 100, (True, "test"): 50, (False, "train"): 7, (False, "test"): 3}


def test_count_split_of_nothing_is_empty(spark):
    assert split_by_count(numbered(spark), "label", key=["id"]).count() == 0


def test_sample(spark):
    df = numbered(spark)
    got = [r.id for r in sample_rows(df, 37, 3, ["id"]).collect()]
    assert sorted(got) == sorted(sorted(range(500), key=lambda i: digest(3, i))[:37])
    assert rows(sample_rows(df, 500)) == rows(df)
    with pytest.raises(ValueError, match="501"):
        sample_rows(df, 501)
    with pytest.raises(ValueError):
        sample_rows(df, -1)


def test_refusals(spark):
    df = numbered(spark)
    for ratio in (0.0, 1.0, -1, 2):
        with pytest.raises(ValueError, match="between 0 and 1"):
            split_by_ratio(df, "label", ratio)
    with pytest.raises(ValueError, match="two rows"):
        split_by_ratio(df.where("label or id = 1"), "label")
    with pytest.raises(ValueError, match="two rows"):
        split_by_ratio(df.where("label"), "label")
    with pytest.raises(UnknownLabelsError):
        split_by_ratio(df.withColumn("label", F.when(F.col("id") > 5, F.col("label"))), "label")
    with pytest.raises(ValueError, match="positive rows asked"):
        split_by_count(df, "label", train_pos=1000)
    with pytest.raises(ValueError, match="zero or more"):
        split_by_count(df, "label", train_pos=-1)
    with pytest.raises(ValueError, match="'z'"):
        split_by_ratio(df, "label", key=["z"])


def test_shuffle_is_a_seeded_permutation(spark):
    df = numbered(spark)
    order = [r.id for r in shuffle_rows(df, 7, ["id"]).collect()]
    assert order == sorted(range(500), key=lambda i: digest(7, i))
    assert order != [r.id for r in shuffle_rows(df, 8, ["id"]).collect()]


@pytest.mark.parametrize("key", [None, ["k"]])
def test_shuffle_scatters_copies(spark, key):
    df = copies_table(spark)
    got = shuffle_rows(df, 1, key)
    assert rows(got) == rows(df)
    hot = [at for at, r in enumerate(got.collect()) if r.v == -1]
    assert len(hot) == 300 and min(hot) < 60 and max(hot) > 840
    assert [r.v for r in got.collect()] == [r.v for r in shuffle_rows(df.repartition(9), 1, key).collect()]


def test_the_split_itself_moves_no_rows(spark, capsys):
    split_by_ratio(numbered(spark), "label", key=["id"]).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Window" not in plan and "Python" not in plan


def test_from_raw_labels_to_sizes(spark):
    df = spark.createDataFrame([(i, " Yes" if i % 4 == 0 else "no ") for i in range(100)], "i int, l string")
    got = train_test_split(df, " l ", key=["i"], text_columns=["i", "absent"])
    assert got.columns == ["i", "l", "split"] and dict(got.dtypes)["i"] == "string"
    assert {r.split: r.n for r in split_sizes(got).collect()} == {"train": 80, "test": 20}
    with pytest.raises(UnknownLabelsError, match="'maybe': 3"):
        train_test_split(df.union(spark.createDataFrame([(-1, "maybe")] * 3, df.schema)), "l")
    with pytest.raises(ValueError, match="mode"):
        train_test_split(df, "l", mode="other")
    counted = train_test_split(df, "l", "count", train_pos=5, test_neg=6)
    assert {r.split: r.n for r in split_sizes(counted).collect()} == {"train": 5, "test": 6}


def test_one_order_for_any_partitions(spark):
    df = spark.range(900).selectExpr("if(id < 300, 0, id) k", "id % 7 v")
    for key in (None, ["k"]):
        orders = [shuffle_rows(df.repartition(n), 5, key).collect() for n in (1, 7, 64)]
        assert orders[0] == orders[1] == orders[2] != df.collect()


def test_labels_have_to_be_truth_values(spark):
    with pytest.raises(ValueError, match="truth values"):
        split_by_ratio(spark.range(9).selectExpr("id", "id % 3 c"), "c")


@pytest.mark.parametrize("kind", ["once", "paired", "hot"])
def test_shuffle_gives_every_task_its_share(spark, kind):
    value = {"once": F.col("id"), "paired": F.floor(F.col("id") / 2), "hot": F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))}
    df = spark.range(200_000, numPartitions=8).select(value[kind].cast("bigint").alias("v"))
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        sizes = [r["count"] for r in shuffle_rows(df, 3, ["v"]).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 200_000 and len(sizes) == 16 and max(sizes) < 2 * 200_000 / 16
