import pytest
from pyspark.sql import functions as F

from tests.test_sources import workbook

from rowloom.sources import positions
from rowloom.sources.files import read_csv
from rowloom.sources.positions import file_row_at, json_line_at, load_row, row_at
from rowloom.sources.writers import write_table


@pytest.fixture(params=[10_000, 0])
def way(request, monkeypatch):
    """Both ways: top-k, and counting ranges of keys."""
    monkeypatch.setattr(positions, "TOP_K", request.param)


def test_row_at(spark, way):
    df = spark.range(200).select(
        "id", F.when(F.col("id") < 90, "hot").otherwise(F.format_string("k%03d", "id")).alias("k"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 2).alias("n"),
    )
    want = sorted(df.collect(), key=lambda r: (r.k, -1 if r.n is None else r.n, r.asDict().__str__()))
    for i in (0, 1, 89, 90, 150, 199):
        got = row_at(df, i, ["k", "n"]).collect()
        assert len(got) == 1 and (got[0].k, got[0].n) == (want[i].k, want[i].n)
    assert len({row_at(df, i, ["k"]).first().id for i in range(0, 90, 9)}) == 10
    for i in (-1, 200):
        with pytest.raises(ValueError):
            row_at(df, i, ["k"])


def test_row_at_among_copies(spark, way):
    df = spark.range(30).select(F.lit(1).alias("a"), (F.col("id") > 9).cast("int").alias("b"))
    assert row_at(df, 5, ["a"]).collect() == [(1, 0)] and row_at(df, 25, ["a"]).collect() == [(1, 1)]


def test_lines_of_json(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"a": 1}\n\n{"a": [1, {"b": null}]}\n[1]\n{"z": "é"}', encoding="utf-8")
    assert json_line_at(spark, str(path), 0) == {"a": 1}
    assert json_line_at(spark, str(path), 1) == {}
    assert json_line_at(spark, str(path), 2) == {"a": [1, {"b": None}]}
    assert json_line_at(spark, str(path), 4) == {"z": "é"}
    for i in (-1, 3, 5):
        with pytest.raises(ValueError):
            json_line_at(spark, str(path), i)


def test_file_order_over_many_pieces(spark, tmp_path):
    for part in range(3):
        (tmp_path / f"{part}.csv").write_text("a,b\n" + "".join(f"{part * 3000 + i},x{i}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = read_csv(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 10
        for i in (0, 1, 2999, 3000, 5555, 8999):
            assert [tuple(r) for r in file_row_at(df, i).collect()] == [(i, f"x{i % 3000}")]
        with pytest.raises(ValueError):
            file_row_at(df, 9000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_one_row_of_a_file_of_each_kind(spark, tmp_path):
    (tmp_path / "a.csv").write_text('i, t\n0,"x\ny"\n1,NA\n2,"z ""q"""\n')
    assert load_row(spark, str(tmp_path / "a.csv"), 0) == {"i": 0, "t": "x\ny"}
    assert load_row(spark, str(tmp_path / "a.csv"), 2) == {"i": 2, "t": 'z "q"'}
    book = workbook(tmp_path / "a.xlsx", {"S": [["i", "t"]] + [[i, f"v{i}"] for i in range(30)]})
    assert load_row(spark, book, 17) == {"i": 17, "t": "v17"}
    (tmp_path / "a.jsonl").write_text('{"i": 1}\n{"t": [2]}\n')
    assert load_row(spark, str(tmp_path / "a.jsonl"), 1) == {"t": [2]}
    spark.range(10, numPartitions=1).write.parquet(str(tmp_path / "a.parquet"))
    assert load_row(spark, str(tmp_path / "a.parquet"), 4) == {"id": 4}
    for name, i in (("a.csv", 3), ("a.xlsx", 30), ("a.jsonl", 2), ("a.parquet", 10), ("a.csv", -1)):
        with pytest.raises(ValueError):
            load_row(spark, str(tmp_path / name), i)


def test_positions_over_large_files(spark, tmp_path):
    for part in range(2):
        (tmp_path / f"{part}.csv").write_text("a\n" + "".join(f"{part * 200_000 + i}\n" for i in range(200_000)))
    df = read_csv(spark, str(tmp_path), multi_line=False)
    for i in (0, 150_000, 199_999, 200_000, 350_000, 399_999):
        assert file_row_at(df, i).collect() == [(i,)]


def test_keys_that_are_not_numbers(spark, way):
    df = spark.sql("select id, if(id < 2, double(id), double('nan')) k from range(6)")
    assert sorted(row_at(df, i, ["k"]).first().id for i in range(6)) == list(range(6))


@pytest.mark.parametrize("kind", ["csv", "jsonl", "parquet"])
def test_a_thousand_positions_by_an_index(spark, tmp_path, kind):
    """Files of several ranges each; the index answers for any list of positions."""
    from rowloom.sources.positions import position_index, rows_at

    path = str(tmp_path / f"t.{kind}")
    rows = spark.range(9000).select("id", F.concat(F.lit("x" * 40), "id").alias("s"))
    write_table(rows.repartition(3), path)
    read = spark.read.schema("id bigint, s string")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        df = {"csv": read.option("header", True).csv, "jsonl": read.json, "parquet": read.parquet}[kind](path)
        files = df.select("_metadata.file_path").distinct().orderBy("file_path").collect()
        by_file = {f.file_path: [] for f in files}
        for r in df.select("id", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("m")).orderBy(
            "file_path", "file_block_start", "m"
        ).collect():
            by_file[r.file_path].append(r.id)
        want = [i for ids in by_file.values() for i in ids]
        index = position_index(df)
        assert kind == "parquet" or index.ranges.count() > 3
        for asked in (list(range(0, 9000, 9)), [8999], [0, 0, 4]):
            got = {r.position: r.id for r in rows_at(df, asked, index).collect()}
            assert got == {p: want[p] for p in asked}
        with pytest.raises(ValueError, match="1 of the positions are out of range: there are 9000"):
            rows_at(df, [3, 9000], index)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_rows_carry_no_lists_of_positions(spark, tmp_path, monkeypatch):
    """With many positions a row that is looked at stays as wide as with one."""
    plans, kept = [], positions.checkpointed

    def seen(df):
        plans.append(df._jdf.queryExecution().analyzed().toString())
        return kept(df)

    write_table(spark.range(3000).repartition(2), str(tmp_path / "t.csv"))
    df = spark.read.schema("id bigint").option("header", True).csv(str(tmp_path / "t.csv"))
    index = positions.position_index(df)
    monkeypatch.setattr(positions, "checkpointed", seen)
    got = positions.rows_at(df, list(range(0, 3000, 2)), index).collect()
    assert sorted(r.position for r in got) == list(range(0, 3000, 2)) and len({r.id for r in got}) == 1500
    assert len(plans) == 1 and "MapInArrow" in plans[0] and "collect_list" not in plans[0]


def test_lines_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    from rowloom import catalog

    rows = spark.range(20_000).select(F.col("id").alias("o_orderkey"), (F.col("id") * 7).alias("o_custkey"))
    rows.write.parquet(str(tmp_path / "orders.parquet"))
    parts, write = [], catalog.write_table

    def seen(df, path):
        parts.append(df.rdd.getNumPartitions())
        write(df, path)

    monkeypatch.setattr(catalog, "write_table", seen)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = catalog.rows_at_positions(spark, str(tmp_path)).where("kind = 'lines'").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sorted((r.position, r.o_orderkey, r.o_custkey) for r in got) == [(i, i, 7 * i) for i in range(0, 1500, 3)]
    assert parts[0] > 1
