"""Vocabulary tables ``(token, id)`` and embedding tables ``(id, vector)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowloom.functions.content import need_columns
from rowloom.operators.joins import lookup_join
from rowloom.session import checkpointed

NUMBERED_AT_ONCE = 1_000_000
LISTED_IN_FILTER = 1_000  # a token list up to this length becomes a filter the scan can use


def token_rows(spark: SparkSession, tokens: list[str]) -> DataFrame:
    """A token list of the caller as ``(token, pos)``, each token once, at its first place."""
    first = {t: i for i, t in reversed(list(enumerate(tokens)))}
    rows = sorted(first.items(), key=lambda item: item[1])
    return spark.createDataFrame(rows, "token string, pos bigint")


def ordered_union(*token_tables: DataFrame) -> DataFrame:
    """``(token, pos)`` over several tables of that shape, one after the other: first place wins.

    Later tables' places are moved behind those of earlier ones. Minima are
    combined before the shuffle, so a very frequent token is no burden.
    """
    united, behind = None, F.lit(0).cast("bigint")
    for table in token_tables:
        need_columns(table, ["token", "pos"], "token table")
        moved = table.select("token", (F.col("pos") + behind).cast("bigint").alias("pos"))
        united = moved if united is None else united.unionByName(moved)
        if table is not token_tables[-1]:
            behind = behind + _size(table, "pos")
    if united is None:
        raise ValueError("no token tables to unite")
    return united.groupBy("token").agg(F.min("pos").alias("pos"))


def merge_token_lists(first: Column, second: Column) -> Column:
    """The array form of ``ordered_union``."""
    return F.array_distinct(F.concat(first, second))


def _size(df: DataFrame, number: str) -> Column:
    """One past the largest number, zero for an empty table, as a scalar subquery."""
    return df.select(F.coalesce(F.max(number) + 1, F.lit(0)).cast("bigint")).scalar()


def _as_rows(vocab: DataFrame, tokens: list[str] | DataFrame) -> DataFrame:
    return token_rows(vocab.sparkSession, tokens) if isinstance(tokens, list) else tokens


def lookup_tokens(
    vocab: DataFrame, tokens: list[str] | DataFrame, encoded: str | None = None
) -> DataFrame:
    """``(token, token_id, in_vocab)`` for each token of a list or of a table with a ``token`` column.

    Only lists and tables of proven size are broadcast. A table may also carry
    an ``encoded`` id list, reported with ``is_single_token``.
    """
    need_columns(vocab, ["token", "id"], "vocabulary")
    asked = _as_rows(vocab, tokens)
    known = vocab.select("token", "id")
    if isinstance(tokens, list):
        if len(tokens) <= LISTED_IN_FILTER:
            known = known.where(F.col("token").isin(tokens))
        else:
            known = lookup_join(known, asked.select("token"), ["token"], "left_semi")
    known = known.groupBy("token").agg(F.min("id").alias("token_id"))
    if isinstance(tokens, list) and len(tokens) <= LISTED_IN_FILTER:
        # at most one row for each listed token is left here
        found = asked.join(F.broadcast(known), "token", "left")
    else:
        found = lookup_join(asked, known, ["token"], "left")
    report = [F.col("token"), F.col("token_id"), F.col("token_id").isNotNull().alias("in_vocab")]
    if encoded is not None:
        need_columns(asked, [encoded], "encoded tokens")
        ids = F.col(encoded)
        report += [ids.alias("encoded"), (F.size(ids) == 1).alias("is_single_token")]
    return found.select(*report)


def _numbered(rows: DataFrame, order: str) -> DataFrame:
    """Adds ``nth`` (from zero, by ``order``): ranges of about ``NUMBERED_AT_ONCE`` rows are sorted and counted by a task each.

    What one task sees of all is a count for each range.
    """
    rows = checkpointed(rows)
    parts = max(1, -(-rows.count() // NUMBERED_AT_ONCE))
    ranges = checkpointed(rows.repartitionByRange(parts, order, "token").sortWithinPartitions(order, "token"))
    in_range = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = ranges.withColumns({"__range": F.spark_partition_id(), "__in": in_range})
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("__n")).select(
        "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")
    )
    return placed.join(F.broadcast(offsets), "__range").withColumn("nth", F.col("__before") + F.col("__in")).drop("__range", "__in", "__before")


def vocabulary_state(vocab: DataFrame, tokens: list[str]) -> tuple[dict[str, int], int]:
    """The ids of those listed tokens that the vocabulary has, and one past its largest id: one scan for a short list."""
    if len(set(tokens)) > LISTED_IN_FILTER:
        known = {r["token"]: r["token_id"] for r in lookup_tokens(vocab, tokens).where("in_vocab").collect()}
        return known, vocab.agg(F.coalesce(F.max("id") + 1, F.lit(0))).first()[0]
    listed = F.when(F.col("token").isin(list(set(tokens))), F.struct("token", "id"))
    # No more different tokens than the caller listed, and few ids each.
    seen = vocab.agg(F.collect_set(listed).alias("known"), F.coalesce(F.max("id") + 1, F.lit(0)).alias("size")).first()
    known: dict[str, int] = {}
    for token, id_ in seen["known"]:
        if id_ is not None:
            known[token] = min(id_, known.get(token, id_))
    return known, seen["size"]


def append_tokens(vocab: DataFrame, tokens: list[str] | DataFrame) -> DataFrame:
    """The vocabulary with unseen tokens added under the next ids, in list (``pos``) order.

    A list's new tokens are numbered where the list is, on the driver. A table's
    are numbered by many tasks.
    """
    need_columns(vocab, ["token", "id"], "vocabulary")
    old, schema = vocab.select("token", "id"), vocab.select("token", "id").schema
    if isinstance(tokens, list):
        known, start = vocabulary_state(vocab, tokens)
        fresh = [t for t in dict.fromkeys(tokens) if t not in known]
        if not fresh:
            return old
        rows = [(t, start + i) for i, t in enumerate(fresh)]
        return old.unionByName(vocab.sparkSession.createDataFrame(rows, schema))
    need_columns(tokens, ["token", "pos"], "token table")
    known = vocab.select("token").distinct()
    fresh = lookup_join(ordered_union(tokens), known, ["token"], "left_anti")
    numbered = _numbered(fresh, "pos").select(
        "token", (F.col("nth") + _size(vocab, "id")).cast(schema["id"].dataType).alias("id")
    )
    return old.unionByName(numbered)


def alignment_report(
    vocab: DataFrame, matrix: DataFrame, tokens: list[str] | DataFrame, id_col: str = "id"
) -> DataFrame:
    """``(check, severity, token, id)``: where vocabulary and embedding rows do not fit together.

    ``vocab_larger`` and ``bad_token_id`` are errors, ``sizes_differ`` a warning.
    """
    need_columns(matrix, [id_col], "embedding table")
    size = matrix.select(F.count(F.lit(1))).scalar()
    vocab_size = vocab.select(F.count(F.lit(1))).scalar()
    token_id = F.col("token_id")
    bad = (
        lookup_tokens(vocab, tokens)
        .where(token_id.isNull() | (token_id < 0) | (token_id >= size))
        .select(
            F.lit("bad_token_id").alias("check"),
            F.lit("error").alias("severity"),
            "token",
            token_id.cast("bigint").alias("id"),
        )
    )

    def size_row(check: str, severity: str, when: Column) -> DataFrame:
        one = vocab.sparkSession.range(1).where(when)
        return one.select(
            F.lit(check).alias("check"),
            F.lit(severity).alias("severity"),
            F.lit(None).cast("string").alias("token"),
            F.lit(None).cast("bigint").alias("id"),
        )

    return (
        bad.unionByName(size_row("vocab_larger", "error", vocab_size > size))
        .unionByName(size_row("sizes_differ", "warning", vocab_size != size))
    )


def refuse_misalignment(report: DataFrame) -> None:
    """Raise when an alignment report holds errors."""
    errors = report.where(F.col("severity") == "error").limit(50).collect()
    if errors:
        raise ValueError(f"vocabulary and embeddings do not fit: {[tuple(r) for r in errors]}")


def grow_embeddings(
    matrix: DataFrame, vocab_size: int, id_col: str = "id", vector_col: str = "vector"
) -> DataFrame:
    """The embedding table with rows up to ``vocab_size``; old rows unchanged, new vectors null."""
    need_columns(matrix, [id_col, vector_col], "embedding table")
    rows = matrix.agg(F.coalesce(F.max(id_col) + 1, F.lit(0))).first()[0]
    old = matrix.select(id_col, vector_col)
    if vocab_size <= rows:
        return old
    new = matrix.sparkSession.range(rows, vocab_size).select(
        F.col("id").cast(matrix.schema[id_col].dataType).alias(id_col),
        F.lit(None).cast(matrix.schema[vector_col].dataType).alias(vector_col),
    )
    return old.unionByName(new)


def initialise_tokens(
    matrix: DataFrame,
    vocab: DataFrame,
    tokens: list[str],
    reference_id: int,
    old_vocab_size: int,
    overwrite_existing: bool = False,
    id_col: str = "id",
    vector_col: str = "vector",
) -> DataFrame:
    """Copies the reference row's vector into the listed tokens' rows.

    Rows below ``old_vocab_size`` belong to tokens that were there before and are
    left alone unless ``overwrite_existing``. Run it again on a second table whose
    weights are not shared.
    """
    need_columns(matrix, [id_col, vector_col], "embedding table")
    ids = sorted(set(vocabulary_state(vocab, tokens)[0].values()))
    if not overwrite_existing:
        ids = [i for i in ids if i >= old_vocab_size]
    if not ids:
        return matrix.select(id_col, vector_col)
    reference = matrix.where(F.col(id_col) == reference_id).select(vector_col).scalar()
    copied = F.coalesce(reference, F.raise_error(F.lit(f"no embedding row {reference_id}")))
    listed = F.col(id_col).isin(ids)
    if len(ids) > LISTED_IN_FILTER:
        kind = matrix.schema[id_col].dataType
        marks = matrix.sparkSession.createDataFrame([(i, True) for i in ids], f"id {kind.simpleString()}, __listed boolean")
        matrix = lookup_join(matrix.select(id_col, vector_col), marks.withColumnRenamed("id", id_col), [id_col], "left")
        listed = F.coalesce("__listed", F.lit(False))
    return matrix.select(
        id_col,
        F.when(listed, copied).otherwise(F.col(vector_col)).alias(vector_col),
    )
