"""Exact, seeded draws without replacement: splits, samples and shuffles.

Each row gets a digest of seed and key, and "the first k rows of a class" means
the k smallest digests. The digest of the k-th row is found from histograms of
digest prefixes, so no class is ever sorted or gathered: the input is only
counted, and the result is one projection that compares digests with literals.
Which rows are drawn depends on seed and keys alone, not on partitioning.

Rows of one digest are told apart by a digest of the whole row. Rows that agree
even there are copies of each other. Where a cut runs through a group of copies,
the group is counted, its share of each part follows by arithmetic, and the
copies are written out again from one representative by many tasks, so a group
that holds a third of the table does not end up in one task.

The input is read several times; checkpoint it first if reading it again may
give other rows (``rowloom.session.checkpointed``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.content import need_columns
from rowloom.functions.rows import JSON_OF_ROWS, row_fingerprint, row_text
from rowloom.functions.text import quoted
from rowloom.operators.joins import lookup_join
from rowloom.operators.labels import UnknownLabelsError
from rowloom.session import checkpointed

FIRST_DIGITS = 3  # 4,096 buckets per class in the first histogram
GUESSED_DIGITS = 6  # resolution of the first histogram where a cut is expected
GUESSED_BUCKETS = 8  # how far from the expected place, in buckets
NEXT_DIGITS = 8  # up to 1,048,576 buckets inside one bucket of the first
ALL_DIGITS = 32
EXACT_ROWS = 1_000_000  # a bucket up to this size is resolved digest by digest
COPIES_PER_TASK_ROW = 100_000

# --- digests ----------------------------------------------------------------

def _key_part(df: DataFrame, name: str) -> Column:
    dtype, c = df.schema[name].dataType, quoted(name)
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        c = F.to_json(c, JSON_OF_ROWS)
    elif isinstance(dtype, T.BinaryType):
        c = F.hex(c)
    return F.coalesce(c.cast("string"), F.lit(""))


def row_digest(df: DataFrame, seed: int, key: list[str] | None) -> Column:
    """``md5("seed:key:key…")`` as 32 hex digits; without a key the whole row is the key."""
    if key is None:
        return F.md5(F.concat_ws(":", F.lit(str(seed)), row_text(df)))
    need_columns(df, key, "key")
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(_key_part(df, k) for k in key)))


# --- locating the k-th digest -----------------------------------------------

@dataclass(frozen=True)
class _Cut:
    """The place of row number ``rank`` of a class: inside the rows whose digest starts with
    ``prefix``, of which there are ``n`` with ``start`` rows of the class before them."""

    cls: object
    no: int
    rank: int
    prefix: str
    start: int
    n: int

    @property
    def settled(self) -> bool:
        return self.rank == self.start + self.n

    @property
    def bound(self) -> str:
        """Digests of rows up to the cut are below this text (``g`` sorts after every hex digit)."""
        return self.prefix + "g"


def _histogram(rows: DataFrame, prefix: Column) -> DataFrame:
    return rows.groupBy("cls", prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n"))


def _first_prefix(guesses: list[float]) -> Column:
    """Three digits of the digest, more of them around the places where cuts are expected.

    Digests are spread evenly, so a cut that gives a share of each class to a part
    lies close to that share of the digest range.
    """
    digest = F.col("digest")
    prefix = F.substring(digest, 1, FIRST_DIGITS)
    buckets = 16**FIRST_DIGITS
    for share in guesses:
        low = max(int(share * buckets) - GUESSED_BUCKETS, 0)
        high = min(int(share * buckets) + GUESSED_BUCKETS, buckets - 1)
        near = (digest >= f"{low:0{FIRST_DIGITS}x}") & (digest < f"{high:0{FIRST_DIGITS}x}g")
        prefix = F.when(near, F.substring(digest, 1, GUESSED_DIGITS)).otherwise(prefix)
    return prefix


def _first_pass(
    rows: DataFrame,
    cut_ranks: list[Callable[[Column, Column], Column]],
    guesses: list[float],
) -> tuple[dict, list[_Cut]]:
    """Class totals and, for each class and cut, the first-level bucket the cut falls into."""
    by_class = Window.partitionBy("cls")
    running = by_class.orderBy("prefix").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    hist = _histogram(rows, _first_prefix(guesses)).select(
        "cls",
        "prefix",
        "n",
        F.sum("n").over(running).alias("upto"),
        F.sum("n").over(by_class).alias("total"),
    )
    found = []
    for j, rank_of in enumerate(cut_ranks):
        rank = rank_of(F.col("cls"), F.col("total"))
        here = (F.col("upto") - F.col("n") < rank) & (rank <= F.col("upto"))
        place = F.struct("prefix", (F.col("upto") - F.col("n")).alias("start"), "n")
        found += [F.max(rank).alias(f"rank{j}"), F.max(F.when(here, place)).alias(f"place{j}")]
    totals, cuts = {}, []
    for r in hist.groupBy("cls").agg(F.max("total").alias("total"), *found).collect():
        totals[r["cls"]] = r["total"]
        for j in range(len(cut_ranks)):
            place = r[f"place{j}"]
            if place is not None:
                cuts.append(
                    _Cut(r["cls"], j, r[f"rank{j}"], place["prefix"], place["start"], place["n"])
                )
    return totals, cuts


def _within(cut: _Cut) -> Column:
    return F.col("cls").eqNullSafe(F.lit(cut.cls)) & F.col("digest").startswith(cut.prefix)


def _narrow(rows: DataFrame, cuts: list[_Cut], digits: int) -> list[_Cut]:
    """Each cut's bucket at a longer prefix; counts only rows of the buckets known so far."""
    spark = rows.sparkSession
    inside = F.lit(False)
    for c in cuts:
        inside = inside | _within(c)
    cls_type = rows.schema["cls"].dataType
    wanted = spark.createDataFrame(
        [(c.cls, c.prefix, c.no, c.rank, c.start) for c in cuts],
        T.StructType(
            [
                T.StructField("cls", cls_type),
                T.StructField("parent", T.StringType()),
                T.StructField("no", T.IntegerType()),
                T.StructField("rank", T.LongType()),
                T.StructField("start", T.LongType()),
            ]
        ),
    )
    length = len(cuts[0].prefix)
    hist = _histogram(rows.where(inside), F.substring("digest", 1, digits)).withColumn(
        "parent", F.substring("prefix", 1, length)
    )
    running = (
        Window.partitionBy("cls", "no")
        .orderBy("prefix")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # one row per class and cut, so this side is a handful of rows by construction
    places = (
        hist.join(F.broadcast(wanted), ["cls", "parent"])
        .withColumn("upto", F.col("start") + F.sum("n").over(running))
        .where((F.col("upto") - F.col("n") < F.col("rank")) & (F.col("rank") <= F.col("upto")))
    )
    return [
        _Cut(r["cls"], r["no"], r["rank"], r["prefix"], r["upto"] - r["n"], r["n"])
        for r in places.collect()
    ]


def _settle(rows: DataFrame, cuts: list[_Cut]) -> list[_Cut]:
    """Lengthen prefixes until each cut falls between two digests or inside one whole digest."""
    done: list[_Cut] = []
    todo = cuts
    while todo:
        done += [c for c in todo if c.settled or len(c.prefix) == ALL_DIGITS]
        todo = [c for c in todo if not c.settled and len(c.prefix) < ALL_DIGITS]
        steps: dict[tuple[int, int], list[_Cut]] = {}
        for c in todo:
            far = c.n > EXACT_ROWS and len(c.prefix) < NEXT_DIGITS
            steps.setdefault((len(c.prefix), NEXT_DIGITS if far else ALL_DIGITS), []).append(c)
        todo = []
        for (_, digits), group in steps.items():
            todo += _narrow(rows, group, digits)
    return done


# --- allotting rows to named parts ------------------------------------------

@dataclass(frozen=True)
class _Part:
    name: str
    upto: Callable[[Column, Column], Column]  # (class, class total) -> last row number
    share: float | None = None  # about which share of each class that is, where known


def _allot(
    df: DataFrame,
    cls: Column,
    parts: list[_Part],
    rest: str | None,
    seed: int,
    key: list[str] | None,
    out: str,
    check: Callable[[dict], None],
) -> DataFrame:
    """Rows with their part's name in ``out``; rows past the last part get ``rest`` or are left out."""
    digest = row_digest(df, seed, key)
    rows = df.select(cls.alias("cls"), digest.alias("digest"))
    guesses = [p.share for p in parts if p.share is not None]
    totals, firsts = _first_pass(rows, [p.upto for p in parts], guesses)
    check(totals)
    cuts = _settle(rows, firsts)

    tied = [c for c in cuts if not c.settled]
    inner: dict[tuple, _Cut] = {}
    copies = {(c.cls, c.prefix) for c in tied}
    if tied and key is not None:
        copies = _groups_of_copies(df, cls, digest, tied)
        mixed = [c for c in tied if (c.cls, c.prefix) not in copies]
        if mixed:
            inner = _cuts_among_equal_keys(df, cls, digest, mixed)

    whole = F.md5(row_text(df))
    before: dict[tuple, Column] = {}
    groups: dict[tuple, tuple[int, int]] = {}
    for c in cuts:
        if c.settled:
            before[c.cls, c.no] = digest < c.bound
        elif (c.cls, c.prefix) in copies:
            before[c.cls, c.no] = digest < c.prefix
            groups[c.cls, c.prefix, None] = (c.start, c.n)
        else:
            i = inner[c.cls, c.no]
            limit = i.bound if i.settled else i.prefix
            before[c.cls, c.no] = (digest < c.prefix) | ((digest == c.prefix) & (whole < limit))
            if not i.settled:
                groups[c.cls, c.prefix, i.prefix] = (c.start + i.start, i.n)

    ranks = {(c.cls, c.no): c.rank for c in cuts}
    name_of = None
    for value in totals:
        chosen = F.lit(rest).cast("string")
        for no in reversed(range(len(parts))):
            if (value, no) in before:
                chosen = F.when(before[value, no], F.lit(parts[no].name)).otherwise(chosen)
        is_value = cls.eqNullSafe(F.lit(value))
        name_of = F.when(is_value, chosen) if name_of is None else name_of.when(is_value, chosen)
    if name_of is None:
        name_of = F.lit(None).cast("string")

    def in_group(g: tuple) -> Column:
        same = cls.eqNullSafe(F.lit(g[0])) & (digest == g[1])
        return same if g[2] is None else same & (whole == g[2])

    body = df
    for g in groups:
        body = body.where(~in_group(g))
    body = body.withColumn(out, name_of)
    if rest is None:
        body = body.where(F.col(out).isNotNull())
    for g, (start, n) in groups.items():
        ends = [(p.name, ranks.get((g[0], no), 0)) for no, p in enumerate(parts)]
        shares = _shares(start, n, ends, rest)
        body = body.unionByName(_written_out(df, in_group(g), shares, out))
    return body


def _group_number(cls: Column, digest: Column, groups: list[tuple]) -> Column:
    """Which of a few (class, digest) groups a row is in; null for all other rows."""
    number = F.lit(None).cast("int")
    for i, (value, prefix) in enumerate(groups):
        same = cls.eqNullSafe(F.lit(value)) & (digest == prefix)
        number = F.when(same, F.lit(i)).otherwise(number)
    return number


def _groups_of_copies(df: DataFrame, cls: Column, digest: Column, tied: list[_Cut]) -> set[tuple]:
    """Those of the cuts' groups whose rows are all the same, told by two hashes of the row."""
    groups = list(dict.fromkeys((c.cls, c.prefix) for c in tied))
    number = _group_number(cls, digest, groups)
    spread = []
    for salt in (1, 2):
        h = row_fingerprint(df, salt)
        spread.append(F.min(h) == F.max(h))
    found = (
        df.where(number.isNotNull())
        .groupBy(number.alias("group"))
        .agg((spread[0] & spread[1]).alias("same"))
        .collect()
    )
    return {groups[r["group"]] for r in found if r["same"]}


def _cuts_among_equal_keys(
    df: DataFrame, cls: Column, digest: Column, tied: list[_Cut]
) -> dict[tuple, _Cut]:
    """Cuts that run through different rows of one key, placed by a digest of the whole row."""
    groups = list(dict.fromkeys((c.cls, c.prefix) for c in tied))
    group_no = {g: i for i, g in enumerate(groups)}
    number = _group_number(cls, digest, groups)
    rows = (
        df.where(number.isNotNull())
        .select(number.alias("cls"), F.md5(row_text(df)).alias("digest"))
    )

    def rank_of(no: int) -> Callable[[Column, Column], Column]:
        rank = F.lit(0)
        for c in tied:
            if c.no == no:
                is_group = F.col("cls") == group_no[c.cls, c.prefix]
                rank = F.when(is_group, F.lit(c.rank - c.start)).otherwise(rank)
        return lambda _cls, _total: rank

    numbers = sorted({c.no for c in tied})
    guesses = [(c.rank - c.start) / c.n for c in tied]
    _, firsts = _first_pass(rows, [rank_of(no) for no in numbers], guesses)
    return {
        (groups[c.cls][0], numbers[c.no]): replace(c, cls=groups[c.cls][0], no=numbers[c.no])
        for c in _settle(rows, firsts)
    }


def _shares(
    start: int, n: int, ends: list[tuple[str, int]], rest: str | None
) -> list[tuple[str, int]]:
    """How many of rows ``start .. start + n - 1`` fall to each part."""
    shares, at = [], start
    for name, end in ends:
        take = min(end, start + n) - at
        if take > 0:
            shares.append((name, take))
            at += take
    if rest is not None and at < start + n:
        shares.append((rest, start + n - at))
    return shares


def _written_out(
    df: DataFrame, which: Column, shares: list[tuple[str, int]], out: str
) -> DataFrame:
    """A group of copies, written from one of its rows: ``count`` times for each share."""
    # all rows of the group are the same, so each task needs to offer no more than one of them
    one = df.where(which).limit(1).select(F.struct(*(quoted(n) for n in df.columns)).alias("__row"))
    each = F.array(
        *(F.struct(F.lit(name).alias("part"), F.lit(n).cast("bigint").alias("n")) for name, n in shares)
    )
    rows = one.select("__row", F.inline(each))
    return copies_of(rows, "n", ["part"]).select("__row.*", F.col("part").alias(out))


def copies_of(rows: DataFrame, count: str, by: list[str]) -> DataFrame:
    """Each row ``count`` times, numbered from zero in ``__copy``, a large count shared out over tasks.

    ``by`` names columns that tell the rows apart: pieces are dealt by them and by their place.
    """
    size = F.lit(COPIES_PER_TASK_ROW).cast("bigint")
    pieces = rows.withColumn(
        "__first", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1, size))
    )
    last = F.least(F.col("__first") + size, F.col(count)) - 1
    # A number of its own, or adaptive execution would join the small pieces to one task again.
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8)
    return (
        pieces.repartition(tasks, *by, "__first")
        .withColumn("__copy", F.explode(F.sequence("__first", last)))
        .drop("__first")
    )


# --- the operators ----------------------------------------------------------

def _need_known(totals: dict) -> None:
    if totals.get(None):
        raise UnknownLabelsError(f"{totals[None]} rows have an unknown label")


def _need_truth_values(df: DataFrame, label: str) -> None:
    need_columns(df, [label], "label column")
    kind = df.select(quoted(label)).schema[0].dataType
    if kind.typeName() != "boolean":
        raise ValueError(f"label column {label!r} has to hold truth values, not {kind.simpleString()}")


def split_by_ratio(
    df: DataFrame,
    label: str,
    train_ratio: float = 0.8,
    seed: int = 42,
    key: list[str] | None = None,
    out: str = "split",
) -> DataFrame:
    """Every row marked ``train`` or ``test``, each class cut at exactly its share.

    A class of n rows gives ``int(n * train_ratio)`` of them to train, but at
    least one row to each part.
    """
    if not 0.0 < train_ratio < 1.0:
        raise ValueError(f"train_ratio has to lie between 0 and 1, not {train_ratio}")
    _need_truth_values(df, label)

    def train_rows(_cls: Column, total: Column) -> Column:
        share = (total.cast("double") * F.lit(float(train_ratio))).cast("bigint")
        return F.greatest(F.lit(1).cast("bigint"), F.least(share, total - 1))

    def check(totals: dict) -> None:
        _need_known(totals)
        short = {c: totals.get(c, 0) for c in (True, False) if totals.get(c, 0) < 2}
        if short:
            raise ValueError(f"a split by ratio needs two rows of each class, not {short}")

    parts = [_Part("train", train_rows, train_ratio)]
    return _allot(df, quoted(label), parts, "test", seed, key, out, check)


def split_by_count(
    df: DataFrame,
    label: str,
    train_pos: int = 0,
    train_neg: int = 0,
    test_pos: int = 0,
    test_neg: int = 0,
    seed: int = 42,
    key: list[str] | None = None,
    out: str = "split",
) -> DataFrame:
    """Exactly the asked number of rows for each class and part; test is drawn first, the rest is left out."""
    _need_truth_values(df, label)
    asked = {True: (test_pos, train_pos), False: (test_neg, train_neg)}
    if min(n for pair in asked.values() for n in pair) < 0:
        raise ValueError("counts have to be zero or more")

    def check(totals: dict) -> None:
        _need_known(totals)
        for c, (test, train) in asked.items():
            if totals.get(c, 0) < test + train:
                kind = "positive" if c else "negative"
                raise ValueError(f"{test + train} {kind} rows asked for, {totals.get(c, 0)} there")

    def upto(last: int) -> Callable[[Column, Column], Column]:
        ends = {c: sum(pair[:last]) for c, pair in asked.items()}
        return lambda cls, _total: F.when(cls, F.lit(ends[True])).otherwise(F.lit(ends[False]))

    parts = [_Part("test", upto(1)), _Part("train", upto(2))]
    return _allot(df, quoted(label), parts, None, seed, key, out, check)


def sample_rows(df: DataFrame, n: int, seed: int = 42, key: list[str] | None = None) -> DataFrame:
    """Exactly ``n`` rows, drawn without replacement."""
    if n < 0:
        raise ValueError("the sample size has to be zero or more")

    def check(totals: dict) -> None:
        if sum(totals.values()) < n:
            raise ValueError(f"{n} rows asked for, {sum(totals.values())} there")

    parts = [_Part("in", lambda _cls, _total: F.lit(n))]
    return _allot(df, F.lit(True), parts, None, seed, key, "__part", check).drop("__part")


def shuffle_rows(df: DataFrame, seed: int = 42, key: list[str] | None = None) -> DataFrame:
    """All rows in a seeded random order, which does not depend on the partitions.

    A row's place is the digest of its key, then a hash of the row. Rows that
    occur once, told by a count of hashes, go straight into one sort by range.
    Of copies the first takes that place and each other a digest of its own, so
    they are spread over the order; they are written out again from one of them
    by many tasks.
    """
    digest, whole = row_digest(df, seed, key), F.md5(row_text(df))
    placed = df.select(F.struct(*(quoted(n) for n in df.columns)).alias("__row"), digest.alias("__place"), whole.alias("__g"))
    counts = placed.groupBy("__place", "__g").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    counts = checkpointed(counts)
    if not counts.isEmpty():
        keys = ["__place", "__g"]
        once = lookup_join(placed, counts.select(*keys), keys, "left_anti")
        again = lookup_join(placed, counts.select(*keys), keys, "left_semi")
        groups = again.groupBy(*keys).agg(F.any_value("__row").alias("__row"))
        copies = copies_of(groups.join(counts, keys), "__n", keys)
        moved = F.md5(F.concat_ws(":", "__place", "__g", "__copy"))
        copies = copies.withColumn("__place", F.when(F.col("__copy") == 0, F.col("__place")).otherwise(moved))
        placed = once.unionByName(copies.select("__row", *keys))
    return placed.orderBy("__place", "__g").select("__row.*")
