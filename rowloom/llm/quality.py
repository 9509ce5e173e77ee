"""Quality rules: fixed base rules, then robust multivariate outliers per language and source.

Each text gives a vector of transformed statistics. For every language and
source the minimum-covariance-determinant estimate of centre and scatter is
worked out by concentration steps from two fixed starts; documents far from
the centre by Mahalanobis distance are rejected. Everything is DataFrame
expressions and aggregates.

* null or blank text: no words, so it fails the base rule;
* null language or source: a group of its own;
* a group with fewer than ``min_group`` rows that passed the base rules uses
  the estimate of its language, and that in turn the estimate of all rows;
* repeated rows are rows like any other; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import SPACE, small, stored, word_array

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["x0", "x1", "x2", "x3"]
PAIRS = [(i, j) for i in range(len(FEATURES)) for j in range(i + 1)]


@dataclass(frozen=True)
class OutlierRule:
    """Settings of the estimate.

    ``share``: part of a group that the estimate rests on. ``cutoff``: largest
    squared distance kept; 33.4 is exceeded once in a million by a
    chi-square with four degrees of freedom. ``floors``: smallest standard
    deviation of each statistic, below which differences are of no concern.
    """

    share: float = 0.75
    steps: int = 4
    min_group: int = 100
    cutoff: float = 33.4
    floors: tuple[float, ...] = (0.08, 0.35, 0.35, 0.12)


#: Bits of a window's number that hold its place, for texts of up to 2^20 words and for longer ones.
PLACE_BITS = 20, 31


def _repeat_words(words: Column, packed: Column, bits: Column) -> Column:
    """Words within 3-word windows found twice or more; ``packed``: sorted (hash bits, position).

    Windows of equal hash bits are neighbours. Where two of them have other
    words, the text's windows are sorted by their words instead.
    """
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1

    def alike(a, b):
        return F.call_function("shiftrightunsigned", a, bits) == F.call_function("shiftrightunsigned", b, bits)

    def same(a, b):
        at, to = a.bitwiseAND(mask).cast("int"), b.bitwiseAND(mask).cast("int")
        equal = alike(a, b)
        for k in range(3):
            equal = equal & (F.get(words, at + k) == F.get(words, to + k))
        return F.coalesce(equal, F.lit(False))

    def both(values, equal):
        return F.filter(values, lambda x, i: equal(F.get(values, i - 1), x) | equal(x, F.get(values, i + 1)))

    by_hash = F.transform(both(packed, same), lambda x: x.bitwiseAND(mask))
    mixed = F.filter(packed, lambda x, i: F.coalesce(alike(F.get(packed, i - 1), x), F.lit(False)) & ~same(F.get(packed, i - 1), x))
    spelt = F.sort_array(
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.struct(*(F.get(words, i + k).alias(f"w{k}") for k in range(3)), i.cast("bigint").alias("at")),
        )
    )
    equal_words = lambda a, b: F.coalesce((a["w0"] == b["w0"]) & (a["w1"] == b["w1"]) & (a["w2"] == b["w2"]), F.lit(False))
    # The sorted windows are bound to a variable, so that they are worked out once.
    by_words = F.get(F.transform(F.array(spelt), lambda all_of: F.transform(both(all_of, equal_words), lambda x: x["at"])), 0)
    found = F.when(F.size(mixed) > 0, by_words).otherwise(by_hash)
    places = F.sort_array(found)
    zero = F.lit(0).cast("bigint")
    return F.aggregate(
        places,
        F.struct(zero.alias("total"), zero.alias("upto")),
        lambda seen, p: F.struct(
            (seen["total"] + p + 3 - F.greatest(p, seen["upto"])).alias("total"), (p + 3).alias("upto")
        ),
        lambda seen: seen["total"],
    )


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with the columns of ``BASE``.

    A repeat is told by the leading bits of a window's hash and confirmed by
    comparing the words; the rest of the 64 bits holds the window's place.
    Counts are exact for texts of any length.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in {text, *BASE}]
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    words = docs.select(*rest, whole.alias("__text"), word_array(whole).alias("__words"))
    n = F.size("__words")
    bits = F.when(n < (1 << 20), PLACE_BITS[0]).otherwise(PLACE_BITS[1])
    windows = F.when(
        n >= 3,
        F.sort_array(
            F.transform(
                F.sequence(F.lit(0), n - 3),
                lambda i: F.call_function(
                    "shiftleft",
                    F.xxhash64(
                        F.get(F.col("__words"), i), F.get(F.col("__words"), i + 1), F.get(F.col("__words"), i + 2)
                    ),
                    bits,
                ).bitwiseOR(i.cast("bigint")),
            )
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split("__text", "\n", -1), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0)
    counted = words.select(
        *rest,
        "__words",
        n.cast("bigint").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("__text", r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        lines.alias("__lines"),
        windows.alias("__windows"),
        bits.alias("__bits"),
    )
    return counted.select(
        *rest,
        *BASE[:3],
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size("__windows") > 1, _repeat_words(F.col("__words"), F.col("__windows"), F.col("__bits")))
        .otherwise(F.lit(0))
        .cast("bigint")
        .alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _vector(rows: DataFrame) -> DataFrame:
    """Mean word length, symbols a hundred characters, repeated lines a hundred words, share of repeated words."""
    n, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    values = [
        F.log(chars / n),
        F.log1p(100.0 * F.col("n_symbols") / chars),
        F.log1p(100.0 * F.col("n_dup_lines") / n),
        F.asin(F.sqrt(F.least(F.col("n_repeat_words") / n, F.lit(1.0)))),
    ]
    return rows.withColumns({name: F.round(v, 4) for name, v in zip(FEATURES, values)})


def _scattered(means: DataFrame, floors) -> DataFrame:
    """Adds the Cholesky factor of the scatter matrix, with floors added to its diagonal."""
    out = means
    for j in range(len(FEATURES)):
        square = F.col(f"c{j}{j}") + F.lit(float(floors[j]) ** 2)
        for k in range(j):
            square = square - F.col(f"l{j}{k}") * F.col(f"l{j}{k}")
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(square, F.lit(1e-12))))
        column = {}
        for i in range(j + 1, len(FEATURES)):
            value = F.col(f"c{i}{j}")
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            column[f"l{i}{j}"] = value / F.col(f"l{j}{j}")
        if column:
            out = out.withColumns(column)
    return out


def _distances(rows: DataFrame) -> DataFrame:
    """Adds ``d2``, the squared Mahalanobis distance, by forward substitution."""
    out, total = rows, F.lit(0.0)
    for i, name in enumerate(FEATURES):
        value = F.col(name) - F.col(f"m{i}")
        for k in range(i):
            value = value - F.col(f"l{i}{k}") * F.col(f"y{k}")
        out = out.withColumn(f"y{i}", value / F.col(f"l{i}{i}"))
        total = total + F.col(f"y{i}") * F.col(f"y{i}")
    return out.withColumn("d2", total)


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    sums = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *(F.avg(x).alias(f"m{i}") for i, x in enumerate(FEATURES)),
        *(F.covar_pop(FEATURES[i], FEATURES[j]).alias(f"c{i}{j}") for i, j in PAIRS),
    )
    return sums


def _grid(d2: Column) -> Column:
    """Distances on a fixed logarithmic grid, so that an exact quantile keeps few values a task."""
    return F.floor(F.log(d2 + F.lit(1e-6)) * 50.0).cast("int")


def _concentrated(rows: DataFrame, start: DataFrame, rule: OutlierRule) -> DataFrame:
    """Concentration steps: the nearest ``share`` of each group gives the next centre and scatter."""
    keys, now = ["grp", "start"], start
    for _ in range(rule.steps):
        far = _distances(rows.join(small(now), "grp")).select(*keys, *FEATURES, _grid(F.col("d2")).alias("g"))
        edge = far.groupBy(*keys).agg(F.percentile("g", F.lit(rule.share)).alias("edge"))
        near = far.join(small(edge), keys).where(F.col("g") <= F.col("edge"))
        now = stored(_scattered(_moments(near, keys).drop("n"), rule.floors))
    return now


def robust_estimates(rows: DataFrame, rule: OutlierRule) -> DataFrame:
    """Centre, Cholesky factor and size of every group ``grp`` of ``rows``."""
    medians = rows.groupBy("grp").agg(
        F.count(F.lit(1)).alias("size"), *(F.percentile(x, F.lit(0.5)).alias(f"m{i}") for i, x in enumerate(FEATURES))
    )
    medians = stored(medians)
    off = rows.join(small(medians), "grp")
    spread = off.groupBy("grp").agg(
        *(F.percentile(F.round(F.abs(F.col(x) - F.col(f"m{i}")), 4), F.lit(0.5)).alias(f"s{i}") for i, x in enumerate(FEATURES))
    )
    spread = stored(spread)
    middle = medians.join(spread, "grp")
    by_median = middle.select(
        "grp",
        F.lit(0).alias("start"),
        *(F.col(f"m{i}") for i in range(len(FEATURES))),
        *((F.pow(1.4826 * F.col(f"s{i}"), 2) if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in PAIRS),
    )
    # The second start rests on the half of the rows whose worst statistic is nearest to the medians.
    worst = F.greatest(
        *(F.abs(F.col(x) - F.col(f"m{i}")) / (1.4826 * F.col(f"s{i}") + float(rule.floors[i])) for i, x in enumerate(FEATURES))
    )
    scored = rows.join(small(middle), "grp").select("grp", *FEATURES, F.round(worst, 2).alias("worst"))
    half = scored.groupBy("grp").agg(F.percentile("worst", F.lit(0.5)).alias("half"))
    inner = scored.join(small(half), "grp").where(F.col("worst") <= F.col("half"))
    by_half = _moments(inner, ["grp"]).drop("n").withColumn("start", F.lit(1))
    starts = stored(_scattered(by_median.unionByName(by_half), rule.floors))
    found = _concentrated(rows, starts, rule)
    volume = sum((F.log(F.col(f"l{i}{i}")) for i in range(len(FEATURES))), F.lit(0.0))
    columns = [c for c in found.columns if c not in {"grp", "start"}]
    best = found.groupBy("grp").agg(
        F.min_by(F.struct(*columns), F.struct(volume.alias("v"), "start")).alias("b")
    )
    return stored(best.select("grp", "b.*").join(medians.select("grp", "size"), "grp"))


def quality_rules(docs: DataFrame, rule: OutlierRule = OutlierRule(), text: str = "text", keep_text: bool = False) -> DataFrame:
    """One row for each row of ``docs``: its other columns, ``BASE``, ``base_failed``, ``d2`` and ``kept``.

    With ``keep_text`` the text stays in the result. Columns of ``docs`` with
    names of the result or of the statistics are replaced or dropped.
    """
    own = [*BASE, *FEATURES, "base_failed", "d2", "kept", "grp", "g_lang", "g_both"]
    docs = docs.drop(*own)
    source = docs.withColumn("__body", F.col(f"`{text}`")) if keep_text else docs
    for name in ("lang", "source"):
        if name not in docs.columns:
            source = source.withColumn(name, F.lit(None).cast("string"))
    key = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in ("lang", "source")]
    measured = text_statistics(source, text).withColumns(
        {"base_failed": base_failed(), "g_lang": key[0], "g_both": F.concat_ws("\x1f", *key)}
    )
    measured = stored(_vector(measured))
    sound = measured.where(~F.col("base_failed"))
    levels = F.explode(F.array(F.col("g_both"), F.col("g_lang"), F.lit("")))
    estimates = robust_estimates(sound.select(levels.alias("grp"), *FEATURES), rule)
    enough = small(estimates.where((F.col("size") >= rule.min_group) | (F.col("grp") == "")))
    sizes = enough.select("grp")
    both, lang = (sizes.select(F.col("grp").alias(c), F.lit(True).alias(f"has_{c}")) for c in ("g_both", "g_lang"))
    chosen = (
        measured.join(small(both), "g_both", "left")
        .join(small(lang), "g_lang", "left")
        .withColumn("grp", F.when(F.col("has_g_both"), F.col("g_both")).when(F.col("has_g_lang"), F.col("g_lang")).otherwise(""))
    )
    judged = _distances(chosen.join(enough, "grp", "left"))
    far = F.coalesce(F.col("d2") > rule.cutoff, F.lit(False))
    names = [c for c in source.columns if c not in {text, "__body", *BASE} and c in docs.columns]
    body = [F.col("__body").alias(text)] if keep_text else []
    return judged.select(
        *(F.col(f"`{c}`") for c in names), *body, *BASE, "base_failed", "d2", (~F.col("base_failed") & ~far).alias("kept")
    )
