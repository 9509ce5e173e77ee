"""Document fingerprints from closed syncmers, by DataFrame expressions only.

The symbols of a text are its words; every character is a symbol in scripts
written without spaces and in runs of over 32 characters. Each symbol ends one
k-mer of nine symbols, which reaches over blanks at the text's start. A k-mer is
chosen if the least of its eight inner 2-mers, by hash, is the first or the
last. That depends on the k-mer alone, so equal passages give equal anchors
whatever stands around them. Pairs of blanks are least, so the first seven
k-mers are always chosen and the shortest texts have anchors too. The scheme is
the same for texts of all lengths.

The fingerprint lists the anchors' 32-bit hashes in order of place, each with its
distance in symbols from the anchor before it. Likeness matches by place: equal
anchors of two texts are paired in order of place, and a pair counts if the
pair before or after it stands in the same order at a like distance (the start
of the text is a pair as well). Likeness is the share of counted pairs among all
anchors, a pair being one of them; two texts without any anchor are alike.

Null texts are empty; empty and blank texts have no anchor. Texts of any length
are read whole, as arrays of one row: some 100 bytes a word while in work. An
empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Thai to Burmese, Khmer, kana and Han: scripts without spaces between words.
UNSPACED = r"\x{E00}-\x{EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}"
OUTSIDE = rf"\x20\x09-\x0D{UNSPACED}"
SYMBOL = rf"(?<![^{OUTSIDE}])[^{OUTSIDE}]{{1,32}}(?![^{OUTSIDE}])|[^\x20\x09-\x0D]"
K, S = 9, 2
#: Symbols by which the distances of two neighbouring pairs may differ.
SLACK = 8
#: Text in a stretch of the key order, and how many stretches there are at most: beyond, they grow.
BUCKET_BYTES, BUCKETS = 16 << 20, 1 << 16
#: A row counts once for each so many bytes where the borders of stretches are looked for.
WEIGHT_BYTES = 64 << 10
LEAST = -(1 << 63)


def symbols(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(SYMBOL), F.lit(0))


def mers(words: Column) -> Column:
    """Hashes of the 2-mers that end at each symbol, after those of blanks that the first k-mers begin with."""
    blanks = F.array_repeat(F.lit(LEAST).cast("bigint"), K - S)
    return F.concat(blanks, F.transform(words, lambda w, i: F.xxhash64(F.get(words, i - 1), w)))


def anchors(words: Column, pairs: Column) -> Column:
    """All anchors in order of place, as hash * 2^31 + place; ``pairs``: ``mers(words)`` as a column."""
    w = K - S + 1

    def closed(i):
        inner = F.least(*(F.get(pairs, i + j) for j in range(1, w - 1)))
        return inner >= F.least(F.get(pairs, i), F.get(pairs, i + (w - 1)))

    def value(i):
        hashed = F.xxhash64(*(F.get(pairs, i + j) for j in (*range(0, w - 1, 2), w - 1)))
        return F.shiftleft(hashed.bitwiseAND(F.lit(0xFFFFFFFF)), 31).bitwiseOR(i.cast("bigint"))

    n = F.size(words)
    found = F.transform(F.filter(F.sequence(F.lit(0), n - 1), closed), value)
    return F.when(n > 0, found).otherwise(F.array().cast("array<bigint>"))


def _hash(anchor: Column) -> Column:
    return F.shiftrightunsigned(anchor, 31)


def _place(anchor: Column) -> Column:
    return anchor.bitwiseAND(F.lit((1 << 31) - 1))


def with_anchors(rows: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the anchors of a text column. Symbols and 2-mers are columns first, so each is worked out once."""
    read = rows.withColumn("__words", symbols(F.col(f"`{text}`")))
    read = read.withColumn("__pairs", mers(F.col("__words")))
    return read.withColumn(out, anchors(F.col("__words"), F.col("__pairs"))).drop("__words", "__pairs")


def fingerprint(found: Column) -> Column:
    """The anchors as ``hash:distance``, joined by points; the first distance is from the text's start."""
    return F.array_join(
        F.transform(
            found,
            lambda x, i: F.concat(
                F.lower(F.hex(_hash(x))),
                F.lit(":"),
                (_place(x) - F.coalesce(_place(F.get(found, i - 1)), F.lit(0).cast("bigint"))).cast("string"),
            ),
        ),
        ".",
    )


def with_likeness(rows: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Adds the likeness of two columns of anchors, by pairs in the same order at like distances.

    Anchors of both texts are sorted by hash, place and text. An anchor of the
    first text and one of the second after it are a pair, or one of the second
    and one of the first where neither is in such a pair.
    """
    both = F.sort_array(
        F.concat(F.transform(a, lambda x: F.shiftleft(x, 1)), F.transform(b, lambda x: F.shiftleft(x, 1).bitwiseOR(F.lit(1).cast("bigint"))))
    )
    merged = F.col("__merged")

    def follows(x, y, first):
        """Whether ``y`` after ``x`` is the same anchor in the other text, ``x`` being of text ``first``."""
        bit = F.lit(1).cast("bigint")
        same = F.shiftrightunsigned(x, 32) == F.shiftrightunsigned(y, 32)
        return F.coalesce(same & (x.bitwiseAND(bit) == first) & (y.bitwiseAND(bit) == 1 - first), F.lit(False))

    def place(x):
        return _place(F.shiftrightunsigned(x, 1))

    def at(i):
        return F.get(merged, i)

    def pair(x, i):
        y = at(i + 1)
        forward = F.struct(place(x).alias("a"), place(y).alias("b"))
        backward = F.struct(place(y).alias("a"), place(x).alias("b"))
        alone = ~follows(at(i - 1), x, 0) & ~follows(y, at(i + 2), 0)
        return F.when(follows(x, y, 0), forward).when(follows(x, y, 1) & alone, backward)

    pairs = F.col("__pairs")

    def near(p, q):
        """Whether pair ``q`` stands behind ``p`` in both texts, as far in one as in the other but for ``SLACK``."""
        ahead, other = q["a"] - p["a"], q["b"] - p["b"]
        return F.coalesce((ahead > 0) & (other > 0) & (F.abs(ahead - other) <= SLACK), F.lit(False))

    start = F.struct(F.lit(-1).cast("bigint").alias("a"), F.lit(-1).cast("bigint").alias("b"))
    counted = F.filter(pairs, lambda p, i: (i > 0) & (near(F.get(pairs, i - 1), p) | near(p, F.get(pairs, i + 1))))
    read = rows.withColumn("__merged", both)
    read = read.withColumn("__pairs", F.concat(F.array(start), F.sort_array(F.array_compact(F.transform(merged, pair)))))
    n = F.size(counted)
    read = read.withColumn("__n", n)
    every = F.size(a) + F.size(b) - F.col("__n")
    found = F.when(F.col(b).isNull(), None).when(every == 0, 1.0).otherwise(F.col("__n") / every)
    return read.withColumn(out, found).drop("__merged", "__pairs", "__n")


def _buckets(rows: DataFrame, key: str, text: str) -> tuple[Column, list, object]:
    """Stretches of the key order of like sizes of text: a number for a key, the borders, the least key.

    There are at most ``BUCKETS`` borders, so what the driver and the plan hold is bounded.
    """
    size = F.octet_length(text)
    seen = rows.agg(F.sum(size).alias("bytes"), F.min(key).alias("least"), F.max(F.col(key).isNull()).alias("nulls")).first()
    n = min(BUCKETS, max(1, (seen["bytes"] or 0) // BUCKET_BYTES))
    if n == 1:
        return F.lit(0), [], None if seen["nulls"] else seen["least"]
    shares = [i / n for i in range(1, n)]
    times = F.explode(F.sequence(F.lit(0), F.floor(size / WEIGHT_BYTES).cast("int")))
    weighed = rows.select(key, times)
    borders = weighed.agg(F.percentile_approx(key, shares, max(10_000, 10 * n)).alias("b")).first()["b"]
    borders = sorted({b for b in borders if b > seen["least"]})
    # Coarse borders first, so that a key is compared with about 2 * sqrt(n) of them.
    wide = max(1, int(len(borders) ** 0.5))
    groups = [borders[i : i + wide] for i in range(0, len(borders), wide)]
    heads, lists = F.lit([g[0] for g in groups]), F.array(*(F.lit(g) for g in groups))
    at = F.size(F.filter(heads, lambda b: b <= F.col(key)))
    fine = F.size(F.filter(F.get(lists, at - 1), lambda b: b <= F.col(key)))
    number = F.when(at > 0, (at - 1) * wide + fine).otherwise(0)
    return F.when(F.col(key).isNull(), 0).otherwise(number), borders, None if seen["nulls"] else seen["least"]


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, and its likeness to that and to the next text.

    The edited text has its last quarter of code points replaced by the first
    as many of the next row's, by ascending key (a number; nulls first, ties by
    the text's hash; after the last row the first). Rows are dealt to stretches
    of the key order; each stretch also gets a copy of the row that follows it.
    Rows with one key are in one stretch.
    """
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    bucket, borders, least = _buckets(rows, "doc_id", "text")
    first = F.col("doc_id").isNull() if least is None else F.col("doc_id").eqNullSafe(F.lit(least))
    begins = F.col("doc_id").isin(borders) if len(borders) <= 64 else F.array_contains(F.lit(borders), F.col("doc_id"))
    begins = F.coalesce(begins, F.lit(False)) if borders else F.lit(False)
    own = F.struct(bucket.alias("bucket"), F.lit(False).alias("copy"))
    before = F.struct((bucket - 1).alias("bucket"), F.lit(True).alias("copy"))
    around = F.struct(F.lit(len(borders)).alias("bucket"), F.lit(True).alias("copy"))
    places = F.array_compact(F.array(own, F.when(begins, before), F.when(first, around)))
    dealt = rows.select("doc_id", "text", F.explode(places).alias("p")).select("doc_id", "text", "p.*", F.xxhash64("text").alias("tie"))
    order = Window.partitionBy("bucket").orderBy("copy", "doc_id", "tie")
    n = F.length("text")
    part = F.floor(n / 4).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - part), F.substr("next", F.lit(1), part))
    read = dealt.withColumn("next", F.lead("text").over(order)).select(
        "bucket", "copy", "doc_id", "tie", "text", n.cast("bigint").alias("n_chars"), F.coalesce(edited, F.col("text")).alias("edited")
    )
    read = with_anchors(with_anchors(read, "text", "a"), "edited", "e").select(
        "bucket", "copy", "doc_id", "tie", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "a", "e"
    )
    found = read.withColumn("b", F.lead("a").over(order)).where("not copy")
    found = with_likeness(with_likeness(found, "a", "e", "near_edited"), "a", "b", "near_next")
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("a")).alias("fingerprint"),
        fingerprint(F.col("e")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
