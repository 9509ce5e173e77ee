"""Information-theoretic sanitisation of personal data, by DataFrame expressions only.

Protected entities are the e-mail addresses, IP addresses, card and telephone
numbers in the texts. How far a term reveals an entity is estimated from the
whole corpus: with N different texts, c(t) texts that contain the term, c(e)
that contain the entity and c(t, e) in which the term stands within ``reach``
characters of it, the disclosure is the pointwise mutual information over the
entity's information content,

    log(N * c(t, e) / (c(t) * c(e))) / log(N / c(e)),

1 if the term occurs with the entity only. Terms of a text at or above
``generalise`` for an entity of that text become a class word, those at or
above ``remove`` go. ``support`` texts that differ are needed, so that chance
companions of an entity that occurs once are no evidence.

* null texts are empty; texts without entities are left as they are;
* very long texts are read whole; time is in proportion to text and matches;
* columns named ``base`` and ``spans`` of the input give way to the operator's;
* equal texts count once for the statistics; repeated rows have equal results;
* an empty table gives an empty result.

Kinds of spans, in this order at equal starts: email, ip, card, phone, term.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import small, spread_join, stored
from rowloom.session import fits_broadcast

KINDS = ["email", "ip", "card", "phone", "term"]
#: The base patterns, written so that a match starts at the border of a run and
#: never runs through it twice; \G admits a match right behind the one before.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Elements that a fold appends one by one.
BLOCK = 256
WORD = r"[\p{L}\p{N}_-]"
TERM = r"(?<![\p{L}\p{N}_-])\p{L}[\p{L}\p{N}_-]{2,}+"
SPANS = "array<struct<s: bigint, k: int, e: bigint, v: string>>"


@dataclass(frozen=True)
class Disclosure:
    """``reach`` in characters; ``support`` in different texts; thresholds of disclosure from 0 to 1."""

    reach: int = 120
    support: int = 3
    generalise: float = 0.9
    remove: float = 0.97


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _in_blocks(items: Column) -> Column:
    """An array as an array of arrays of up to ``BLOCK`` elements, so that folds copy short arrays."""
    last = F.floor((F.greatest(F.size(items), F.lit(1)) - 1) / BLOCK).cast("int")
    return _bound(items, lambda x: F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(x, b * BLOCK + 1, BLOCK)))


def _matches(text: Column, pattern: Column, kind: int) -> Column:
    """Start, kind, end and value of every match, in code points; linear in the text for up to a million matches."""
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, pattern, -1)
    # The text before each match; the one behind the last match has no match.
    pieces = F.zip_with(between, found, lambda g, v: F.struct(F.length(g).alias("gap"), v.alias("v")))
    none = F.array().cast(SPANS)

    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.length(x["v"])
        one = F.struct(start.alias("s"), F.lit(kind).alias("k"), end.alias("e"), x["v"].alias("v"))
        grown = F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))
        return F.when(x["v"].isNull(), acc).otherwise(grown)

    def block(acc, some):
        inner = F.aggregate(some, F.struct(acc["at"].alias("at"), none.alias("out")), step)
        return _bound(inner, lambda x: F.struct(x["at"].alias("at"), F.concat(acc["out"], x["out"]).alias("out")))

    start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out"))
    return F.aggregate(_in_blocks(pieces), start, block, lambda acc: acc["out"])


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]+", "")


def _luhn(v: Column) -> Column:
    d = F.reverse(_digits(v))

    def add(total, i):
        x = F.substr(d, i, F.lit(1)).cast("int")
        twice = F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        return total + F.when(i % 2 == 0, twice).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


def _valid(kind: str):
    """Whether a match of a kind counts, as a function of the match."""
    return lambda x: _passes(kind, x["v"])


def _passes(kind: str, v: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(v, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    n = F.length(_digits(v))
    if kind == "phone":
        return n.between(10, 15)
    return F.when(n.between(14, 19), _luhn(v)).otherwise(False)


def base_spans(text: Column, digits: Column) -> Column:
    """All spans of the four base kinds, sorted; ``digits``: the number of digits in the text."""
    need = {
        "email": F.contains(text, F.lit("@")),
        "ip": (digits >= 4) & F.contains(text, F.lit(".")),
        "card": digits >= 14,
        "phone": (digits >= 10) & F.contains(text, F.lit("+")),
    }
    none = F.array().cast(SPANS)
    parts = []
    for k, kind in enumerate(KINDS[:4]):
        found = F.filter(_matches(text, F.lit(PATTERNS[kind]), k), _valid(kind))
        parts.append(F.when(need[kind], found).otherwise(none))
    return F.sort_array(F.concat(*parts))


def span_text(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    one = F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string")))
    return F.array_join(one, ",")


def revealing_terms(texts: DataFrame, entities: DataFrame, rule: Disclosure) -> DataFrame:
    """``entity``, ``term``, ``disclosure`` at or above the lower threshold.

    ``texts``: ``text`` of the whole corpus. ``entities``: ``h`` (a text's
    digest), ``text``, ``spans`` of the different texts that have spans.
    """
    mention = entities.select("h", "text", F.explode("spans").alias("x"))
    before = F.substr("text", F.greatest(F.col("x.s") - rule.reach, F.lit(0)).cast("int") + 1, F.least(F.col("x.s"), F.lit(rule.reach)).cast("int"))
    after = F.substr("text", F.col("x.e").cast("int") + 1, F.lit(rule.reach))
    # A word that the edge of the window cuts is no term.
    before = F.when(F.col("x.s") > rule.reach, F.regexp_replace(before, r"^\S+", "")).otherwise(before)
    after = F.when(F.length(after) == rule.reach, F.regexp_replace(after, r"\S+$", "")).otherwise(after)
    near = F.regexp_extract_all(F.lower(F.concat_ws("\n", before, after)), F.lit(TERM), F.lit(0))
    pairs = mention.select("h", F.lower("x.v").alias("entity"), F.explode(F.array_distinct(near)).alias("term")).distinct()
    joint = stored(pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("te")).where(F.col("te") >= rule.support))
    terms = joint.select("term").distinct()
    all_texts = texts.where("text is not null")
    if joint.isEmpty():
        return joint.select("entity", "term", F.lit(1.0).alias("disclosure"))
    size, different = _different(all_texts)
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))
    of_term = different.select(F.explode(words).alias("term")).join(small(terms), "term").groupBy("term").agg(F.count(F.lit(1)).alias("t"))
    of_entity = mention.groupBy(F.lower("x.v").alias("entity")).agg(F.count_distinct("h").alias("en"))
    known = joint.join(of_term, "term").join(of_entity, "entity")
    content = F.log(F.lit(float(size)) / F.col("en"))
    shared = F.log(F.lit(float(size)) * F.col("te") / (F.col("t") * F.col("en")))
    measured = known.select("entity", "term", F.when(content > 0, shared / content).otherwise(0.0).alias("disclosure"))
    return stored(measured.where(F.col("disclosure") >= rule.generalise))


def _different(texts: DataFrame) -> tuple[int, DataFrame]:
    """How many different texts there are, and each once; only texts that occur again are shuffled."""
    hashed = texts.select(F.unhex(F.md5("text")).alias("h"), "text")
    counts = stored(hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n")))
    again = counts.where("n > 1")
    marked = joined_once(hashed, again.withColumn("again", F.lit(True)).drop("n"), ["h"], again)
    once = marked.where("again is null").select("text")
    return counts.count(), once.unionByName(marked.where("again").dropDuplicates(["h"]).select("text"))


def joined_once(left: DataFrame, right: DataFrame, keys: list[str], counts: DataFrame) -> DataFrame:
    """Left join with a right side that has each key once; copies of a hot key are dealt by their tasks."""
    if fits_broadcast(right):
        return left.join(F.broadcast(right), keys, "left")
    return spread_join(left, right, keys, "left", counts, F.spark_partition_id())


def personal_spans(docs: DataFrame, rule: Disclosure = Disclosure(), text: str = "text", keep_text: bool = False) -> DataFrame:
    """The columns of ``docs`` without the text, ``base`` and ``spans`` (start, kind, end, value).

    The value of a term's span is empty if the term is to be removed. With
    ``keep_text`` the text stays.
    """
    rest = [c for c in docs.columns if c not in {text, "base", "spans"}]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    read = docs.select(*(F.col(f"`{c}`") for c in rest), F.col(f"`{text}`").alias("__raw"), body.alias("__text"))
    read = read.withColumn("__digits", F.length(F.regexp_replace("__text", "[^0-9]+", "")))
    found = read.withColumn("base", base_spans(F.col("__text"), F.col("__digits")))
    some = F.size("base") > 0
    kept = F.col("__raw") if keep_text else F.when(some, F.col("__raw"))
    found = stored(
        found.select(*(F.col(f"`{c}`") for c in rest), "base", F.when(some, F.sha2("__text", 256)).alias("__h"), kept.alias("__raw"))
    )
    entities = found.where("__h is not null").select(F.col("__h").alias("h"), F.col("__raw").alias("text"), F.col("base").alias("spans"))
    entities = stored(entities.dropDuplicates(["h"]))
    told = revealing_terms(docs.select(F.col(f"`{text}`").alias("text")), entities, rule)
    told = told.groupBy("entity").agg(F.collect_set(F.struct("term", "disclosure")).alias("told"))
    mention = entities.select("h", F.explode(F.array_distinct(F.transform("spans", lambda x: F.lower(x["v"])))).alias("entity"))
    per_text = mention.join(small(told), "entity").groupBy("h").agg(F.array_distinct(F.flatten(F.collect_list("told"))).alias("told"))
    named = F.array_distinct(F.transform("told", lambda x: x["term"]))
    strong = F.transform(F.filter("told", lambda x: x["disclosure"] >= rule.remove), lambda x: x["term"])
    # Terms hold letters, digits, _ and - only and need no quoting; longer ones come first.
    pattern = F.concat(F.lit(rf"(?iu)(?<!{WORD})(?:"), F.array_join(F.reverse(F.array_sort(named)), "|"), F.lit(rf")(?!{WORD})"))
    marked = entities.join(per_text, "h").select("h", "text", "spans", strong.alias("strong"), pattern.alias("pattern"))
    terms = F.filter(
        _matches(F.col("text"), F.col("pattern"), 4),
        lambda x: ~F.exists("spans", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])),
    )
    terms = F.transform(
        terms,
        lambda x: F.struct(
            x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"),
            F.when(F.array_contains("strong", F.lower(x["v"])), F.lit("")).otherwise(x["v"]).alias("v"),
        ),
    )
    added = marked.select(F.col("h").alias("__h"), terms.alias("__terms"))
    # Texts without spans have no digest and take no part in the join.
    counts = found.where("__h is not null").groupBy("__h").agg(F.count(F.lit(1)).alias("n"))
    joined = joined_once(found.where("__h is not null"), stored(added), ["__h"], counts)
    joined = joined.unionByName(found.where("__h is null").withColumn("__terms", F.lit(None).cast(SPANS)))
    every = F.sort_array(F.concat("base", F.coalesce("__terms", F.array().cast(SPANS))))
    raw = [F.col("__raw").alias(text)] if keep_text else []
    return joined.select(*(F.col(f"`{c}`") for c in rest), *raw, "base", every.alias("spans"))


def sanitised(text: Column, spans: Column) -> Column:
    """The text with class words for spans; removed terms leave nothing."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    zero = F.lit(0).cast("bigint")

    def step(acc, x):
        """Within ``acc.cut``, the part of the text that starts at ``acc.from``."""
        mark = F.when((x["k"] == 4) & (x["v"] == ""), F.lit("")).otherwise(F.get(names, x["k"]))
        before = F.substr(acc["cut"], (acc["at"] - acc["from"]).cast("int") + 1, (x["s"] - acc["at"]).cast("int"))
        out = F.when(x["s"] >= acc["at"], F.concat(acc["out"], before, mark)).otherwise(acc["out"])
        return F.struct(acc["from"].alias("from"), acc["cut"].alias("cut"), F.greatest(acc["at"], x["e"]).alias("at"), out.alias("out"))

    def block(acc, some):
        cut = F.substr(text, acc["at"].cast("int") + 1, F.greatest(F.array_max(F.transform(some, lambda x: x["e"])) - acc["at"], zero).cast("int"))
        start = F.struct(acc["at"].alias("from"), cut.alias("cut"), acc["at"].alias("at"), F.lit("").alias("out"))
        inner = F.aggregate(some, start, step)
        return _bound(inner, lambda x: F.struct(x["at"].alias("at"), F.concat(acc["out"], F.array(x["out"])).alias("out")))

    start = F.struct(zero.alias("at"), F.array().cast("array<string>").alias("out"))
    whole = F.aggregate(
        _in_blocks(spans),
        start,
        block,
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substr(text, acc["at"].cast("int") + 1)),
    )
    return F.when(F.size(spans) > 0, whole).otherwise(text)
