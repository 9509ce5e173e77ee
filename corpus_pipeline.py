"""The corpus pipeline: quality rules, near copies, repeated passages, personal data, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before
kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rowloom.llm.common import stored
from rowloom.llm.packing import packed
from rowloom.llm.quality import quality_rules
from rowloom.llm.queries import WORDS_49K
from rowloom.llm.repeats import without_repeats
from rowloom.llm.sanitise import personal_spans, sanitised
from rowloom.llm.simhash import first_of_components

#: A string of so many bytes that occurs again is taken out; passages of 50 words are longer.
REPEAT_BYTES = 200


def _apart(docs):
    """``docs`` with columns renamed that no operator needs, so that none clashes, and the way back."""
    names = {c: c if c in ("doc_id", "text", "lang", "source") else f"__p{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    return renamed, lambda rows: rows.select(*(F.col(n).alias(c) for c, n in names.items()))


def _changed(docs, rows, text):
    """``rows`` with a new text, and its length where ``docs`` has one."""
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return rows.select(*(new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns))


def quality_stage(spark, docs, sf_dir):
    """Documents that the quality rules keep."""
    apart, back = _apart(docs)
    return back(quality_rules(apart, keep_text=True).where("kept"))


def near_copy_stage(spark, docs, sf_dir):
    """One document of each group of near copies."""
    return first_of_components(docs, size=3, max_bits=3)


def repeats_stage(spark, docs, sf_dir):
    """Texts without the bytes of strings that occur again; documents left empty stay, with an empty text."""
    apart, back = _apart(docs)
    rows = without_repeats(apart.withColumn("__old", F.col("text")), length=REPEAT_BYTES, with_text=True)
    rows = rows.withColumn("text", F.coalesce("__left", "__old"))
    return _changed(docs, back(rows), F.col("text"))


def personal_data_stage(spark, docs, sf_dir):
    """Texts with class words for personal data, without the terms that reveal it."""
    apart, back = _apart(docs)
    rows = personal_spans(apart, keep_text=True)
    return _changed(docs, back(rows.withColumn("text", sanitised(F.col("text"), F.col("spans")))), F.col("text"))


def packing_stage(spark, docs, sf_dir):
    """Pieces of token ids and their places in sequences."""
    return packed(docs, WORDS_49K, ["doc_id"], capacity=2048)


STAGES = [
    ("quality rules", quality_stage),
    ("SimHash near copies", near_copy_stage),
    ("repeated passages", repeats_stage),
    ("personal data", personal_data_stage),
    ("packing", packing_stage),
]

#: Fingerprints, robust estimates and tokens are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
