"""The operators of this folder as queries over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from rowloom.llm.alignment import alignment_counts
from rowloom.llm.common import documents
from rowloom.llm.decontaminate import affected, n_hit
from rowloom.llm.languages import held_out_languages
from rowloom.llm.middle import fill_in_middle, restored
from rowloom.llm.packing import packed
from rowloom.llm.pieces import piece_digests
from rowloom.llm.quality import BASE, quality_rules
from rowloom.llm.repeats import without_repeats
from rowloom.llm.sanitise import KINDS, personal_spans, span_text
from rowloom.llm.sharding import extendible_shards
from rowloom.llm.simhash import simhash_components
from rowloom.llm.syncmers import edited_fingerprints
from rowloom.llm.toxicity import held_out_toxicity

#: Bytes of text in a shard at most.
SHARD_BYTES = 1 << 20
#: Where the public tokenizer files are; a parameter of the operators.
WORDS_49K = public_tokenizers.path("word_bpe_49k.json")
PIECES_32K = public_tokenizers.path("piece_bpe_32k.model")
BYTES_50K = public_tokenizers.path("byte_bpe_50k.json")


def op1_extendible_hash_sharding(spark, folder):
    rows = documents(spark, folder).select("doc_id", F.octet_length("text").alias("size"))
    found = extendible_shards(rows, ["doc_id"], F.col("size"), SHARD_BYTES)
    return found.select("doc_id", "n_bytes", "shard", F.length("shard").alias("depth"), "shard_bytes", "shard_rows")


def op2_simhash_near_dedup(spark, folder):
    found = simhash_components(documents(spark, folder), size=3, max_bits=3)
    printed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", printed.alias("fingerprint"), "component_id")


def op3_quality_rules(spark, folder):
    rows = quality_rules(documents(spark, folder))
    return rows.select("doc_id", *BASE, "base_failed", "kept", "d2")


def op4_best_fit_packing(spark, folder):
    return packed(documents(spark, folder), WORDS_49K, ["doc_id"], capacity=2048)


def op5_syncmer_fingerprints(spark, folder):
    return edited_fingerprints(documents(spark, folder))


def op6_language_id(spark, folder):
    return held_out_languages(documents(spark, folder))


def op7_toxicity_grammar(spark, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return held_out_toxicity(documents(spark, folder), labels)


def op8_sentencepiece_codec(spark, folder):
    return piece_digests(documents(spark, folder), PIECES_32K, ["doc_id"])


def op9_suffix_array_dedup(spark, folder):
    return without_repeats(documents(spark, folder).select("doc_id", "text"), length=400)


def op10_pii_sanitisation(spark, folder):
    found = personal_spans(documents(spark, folder).select("doc_id", "text"))
    kinds = F.transform("base", lambda x: x["k"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{n}") for k, n in enumerate(KINDS[:4])
    ]
    return found.select(
        "doc_id", *counts, F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans")
    )


def op11_cross_tokenizer_alignment(spark, folder):
    return alignment_counts(documents(spark, folder), BYTES_50K, PIECES_32K, ["doc_id"])


def op12_benchmark_decontamination(spark, folder):
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    found = affected(documents(spark, folder), benchmark, ["doc_id"], window=10)
    return found.select(
        "doc_id",
        "n_words",
        n_hit(F.col("spans")).alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op13_fill_in_middle(spark, folder):
    found = fill_in_middle(documents(spark, folder), "doc_id", ["doc_id"], seed=42, share=50, suffix_first=80)
    back = restored(F.col("output"), F.col("form"))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256")
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


QUERIES = {
    "op1_extendible_hash_sharding": op1_extendible_hash_sharding,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_syncmer_fingerprints": op5_syncmer_fingerprints,
    "op6_language_id": op6_language_id,
    "op7_toxicity_grammar": op7_toxicity_grammar,
    "op8_sentencepiece_codec": op8_sentencepiece_codec,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_pii_sanitisation": op10_pii_sanitisation,
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_benchmark_decontamination": op12_benchmark_decontamination,
    "op13_fill_in_middle": op13_fill_in_middle,
}
ORACLE: dict[str, str] = {
    "op1_extendible_hash_sharding": f"""
    WITH sized AS (
      SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS n_bytes,
             lpad(bin(('0x' || substr(md5('=' || doc_id::VARCHAR), 1, 16))::UBIGINT), 64, '0') AS bits
      FROM documents),
    prefixes AS (
      SELECT doc_id, n_bytes, d, substr(bits, 1, d) AS prefix FROM sized, range(0, 41) AS r(d)),
    sums AS (
      SELECT prefix, sum(n_bytes)::BIGINT AS shard_bytes, count(*)::BIGINT AS shard_rows FROM prefixes GROUP BY prefix),
    fits AS (
      SELECT p.*, s.shard_bytes, s.shard_rows FROM prefixes p JOIN sums s USING (prefix)
      WHERE s.shard_bytes <= {SHARD_BYTES} OR s.shard_rows = 1)
    SELECT doc_id, n_bytes, prefix AS shard, d::INTEGER AS depth, shard_bytes, shard_rows
    FROM fits QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY d) = 1
    """,
    "op12_benchmark_decontamination": r"""
    WITH parts AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    items AS (
      SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    sized AS (SELECT item_id, w, least(10, len(w)) AS k FROM items WHERE len(w) > 0),
    windows AS (
      SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS s
      FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM sized)),
    places AS (
      SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS s
      FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p
            FROM parts, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
    found AS (SELECT doc_id, k, p, s FROM places SEMI JOIN windows USING (k, s)),
    hit AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS place FROM found) GROUP BY doc_id),
    named AS (
      SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS all_items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found JOIN windows USING (k, s)) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(named.n, 0)::BIGINT AS n_items,
           sha256(coalesce(all_items, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
    FROM parts LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
    "op13_fill_in_middle": r"""
    WITH parts AS (
      SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id::VARCHAR) AS h,
             regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w FROM documents),
    drawn AS (
      SELECT *, len(w) AS n, ('0x' || h[1:8])::UBIGINT % (len(w) + 1)::UBIGINT AS r1, ('0x' || h[9:16])::UBIGINT % (len(w) + 1)::UBIGINT AS r2,
             ('0x' || h[17:24])::UBIGINT % 100 AS h3, ('0x' || h[25:32])::UBIGINT % 100 AS h4 FROM parts),
    cut AS (
      SELECT *, array_to_string(w[1:least(r1, r2)], '') AS p, array_to_string(w[least(r1, r2) + 1:greatest(r1, r2)], '') AS m,
             array_to_string(w[greatest(r1, r2) + 1:], '') AS s,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 50 THEN 'plain'
                  WHEN h4 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn)
    SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                  ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM cut
    """,
}
