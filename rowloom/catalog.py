"""The operators as named queries over the given tables; each reads whole tables."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.functions.chat import (
    PromptFormat, best_allowed, chat_messages, first_candidate, parse_toggle, prompt_text,
)
from rowloom.functions.content import article_comment_text, key_value_text, template_text, user_text
from rowloom.functions.labels import label_text
from rowloom.functions.text import lower_trim, preview, safe_str, text_length
from rowloom.operators.checks import result_rows, token_report, with_clean_text, with_label_check
from rowloom.operators.conversations import (
    conversation_prompts, prompt_blocks, validate_message_lists, validate_messages,
)
from rowloom.operators.generation import generate
from rowloom.operators.labels import class_counts, of_class, split_sizes, unknown_labels, with_label
from rowloom.operators.sets import complement, union_parts
from rowloom.operators.split import sample_rows, shuffle_rows, split_by_count, split_by_ratio
from rowloom.operators.vocab import (
    alignment_report, append_tokens, grow_embeddings, initialise_tokens, lookup_tokens, ordered_union,
)
from rowloom.plans.dataset_split import train_test_split
from rowloom.plans.text_runs import generation_results, list_prompts, prompt_rows, token_run
from rowloom.session import checkpointed, shared_dir
from rowloom.sources.files import load_table, token_entries
from rowloom.sources.positions import file_row_at, row_at, rows_at
from rowloom.sources.workbook import read_workbooks, workbook_contents
from rowloom.sources.writers import columns_as_text, write_split, write_table, write_train_test

LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
CHAT_FORMAT = PromptFormat(
    before_role="<|im_start|>",
    after_role="\n",
    after_content="<|im_end|>\n",
    generation="<|im_start|>assistant\n",
    reasoning_on="<|im_start|>assistant\n<think>",
    reasoning_off="<|im_start|>assistant\n<think></think>",
)
JUDGE = "Judge the text."


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for queries that write a table and read it back."""
    return f"{shared_dir(spark)}/rowloom-{uuid4()}/{name}"


def stand_in_factory() -> Callable[..., Callable[[list[str]], list[str]]]:
    """Stands in for a model; made inside a function, so that tasks receive it by value."""

    def factory():
        return lambda prompts: ["<YES>" if "the" in p else "<NO>" for p in prompts]

    return factory


# --- sources and sinks ------------------------------------------------------

def csv_scan(spark, folder):
    path = scratch(spark, "documents.csv")
    write_table(table(spark, folder, "documents"), path)
    return load_table(spark, path)


def csv_scan_typed(spark, folder):
    path = scratch(spark, "part.csv")
    write_table(table(spark, folder, "part"), path)
    return load_table(spark, path)


def json_lines_scan(spark, folder):
    path = scratch(spark, "documents.jsonl")
    write_table(table(spark, folder, "documents"), path)
    return load_table(spark, path)


def json_lines_layout(spark, folder):
    """Keys in their own order, prices that are whole in some lines only."""
    path = scratch(spark, "part.jsonl")
    price = F.when(F.col("p_size") % 2 == 0, F.col("p_retailprice").cast("string")).otherwise(F.col("p_size").cast("string"))
    fields = [F.concat(F.lit(f'"{n}":'), F.to_json(F.array(c)).substr(F.lit(2), F.length(F.to_json(F.array(c))) - 2))
              for n, c in (("size", F.col("p_size")), ("name", F.col("p_name")), ("Key", F.col("p_partkey")))]
    text = F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit(',"price":'), price, F.lit("}"))
    table(spark, folder, "part").select(text).write.text(path)
    rows = load_table(spark, path)
    return rows.select(F.col("Key").alias("p_partkey"), key_value_text(rows).alias("content"))


def workbook_scan(spark, folder):
    """The table as workbooks, made by tasks, and read again."""
    books = checkpointed(workbook_contents(table(spark, folder, "part").repartition(3), rows_per_book=100_000))
    return read_workbooks(spark, books)


def token_templates(spark, folder):
    """Each conversation as a JSON object in which roles repeat, taken apart again."""
    def text(c):
        listed = F.to_json(F.array(c))
        return listed.substr(F.lit(2), F.length(listed) - 2)

    entry = F.struct("turn", F.concat(text("role"), F.lit(":"), text("text")).alias("e"))
    turns = table(spark, folder, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(entry)).alias("all"))
    texts = turns.select("conv_id", F.concat(F.lit("{"), F.array_join("all.e", ","), F.lit("}")).alias("object"))
    return token_entries(texts, "object", ["conv_id"])


def csv_sink(spark, folder):
    path = scratch(spark, "orders.csv")
    write_table(table(spark, folder, "orders"), path)
    return spark.read.option("header", True).csv(path)


def split_sink(spark, folder):
    parts = train_test_split(
        table(spark, folder, "labels"), "quality", train_ratio=0.5, key=["doc_id"]
    )
    path = scratch(spark, "labels.parquet")
    write_split(parts, path)
    return spark.read.parquet(path)


def named_split_sink(spark, folder):
    parts = train_test_split(
        table(spark, folder, "labels"), "quality", train_ratio=0.5, key=["doc_id"]
    )
    train, test = write_train_test(parts, scratch(spark, "labels.parquet"), input_format="parquet")
    return union_parts(
        [
            spark.read.parquet(train).withColumn("split", F.lit("train")),
            spark.read.parquet(test).withColumn("split", F.lit("test")),
        ]
    )


# --- rows, labels, counts ---------------------------------------------------

def row_at_position(spark, folder):
    return row_at(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), 7, ["o_orderkey"])


def row_at_file_position(spark, folder):
    return file_row_at(table(spark, folder, "orders"), 7).select("o_orderkey", "o_custkey")


def rows_at_positions(spark, folder):
    """Five hundred positions of a table, and of the same table as lines of text."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    path = scratch(spark, "orders.csv")
    write_table(orders.orderBy("o_orderkey"), path)
    kinds = "o_orderkey bigint, o_custkey bigint"
    lines = spark.read.schema(kinds).option("header", True).csv(path)
    asked = list(range(0, 1500, 3))
    return union_parts([rows_at(t, asked).withColumn("kind", F.lit(k)) for t, k in ((orders, "rows"), (lines, "lines"))])


def cast_string(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return columns_as_text(orders, ["o_orderkey", "o_totalprice", "not_there"])


def label_int(spark, folder):
    return with_label(table(spark, folder, "labels"), "quality").select("doc_id", "label")


def label_string(spark, folder):
    return with_label(table(spark, folder, "orders"), "o_orderstatus", "f", "o").select("o_orderkey", "label")


def label_double(spark, folder):
    yes, no = map(str, range(10)), map(str, range(10, 20))
    return with_label(table(spark, folder, "events"), "value", yes, no).select("event_id", "label")


def class_filter(spark, folder):
    return of_class(with_label(table(spark, folder, "labels"), "quality"), True).select("doc_id")


def text_label(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status")
    )
    return orders.select("o_orderkey", label_text(orders, "status").alias("label_text"))


def unknown_audit(spark, folder):
    events = with_label(table(spark, folder, "events"), "event_type", "purchase,signup", "view,click")
    return unknown_labels(events, "event_type")


def line_labels(spark, folder):
    return with_label(table(spark, folder, "lineitem"), "l_linestatus", "f", "o")


def count_classes(spark, folder):
    return class_counts(line_labels(spark, folder))


# --- splits and samples -----------------------------------------------------

def ratio_split(spark, folder):
    parts = split_by_ratio(line_labels(spark, folder), "label", 0.8, 42, LINE_KEY)
    return parts.select(*LINE_KEY, "label", "split")


def ratio_split_sizes(spark, folder):
    return split_sizes(split_by_ratio(line_labels(spark, folder), "label", 0.8, 42, LINE_KEY))


def ratio_split_shared_keys(spark, folder):
    """Keys here are a flag and a status, so nearly all rows share theirs with very many others."""
    lines = line_labels(spark, folder).select("l_returnflag", "l_linestatus", "label")
    parts = split_by_ratio(lines, "label", 0.8, 42, ["l_returnflag"])
    return parts.groupBy("label", "split").agg(F.count(F.lit(1)).alias("n"))


def count_split(spark, folder):
    labels = with_label(table(spark, folder, "labels"), "quality")
    parts = split_by_count(labels, "label", 20, 5, 8, 3, 42, ["doc_id"])
    return parts.select("doc_id", "label", "split")


def sample_n(spark, folder):
    return sample_rows(table(spark, folder, "orders").select("o_orderkey"), 500, 42, ["o_orderkey"])


def complement_of_sample(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey")
    return complement(orders, sample_rows(orders, 500, 42, ["o_orderkey"]), ["o_orderkey"])


def union_of_classes(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    flagged = with_label(orders, "o_orderstatus", "f", "o")
    return union_parts([of_class(flagged, True), of_class(flagged, False)]).drop("label")


def shuffle(spark, folder):
    return shuffle_rows(table(spark, folder, "events").select("user_id", "event_id"), 7, ["event_id"])


# --- row texts --------------------------------------------------------------

def null_safe_text(spark, folder):
    events = table(spark, folder, "events")
    return events.select("event_id", *(safe_str(events, c).alias(c) for c in ("user_id", "value", "props")))


def text_column(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", user_text(docs, text_col="text").alias("content"))


def template(spark, folder):
    part = table(spark, folder, "part")
    text = template_text(part, "Part {p_name} {{{p_brand}}} size {p_size} costs {p_retailprice}")
    return part.select("p_partkey", text.alias("content"))


def template_widths(spark, folder):
    part = table(spark, folder, "part")
    text = template_text(part, "[{p_name:<20.10}|{p_size:*>6}|{p_brand:^12}]")
    return part.select("p_partkey", text.alias("content"))


def article_comment(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", article_comment_text(docs, "text", "source").alias("content"))


def key_value(spark, folder):
    supplier = table(spark, folder, "supplier")
    return supplier.select("s_suppkey", key_value_text(supplier).alias("content"))


def layout_choice(spark, folder):
    docs = table(spark, folder, "documents").select(
        "doc_id", F.col("text").alias("article"), F.col("source").alias("comment")
    )
    return docs.select("doc_id", user_text(docs).alias("content"))


def trim_lower(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", lower_trim(F.concat(F.lit("\t\u3000"), "o_orderpriority", F.lit("\n "))).alias("word")
    )


def strip_tokens(spark, folder):
    docs = table(spark, folder, "documents")
    return with_clean_text(docs, "text", ["***", "###", "%%%"]).select("doc_id", "content")


def prompt_preview(spark, folder):
    text = F.col("text")
    return table(spark, folder, "documents").select(
        "doc_id", preview(text).alias("preview"), text_length(text).alias("n")
    )


# --- messages and prompts ---------------------------------------------------

def messages(spark, folder):
    docs = table(spark, folder, "documents")
    parts = F.posexplode(chat_messages(JUDGE, user_text(docs, text_col="text"))).alias("pos", "m")
    return docs.select("doc_id", parts).select("doc_id", "pos", "m.role", "m.content")


def validation(spark, folder):
    turns = table(spark, folder, "conversations").withColumn("role", F.nullif("role", F.lit("system")))
    return validate_messages(turns, "conv_id", "turn")


def list_validation(spark, folder):
    docs = table(spark, folder, "documents")
    lists = docs.select(
        "doc_id", chat_messages(JUDGE, F.nullif("lang", F.lit("en"))).alias("messages")
    )
    return validate_message_lists(lists, "messages").drop("messages")


def prompts(spark, folder):
    return conversation_prompts(table(spark, folder, "conversations"), "conv_id", "turn", CHAT_FORMAT)


def prompts_in_runs(spark, folder):
    return prompt_blocks(
        table(spark, folder, "conversations"), "conv_id", "turn", CHAT_FORMAT, block=3
    )


def prompts_of_lists(spark, folder):
    docs = table(spark, folder, "documents")
    whole = prompt_text(chat_messages(JUDGE, docs["text"]), CHAT_FORMAT, parse_toggle("false"))
    return docs.select("doc_id", whole.alias("prompt"))


def reasoning_toggle(spark, folder):
    switch = F.when(F.col("lang") == "en", "true").when(F.col("lang") == "fr", "false").otherwise("none")
    return table(spark, folder, "documents").select("doc_id", CHAT_FORMAT.ending(switch).alias("suffix"))


# --- generation and checks --------------------------------------------------

def generated(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return generate(docs, "text", stand_in_factory())


def candidate(spark, folder):
    docs = table(spark, folder, "documents")
    lines = F.filter(F.split("text", "\n"), lambda line: F.contains(line, F.lit("the")))
    listed = docs.select("doc_id", lines.alias("candidates"))
    text = first_candidate(F.col("candidates"), listed.schema["candidates"].dataType)
    return listed.select("doc_id", text.alias("generated_text"))


def allowed_choice(spark, folder):
    return table(spark, folder, "embeddings").select(
        "vec_id", best_allowed(F.col("embedding"), [11, 3, None, 7, 3, -1]).alias("choice")
    )


def label_in_text(spark, folder):
    answers = table(spark, folder, "conversations").where("role = 'assistant'")
    found = with_label_check(answers, "text", ["the", "The", "ion"])
    return found.select(
        "conv_id",
        "turn",
        "has_special_token",
        F.array_join("matched_tokens", ",").alias("matched_tokens"),
        "extracted_label",
    )


def token_check(spark, folder):
    words = F.transform(F.split("text", " "), lambda w: F.length(w))
    turns = table(spark, folder, "conversations").withColumn("ids", words)
    return token_report(turns, ["conv_id", "turn"], "text", "ids", {"the": 3, "ion": 9, "zz": None})


def result_table(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labelled = docs.join(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id")
    answered = generate(labelled, "text", stand_in_factory())
    done = result_rows(answered, ["doc_id"], "quality", "generated_text", ["<YES>", "<NO>"])
    return done.select("doc_id", "label_text", "extracted_label")


def whole_run(spark, folder):
    part = table(spark, folder, "part")
    asked = prompt_rows(
        part, ["p_partkey"], CHAT_FORMAT, "Is it small?", template="{p_name} in {p_type}",
        label_col="p_size",
    )
    done = generation_results(asked, stand_in_factory(), ["<YES>", "<NO>"])
    return done.select("p_partkey", "label_text", "generated_text", "extracted_label")


def whole_run_tokens(spark, folder):
    """Texts with ids from a stand-in, cleaned, and checked by text and by ids."""

    def factory():
        return lambda prompts: [(f"<s>{p[-9:]}</s>", [ord(c) for c in p[-9:]]) for p in prompts]

    asked = prompt_rows(table(spark, folder, "part"), ["p_partkey"], CHAT_FORMAT, template="{p_name}", label_col="p_size")
    asked = asked.withColumn("prompt", F.concat("prompt", F.reverse("label_text"), F.reverse(F.col("p_partkey").cast("string"))))
    done = token_run(asked, factory, {"1": 49, "</s>": 2, "t": None}, ["<s>", "</s>"], ["11", "22"])
    checks = F.inline("token_checks").alias("token", "found_in_text", "found_in_ids", "token_id")
    return done.select("p_partkey", "label_text", "raw_text", "generated_text", "extracted_label", checks)


def checked_lists(spark, folder):
    docs = table(spark, folder, "documents").withColumn("messages", chat_messages(JUDGE, F.col("text")))
    return list_prompts(docs, ["doc_id"], "messages", CHAT_FORMAT, label_col="lang")


# --- vocabularies and embeddings --------------------------------------------

def vector_vocab(spark, folder):
    return table(spark, folder, "embeddings").select(
        F.concat(F.lit("t"), F.col("vec_id").cast("string")).alias("token"), F.col("vec_id").alias("id")
    )


def part_vocab(spark, folder):
    return table(spark, folder, "part").select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("token"),
        F.col("p_partkey").alias("id"),
    )


def token_lookup(spark, folder):
    return lookup_tokens(vector_vocab(spark, folder), ["t5", "t499", "<A>"])


def token_table_lookup(spark, folder):
    tokens = table(spark, folder, "events").select(
        "event_id", F.concat(F.lit("t"), F.col("user_id").cast("string")).alias("token")
    )
    found = lookup_tokens(vector_vocab(spark, folder), tokens)
    return found.groupBy("token", "token_id", "in_vocab").agg(F.count(F.lit(1)).alias("n"))


def token_union(spark, folder):
    return ordered_union(
        table(spark, folder, "events").select(F.col("event_type").alias("token"), F.col("event_id").alias("pos"))
    )


def token_union_of_two(spark, folder):
    events = table(spark, folder, "events").select(F.col("event_type").alias("token"), F.col("event_id").alias("pos"))
    parts = table(spark, folder, "part").select(F.col("p_type").alias("token"), F.col("p_partkey").alias("pos"))
    return ordered_union(events, parts)


def tokens_appended(spark, folder):
    return append_tokens(vector_vocab(spark, folder), ["<A>", "t5", "<B>"])


def token_table_appended(spark, folder):
    names = table(spark, folder, "part").select(F.col("p_name").alias("token"), F.col("p_partkey").alias("pos"))
    return append_tokens(vector_vocab(spark, folder), names)


def alignment(spark, folder):
    vocab = part_vocab(spark, folder)
    asked = vocab.select("token").union(spark.range(1).select(F.lit("<A>").alias("token")))
    matrix = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"))
    return alignment_report(vocab, matrix, asked)


def grown(spark, folder):
    vocab_size = table(spark, folder, "part").count()
    matrix = table(spark, folder, "embeddings")
    wide = grow_embeddings(matrix, vocab_size, "vec_id", "embedding")
    return wide.select("vec_id", F.get("embedding", F.lit(0)).cast("double").alias("first_value"))


def initialised(spark, folder):
    matrix, old = table(spark, folder, "embeddings"), vector_vocab(spark, folder)
    tokens = ["<A>", "t5", "<B>"]
    vocab = append_tokens(old, tokens)
    old_size = old.agg(F.max("id") + 1).first()[0]
    wide = grow_embeddings(matrix, old_size + 2, "vec_id", "embedding")
    ready = initialise_tokens(wide, vocab, tokens, 0, old_size, id_col="vec_id", vector_col="embedding")
    return ready.select("vec_id", F.posexplode("embedding").alias("dim", "v")).select(
        "vec_id", "dim", F.col("v").cast("double").alias("value")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "s1_csv_scan": csv_scan,
    "s1_csv_scan_typed": csv_scan_typed,
    "s2_json_lines_scan": json_lines_scan,
    "s2_json_lines_layout": json_lines_layout,
    "s3_workbook_scan": workbook_scan,
    "s6_token_template": token_templates,
    "k1_csv_sink": csv_sink,
    "k2_split_sink": split_sink,
    "k2_named_split_sink": named_split_sink,
    "p1_row_at": row_at_position,
    "p1_row_at_file_position": row_at_file_position,
    "p1_rows_at_positions": rows_at_positions,
    "p3_cast_string": cast_string,
    "p4_label_int": label_int,
    "p4_label_string": label_string,
    "p4_label_double": label_double,
    "p6_class_filter": class_filter,
    "p7_label_text": text_label,
    "a1_unknown_audit": unknown_audit,
    "a2_class_counts": count_classes,
    "a3_split_sizes": ratio_split_sizes,
    "x1_ratio_split": ratio_split,
    "x1_ratio_split_shared_keys": ratio_split_shared_keys,
    "x2_count_split": count_split,
    "x3_sample_n": sample_n,
    "x4_complement": complement_of_sample,
    "x5_union_of_classes": union_of_classes,
    "x6_shuffle": shuffle,
    "t1_safe_str": null_safe_text,
    "t2_text_column": text_column,
    "t3_template": template,
    "t3_template_widths": template_widths,
    "t4_article_comment": article_comment,
    "t5_key_value": key_value,
    "t6_layout_choice": layout_choice,
    "t7_trim_lower": trim_lower,
    "t8_strip_tokens": strip_tokens,
    "t9_preview": prompt_preview,
    "m1_messages": messages,
    "m2_validate": validation,
    "m2_validate_lists": list_validation,
    "m3_prompt": prompts,
    "m3_prompt_blocks": prompts_in_runs,
    "m3_prompt_from_list": prompts_of_lists,
    "m3_checked_lists": checked_lists,
    "m4_toggle": reasoning_toggle,
    "g1_generate": generated,
    "g2_first_candidate": candidate,
    "g3_allowed_choice": allowed_choice,
    "v1_extract_label": label_in_text,
    "v2_token_check": token_check,
    "v3_result_row": result_table,
    "v3_whole_run": whole_run,
    "v3_whole_run_tokens": whole_run_tokens,
    "e1_lookup": token_lookup,
    "e1_lookup_table": token_table_lookup,
    "e2_ordered_union": token_union,
    "e2_ordered_union_of_two": token_union_of_two,
    "e3_append": tokens_appended,
    "e3_append_table": token_table_appended,
    "e4_alignment": alignment,
    "e5_grow": grown,
    "e6_extend": initialised,
}


def labelled_prompts(spark: SparkSession, folder: str) -> DataFrame:
    """The flagship: an exact class-balanced split of the labelled documents with a prompt for each."""
    labels = with_label(table(spark, folder, "labels").select("doc_id", "quality"), "quality")
    # the split reads its input more than once, so it comes before the join with the texts
    parts = split_by_ratio(labels, "label", 0.8, 42, ["doc_id"])
    rows = table(spark, folder, "documents").select("doc_id", "text", "lang", "source").join(parts, "doc_id")
    content = template_text(rows, "Source: {source} ({lang})\n{text}")
    prompt = prompt_text(chat_messages(JUDGE, content), CHAT_FORMAT)
    return rows.select("doc_id", "label", "split", prompt.alias("prompt"))
