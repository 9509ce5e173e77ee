from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowloom.functions.chat import PromptFormat, chat_messages, extract_label, prompt_text
from rowloom.functions.content import template_text
from rowloom.operators.generation import generate
from rowloom.operators.conversations import validate_messages
from rowloom.operators.labels import class_counts, unknown_labels, with_label
from rowloom.streaming.rows import compact_updates, current_rows, stream_table, write_stream, write_updates

SCHEMA = T.StructType().add("i", "long").add("l", "string").add("t", "string")


def test_rows_are_labelled_and_rendered_once(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()

    def run():
        rows = with_label(stream_table(spark, str(folder), "csv", SCHEMA), "l")
        prompt = prompt_text(chat_messages("S", template_text(rows, "{i}:{t}")), PromptFormat("<", ">", ";", "<a>"))
        check = extract_label(F.col("t"), ["<Y>"])["extracted_label"]
        done = rows.select("i", "label", prompt.alias("prompt"), check.alias("found"))
        query = write_stream(done, out, "rows")
        assert query.awaitTermination(120)
        return {r.i: tuple(r[1:]) for r in spark.read.parquet(out).collect()}

    (folder / "1.csv").write_text("i,l,t\n1,yes,a <Y>\n2,No,NA\n")
    want = {1: (True, "<system>S;<user>1:a <Y>;<a>", "<Y>"), 2: (False, "<system>S;<user>2:;<a>", "NONE")}
    assert run() == want
    (folder / "2.csv").write_text("i,l,t\n3,?,z\n")
    assert run() == want | {3: (None, "<system>S;<user>3:z;<a>", "NONE")}
    assert spark.read.parquet(out).count() == 3


def test_json_lines_generation_and_audit(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.jsonl").write_text('{"i": 1, "l": "?", "t": "x"}\n\n{"i": 2, "l": "?", "t": "y"}\n')
    rows = stream_table(spark, str(folder), "jsonl", SCHEMA)
    texts = generate(rows, "t", lambda: lambda prompts: [p * 2 for p in prompts], keep=["i"])
    assert write_stream(texts, str(tmp_path / "out"), "texts").awaitTermination(120)
    assert {r.i: r.generated_text for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {1: "xx", 2: "yy"}
    audit = unknown_labels(with_label(rows, "l"), "l")
    query = audit.writeStream.outputMode("complete").format("memory").queryName("audit").trigger(availableNow=True).start()
    assert query.awaitTermination(120)
    assert [tuple(r) for r in spark.table("audit").collect()] == [("?", 2)]


def test_counts_and_audits_kept_up_to_date(spark, tmp_path):
    """Three aggregates in update mode over growing files, with a restart and a batch that runs again."""
    folder, out = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    schema = T.StructType().add("conv", "long").add("turn", "long").add("role", "string").add("text", "string").add("l", "string")

    def run():
        rows = with_label(stream_table(spark, str(folder), "csv", schema), "l")
        made = {
            "audit": (unknown_labels(rows, "l"), ["value"]),
            "classes": (class_counts(rows), ["label"]),
            "bad": (validate_messages(rows, "conv", "turn"), ["conv"]),
        }
        for name, (df, _) in made.items():
            assert write_updates(df, str(out / name), f"up-{name}").awaitTermination(120)
        return {n: {tuple(r) for r in current_rows(spark, str(out / n), k).collect()} for n, (_, k) in made.items()}

    (folder / "1.csv").write_text("conv,turn,role,text,l\n1,0,user,a,yes\n1,1,,b,?\n2,0,user,c,no\n2,1,user,d,NA\n")
    assert run() == {
        "audit": {("?", 1), (None, 1)}, "classes": {(True, 1), (False, 1), (None, 2)}, "bad": {(1, 1, 1), (2, 0, None)},
    }
    (folder / "2.csv").write_text("conv,turn,role,text,l\n2,2,user,,?\n1,2,user,z,yes\n")
    want = {
        "audit": {("?", 2), (None, 1)}, "classes": {(True, 2), (False, 1), (None, 3)}, "bad": {(1, 1, 1), (2, 1, 2)},
    }
    assert run() == want and run() == want
    # A batch whose folder was written before the restart is written again, not added.
    changed = spark.read.parquet(str(out / "audit" / "batch=1"))
    kept = [tuple(r) for r in changed.collect()]
    spark.createDataFrame(kept, changed.schema).write.mode("overwrite").parquet(str(out / "audit" / "batch=1"))
    assert run() == want
    compact_updates(spark, str(out / "classes"), str(out / "small"), ["label"])
    assert {tuple(r) for r in current_rows(spark, str(out / "small"), ["label"]).collect()} == want["classes"]
