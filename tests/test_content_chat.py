import math

import pytest
from pyspark.sql import functions as F

from rowloom.functions.chat import (
    PromptFormat, allowed_ids, best_allowed, chat_messages, checked_messages, extract_label,
    parse_toggle, prompt_text,
)
from rowloom.functions.content import key_value_text, template_text, user_text
from rowloom.operators import conversations
from rowloom.operators.checks import result_rows, token_report, with_clean_text, with_first_candidate
from rowloom.operators.conversations import (
    conversation_prompts, prompt_blocks, refuse_bad_messages, validate_message_lists, validate_messages,
)
from rowloom.operators.generation import generate
from rowloom.plans.text_runs import generation_results, prompt_lengths, prompt_rows

FMT = PromptFormat("<", ">", "\n", "<a>", "<a>on", "<a>off")


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(
        [("ab", 7, 1.5, None), ("né😀", -1, math.nan, "x y"), ("", 0, 1e7, "")],
        "t string, n int, f double, a string",
    )


def python_rows(df):
    return [
        {k: "" if v is None or v != v else str(v) for k, v in r.asDict().items()} for r in df.collect()
    ]


@pytest.mark.parametrize(
    "template",
    ["", "{t}", "a{{{n}}}b", "{{}}", "{t:>6}|{t:<6}|{t:^6}|{t:6}", "{t:*^7}{f:.2}", "{t:07}", "{a:x<4.1s}",
     "no fields\\n", "{t}{t}\n{n}", "{t:-<5}"],
)
def test_templates_render_as_in_python(table, template):
    got = [r[0] for r in table.select(template_text(table, template)).collect()]
    assert got == [template.format(**row) for row in python_rows(table)]


@pytest.mark.parametrize(
    "template,problem",
    [("{zz}", "zz"), ("{}", "no column name"), ("{0}", "no column name"), ("{t!r}", "conversions"),
     ("{t.x}", "plain column"), ("{t[0]}", "plain column"), ("{t:{n}}", "nested"), ("{t:d}", ""),
     ("{t:=5}", ""), ("{", "")],
)
def test_templates_refused_at_plan_time(table, template, problem):
    with pytest.raises(ValueError, match=problem):
        template_text(table, template)


def test_layouts(table):
    first = lambda c, df=table: df.select(c).first()[0]
    assert first(user_text(table, text_col="f")) == "1.5"
    assert first(user_text(table, text_col="t", template="{n}")) == "ab"
    assert first(user_text(table, template="{n}")) == "7"
    assert first(user_text(table, template="")) == first(key_value_text(table)) == "t: ab\nn: 7\nf: 1.5\na: "
    both = table.select(F.col("t").alias("comment"), F.col("a").alias("article"))
    assert first(user_text(both), both) == "Article:\n\n\nComment:\nab"
    with pytest.raises(ValueError, match="nope"):
        user_text(table, text_col="nope")


def test_a_template_reads_only_its_columns(spark, tables, capsys):
    part = spark.read.parquet(f"{tables}/part.parquet")
    part.select(template_text(part, "{p_name} {p_size}")).explain()
    plan = capsys.readouterr().out
    assert "ReadSchema: struct<p_name:string,p_size:int>" in plan
    assert "Exchange" not in plan and "Python" not in plan


def test_messages_and_prompts(spark, table):
    msgs = chat_messages("", F.col("t"))
    row = table.select(msgs.alias("m"), prompt_text(msgs, FMT).alias("p")).first()
    assert [tuple(m) for m in row.m] == [("system", ""), ("user", "ab")]
    assert row.p == "<system>\n<user>ab\n<a>"
    first = lambda c: table.select(c).first()[0]
    assert first(prompt_text(msgs, FMT, True)).endswith("<a>on")
    assert first(prompt_text(msgs, FMT, parse_toggle("false"))).endswith("<a>off")
    assert first(prompt_text(msgs, FMT, parse_toggle("none"))).endswith("<a>")
    by_row = FMT.ending(F.when(F.col("n") > 0, "true").when(F.col("n") < 0, "false"))
    assert [r[0] for r in table.select(by_row).collect()] == ["<a>on", "<a>off", "<a>"]
    plain = PromptFormat("<", ">", "\n", "<a>")
    assert first(prompt_text(msgs, plain, True)).endswith("<a>")
    with pytest.raises(ValueError, match="switch"):
        prompt_text(msgs, plain, True, strict=True)


def test_message_list_faults(spark):
    df = spark.createDataFrame(
        [(1, [("user", "a")]), (2, []), (3, None), (4, [("user", "a"), (None, "b"), ("x", None)])],
        "i int, m array<struct<role:string,content:string>>",
    )
    got = {r.i: (r.empty, r.n_bad, r.first_bad) for r in validate_message_lists(df, "m").collect()}
    assert got == {1: (False, 0, None), 2: (True, 0, None), 3: (True, 0, None), 4: (False, 2, 1)}
    with pytest.raises(ValueError, match="bad messages"):
        refuse_bad_messages(validate_message_lists(df, "m"))
    refuse_bad_messages(validate_message_lists(df.where("i = 1"), "m"))
    assert df.where("i = 1").select(checked_messages(F.col("m"))).first()[0][0].role == "user"
    with pytest.raises(Exception, match="position 1"):
        df.where("i = 4").select(checked_messages(F.col("m"))).collect()
    with pytest.raises(Exception, match="empty"):
        df.where("i = 2").select(checked_messages(F.col("m"))).collect()


def turns(spark, sizes):
    return spark.createDataFrame(
        [(c, t, "user" if t % 2 else "system", f"{c}/{t}") for c, n in sizes.items() for t in range(n)],
        "c string, t int, role string, text string",
    ).repartition(5)


def test_long_form_validation(spark):
    df = turns(spark, {"a": 3, "b": 2}).withColumn("role", F.nullif("role", F.lit("system")))
    got = {r.c: (r.n_bad, r.first_bad) for r in validate_messages(df, "c", "t").collect()}
    assert got == {"a": (2, 0), "b": (1, 0)}
    with pytest.raises(ValueError):
        refuse_bad_messages(validate_messages(df, "c", "t"))


@pytest.mark.parametrize("block", [1, 4, 1000])
@pytest.mark.parametrize("broadcast", [True, False])
def test_conversation_prompts_however_long(spark, monkeypatch, block, broadcast):
    monkeypatch.setattr(conversations, "fits_broadcast", lambda df: broadcast)
    sizes = {"a": 1, "b": 3, "hot": 200, None: 6}
    want = {
        c: "".join(f"<{'user' if t % 2 else 'system'}>{c}/{t}\n" for t in range(n)) + "<a>on"
        for c, n in sizes.items()
    }
    got = conversation_prompts(turns(spark, sizes), "c", "t", FMT, reasoning=True, block=block)
    assert {r.c: r.prompt for r in got.collect()} == want
    runs = prompt_blocks(turns(spark, sizes), "c", "t", FMT, block=block).orderBy("block").collect()
    for c in sizes:
        assert "".join(r.text for r in runs if r.c == c) + "<a>on" == want[c]


def test_turns_have_to_be_whole_numbers(spark):
    with pytest.raises(ValueError, match="integer"):
        prompt_blocks(spark.sql("select 1 c, 1.5D t, '' role, '' text"), "c", "t", FMT)


def test_generation(spark):
    df = spark.range(50, numPartitions=3).select(
        (F.col("id") + (1 << 60)).alias("k"), F.col("id").cast("string").alias("p"), F.lit(None).cast("int").alias("z")
    )

    def factory(suffix="!"):
        def run(prompts):
            return (p + suffix for p in prompts)
        return run

    got = generate(df, "p", factory, options={"suffix": "?"}, partitions=4)
    assert got.columns == ["k", "z", "generated_text"]
    assert {r.k - (1 << 60): r.generated_text for r in got.collect()} == {i: f"{i}?" for i in range(50)}
    assert generate(df, "p", factory, keep=["k", "p"]).where("k - 1152921504606846976 = 3").first()[1:] == ("3", "3!")
    with pytest.raises(Exception, match="prompts gave"):
        generate(df, "p", lambda: lambda prompts: ["x"]).collect()
    with pytest.raises(ValueError):
        generate(df, "p", factory, out="k")


def test_first_candidate(spark):
    df = spark.sql("select array(struct('a' text), struct('b' text)) s, array('x') t, cast(array() as array<string>) e, cast(null as array<string>) n")
    got = [with_first_candidate(df, c).first()["generated_text"] for c in df.columns]
    assert got == ["a", "x", "", ""]


def test_allowed_choice(spark):
    assert allowed_ids([5, None, 2, 5, -3, True]) == [2, 5]
    with pytest.raises(ValueError):
        allowed_ids([None, -1])
    df = spark.createDataFrame(
        [([0.1, 0.9, 0.5],), ([0.5, 0.9, 0.5],), ([0.1],), (None,), ([],)], "s array<float>"
    )
    assert [r[0] for r in df.select(best_allowed(F.col("s"), [2, 0])).collect()] == [2, 0, 0, None, None]


@pytest.mark.parametrize("tokens", [["<Y>", "<N>"], ["<Y>", "<Y>"], [""], [], ["y"]])
def test_extracted_label(spark, tokens):
    texts = ["", "a <Y>", "<N><Y>", "<y>", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for text, r in zip(texts, df.select(extract_label(F.col("t"), tokens).alias("c")).collect()):
        matched = [t for t in tokens if text is not None and t in text]
        label = "NONE" if not matched else matched[0] if len(matched) == 1 else "MULTIPLE"
        assert tuple(r.c) == (bool(matched), matched, label)


def test_token_report(spark):
    df = spark.createDataFrame([(1, "a <Y>", [4, 9]), (2, None, None)], "i int, t string, ids array<int>")
    got = {(r.i, r.token): (r.found_in_text, r.found_in_ids, r.token_id)
           for r in token_report(df, ["i"], "t", "ids", {"<Y>": 9, "<N>": 5, "q": None}).collect()}
    assert got == {(1, "<Y>"): (True, True, 9), (1, "<N>"): (False, False, 5), (1, "q"): (False, False, None),
                   (2, "<Y>"): (False, False, 9), (2, "<N>"): (False, False, 5), (2, "q"): (False, False, None)}


def test_whole_run(spark, table):
    asked = prompt_rows(table, ["n"], FMT, "S", template="{t}", label_col="a")
    assert asked.columns == ["n", "label_text", "prompt"]

    def factory():
        return lambda prompts: ["<Y>" if "ab" in p else "" for p in prompts]

    got = {r.n: (r.label_text, r.generated_text, r.extracted_label)
           for r in generation_results(asked, factory, ["<Y>"]).collect()}
    assert got == {7: (None, "<Y>", "<Y>"), -1: ("x y", "", "NONE"), 0: (None, "", "NONE")}
    assert prompt_lengths(asked).first()["n_chars"] == len("<system>S\n<user>ab\n<a>")
    clean = with_clean_text(generation_results(asked, factory), "generated_text", ["<Y>"])
    assert {r.content for r in clean.collect()} == {""}
    assert result_rows(clean, ["n"], None, "generated_text").columns == ["n", "label_text", "generated_text"]


def test_text_checks_need_no_python(table, capsys):
    table.select(extract_label(F.col("t"), ["a"]), prompt_text(chat_messages("", F.col("t")), FMT)).explain()
    assert "Python" not in capsys.readouterr().out
