"""Times headline queries and prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [names…]

Each query is run once to warm up and then BENCH_RUNS times (3); the median
counts. Results go to Spark's ``noop`` sink, which works out every column of
every row and stores none. A query's time includes the counting jobs it runs
before its result.
"""

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from rowloom.catalog import LINE_KEY, QUERIES, labelled_prompts, line_labels
from rowloom.operators.split import row_digest

HEADLINE = [
    "p4_label_string",
    "a1_unknown_audit",
    "x1_ratio_split",
    "x2_count_split",
    "x3_sample_n",
    "x6_shuffle",
    "t3_template",
    "t5_key_value",
    "t8_strip_tokens",
    "m2_validate",
    "m3_prompt",
    "m3_prompt_from_list",
    "g1_generate",
    "g3_allowed_choice",
    "v1_extract_label",
    "v2_token_check",
    "v3_result_row",
    "e1_lookup_table",
    "e3_append_table",
    "e6_extend",
]


def ranked_split(spark, folder):
    """The same split by a plain rank per class, which sorts each class in one task; for comparison."""
    lines = line_labels(spark, folder)
    ranked = lines.withColumn("h", row_digest(lines, 42, LINE_KEY)).withColumns(
        {
            "rn": F.row_number().over(Window.partitionBy("label").orderBy("h")),
            "n": F.count(F.lit(1)).over(Window.partitionBy("label")),
        }
    )
    train = F.greatest(F.lit(1), F.least((F.col("n") * F.lit(0.8)).cast("bigint"), F.col("n") - 1))
    return ranked.select(
        *LINE_KEY, "label", F.when(F.col("rn") <= train, "train").otherwise("test").alias("split")
    )


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    memory = os.environ.get("BENCH_MEMORY", "8g")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rowloom-bench")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(query) -> float:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            query(spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        return round(statistics.median(times[1:]), 4)

    chosen = {"labelled_prompts": labelled_prompts} | {n: QUERIES[n] for n in HEADLINE}
    extra = {"x1_by_rank_for_comparison": ranked_split}
    if sys.argv[1:]:
        chosen = {n: q for n, q in (chosen | QUERIES).items() if n in sys.argv[1:]}
        extra = {n: q for n, q in extra.items() if n in sys.argv[1:]}
    timed = {n: seconds(q) for n, q in chosen.items()}
    compared = {n: seconds(q) for n, q in extra.items()}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timed.values()), 4),
                "unit": "sec",
                "queries": timed,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "memory": memory,
                "compared": compared,
            }
        )
    )


if __name__ == "__main__":
    main()
