"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of parquet tables, BENCH_CPUS the cores. Each query is run once on the
smallest tables to load and compile its classes, then timed once, planning included, into a sink that
discards the rows."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from lexmill.queries.registry import queries  # noqa: E402

HEADLINE = [
    "tokenize", "ssplit", "cleanxml", "pos", "lemma", "ner", "regexner", "regexner_join", "natlog", "sentiment",
    "doc_sentiment", "parse_chunks", "depparse_edges", "coref", "coref_text", "relation", "quote", "openie",
    "line_as_sentence", "annotate_long", "annotate_syntax", "html_to_text", "articles_to_lines", "normalize_nfkd",
    "read_lines_indexed", "sink_by_functionality", "sorted_results", "dcoref", "read_lines_by_offset", "html_to_text_exact",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("lexmill-bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
        .config("spark.lexmill.spread", str(4 * int(cpus)))  # the tables are one split each
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    named = sys.argv[1:] or HEADLINE
    run = queries()
    seconds = {}
    for name in named:
        if os.path.isdir(small):
            run[name](spark, small).write.format("noop").mode("overwrite").save()
        start = time.perf_counter()
        run[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
