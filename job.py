"""spark-submit job.py -input PATH -output PATH -functionality a,b,c [-mappers N] [-rules TSV] [-gazetteer TSV]
[-format lines|offsets|articles] [-sink sorted|keyed|json|typed] [-line-as-sentence]
spark-submit job.py -input PATH -output PATH -prepare

Articles are keyed by their line, not by their id. Records that are no JSON go to PATH.bad and are counted. With -prepare
articles become one line of text each, in order, and nothing is annotated."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lexmill import run_job, validate
from lexmill.functions import html
from lexmill.plans.annotate import SINKS
from lexmill.sources import readers, sinks


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("-input", required=True)
    parser.add_argument("-output", required=True)
    what = parser.add_mutually_exclusive_group(required=True)
    what.add_argument("-functionality", help="comma-separated annotators")
    what.add_argument("-prepare", action="store_true", help="write articles as lines")
    parser.add_argument("-mappers", type=int, help="partitions; Spark's own choice if not given")
    parser.add_argument("-rules", help="dictionary of phrase TAB type lines")
    parser.add_argument("-gazetteer", help="names, as phrase TAB type lines, instead of the built-in ones")
    parser.add_argument("-format", choices=["lines", "offsets", "articles"], default="lines")
    parser.add_argument("-sink", choices=list(SINKS), default="sorted")
    parser.add_argument("-line-as-sentence", action="store_true")
    args = parser.parse_args()
    if not args.prepare:
        validate(args.functionality)

    spark = SparkSession.builder.appName("lexmill").getOrCreate()
    keys = ["doc_id"]
    if args.format == "lines" and not args.prepare:
        docs = readers.read_lines(spark, args.input)
    elif args.format == "offsets" and not args.prepare:
        docs, keys = readers.read_lines_by_offset(spark, args.input), ["path", "byte_offset"]
    else:
        articles = readers.read_numbered_articles(spark, args.input)
        bad, seen = sinks.counted(articles.where("_corrupt_record IS NOT NULL").select(F.col("_corrupt_record").alias("value")), "bad")
        bad.write.mode("overwrite").text(args.output.rstrip("/") + ".bad")
        print(f"{seen.get['n']} records could not be read", file=sys.stderr)
        docs = articles.where("_corrupt_record IS NULL").select("doc_id", html.article_text(F.col("contents")).alias("text"))
    if args.prepare:
        sinks.write_lines(docs, args.output)
    else:
        tables = {name: readers.read_rules(spark, path) for name, path in (("rules", args.rules), ("gazetteer", args.gazetteer)) if path}
        run_job(docs, args.functionality, args.output, args.mappers, keys, args.sink, line_as_sentence=args.line_as_sentence, **tables)
    spark.stop()


if __name__ == "__main__":
    main()
