"""Secret scans with an incremental ledger of blobs.

A text is addressed by its SHA-256, whatever paths and versions it stands under. The ledger is a Parquet table in a
folder that all executors share: a row for every scan of a blob, with the versioned rules that were run and what they
found. A scan reads only blobs that lack a rule, runs only the rules they lack, appends a row, and the findings of the wanted
versions go back to every path of the blob by a join. A changed pattern is a new version, and scans what it must anew.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.common import blocks, packed

LEDGER = "blob binary, rules array<string>, findings array<struct<rule:string,start:int,stop:int>>"
FINDINGS = pa.list_(pa.struct({"rule": pa.string(), "start": pa.int32(), "stop": pa.int32()}))


@dataclass(frozen=True)
class Rule:
    """A match counts if its group has at least so many characters. Failing matches use up their text all the same."""

    kind: str
    pattern: str
    flags: int = re.ASCII
    group: int = 0
    least: int = 1

    @property
    def version(self) -> str:
        return f"{self.kind}@{zlib.crc32(repr((self.pattern, int(self.flags), self.group, self.least)).encode()):08x}"


LABEL = r"(?:[A-Z]+ )*PRIVATE KEY(?: BLOCK)?-----"
LINE = r"(?:\r?\n|\r|\\r\\n|\\n)"
#: A private key from BEGIN to its END, whatever stands between but other marks of five dashes. Where END is missing: its
#: attributes, then lines that are one run of base64 and runs of 16 characters on, and the shorter run that ends them.
#: All is taken possessively and stops before the next mark, so that keys without END stay linear.
PEM = (rf"-----BEGIN {LABEL}(?:[^-]*+(?:-(?!----)[^-]*+)*+-{{5,}}+END {LABEL}"
       rf"|(?:{LINE}[ \t>]*[A-Za-z][A-Za-z-]*: [^\r\n\\]*+)*+"
       rf"(?:(?:(?:\s|\\[rn])++[A-Za-z0-9+/]{{16,}}+=*+|(?:[ \t]|{LINE})*?{LINE}[ \t]*+[A-Za-z0-9+/]++=*+(?=[ \t]*+(?:[\r\n\\]|\Z)))++"
       rf"(?:(?:\s|\\[rn])++[A-Za-z0-9+/]++=*+)?)?+)")
#: The first three are the base; the order settles ties. Runs are taken whole from their first character, so that no
#: rule looks twice at a stretch.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE, 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{32,}+"),
    Rule("pem", PEM),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
    Rule("forge", r"(?<![A-Za-z0-9_])gh[pousr]_[A-Za-z0-9]{36,}+"),
)
BASE = ("assign", "access", "hex")


def scan_blobs(rules: Sequence[Rule]):
    """(blob, text, todo) to ledger rows."""
    compiled = {r.version: (i, r, re.compile(r.pattern, r.flags)) for i, r in enumerate(rules)}
    schema = pa.schema({"blob": pa.binary(), "rules": pa.list_(pa.string()), "findings": FINDINGS})

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for blob, text, todo in zip(*map(batch.column, ("blob", "text", "todo")), strict=True):
                names, body, found = todo.as_py(), text.as_py(), []
                for i, rule, pattern in map(compiled.__getitem__, names):
                    for m in pattern.finditer(body):
                        if m.end(rule.group) - m.start(rule.group) >= rule.least:
                            found.append((m.start(), i, m.end(), rule.version))
                yield blob.as_py(), names, [{"rule": k, "start": a, "stop": b} for a, _, b, k in sorted(found)]

    return lambda batches: packed((r for b in batches for r in rows(blocks(iter([b]), "text"))), schema)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """An empty ledger where the folder has none yet."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    if not there:
        return spark.createDataFrame([], LEDGER)
    # Rows of findings without their rule's version, as earlier ledgers have them, count as not scanned.
    return spark.read.schema(LEDGER).parquet(path).where("NOT exists(findings, f -> f.rule IS NULL)")


def scan(versions: DataFrame, ledger: str, text: str = "text", rules: Sequence[Rule] = RULES, name: str = "findings") -> DataFrame:
    """Every row (path, version, ...) with all its columns and a column name: its findings as (kind, start, stop) in
    code points, stop exclusive, by start, then in the order of the rules. Scans what the ledger lacks and adds it.

    A null text counts as empty. Equal texts are one blob, repeated rows all come back. A column that is called name
    already is replaced. A scan that is cut off leaves no partial row: Spark commits its files at the end."""
    spark = versions.sparkSession
    body = F.coalesce(F.col(text), F.lit(""))
    address = F.unhex(F.sha2(body, 256))
    wanted = F.array(*[F.lit(r.version) for r in rules])
    known = read_ledger(spark, ledger).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("done"))
    unseen = (versions.select(address.alias("blob"), body.alias("text")).dropDuplicates(["blob"]).join(known, "blob", "left")
              .select("blob", "text", F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>"))).alias("todo"))
              .where("size(todo) > 0"))
    unseen.mapInArrow(scan_blobs(rules), LEDGER).write.mode("append").parquet(ledger)

    place = {r.version: i for i, r in enumerate(rules)}
    order = F.create_map(*[x for k, i in place.items() for x in (F.lit(k), F.lit(i))])
    current = read_ledger(spark, ledger).select("blob", "findings", F.arrays_overlap("rules", wanted).alias("used")).where("used")
    sorted_ = F.sort_array(F.transform(F.filter(F.flatten(F.collect_list("findings")), lambda f: F.array_contains(F.lit(list(place)), f.rule)),
                                       lambda f: F.struct(f.start, order[f.rule].alias("i"), f.stop, F.substring_index(f.rule, "@", 1).alias("kind"))))
    found = (current.where("size(findings) > 0").groupBy("blob")
             .agg(F.transform(F.array_distinct(sorted_), lambda f: F.struct(f.kind, f.start, f.stop)).alias("__found")))
    joined = versions.drop(name).withColumn("__blob", address).join(found.withColumnRenamed("blob", "__blob"), "__blob", "left")
    return joined.select(*[F.col(f"`{c}`") for c in versions.columns if c != name],
                         F.coalesce("__found", F.array().cast("array<struct<kind:string,start:int,stop:int>>")).alias(name))


def report(found: DataFrame, doc_id: str = "doc_id", name: str = "findings") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    def of(*kinds):
        return F.filter(name, lambda f: f.kind.isin(*kinds))
    def line(spans):
        return F.array_join(F.transform(spans, lambda f: F.concat_ws(":", f.kind, f.start, f.stop)), ",")
    return found.select(
        F.col(doc_id).alias("doc_id"), *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(line(of(*BASE)), 256).alias("base_sha256"), line(F.col(name)).alias("spans"))


def mask(found: DataFrame, text: str = "text", name: str = "findings", put: str = "[secret]") -> DataFrame:
    """The rows without the column name; overlapping findings of a text are merged, each replaced by put."""
    schema = found.drop(name).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, spans in zip(batch.column(text).to_pylist(), batch.column(name).to_pylist(), strict=True):
                kept, done = [], 0
                for s in spans:
                    if s["start"] >= done:
                        kept += [body[done:s["start"]], put]
                    done = max(done, s["stop"])
                out.append("".join([*kept, body[done:]]) if spans else body)
            changed = batch.set_column(batch.schema.get_field_index(text), text, pa.array(out, pa.string()))
            yield changed.select([n for n in changed.schema.names if n != name])
    return found.mapInArrow(run, schema)
