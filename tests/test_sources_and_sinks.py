import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from lexmill import annotate, ranked_results, run_job
from lexmill.functions import html
from lexmill.functions.text import running_sum
from lexmill.operators.documents import spread
from lexmill.operators import phrases
from lexmill.sources import readers, sinks


def write(path, data: bytes):
    path.write_bytes(data)
    return str(path)


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_line_numbers(spark, tmp_path):
    path = write(tmp_path / "a.txt", "héllo a\n\nb c\n".encode())
    assert sorted(map(tuple, readers.read_lines(spark, path).collect())) == [(0, "héllo a"), (1, ""), (2, "b c")]


def test_line_numbers_over_many_splits(spark, tmp_path, small_splits):
    path = write(tmp_path / "a.txt", b"".join(b"line %d\n" % i for i in range(3000)))
    lines = readers.read_lines(spark, path)
    assert spark.read.text(path).rdd.getNumPartitions() > 5
    assert sorted(r.doc_id for r in lines.collect()) == list(range(3000))
    files = tmp_path / "many"
    files.mkdir()
    for k in range(4):
        write(files / f"{k}.txt", b"".join(b"%d %d\n" % (k, i) for i in range(300 * k)))
    got = sorted(map(tuple, readers.read_lines(spark, str(files)).collect()))
    assert [i for i, _ in got] == list(range(1800))
    assert sorted(t for _, t in got) == sorted(f"{k} {i}" for k in range(4) for i in range(300 * k))


def test_byte_offsets(spark, tmp_path, small_splits):
    files = {"a": "héllo a\n\nb c\n".encode(), "b": b"".join(b"%d\r\n" % (i * i) for i in range(2000)), "c": b"x\ry\n\rz", "d": b""}
    for name, data in files.items():
        write(tmp_path / name, data)
    got = {(os.path.basename(r.path), r.byte_offset): r.text for r in readers.read_lines_by_offset(spark, str(tmp_path)).collect()}
    assert [o for n, o in sorted(got) if n == "a"] == [0, 9, 10]
    for (name, offset), text in got.items():
        assert files[name][offset:offset + len(text.encode())] == text.encode()
    assert len([1 for n, _ in got if n == "b"]) == 2000
    assert sorted((o, t) for (n, o), t in got.items() if n == "c") == [(0, "x"), (2, "y"), (4, ""), (5, "z")]


def test_articles(spark, tmp_path):
    def block(**kw):
        return kw
    rows = [
        {"id": "1", "contents": [block(type="sanitized_html", content="x &am"), block(type="image", content="no"),
                                 block(type="sanitized_html", content="p; y")]},
        {"id": "2"},
        {"id": "3", "contents": [None, block(content="no type"), block(type="sanitized_html"),
                                 block(type="sanitized_html", content="<p>one</p>\n<p>ﬁne</p>")]},
    ]
    path = write(tmp_path / "a.json", ("\n".join(map(json.dumps, rows)) + "\n{bad\n").encode())
    articles = readers.read_articles(spark, path).cache()
    assert articles.where("_corrupt_record is not null").count() == 1
    for exact in (False, True):
        got = {r.id: r.t for r in articles.where("id is not null").select("id", html.article_text(F.col("contents"), exact=exact).alias("t")).collect()}
        assert got == {"1": "x & y", "2": "", "3": "one  fine"}


def test_markup(docs):
    texts = ["a &amp; b", "<b>x</b><!-- c -->y", "<script>var t='1';</script>z", "<p>a</p>", "tail &amp", "a &eacute; b"]
    frame = docs(*texts).select("doc_id", html.html_to_text(F.col("text")).alias("a"), html.html_to_text_exact(F.col("text")).alias("b"),
                                html.html_to_text_exact(F.col("text"), ("script",)).alias("c")).orderBy("doc_id").collect()
    assert [r.a for r in frame][:4] == [r.b for r in frame][:4] == ["a & b", "x y", "var t='1'; z", "a"]
    assert [r.b for r in frame][4:] == ["", "a é b"]
    assert frame[2].c == "z"


def test_rules(spark, tmp_path):
    path = write(tmp_path / "r.tsv", b"Bachelor of Arts\tDEGREE\nBachelor of Laws\tDEGREE")
    assert sorted(map(tuple, readers.read_rules(spark, path).collect())) == [("Bachelor of Arts", "DEGREE"), ("Bachelor of Laws", "DEGREE")]


def lines_of(folder):
    return [line for p in sorted(glob.glob(f"{folder}/part-*")) for line in open(p, encoding="utf-8").read().splitlines()]


@pytest.mark.parametrize("names, table, trie_bytes", [
    ("tokenize,pos", None, 0), ("tokenize,coref", None, 0), ("tokenize,regexner", "rules", 1000), ("tokenize,regexner", "rules", 0),
    ("tokenize,ner", "gazetteer", 1000), ("tokenize,ner", "gazetteer", 0)])
def test_one_sorted_directory_per_annotator(spark, tmp_path, monkeypatch, names, table, trie_bytes):
    monkeypatch.setattr(phrases, "TRIE_BYTES", trie_bytes)
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("doc w"), F.format_string("%03d", "id")).alias("text")).repartition(5)
    rule_frame = spark.createDataFrame([("doc", "D")], "pattern string, type string")
    out = str(tmp_path / "out")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # which would hide parts out of order in a few
    run_job(docs, names, out, mappers=4, **({table: rule_frame} if table else {}))
    spark.conf.unset("spark.sql.adaptive.enabled")
    assert lines_of(f"{out}/functionality=tokenize") == [f"doc w {i:03d}" for i in range(200)]
    assert len(glob.glob(f"{out}/functionality=tokenize/part-*")) > 1
    assert sorted(d for d in os.listdir(out) if d.startswith("func")) == sorted(f"functionality={n}" for n in names.split(","))


def test_other_sinks(spark, docs, tmp_path):
    results = annotate(docs("b c", "a"), "tokenize")
    sinks.write_keyed(results, str(tmp_path / "keyed"))
    assert sorted(lines_of(tmp_path / "keyed")) == ["(tokenize, 0)\tb c", "(tokenize, 1)\ta"]
    sinks.write_json(results, str(tmp_path / "json"))
    assert sorted(json.loads(x)["result"] for x in lines_of(tmp_path / "json")) == ["a", "b c"]
    sinks.write_typed(results, str(tmp_path / "typed"))
    assert spark.read.parquet(str(tmp_path / "typed")).count() == 2
    sinks.write_lines(docs("z", "", "a"), str(tmp_path / "lines"))
    assert lines_of(tmp_path / "lines") == ["z", "", "a"]
    counted, seen = sinks.counted(results)
    counted.collect()
    assert seen.get["n"] == 2


def test_spread_is_on_request(spark):
    assert spread(spark.range(0, 1000, 1, 1), 3).rdd.getNumPartitions() == 3


def test_ranks_over_many_ranges(spark, tmp_path):
    keys = [*range(500), 7, 7, -3, None]
    rows = spark.createDataFrame([(f, k, f"{f}{k}") for f in "ab" for k in keys], "functionality string, doc_id bigint, result string").repartition(5)
    got = sinks.ranked(rows, str(tmp_path / "a")).collect()
    for f in "ab":
        own = sorted(((r["rank"], r.doc_id) for r in got if r.functionality == f))
        assert [r for r, _ in own] == list(range(1, len(keys) + 1))
        assert [k for _, k in own] == sorted(keys, key=lambda k: (k is not None, k or 0))
    assert sinks.ranked(rows.limit(0), str(tmp_path / "b")).count() == 0


@pytest.mark.parametrize("trie_bytes", [1000, 0])
def test_ranked_results(spark, tmp_path, monkeypatch, trie_bytes):
    monkeypatch.setattr(phrases, "TRIE_BYTES", trie_bytes)
    docs = spark.range(300).select((F.lit(300) - F.col("id")).alias("doc_id"), F.concat(F.lit("A dog w"), "id").alias("text")).repartition(7)
    rules = spark.createDataFrame([("dog", "D")], "pattern string, type string")
    got = ranked_results(docs, "regexner,coref", str(tmp_path / "out"), rules=rules).collect()
    assert sorted((r.functionality, r.doc_id, r["rank"]) for r in got) == sorted((f, i, i) for f in ("coref", "regexner") for i in range(1, 301))
    assert {r.result.split()[1] for r in got if r.functionality == "regexner"} == {"D"}


def test_running_sum(spark):
    for n in (0, 1, 255, 256, 257, 70_000):
        got = spark.range(1).select(F.expr(f"transform(sequence(1, {n}), x -> CAST(x AS BIGINT))" if n else "CAST(array() AS array<bigint>)").alias("xs"))
        got = got.select(F.expr(running_sum("xs")).alias("s")).first().s
        assert got == [i * (i + 1) // 2 for i in range(1, n + 1)]


def test_markup_is_read_as_the_parser_does(docs):
    import random
    rng = random.Random(5)
    parts = ["<p>", "</p>", '<b class="x">', "<br/>", '<a title="x > y">', "<a href='q'>", "text", "&amp;", "&copy;", "&#233;", "&eacute;", "&", "<",
             "<!-- c -->", "<!-- open", "<!-->", "--!>", "-->", "<script>", "</script>", '<script>var a="</p>";</script>', "<style>p{}</style>",
             "<SCRIPT>", "</Script >", "<title>a", "</title>", "<textarea>", "<!DOCTYPE html>", '<?xml v="1"?>', "<![CDATA[x]]>", " ", "\n", "\x01",
             "a < b", "</", "<p", "&am", '<p\n x="1"\ty="2" />', "<x-y>", "<scripted>", "<svg/onload=x>"]
    frame = docs(*["".join(rng.choices(parts, k=rng.randrange(1, 9))) for _ in range(3000)], None, "")
    for drop in ((), ("script", "style")):
        both = frame.select("text", html.html_to_text(F.col("text"), drop).alias("a"), html.html_to_text_exact(F.col("text"), drop).alias("b"))
        assert [r for r in both.collect() if r.a != r.b] == []


def test_bad_markup_is_linear(docs):
    import time
    frame = docs("<!--" * 20_000, "<a" * 100_000, "<script" * 50_000, '<a "' * 50_000)
    start = time.perf_counter()
    frame.select(html.html_to_text(F.col("text"), ("script", "style"))).collect()
    assert time.perf_counter() - start < 8


def test_job_keeps_articles_apart(spark, tmp_path, monkeypatch):
    """Missing and repeated ids, a bad line, and the keyed sink with byte offsets."""
    import json
    import sys

    import job
    lines = [json.dumps({"id": i, "contents": [{"type": "sanitized_html", "content": t}]}) for i, t in (
        (None, "Barack Obama spoke. He left."), (None, "Angela Merkel spoke. She left."), ("a", "Tom Lee won."), ("a", "Tom Lee lost."))]
    write(tmp_path / "in.json", "\n".join([*lines, "{no json"]).encode())
    monkeypatch.setattr(spark, "stop", lambda: None)
    monkeypatch.setattr(sys, "argv", ["job", "-input", str(tmp_path / "in.json"), "-output", str(tmp_path / "out"), "-functionality", "coref,pos",
                                      "-format", "articles", "-sink", "json"])
    job.main()
    got = sorted((r.functionality, r.doc_id, r.result) for r in spark.read.json(str(tmp_path / "out")).collect())
    assert [x[:2] for x in got] == [(f, i) for f in ("coref", "pos") for i in range(4)]
    assert "Barack Obama" in got[0][2] and "Angela" not in got[0][2] and "Angela Merkel" in got[1][2]
    assert lines_of(tmp_path / "out.bad") == ["{no json"]
    write(tmp_path / "t.txt", b"One dog.\nTwo cats.\n")
    monkeypatch.setattr(sys, "argv", ["job", "-input", str(tmp_path / "t.txt"), "-output", str(tmp_path / "keyed"), "-functionality", "tokenize",
                                      "-format", "offsets", "-sink", "keyed"])
    job.main()
    assert sorted(lines_of(tmp_path / "keyed")) == ["(tokenize, 0)\tOne dog .", "(tokenize, 9)\tTwo cats ."]


def test_job_prepares_lines_and_takes_names(spark, tmp_path, monkeypatch):
    import json
    import sys

    import job
    write(tmp_path / "in.json", "\n".join(json.dumps({"contents": [{"type": "sanitized_html", "content": f"<p>Red Fox {i}\n of Mill</p>"}]}) for i in range(30)).encode())
    write(tmp_path / "names.tsv", b"Red Fox\tANIMAL\nMill\tPLACE\n")
    monkeypatch.setattr(spark, "stop", lambda: None)
    monkeypatch.setattr(sys, "argv", ["job", "-input", str(tmp_path / "in.json"), "-output", str(tmp_path / "lines"), "-prepare"])
    job.main()
    assert lines_of(tmp_path / "lines") == [f"Red Fox {i} of Mill" for i in range(30)]
    monkeypatch.setattr(sys, "argv", ["job", "-input", str(tmp_path / "lines"), "-output", str(tmp_path / "out"), "-functionality", "ner",
                                      "-gazetteer", str(tmp_path / "names.tsv")])
    job.main()
    assert lines_of(tmp_path / "out/functionality=ner") == ["ANIMAL ANIMAL NUMBER O PLACE"] * 30
    monkeypatch.setattr(sys, "argv", ["job", "-input", "x", "-output", "y"])
    with pytest.raises(SystemExit):
        job.main()
