"""Each stage on its own input, and all of them on a small corpus."""

import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

pipeline = pytest.importorskip("corpus_pipeline")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, findings string"
SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    def make(*pairs):
        rows = [(i, t, None, "s", None if t is None else len(t), "x") for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA)
    return make


def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_language_rejects_what_has_none(spark):
    table = corpus(spark)
    odd = spark.createDataFrame([(900001, "1234 !!", None, "s", 7), (900002, None, None, "s", None), (900003, "", "en", "s", 0)], table.schema)
    kept = pipeline.identify_language(spark, table.union(odd), SF)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in table.collect()}
    assert pipeline.identify_language(spark, odd, SF).count() == 0
    assert pipeline.identify_language(spark, table.limit(0), SF).count() == 0


def test_one_of_each_group_stays(spark, docs):
    words = [f"w{i}" for i in range(3000)]
    near = words[:]
    near[150] = "other"
    table = docs((5, " ".join(words)), (3, " ".join(words)), (6, " ".join(near)), (9, "apart from all others"), (9, "apart from all others"),
                 (9, "one id with another text"), (None, "no id"), (None, "no id"), (None, "apart from all others"), (8, None), (7, ""))
    kept = pipeline.drop_near_duplicates(spark, table, SF)
    assert kept.columns == table.columns
    assert sorted(((r.doc_id, (r.text or "")[:8]) for r in kept.collect()), key=repr) == [
        (3, "w0 w1 w2"), (7, ""), (9, "apart fr"), (9, "one id w"), (None, "no id")]


def test_one_stays_exactly_where_the_operator_links(spark):
    table = corpus(spark)
    classes = {r.component_id for r in pipeline.simhash.near_duplicates(table).collect()}
    kept = [r.doc_id for r in pipeline.drop_near_duplicates(spark, table, SF).collect()]
    assert sorted(kept) == sorted(classes)
    named = table.withColumnsRenamed({"lang": "late", "source": "digest", "n_chars": "key"})
    again = pipeline.simhash.one_of_each(named)
    assert again.columns == named.columns and sorted(r.doc_id for r in again.collect()) == sorted(classes)


def test_leaks_go_and_short_items_are_cut(spark, docs, tmp_path):
    item = "one two three four five six seven eight nine ten eleven twelve"
    spark.createDataFrame([(1, item), (2, "short item")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    table = docs((1, f"before {item} after"), (2, "with a Short, item inside"), (3, "clean"), (4, None), (5, "one two three four five six seven eight nine"))
    kept = {r.doc_id: (r.text, r.n_chars) for r in pipeline.decontaminate_benchmark(spark, table, str(tmp_path)).collect()}
    assert kept == {2: ("with a  inside", 14), 3: ("clean", 5), 4: (None, None), 5: (table.collect()[4].text, 44)}


def test_secrets_are_masked(spark, docs):
    table = docs((1, "x password=hunter2hunter2 y"), (2, "plain"), (3, None))
    kept = {r.doc_id: (r.text, r.n_chars, r.findings) for r in pipeline.mask_secrets(spark, table, SF).collect()}
    assert kept == {1: ("x [secret] y", 12, "x"), 2: ("plain", 5, "x"), 3: (None, None, "x")}


def test_empty_tables(spark, docs):
    none = docs((1, "x")).limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0


def test_run(spark):
    table = {r.doc_id: r.text for r in corpus(spark).collect()}
    got = pipeline.run(spark, SF).collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert 0 < len(got) < len(table) and len({r.doc_id for r in got}) == len(got)
    benchmark = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = set()
    for text in benchmark:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
        windows |= {" ".join(words[i:i + 10]) for i in range(len(words) - 9)}
    for r in got:
        text = library.decode(list(memoryview(bytes(r.ids)).cast("I")), skip_special_tokens=False)
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
        assert not windows & {" ".join(words[i:i + 10]) for i in range(len(words) - 9)}
        if "[secret]" not in text:
            assert text == table[r.doc_id]
