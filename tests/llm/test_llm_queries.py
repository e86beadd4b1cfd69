"""Every registered operator over a small folder; those with SQL against it."""

import check
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op2": {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"},
    "op3": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op4": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op5": {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
    "op6": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
    "op7": {"doc_id", "held_out", "lang_pred", "score"},
    "op8": {"doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"},
    "op9": {"doc_id", "fingerprint", "component_id"},
    "op10": {"page_id", "url", "text", "n_chars"},
    "op11": {"doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"},
    "op12": {"item_id", "rank", "doc_id", "score"},
    "op13": {"query_id", "rank", "vec_id", "score"},
}


@pytest.mark.parametrize("number", list(COLUMNS))
def test_query(spark, number):
    [name] = [n for n in contract.queries() if n.startswith(f"{number}_")]
    frame = contract.queries()[name](spark, SF)
    assert COLUMNS[number] <= set(frame.columns)
    if int(number[2:]) < 12:
        table = "pages" if number == "op10" else "documents"
        assert frame.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
    if name in contract.oracle_sql():
        assert check.differences(spark, check.duck(SF), SF, name) == ""


def test_fingerprints_are_spark_hashes(spark):
    """The shingles' hash is the one that Spark's own function gives."""
    import xxhash
    assert spark.sql("SELECT xxhash64('a b c') h").first().h & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"a b c", 42)


def test_nothing_else_imports_llm():
    import pathlib
    root = pathlib.Path(contract.__file__).parent
    for path in [*root.glob("lexmill/**/*.py"), root / "bench.py", root / "job.py"]:
        assert "llm" in path.parts or "lexmill.llm" not in path.read_text()
