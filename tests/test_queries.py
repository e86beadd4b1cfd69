import check
import pytest

import __spark_entry__ as contract

LLM = {*contract.llm.queries(), "pipeline"} if contract.llm else set()

SF = "/root/testdata/sf0.001"
# Checked by other means: the operators of llm and learned taggers have their own tests.
ROWS_ONLY = {"learned_layers"}
OWN = [name for name in contract.queries() if name not in LLM]


@pytest.fixture(scope="module")
def con():
    return check.duck(SF)


@pytest.mark.parametrize("name", OWN)
def test_query_equals_its_sql(spark, con, name):
    assert check.differences(spark, con, SF, name) == ""


def test_which_have_sql():
    assert set(OWN) - set(contract.oracle_sql()) == ROWS_ONLY
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_rules_fire_on_the_corpus(spark):
    for name in ("relation", "quote", "openie", "coref", "depparse_edges"):
        assert contract.queries()[name](spark, SF).count() > 1
    tags = {r.ner for r in contract.queries()["regexner"](spark, SF).select("ner").distinct().collect()}
    assert {"PERSON", "LOCATION", "ORGANIZATION", "DEGREE", "LICENSE", "MONEY", "PERCENT", "NUMBER", "URL", "EMAIL", "MISC", "O"} <= tags
    assert {r.polarity for r in contract.queries()["natlog"](spark, SF).select("polarity").distinct().collect()} == {"up", "down", "flat"}


def test_row_local_plans_do_not_shuffle(spark):
    from lexmill import annotate
    docs = spark.range(0, 10, 1, 64).selectExpr("id as doc_id", "'a b.' as text")
    names = "tokenize,ssplit,pos,lemma,ner,regexner,parse,depparse,natlog,sentiment,openie,relation"
    text = annotate(docs, names)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Sort" not in text and "Python" not in text
    text = annotate(docs, names + ",quote")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Sort" not in text


def test_chains_do_not_shuffle(spark):
    from lexmill import annotate
    docs = spark.range(0, 10, 1, 64).selectExpr("id + 1 as doc_id", "'a b.' as text")
    plan = annotate(docs, "coref,dcoref")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Range") == 1
