import pytest

from aerofeat.llm.decontaminate import contamination
from aerofeat.llm.jaccard import jaccard_components
from aerofeat.llm.keys import KEY, keyed
from aerofeat.llm.repeats import remove_repeats

PASSAGE = " ".join(f"word{i}" for i in range(60))
ROWS = [("b", PASSAGE + " b"), ("a", PASSAGE + " a"), ("c", "something else entirely"), ("10", "x"), ("9", None), (None, PASSAGE), ("c", "another text"), ("c", "another text")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id string, text string").repartition(3)


def test_keys_follow_text_ids(docs):
    got = [r.doc_id for r in keyed(docs).orderBy(KEY).collect()]
    assert got == ["10", "9", "a", "b", "c", "c", None]


def test_text_ids_in_operators_that_compare(spark, docs):
    groups = {(r.doc_id, r.component_id) for r in jaccard_components(docs).collect()}
    assert groups == {("a", "a"), ("b", "a"), (None, "a"), ("c", "c"), ("9", "9"), ("10", "10")}
    cut = {r.doc_id: r.n_removed for r in remove_repeats(docs).filter("doc_id in ('a', 'b', '9')").collect()}
    # all but the last character of the passage stands in "a" first; its last window reaches the blank behind it
    assert cut["a"] == 0 and cut["9"] == 0 and cut["b"] >= len(PASSAGE)
    items = spark.createDataFrame([("i", PASSAGE)], "item_id string, text string")
    bad = {r.doc_id for r in contamination(docs, items).filter("contaminated").collect()}
    assert bad == {"a", "b", None}
