"""Near duplicates where an id comes with different texts."""

import corpus_pipeline as P
from ledgerline.llm import simhash

X = "the first of the texts tells of rivers and of hills and of a road between them"
Y = "quite another story about a ship with nine sails that never came home from sea"


def test_the_unique_text_stays(spark):
    """Of (3, X), (5, X), (5, Y) the duplicate X goes, in whatever order they come."""
    for rows in ([(3, X), (5, X), (5, Y)], [(5, Y), (5, X), (3, X)]):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
        assert sorted(simhash.one_of_each(docs).collect()) == [(3, X), (5, Y)]
        assert sorted(P.near_duplicates(spark, docs, "").collect()) == [(3, X), (5, Y)]


def test_texts_of_one_id(spark):
    """The stage keeps every text of an id that is no near duplicate, once, and the least row."""
    rows = [(5, X, 2), (5, Y, 1), (5, X, 1), (7, Y, 0), (None, X, 0), (None, "a third one", 4), (None, "a third one", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n int").repartition(3)
    got = sorted(P.near_duplicates(spark, docs, "").collect(), key=str)
    assert got == sorted([(5, X, 1), (5, Y, 1), (None, "a third one", 3)], key=str)
    assert len({r.component_id for r in simhash.components(docs).collect() if r.doc_id}) == 1
