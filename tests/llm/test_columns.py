"""Extra columns of any name through the pipeline's operators, and hard rows and empty tables through its stages."""

import pytest

import corpus_pipeline as cp
from regioncast.llm import decontaminate, line_dedup, simhash, toxicity
from tests.llm.helpers import DOC_SCHEMA, HARD, SF, sf_rows

NAMES = ["__id", "__key", "__none", "__copy", "__text", "__own", "__drops", "__bad", "row", "id", "no_id", "key", "own", "drops", "a.b", "a`b",
         "text_key", "fp", "component_id", "first_key", "place", "good", "Score", "N_HIT", "spans", "items", " blank "]


def extended(spark, rows, names=NAMES):
    docs = spark.createDataFrame([(d, t, None, "s", len(t or "")) for d, t in rows], DOC_SCHEMA)
    for i, name in enumerate(names):
        docs = docs.withColumn(name, docs.doc_id * 1000 + i)
    return docs


def same_values(got, names=NAMES):
    assert set(names) <= set(got.columns)
    rows = got.collect()
    for r in rows:
        for i, name in enumerate(names):
            assert r[name] == (None if r["doc_id"] is None else r["doc_id"] * 1000 + i)
    return rows


ROWS = HARD + [(60 + i, "some shared words of a copy that stands here more than once " * 4) for i in range(3)]


def test_extra_columns_stay(spark):
    docs = extended(spark, ROWS)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    bench = spark.createDataFrame(sf_rows("benchmark", "item_id, text"), "item_id long, text string")
    assert len(same_values(toxicity.without_toxic(docs, labels))) == len(ROWS)
    assert len(same_values(decontaminate.clean_documents(docs, bench))) == len(ROWS)
    kept = same_values(simhash.first_of_each_group(docs))
    assert sum(r["doc_id"] in (60, 61, 62) for r in kept) == 1
    assert len(same_values(line_dedup.without_repeated_chunks(docs))) == len(ROWS)


def test_columns_of_added_names_are_replaced(spark):
    docs = extended(spark, ROWS, ["N_LINES", "n_Removed", "other"])
    got = line_dedup.without_repeated_chunks(docs)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "other", "n_lines", "n_removed"]
    assert {r["doc_id"]: r["n_lines"] for r in got.collect()}[11] == len(HARD[-1][1].split("\n"))


def test_order_of_columns_and_types_stay(spark):
    docs = extended(spark, ROWS, ["a.b"]).select("`a.b`", "text", "n_chars", "doc_id", "source", "lang")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    for got in (toxicity.without_toxic(docs, labels), decontaminate.clean_documents(docs, bench), simhash.first_of_each_group(docs)):
        assert got.dtypes == docs.dtypes
    assert line_dedup.without_repeated_chunks(docs).dtypes[:6] == docs.dtypes


@pytest.mark.parametrize("rows", [[], HARD + [(None, None), (None, None), (5, None)]], ids=["no rows", "hard rows"])
def test_stages_take_hard_rows_and_empty_tables(spark, rows):
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOC_SCHEMA)
    for name, stage in cp.STAGES:
        got = stage(spark, docs, SF)
        out = got.collect()
        if name != "packing":
            assert got.columns == docs.columns
            assert len(out) <= len(rows) and {r.doc_id for r in out} <= {d for d, _ in rows}
            if name in ("toxicity", "line_dedup", "decontamination"):
                assert len(out) == len(rows)
        else:
            assert sum(r.piece == 0 for r in out) == len(rows)
