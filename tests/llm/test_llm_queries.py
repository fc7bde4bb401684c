"""The registered corpus queries: SQL, held-out accuracy, and the pipeline's stages."""

import zlib

import pytest
from conftest import DATA

import __spark_entry__ as contract
import corpus_pipeline
from oracle_check import compare, duck
from studymart.llm import queries


@pytest.fixture(scope="module")
def connection():
    return duck(DATA)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, connection, name):
    ours, theirs = compare(spark, connection, DATA, name)
    assert ours == theirs


def test_every_operator_is_registered():
    numbers = {n.split("_")[0] for n in contract.queries() if n.startswith("op")}
    assert numbers == {f"op{n}" for n in range(1, 14)} and "pipeline" in contract.queries()


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.op9_toxicity(spark, folder).collect()}
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    labels = queries.table(spark, folder, "labels").collect()
    said = {t: [rows[x.doc_id].score for x in labels if x.toxic == t and rows[x.doc_id].held_out] for t in (0, 1)}
    higher = sum((a > b) + 0.5 * (a == b) for a in said[1] for b in said[0])
    assert higher / (len(said[0]) * len(said[1])) > 0.7


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, before, ids = docs.columns, docs.count(), None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, DATA).collect(), docs.schema)
        assert docs.columns == columns, name
        assert docs.count() <= before
        before = docs.count()
        texts = [r.text for r in docs.collect()]
        if name == "near_duplicates":
            assert len({t.lower() for t in texts}) == len(texts)
        if name == "repeats":
            windows = [t.encode()[i : i + 100] for t in texts for i in range(len(t.encode()) - 99)]
            assert len(windows) - len(set(windows)) < 0.01 * len(windows)  # cuts join texts anew
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        ids = {r.doc_id for r in docs.collect()}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, DATA).collect()
    assert {r.doc_id for r in pieces} == ids
    full = {}
    for r in pieces:
        full[r.doc_id] = full.get(r.doc_id, 0) + r.length
    assert all(full[r.doc_id] == r.doc_tokens for r in pieces)
