import re

import pytest

import corpus_pipeline
from loomcast.llm.common import keep
from loomcast.llm.registry import QUERIES
from tests.llm.test_exact_dedup import brute as exact
from tests.llm.test_near_dedup import brute as near
from tests.llm.test_packing import check as packed
from tests.llm.test_pii import brute as personal

FOLDER = "/root/testdata/sf0.001"


COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """{stage: (texts before, texts after)}; the last one's rows are its pieces."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = keep(stage(spark, docs, FOLDER), name)
        if name == "packing":
            out[name] = before, docs.collect()
            break
        assert docs.columns == COLUMNS and docs.where("n_chars <> length(text)").count() == 0
        out[name] = before, {r.doc_id: r.text for r in docs.collect()}
    assert list(out) == ["toxicity", "exact_dedup", "near_dedup", "pii", "packing"]
    return out


def test_toxic_documents_go(spark, steps):
    before, after = steps["toxicity"]
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    gone = before.keys() - after.keys()
    assert gone and all(after[k] == before[k] for k in after)
    clean = [k for k in before if toxic.get(k) == 0]
    assert sum(k in gone for k in clean) <= 0.05 * len(clean)
    # the query and the stage decide alike
    rejected = {r.doc_id for r in QUERIES["op4_toxicity"](spark, FOLDER).where("toxic").collect()}
    assert gone == rejected


def test_copies_go(steps):
    before, after = steps["exact_dedup"]
    assert sorted(after) == [x[0] for x in exact(sorted(before.items())) if x[3]]


def test_near_copies_go(steps):
    before, after = steps["near_dedup"]
    assert sorted(after) == [x[0] for x in near(sorted(before.items())) if x[3]]


def test_personal_data_is_hidden(steps):
    before, after = steps["pii"]
    assert after.keys() == before.keys()
    for k, text in after.items():
        assert personal(text) == "" and (text == before[k] or re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", text))


def test_all_is_packed(steps):
    before, pieces = steps["packing"]
    packed(sorted(before.items()), pieces)


def test_empty_input(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = keep(stage(spark, docs, FOLDER), name)
    assert docs.count() == 0
