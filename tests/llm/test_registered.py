"""Registered queries: the SQL they have, and the pipeline against its parts."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tallyflow.llm import decontaminate, minhash, piece_bpe, toxicity
from tallyflow.llm.frames import table
from tallyflow.llm.queries import ORACLES, QUERIES
from tests.compare import differences, duck

SF_DIR = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck(SF_DIR), ORACLES[name]) is None


@pytest.mark.parametrize("name", ["op5_pii", "op9_licenses", "op10_decontaminate"])
def test_native_plans(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_stages_keep_clean_documents(spark):
    docs = table(spark, SF_DIR, "documents")
    names, all_ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    model = toxicity.train(docs, table(spark, SF_DIR, "labels"))
    steps = [
        lambda d: ids(toxicity.score(d, model).where("predicted = 1")),
        lambda d: ids(minhash.near_duplicates(d).where("not kept")),
        lambda d: ids(decontaminate.contaminated(d, table(spark, SF_DIR, "benchmark"))),
        lambda d: set(),
    ]
    left = set(all_ids)
    for (_, stage), gone in zip(corpus_pipeline.STAGES[:-1], steps):
        after = stage(spark, docs, SF_DIR)
        left -= gone(docs)
        assert after.columns == names and ids(after) == left
        docs = after
    want = sorted(map(tuple, piece_bpe.digests(docs, corpus_pipeline.public_tokenizers.path("piece_bpe_32k.model")).collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect())) == want and len(want) == len(left)
