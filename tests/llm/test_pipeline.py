"""The pipeline's stages: each takes effect on all rows its predecessor kept."""

import corpus_pipeline
import pytest
from test_llm_operators import BYTE_BPE, brute_groups, check_packing

from kerbside.llm.decontamination import contamination
from kerbside.llm.pii import Surrogates, replace_entities
from kerbside.llm.queries import SURROGATE_KEY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder, docs = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"file://{folder}/{name}")
        docs = spark.read.parquet(f"file://{folder}/{name}")
        out.append((name, docs))
    return out


def texts(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_stages_follow_each_other(spark, stages):
    names, tables = zip(*stages, strict=True)
    assert names == ("documents", "toxicity", "ngram_join", "decontamination", "pii", "packing")
    documents, clean, single, honest, private, packed = tables
    assert all(t.columns == documents.columns for t in tables[1:-1])
    assert set(texts(clean)) < set(texts(documents))
    groups = {c for _, _, c in brute_groups(texts(clean), 5, 80)}
    assert texts(single) == [r for r in texts(clean) if r[0] in groups]
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    gone = {r["doc_id"] for r in contamination(single, benchmark).filter("contaminated").collect()}
    assert gone and texts(honest) == [r for r in texts(single) if r[0] not in gone]
    surrogates = Surrogates(SURROGATE_KEY)
    assert texts(private) == [(i, replace_entities(t, surrogates, {})[0]) for i, t in texts(honest)]
    check_packing(packed.collect(), texts(private), 2048, 0)


def test_run_is_the_stages_in_turn(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    same = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(got.select(*same).collect()) == sorted(stages[-1][1].select(*same).collect())
