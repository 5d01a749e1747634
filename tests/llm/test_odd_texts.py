"""Cases that once broke: short pieces only, very long unbroken texts, rows without ids, unlike texts of one id."""

import random
import re
import time
from pathlib import Path

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_llm_operators import BYTE_BPE, WORD_BPE, brute_groups, same_rows, table
from tokenizers import Tokenizer

from kerbside.llm import common, ngram_join, packing, toxicity
from kerbside.llm.common import BATCH_BYTES, give_back, sliced, small_batches
from kerbside.llm.ngram_join import ngram_groups, one_of_each_group
from kerbside.llm.packing import best_packing, lower_bound, pack
from kerbside.llm.pii import Surrogates, replace_entities
from kerbside.llm.tokens import TextEncoder, encoder
from kerbside.operators import bloom
from kerbside.operators.bloom import rows_maybe_held


@pytest.mark.parametrize("lengths", [{3: 1, 2: 5000}, {5: 1, 2: 3000}, {7: 3, 2: 4000}, {1: 100_000, 2: 50_000, 3: 7}, {1: 3}, {2: 1, 1: 2047}])
def test_packing_of_short_pieces(lengths):
    counts = np.zeros(2049, np.int64)
    for n, times in lengths.items():
        counts[n] = times
    patterns = best_packing(counts, 2048)
    held = np.zeros(2049, np.int64)
    for filling, times in patterns:
        assert sum(filling) <= 2048
        np.add.at(held, list(filling), times)
    assert (held == counts).all()
    assert sum(n for _, n in patterns) == lower_bound(counts, 2048)


UNBROKEN = ["a1" * 500_000, "a1" * 20_000 + "@x.com", "token: " + "a1B" * 200_000, "x@" + "a." * 300_000, "password=" + "z" * 300, "一" * 300_000]


@pytest.mark.parametrize("text", UNBROKEN)
def test_surrogates_of_unbroken_texts_take_seconds(text):
    begun = time.time()
    out, counts = replace_entities(text, Surrogates(b"key"), {})
    assert len(out) == len(text) and time.time() - begun < 10
    assert (out != text) == bool(counts)


def test_long_surrogates_stay_distinct_and_equal():
    surrogates, long = Surrogates(b"key"), "ab12" * 40
    texts = [long, long[:-1] + "3", "zb12" + long[4:], long[:63] + "9" + long[64:], long * 2]
    new = [surrogates.shaped("secret", t) for t in texts]
    assert len(set(new)) == len(texts) and [len(t) for t in new] == [len(t) for t in texts]
    assert new == [surrogates.shaped("secret", t) for t in texts]


def test_rows_without_ids_are_linked(spark):
    words = [f"w{i}" for i in range(60)]
    a, b, c = " ".join(words), " ".join(words[:-1] + ["x"]), " ".join(words[:-2] + ["x", "y"])
    rows = [(1, a), (None, b), (5, c), (None, "something else"), (None, "something else"), (7, "one thing here"), (7, "another matter there"), (9, "one thing here"), (8, None), (8, None), (None, "")]
    for size, percent in ((5, 80), (3, 90)):
        same_rows(ngram_groups(table(spark, rows), size, percent).collect(), brute_groups(rows, size, percent))
    kept = sorted(((r["doc_id"], r["text"]) for r in one_of_each_group(table(spark, rows)).collect()), key=str)
    want = [(1, a), (None, "something else"), (7, "one thing here"), (7, "another matter there"), (8, None), (None, "")]
    assert kept == sorted(want, key=str)


def test_batches_are_cut_by_bytes():
    texts = ["x" * 10] * 50 + ["y" * 5000] + ["z"] * 20 + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(len(texts)))], ["text", "n"])
    parts = list(sliced(iter([batch, batch.slice(0, 0)]), 200))
    assert pa.Table.from_batches(parts).column("n").to_pylist() == list(range(len(texts)))
    assert all(p.num_rows <= 1 or p.nbytes <= 500 for p in parts)


def test_the_sample_is_bounded_by_rows(spark):
    docs = spark.range(3000).selectExpr("id % 3 doc_id", "concat('text ', id % 7) text")
    labels = spark.createDataFrame([(0, 0), (1, 1), (2, 1)], "doc_id bigint, label int")
    seen = []
    original = toxicity.materialise
    toxicity.materialise = lambda df, name: seen.append((name, out := original(df, name))) or out
    try:
        toxicity.fit(docs, labels, sample=2)
    finally:
        toxicity.materialise = original
    assert dict(seen)["toxicity-texts"].count() == 3


def test_stages_take_odd_rows(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([("b", "one two three"), (None, None)], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (3, 1, 0), (4, 1, 0), (2, 0, 1), (None, None, None)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    rows = [(1, "a b c"), (1, "a b c"), (1, "unlike it"), (None, None), (2, ""), (3, "a1" * 300_000), (4, "w " * 200_000), (5, "x@" + "a." * 50_000)]
    docs = table(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), folder)
        assert empty.count() == 0
        after = stage(spark, docs, folder)
        after.write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        if name != "packing":
            assert after.columns == docs.columns == empty.columns
            docs = after
    assert {r["doc_id"] for r in docs.collect()} == {1, None, 2, 3, 4, 5}
    assert docs.count() == 7
    assert pack(docs, BYTE_BPE).filter("length < 1 or length > 2048").count() == 0


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_columns_give_the_ids_of_single_texts(path):
    rng, plain, known = random.Random(2), Tokenizer.from_file(path), TextEncoder(path, limit=60)
    signs = list("  \n\t\r.,'\"%&|<>!aAbBsTé0129ñΣ日\U0001f600\x1c\x0b\x85\xa0　́-_")
    texts = ["".join(rng.choice(signs[: rng.choice([16, 24, 99])]) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += [None, "", " ", "<|endoftext|> a b", "a b", "x<|startoftext|>y", "don't we've", "  a  b\n\n c \n", "Big, big words. ", None]
    for column in (pa.array(texts), pa.array(["x", *texts, "y"]).slice(1, len(texts)), pa.array([None, ""], pa.string()), pa.array([], pa.string())):
        values, bounds = known.column(column, 9)
        for i, text in enumerate(column.to_pylist()):
            assert values[bounds[i] : bounds[i + 1]].tolist() == [*plain.encode(text or "", add_special_tokens=False).ids, 9]
        assert len(bounds) == len(column) + 1 and bounds[-1] == len(values)


def test_a_stretch_met_often_is_looked_up_once():
    known, seen = TextEncoder(BYTE_BPE), []
    learnt = known._learnt
    known._learnt = lambda stretches: seen.extend(stretches) or learnt(stretches)
    values, _ = known.column(pa.array(["one two, one two,\n one"] * 500), 0)
    assert len(values) == 500 * len(known.column(pa.array(["one two, one two,\n one"]), 0)[0])
    assert len(seen) <= 8 + 8


def test_sets_of_many_heavy_shingles_are_placed_once(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LIGHT", 3)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    # 96 sets with 30 shingles in common, 64 of them of one component already; all shingles have the same least set.
    rows = [(s, 0, k, 40, -1 if k < 64 else k) for s in range(30) for k in range(96)]
    postings = spark.createDataFrame(rows, "shingle bigint, head bigint, node bigint, n bigint, component bigint")
    placed = ngram_join._placed(ngram_join._families(postings)).collect()
    assert len(placed) == 96  # one text read for each, where block against block of each shingle read 30 * 96 * 12
    assert {(r["others"], r["blocks"]) for r in placed} == {(4, 12)}
    assert {r["block"] < 4 for r in placed if r["component"] != -1} == {True}
    # Shingles that share nothing but their least set stay apart.
    rows = [(s, 0, k and 1000 * s + k, 40, 1000 * s + k) for s in range(30) for k in range(20)]
    postings = spark.createDataFrame(rows, "shingle bigint, head bigint, node bigint, n bigint, component bigint")
    assert ngram_join._families(postings).select("family").distinct().count() == 30


def test_near_copies_of_one_text_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LIGHT", 3)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    rng = random.Random(5)
    base, rows = [f"w{i}" for i in range(60)], []
    for i in range(120):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(60)] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(words)))
    same_rows(ngram_groups(table(spark, rows), 5, 80).collect(), brute_groups(rows, 5, 80))


def test_only_texts_of_candidates_leave_their_scan(spark, monkeypatch):
    left, written = [], []

    def counted(df, column, keys, key):
        kept = rows_maybe_held(df, column, keys, key)
        left.append(kept.count())
        return kept

    def watched(df, label, write=ngram_join.materialise):
        written.extend(c for c in df.columns if c == "text")
        return write(df, label)

    monkeypatch.setattr(ngram_join, "rows_maybe_held", counted)
    monkeypatch.setattr(ngram_join, "materialise", watched)
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randrange(100_000)}" for _ in range(30))) for i in range(1000)]
    rows += [(1000 + i, rows[i][1] + " more") for i in range(10)]
    same_rows(ngram_groups(table(spark, rows), 3, 90).collect(), brute_groups(rows, 3, 90))
    assert 20 <= sum(left) <= 100
    assert not written  # texts are neither written nor shuffled before a pair asks for them


def test_a_bounded_filter_keeps_every_key(spark, monkeypatch):
    rows = spark.range(20_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    keys = spark.range(0, 20_000, 10).selectExpr("CASE WHEN id > 0 THEN id END AS key")
    for most in (512, 1):
        monkeypatch.setattr(bloom, "MOST_ROWS", most)
        kept = rows_maybe_held(rows, "k", keys, "key")
        assert kept.columns == rows.columns
        held = [r["k"] for r in kept.collect()]
        assert len(held) == len(set(held))
        assert set(held) >= set(range(10, 20_000, 10))
        assert len(held) < 2400
    assert rows_maybe_held(rows, "k", keys.limit(0), "key").count() == 0


def test_packing_reads_texts_in_small_batches(spark, monkeypatch):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    texts = spark.range(0, 64, 1, 1).selectExpr("id AS doc_id", "repeat(cast(id AS string), 500000) AS text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    before = spark.conf.get(key, None)
    with small_batches(spark):
        assert texts.mapInArrow(sizes, "size bigint").selectExpr("max(size)").first()[0] < 6 << 20
    assert spark.conf.get(key, None) == before
    seen = {}

    def watched(df, label, write=packing.materialise):
        seen[label] = spark.conf.get(key, None)
        return write(df, label)

    monkeypatch.setattr(packing, "materialise", watched)
    pack(table(spark, [(1, "a b")]), BYTE_BPE).collect()
    assert int(seen["pieces"]) == 4 << 20
    assert seen["piece-counts"] == before
    assert encoder(BYTE_BPE, 50)._limit == 50
    assert encoder(BYTE_BPE)._limit == 800_000


def test_freed_memory_is_given_back_after_a_task(monkeypatch):
    def megabytes():
        return int(re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024

    held = [np.ones(8000) for _ in range(3000)]  # 64 kB each
    last = held.pop()  # keeps the end of the heap
    del held
    before = megabytes()
    give_back()
    assert megabytes() < before - 100 and len(last) == 8000
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 100, "y" * 5000, "z"])], ["text"])
    assert sum(part.num_rows for part in sliced(iter([batch, batch]), 50)) == 6
    assert calls == [1]


def test_every_stage_of_the_pipeline_takes_small_batches(spark, tmp_path, monkeypatch):
    folder, before, seen = str(tmp_path), spark.conf.get(BATCH_BYTES, None), []
    docs = table(spark, [(1, "a b c")])
    for name in ("benchmark", "labels", "documents"):
        docs.write.parquet(f"{folder}/{name}.parquet")
    for name in ("without_toxic", "one_of_each_group", "decontaminate", "anonymise", "pack"):
        monkeypatch.setattr(corpus_pipeline, name, lambda df, *_, **__: seen.append(spark.conf.get(BATCH_BYTES)) or df.select("doc_id", "text"))
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.set(BATCH_BYTES, str(64 << 20))
            stage(spark, docs, folder)
            assert int(spark.conf.get(BATCH_BYTES)) == 4 << 20  # what it returns runs later
        spark.conf.set(BATCH_BYTES, str(64 << 20))
        assert corpus_pipeline.run(spark, folder).count() == 1
        assert int(spark.conf.get(BATCH_BYTES)) == 64 << 20
    finally:
        if before is None:
            spark.conf.unset(BATCH_BYTES)
        else:
            spark.conf.set(BATCH_BYTES, before)
    assert [int(x) for x in seen] == 10 * [4 << 20]
