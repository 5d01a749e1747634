"""Each operator against SQL, brute force, a round trip or held-out accuracy, on rows with nulls, ties and repeats."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from kerbside.llm import common, cotraining, lm_scoring, ngram_join, packing, pii, substring_dedup, toxicity
from kerbside.llm import language_model as lm
from kerbside.llm.common import crc32_mod, word_hashes
from kerbside.llm.components import components
from kerbside.llm.decontamination import contamination, decontaminate
from kerbside.llm.oracles import ORACLES
from kerbside.llm.quality_rules import quality_rules
from kerbside.llm.token_output import checksums, read_tokens, write_tokens
from kerbside.llm.tokens import TextEncoder

BYTE_BPE, WORD_BPE = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
# Names that operators use inside; an input may have columns of these names.
CLASHING = ("row_key", "words", "n", "node", "shingle", "start", "spans", "row", "score", "label", "part", "windows", "_key", "_new_names", "_nth")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in CLASHING)


_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return _WORD.findall(text or "")


def lower_words(text):
    return _WORD.findall((text or "").translate(_LOWER))


def test_word_hashes_follow_the_words(rows, monkeypatch):
    texts = [t for _, t in rows] + ["a\x0bb\x0cc", "é\xa0é É", "x" * 9000 + " y", "x" * 9001 + " y"]
    column = pa.array(["skipped", *texts], pa.string()).slice(1)
    for lower, split in ((False, words), (True, lower_words)):
        known = {}
        for size in (1 << 20, 64):
            monkeypatch.setattr(common, "_SLICE", size)
            found = list(word_hashes(column, lower))
            assert len(found) == len(texts)
            for hashes, text in zip(found, texts, strict=True):
                own = split(text)
                assert len(own) == len(hashes)
                assert all(known.setdefault(w, h) == h for w, h in zip(own, hashes.tolist(), strict=True))
        assert len(set(known.values())) == len(known)


def table(spark, rows):
    """Documents with further columns whose names clash."""
    full = [(i, t, "en", "s", len(t or ""), *["x"] * len(CLASHING)) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def rows():
    """Texts with copies, near copies, shared passages and every odd case."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdeghilmnorstuéß") for _ in range(rng.randint(2, 7))) for _ in range(900)] + ["the", "of", "and", "to"] * 40
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    out = [text(rng.randint(3, 160)) for _ in range(50)]
    base, passage = text(140).split(), text(70)
    for _ in range(40):  # near copies, some of them only linked through others
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        out.append(" ".join(copy))
    out += [text(20) + " " + passage + " " + text(rng.randint(5, 30)) for _ in range(25)]
    out += [out[3], out[3].upper(), "", " \n\t ", None, "one", "one two", "ONE two", "a b c", "line one\nline one\n\nline two", "!!! ### ***"]
    out += [" ".join(["same"] * 300), text(9000), passage, "日本語 の テキスト \U0001f600 ñandú"]
    numbered = list(enumerate(out))
    return numbered + [numbered[5], numbered[60], (None, out[2]), (None, None)]


@pytest.fixture(scope="module")
def benchmark_rows(rows):
    texts = [t for _, t in rows]
    item = " ".join(texts[91].split()[20:60])
    return [("b1", item), ("b2", item.upper() + "!"), ("b3", "one two"), ("b4", ""), ("b5", None), (None, "a-b-c"), ("b6", " ".join(texts[7].split()[:13]))]


def same_rows(got, want):
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


def unique(rows):
    """Rows whose ids tell them apart, as SQL that joins by id needs."""
    return [r for i, r in enumerate(rows) if r[0] is not None and r not in rows[:i]]


def duck(rows, items=()):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, 'en')", rows)
    con.execute("CREATE TABLE benchmark (item_id VARCHAR, text VARCHAR)")
    if items:
        con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    return con


def test_quality_rules_equal_sql(spark, rows):
    got = quality_rules(table(spark, unique(rows)))
    want = duck(unique(rows)).execute(ORACLES["op1_quality_rules"]).df()
    same_rows(got.select(*want.columns).collect(), want.itertuples(index=False, name=None))
    assert quality_rules(table(spark, rows)).count() == len(rows)
    assert quality_rules(table(spark, [])).count() == 0


def test_contamination_equals_sql(spark, rows, benchmark_rows):
    items = spark.createDataFrame(benchmark_rows, "item_id string, text string")
    got = contamination(table(spark, unique(rows)), items)
    con = duck(unique(rows), [r for r in benchmark_rows if r[0]])
    want = con.execute(ORACLES["op2_decontamination"]).df()
    named = contamination(table(spark, unique(rows)), items.filter("item_id is not null"))
    same_rows(named.select(*want.columns).collect(), want.itertuples(index=False, name=None))
    assert got.filter("contaminated").count() >= 26
    repeated = contamination(table(spark, rows), items)
    assert repeated.count() == len(rows)
    assert contamination(table(spark, []), items).count() == 0
    assert contamination(table(spark, rows), items.limit(0)).filter("n_hit > 0").count() == 0
    kept = decontaminate(table(spark, rows), items)
    assert kept.columns == table(spark, []).columns
    assert kept.count() == len(rows) - repeated.filter("contaminated").count()


@pytest.mark.parametrize("path", [BYTE_BPE, WORD_BPE])
def test_pieces_give_the_ids_of_whole_texts(path, rows):
    from tokenizers import Tokenizer

    rng, plain, known = random.Random(1), Tokenizer.from_file(path), TextEncoder(path, limit=300)
    signs = list(" \n\t\r.,'\"%&|<>!aAbBsTé0129ñΣ日\U0001f600\x1c\x0b\x85\xa0　́-_")
    texts = [t for _, t in rows if t] + ["".join(rng.choice(signs) for _ in range(rng.randint(1, 50))) for _ in range(3000)]
    texts += ["<|endoftext|> a", "x<|startoftext|>y", "don't we've 'll I'm", "  a  b\n\n c \n", "á b"]
    for text in texts:
        assert np.frombuffer(known(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert known(None) == known("") == b""


def test_token_files_round_trip(spark, rows, tmp_path):
    path = f"file://{tmp_path}/ids"
    write_tokens(table(spark, rows), path, WORD_BPE, end_id=2)
    got = sorted(checksums(read_tokens(spark, path)).collect(), key=lambda r: r["start"])
    encode, start = TextEncoder(WORD_BPE), 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    for row, (i, text) in zip(got, order, strict=True):
        ids = encode(text) + (2).to_bytes(4, "little")
        assert tuple(row) == (i, start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
    plan = read_tokens(spark, path).filter("doc_id = 7")
    assert plan.count() == 1
    assert "EqualTo(doc_id,7)" in plan._jdf.queryExecution().executedPlan().toString()
    write_tokens(table(spark, []), f"{path}-empty", WORD_BPE, end_id=2)
    assert checksums(read_tokens(spark, f"{path}-empty")).count() == 0


def check_packing(pieces, rows, capacity, end):
    encode, by_doc, sequences = TextEncoder(BYTE_BPE), defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"], p["piece"]].append(p)
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for i, text in rows:
        ids, at, piece = encode(text) + end.to_bytes(4, "little"), 0, 0
        while at < len(ids):
            found = [p for p in by_doc[i, piece] if p["start"] * 4 == at and zlib.crc32(ids[at : at + 4 * p["length"]]) == p["ids_crc32"]]
            assert found
            at, piece = at + 4 * found[0]["length"], piece + 1
            assert len(ids) // 4 <= capacity or piece == 1 or found[0]["length"] == capacity
    assert len(pieces) == sum(max(1, -(-len(encode(t) + b"0000") // 4 // capacity)) for _, t in rows)
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing_holds_every_piece(spark, rows):
    pieces = packing.pack(table(spark, rows), BYTE_BPE, end_id=0, capacity=256).collect()
    used = check_packing(pieces, rows, 256, 0)
    counts = np.bincount([p["length"] for p in pieces], minlength=257)
    assert used <= packing.lower_bound(counts, 256) + 1
    assert packing.pack(table(spark, []), BYTE_BPE, end_id=0).count() == 0


def brute_bins(sizes, capacity):
    """Fewest bins, by trying every place of every piece."""
    best = len(sizes)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + sizes[i] <= capacity and bins[b] not in bins[:b]:
                place(i + 1, [*bins[:b], bins[b] + sizes[i], *bins[b + 1 :]])
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best


def test_packing_is_optimal_on_small_inputs():
    rng = random.Random(3)
    for _ in range(60):
        sizes = sorted((rng.randint(1, 30) for _ in range(rng.randint(1, 10))), reverse=True)
        counts = np.bincount(sizes, minlength=31)
        patterns = packing.best_packing(counts, 30)
        assert sum(n for _, n in patterns) == brute_bins(sizes, 30)
        assert Counter(s for f, n in patterns for s in f * n) == Counter(sizes)


def test_packing_of_many_pieces_meets_the_bound():
    rng = np.random.default_rng(5)
    counts = np.bincount(np.minimum(rng.lognormal(5.5, 1, 200_000).astype(int) + 1, 2048), minlength=2049)
    patterns = packing.best_packing(counts, 2048)
    used, placed = sum(n for _, n in patterns), np.zeros(2049, np.int64)
    for lengths, n in patterns:
        assert sum(lengths) <= 2048
        np.add.at(placed, list(lengths), n)
    assert (placed == counts).all()
    assert used <= packing.lower_bound(counts, 2048) * 1.001 + 1


@pytest.mark.parametrize("n", [10, 1000, 1_000_000])
def test_packing_searches_whole_packings_at_every_size(n):
    # 1045 + 512 + 491, 984 + 2 * 532 and 799 + 778 + 471 fill sequences; the first choice, 1045 + 532 + 471, spoils two
    counts = np.zeros(2049, np.int64)
    counts[[1045, 512, 491, 984, 471, 799, 778]] = n
    counts[532] = 2 * n
    patterns = packing.best_packing(counts, 2048)
    assert sum(times for _, times in patterns) == packing.lower_bound(counts, 2048) == 3 * n
    placed = np.zeros(2049, np.int64)
    for lengths, times in patterns:
        assert sum(lengths) <= 2048
        np.add.at(placed, list(lengths), times)
    assert (placed == counts).all()


def shingles(text, size):
    own = lower_words(text)
    return frozenset(zip(*[own[i:] for i in range(size)], strict=False)) if len(own) >= size else frozenset([tuple(own)] if own else [])


def brute_groups(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(doc, len(sets[i]), least.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)]


@pytest.mark.parametrize(("size", "percent", "light"), [(3, 90, 100), (5, 80, 3)])
def test_ngram_groups_equal_brute_force(spark, rows, monkeypatch, size, percent, light):
    monkeypatch.setattr(ngram_join, "LIGHT", light)
    monkeypatch.setattr(ngram_join, "BLOCK", 7)
    got = ngram_join.ngram_groups(table(spark, rows), size, percent).collect()
    same_rows(got, brute_groups(rows, size, percent))


def test_one_of_each_group_stays(spark, rows):
    kept = ngram_join.one_of_each_group(table(spark, rows))
    want = {c for i, _, c in brute_groups(rows, 5, 80) if i is not None}
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == table(spark, []).columns
    assert sorted(i for i in ids if i is not None) == sorted(want)
    assert ngram_join.ngram_groups(table(spark, [])).count() == 0
    assert ngram_join.ngram_groups(table(spark, [(1, None), (2, "")])).count() == 2


def test_prefixes_of_similar_sets_share_enough():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 300, ngram_join.SKETCH).astype(np.int32)
    for _ in range(300):
        n = int(rng.integers(5, 200))
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = a[rng.random(len(a)) > rng.random() * 0.15]
        common = len(b)
        if 100 * common >= 80 * len(a) and common:
            (pa_, la), (pb, lb) = (ngram_join.prefix(x, counts, 100.0, 80) for x in (a, b))
            assert len(np.intersect1d(pa_, pb)) >= min(la, lb)


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(50)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    got = dict(components(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def brute_repeats(rows, size):
    first = {}
    for i, t in rows:
        own = words(t)
        for at in range(len(own) - size + 1):
            window = tuple(own[at : at + size])
            if i is not None:
                first[window] = min(i, first.get(window, i))
    out = []
    for i, t in rows:
        own = words(t)
        gone = [False] * len(own)
        for at in range(len(own) - size + 1):
            if i is not None and first[tuple(own[at : at + size])] < i:
                gone[at : at + size] = [True] * size
        kept = " ".join(w for w, g in zip(own, gone, strict=True) if not g)
        out.append((i, len(own), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize(("shard", "most"), [(150_000, 1000), (400, 4)])
def test_repeats_equal_brute_force(spark, rows, monkeypatch, shard, most):
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", shard)
    monkeypatch.setattr(substring_dedup, "SEGMENTS", most)
    same_rows(substring_dedup.remove_repeats(table(spark, rows)).collect(), brute_repeats(rows, 50))


def test_repeats_of_empty_and_with_text(spark):
    assert substring_dedup.remove_repeats(table(spark, [])).count() == 0
    text = " ".join(f"w{i}" for i in range(60))
    got = substring_dedup.remove_repeats(table(spark, [(1, text), (2, "x " + text + " y")]), with_text=True).collect()
    assert sorted((r["doc_id"], r["kept_text"]) for r in got) == [(1, text), (2, "x y")]


def test_automaton_finds_first_documents():
    rng = random.Random(9)
    for _ in range(40):
        texts = [[rng.randrange(3) for _ in range(rng.randint(1, 25))] for _ in range(6)]
        automaton = substring_dedup.SuffixAutomaton()
        for doc, t in enumerate(texts[:5]):
            automaton.add(t, doc)
        automaton.finish()
        for size in (1, 3, 5):
            windows = [tuple(texts[5][i : i + size]) for i in range(len(texts[5]) - size + 1)]
            holds = lambda t, w: any(tuple(t[i : i + len(w)]) == w for i in range(len(t)))
            want = [min((d for d in range(5) if holds(texts[d], w)), default=2**63 - 1) for w in windows]
            assert automaton.firsts(texts[5], size) == want


def labelled(rows, rng):
    """Half of the texts get a rude word, a sixth are junk."""
    out, marks = [], []
    for i in range(600):
        own = words(rng.choice(rows)[1])[:80] or ["empty"]
        rude, junk = rng.random() < 0.4, rng.random() < 0.2
        if rude:
            own.insert(rng.randrange(len(own) + 1), rng.choice(["blockhead", "blockheads", "nitwitted"]))
        if junk:
            own = [w + "%%%" for w in own]
        out.append((i, " ".join(own)))
        marks.append((i, int(not junk), int(rude)))
    return out, marks


def test_toxicity_on_held_out_rows(spark, rows):
    docs, marks = labelled(rows, random.Random(11))
    labels = spark.createDataFrame([*marks, marks[0], (None, 1, 1), (5, None, None)], "doc_id bigint, quality int, toxic int")
    odd = [(1000, None), (1001, ""), (1002, docs[1][1]), (1002, docs[1][1]), (None, "text")]
    held = crc32_mod("doc_id") == 0
    got = toxicity.toxicity(table(spark, docs + odd), labels, train=~held).withColumn("held_out", held).collect()
    assert len(got) == len(docs) + len(odd)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    truth = {i: t for i, _, t in marks}
    tested = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in tested) >= 0.95 * len(tested)
    kept = toxicity.without_toxic(table(spark, docs + odd), labels)
    assert kept.columns == table(spark, []).columns
    assert kept.filter("text is null").count() == 1
    assert [r["score"] for r in toxicity.toxicity(table(spark, odd), labels.limit(0)).collect()] == [0.0] * len(odd)
    assert toxicity.toxicity(table(spark, []), labels).count() == 0


def test_cotraining_on_held_out_rows(spark, rows):
    docs, marks = labelled(rows, random.Random(13))
    labels = spark.createDataFrame([m for m in marks if m[0] % 3] + [(None, 1, 1), (5, None, None)], "doc_id bigint, quality int, toxic int")
    odd = [(1000, None), (1001, ""), (1002, docs[1][1]), (1002, docs[1][1]), (None, "text")]
    held = crc32_mod("doc_id") == 0
    scored = cotraining.quality_classifier(table(spark, docs + odd), labels, train=~held)
    got = scored.withColumn("held_out", held).collect()
    assert len(got) == len(docs) + len(odd)
    truth = {i: q for i, q, _ in marks}
    tested = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in tested) >= 0.95 * len(tested)
    assert [r["score"] for r in cotraining.quality_classifier(table(spark, odd), labels.limit(0)).collect()] == [0.0] * len(odd)
    assert cotraining.quality_classifier(table(spark, []), labels).count() == 0


def test_cotraining_finds_the_surest_of_all_unlabelled_rows(spark):
    class Sizes:
        def log_odds(self, view, statistics, meta):
            return statistics[:, 0] - 500

    # a hot text in 300 rows with metadata of its own each, and 1000 others; odds -500 to 499
    pool = [(-1, np.r_[1e3, np.zeros(13)].tobytes(), f"s{i}", 10_000 + i) for i in range(300)]
    pool += [(i, np.r_[float(i), np.zeros(13)].tobytes(), "s", i) for i in range(1000)]
    pool = spark.createDataFrame(pool, "text_hash bigint, statistics binary, m0 string, key bigint").repartition(5)
    found = cotraining._surest(pool, ["m0"], Sizes(), 0, {0, 999}, (3, 4), 2.0)
    assert [k for k, label, _, _ in found if label == 0] == [1, 2, 3]
    assert [k for k, label, _, _ in found if label == 1] == [996, 997, 998, 10_000]


def test_cotraining_scores_the_whole_pool(spark, rows, monkeypatch):
    docs, marks = labelled(rows, random.Random(19))
    labels = spark.createDataFrame(marks[:200], "doc_id bigint, quality int, toxic int")
    seen, real = [], cotraining._surest

    def spy(pool, *rest):
        seen.append({r["text_hash"] for r in pool.select("text_hash").collect()})
        return real(pool, *rest)

    monkeypatch.setattr(cotraining, "_surest", spy)
    assert cotraining.quality_classifier(table(spark, docs), labels, pool=40, rounds=1).count() == len(docs)
    want = {r[0] for r in table(spark, docs[200:]).select(F.xxhash64("text")).collect()}
    assert seen == [want] * 2 and len(want) > 40


def test_language_model_gradients():
    rng = np.random.default_rng(1)
    p = {k: v.astype(np.float64) for k, v in lm.initial(np.arange(1.0, 11.0), 3, 4).items()}
    p["class_w"] += rng.standard_normal(p["class_w"].shape)
    p["word_w"] += rng.standard_normal(p["word_w"].shape)
    ids, targets = rng.integers(0, 10, (5, 2)), rng.integers(0, 10, (5, 2))
    fresh, state = np.zeros((5, 2)), np.zeros((2, 3))
    fresh[2, 1] = 1

    def loss():
        h, _, _ = lm.states(p, ids, fresh, state)
        return -lm.log_probabilities(p, h.reshape(10, 3).astype(np.float64), targets.reshape(10)).mean()

    g, _ = lm.gradients(p, ids, targets, fresh, state)
    for name in p:
        flat = p[name].reshape(-1)
        for at in rng.choice(flat.size, min(6, flat.size), replace=False):
            if abs(flat[at]) > 100:
                continue
            was = flat[at]
            flat[at] = was + 1e-3
            up = loss()
            flat[at] = was - 1e-3
            down = loss()
            flat[at] = was
            assert abs((up - down) / 2e-3 - g[name].reshape(-1)[at]) < 2e-3


def test_language_model_is_a_distribution_and_carries_state():
    p = lm.initial(np.arange(1.0, 12.0), 4, 4)
    rng = np.random.default_rng(2)
    p["class_w"] += rng.standard_normal(p["class_w"].shape).astype(np.float32)
    p["word_w"] += rng.standard_normal(p["word_w"].shape).astype(np.float32)
    h = np.repeat(rng.standard_normal((1, 4)).astype(np.float32), 11, axis=0)
    assert abs(np.exp(lm.log_probabilities(p, h, np.arange(11))).sum() - 1) < 1e-4
    texts = [rng.integers(0, 11, n) for n in (1, 700, 3, 64, 65, 130, 2, 2, 9)]
    whole = lm.score(p, texts, 0)
    for lanes, steps in ((1, 5), (2, 7), (3, 1000)):
        assert np.allclose(lm.score(p, texts, 0, lanes, steps), whole, atol=1e-2)
    assert len(lm.score(p, [], 0)) == 0


def test_lm_scores(spark, rows):
    train = crc32_mod("doc_id") != 1
    got = lm_scoring.lm_scores(table(spark, rows), train, vocabulary=200, dictionary=300, share=1, rounds=1).collect()
    counts = Counter()
    for i, t in rows:
        if zlib.crc32(str("" if i is None else i).encode()) % 5 != 1:
            counts.update([*lower_words(t), "\n"])
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for i, t in rows:
        own = [*lower_words(t), "\n"]
        base = sum(np.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own)
        want.append((i, len(own), sum(counts[w] > 0 for w in own), total, round(float(base), 4)))
    same_rows([(*r[:4], round(r["base_score"], 4)) for r in got], want)
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)
    none = lm_scoring.lm_scores(table(spark, rows[:3]), F.lit(False)).collect()
    assert all(r["score"] == r["base_score"] and r["train_tokens"] == 0 for r in none)
    assert lm_scoring.lm_scores(table(spark, [])).count() == 0


def test_language_model_learns_from_every_training_row(spark, rows, monkeypatch):
    seen, train = Counter(), crc32_mod("doc_id") != 1

    def spy(encoded, words, p):
        seen.update((r["doc_id"], tuple(r["ids"])) for r in encoded.collect())
        spied.append(words)
        return p

    spied = []
    monkeypatch.setattr(lm_scoring, "_train_round", spy)
    lm_scoring.lm_scores(table(spark, rows), train)
    encode = lambda t: tuple(spied[0].encode([w.encode() for w in lower_words(t)]))
    assert len(spied) == 8
    assert seen == Counter((i, encode(t)) for i, t in rows if zlib.crc32(str("" if i is None else i).encode()) % 5 != 1)


@pytest.mark.parametrize("sizes", [[1], [31, 2], [700, 1, 64], [2111], [5000, 3, 90]])
def test_language_model_learns_from_every_token(monkeypatch, sizes):
    learnt, plain = [], lm.gradients
    rng = np.random.default_rng(5)
    texts = [np.append(rng.integers(1, 9, n - 1), 0) for n in sizes]

    def spy(p, ids, targets, fresh, state):
        assert ids.shape == targets.shape == fresh.shape and ids.shape[1] == len(state)
        learnt.extend(zip(ids.ravel().tolist(), targets.ravel().tolist(), fresh.ravel().tolist(), strict=True))
        return plain(p, ids, targets, fresh, state)

    monkeypatch.setattr(lm, "gradients", spy)
    trainer = lm.Trainer(lm.initial(np.arange(1.0, 10.0), 3, 3))
    trainer.learn(texts, 0)
    pairs = [(b, w, float(i == 0)) for t in texts for i, (b, w) in enumerate(zip([0, *t[:-1].tolist()], t.tolist(), strict=True))]
    assert Counter(learnt) == Counter(pairs) and trainer.tokens == sum(sizes)


def plain_score(p, ids):
    """The model's definition, one token at a time."""
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    softmax = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    p = {k: v.astype(np.float64) for k, v in p.items()}
    n, per_class = p["u"].shape[0], p["word_b"].shape[1]
    h, before, total = np.zeros(n), 0, 0.0
    for token in ids:
        x, a = p["embed"][before] @ p["w"] + p["b"], h @ p["u"]
        z, r = sigmoid(x[:n] + a[:n]), sigmoid(x[n : 2 * n] + a[n : 2 * n])
        h = z * h + (1 - z) * np.tanh(x[2 * n :] + r * a[2 * n :])
        c, w = divmod(int(token), per_class)
        total += np.log(softmax(h @ p["class_w"] + p["class_b"])[c]) + np.log(softmax(h @ p["word_w"][c] + p["word_b"][c])[w])
        before = token
    return total


def test_scores_of_held_out_texts_equal_a_plain_loop_and_beat_the_untrained_model():
    rng = np.random.default_rng(6)
    step = np.array([3, 7, 1, 5, 2, 8, 4, 9, 6, 10, 0])  # each word is mostly followed by one other

    def text(n):
        out = [int(rng.integers(1, 11))]
        while len(out) < n:
            out.append(int(step[out[-1]]) if rng.random() < 0.9 else int(rng.integers(1, 11)))
        return np.array([*out, 0])

    start = lm.initial(np.ones(11), 8, 4)
    trainer = lm.Trainer(start)
    for _ in range(40):
        trainer.learn([text(int(n)) for n in rng.integers(5, 300, 60)], 0)
    held_out = [text(int(n)) for n in (1, 2, 40, 63, 64, 65, 400)]
    got = lm.score(trainer.p, held_out, 0, lanes=3)
    assert np.allclose(got, [plain_score(trainer.p, t) for t in held_out], rtol=1e-4, atol=1e-3)
    assert got.sum() > lm.score(start, held_out, 0).sum() * 0.8


def test_a_very_long_text_is_scored_in_windows():
    rng = np.random.default_rng(7)
    p = lm.initial(np.arange(1.0, 12.0), 4, 4)
    texts = [rng.integers(0, 11, n) for n in (300_000, *rng.integers(1, 60, 300))]
    tracemalloc.start()
    got = lm.score(p, texts, 0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20  # a matrix of the longest text by 128 lanes takes 300 MB
    assert np.allclose(got[1:], lm.score(p, texts[1:], 0), atol=1e-2)
    assert np.isclose(got[0], lm.score(p, texts[:1], 0)[0], rtol=1e-4)


def test_surrogates_are_permutations():
    s = pii.Surrogates(b"key")
    assert sorted(s.permute("d", i, 997) for i in range(997)) == list(range(997))
    assert len({s.shaped("d", f"{i:03d}") for i in range(1000)}) == 1000
    cards = [s.of("card", f"4000 0000 0000 {i:04d}") for i in range(300)]
    assert len(set(cards)) == 300
    assert [pii.luhn(c.replace(" ", "")) for c in cards] == [pii.luhn(f"400000000000{i:04d}") for i in range(300)]
    iban = s.of("iban", "DE89 3704 0044 0532 0130 00")
    moved = iban.replace(" ", "")[4:] + iban[:4]
    assert int("".join(str(int(c, 36)) for c in moved)) % 97 == 1
    assert re.fullmatch(r"DE\d\d( \d{4}){4} \d\d", iban)
    assert s.of("email", "Ann.Lee@Mail.example.com").lower() == s.of("email", "ann.lee@mail.example.com")
    assert pii.Surrogates(b"other").of("phone", "+1 (743) 555-3824") != s.of("phone", "+1 (743) 555-3824")


def test_anonymise(spark):
    text = "Mr. John Smith (john@mail.example.com, +1 (743) 555-3824) met Mrs Mary Smith. Smith left 8.8.4.4."
    rows = [(1, text), (2, "Mr. Adam Jones wrote to john@mail.example.com; господин Иван Петров not"), (3, None), (4, ""), (5, "clean text"), (1, text), (None, text)]
    rows += [(10 + i, f"Mr. {a}{b} Adler{a}{b}") for i, (a, b) in enumerate((a, b) for a in "ABCDEFGH" for b in "aeiou")]
    given = table(spark, rows)
    out = pii.anonymise(given, b"key", counts_col="entities")
    assert out.columns == [*given.columns, "entities"]
    new = defaultdict(list)
    for r in out.collect():
        new[r["doc_id"]].append(r["text"])
    assert new[3] == [None] and new[4] == [""] and new[5] == ["clean text"]
    assert new[1][0] == new[1][1] == new[None][0]
    for gone in ("John", "Smith", "john@mail", "555-3824", "8.8.4.4"):
        assert gone not in new[1][0]
    shape = re.fullmatch(r"Mr\. (\w+) (\w+) \(([\w.]+@[\w.]+\.com), \+1 \(\d{3}\) \d{3}-\d{4}\) met Mrs (\w+) (\w+)\. (\w+) left [\d.]+\.", new[1][0])
    assert shape and shape[2] == shape[5] == shape[6]
    # The list of male names is shorter than the names to replace: some are made of syllables, with a male ending.
    assert shape[1] in pii.NAMES["latin"]["m"].split() or shape[1].endswith("n")
    assert shape[4] in pii.NAMES["latin"]["f"].split()
    assert shape[3] in new[2][0]
    russian = re.search(r"господин (\w+) (\w+) not", new[2][0])
    assert russian and pii.script_of(russian[1]) == pii.script_of(russian[2]) == "cyrillic" and russian[1] != "Иван"
    names = [new[i][0].split()[1:] for i in range(10, 50)]
    assert len({n[0] for n in names}) == len({n[1] for n in names}) == 40
    assert not {n for pair in names for n in pair} & {n for _, t in rows[7:] for n in t.split()[1:]}
    assert pii.anonymise(table(spark, []), b"key").count() == 0
