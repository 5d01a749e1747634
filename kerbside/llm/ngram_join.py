"""N-gram Jaccard join with adaptive multi-match prefixes, and the groups its links form.

Every text is a set of hashed word shingles; equal sets are one node. Shingles are ordered by rarity, estimated by a sketch
of fixed size over all texts. A partner must share ``o`` = ceil(percent * n / 100) of a set's n shingles, so the first
n - o + l of both sets have l in common (the lesser l of the two). Each set takes the l of least estimated cost: a longer
prefix has more postings, but asks for more matches before a pair is verified. Verification is exact on whole sets.

Links are looked for in two rounds, so that a large group costs as many checks as it has members, not pairs:

* first each prefix shingle links the sets that hold it to the least of them, and the found links are joined to components;
* then only shingles whose sets are still in several components are left. Pairs across components with enough matches
  are verified. Shingles of more than ``LIGHT`` sets are instead taken together where they share their least set: their
  sets are packed into blocks, each set once, and block against block is compared by the matrix product of the sets, which
  emits one edge for each component that its links join, never all pairs. A text is read once for that, a group of n sets
  is (n / BLOCK) ** 2 pairs of blocks, and the largest component is compared with all others only, not with itself.

No link between different components can be missed, so the components are exact; no cap is set on partners.

Defined results: null or empty texts have no set and form groups of their own; a text of fewer words than a shingle is one
shingle; each row is returned, rows of one id by their own texts; a null id is never a group's name unless its group has no
other; very long texts are compared whole; other columns are never read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import documents, shingle_set, sliced, summed_vector, vector_rows, with_row_key, word_hashes
from kerbside.llm.components import components
from kerbside.operators.bloom import rows_maybe_held
from kerbside.session import materialise

SKETCH = 1 << 20
LIGHT = 100  # sets of a shingle whose pairs are listed; more are compared in blocks
BLOCK = 256  # sets of a block, and partners that one group of checks holds
MOST_MATCHES = 8
CHANCE = 0.25  # sets that share a shingle by chance, beyond what the sketch can tell


def _node(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(44)).astype(np.int64)


def prefix(shingles: np.ndarray, counts: np.ndarray, background: float, percent: int) -> tuple[np.ndarray, int]:
    """The prefix of a set and the matches it asks for; ``counts`` estimates how many sets hold a shingle."""
    n = len(shingles)
    least = -(-percent * n // 100)
    estimate = counts[_slots(shingles)]
    order = np.lexsort((shingles, estimate))[: n - least + MOST_MATCHES]
    others = np.maximum(estimate[order] - background, 0)
    best, best_cost = 1, np.inf
    for matches in range(1, min(MOST_MATCHES, least) + 1):
        length = n - least + matches
        postings = float(others[:length].sum()) + CHANCE * length
        # Pairs that share l postings are at most a l-th of all; checking a pair reads both sets.
        cost = length + postings + (n / 16) * postings / matches
        if cost < best_cost:
            best, best_cost = matches, cost
    return shingles[order[: n - least + best]], best


def _prints(docs: DataFrame, size: int) -> DataFrame:
    """A row (doc_id, row_key, n, node) for every document, and rows (chunk, payload) of the sketch."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, np.int64)
        names = ["doc_id", "row_key", "n", "node", "chunk", "payload"]
        id_arrow = None
        for batch in sliced(batches):
            id_arrow = batch.column("doc_id").type
            sizes, nodes = [], []
            for hashes in word_hashes(batch.column("text"), lower=True):
                shingles = shingle_set(hashes, size)
                sizes.append(len(shingles))
                nodes.append(_node(shingles))
                np.add.at(sketch, _slots(shingles), 1)
            empty = [pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_key"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), *empty], names)
        rows = vector_rows(sketch)
        if rows:
            empty = [pa.nulls(len(rows), id_arrow), *[pa.nulls(len(rows), pa.int64())] * 3]
            yield pa.RecordBatch.from_arrays([*empty, pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names)

    return docs.mapInArrow(run, f"doc_id {id_type}, row_key bigint, n bigint, node bigint, chunk int, payload binary")


def _prefixes(docs: DataFrame, size: int, percent: int, counts: np.ndarray, background: float) -> DataFrame:
    """(shingle, node, n, matches); copies of a set met in one task give their rows once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = set()
        for batch in sliced(batches):
            parts, nodes, sizes, matches = [], [], [], []
            for hashes in word_hashes(batch.column("text"), lower=True):
                shingles = shingle_set(hashes, size)
                node = _node(shingles)
                if not len(shingles) or node in met:
                    continue
                if len(met) < 1_000_000:
                    met.add(node)
                chosen, least = prefix(shingles, counts, background, percent)
                parts.append(chosen)
                nodes.append(np.full(len(chosen), node, np.int64))
                sizes.append(np.full(len(chosen), len(shingles), np.int64))
                matches.append(np.full(len(chosen), least, np.int32))
            if parts:
                columns = [np.concatenate(parts).view(np.int64), *map(np.concatenate, (nodes, sizes, matches))]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["shingle", "node", "n", "matches"])

    return docs.mapInArrow(run, "shingle bigint, node bigint, n bigint, matches int")


def _lengths_fit(a: str | Column, b: str | Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _with_texts(rows: DataFrame, key: str, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """``rows`` with the ``text`` of the set that their column ``key`` names. ``nodes`` (node, text_key) has the row of one
    text of each set, by a key that is never null; only texts that a row asks for leave their scan. The texts of two keys
    with one hash come both, so the set is computed again and compared by the reader."""
    named = rows.join(nodes.withColumnRenamed("node", "of_node"), F.col(key) == F.col("of_node")).drop("of_node")
    named = materialise(named, "named")
    asked = rows_maybe_held(docs.select("row_key", "text"), "row_key", named.select("text_key").distinct(), "text_key")
    # Joins with texts are never broadcasts: the lists of nodes and pairs grow with the corpus and have no bound.
    return asked.join(named.hint("merge"), F.col("row_key") == F.col("text_key")).drop("row_key", "text_key")


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar. A node ``a`` of many pairs is split into groups of ``BLOCK`` partners."""
    pairs = materialise(pairs, "pairs")
    groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).alias("groups"))
    dealt = pairs.join(groups, "a").select("a", F.pmod(F.hash("b"), F.col("groups")).alias("part"), "b")
    heads = dealt.select("a", "part").distinct().select("a", "part", F.col("a").alias("b"))
    rows = _with_texts(dealt.unionByName(heads), "b", nodes, docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, own = None, np.empty(0, np.uint64)
        for batch in sliced(batches):
            links = []
            texts = word_hashes(batch.column("text"), lower=True)
            for a, b, hashes in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), texts, strict=True):
                shingles = shingle_set(hashes, size)
                if _node(shingles) != b:
                    continue
                if a == b:
                    head, own = a, shingles
                    continue
                if head != a:  # its text was ruled out
                    continue
                common = len(np.intersect1d(own, shingles, assume_unique=True))
                if 100 * common >= percent * (len(own) + len(shingles) - common):
                    links.append((a, b))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"])

    placed = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("a") != F.col("b"))
    return placed.mapInArrow(run, "a bigint, b bigint")


def _families(postings: DataFrame) -> DataFrame:
    """(family, node, n, component) of the heavy open shingles: all sets of the shingles that have the same head, where
    that compares fewer pairs than shingle by shingle; sets with a common shingle have a common family."""
    of_head = postings.groupBy("head").agg(F.countDistinct("node").alias("sets_of_head"))
    of_shingle = postings.groupBy("head", "shingle").agg(F.count("*").alias("sets"))
    apart = of_shingle.groupBy("head").agg(F.sum(F.col("sets") * F.col("sets")).alias("pairs_apart")).join(of_head, "head")
    together = apart.filter(F.col("sets_of_head") * F.col("sets_of_head") <= F.col("pairs_apart")).select("head", F.lit(True).alias("together"))
    family = F.when(F.col("together"), F.struct(F.lit(True).alias("of_head"), F.col("head").alias("key")))
    family = family.otherwise(F.struct(F.lit(False).alias("of_head"), F.col("shingle").alias("key")))
    return postings.join(together, "head", "left").select(family.alias("family"), "node", "n", "component").distinct()


def _placed(families: DataFrame) -> DataFrame:
    """Adds ``block`` of about ``BLOCK`` sets, and ``others`` and ``blocks``, the numbers of a family's blocks. The sets of
    its largest component have blocks of their own, behind those of all others, as they need not meet each other."""
    parts = families.groupBy("family", "component").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    needed = lambda sets, shingles: F.greatest(F.ceil(sets / BLOCK), F.ceil(shingles / (1024 * BLOCK))).cast("int")
    sums = parts.groupBy("family").agg(
        F.max_by(F.struct("component", "sets", "shingles"), F.struct("sets", "component")).alias("main"),
        F.sum("sets").alias("sets"),
        F.sum("shingles").alias("shingles"),
    )
    sums = sums.select(
        "family",
        F.col("main.component").alias("main"),
        needed(F.col("sets") - F.col("main.sets"), F.col("shingles") - F.col("main.shingles")).alias("others"),
        needed(F.col("main.sets"), F.col("main.shingles")).alias("mains"),
    )
    hashed = lambda count: F.pmod(F.hash("node"), F.greatest(F.col(count), F.lit(1)))
    block = F.when(F.col("component") == F.col("main"), F.col("others") + hashed("mains")).otherwise(hashed("others"))
    placed = families.join(sums, "family").filter("others > 0")
    return placed.select("family", "node", "component", block.alias("block"), "others", (F.col("others") + F.col("mains")).alias("blocks"))


def _block_links(postings: DataFrame, nodes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links across components among the sets of each heavy shingle. A set is read once for each of its families; its
    shingles are packed into its block, and packed blocks are compared, not rows."""
    placed = materialise(_placed(materialise(_families(postings), "families")), "placed")
    rows = _with_texts(placed, "node", nodes, docs)

    def packed(frame: pd.DataFrame) -> pd.DataFrame:
        sets = [shingle_set(hashes, size) for hashes in word_hashes(pa.array(frame["text"], pa.string()), lower=True)]
        frame["own"] = [_node(s) for s in sets] == frame["node"]
        frame["set"] = sets
        frame = frame[frame["own"]].drop_duplicates("node")
        sets = frame["set"].tolist()
        if not sets:
            return pd.DataFrame()
        first = frame.iloc[[0]][["family", "block", "others", "blocks"]].copy()
        for name, values in (
            ("sets", np.concatenate(sets)),
            ("sizes", np.asarray([len(s) for s in sets], np.int64)),
            ("nodes", frame["node"].to_numpy(np.int64)),
            ("components", frame["component"].to_numpy(np.int64)),
        ):
            first[name] = [values.tobytes()]
        return first

    schema = "family struct<of_head: boolean, key: bigint>, block int, others int, blocks int, sets binary, sizes binary, nodes binary, components binary"
    blocks = materialise(rows.groupBy("family", "block").applyInPandas(packed, schema), "set-blocks")
    # Blocks of the largest component meet those of all others, which meet every block.
    meets = F.when(F.col("block") < F.col("others"), F.col("blocks")).otherwise(F.col("others"))
    met = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), meets - 1)))
    met = met.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        every, sizes, node, component = (
            np.concatenate([np.frombuffer(x, kind) for x in frame[name]])
            for name, kind in (("sets", np.uint64), ("sizes", np.int64), ("nodes", np.int64), ("components", np.int64))
        )
        row = np.repeat(np.arange(len(sizes)), sizes)
        _, column = np.unique(every, return_inverse=True)
        common = np.zeros((len(sizes), len(sizes)), np.float32)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for at in range(0, int(column[-1]) + 1, 4096):
            a, b = np.searchsorted(column, [at, at + 4096])
            part = np.zeros((len(sizes), 4096), np.float32)
            part[row[a:b], column[a:b] - at] = 1
            common += part @ part.T
        alike = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
        alike &= component[:, None] != component[None, :]
        # Components that the block's links join, by spreading the least label; one edge for each component joined.
        _, own = np.unique(component, return_inverse=True)
        label = own
        while True:
            spread = np.minimum(label, np.where(alike, label[None, :], len(label)).min(axis=1))
            of_component = np.full(len(label), len(label))
            np.minimum.at(of_component, own, spread)
            spread = of_component[own]
            if (spread == label).all():
                break
            label = spread
        links = pd.DataFrame({"a": node, "joined": label, "component": component}).drop_duplicates("component")
        links["b"] = links.groupby("joined")["a"].transform("first")
        return links.loc[links["a"] != links["b"], ["a", "b"]]

    return met.groupBy("family", "i", "j").applyInPandas(run, "a bigint, b bigint")


def _grouped(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, row_key): doc_id, row_key, n, and the component of its set; null without a set."""
    prints = materialise(_prints(docs, size), "shingle-prints")
    members = prints.filter("n is not null").select("doc_id", "row_key", "n", "node")
    counts = summed_vector(prints.filter("chunk is not null").select("chunk", "payload"), SKETCH).astype(np.int32)
    background = float(np.median(counts)) + 3 * float(np.sqrt(np.median(counts)))
    nodes = materialise(members.filter("n > 0").groupBy("node").agg(F.min("row_key").alias("text_key")), "nodes")

    # One shuffle by shingle serves the removal of copies and the counts.
    postings = _prefixes(docs, size, percent, counts, background).repartition("shingle").dropDuplicates(["shingle", "node"])
    of_shingle = Window.partitionBy("shingle")
    postings = postings.select(
        "*",
        F.count("*").over(of_shingle).alias("sets"),
        F.min("node").over(of_shingle).alias("head"),
        F.min("matches").over(of_shingle).alias("fewest"),
    )
    postings = materialise(postings.filter("sets > 1"), "postings")
    # A link needs as many shared shingles as the lesser of two sets asks for, and each of them knows the least that any
    # of its sets asks for: a set with fewer shared shingles than that has no link.
    able = postings.groupBy("node").agg(F.count("*").alias("shared"), F.min("fewest").alias("least")).filter("shared >= least")
    able = materialise(able.select("node"), "able-nodes")
    postings = materialise(postings.drop("fewest").join(able, "node", "left_semi"), "able-postings")

    first = postings.filter("node != head").groupBy(F.col("head").alias("a"), F.col("node").alias("b")).agg(
        F.count("*").alias("shared"), F.min("matches").alias("matches")
    )
    links = materialise(_verified(first.filter("shared >= matches").select("a", "b"), nodes, docs, size, percent), "links")
    found = materialise(components(links), "components")

    placed = postings.join(found, "node", "left").select("shingle", "head", "node", "n", "matches", "sets", F.coalesce("component", "node").alias("component"))
    open_ = placed.groupBy("shingle").agg(F.min("component").alias("p"), F.max("component").alias("q")).filter("p != q")
    placed = materialise(placed.join(open_.select("shingle"), "shingle", "left_semi"), "open-postings")
    held = placed.filter(F.col("sets") <= LIGHT).groupBy("shingle").agg(F.collect_list(F.struct("node", "n", "matches", "component")).alias("held"))
    partners = F.filter(
        "held",
        lambda y: (y["node"] > F.col("x.node")) & (y["component"] != F.col("x.component")) & _lengths_fit(F.col("x.n"), y["n"], percent),
    )
    pairs = held.select(F.explode("held").alias("x"), "held").select("x", F.explode(partners).alias("y"))
    pairs = pairs.groupBy(F.col("x.node").alias("a"), F.col("y.node").alias("b")).agg(
        F.count("*").alias("shared"), F.min(F.least("x.matches", "y.matches")).alias("matches")
    )
    more = _verified(pairs.filter("shared >= matches").select("a", "b"), nodes, docs, size, percent)
    blocks = _block_links(placed.filter(F.col("sets") > LIGHT), nodes, docs, size, percent)
    links = links.unionByName(more).unionByName(blocks)
    groups = components(materialise(links, "links"))

    groups = groups.select(F.col("node").alias("of"), "component")
    out = members.join(groups, (F.col("node") == F.col("of")) & (F.col("n") > 0), "left")
    return out.select("doc_id", "row_key", "n", F.when(F.col("n") > 0, F.coalesce("component", "node")).alias("component"))


def ngram_groups(df: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the least id reachable by links of Jaccard >= percent / 100."""
    grouped = materialise(_grouped(with_row_key(documents(df, id_col, text_col)), size, percent), "grouped")
    least = grouped.filter("n > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    least = least.select(F.col("component").alias("of"), "component_id")
    out = grouped.join(least, F.col("component") == F.col("of"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each_group(df: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of ``df``: that of the least id; a row without an id only where no row of its group has one.

    Unlike texts of one id are groups of their own and stay. Rows without a set stay, but of rows equal in id and text one
    does: the first by its other columns.
    """
    names = ["_row_key", "_nth"]
    while set(names) & set(df.columns):
        names = [n + "_" for n in names]
    key, nth = names
    keyed = df.withColumn(key, F.xxhash64(F.col(id_col), F.col(text_col).cast("string")))
    docs = keyed.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(key).alias("row_key"))
    grouped = materialise(_grouped(docs, size, percent), "grouped")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")).alias("best")
    kept = grouped.filter("n > 0").groupBy("component").agg(best).select(F.col("best.row_key").alias("kept"))
    kept = materialise(kept.unionByName(grouped.filter("n = 0").select(F.col("row_key").alias("kept"))).distinct(), "groups-kept")
    order = Window.partitionBy(key).orderBy(text_col, *[c for c in df.columns if c != text_col])
    single = keyed.join(kept, keyed[key] == kept["kept"], "left_semi").withColumn(nth, F.row_number().over(order))
    return single.filter(F.col(nth) == 1).drop(key, nth)
