"""Near-duplicate vectors: NN-descent with growing lists and an audited recall.

Equal vectors of a label are one vector with a weight: they link with each other, and with
whatever one of them links to, which is counted by arithmetic. For the others:

1. *Start.* Random hyperplanes cut the vectors of a label into leaves of some
   ``LEAF`` vectors, ``TREES`` times over; a leaf that stays larger is dealt out at
   random. Each vector lists its ``K`` nearest of its leaves.
2. *Descend.* Neighbours of a vector are compared with each other, both along and
   against the lists, and better ones enter the lists, until no list changes or
   ``ROUNDS`` are over. Edges below ``FLOOR`` are not followed: two vectors within
   the threshold of 0.98 are 11 degrees apart, and common neighbours beyond 37
   degrees say little about them.
3. *Enlarge.* A list is saturated if all its K entries are links. Then K is too
   small to hold all, and the list is enlarged to everything that links lead to:
   members of such a component are compared block by block and counted.
4. *Audit.* One vector in ``AUDITED`` is compared with all of its label. Recall is the
   mean share of its links that an audited vector with links was found to have, so that
   each vector counts alike, whatever the size of its group. While a label is below
   ``RECALL``, more trees follow for it; a label that is still below it after
   ``MORE_TREES`` further tries is compared whole, block by block, which is exact.

Vectors are compared in tasks that hold a leaf, a share of the centres or two
blocks, never all of a label. Counts by label are joined to vectors over a salted key.

Defined results: vectors that are null, zero, or hold null or non-finite numbers,
and vectors without a label, link with nothing and are their own component;
vectors of different lengths do not link; repeated rows of one id are one vector
(the first in array order) with a row each. Other columns are not read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.components import components
from playtrail.llm.stages import keep_table, partitions
from playtrail.llm.textbytes import mix

COSINE = 0.98
FLOOR = 0.8
K = 10
LEAF = 200
TREES = 8
ROUNDS = 4
BLOCK = 2048
AUDITED = 50
RECALL = 0.95
MORE_TREES = 3

#: Parts that the vectors of one label are dealt to where they meet its counts.
SALTS = 32

_EDGES = "u long, v long, cosine double"


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _edges(u=(), v=(), cosine=()) -> pa.Table:
    return pa.table(
        {"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64()),
         "cosine": pa.array(cosine, pa.float64())}
    )


def _nearest(ids: np.ndarray, x: np.ndarray, k: int) -> pa.Table:
    """For each vector its k nearest others of at least ``FLOOR``."""
    out = []
    for at in range(0, len(x), 512):
        cosine = x[at : at + 512] @ x.T
        rows = np.arange(len(cosine))
        cosine[rows, at + rows] = -2
        best = np.argsort(-cosine, axis=1, kind="stable")[:, :k]
        value = np.take_along_axis(cosine, best, axis=1)
        row, place = np.nonzero(value >= FLOOR)
        out.append((ids[at + row], ids[best[row, place]], value[row, place]))
    return _edges(*(np.concatenate(c) for c in zip(*out)))


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """id, family (label and length) and vector of those that can link, one row per id."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    norm = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    return (
        vectors.select(
            F.col(id_col).cast("long").alias("id"),
            F.col(label_col).alias("label"),
            x.alias("x"),
            F.coalesce(finite, F.lit(False)).alias("finite"),
        )
        .filter("id is not null and label is not null and x is not null and finite")
        .filter((norm > 0) & (norm < float("inf")))
        .groupBy("id")
        .agg(F.min(F.struct("x", "label")).alias("one"))
        .select(
            "id",
            F.xxhash64("one.label", F.size("one.x")).alias("family"),
            F.col("one.x").alias("x"),
        )
    )


def _leaves(rows: DataFrame, trees: int, first_tree: int) -> DataFrame:
    """id, vector and leaf of every vector in every tree."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            family = batch.column(1).to_numpy().view(np.uint64)
            bits = batch.column(2).to_numpy()
            lengths = pa.compute.list_value_length(batch.column(3)).to_numpy()
            leaf = np.zeros((batch.num_rows, trees), np.int64)
            for length in np.unique(lengths):
                own = np.flatnonzero(lengths == length)
                x = _matrix(batch.column(3).take(pa.array(own)))
                for t in range(trees):
                    planes = np.random.RandomState(first_tree + t).randn(int(length), 40)
                    sides = (x @ planes > 0) & (np.arange(40) < bits[own][:, None])
                    code = (sides * (1 << np.arange(40))).sum(axis=1).astype(np.uint64)
                    salt = mix(family[own] + np.uint64(first_tree + t))
                    leaf[own, t] = mix(salt ^ mix(code + np.uint64(1))).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3), pa.array(list(leaf), pa.list_(pa.int64()))],
                names=["id", "x", "leaves"],
            )

    cutted = rows.select("id", "family", "bits", "x").mapInArrow(
        cut, "id long, x array<double>, leaves array<long>"
    )
    return cutted.select("id", "x", F.explode("leaves").alias("leaf"))


def with_counts(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows joined to a table by family; the rows of one family are dealt to several tasks."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    return salted.join(counts.select("*", salts), ["family", "salt"]).drop("salt")


def start_lists(vectors: DataFrame, trees: int, first_tree: int, k: int) -> DataFrame:
    size = vectors.groupBy("family").count()
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("count") / LEAF))).cast("int")
    rows = with_counts(vectors, size).withColumn("bits", bits)
    leaves = _leaves(rows, trees, first_tree)
    large = leaves.groupBy("leaf").count().filter(F.col("count") > 4 * LEAF)
    large = large.select("leaf", F.ceil(F.col("count") / (2 * LEAF)).alias("parts"))
    dealt = leaves.join(large, "leaf", "left").withColumn(
        "part", F.pmod(F.xxhash64("id", "leaf"), F.coalesce("parts", F.lit(1)))
    )

    def nearest(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        if len(ids) < 2:
            return _edges()
        return _nearest(ids, _matrix(table.column("x")), k)

    found = dealt.groupBy("leaf", "part").applyInArrow(nearest, _EDGES)
    return keep_table(best(found, k), "lists")


def best(edges: DataFrame, k: int) -> DataFrame:
    """The k best entries of every list, with one entry for each other vector.

    One cosine computed in two products may differ in its last bit; the greatest counts.
    Lists stay where the first exchange brought their entries.
    """
    single = edges.filter("u != v").repartition("u").groupBy("u", "v")
    entry = F.struct((-F.col("cosine")).alias("far"), "v")
    ranked = (
        single.agg(F.max("cosine").alias("cosine"))
        .groupBy("u")
        .agg(F.slice(F.sort_array(F.collect_list(entry)), 1, k).alias("list"))
    )
    return ranked.select("u", F.explode("list").alias("e")).select(
        "u", F.col("e.v").alias("v"), (-F.col("e.far")).alias("cosine")
    )


def descend(lists: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """One round: compare the neighbours of every vector with each other."""
    against = lists.select(F.col("v").alias("u"), F.col("u").alias("v"), "cosine")
    around = best(lists.unionByName(against), 2 * k)
    centre = F.pmod(F.xxhash64("u"), F.lit(partitions(vectors.sparkSession))).alias("share")
    members = around.select("u", "v").join(vectors.select(F.col("id").alias("v"), "x"), "v")

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("u", "ascending"), ("v", "ascending")])
        centres = table.column("u").to_numpy()
        ids = table.column("v").to_numpy()
        cut = np.flatnonzero(np.append(True, centres[1:] != centres[:-1]))
        lengths = pa.compute.list_value_length(table.column("x").combine_chunks()).to_numpy()
        out = []
        for a, b in zip(cut, np.append(cut[1:], len(ids))):
            if b - a > 1 and (lengths[a:b] == lengths[a]).all():
                out.append(_nearest(ids[a:b], _matrix(table.column("x").slice(a, b - a)), k))
        return pa.concat_tables(out) if out else _edges()

    found = members.select(centre, "u", "v", "x").groupBy("share").applyInArrow(compare, _EDGES)
    return keep_table(best(lists.unionByName(found), k), "lists")


def _links(lists: DataFrame) -> DataFrame:
    both = lists.filter(F.col("cosine") >= COSINE).select(
        F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")
    )
    return both.distinct()


def _changes(lists: DataFrame):
    return lists.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def neighbour_graph(vectors: DataFrame, trees: int, first_tree: int, k: int, old=None) -> DataFrame:
    lists = start_lists(vectors, trees, first_tree, k)
    if old is not None:
        lists = keep_table(best(lists.unionByName(old), k), "lists")
    seen = _changes(lists)
    for _ in range(ROUNDS):
        lists = descend(lists, vectors, k)
        now = _changes(lists)
        if now == seen:
            break
        seen = now
    return lists


def _block_counts(
    asking: DataFrame, given: DataFrame, size: int, ties: bool = False
) -> DataFrame:
    """id, n, joined: how many others of its ``family`` each of ``asking`` links to, by weight.

    Both are dealt into blocks of some ``size`` vectors; a task compares two blocks.
    With ``ties``, ``joined`` are vectors that stand for the links of two blocks: within
    them, linked vectors lead to the same one.
    """
    n_asking = asking.groupBy("family").agg(F.ceil(F.count("*") / size).alias("n_x"))
    n_given = given.groupBy("family").agg(F.ceil(F.count("*") / size).alias("n_y"))
    blocks = n_asking.join(n_given, "family")

    def dealt(rows: DataFrame, own: str, n_own: str, other: str, n_other: str, asks: bool):
        # a number of blocks is a count over ``size``, so the sequence is as short
        return with_counts(rows, blocks).select(
            "family",
            F.pmod(F.xxhash64("id"), F.col(n_own)).alias(own),
            F.explode(F.sequence(F.lit(0), F.col(n_other) - 1)).alias(other),
            "id",
            "x",
            "weight",
            F.lit(asks).alias("asks"),
        )

    both = dealt(asking, "bx", "n_x", "by", "n_y", True).unionByName(
        dealt(given, "by", "n_y", "bx", "n_x", False)
    )

    def count(table: pa.Table) -> pa.Table:
        ask = np.array(table.column("asks").to_pylist())
        ids, weight = table.column("id").to_numpy(), table.column("weight").to_numpy()
        x = _matrix(table.column("x"))
        left, right = np.flatnonzero(ask), np.flatnonzero(~ask)
        n = np.zeros(len(left), np.int64)
        near = np.zeros((len(left), len(right)), bool)
        for at in range(0, len(left), 512):
            own = left[at : at + 512]
            near[at : at + 512] = x[own] @ x[right].T >= COSINE
            near[at : at + 512] &= ids[own][:, None] != ids[right]
            n[at : at + 512] = near[at : at + 512] @ weight[right]
        joined = _least_reached(near, ids[left], ids[right]) if ties else ids[left]
        return pa.table({"id": pa.array(ids[left]), "n": pa.array(n), "joined": pa.array(joined)})

    met = both.groupBy("family", "bx", "by").applyInArrow(count, "id long, n long, joined long")
    return met.groupBy("id").agg(F.sum("n").alias("n"), F.collect_set("joined").alias("joined"))


def _least_reached(near: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each row the least id that links of the two blocks lead to."""
    told = np.zeros(0, np.int64)
    mine, theirs = left.copy(), right.copy()
    row, column = np.nonzero(near)
    while not np.array_equal(told, mine):
        told = mine.copy()
        np.minimum.at(theirs, column, mine[row])
        np.minimum.at(mine, row, theirs[column])
    return mine


def degrees(lists: DataFrame, links: DataFrame, joined: DataFrame, vectors: DataFrame, k: int):
    """id, n: number of links by weight; saturated components are counted block by block."""
    weights = vectors.select(F.col("id").alias("b"), "weight")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    listed = both.join(weights, "b").groupBy(F.col("a").alias("id"))
    listed = listed.agg(F.sum("weight").alias("n"))
    member = listed.join(joined.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id")
    )
    full = (
        lists.groupBy("u")
        .agg(F.min("cosine").alias("low"), F.count("*").alias("size"))
        .filter((F.col("size") >= k) & (F.col("low") >= COSINE))
        .select(F.col("u").alias("id"))
    )
    saturated = member.join(full, "id", "left_semi").select("component").distinct()
    grown = member.join(saturated, "component", "left_semi").select("id", "component")
    grown = grown.join(vectors.select("id", "x", "weight"), "id").select(
        "id", F.col("component").alias("family"), "x", "weight"
    )
    grown = keep_table(grown, "saturated")
    counted = keep_table(_block_counts(grown, grown, BLOCK).select("id", "n"), "counted")
    return member.join(counted.withColumnRenamed("n", "all"), "id", "left").select(
        "id", F.coalesce("all", "n").alias("n")
    )


def audit(vectors: DataFrame, found: DataFrame) -> DataFrame:
    """Per family: how many vectors were audited, and the sum of the shares found of their links."""
    asking = vectors.filter(F.pmod(F.xxhash64("id"), F.lit(AUDITED)) == 0)
    truth = _block_counts(asking, vectors, BLOCK).filter("n > 0").select("id", "n")
    share = F.coalesce(F.col("got"), F.lit(0)) / F.col("n")
    return (
        truth.join(vectors.select("id", "family"), "id")
        .join(found.select("id", F.col("n").alias("got")), "id", "left")
        .groupBy("family")
        .agg(F.count("*").alias("audited"), F.sum(F.least(share, F.lit(1.0))).alias("shares"))
    )


def collapsed(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One vector for equal ones of a family, with their number; and whom each stands for."""
    keyed = vectors.withColumn("hash", F.xxhash64("x"))
    own = keyed.groupBy("family", "hash", "x").agg(
        F.min("id").alias("id"), F.count("*").alias("weight")
    )
    own = keep_table(own.select("id", "family", "x", "weight"), "vectors")
    keys = own.select(F.col("id").alias("same_as"), "family", F.xxhash64("x").alias("hash"), "x")
    same = keyed.select("id", "family", "hash", "x").join(keys, ["family", "hash", "x"])
    return own, keep_table(same.select("id", "same_as"), "copies")


def linked_vectors(
    vectors: DataFrame,
    id_col="vec_id",
    vector_col="embedding",
    label_col="label",
    k: int = K,
    more_trees: int = MORE_TREES,
) -> DataFrame:
    """id, n_links, component_id of every row, and the audited recall."""
    rows, copies = collapsed(keep_table(usable(vectors, id_col, vector_col, label_col), "usable"))
    settled: list[tuple[DataFrame, DataFrame]] = []  # links and degrees of labels that are done
    open_rows, lists, audited, shares = rows, None, 0, 0.0
    for attempt in range(1 + more_trees):
        lists = neighbour_graph(open_rows, TREES, attempt * TREES, k, lists)
        links = keep_table(_links(lists), "links")
        found = keep_table(degrees(lists, links, components(links), open_rows, k), "degrees")
        judged = keep_table(audit(open_rows, found), "audit")
        short = judged.filter(F.col("shares") < RECALL * F.col("audited")).select("family")
        good = judged.join(short, "family", "left_anti").agg(F.sum("audited"), F.sum("shares"))
        whole = judged.agg(F.sum("audited"), F.sum("shares")).first()
        left = keep_table(open_rows.join(short, "family", "left_semi"), "open")
        settled.append(
            (
                links.join(left.select(F.col("id").alias("a")), "a", "left_anti"),
                found.join(left.select("id"), "id", "left_anti"),
            )
        )
        done = good.first()
        audited, shares = audited + (done[0] or 0), shares + (done[1] or 0.0)
        open_rows = left
        if not (whole[0] or 0) - (done[0] or 0):
            break
    else:
        # these labels are compared whole; what their links lead to stands for the links
        exact = keep_table(_block_counts(open_rows, open_rows, BLOCK, ties=True), "whole-labels")
        ties = exact.select(F.explode("joined").alias("a"), F.col("id").alias("b"))
        settled.append((ties.filter("a != b"), exact.select("id", "n")))
        n = open_rows.filter(F.pmod(F.xxhash64("id"), F.lit(AUDITED)) == 0).join(
            exact.filter("n > 0").select("id"), "id", "left_semi"
        )
        n = n.count()
        audited, shares = audited + n, shares + n
    links, found = settled[0]
    for more_links, more_found in settled[1:]:
        links, found = links.unionByName(more_links), found.unionByName(more_found)
    joined = components(links).select(F.col("node").alias("same_as"), "component")
    own = F.col(id_col).cast("long")
    each = (
        copies.join(rows.select(F.col("id").alias("same_as"), "weight"), "same_as")
        .join(found.select(F.col("id").alias("same_as"), "n"), "same_as", "left")
        .join(joined, "same_as", "left")
        .select(
            "id",
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n"),
            F.coalesce("component", "same_as").alias("component"),
        )
    )
    return (
        vectors.select(own.alias("id"))
        .join(each, "id", "left")
        .select(
            "id",
            F.coalesce("n", F.lit(0).cast("long")).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
            F.lit(shares / audited if audited else 1.0).alias("audited_recall"),
        )
    )
