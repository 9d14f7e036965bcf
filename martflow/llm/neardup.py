"""Near-duplicate documents: bottom-k sketches of one hash function.

A document's set is its distinct word shingles as 64-bit hashes. Documents
with the same set (128-bit signature and size) are one node, so copies are
never compared. Of each node's set the k smallest hashes are kept.

Candidates come from inverted lists of kept values. Two sets of similarity s
have about k*s of the union's k smallest values in common, so a linked pair
shares at least ``least`` kept values but for a chance of ``MISS`` (sets of up
to k shingles are kept whole: for them the bound is exact). Values are ordered
by how many nodes keep them; a node is listed under its rarest ones, all but
its ``least - MEET`` most frequent, so such a pair meets in ``MEET`` lists at
least (prefix filter). Frequent shingles hence make no long lists.

Pairs that meet often enough in lists of up to ``SMALL`` members, and each
member of a longer list with the list's first, are filtered by the union
sketch's estimate. The connected components of what is left are the clusters
that can hold links. Every cluster, and every longer list whose members are
in several clusters, is verified by the exact similarities of the full sets,
in tiles of up to about ``TILE`` by ``TILE`` documents and ``TILE_SHINGLES`` by
``TILE_SHINGLES`` shingles (one longer text is taken whole) that emit a spanning
forest of their links: no group of n near copies makes n*n pairs, and none is cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.llm.components import components
from martflow.llm.shipping import map_arrow, ship
from martflow.llm.textcore import SPACED, mix, shingles, stored, text_words

K = 32            # values kept of each set
MISS = 1e-6       # largest chance that a linked pair shares too few kept values
MEET = 3          # lists that a linked pair meets in
SMALL = 64        # members of a list whose pairs are made by a join
TILE = 1024       # members of a block of a cluster or longer list
TILE_SHINGLES = 1 << 20  # shingles of such a block
COLUMNS = 1 << 12  # shingles of a tile compared at once
STRIP = 256       # rows of a tile compared at once


def least_shared(k: int, percent: int, miss: float = MISS) -> int:
    """The most values that all but a share ``miss`` of linked pairs reach."""
    p, below = percent / 100, 0.0
    for shared in range(k + 1):
        below += math.comb(k, shared) * p ** shared * (1 - p) ** (k - shared)
        if below > miss:
            return max(1, shared)
    return k


def _signature(found: np.ndarray) -> tuple[int, int]:
    wide = found.view(np.uint64)
    return (int(mix(wide).sum().view(np.int64)),
            int(mix(wide * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)).sum().view(np.int64)))


def sketches(docs: DataFrame, words: int, id_col: str, text_col: str, k: int) -> DataFrame:
    """Per row: id, n, s1, s2 (the set's signature), hashes (its k smallest);
    n is 0 without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, s1, s2, kept = [], [], [], []
            for _, hashes in text_words(batch, text_col, SPACED):
                found = np.unique(shingles(hashes, words))
                a, b = _signature(found) if len(found) else (0, 0)
                n.append(len(found))
                s1.append(a)
                s2.append(b)
                kept.append(found[:k])
            made = [pa.array(n, type=pa.int64()), pa.array(s1, type=pa.int64()),
                    pa.array(s2, type=pa.int64()), pa.array(kept, type=pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), *made], names=[id_col, "n", "s1", "s2", "hashes"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(id_col, text_col), run,
                     f"`{id_col}` {kind}, n bigint, s1 bigint, s2 bigint, hashes array<bigint>")


def _similar_sizes(a: str, b: str, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _own_least(n: Column, percent: int, least: int) -> Column:
    """The kept values that a set of n shingles shares with a linked one."""
    return F.least(F.lit(least), F.ceil(n * percent / 100)).cast("int")


def _postings(nodes: DataFrame, percent: int, least: int) -> DataFrame:
    """(value, node, n): the inverted lists."""
    kept = nodes.select("node", "n", F.explode("hashes").alias("value"))
    shared = kept.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    # values of one node alone come first in its order and list nobody else, so
    # the most frequent ones are left out of its shared values
    left_out = _own_least(F.col("n"), percent, least)
    left_out = left_out - F.least(F.lit(MEET), left_out)
    listed = (kept.join(shared, "value").groupBy("node", "n")
              .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("order"))
              .where(F.size("order") > left_out)
              .select("node", "n", F.explode(F.slice(
                  "order", F.lit(1), F.size("order") - left_out)).alias("kept")))
    return listed.select(F.col("kept.value").alias("value"), "node", "n")


def _pairs(lists: DataFrame, percent: int, least: int) -> DataFrame:
    """(a, b): pairs of similar size that meet in as many short lists as a
    linked pair must, and the members of long ones with their first."""
    short = lists.where((F.col("members") > 1) & (F.col("members") <= SMALL))
    left, right = (short.select("value", F.col("node").alias(s), F.col("n").alias(f"n_{s}"))
                   for s in ("a", "b"))
    must = F.least(F.lit(MEET), _own_least(F.col("n_a"), percent, least),
                   _own_least(F.col("n_b"), percent, least))
    met = (left.join(right, "value")
           .where((F.col("a") < F.col("b")) & _similar_sizes("n_a", "n_b", percent))
           .groupBy("a", "b").agg(F.count("*").alias("met"), F.first(must).alias("must"))
           .where("met >= must").select("a", "b"))
    long = lists.where(F.col("members") > SMALL)
    star = (long.where(F.col("node") != F.col("first"))
            .select(F.col("first").alias("a"), F.col("node").alias("b")))
    return met.unionByName(star).distinct()


def _likely(pairs: DataFrame, nodes: DataFrame, k: int, percent: int, least: int) -> DataFrame:
    """The pairs whose union sketch lets them be linked: of its k smallest
    values, those kept by both are counted (exact if the union has no more)."""
    for side in ("a", "b"):
        pairs = pairs.join(nodes.select(F.col("node").alias(side), F.col("hashes").alias(f"h_{side}")), side)
    union = F.slice(F.array_sort(F.array_union("h_a", "h_b")), 1, k)
    both = F.size(F.array_intersect(F.array_intersect("h_a", "h_b"), union))
    enough = F.least(F.lit(least), F.ceil(F.size(union) * percent / 100))
    return pairs.where(both >= enough).select("a", "b")


def _tiles(members: DataFrame) -> DataFrame:
    """(kind, name, i, j, node) for members (kind, name, node, members, shingles:
    the group's counts): each pair of a group's blocks is one tile."""
    blocks = F.greatest(F.ceil(F.col("members") / TILE),
                        F.least(F.col("members"), F.ceil(F.col("shingles") / TILE_SHINGLES))).cast("int")
    return (members.withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .select("kind", "name", F.least("block", "other").alias("i"),
                    F.greatest("block", "other").alias("j"), "node"))


def linked_rows(row: np.ndarray, column: np.ndarray, size: np.ndarray, percent: int) -> np.ndarray:
    """Whether any two sets are similar enough, from the (row, column) of their
    shared values, by column. Counted in whole numbers; beside the result, one
    whole-number matrix and strips of ``STRIP`` rows are held."""
    n = len(size)
    shared = np.zeros((n, n), dtype=np.int32)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        at, to = np.searchsorted(column, [low, low + COLUMNS])
        part = np.zeros((n, int(column[to - 1]) - low + 1 if to > at else 0), dtype=np.float32)
        part[row[at:to], column[at:to] - low] = 1
        for top in range(0, n, STRIP):  # products of at most COLUMNS ones are exact
            shared[top:top + STRIP] += (part[top:top + STRIP] @ part.T).astype(np.int32)
    linked = np.empty((n, n), dtype=bool)
    for top in range(0, n, STRIP):
        both = shared[top:top + STRIP].astype(np.int64)
        linked[top:top + STRIP] = both * 100 >= (size[top:top + STRIP, None] + size[None, :] - both) * percent
    return linked


def _tile_links(tiles: DataFrame, words: int, percent: int) -> DataFrame:
    """Links of each tile of (node, text, n, s1, s2): a spanning forest of the
    pairs within it whose full sets are similar enough."""
    def sets(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
        nodes, found = [], []
        for batch in table.to_batches():
            node, n, s1, s2 = (batch.column(c).to_pylist() for c in ("node", "n", "s1", "s2"))
            for row, hashes in text_words(batch, "text", SPACED):
                own = np.unique(shingles(hashes, words))
                # a row of the same id with another text is not the node's
                if len(own) == n[row] and _signature(own) == (s1[row], s2[row]):
                    nodes.append(node[row])
                    found.append(own)
        nodes, first = np.unique(np.array(nodes, dtype=np.int64), return_index=True)
        return nodes, [found[i] for i in first]

    def link(table: pa.Table) -> pa.Table:
        node, found = sets(table)
        del table
        size = np.array([len(f) for f in found], dtype=np.int64)
        row = np.repeat(np.arange(len(node)), size)
        flat = np.concatenate(found) if found else np.empty(0, dtype=np.int64)
        del found
        _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
        common = count[column] > 1
        place = np.cumsum(count > 1) - 1
        row, column = row[common], place[column[common]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        linked = linked_rows(row, column, size, percent)
        a, b, left = [], [], np.ones(len(node), dtype=bool)
        for start in range(len(node)):  # each node is reached once
            if left[start]:
                left[start] = False
                front = [start]
                while front:
                    at = front.pop()
                    near = np.flatnonzero(linked[at] & left)
                    left[near] = False
                    front.extend(near.tolist())
                    a.extend([node[at]] * len(near))
                    b.extend(node[near].tolist())
        return pa.table({"a": pa.array(a, type=pa.int64()), "b": pa.array(b, type=pa.int64())})

    ship(tiles.sparkSession)
    return tiles.groupBy("kind", "name", "i", "j").applyInArrow(link, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, k: int = K,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id, n_shingles, component_id, kept.

    Words are split at ASCII white space, A-Z in lower case; a text of fewer
    than ``words`` words is one shingle, one without words (or null) has none
    and is linked with nothing. Documents are linked at ``100 * shared >=
    percent * union``; component_id is the smallest id reachable, the own one
    included. Rows that repeat an id are one document, whose set is that of
    its largest row (ties: by signature); each row is returned. Rows with a
    null id are linked with nothing: component_id is null and kept is true.
    """
    least = least_shared(k, percent)
    read = docs.select(F.col(id_col).cast("bigint").alias("node"),
                       F.col(text_col).cast("string").alias("text"))
    rows = stored(sketches(read, words, "node", "text", k), "sketches")
    own = stored(rows.where("node is not null and n > 0").groupBy("node")
                 .agg(F.max(F.struct("n", "s1", "s2")).alias("own")).select("node", "own.*"), "own")
    signature = ["n", "s1", "s2"]
    classes = own.groupBy(*signature).agg(F.min("node").alias("node"))
    nodes = stored(rows.join(classes, ["node", *signature]).dropDuplicates(["node", *signature]), "nodes")
    postings = stored(_postings(nodes, percent, least), "postings")
    sizes = postings.groupBy("value").agg(F.count("*").alias("members"), F.min("node").alias("first"),
                                             F.sum("n").alias("shingles"))
    lists = postings.join(sizes, "value")
    likely = _likely(_pairs(lists, percent, least), nodes, k, percent, least)
    clusters = components(likely)

    # tiles: every cluster, and every long list with members of several clusters
    counts = clusters.join(nodes.select("node", "n"), "node").groupBy("comp").agg(
        F.count("*").alias("members"), F.sum("n").alias("shingles"))
    of_cluster = clusters.join(counts, "comp").select(
        F.lit(0).alias("kind"), F.col("comp").alias("name"), "node", "members", "shingles")
    long = (lists.where(F.col("members") > SMALL).join(clusters, "node", "left")
            .withColumn("comp", F.coalesce("comp", "node")))
    mixed = (long.groupBy("value").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
             .where("low < high").select("value"))
    of_list = long.join(mixed, "value").select(
        F.lit(1).alias("kind"), F.col("value").alias("name"), "node", "members", "shingles")
    tiles = stored(_tiles(of_cluster.unionByName(of_list)), "tiles")

    # the full sets are made again, in the tiles, from the texts of their nodes
    wanted = tiles.select("node").distinct().join(nodes.select("node", *signature), "node")
    texts = (read.join(wanted, "node").withColumn("h", F.xxhash64("text"))
             .dropDuplicates(["node", "h"]).drop("h"))
    links = _tile_links(tiles.join(texts, "node"), words, percent)
    comps = components(links)

    # every id: by its set's class, by the class's component
    of_class = (nodes.join(comps, "node", "left")
                .select(*signature, F.coalesce("comp", "node").alias("comp")))
    of_id = own.join(of_class, signature).select("node", F.col("n").alias("own_n"), "comp")
    out = rows.select("node", "n").join(of_id, "node", "left")
    return out.select(F.col("node").alias(id_col),
                      F.coalesce("own_n", "n").alias("n_shingles"),
                      F.coalesce("comp", "node").alias("component_id"),
                      F.coalesce(F.coalesce("comp", "node") == F.col("node"), F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, words: int = 5, percent: int = 80, k: int = K,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, with one document of each group: the one
    with the smallest id (of several texts with that id, one by a hash of the
    text). Texts are judged apart even if they share an id; of rows that repeat
    both id and text one stays. Rows with a null id stay."""
    node = F.xxhash64(F.col(id_col), F.col(text_col))
    read = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("name"), node.alias("node"), F.col(text_col).alias("text"))
    judged = near_duplicates(read, words, percent, k, "node", "text")
    first = (judged.select("node", "component_id").distinct().join(read.select("name", "node").distinct(), "node")
             .groupBy("component_id").agg(F.min(F.struct("name", "node")).alias("first")))
    kept_col = "kept"
    while kept_col in docs.columns:
        kept_col += "_"
    kept = first.select(F.col("first.node").alias(kept_col))
    named = (docs.where(F.col(id_col).isNotNull()).join(kept, node == F.col(kept_col), "left_semi")
             .dropDuplicates([id_col, text_col]))
    return named.unionByName(docs.where(F.col(id_col).isNull()))
