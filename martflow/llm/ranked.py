"""Ranked lexical search: Block-Max MaxScore over shards of an inverted index.

Documents are indexed where they are read: each task cuts its rows into shards
of a bounded number of documents and postings. A shard has one list per term,
its postings in blocks of ``BLOCK`` (document gaps and term frequencies in as
few bytes as the list needs), and per block its last document, its highest
frequency and its shortest document, from which a bound of the block's scores
follows once the corpus counts are known.

The search goes shard by shard. An item's lists are ordered by their bounds;
while the lists left could lift a document to the k-th best score on their own,
the next one is essential and read as a whole. The rest are not: documents
found so far are looked up there only while the bounds of the lists left, then
of the document's block, let them reach the k-th best score, and only blocks
that such documents fall into are decompressed. Shard heaps (k rows an item)
are merged by Spark. Nothing is cut: the result is that of scoring everything.

Only terms that some item has are indexed. A bitmap of ``SLOTS`` hashed terms
(fixed size, broadcast) keeps others out early, a join on the terms themselves
keeps the exact ones. Items come in blocks of about ``ITEM_TERMS`` terms; a
task holds one shard and one block of items.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martflow.llm.shipping import map_arrow, ship
from martflow.llm.textcore import ALNUM, stored, text_words

BLOCK = 128               # postings of a block
SHARD_POSTINGS = 1 << 21  # postings of a shard
SHARD_DOCS = 1 << 16      # documents of a shard
SLOTS = 1 << 22           # bitmap of the items' terms
ITEM_TERMS = 1 << 20      # terms of a block of items

_INDEX = ("shard bigint, term bigint, df bigint, total bigint, heads binary, docs binary, tfs binary")
_WIDTHS = {1: np.uint8, 2: np.uint16, 4: np.uint32}


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, term): the distinct terms of each item as 64-bit hashes. Rows
    that repeat an id are one item; null and empty texts have no terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item")
            for row, hashes in text_words(batch, "text", ALNUM):
                terms = np.unique(hashes).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array([row] * len(terms), type=pa.int32())), pa.array(terms)],
                    names=["item", "term"])

    read = items.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("text"))
    kind = read.schema["item"].dataType.simpleString()
    return map_arrow(read, run, f"item {kind}, term bigint").distinct()


def _narrow(values: np.ndarray) -> bytes:
    top = int(values.max()) if len(values) else 0
    return values.astype(next(t for w, t in _WIDTHS.items() if top < 1 << (8 * w))).tobytes()


def _wide(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=_WIDTHS[len(raw) // n] if n else np.uint8)


def _shard(shard: int, ids: list, lengths: list[int], found: list[tuple[np.ndarray, np.ndarray]]
           ) -> pa.RecordBatch:
    """The rows of one shard: its documents (term null) and its lists."""
    n = np.array(lengths, dtype=np.uint32)
    doc = np.repeat(np.arange(len(ids)), [len(t) for t, _ in found])
    term = np.concatenate([t for t, _ in found])
    tf = np.concatenate([c for _, c in found])
    order = np.argsort(term, kind="stable")  # documents stay ascending in a list
    doc, term, tf = doc[order], term[order], tf[order]
    cuts = np.append(np.flatnonzero(np.diff(term, prepend=term[:1] - 1)), len(term))
    rows = [(None, len(ids), int(n.astype(np.int64).sum()),
             np.array([i is None for i in ids]).tobytes(),
             np.array([i or 0 for i in ids], dtype=np.int64).tobytes(), n.tobytes())]
    for low, high in zip(cuts, cuts[1:], strict=False):
        docs, tfs = doc[low:high], tf[low:high]
        starts = np.arange(0, len(docs), BLOCK)
        last = docs[np.minimum(starts + BLOCK, len(docs)) - 1]
        heads = np.stack([last, np.maximum.reduceat(tfs, starts),
                          np.minimum.reduceat(n[docs], starts)]).astype(np.uint32)
        rows.append((int(term[low]), len(docs), 0, heads.tobytes(),
                     _narrow(np.diff(docs, prepend=0)), _narrow(tfs)))
    columns = list(zip(*rows, strict=True))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array([shard] * len(rows), type=pa.int64())]
        + [pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)],
        names=["shard", "term", "df", "total", "heads", "docs", "tfs"])


def index(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text"
          ) -> DataFrame:
    """The sharded index of docs for (at least) the terms of ``terms``."""
    spark = docs.sparkSession
    slots = (terms.select(F.col("term").bitwiseAND(SLOTS - 1).cast("int").alias("slot")).distinct()
             .toArrow().column("slot").to_numpy())
    bitmap = np.zeros(SLOTS, dtype=bool)
    bitmap[slots] = True
    shared = spark.sparkContext.broadcast(np.packbits(bitmap))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(shared.value).astype(bool)
        shard = TaskContext.get().partitionId() << 32
        ids, lengths, found, held = [], [], [], 0
        for batch in batches:
            names = batch.column("doc").to_pylist()
            for row, hashes in text_words(batch, "text", ALNUM):
                if not len(hashes):
                    continue
                known = hashes[wanted[hashes & np.uint64(SLOTS - 1)]]
                terms, counts = np.unique(known.view(np.int64), return_counts=True)
                ids.append(names[row])
                lengths.append(len(hashes))
                found.append((terms, counts))
                held += len(terms)
                if held >= SHARD_POSTINGS or len(ids) >= SHARD_DOCS:
                    yield _shard(shard, ids, lengths, found)
                    shard, ids, lengths, found, held = shard + 1, [], [], [], 0
        if ids:
            yield _shard(shard, ids, lengths, found)

    read = docs.select(F.col(id_col).cast("bigint").alias("doc"),
                       F.col(text_col).cast("string").alias("text"))
    return map_arrow(read, run, _INDEX)


class _List:
    """One term's list in a shard, decompressed as far as asked for."""

    def __init__(self, weight: int, df: int, heads: bytes, docs: bytes, tfs: bytes, m_of):
        self.weight, self.df = weight, df
        self.last, top_tf, least_n = np.frombuffer(heads, dtype=np.uint32).astype(np.int64).reshape(3, -1)
        self.gaps, self.tfs = _wide(docs, df), _wide(tfs, df)
        self.bounds = self._scores(top_tf, m_of(least_n))
        self.bound = int(self.bounds.max())
        self._all: tuple[np.ndarray, np.ndarray] | None = None

    def _scores(self, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        tf = tf.astype(np.int64)
        return self.weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))

    def whole(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self._all is None:
            docs = np.cumsum(self.gaps, dtype=np.int64)
            self._all = docs, self._scores(self.tfs, m[docs])
        return self._all

    def of(self, docs: np.ndarray, blocks: np.ndarray, m: np.ndarray) -> np.ndarray:
        """The scores of ascending docs, which fall into the given blocks."""
        own, back = np.unique(blocks, return_inverse=True)
        place = own[:, None] * BLOCK + np.arange(BLOCK)
        inside = place < self.df
        place = np.minimum(place, self.df - 1)
        base = np.where(own > 0, self.last[own - 1], 0)
        held = np.where(inside, base[:, None] + np.cumsum(self.gaps[place], axis=1, dtype=np.int64),
                        np.iinfo(np.int64).max)
        flat = held.ravel()  # blocks ascend, so do their documents
        at = np.minimum(np.searchsorted(flat, docs), len(flat) - 1)
        met = flat[at] == docs
        out = np.zeros(len(docs), dtype=np.int64)
        out[met] = self._scores(self.tfs[place.ravel()[at[met]]], m[docs[met]])
        return out


def _best(lists: list[_List], m: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores): all that can be among the k best of a shard."""
    lists = sorted((x for x in lists if x.bound > 0), key=lambda x: -x.bound)
    left = np.append(np.cumsum([x.bound for x in lists][::-1])[::-1], 0).astype(np.int64)
    score = np.zeros(len(m), dtype=np.int64)
    least, at = 1, 0

    def raised(scores: np.ndarray) -> int:
        return max(least, int(np.partition(scores, len(scores) - k)[len(scores) - k])) \
            if len(scores) >= k else least

    while at < len(lists) and left[at] >= least:  # essential
        docs, own = lists[at].whole(m)
        score[docs] += own
        at += 1
        if at < len(lists):
            least = raised(score[docs])
    docs = np.flatnonzero(score)
    found = score[docs]
    least = raised(found)
    for i in range(at, len(lists)):
        keep = found + left[i] >= least
        docs, found = docs[keep], found[keep]
        blocks = np.searchsorted(lists[i].last, docs)
        bound = np.append(lists[i].bounds, 0)[blocks]  # 0 behind the last block
        keep = found + bound + left[i + 1] >= least
        docs, found, blocks, bound = docs[keep], found[keep], blocks[keep], bound[keep]
        inside = np.flatnonzero(bound > 0)
        if len(inside):
            found[inside] += lists[i].of(docs[inside], blocks[inside], m)
            least = raised(found)
    keep = found >= least
    return docs[keep], found[keep]


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
           ) -> DataFrame:
    """Per item its k best documents: item, rank (from 1), id, score.

    Terms are runs of ASCII digits and letters (A-Z lower-cased) and non-ASCII
    characters. With N documents that have a term, L their terms, n a
    document's, df the documents of a term and tf its occurrences in one, a
    term's weight is floor(1000 ln((2N+2)/(2df+1))), a document's m is
    10 + 90nN div L, and a score the sum over the item's distinct terms of
    weight * (10^9 tf div (1000 tf + 8m)). Documents of score 0 are left out;
    equal scores go by ascending id, null ids last. Each row of docs is a
    document of its own; rows that repeat an item's id are one item; an item
    without a term that some document has, gives no row.
    """
    spark = docs.sparkSession
    wanted = stored(item_terms(items, item_col, item_text_col), "item-terms")
    made = stored(index(docs, wanted, id_col, text_col), "index")
    own = made.where("term is null")
    corpus = own.agg(F.sum("df").alias("docs"), F.sum("total").alias("terms")).first()
    n_docs, n_terms = int(corpus["docs"] or 0), int(corpus["terms"] or 1)
    n_blocks = max(1, math.ceil(wanted.count() / ITEM_TERMS))
    block = F.pmod(F.xxhash64("item"), F.lit(n_blocks)).cast("int").alias("block")

    weight = F.floor(1000 * F.log((F.lit(2.0) * n_docs + 2) / (2 * F.sum("df") + 1)))
    weights = made.where("term is not null").groupBy("term").agg(weight.cast("bigint").alias("weight"))
    asked = wanted.select(block, "term").distinct().join(weights, "term")
    lists = (made.where("term is not null").join(asked, "term")
             .select("shard", "block", F.lit(1).alias("kind"), "term", "weight", "df", "heads", "docs", "tfs"))
    shards = own.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    heads = shards.select("shard", "block", F.lit(0).alias("kind"), "df", "heads", "docs", "tfs")
    sought = wanted.groupBy(block, "item").agg(F.collect_list("term").alias("terms"))
    asking = (shards.select("shard", "block").join(sought, "block")
              .select("shard", "block", F.lit(2).alias("kind"), "item", "terms"))
    rows = (lists.unionByName(heads, allowMissingColumns=True)
            .unionByName(asking, allowMissingColumns=True))

    def run(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        named = {c: table.column(c).to_pylist() for c in ("term", "weight", "df", "heads", "docs", "tfs")}
        head = int(np.flatnonzero(kind == 0)[0])
        ids = np.frombuffer(named["docs"][head], dtype=np.int64)
        nameless = np.frombuffer(named["heads"][head], dtype=bool)

        def m_of(n: np.ndarray) -> np.ndarray:
            return 10 + (90 * n.astype(np.int64) * n_docs) // n_terms
        m = m_of(np.frombuffer(named["tfs"][head], dtype=np.uint32))
        of_term = {named["term"][i]: _List(*(named[c][i] for c in ("weight", "df", "heads", "docs", "tfs")), m_of)
                   for i in np.flatnonzero(kind == 1)}
        sought = np.flatnonzero(kind == 2)
        terms, source, found, scores = table.column("terms"), [], [], []
        for row in sought:
            own = [of_term[t] for t in terms[int(row)].as_py() if t in of_term]
            at, score = _best(own, m, k)
            best = np.lexsort((ids[at], nameless[at], -score))[:k]
            source += [row] * len(best)
            found.append(at[best])
            scores.append(score[best])
        at = np.concatenate(found) if found else np.empty(0, dtype=np.int64)
        score = np.concatenate(scores) if scores else np.empty(0, dtype=np.int64)
        return pa.table({"item": table.column("item").take(pa.array(source, type=pa.int64())),
                         "doc": pa.array(ids[at], mask=nameless[at]), "score": pa.array(score)})

    ship(spark)
    kind = wanted.schema["item"].dataType.simpleString()
    heaps = rows.groupBy("shard", "block").applyInArrow(run, f"item {kind}, doc bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc").asc_nulls_last())
    return (heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score"))
