"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item is a short set of word shingles that must be found inside long
documents, where the two sets' Jaccard similarity is close to 0 and MinHash of
whole documents is blind. So only the small side is sketched: the items are
partitioned by set size, each partition with its own sketch length (the items'
bottom-m hash values) and its own least number of hits; a document's whole
shingle set is the other side. An item that a document contains to the
threshold has each sketch value in the document with at least that chance, so
a candidate is an item with enough of its sketch met; items up to ``WHOLE``
shingles are kept whole and need exactly their share. Candidates are verified
by exact containment of the full shingle sets.

The items' index is broadcast in blocks of at most ``BLOCK`` shingles (a block
never exceeds that by more than its last item), however many items there are;
documents are only scanned, never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.shipping import map_arrow
from martflow.llm.textcore import ALNUM, arrow_type, shingles, text_words

BLOCK = 1 << 20      # shingles of the items broadcast at once
WHOLE = 32           # items up to this size are their own sketch
MISS = 1e-9          # largest chance that a contained item's sketch has too few hits


def _sketch_length(size: int) -> int:
    """By size partition: the whole set, then one more value each doubling."""
    return size if size <= WHOLE else WHOLE + 8 * (size.bit_length() - WHOLE.bit_length())


def _least_hits(size: int, sketch: int, threshold: float) -> int:
    if sketch == size:
        return max(1, math.ceil(threshold * size - 1e-9))
    chance = 0.0
    for hits in range(sketch + 1):
        chance += (math.comb(sketch, hits) * threshold ** hits
                   * (1 - threshold) ** (sketch - hits))
        if chance > MISS:
            return max(1, hits)
    return sketch


class _Index:
    """One block of items: sorted sketch values, the items behind each, the full sets."""

    def __init__(self, items: list[tuple], threshold: float):
        self.threshold = threshold
        self.ids = [i for i, _ in items]
        self.sets = [s for _, s in items]
        lengths = [_sketch_length(len(s)) for s in self.sets]
        self.least = np.array([_least_hits(len(s), m, threshold)
                               for s, m in zip(self.sets, lengths, strict=True)])
        values = np.concatenate([s[:m] for s, m in zip(self.sets, lengths, strict=True)])
        owner = np.repeat(np.arange(len(items)), lengths)
        order = np.argsort(values, kind="stable")
        self.owner = owner[order]
        self.values, self.first = np.unique(values[order], return_index=True)
        self.first = np.append(self.first, len(values))
        self.bits = min(28, max(16, len(self.values).bit_length() + 6))
        self.seen = np.zeros(1 << self.bits, dtype=bool)
        self.seen[self._slot(self.values)] = True

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes.view(np.uint64) >> np.uint64(64 - self.bits)).astype(np.int64)

    def contained(self, found: np.ndarray) -> list[tuple[int, int]]:
        """(item, shared shingles) of the items that the document contains."""
        maybe = np.unique(found[self.seen[self._slot(found)]])
        at = np.searchsorted(self.values, maybe)
        at = at[(at < len(self.values)) & (self.values[np.minimum(at, len(self.values) - 1)] == maybe)]
        if not len(at):
            return []
        owners = np.concatenate([self.owner[self.first[i]:self.first[i + 1]] for i in at])
        items, hits = np.unique(owners, return_counts=True)
        whole, out = None, []
        for item in items[hits >= self.least[items]]:
            whole = np.unique(found) if whole is None else whole
            shared = int(np.isin(self.sets[item], whole, assume_unique=True).sum())
            if shared >= self.threshold * len(self.sets[item]) - 1e-9:
                out.append((int(item), shared))
        return out


def _item_blocks(items: DataFrame, id_col: str, text_col: str, words: int
                 ) -> Iterator[list[tuple]]:
    """The items' distinct shingle sets, streamed to the driver in blocks."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(shingles(h, words)) for _, h in text_words(batch, text_col, ALNUM)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(found, type=pa.list_(pa.int64()))],
                names=[id_col, "hashes"])

    kind = items.schema[id_col].dataType.simpleString()
    made = (map_arrow(items.select(id_col, text_col), sets, f"`{id_col}` {kind}, hashes array<bigint>")
            .where(F.size("hashes") > 0).distinct())
    block, size = [], 0
    for row in made.toLocalIterator():
        block.append((row[0], np.array(row[1], dtype=np.int64)))
        size += len(row[1])
        if size >= BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


def contamination(docs: DataFrame, items: DataFrame, words: int = 5, threshold: float = 0.8,
                  id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """One row per document row and item it contains: doc id, item id,
    n_item (the item's shingles), n_shared, containment.

    Shingles are runs of ``words`` words (ASCII letters and digits in lower
    case, and all non-ASCII characters); a text with fewer words is one
    shingle, so such an item is met only by a document that is just that
    sequence. Null or empty items and documents contain nothing and are
    contained in nothing. Repeated items count once, repeated documents each.
    """
    spark = docs.sparkSession
    id_kind = docs.schema[id_col].dataType
    item_kind = items.schema[item_id].dataType
    kind = arrow_type(items, item_id)
    schema = (f"`{id_col}` {id_kind.simpleString()}, `{item_id}` {item_kind.simpleString()}, "
              "n_item bigint, n_shared bigint, containment double")
    out = None
    for block in _item_blocks(items, item_id, item_text, words):
        index = spark.sparkContext.broadcast(_Index(block, threshold))

        def search(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            index = index.value
            for batch in batches:
                rows, hits = [], []
                for row, hashes in text_words(batch, text_col, ALNUM):
                    for hit in index.contained(shingles(hashes, words)):
                        rows.append(row)
                        hits.append(hit)
                n = np.array([len(index.sets[i]) for i, _ in hits], dtype=np.int64)
                shared = np.array([s for _, s in hits], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(id_col).take(pa.array(rows, type=pa.int64())),
                     pa.array([index.ids[i] for i, _ in hits], type=kind), pa.array(n),
                     pa.array(shared), pa.array(shared / np.maximum(n, 1))],
                    names=[id_col, item_id, "n_item", "n_shared", "containment"])

        found = map_arrow(docs.select(id_col, text_col), search, schema)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def decontaminate(docs: DataFrame, items: DataFrame, words: int = 5, threshold: float = 0.8,
                  text_col: str = "text", item_id: str = "item_id", item_text: str = "text"
                  ) -> DataFrame:
    """The rows of docs, all columns, that contain no item (see contamination)."""
    spark = docs.sparkSession
    for block in _item_blocks(items, item_id, item_text, words):
        index = spark.sparkContext.broadcast(_Index(block, threshold))

        def clean(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = [not index.value.contained(shingles(hashes, words))
                        for _, hashes in text_words(batch, text_col, ALNUM)]
                yield batch.filter(pa.array(keep, type=pa.bool_()))

        docs = map_arrow(docs, clean, docs.schema)
    return docs
