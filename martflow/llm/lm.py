"""Stupid-backoff language-model scores, by exact counts of all n-grams.

Every word and n-gram is keyed by a 64-bit hash and keeps its own count,
however rare it is and however large the corpus.

1. Texts are taken in blocks of about ``BLOCK_WORDS`` words. A block gives its
   distinct keys with their counts in it, so the most frequent n-gram is one
   row of a block. Keys are dealt by hash range to buckets of about ``BUCKET``
   positions (packed: sorted differences, a few bytes a key). The block's own
   row keeps its texts as places in the list of its distinct words.
2. A bucket adds up the counts of its keys over all blocks and answers each
   block with the corpus counts of that block's keys.
3. A block puts its texts' keys and the answers together, scores every
   position and adds up its documents.

Score of a word w after the ``order`` - 1 words c before it (fewer at the start
of a document): f(c w) / f(c) if c w occurs ``least`` times or more in the
corpus, else BACKOFF times the score of w after c without its first word; after
no words: f(w) / N.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.shipping import map_arrow
from martflow.llm.textcore import SPACED, arrow_type, mix, stored, text_words

BACKOFF = 0.4
BUCKET = 1 << 21     # positions of a bucket
BLOCK_WORDS = 1 << 20  # words of a block of texts (one longer text is a block)
WORD_BYTES = 4       # of a text for each word, for the number of buckets

_MULT = np.uint64(0x9E3779B97F4A7C15)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(ids, words of each text, all word hashes) of blocks of texts."""
    for batch in batches:
        ids = batch.column("id").to_pylist()
        rows, words, size = [], [], 0
        for row, hashes in text_words(batch, "text", SPACED):
            rows.append(ids[row])
            words.append(hashes)
            size += len(hashes)
            if size >= BLOCK_WORDS:
                yield rows, np.array([len(w) for w in words]), np.concatenate(words)
                rows, words, size = [], [], 0
        if rows:
            yield rows, np.array([len(w) for w in words]), np.concatenate(words)


def _keys(hashes: np.ndarray, lengths: np.ndarray, order: int) -> list[np.ndarray]:
    """For n from 1 to order the keys of the n-grams within documents, in the
    order of their last words; ``_whole`` has their places."""
    made, keys = [hashes], hashes
    for n in range(2, order + 1):
        full = np.zeros(len(hashes), dtype=np.uint64)
        full[1:] = mix(keys[:-1] * _MULT + hashes[1:] + np.uint64(n))
        keys = full
        made.append(keys[_whole(lengths, n)])
    return made


def _whole(lengths: np.ndarray, n: int) -> np.ndarray:
    """Which words have n - 1 words of their document before them."""
    starts = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) - np.repeat(starts, lengths) >= n - 1


def scores(docs: DataFrame, least: int = 1, bucket: int = BUCKET, order: int = 2,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, log_score (sum of the words' natural log scores,
    to 6 digits; 0 without words), mean_log_score (per word, to 6 digits;
    null without words).

    Words are split at ASCII white space, A-Z in lower case. A null or empty
    text has no words. Repeated rows count and are returned each. Every word
    and n-gram that occurs has its own count; with least above 1 those met
    fewer times count as unseen, and the shorter context is asked.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-order * size // (WORD_BYTES * bucket)))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for ids, lengths, hashes in _blocks(batches):
            words, at, n = np.unique(hashes, return_inverse=True, return_counts=True)
            often = np.argsort(-n, kind="stable")  # frequent words have small numbers
            place = np.empty(len(words), dtype=np.int64)
            place[often] = np.arange(len(words))
            yield pa.RecordBatch.from_pylist([{
                "block": block, "bucket": -1, "keys": words[often].tobytes(),
                "n": _packed(place[at]), "ids": ids, "words": lengths.tolist()}], schema=arrow)
            keys, n = np.unique(np.concatenate(_keys(hashes, lengths, order)), return_counts=True)
            # the 32 high bits, scaled: ascending with the keys
            to = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(to, prepend=-1))
            ends = np.append(cuts, len(to))[1:]
            out = [{"block": block, "bucket": int(to[low]), "keys": _packed(np.concatenate(
                        (keys[low:low + 1], np.diff(keys[low:high])))),
                    "n": _packed(n[low:high]), "ids": None, "words": None}
                   for low, high in zip(cuts, ends, strict=True)]
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
            block += 1

    arrow = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("keys", pa.binary()),
                       ("n", pa.binary()), ("ids", pa.list_(arrow_type(docs, id_col))),
                       ("words", pa.list_(pa.int64()))])
    columns = (f"block bigint, bucket bigint, keys binary, n binary, ids array<{kind}>, "
               "words array<bigint>")

    def count(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            return table.select(arrow.names)
        keys = [np.cumsum(_unpacked(p), dtype=np.uint64) for p in table.column("keys").to_pylist()]
        n = np.concatenate([_unpacked(p) for p in table.column("n").to_pylist()])
        _, same = np.unique(np.concatenate(keys), return_inverse=True)
        totals = _added(same, n)[same]
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        none = [None] * len(keys)
        return pa.table([table.column("block"), table.column("bucket"), pa.array(none, type=pa.binary()),
                         pa.array([_packed(t) for t in np.split(totals, cuts)], type=pa.binary()),
                         pa.array(none, type=arrow.field("ids").type),
                         pa.array(none, type=arrow.field("words").type)], names=arrow.names)

    # a block's own row is no bucket: a part each block
    part = F.when(F.col("bucket") < 0, -1 - F.col("block")).otherwise(F.col("bucket"))
    counted = (map_arrow(texts, explode, columns).withColumn("part", part).groupBy("part")
               .applyInArrow(count, columns))

    def add(table: pa.Table) -> pa.Table:
        rows = sorted(table.select(["bucket", "keys", "n", "ids", "words"]).to_pylist(),
                      key=lambda r: r["bucket"])
        own, answers = rows[0], rows[1:]
        lengths = np.array(own["words"], dtype=np.int64)
        hashes = np.frombuffer(own["keys"], dtype=np.uint64)[_unpacked(own["n"]).astype(np.int64)]
        keys = _keys(hashes, lengths, order)
        # the answers' keys are all distinct keys, ascending
        _, same = np.unique(np.concatenate(keys), return_inverse=True)
        found = np.concatenate([np.empty(0, dtype=np.uint64), *(_unpacked(r["n"]) for r in answers)])
        counts = np.split(found[same].astype(np.int64), np.cumsum([len(k) for k in keys])[:-1])
        score, backed = np.log(counts[0]), np.ones(len(hashes))  # each has - log N once more
        shorter = counts[0]  # of the (n - 1)-gram that ends with each word
        for n in range(2, order + 1):
            last = np.flatnonzero(_whole(lengths, n))
            longer = np.zeros(len(hashes), dtype=np.int64)
            longer[last] = counts[n - 1]
            met = last[longer[last] >= least]
            unmet = last[longer[last] < least]
            score[met] = np.log(longer[met]) - np.log(shorter[met - 1])
            backed[met] = 0
            score[unmet] += np.log(BACKOFF)
            shorter = longer
        doc = np.repeat(np.arange(len(lengths)), lengths)
        return pa.table([pa.array(own["ids"], type=arrow.field("ids").type.value_type),
                         pa.array(lengths),
                         pa.array(_summed(doc, score, len(lengths))),
                         pa.array(_summed(doc, backed, len(lengths)))],
                        names=[id_col, "n_words", "total", "backed"])

    out = stored(counted.groupBy("block").applyInArrow(
        add, f"`{id_col}` {kind}, n_words bigint, total double, backed double"), "scores")
    log_n = float(np.log(max(1, out.agg(F.sum("n_words")).first()[0] or 0)))
    total = F.col("total") - F.col("backed") * F.lit(log_n)
    return out.select(id_col, "n_words", F.round(total, 6).alias("log_score"),
                      F.when(F.col("n_words") > 0, F.round(total / F.col("n_words"), 6))
                      .alias("mean_log_score"))


def _added(same: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The sums of n by group number, in whole numbers."""
    order = np.argsort(same, kind="stable")
    return np.add.reduceat(n[order], np.flatnonzero(np.diff(same[order], prepend=-1)))


def _summed(group: np.ndarray, values: np.ndarray, groups: int) -> np.ndarray:
    """The sums of values by group number, in doubles also of no value at all."""
    return np.bincount(group, values, minlength=groups).astype(np.float64)


def _packed(numbers: np.ndarray) -> bytes:
    """As many bytes a number as the greatest needs, first bytes first, compressed."""
    numbers = numbers.astype("<u8")
    width = max(1, -(-int(numbers.max()).bit_length() // 8)) if len(numbers) else 1
    raw = numbers.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return bytes([width]) + len(numbers).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(packed: bytes) -> np.ndarray:
    width, size = packed[0], int.from_bytes(packed[1:9], "little")
    raw = pa.decompress(packed[9:], decompressed_size=width * size, codec="zstd", asbytes=True)
    out = np.zeros((size, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(raw, dtype=np.uint8).reshape(width, size).T
    return out.view("<u8").reshape(-1)
