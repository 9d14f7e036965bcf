"""Spelling variants: words one edit apart, found through a reduced alphabet.

Letters are hashed to ``SYMBOLS`` symbols. Two words that differ by one
inserted, deleted or replaced code point have reduced words that are equal or
differ by one such edit, so every word generates the one-edit neighbourhood of
its reduced word and meets there the words with that reduced word: an
equi-join of keys, whose candidates are verified on the original strings. The
neighbourhood is generated once for each pair: an insertion into one word is
the deletion from the other, and of two words that differ by a replaced symbol
the one with the smaller symbol generates it. Keys are 64-bit polynomial
hashes, so all neighbours of a word follow from its prefix sums without
building strings. Words longer than ``LONG`` meet by number instead of by
themselves, so a word of any length is handled.

Words are counted where the documents are read (runs of letters found with
numpy in Latin-1, where each code point is a byte), the counts are summed by
Spark.
"""

from __future__ import annotations

import math
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.shipping import map_arrow
from martflow.llm.textcore import SEGMENT, _tables, mix, stored

SYMBOLS = 6
SHORT = 64            # letters of a run whose checksum is computed with its block's
LONG = 65             # letters of a word that is carried along with its keys
PART_WORDS = 1 << 15  # words whose neighbourhoods a task generates
HELD_WORDS = 1 << 19  # distinct words a task counts before it hands them on

# runs of A-Z, a-z and U+00C0 to U+00FF, as Latin-1
LETTERS = np.zeros(256, dtype=bool)
LETTERS[ord("A"):ord("Z") + 1] = True
LETTERS[ord("a"):ord("z") + 1] = True
LETTERS[0xC0:] = True

_crc_steps: np.ndarray | None = None


def _crc_table() -> np.ndarray:
    global _crc_steps
    if _crc_steps is None:
        steps = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(0xEDB88320), steps >> 1)
        _crc_steps = steps
    return _crc_steps


def _checksums(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """crc32 of each run's UTF-8 bytes after its document's prefix (whose crc32 is given)."""
    table = _crc_table()
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    crc = ~prefix[order]
    long = int(np.searchsorted(-lengths, -SHORT))  # runs longer than SHORT come first
    for j in range(int(lengths[long]) if long < len(lengths) else 0):
        active = slice(long, int(np.searchsorted(-lengths, -j)))
        byte, own = raw[starts[active] + j].astype(np.uint32), crc[active]
        high = byte >= 0xC0  # two bytes in UTF-8: 0xC3 and the letter less 0x40
        if high.any():
            own = np.where(high, table[(own ^ np.uint32(0xC3)) & 255] ^ (own >> 8), own)
            byte = np.where(high, byte - np.uint32(0x40), byte)
        crc[active] = table[(own ^ byte) & 255] ^ (own >> 8)
    crc = ~crc
    for i in range(long):
        run = raw[starts[i]:starts[i] + lengths[i]].tobytes().decode("latin-1").encode()
        crc[i] = zlib.crc32(run, int(prefix[order[i]]))
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _pieces(names: list, texts: list[str | None]) -> Iterator[tuple[list[bytes], list[bytes]]]:
    """Blocks of (document prefix, Latin-1 bytes in lower case) of about
    SEGMENT code points; longer texts are cut behind runs of letters."""
    prefixes, block, size = [], [], 0
    for name, text in zip(names, texts, strict=True):
        if not text:
            continue
        prefix = f"{'' if name is None else name}:".encode()
        raw = text.encode("latin-1", "replace").lower()
        at = 0
        while at < len(raw):
            end = min(at + SEGMENT, len(raw))
            while end < len(raw) and LETTERS[raw[end]]:
                gap = np.flatnonzero(~LETTERS[np.frombuffer(raw, np.uint8, min(SEGMENT, len(raw) - end), end)])
                end = end + int(gap[0]) if len(gap) else min(end + SEGMENT, len(raw))
            prefixes.append(prefix)
            block.append(raw[at:end])
            size += end - at
            at = end
            if size >= SEGMENT:
                yield prefixes, block
                prefixes, block, size = [], [], 0
    if block:
        yield prefixes, block


def _block_words(prefixes: list[bytes], block: list[bytes], least: int, spoil: int
                 ) -> Iterator[tuple[bytes, int]]:
    """(word in Latin-1, occurrences) of the distinct words of a block."""
    text = b"\n".join(block)
    raw = np.frombuffer(text, dtype=np.uint8)
    edges = np.flatnonzero(np.diff(LETTERS[raw].astype(np.int8), prepend=0, append=0))
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    if spoil:
        # runs that a deletion leaves too short need no checksum
        some = lengths >= least
        starts, lengths = starts[some], lengths[some]
        piece = np.searchsorted(np.cumsum([len(b) + 1 for b in block]), starts, side="right")
        crc = _checksums(raw, starts, lengths, np.array([zlib.crc32(p) for p in prefixes], np.uint32)[piece])
        spoiled = crc % np.uint32(spoil) == 0
        for i in np.flatnonzero(spoiled):
            run = text[starts[i]:starts[i] + lengths[i]]
            at = int(crc[i]) % len(run)
            if len(run) > least:
                yield run[:at] + run[at + 1:], 1
        starts, lengths = starts[~spoiled], lengths[~spoiled]
    some = lengths >= least
    starts, lengths = starts[some], lengths[some]
    if not len(starts):
        return
    power, inverse = _tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:len(raw)], out=sums[1:])
    hashes = mix((sums[starts + lengths] - sums[starts]) * inverse[starts] + lengths.astype(np.uint64))
    _, first, counts = np.unique(hashes, return_index=True, return_counts=True)
    for at, n, count in zip(starts[first].tolist(), lengths[first].tolist(), counts.tolist(), strict=True):
        yield text[at:at + n], count


def vocabulary(docs: DataFrame, least_letters: int = 5, least_count: int = 3, spoil: int = 0,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of at least ``least_letters`` code points met at
    least ``least_count`` times over all documents.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, only A-Z in lower
    case; null texts have none. With ``spoil`` > 0, misspellings are planted:
    where it divides the crc32 h of the UTF-8 ``<id>:<run>`` (a null id is
    empty), the run loses its code point h % length.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def handed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in held], type=pa.string()),
                 pa.array(list(held.values()), type=pa.int64())], names=["word", "n"])

        for batch in batches:
            for prefixes, block in _pieces(batch.column("name").to_pylist(), batch.column("text").to_pylist()):
                for word, n in _block_words(prefixes, block, least_letters, spoil):
                    held[word] = held.get(word, 0) + n
                if len(held) >= HELD_WORDS:
                    yield handed()
                    held.clear()
        if held:
            yield handed()

    read = docs.select(F.col(id_col).cast("string").alias("name"), F.col(text_col).cast("string").alias("text"))
    return (map_arrow(read, run, "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


def _keyed(words: DataFrame, symbols: int, neighbours: bool) -> DataFrame:
    """The rows of words and ``keys``: the key of the word's reduced word,
    followed with ``neighbours`` by those of its neighbourhood."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("word").to_pylist()
            codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
            length = np.array([len(t) for t in texts], dtype=np.int64)
            end = np.cumsum(length)
            start = end - length
            symbol = mix(codes) % np.uint64(symbols) + np.uint64(1)
            power, inverse = _tables(len(codes) + 1)
            sums = np.zeros(len(codes) + 1, dtype=np.uint64)
            np.cumsum(symbol * power[:len(codes)], out=sums[1:])
            whole = (sums[end] - sums[start]) * inverse[start]
            word, key = [np.arange(len(texts))], [_key(whole, length)]
            if neighbours:
                of = np.repeat(np.arange(len(texts)), length)
                first = start[of]
                place = np.arange(len(codes)) - first
                before = (sums[:-1] - sums[first]) * inverse[first]
                behind = (sums[end[of]] - sums[1:]) * inverse[first]
                # of equal symbols in a row, each deletion gives the same
                other = (place == 0) | (symbol != np.roll(symbol, 1))
                word.append(of[other])
                key.append(_key((before + behind * inverse[1])[other], length[of][other] - 1))
                for put in range(2, symbols + 1):
                    lower = symbol < np.uint64(put)
                    word.append(of[lower])
                    key.append(_key((whole[of] + (np.uint64(put) - symbol) * power[place])[lower],
                                    length[of][lower]))
            word, key = np.concatenate(word), np.concatenate(key)
            order = np.argsort(word, kind="stable")  # a word's own key comes first
            offsets = np.searchsorted(word[order], np.arange(len(texts) + 1))
            keys = pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()),
                                            pa.array(key[order].view(np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], names=[*batch.schema.names, "keys"])

    return map_arrow(words, run, words.schema.simpleString()[7:-1] + ",keys:array<bigint>")


def _key(hashes: np.ndarray, length: np.ndarray) -> np.ndarray:
    return mix(hashes * np.uint64(0x9E3779B97F4A7C15) + length.astype(np.uint64))


def _candidates(words: DataFrame, symbols: int, columns: list[str], order: str) -> DataFrame:
    """Pairs of words whose reduced words are at most one edit apart, each
    once: the columns as ``a_`` and ``b_``; ``order`` is the column that tells
    the two words of a pair with the same reduced word apart."""
    asked = _keyed(words, symbols, neighbours=True).select(
        *[F.col(c).alias(f"a_{c}") for c in columns], F.posexplode("keys").alias("place", "key"))
    own = _keyed(words, symbols, neighbours=False).select(
        *[F.col(c).alias(f"b_{c}") for c in columns], F.col("keys")[0].alias("key"))
    return (asked.join(own, "key").where((F.col("place") > 0) | (F.col(f"a_{order}") < F.col(f"b_{order}")))
            .drop("key", "place"))


def _one_edit(pairs: DataFrame) -> DataFrame:
    """The rows of (a_word, b_word, ...) one edit apart, in time linear in a word's length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for a, b in zip(batch.column("a_word").to_pylist(), batch.column("b_word").to_pylist(), strict=True):
                at = len(os.path.commonprefix((a, b)))
                near.append(a != b and (a[at + 1:] == b[at + 1:] or a[at + 1:] == b[at:] or a[at:] == b[at + 1:]))
            yield batch.filter(pa.array(near, type=pa.bool_()))
    return map_arrow(pairs, run, pairs.schema)


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, near, near_n): every ordered pair of different words of (word, n)
    that are one inserted, deleted or replaced code point apart."""
    n_parts = max(1, math.ceil(words.count() / PART_WORDS))
    words = words.select("word", "n").repartition(n_parts, "word")
    met = (_candidates(words.where(F.length("word") <= LONG), symbols, ["word", "n"], "word")
           .where(F.levenshtein("a_word", "b_word", 1) == 1))
    # longer words meet by number, so that their many keys do not carry them along
    long = stored(words.where(F.length("word") >= LONG).withColumn("id", F.monotonically_increasing_id()), "long")
    pairs = _candidates(long, symbols, ["id"], "id")
    for side in ("a", "b"):
        pairs = pairs.join(long.select(*[F.col(c).alias(f"{side}_{c}") for c in long.columns]), f"{side}_id")
    pairs = pairs.where(F.greatest(F.length("a_word"), F.length("b_word")) > LONG)
    met = met.unionByName(_one_edit(pairs.select(*met.columns)))
    both = F.explode(F.array(
        F.struct(F.col("a_word").alias("word"), F.col("b_word").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b_word").alias("word"), F.col("a_word").alias("near"), F.col("a_n").alias("near_n"))))
    return met.select(both.alias("pair")).select("pair.*")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the last of each chain of forms, by
    pointer jumping; a form's count at least doubles, so chains end."""
    at = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = stored(at.join(further, "root", "left")
                       .select("word", F.coalesce("further", "root").alias("root"),
                               F.col("further").isNotNull().alias("moved")), "roots")
        at = after.select("word", "root")
        if after.where("moved").isEmpty():
            return at


def variants(words: DataFrame, ratio: int = 2, symbols: int = SYMBOLS) -> DataFrame:
    """Per word of (word, n): word, form, root, n, n_near, form_n.

    form is the near word of largest n (ties: the smallest in code-point
    order) if its n is at least ``ratio`` (2 or more) times the word's, else
    null; root is the last word along the forms, the word itself if it has
    none; n_near counts the near words. No words give no rows.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2: forms could go round in circles")
    words = stored(words, "words")
    near = stored(near_words(words, symbols).groupBy("word")
                  .agg(F.count("*").alias("n_near"),
                       F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")), "near")
    own = words.join(near, "word", "left")
    formed = -F.col("best.less") >= ratio * F.col("n")
    own = own.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                     F.when(formed, F.col("best.near")).alias("form"),
                     F.when(formed, -F.col("best.less")).alias("form_n"))
    roots = _roots(own.where("form is not null"))
    return (own.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def spelling_groups(docs: DataFrame, least_letters: int = 5, least_count: int = 3, spoil: int = 0,
                    ratio: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``variants`` of the ``vocabulary`` of docs."""
    return variants(vocabulary(docs, least_letters, least_count, spoil, id_col, text_col), ratio)
