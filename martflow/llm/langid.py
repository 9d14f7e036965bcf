"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts every labelled row (no sample): each task adds its n-gram
counts into one (language x bucket) matrix and emits its non-zero cells, Spark
sums the cells. The log-probability matrix has ``buckets`` columns and one row
per learned language, so its size is bounded by the number of languages, not
by the data; it is broadcast and scored sparsely (the n-grams of a block of
texts are looked up and summed per text) in numpy.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martflow.llm.shipping import map_arrow

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
ALPHA = 0.5          # additive smoothing per bucket
MAX_LANGUAGES = 512  # a label column beyond this is no language column: refused
GATHERED = 1 << 22   # looked-up log-probabilities held at once
BLOCK_CHARS = 1 << 19
UNKNOWN = "und"

_letters: np.ndarray | None = None


def _letter_map() -> np.ndarray:
    """Code point -> itself if it is a letter (category L*), else a space."""
    global _letters
    if _letters is None:
        points = np.arange(0x110000, dtype=np.uint32)
        letter = np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)),
                             dtype=bool, count=0x110000)
        _letters = np.where(letter, points, np.uint32(32))
    return _letters


def _pieces(texts: list[str | None]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Blocks of (row of each piece, code points of each piece, padded).

    A text longer than a block is cut into pieces that overlap by the longest
    n-gram less one, so that every n-gram of the text is met once.
    """
    reach = max(ORDERS) - 1
    rows: list[int] = []
    codes: list[np.ndarray] = []
    size = 0
    table = _letter_map()
    for row, text in enumerate(texts):
        if not text:
            continue
        points = table[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        points = np.concatenate(([np.uint32(32)], points, np.full(reach, 32, dtype=np.uint32)))
        for at in range(0, len(points) - reach, BLOCK_CHARS):
            piece = points[at:at + BLOCK_CHARS + reach]
            rows.append(row)
            codes.append(piece)
            size += len(piece)
            if size >= BLOCK_CHARS:
                yield rows, codes
                rows, codes, size = [], [], 0
    if rows:
        yield rows, codes


def _ngrams(codes: list[np.ndarray], buckets: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per order the (pieces, buckets) of every n-gram that has a letter at its
    start or, for longer ones, a space followed by a letter; pieces ascend."""
    flat = np.concatenate(codes)
    reach = max(ORDERS) - 1
    lengths = np.array([len(c) for c in codes])
    piece = np.repeat(np.arange(len(codes)), lengths)
    own = np.ones(len(flat), dtype=bool)  # the last characters of a piece only end n-grams
    ends = np.cumsum(lengths)
    for back in range(1, reach + 1):
        own[ends - back] = False
    wide = flat.astype(np.uint64)
    pieces, cells = [], []
    code = np.zeros(len(flat), dtype=np.uint64)
    for n in range(1, reach + 2):
        code = code[:len(flat) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + wide[n - 1:] + np.uint64(n)
        if n in ORDERS:
            first = own[:len(code)] & ((flat[:len(code)] != 32) if n == 1 else
                                       ((flat[:len(code)] != 32) | (flat[1:len(code) + 1] != 32)))
            where = np.flatnonzero(first)
            mixed = code[where]
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            cells.append((mixed >> np.uint64(40)).astype(np.int64) % buckets)
            pieces.append(piece[where])
    return pieces, cells


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
          buckets: int = BUCKETS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages sorted, log priors, log-probability matrix languages x buckets).

    Rows whose language is null are left out. A language whose texts have no
    letter is learned with its prior alone.
    """
    labelled = labelled.where(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for lang in langs:
                docs[lang] = docs.get(lang, 0) + 1
            for rows, codes in _pieces(batch.column("text").to_pylist()):
                names = sorted({langs[r] for r in rows})
                of_piece = np.array([names.index(langs[r]) for r in rows])
                cells = np.zeros(len(names) * buckets, dtype=np.int64)
                for pieces, found in zip(*_ngrams(codes, buckets), strict=True):
                    cells += np.bincount(of_piece[pieces] * buckets + found, minlength=len(cells))
                for i, lang in enumerate(names):
                    part = cells[i * buckets:(i + 1) * buckets]
                    totals[lang] = totals[lang] + part if lang in totals else part
        for lang, n in docs.items():  # bucket -1 counts the documents
            cells = totals.get(lang, np.zeros(buckets, dtype=np.int64))
            some = np.flatnonzero(cells)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(some) + 1)), pa.array(np.append(some, -1), type=pa.int64()),
                 pa.array(np.append(cells[some], n), type=pa.int64())], names=["lang", "bucket", "n"])

    cells = (map_arrow(labelled, count, "lang string, bucket bigint, n bigint")
             .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
             .limit(MAX_LANGUAGES * (buckets + 1) + 1).toArrow())
    if cells.num_rows > MAX_LANGUAGES * (buckets + 1):
        raise ValueError(f"more than {MAX_LANGUAGES} values of {lang_col}: not a language column")
    names = sorted(cells.column("lang").unique().to_pylist())
    prior, counts = np.zeros(len(names)), np.full((len(names), buckets), ALPHA)
    if not names:
        return names, prior, counts
    coded = cells.column("lang").combine_chunks().dictionary_encode()
    place = np.array([names.index(x) for x in coded.dictionary.to_pylist()])
    lang = place[coded.indices.to_numpy(zero_copy_only=False)]
    bucket, n = cells.column("bucket").to_numpy(), cells.column("n").to_numpy()
    prior[lang[bucket < 0]] = n[bucket < 0]
    counts[lang[bucket >= 0], bucket[bucket >= 0]] += n[bucket >= 0]
    return names, np.log(prior / prior.sum()), np.log(counts / counts.sum(axis=1, keepdims=True))


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray],
            id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: id, the columns named in keep, lang_pred, score (posterior), fit.

    ``und`` with score 0 where the text is null or has no letter, or nothing
    was learned. Ties go to the alphabetically first language. fit is the mean
    log-likelihood of the text's n-grams in lang_pred above that of n-grams
    drawn evenly: below 0 the text is in no learned language (null for und).
    """
    names, prior, weights = model
    buckets = weights.shape[1] if len(names) else BUCKETS
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((names, prior, np.ascontiguousarray(weights.T)))
    columns = [id_col, *(c for c in keep if c != id_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, prior, weights = shared.value
        for batch in batches:
            total = np.zeros((batch.num_rows, len(names)))
            ngrams = np.zeros(batch.num_rows, dtype=np.int64)
            for rows, codes in _pieces(batch.column(text_col).to_pylist()) if names else ():
                rows = np.array(rows)
                for pieces, found in zip(*_ngrams(codes, buckets), strict=True):
                    for at in range(0, len(found), step := max(1, GATHERED // len(names))):
                        piece = pieces[at:at + step]
                        first = np.flatnonzero(np.diff(piece, prepend=-1))
                        np.add.at(total, rows[piece[first]],
                                  np.add.reduceat(weights[found[at:at + step]], first, axis=0))
                        np.add.at(ngrams, rows[piece[first]], np.diff(first, append=len(piece)))
            langs, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            fit = np.zeros(batch.num_rows)
            some = np.flatnonzero(ngrams)
            if len(some):
                fit[some] = total[some].max(axis=1) / ngrams[some] + np.log(buckets)
                total = total[some] + prior
                best = total.argmax(axis=1)
                scores[some] = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                for row, lang in zip(some, best, strict=True):
                    langs[row] = names[lang]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(langs), pa.array(scores),
                 pa.array(fit, mask=ngrams == 0)],
                names=[*columns, "lang_pred", "score", "fit"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    return map_arrow(docs.select(*columns, *([text_col] if text_col not in columns else [])),
                     run, f"{kinds}, lang_pred string, score double, fit double")


def fold(id_col: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text, modulo folds; a null id is in fold 0 (held out)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds, F.lit(0))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", keep: tuple[str, ...] = ()) -> DataFrame:
    """Train on the labelled rows outside fold 0, predict every row.

    Per row: id, keep, lang_pred, score, fit, and held_out (its fold is 0).
    """
    model = train(docs.where(fold(id_col) != 0), text_col, lang_col)
    out = predict(docs, model, id_col, text_col, keep)
    return out.withColumn("held_out", fold(id_col) == 0)


def accepted(least_score: float = 0.5) -> Column:
    """Whether a prediction names a language: some letter, a posterior of at
    least ``least_score``, and n-grams likelier in it than evenly drawn ones."""
    return ((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)
            & (F.col("fit") >= 0))
