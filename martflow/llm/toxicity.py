"""Toxic spans and documents: a linear-chain conditional random field.

Tokens are runs of letters in lower case. The field has two states (toxic or
not); a token's features are its word, its prefixes of 3 to 6 letters, its
ending and its neighbours, hashed to ``DIM`` weights. Forward-backward gives
each token's marginal; a whole block of texts is one chain, cut into columns
whose 2 x 2 transfer matrices are multiplied side by side, with a reset at each
text's first token, so marginals are exact and no Python loop runs over tokens.
Tokens of a marginal of 1/2 or more are tagged; adjacent ones make a span. A
text of more than ``SEQUENCE`` code points is several sequences, cut between
words, that count together.

Labels are on documents, so the labelled tokens are derived from them: words
and prefixes that many toxic documents have and hardly any other (near copies
count once) mark the tokens of toxic documents; the tokens of the others are
not toxic. The field is fitted to windows around marked tokens and to windows
of the others, a logistic regression maps a document's marginals to its score.
Fitting uses a sample of about ``ROWS`` labelled rows, chosen by a hash of the
id (all, if fewer); scoring covers every token of every text.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.langid import fold
from martflow.llm.shipping import map_arrow
from martflow.llm.textcore import _tables, mix, stored

ROWS = 1 << 14        # labelled rows that the model is fitted to, about
DIM = 1 << 18         # weights
PREFIXES = (3, 4, 5, 6)
MARKING = (4, 5, 6)   # prefixes that can mark a token, besides its word
LEAST_DOCS = 5        # toxic documents that a marking word or prefix is in ...
LEAST_SHARE = 0.002   # ... and their share of the toxic ones
PRECISION = 0.9       # share of toxic documents among those that it is in
MINIMA = 8            # minimum hashes by which copies of a labelled text are told
WINDOW = 24           # tokens of a training window
CLEAN_WINDOWS = 2     # windows of a labelled document that is not toxic
SEQUENCE = 1 << 18
BLOCK = 1 << 20       # code points of a block
STEPS = 128           # tokens of a column of a block
EPOCHS = 6
BATCH = 512

_MULT = np.uint64(0x9E3779B97F4A7C15)
_folded: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Code point -> its lower-case letter, 0 if it is no letter."""
    global _folded
    if _folded is None:
        def lower(c: str) -> int:
            if unicodedata.category(c)[0] != "L":
                return 0
            small = c.lower()
            return ord(small) if len(small) == 1 else ord(c)
        _folded = np.fromiter((lower(chr(c)) for c in range(0x110000)), dtype=np.uint32, count=0x110000)
    return _folded


@dataclass
class Tokens:
    """The tokens of a block of sequences, in order."""
    row: np.ndarray       # of the batch
    first: np.ndarray     # whether the token starts a sequence
    start: np.ndarray     # in the text, in code points
    length: np.ndarray
    word: np.ndarray      # hashes; 0 where there is none
    prefix: dict[int, np.ndarray]
    ending: np.ndarray

    def marking(self) -> np.ndarray:
        """(tokens x kinds) hashes of what can mark a token."""
        return np.stack([self.word, *(self.prefix[k] for k in MARKING)], axis=1)

    def features(self) -> np.ndarray:
        """(tokens x features) weights that apply; weight 0 stands for none."""
        before = np.where(self.first, np.uint64(0), np.roll(self.word, 1))
        after = np.where(np.roll(self.first, -1), np.uint64(0), np.roll(self.word, -1))
        found = np.stack([self.word, *self.prefix.values(), self.ending, before, after], axis=1)
        salt = np.arange(1, found.shape[1] + 1, dtype=np.uint64) * _MULT
        return np.where(found == 0, 0, 1 + mix(found + salt) % np.uint64(DIM - 1)).astype(np.int32)


def _blocks(texts: list[str | None]) -> Iterator[Tokens]:
    """The tokens of texts, block by block; a text's sequences ascend."""
    table = _letters()
    rows, offsets, pieces, size = [], [], [], 0
    for row, text in enumerate(texts):
        if not text:
            continue
        codes = table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        at = 0
        while at < len(codes):
            end = at + SEQUENCE
            if end < len(codes):
                while end < len(codes) and codes[end]:
                    gap = np.flatnonzero(codes[end:end + SEQUENCE] == 0)
                    end += int(gap[0]) if len(gap) else SEQUENCE
            rows.append(row)
            offsets.append(at)
            pieces.append(codes[at:end])
            size += len(pieces[-1]) + 1
            at = end
            if size >= BLOCK:
                yield _tokens(rows, offsets, pieces)
                rows, offsets, pieces, size = [], [], [], 0
    if rows:
        yield _tokens(rows, offsets, pieces)


def _tokens(rows: list[int], offsets: list[int], pieces: list[np.ndarray]) -> Tokens:
    none = np.zeros(1, dtype=np.uint32)
    flat = np.concatenate([x for p in pieces for x in (p, none)])
    edges = np.flatnonzero(np.diff((flat != 0).astype(np.int8), prepend=0, append=0))
    start, end = edges[::2], edges[1::2]
    length = end - start
    begins = np.cumsum([0] + [len(p) + 1 for p in pieces])
    piece = np.searchsorted(begins, start, side="right") - 1
    power, inverse = _tables(len(flat) + 1)
    wide = flat.astype(np.uint64)
    sums = np.zeros(len(flat) + 1, dtype=np.uint64)
    np.cumsum(wide * power[:len(flat)], out=sums[1:])
    word = mix((sums[end] - sums[start]) * inverse[start] + length.astype(np.uint64)) | np.uint64(1)
    prefix, code = {}, np.zeros(len(start), dtype=np.uint64)
    for k in range(1, max(PREFIXES) + 1):
        code = code * _MULT + wide[np.minimum(start + k - 1, len(flat) - 1)]
        if k in PREFIXES:
            prefix[k] = np.where(length >= k, mix(code + np.uint64(k)) | np.uint64(1), np.uint64(0))
    ending = np.zeros(len(start), dtype=np.uint64)
    for k in (3, 2, 1):
        ending = ending * _MULT + wide[np.maximum(end - k, start)]
    return Tokens(np.array(rows)[piece], np.diff(piece, prepend=-1) != 0,
                  start - begins[piece] + np.array(offsets)[piece], length, word, prefix,
                  mix(ending) | np.uint64(1))


@dataclass
class Model:
    weights: np.ndarray      # of the features, for the toxic state
    moves: np.ndarray        # log-potentials (start to toxic, 01, 10, 11)
    document: np.ndarray     # the regression's coefficients

    @property
    def learned(self) -> bool:
        return len(self.document) > 0


def _potentials(emission: np.ndarray, first: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """(2, 2, tokens): the transfer matrix into each token; that of a first
    token has equal rows, so nothing passes it in either direction."""
    lifted = np.exp(np.clip(emission, -30, 30))
    start, up, down, stay = np.exp(moves)
    one = np.ones(len(emission))
    return np.stack([np.stack([one, np.where(first, start, up) * lifted]),
                     np.stack([np.where(first, 1.0, down), np.where(first, start, stay) * lifted])])


def marginals(emission: np.ndarray, first: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Each token's probability of the toxic state, by forward-backward."""
    n = len(emission)
    if not n:
        return np.empty(0)
    columns = -(-n // STEPS)
    pad = columns * STEPS - n
    m = _potentials(np.append(emission, np.zeros(pad)), np.append(first, np.ones(pad, dtype=bool)), moves)
    m = np.ascontiguousarray(m.reshape(2, 2, columns, STEPS).transpose(3, 0, 1, 2))  # step, from, to, column
    whole = np.zeros((2, 2, columns))
    whole[0, 0] = whole[1, 1] = 1
    for step in m:
        whole = np.stack([whole[:, 0] * step[0, 0] + whole[:, 1] * step[1, 0],
                          whole[:, 0] * step[0, 1] + whole[:, 1] * step[1, 1]], axis=1)
        whole /= whole.sum(axis=(0, 1))
    ahead, behind = np.empty((2, columns)), np.empty((2, columns))
    a0, a1, b0, b1 = 0.5, 0.5, 0.5, 0.5
    w = whole.transpose(2, 0, 1).reshape(columns, 4).tolist()
    for c, (w00, w01, w10, w11) in enumerate(w):
        ahead[0, c], ahead[1, c] = a0, a1
        a0, a1 = a0 * w00 + a1 * w10, a0 * w01 + a1 * w11
        a0, a1 = a0 / (a0 + a1), a1 / (a0 + a1)
    for c in range(columns - 1, -1, -1):
        w00, w01, w10, w11 = w[c]
        behind[0, c], behind[1, c] = b0, b1
        b0, b1 = w00 * b0 + w01 * b1, w10 * b0 + w11 * b1
        b0, b1 = b0 / (b0 + b1), b1 / (b0 + b1)
    forward = np.empty((STEPS, 2, columns))
    for j, step in enumerate(m):
        ahead = np.stack([ahead[0] * step[0, 0] + ahead[1] * step[1, 0],
                          ahead[0] * step[0, 1] + ahead[1] * step[1, 1]])
        ahead /= ahead.sum(axis=0)
        forward[j] = ahead
    out = np.empty((STEPS, columns))
    for j in range(STEPS - 1, -1, -1):
        on, off = forward[j, 1] * behind[1], forward[j, 0] * behind[0]
        out[j] = on / (on + off)
        step = m[j]
        behind = np.stack([step[0, 0] * behind[0] + step[0, 1] * behind[1],
                           step[1, 0] * behind[0] + step[1, 1] * behind[1]])
        behind /= behind.sum(axis=0)
    return out.T.ravel()[:n]


def fit_field(features: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, rate: float = 0.3,
              decay: float = 1e-6) -> tuple[np.ndarray, np.ndarray]:
    """(weights, moves) of windows: features (windows x tokens x kinds, weight
    0 for none) and labels (windows x tokens: 0, 1 or -1 behind the end).
    Adaptive gradient steps over batches of windows, the same for the same input."""
    weights, moves = np.zeros(DIM), np.zeros(4)
    of_weights, of_moves = np.full(DIM, 1e-6), np.full(4, 1e-6)
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            x, y = features[pick], labels[pick]
            inside = y >= 0
            first = np.zeros(y.shape, dtype=bool)
            first[:, 0] = True
            first |= ~inside
            emission = weights[x].sum(axis=2)
            m = _potentials(emission.ravel(), first.ravel(), moves).reshape(2, 2, *y.shape)
            ahead, behind = np.empty((2, *y.shape)), np.empty((2, *y.shape))
            a = np.full((2, len(pick)), 0.5)
            for t in range(y.shape[1]):
                a = np.einsum("in,ijn->jn", a, m[..., t])
                a /= a.sum(axis=0)
                ahead[..., t] = a
            b = np.full((2, len(pick)), 0.5)
            for t in range(y.shape[1] - 1, -1, -1):
                behind[..., t] = b
                b = np.einsum("ijn,jn->in", m[..., t], b)
                b /= b.sum(axis=0)
            both = ahead * behind
            toxic = both[1] / both.sum(axis=0)
            pair = ahead[:, None, :, :-1] * m[..., 1:] * behind[None, :, :, 1:]
            pair /= pair.sum(axis=(0, 1))
            linked = ~first[:, 1:]
            was, now = y[:, :-1], y[:, 1:]
            short = np.where(inside, y - toxic, 0.0)
            steps = np.array([short[:, 0].sum(), *(
                (((was == i) & (now == j)) - pair[i, j])[linked].sum() for i, j in ((0, 1), (1, 0), (1, 1)))])
            grad = np.bincount(x.ravel(), np.repeat(short.ravel(), x.shape[2]), DIM) / len(pick)
            grad[0] = 0
            grad -= decay * weights
            of_weights += grad * grad
            weights += rate * grad / np.sqrt(of_weights)
            steps = steps / len(pick) - decay * moves
            of_moves += steps * steps
            moves += rate * steps / np.sqrt(of_moves)
    return weights, moves


def fit_document(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Coefficients of a logistic regression (the first is the constant)."""
    x = np.column_stack([np.ones(len(x)), x])
    c = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        grad = x.T @ (y - p) - ridge * len(x) * c
        c = c + np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge * len(x) * np.eye(len(c)), grad)
    return c


def _summary(tagged: np.ndarray, top: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What the regression sees of a document: tagged tokens (sum of their
    marginals), largest marginal, tokens."""
    return np.column_stack([np.log1p(tagged), top, np.log1p(n)])


def _tagged(batch: pa.RecordBatch, column: str, weights: np.ndarray, moves: np.ndarray):
    """(sum of tagged marginals, largest marginal, tokens) per row, and the
    spans (row, start, end) of adjacent tagged tokens."""
    tagged, top, n = (np.zeros(batch.num_rows) for _ in range(3))
    spans = []
    for t in _blocks(batch.column(column).to_pylist()):
        p = marginals(weights[t.features()].sum(axis=1), t.first, moves)
        on = p >= 0.5
        np.add.at(n, t.row, 1)
        np.maximum.at(top, t.row, p)
        np.add.at(tagged, t.row[on], p[on])
        opens = on & (t.first | ~np.roll(on, 1) | (np.arange(len(on)) == 0))
        closes = on & (np.roll(t.first, -1) | ~np.roll(on, -1) | (np.arange(len(on)) == len(on) - 1))
        spans.append((t.row[opens], t.start[opens], (t.start + t.length)[closes]))
    joined = [np.concatenate(x) if spans else np.empty(0, dtype=np.int64) for x in
              (zip(*spans, strict=True) if spans else ((), (), ()))]
    return tagged, top, n, joined


def _minima(batch: pa.RecordBatch) -> list[list[int]]:
    """Per row the least hash of its word pairs under several hash functions."""
    salt = np.arange(1, MINIMA + 1, dtype=np.uint64)[:, None] * _MULT
    least = np.full((MINIMA, batch.num_rows), np.iinfo(np.uint64).max)
    for t in _blocks(batch.column("text").to_pylist()):
        pair = mix(t.word * _MULT + np.where(t.first, np.uint64(0), np.roll(t.word, 1)))
        cuts = np.flatnonzero(np.diff(t.row, prepend=-1))
        if len(cuts):
            own = np.minimum.reduceat(mix(pair[None, :] ^ salt), cuts, axis=1)
            least[:, t.row[cuts]] = np.minimum(least[:, t.row[cuts]], own)
    return least.T.view(np.int64).tolist()


def _sample(labelled: DataFrame, rows: int) -> DataFrame:
    """(key, text, toxic) of about ``rows`` rows of (id, text, toxic), one of each group of copies."""
    total = labelled.count()
    if total > rows:
        labelled = labelled.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(rows / total * (1 << 20)))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(_minima(batch), type=pa.list_(pa.int64()))],
                names=["key", "text", "toxic", "least"])

    keyed = labelled.select(F.xxhash64("id", "text").alias("key"), "text", "toxic").dropDuplicates(["key"])
    read = stored(map_arrow(keyed, sketch, "key bigint, text string, toxic int, least array<bigint>"), "labelled")
    lists = read.select("key", F.posexplode("least").alias("place", "value"))
    first = lists.groupBy("place", "value").agg(F.min("key").alias("low"))
    kept = (lists.join(first, ["place", "value"]).groupBy("key").agg(F.min("low").alias("low"))
            .where("key = low").select("key"))
    return stored(read.drop("least").join(kept, "key", "left_semi"), "labelled")


def _having(rows: DataFrame, known: np.ndarray | None) -> DataFrame:
    """(mark, n): the documents that have each word or prefix (of the known ones)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for t in _blocks(batch.column("text").to_pylist()):
                marks = t.marking()
                some = marks != 0 if known is None else np.isin(marks, known)
                own = np.repeat(t.row, marks.shape[1]).reshape(marks.shape)[some]
                pairs = np.unique(np.stack([own.astype(np.uint64), marks[some]]), axis=1)
                found.append(pairs)
            if found:
                marks = np.unique(np.concatenate(found, axis=1), axis=1)[1]
                mark, n = np.unique(marks, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(mark.view(np.int64)), pa.array(n)], names=["mark", "n"])
    return map_arrow(rows.select("text"), run, "mark bigint, n bigint").groupBy("mark").agg(F.sum("n").alias("n"))


def _marks(sample: DataFrame, n_toxic: int) -> np.ndarray:
    """The marking words and prefixes, ascending. Those that many toxic rows
    have are at most as many as a row has on average, over LEAST_SHARE."""
    least = max(LEAST_DOCS, LEAST_SHARE * n_toxic)
    often = _having(sample.where("toxic = 1"), None).where(F.col("n") >= least).toPandas()
    known = np.sort(often["mark"].to_numpy(dtype=np.int64)).view(np.uint64)
    clean = _having(sample.where("toxic = 0"), known).toPandas()
    others = clean.set_index("mark")["n"].reindex(often["mark"]).fillna(0).to_numpy()
    n = often["n"].to_numpy()
    return np.sort(often["mark"].to_numpy(dtype=np.int64)[n >= PRECISION * (n + others)].view(np.uint64))


def _windows(sample: DataFrame, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the training windows."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = np.array(batch.column("toxic").to_pylist(), dtype=bool)
            keys = np.array(batch.column("key").to_pylist(), dtype=np.int64).view(np.uint64)
            made_x, made_y = [], []
            for t in _blocks(batch.column("text").to_pylist()):
                marked = np.isin(t.marking(), marks).any(axis=1) & toxic[t.row]
                cuts = np.append(np.flatnonzero(np.diff(t.row, prepend=-1)), len(t.row))
                features = t.features()
                for low, high in zip(cuts, cuts[1:], strict=False):
                    row, n = t.row[low], -(-(high - low) // WINDOW)
                    if toxic[row]:
                        chosen = np.unique((np.flatnonzero(marked[low:high])) // WINDOW)
                    else:
                        draws = mix(keys[row] + np.arange(CLEAN_WINDOWS, dtype=np.uint64))
                        chosen = np.unique(draws % np.uint64(n)).astype(np.int64)
                    for w in chosen:
                        at = slice(low + w * WINDOW, min(low + (w + 1) * WINDOW, high))
                        made_x.append(features[at].tobytes())
                        made_y.append(marked[at].astype(np.int8).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(made_x, type=pa.binary()), pa.array(made_y, type=pa.binary())],
                                             names=["x", "y"])
    got = map_arrow(sample, cut, "x binary, y binary").sort("x", "y").toArrow()
    kinds = 3 + len(PREFIXES) + 1
    x = np.zeros((got.num_rows, WINDOW, kinds), dtype=np.int32)
    y = np.full((got.num_rows, WINDOW), -1, dtype=np.int8)
    for i, (a, b) in enumerate(zip(got.column("x").to_pylist(), got.column("y").to_pylist(), strict=True)):
        x[i, :len(b)] = np.frombuffer(a, dtype=np.int32).reshape(-1, kinds)
        y[i, :len(b)] = np.frombuffer(b, dtype=np.int8)
    return x, y


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          rows: int = ROWS) -> Model:
    """The model of labelled rows (label 1 or 0; others are left out). Without
    rows of both labels, or words that mark the toxic ones, nothing is learned."""
    labelled = labelled.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                               F.col(label_col).cast("int").alias("toxic")).where("toxic in (0, 1)")
    sample = _sample(labelled, rows)
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    nothing = Model(np.zeros(DIM), np.zeros(4), np.empty(0))
    if len(n) < 2:
        return nothing
    marks = _marks(sample, n[1])
    x, y = _windows(sample, marks)
    if not (y == 1).any():
        return nothing
    weights, moves = fit_field(x, y)
    shared = sample.sparkSession.sparkContext.broadcast((weights, moves))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tagged, top, size, _ = _tagged(batch, "text", *shared.value)
            yield pa.RecordBatch.from_arrays([pa.array(tagged), pa.array(top), pa.array(size),
                                              batch.column("toxic")], names=["tagged", "top", "n", "toxic"])
    seen = map_arrow(sample.select("text", "toxic"), summed,
                     "tagged double, top double, n double, toxic int").toPandas()
    return Model(weights, moves, fit_document(
        _summary(*(seen[c].to_numpy() for c in ("tagged", "top", "n"))), seen["toxic"].to_numpy(dtype=float)))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, score (0 to 1, higher: likelier toxic), predicted (1 from a
    score of 1/2), n_toxic (tagged tokens' marginals, summed) and spans, the
    tagged stretches as array<struct<start, end>> in code points.

    Null and empty texts and those without a letter are scored as documents
    without tokens; every row is returned, repeated ones too. If nothing was
    learned, every score is 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            model = shared.value
            if model.learned:
                tagged, top, n, (row, start, end) = _tagged(batch, text_col, model.weights, model.moves)
                x = np.column_stack([np.ones(len(n)), _summary(tagged, top, n)])
                score = 1 / (1 + np.exp(-np.clip(x @ model.document, -30, 30)))
            else:
                tagged = score = np.zeros(batch.num_rows)
                row = start = end = np.empty(0, dtype=np.int64)
            offsets = np.searchsorted(row, np.arange(batch.num_rows + 1))
            spans = pa.ListArray.from_arrays(
                pa.array(offsets, type=pa.int32()),
                pa.StructArray.from_arrays([pa.array(start, type=pa.int64()), pa.array(end, type=pa.int64())],
                                           names=["start", "end"]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(score), pa.array((score >= 0.5).astype(np.int32)),
                 pa.array(tagged), spans], names=[id_col, "score", "predicted", "n_toxic", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(docs.select(id_col, text_col), run,
                     f"`{id_col}` {kind}, score double, predicted int, n_toxic double, "
                     "spans array<struct<start: bigint, end: bigint>>")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", rows: int = ROWS) -> DataFrame:
    """Train on the labelled rows outside fold 0, score every row: the columns
    of ``predict`` and held_out (its fold is 0). An id labelled several times
    is toxic if one label says so; null ids are unlabelled and held out."""
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("toxic"))
             .groupBy("id").agg(F.max("toxic").alias("toxic")))
    read = docs.where(fold(id_col) != 0).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    model = train(read.join(known, "id"), "id", "text", "toxic", rows)
    return predict(docs, model, id_col, text_col).withColumn("held_out", fold(id_col) == 0)
