"""Byte-level BPE encoding and decoding with the tiktoken library.

The vocabulary is a local rank file (a parameter; every executor must be able
to open the path, e.g. a package data file or a file shipped with the job).
Long texts are cut in front of white space that follows a character which is
none: no match of the split pattern runs across such a place and no match in
front of it looks further, so the parts encode as the whole text would. Every
text is encoded and decoded part by part, so memory holds the ids of one part.

A run of white space that is longer than a part has no such place, and the
pattern's look-ahead tries each of its lengths. All of it but the last
character (all of it at the text's end) is one match of the pattern, so it is
a part of its own, encoded as one piece without the pattern.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from martflow.llm.shipping import map_arrow

PART_CHARS = 1 << 16
SPACES_APART = 1 << 12  # white space parts beyond this are encoded as one piece

# a white space character whose predecessor is none (Unicode white space, as a character class)
_SAFE = regex.compile(r"(?<=[^\s\x1c-\x1f\x85])(?=[\t\n\r ])")

_SPACES = regex.compile(r"\p{White_Space}++")
_WHOLE = r"(?s:.+)"  # a pattern whose one match is the whole text

_loaded: dict[tuple[str, str], tiktoken.Encoding] = {}


def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, loaded once per process."""
    if (path, pattern) not in _loaded:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _loaded[path, pattern] = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path, pattern]


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """text cut at safe places into parts of about size characters; a run
    without a safe place stays whole, but for runs of white space."""
    at = 0
    while len(text) - at > size:
        cut = _SAFE.search(text, at + size)
        end = cut.start() if cut else len(text)
        yield from _apart(text[at:end], end == len(text), size)
        at = end
    if at < len(text) or not text:
        yield text[at:] if at else text


def _apart(part: str, last: bool, size: int) -> Iterator[str]:
    """part with its runs of white space of over size characters apart; last:
    the text ends with it (else a space character follows, after none)."""
    at = 0
    if len(part) > 2 * size:
        for run in _SPACES.finditer(part):
            if run.end() - run.start() > size:
                end = run.end() if last and run.end() == len(part) else run.end() - 1
                if run.start() > at:
                    yield part[at:run.start()]
                yield part[run.start():end]
                at = end
    if at < len(part):
        yield part[at:]


def part_ids(part: str, rank_file: str, pattern: str) -> list[int]:
    """The ids of one of a text's parts."""
    if len(part) > SPACES_APART and _SPACES.fullmatch(part):
        return encoding(rank_file, _WHOLE).encode_ordinary(part)
    return encoding(rank_file, pattern).encode_ordinary(part)


def _per_text(visit: Callable, columns: list[str], schema: pa.Schema, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [visit(t or "") for t in batch.column(text_col).to_pylist()]
            made = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in columns]
                + [pa.array(list(v), type=f.type) for v, f in zip(made, schema, strict=True)],
                names=columns + schema.names)
    return run


def encode_digests(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id",
                   text_col: str = "text", part_chars: int = PART_CHARS) -> DataFrame:
    """Per row: id, n_tokens, and the digests of its ids and of the decoded bytes.

    A null or empty text has no tokens and the digests of the empty string.
    Repeated rows and null ids are each returned as they come.
    """
    def visit(text: str) -> tuple[int, str, str]:
        enc = encoding(rank_file, pattern)
        n, of_ids, of_bytes = 0, hashlib.sha256(), hashlib.sha256()
        for part in parts(text, part_chars):
            ids = part_ids(part, rank_file, pattern)
            if ids:
                of_ids.update((" " * (n > 0) + " ".join(map(str, ids))).encode())
                of_bytes.update(enc.decode_bytes(ids))
                n += len(ids)
        return n, of_ids.hexdigest(), of_bytes.hexdigest()

    schema = pa.schema([("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                        ("decoded_sha256", pa.string())])
    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(
        docs.select(id_col, text_col), _per_text(visit, [id_col], schema, text_col),
        f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text", part_chars: int = PART_CHARS) -> DataFrame:
    """Per row: id and ids array<int>; a null text gives an empty array."""
    def visit(text: str) -> tuple[list[int]]:
        return ([i for part in parts(text, part_chars) for i in part_ids(part, rank_file, pattern)],)

    kind = docs.schema[id_col].dataType.simpleString()
    return map_arrow(
        docs.select(id_col, text_col),
        _per_text(visit, [id_col], pa.schema([("ids", pa.list_(pa.int32()))]), text_col),
        f"`{id_col}` {kind}, ids array<int>")


def decode(tokens: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """Per row: id and the decoded raw bytes (not necessarily valid UTF-8 for
    ids that cut a character); null ids give empty bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        for batch in batches:
            out = [enc.decode_bytes(ids or []) for ids in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col), pa.array(out, type=pa.binary())], names=[id_col, "bytes"])

    kind = tokens.schema[id_col].dataType.simpleString()
    return map_arrow(tokens.select(id_col, ids_col), run, f"`{id_col}` {kind}, bytes binary")
