"""Token-id files: flat unsigned integers, 64-bit document offsets, memory-mapped.

Documents are range-partitioned and sorted by id; each task encodes its part
and streams three little-endian files into the shared folder:

* ``NAME.ids``      the ids, uint16 (vocabularies up to 65,536) or uint32,
* ``NAME.offsets``  n_docs + 1 uint64: where each document starts in the part,
* ``NAME.docs``     n_docs int64: the document ids, null ids first (as 0).

A written table, the manifest, has one row per part in order: its file name,
counts, and its bases (documents and ids of all parts before it), which are
prefix sums over the parts. File names are unique per task attempt and only
those the manifest names count, so a lost or repeated task leaves no trace in
the result. Readers map the files (on stores that cannot be mapped they read
the ranges) in blocks of documents, many tasks to a part.

The tokenizer's file must be openable on every executor. Texts are encoded
with the tokenizers library, one chunk (white space and what follows it up to
the next white space) at a time: no pre-token crosses a chunk, so a chunk's
ids do not depend on its neighbours, and recent chunks' ids are kept. The same
holds for an added token's string without white space, which cuts its chunk;
with added tokens that hold or take in white space, texts are encoded whole.

A block of texts is cut at its spaces and its different words are numbered by
Arrow, so that each is looked up once a block. Of chunks not met before, a word
of one class with punctuation behind it is two pre-tokens of the byte-level
rule, known without its pattern: these go to the library's model as they are.
"""

from __future__ import annotations

import itertools
import operator
import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martflow.llm.shipping import map_arrow
from martflow.llm.textcore import stored
from martflow.session import work_dir

READ_DOCS = 4096      # documents of a reader's block
RECENT = 400_000      # chunks kept in each of two generations, but for those of one block
TOGETHER = 32         # words encoded as one text
LONG = 1 << 20        # characters of a text; a longer one is encoded in pieces
TEXTS = 8             # a block of texts has at most as many times LONG characters

# Unicode's White_Space characters
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNK = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_WORD = re.compile(f" ?[^{_SPACE}]+")
_BESIDE = f"[{_SPACE}] | [{_SPACE}]"

# letters in every version of Unicode, and ASCII's punctuation but for the apostrophe of "it's"
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f\u0410-\u044f"
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_letters() -> str:
    """The byte-level rule's letter for each byte: itself where it can be
    printed, else one from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = itertools.count(256)
    return "".join(chr(b if b in own else next(others)) for b in range(256))


_BYTES = _byte_letters()
_BYTES_IN_LINES = _BYTES.replace(_BYTES[10], "\n")


class ChunkEncoder:
    """Ids of texts as bytes, with the two last generations of chunks kept."""

    def __init__(self, path: str, dtype: str, added_tokens: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # if not added_tokens, the special ones' strings in a text are ordinary text
        self.tokenizer.encode_special_tokens = not added_tokens
        self.whole = any(t.lstrip or t.rstrip or re.search(f"[{_SPACE}]", t.content)
                         for t in self.tokenizer.get_added_tokens_decoder().values()
                         if added_tokens or not t.special)
        self.dtype = np.dtype(dtype)
        line_feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line_feed = line_feed[0] if len(line_feed) == 1 else None
        self.model, self.plain = self._of_plain_words()
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _of_plain_words(self):
        """The library's model behind a cut at line feeds, and the pattern of
        plain words: at most a space, letters or digits or marks, and marks
        behind. The byte-level rule makes a pre-token of each of the two parts.
        None, None with another rule or if an added token can be in such a word."""
        from tokenizers import Tokenizer, pre_tokenizers
        rule = self.tokenizer.pre_tokenizer
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        marks = "".join(m for m in _MARKS if not any(m in content for content in added))
        plain = re.compile(f"[ 0-9{_LETTERS}{re.escape(marks)}]*")
        if (not isinstance(rule, pre_tokenizers.ByteLevel) or not rule.use_regex or rule.add_prefix_space
                or self.tokenizer.normalizer is not None or self.line_feed is None
                or not marks or any(plain.fullmatch(content) for content in added)):
            return None, None
        model = Tokenizer(self.tokenizer.model)
        model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        of = f"[{re.escape(marks)}]"
        return model, re.compile(f"( ?(?:[{_LETTERS}]+|[0-9]+|{of}+))({of}*)")

    def _make_room(self, count: int) -> None:
        """A new generation, if this one cannot take so many chunks more."""
        if len(self.new) + count > RECENT:
            self.old, self.new = self.new, {}

    def _learn(self, wanted: Iterable[str]) -> None:
        """Have the ids of all these chunks in ``new``."""
        unknown = self._not_kept(wanted)
        if self.plain is not None:
            unknown = self._learn_plain(unknown)
        self.new.update(zip(unknown, self._encoded(unknown), strict=True))

    def _not_kept(self, wanted: Iterable[str]) -> list[str]:
        """Those of the chunks that are in neither generation; those of ``old``
        are in ``new`` now."""
        new, old = self.new, self.old
        unknown = []
        for chunk in wanted:
            if chunk not in new:
                ids = old.get(chunk)
                if ids is None:
                    unknown.append(chunk)
                else:
                    new[chunk] = ids
        return unknown

    def _learn_plain(self, chunks: list[str]) -> list[str]:
        """Have the ids of plain words among the chunks, which are not kept, in
        ``new``; the others."""
        ends = [found and found.end(1) for found in map(self.plain.fullmatch, chunks)]
        whole, joined, words, marks, others = [], [], [], [], []
        for chunk, end in zip(chunks, ends, strict=True):
            if end is None:
                others.append(chunk)
            elif end == len(chunk):
                whole.append(chunk)
            else:
                joined.append(chunk)
                words.append(chunk[:end])
                marks.append(chunk[end:])
        self._encode_plain(whole)
        self._encode_plain(self._not_kept({*words, *marks}))
        ids = self.new.__getitem__
        self.new.update(zip(joined, map(operator.add, map(ids, words), map(ids, marks)), strict=True))
        return others

    def _encode_plain(self, words: list[str]) -> None:
        """Have the ids of these pre-tokens in ``new``."""
        ascii_words = [w for w in words if w.isascii()]
        words = [*ascii_words, *(w for w in words if not w.isascii())]
        spelt = "\n".join(ascii_words).replace(" ", _BYTES[32]).split("\n") if ascii_words else []
        if len(ascii_words) < len(words):
            spelt += "\n".join(words[len(ascii_words):]).encode().decode("latin-1").translate(_BYTES_IN_LINES).split("\n")
        between = f"\n{_BYTES[10]}\n"
        texts = [between.join([*spelt[at:at + TOGETHER], ""]) for at in range(0, len(spelt), TOGETHER)]
        made = itertools.chain.from_iterable(self._cut_at_line_feeds(texts, self.model))
        self.new.update(zip(words, made, strict=True))

    def _cut_at_line_feeds(self, texts: list[str], tokenizer) -> Iterator[list[bytes]]:
        """Of each text the ids before each line feed in it."""
        width = self.dtype.itemsize
        for some in itertools.batched(texts, 1024):
            for made in tokenizer.encode_batch_fast(list(some), add_special_tokens=False):
                ids = np.array(made.ids, dtype=self.dtype)
                raw, last, out = ids.tobytes(), 0, []
                for end in (np.flatnonzero(ids == self.line_feed) * width).tolist():
                    out.append(raw[last:end])
                    last = end + width
                yield out

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=self.dtype) for e in self.tokenizer.encode_batch_fast(
            texts, add_special_tokens=False)]

    def _encoded(self, chunks: list[str]) -> Iterator[bytes]:
        """The ids of each chunk. Most chunks are a word behind a space at most:
        these are encoded ``TOGETHER`` to a text, each followed by a line feed,
        whose id ends it (a call and a text have costs of their own)."""
        alone = {c for c in chunks if self.line_feed is None or not _WORD.fullmatch(c)}
        words = [c for c in chunks if c not in alone]
        made = dict(zip(alone, (i.tobytes() for i in self._ids(list(alone))), strict=True))
        groups = [words[at:at + TOGETHER] for at in range(0, len(words), TOGETHER)]
        texts = ["\n".join([*g, ""]) for g in groups]
        for group, ids in zip(groups, self._cut_at_line_feeds(texts, self.tokenizer), strict=True):
            if len(ids) == len(group):
                made.update(zip(group, ids, strict=True))
            else:
                made.update(zip(group, (i.tobytes() for i in self._ids(group)), strict=True))
        return (made[c] for c in chunks)

    def encode(self, texts: Iterable[str]) -> Iterator[Iterable[bytes]]:
        """Of each text in order its ids as bytes, in pieces of bounded size.

        Texts are taken together in blocks; one over ``LONG`` characters is
        taken in pieces and must be consumed before the next is asked for."""
        block: list[str] = []
        size = 0
        for text in texts:
            if self.whole:
                yield [i.tobytes() for i in self._ids([text])]
                continue
            if len(text) > LONG or size + len(text) > TEXTS * LONG:
                yield from self._joined(block)
                block, size = [], 0
            if len(text) > LONG:
                yield self._pieces(text)
            else:
                block.append(text)
                size += len(text)
        yield from self._joined(block)

    def _joined(self, block: list[str]) -> Iterator[list[bytes]]:
        """The ids of each text of a block. A text is its first word (or, if a
        space stands beside white space in it, the whole of it) and the words
        behind a space each; Arrow numbers the different ones."""
        if not block:
            return
        texts = pa.array(block, pa.string())
        odd = pc.match_substring_regex(texts, _BESIDE)
        cut = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        starts = cut.offsets.to_numpy()[:-1]
        behind = np.ones(len(cut.values), dtype=bool)
        behind[starts] = False
        coded = cut.values.filter(pa.array(behind)).dictionary_encode()
        words = [" " + w for w in coded.dictionary.to_numpy(zero_copy_only=False).tolist()]
        # what holds other white space is more than one chunk
        several = [(at, _CHUNK.findall(words[at])) for at in np.flatnonzero(pc.match_substring_regex(
            coded.dictionary, f"[{_SPACE}]").to_numpy(zero_copy_only=False)).tolist()]
        firsts = [_CHUNK.findall(text if whole else text.partition(" ")[0])
                  for text, whole in zip(block, odd.to_pylist(), strict=True)]
        chunks_of = [*firsts, *(chunks for _, chunks in several)]
        self._make_room(len(words) + sum(map(len, chunks_of)))
        made = list(map(self.new.get, words))
        for at, _ in several:
            made[at] = b""
        missing = [at for at, ids in enumerate(made) if ids is None]
        self._learn({words[at] for at in missing}.union(*chunks_of))
        ids = self.new.__getitem__
        for at in missing:
            made[at] = ids(words[at])
        for at, chunks in several:
            made[at] = b"".join(map(ids, chunks))
        made += [b"".join(map(ids, chunks)) for chunks in firsts]

        numbers = np.empty(len(behind), dtype=np.int64)
        numbers[behind] = coded.indices.to_numpy()
        numbers[starts] = np.arange(len(words), len(made))
        sizes = np.fromiter(map(len, made), dtype=np.int64, count=len(made)) // self.dtype.itemsize
        flat = np.frombuffer(b"".join(made), dtype=self.dtype)
        counts = sizes[numbers]
        ends = np.cumsum(counts)
        # an id's place in flat: its place in the block, moved as its word is
        moved = (np.cumsum(sizes) - sizes)[numbers] - (ends - counts)
        raw = flat[np.repeat(moved, counts) + np.arange(ends[-1])].tobytes()
        last = 0
        for end in (ends[np.append(starts[1:], len(numbers)) - 1] * self.dtype.itemsize).tolist():
            yield [raw[last:end]]
            last = end

    def _pieces(self, text: str) -> Iterator[bytes]:
        found = (m.group() for m in _CHUNK.finditer(text))
        while chunks := list(itertools.islice(found, LONG // 8)):
            self._make_room(len(chunks))
            self._learn(set(chunks))
            yield b"".join(map(self.new.__getitem__, chunks))


_encoders: dict[tuple[str, str, bool], ChunkEncoder] = {}


def _encoder(path: str, dtype: str, added_tokens: bool = False) -> ChunkEncoder:
    key = path, dtype, added_tokens
    if key not in _encoders:
        _encoders[key] = ChunkEncoder(*key)
    return _encoders[key]


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def id_type(vocabulary: int, end_id: int | None) -> str:
    return "<u2" if max(vocabulary, (end_id or 0) + 1) <= 1 << 16 else "<u4"


def write_ids(docs: DataFrame, tokenizer_file: str, vocabulary: int, end_id: int | None = 2,
              folder: str | None = None, id_col: str = "doc_id", text_col: str = "text",
              added_tokens: bool = False) -> DataFrame:
    """Write docs as id files into folder (a fresh one in the shared work
    folder by default); returns the manifest: part, name (path without
    ending), dtype, n_docs, n_nulls, n_ids, base_docs, base_ids.

    Every row is one document, in ascending id order (null ids first, equal
    ids by their text's hash); a null or empty text has only the end id. With
    added_tokens the string of a special token in a text is that token, as the
    library has it by default; without, it is ordinary text.
    """
    spark = docs.sparkSession
    folder = folder or work_dir(spark, "ids")
    dtype = id_type(vocabulary, end_id)
    schema = pa.schema([("part", pa.int32()), ("name", pa.string()), ("n_docs", pa.int64()),
                        ("n_nulls", pa.int64()), ("n_ids", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        part = TaskContext.get().partitionId()
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex[:12]}"
        encoder = _encoder(tokenizer_file, dtype, added_tokens)
        end = b"" if end_id is None else np.array([end_id], dtype=dtype).tobytes()
        store, path = _store(name)
        store.create_dir(os.path.dirname(path), recursive=True)
        n_docs = n_nulls = n_ids = 0
        with (store.open_output_stream(f"{path}.ids") as ids,
              store.open_output_stream(f"{path}.offsets") as offsets,
              store.open_output_stream(f"{path}.docs") as names):
            while first is not None:
                lengths = np.zeros(first.num_rows, dtype="<u8")
                texts = (text or "" for text in first.column("text").to_pylist())
                for row, pieces in enumerate(encoder.encode(texts)):
                    size = len(end)
                    for piece in pieces:
                        ids.write(piece)
                        size += len(piece)
                    ids.write(end)
                    lengths[row] = size // np.dtype(dtype).itemsize
                starts = np.cumsum(lengths) - lengths + np.uint64(n_ids)
                offsets.write(starts.astype("<u8").tobytes())
                keys = first.column("id")
                names.write(keys.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                n_docs, n_nulls = n_docs + first.num_rows, n_nulls + keys.null_count
                n_ids += int(lengths.sum())
                first = next((b for b in batches if b.num_rows), None)
            offsets.write(np.array([n_ids], dtype="<u8").tobytes())
        yield pa.RecordBatch.from_pylist([dict(zip(
            schema.names, (part, name, n_docs, n_nulls, n_ids), strict=True))], schema=schema)

    ordered = (docs.select(F.col(id_col).cast("bigint").alias("id"),
                           F.col(text_col).cast("string").alias("text"))
               .withColumn("h", F.xxhash64("text"))
               .repartitionByRange("id", "h").sortWithinPartitions("id", "h").select("id", "text"))
    parts = stored(map_arrow(ordered, write, "part int, name string, n_docs bigint, "
                             "n_nulls bigint, n_ids bigint"), "parts")
    # one row per part: a task adds them up
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return stored(parts.select(
        "part", "name", F.lit(dtype).alias("dtype"), "n_docs", "n_nulls", "n_ids",
        F.coalesce(F.sum("n_docs").over(before), F.lit(0)).alias("base_docs"),
        F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base_ids")), "manifest")


def _mapped(name: str, ending: str, dtype: str, start: int, count: int) -> np.ndarray:
    """count numbers of a file from start on, mapped where the store can."""
    if not count:
        return np.empty(0, dtype=dtype)
    store, path = _store(name + ending)
    size = np.dtype(dtype).itemsize
    if isinstance(store, pafs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r", offset=start * size, shape=(count,))
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read_at(count * size, start * size), dtype=dtype)


def read_ids(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32 (of its ids as little-endian uint32)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                name, first, count = row["name"], row["first"], row["count"]
                at = _mapped(name, ".offsets", "<u8", first, count + 1).astype(np.int64)
                keys = np.array(_mapped(name, ".docs", "<i8", first, count))
                ids = _mapped(name, ".ids", row["dtype"], int(at[0]), int(at[-1] - at[0]))
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes())
                       for a, b in zip(at[:-1] - at[0], at[1:] - at[0], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, mask=np.arange(first, first + count) < row["n_nulls"]),
                     pa.array(at[:-1] + row["base_ids"]), pa.array(np.diff(at)),
                     pa.array(crc, type=pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    spark = manifest.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    blocks = manifest.where("n_docs > 0").select(
        "name", "dtype", "n_nulls", "base_ids", "n_docs",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_docs") - 1, F.lit(READ_DOCS).cast("bigint"))).alias("first"))
    blocks = blocks.select("name", "dtype", "n_nulls", "base_ids", "first",
                           F.least(F.lit(READ_DOCS), F.col("n_docs") - F.col("first")).alias("count"))
    # rows of a few bytes that stand for megabytes: dealt evenly, not merged by size
    return map_arrow(blocks.repartition(tasks), read,
                     "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
