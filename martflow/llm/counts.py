"""Edit-aware token counts: a segment tree of pre-token segments per document.

A document is cut at safe places (see ``bpe.parts``) into leaves of about
``LEAF`` characters, whose token counts add up to the document's. A segment
tree holds the sums of characters and tokens, so a place is found and a count
is updated in logarithmic steps. An edit re-encodes the leaves it touches and,
where it disturbs a leaf's edge, the neighbour that the edge belongs to.

``token_trees`` counts documents once and returns their trees' leaves as
columns, which can be stored; ``edited`` takes them, applies edits without
encoding what they leave alone, and returns the new texts and leaves.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.bpe import part_ids, parts
from martflow.llm.shipping import map_arrow

LEAF = 256
_AFTER = frozenset("\t\n\r ")


def _cut_between(before: str, after: str) -> bool:
    """Whether no token can run across: white space after a character that is none."""
    return after in _AFTER and not (before.isspace() or before in "\x1c\x1d\x1e\x1f\x85")


class TokenTree:
    """Counts of one text; ``apply`` keeps them right."""

    def __init__(self, texts: list[str], tokens: list[int] | None, count):
        """texts are the leaves; tokens their counts, encoded now if None."""
        self.count, self.encoded = count, 0
        self.texts = texts or [""]
        tokens = [self._counted(t) for t in self.texts] if tokens is None else tokens or [0]
        self.width = 1 << max(0, len(self.texts) - 1).bit_length()
        self.chars = [0] * (2 * self.width)
        self.tokens = [0] * (2 * self.width)
        self.chars[self.width:self.width + len(self.texts)] = map(len, self.texts)
        self.tokens[self.width:self.width + len(self.texts)] = tokens
        for node in range(self.width - 1, 0, -1):
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @classmethod
    def build(cls, text: str, count, leaf: int = LEAF) -> TokenTree:
        return cls(list(parts(text, leaf)), None, count)

    @classmethod
    def restore(cls, text: str, chars: list[int], tokens: list[int], count) -> TokenTree:
        """The tree of stored leaves: nothing is encoded."""
        ends = list(itertools.accumulate(chars))
        return cls([text[e - n:e] for e, n in zip(ends, chars, strict=True)], list(tokens), count)

    def leaves(self) -> tuple[list[int], list[int]]:
        """(characters, tokens) of the leaves that hold text."""
        at = [self.width + i for i, t in enumerate(self.texts) if t]
        return [self.chars[i] for i in at], [self.tokens[i] for i in at]

    def _counted(self, text: str) -> int:
        self.encoded += len(text)
        return sum(self.count(part) for part in parts(text)) if text else 0

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.texts)

    def _find(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at place (the last one at the
        end) and where the leaf starts."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if place >= start + self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        return node - self.width, start

    def _set(self, i: int, text: str, tokens: int) -> None:
        self.texts[i] = text
        node = self.width + i
        chars, tokens = len(text) - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += chars
            self.tokens[node] += tokens
            node //= 2

    def apply(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace the characters start to end (exclusive) by new, for each
        (start, end, new) in places of the text as it is. Edits that touch the
        same leaves are made together; an edit that overlaps an earlier one
        (by start, then as listed) begins where that ends."""
        size, done, groups = self.chars[1], 0, []
        for start, end, new in sorted(edits, key=lambda e: e[0]):
            start = max(min(max(start, 0), size), done)
            done = end = max(min(end, size), start)
            low, at = self._find(start)
            high = self._find(max(end - 1, start))[0]
            if groups and low <= groups[-1][1]:
                groups[-1][1] = max(high, groups[-1][1])
                groups[-1][3].append((start, end, new))
            else:
                groups.append([low, high, at, [(start, end, new)]])
        for low, high, at, own in reversed(groups):  # places in front stay as they were
            old, made, last = "".join(self.texts[low:high + 1]), [], 0
            for start, end, new in own:
                made += [old[last:start - at], new]
                last = end - at
            self._replace(low, high, "".join(made) + old[last:])

    def _replace(self, low: int, high: int, text: str) -> None:
        """The leaves low to high become one leaf of this text, together with
        the neighbours that its edges are not safe against."""
        while True:
            before = next((i for i in range(low - 1, -1, -1) if self.texts[i]), None)
            after = next((i for i in range(high + 1, len(self.texts)) if self.texts[i]), None)
            if before is not None and not (text and _cut_between(self.texts[before][-1], text[0])):
                low, text = before, self.texts[before] + text
            elif after is not None and not (text and _cut_between(text[-1], self.texts[after][0])):
                high, text = after, text + self.texts[after]
            else:
                break
        for i in range(low + 1, high + 1):
            if self.texts[i]:
                self._set(i, "", 0)
        self._set(low, text, self._counted(text))


EDITS = "array<struct<start:bigint,end:bigint,new:string>>"


def _counter(rank_file: str, pattern: str) -> Callable[[str], int]:
    return lambda text: len(part_ids(text, rank_file, pattern))


def token_trees(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id",
                text_col: str = "text", keep: tuple[str, ...] = (), leaf: int = LEAF) -> DataFrame:
    """Per row: id, text, the columns in keep, leaf_chars and leaf_tokens (the
    leaves of its tree, whose tokens add up to the text's). A null text is
    empty and has no leaf."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(rank_file, pattern)
        for batch in batches:
            leaves = [TokenTree.build(t or "", count, leaf).leaves()
                      for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([c for c, _ in leaves], type=pa.list_(pa.int32())),
                 pa.array([t for _, t in leaves], type=pa.list_(pa.int32()))],
                names=[*batch.schema.names, "leaf_chars", "leaf_tokens"])

    read = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"), *keep)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields)
    return map_arrow(read, run, f"{kinds}, leaf_chars array<int>, leaf_tokens array<int>")


def edited(trees: DataFrame, rank_file: str, pattern: str,
           edits: str | Callable[[str], list[tuple[int, int, str]]] = "edits",
           id_col: str = "doc_id", with_trees: bool = True) -> DataFrame:
    """Per row of ``token_trees``: id, n_tokens before its edits,
    n_tokens_after them, n_edits, chars_again (characters encoded for the
    edits) and, if asked, the new text, leaf_chars and leaf_tokens.

    edits names a column of array<struct<start,end,new>> or is a function of
    the text that lists such edits. Places are code points of the unedited
    text, beyond it its end; an edit that overlaps an earlier one begins where
    that ends. A null text is empty, null edits are none, an edit with a null
    start or end is left out, a null ``new`` deletes.
    """
    def listed(given: list | None) -> list[tuple[int, int, str]]:
        return [(e["start"], e["end"], e["new"] or "") for e in given or []
                if e and e["start"] is not None and e["end"] is not None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(rank_file, pattern)
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            given = None if callable(edits) else batch.column("edits").to_pylist()
            for row, (text, chars, tokens) in enumerate(zip(
                    *(batch.column(c).to_pylist() for c in ("text", "leaf_chars", "leaf_tokens")),
                    strict=True)):
                tree = TokenTree.restore(text or "", chars, tokens, count)
                own = edits(text or "") if given is None else listed(given[row])
                before = tree.total
                tree.apply(own)
                made = (tree.text, *tree.leaves()) if with_trees else (None, None, None)
                for values, v in zip(out, (before, tree.total, len(own), tree.encoded, *made), strict=True):
                    values.append(v)
            kinds = [pa.int64()] * 4 + [pa.string()] + [pa.list_(pa.int32())] * 2
            made = [pa.array(v, type=k) for v, k in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *made[:7 if with_trees else 4]],
                                             names=names)

    names = [id_col, "n_tokens", "n_tokens_after", "n_edits", "chars_again"]
    kind = trees.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, " + ", ".join(f"{n} bigint" for n in names[1:])
    if with_trees:
        names += ["text", "leaf_chars", "leaf_tokens"]
        schema += ", text string, leaf_chars array<int>, leaf_tokens array<int>"
    column = [] if callable(edits) else [F.col(edits).cast(EDITS).alias("edits")]
    return map_arrow(trees.select(F.col(id_col).alias("id"), "text", "leaf_chars", "leaf_tokens", *column),
                     run, schema)


def counted_edits(docs: DataFrame, rank_file: str, pattern: str,
                  edits: str | Callable[[str], list[tuple[int, int, str]]] = "edits",
                  id_col: str = "doc_id", text_col: str = "text", leaf: int = LEAF) -> DataFrame:
    """``edited`` right after ``token_trees``: the counts alone."""
    keep = () if callable(edits) else (edits,)
    trees = token_trees(docs, rank_file, pattern, id_col, text_col, keep, leaf)
    return edited(trees, rank_file, pattern, edits, id_col, with_trees=False)


_REPEATED = re.compile(r"([^\w\s])\1+")


def tidy_edits(text: str) -> list[tuple[int, int, str]]:
    """Runs of one punctuation mark become one mark, and the text ends in a line feed."""
    found = [(m.start() + 1, m.end(), "") for m in _REPEATED.finditer(text)]
    return found if text.endswith("\n") else [*found, (len(text), len(text), "\n")]
