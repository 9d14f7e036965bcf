"""BPE digests, token files and edit-aware counts against the plain libraries."""
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm.conftest import EDGE_TEXTS, table
from martflow.llm import bpe, counts, idfile

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
JSON = public_tokenizers.path("byte_bpe_50k.json")
ENC = bpe.encoding(RANKS, PATTERN)
AWKWARD = st.text(alphabet="ab1é '\n\t  \x1c\x85!日🙂", max_size=80)


def digests(text):
    ids = ENC.encode_ordinary(text or "")
    return (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(ENC.decode_bytes(ids)).hexdigest())


def test_digests_equal_the_library(edge):
    for size in (bpe.PART_CHARS, 7):
        got = sorted((r["doc_id"] or 0, *tuple(r)[1:]) for r in bpe.encode_digests(
            edge, RANKS, PATTERN, part_chars=size).collect())
        assert got == sorted((i or 0, *digests(t)) for i, t in EDGE_TEXTS)


def test_round_trip_of_ids_and_bytes(edge):
    back = bpe.decode(bpe.encode(edge, RANKS, PATTERN), RANKS, PATTERN)
    assert sorted((r["doc_id"] or 0, bytes(r["bytes"])) for r in back.collect()) == sorted(
        (i or 0, (t or "").encode()) for i, t in EDGE_TEXTS)


def test_nothing_to_encode(nothing):
    assert bpe.encode_digests(nothing, RANKS, PATTERN).collect() == []
    assert counts.counted_edits(nothing, RANKS, PATTERN, edits=counts.tidy_edits).collect() == []
    assert idfile.read_ids(idfile.write_ids(nothing, JSON, 50257)).collect() == []


def test_runs_of_any_length(spark):
    """Two million characters of one class: no run ends the job, and the ids
    decode to the text. Runs that the library can take agree with it."""
    n = 2_000_000
    long = [" " * n + "y", "a" + "\n" * n, "x " + " \t" * (n // 2) + "! b", "a" * n, "7" * n, "!" * n, "é" * n]
    docs = table(spark, list(enumerate(long))).repartition(4)
    got = {r["doc_id"]: tuple(r)[1:] for r in bpe.encode_digests(docs, RANKS, PATTERN).collect()}
    assert {i: d for i, (_, _, d) in got.items()} == {
        i: hashlib.sha256(t.encode()).hexdigest() for i, t in enumerate(long)}
    counted = {r["doc_id"]: r["n_tokens"] for r in counts.counted_edits(
        docs, RANKS, PATTERN, edits=lambda text: [(5, 6, "")]).collect()}
    assert counted == {i: c for i, (c, _, _) in got.items()}
    for text in [" " * 200_000 + "y", "a" + "\n" * 200_000 + "b", "q" + "\t \n" * 60_000,
                 " " * 200_000 + "\n\nzz" + " " * 200_000 + "!" + " " * 140_000]:
        assert [i for p in bpe.parts(text) for i in bpe.part_ids(p, RANKS, PATTERN)] == ENC.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(AWKWARD, st.integers(1, 12))
def test_parts_encode_as_the_whole(text, size):
    assert "".join(bpe.parts(text, size)) == text
    assert [i for p in bpe.parts(text, size) for i in ENC.encode_ordinary(p)] == ENC.encode_ordinary(text)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(bpe, "SPACES_APART", 0)
        assert [i for p in bpe.parts(text, size) for i in bpe.part_ids(p, RANKS, PATTERN)] == ENC.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(AWKWARD, st.lists(st.tuples(st.integers(0, 90), st.integers(0, 90), AWKWARD.map(lambda t: t[:5])),
                         max_size=6), st.integers(1, 16))
def test_tree_counts_after_edits(text, edits, leaf):
    tree = counts.TokenTree.build(text, lambda t: len(ENC.encode_ordinary(t)), leaf)
    assert tree.total == len(ENC.encode_ordinary(text))
    at, last, made = 0, 0, []
    for start, end, new in sorted(edits, key=lambda e: e[0]):
        start = max(min(start, len(text)), last)
        last = max(min(end, len(text)), start)
        made += [text[at:start], new]
        at = last
    tree.apply(edits)
    assert tree.text == "".join(made) + text[at:]
    assert tree.total == len(ENC.encode_ordinary(tree.text))


def test_edits_encode_only_what_they_touch():
    rng = random.Random(5)
    text = " ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(20000))
    tree = counts.TokenTree.build(text, lambda t: len(ENC.encode_ordinary(t)))
    before = tree.encoded
    tree.apply([(60000, 60004, "new words, here"), (90001, 90001, "!")])
    assert tree.encoded - before < 8 * counts.LEAF
    assert tree.total == len(ENC.encode_ordinary(tree.text))


def test_counted_edits_of_a_column(spark):
    from pyspark.sql import functions as F
    rows = [(1, "hello big world", [(6, 9, "small"), (None, 2, "x"), (100, 200, " end")]),
            (2, None, None), (3, "", [(0, 0, "made up")]), (None, "gone", [(0, 4, None)]), (4, "kept", [])]
    docs = spark.createDataFrame(rows, f"doc_id bigint, text string, edits {counts.EDITS}")
    docs = docs.withColumn("n_tokens", F.lit("clash"))
    got = {r["doc_id"]: (r["n_tokens"], r["n_tokens_after"], r["n_edits"])
           for r in counts.counted_edits(docs, RANKS, PATTERN).collect()}
    n = lambda t: len(ENC.encode_ordinary(t))
    assert got == {1: (n("hello big world"), n("hello small world end"), 2), 2: (0, 0, 0),
                   3: (0, n("made up"), 1), None: (n("gone"), 0, 1), 4: (n("kept"), n("kept"), 0)}


def test_stored_trees_take_further_edits(spark, edge):
    """Trees kept as a table: a second round of edits encodes only its places."""
    trees = counts.token_trees(edge, RANKS, PATTERN, leaf=64)
    once = counts.edited(trees, RANKS, PATTERN, counts.tidy_edits)
    twice = counts.edited(once, RANKS, PATTERN, lambda text: [(3, 5, "!"), (10, 10, " more")])
    n = lambda t: len(ENC.encode_ordinary(t))
    rows = {}
    for r in twice.collect():
        assert r["n_tokens_after"] == n(r["text"]) == sum(r["leaf_tokens"])
        assert sum(r["leaf_chars"]) == len(r["text"])
        rows.setdefault(r["doc_id"], []).append(r)
    (long,) = rows[15]
    assert long["chars_again"] < 1000 < len(long["text"])


def test_tidy_counts_equal_encoding_the_edited_texts(edge):
    got = sorted((r["doc_id"] or 0, r["n_tokens"], r["n_tokens_after"]) for r in counts.counted_edits(
        edge, RANKS, PATTERN, edits=counts.tidy_edits).collect())
    want = []
    for i, text in EDGE_TEXTS:
        text, at, made = text or "", 0, []
        for start, end, new in counts.tidy_edits(text):
            made += [text[at:start], new]
            at = end
        want.append((i or 0, len(ENC.encode_ordinary(text)),
                     len(ENC.encode_ordinary("".join(made) + text[at:]))))
    assert got == sorted(want)


def library_ids(text, tokenizer=Tokenizer.from_file(JSON)):
    tokenizer.encode_special_tokens = True
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_token_files_hold_every_document_in_order(edge, monkeypatch):
    monkeypatch.setattr(idfile, "READ_DOCS", 3)
    got = sorted(idfile.read_ids(idfile.write_ids(edge, JSON, 50257)).collect(), key=lambda r: r["start"])
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    start, left = 0, [(i, library_ids(t)) for i, t in EDGE_TEXTS]
    for r in got:
        assert r["start"] == start
        own = next(x for x in left if x[0] == r["doc_id"] and len(x[1]) == r["n_tokens"]
                   and zlib.crc32(np.array(x[1], dtype="<u4").tobytes()) == r["ids_crc32"])
        left.remove(own)
        start += r["n_tokens"]
    assert not left


def test_wide_vocabularies_use_four_bytes(spark):
    assert idfile.id_type(50257, 2) == "<u2" and idfile.id_type(1 << 16, 1 << 16) == "<u4"
    docs = table(spark, [(2, "two words"), (1, "<|endoftext|> is text")])
    for vocabulary in (50257, 1 << 20):
        rows = idfile.read_ids(idfile.write_ids(docs, JSON, vocabulary)).collect()
        assert [r["ids_crc32"] for r in sorted(rows, key=lambda r: r["doc_id"])] == [
            zlib.crc32(np.array(library_ids(t), dtype="<u4").tobytes())
            for t in ("<|endoftext|> is text", "two words")]


@settings(max_examples=200, deadline=None)
@given(st.lists(AWKWARD, max_size=3))
def test_chunks_encode_as_the_whole(texts):
    made = [b"".join(pieces) for pieces in idfile._encoder(JSON, "<u2").encode(texts)]
    assert [[*np.frombuffer(m, dtype="<u2").tolist(), 2] for m in made] == list(map(library_ids, texts))


PLAIN = st.text(alphabet="aZé×ſ٣²Жѐ1_,.'!-<|> \n\u3000ĊĠ", max_size=60)


@settings(max_examples=300, deadline=None)
@given(st.lists(PLAIN, max_size=6), st.booleans())
def test_plain_words_encode_as_the_whole(texts, added):
    made = [b"".join(pieces) for pieces in idfile._encoder(JSON, "<u2", added).encode(texts)]
    assert [[*np.frombuffer(m, dtype="<u2").tolist(), 2] for m in made] == list(map(library_ids, texts))


def test_a_word_is_encoded_once_whatever_marks_follow(monkeypatch):
    """Most of op6's time went into the pattern of the byte-level rule, for the
    same words with other marks behind them."""
    encoder, sent = idfile.ChunkEncoder(JSON, "<u2", True), []
    cut = encoder._cut_at_line_feeds
    monkeypatch.setattr(encoder, "_cut_at_line_feeds", lambda texts, tokenizer: (
        sent.extend(w for t in texts for w in t.split("\n") if w), cut(texts, tokenizer))[1])
    text = "x wörter wörter, wörter. wörter!!! wörter\nwörter?, x"
    (made,) = (b"".join(pieces) for pieces in encoder.encode([text]))
    assert np.frombuffer(made, dtype="<u2").tolist() == plain_ids(text)
    assert sum("Ã¶rter" in w for w in sent) == 1  # that behind a line feed is a chunk by itself


def test_other_rules_and_added_words_have_no_plain_words(tmp_path):
    from tokenizers import AddedToken, normalizers
    texts = ["see Foo, foo and foo! 12", "foo", "FOO.\nfoo foo"]
    for at, change in enumerate([lambda t: t.add_tokens([AddedToken("foo", normalized=False)]),
                                 lambda t: setattr(t, "normalizer", normalizers.Lowercase())]):
        tokenizer = Tokenizer.from_file(JSON)
        change(tokenizer)
        tokenizer.save(path := str(tmp_path / f"{at}.json"))
        encoder = idfile.ChunkEncoder(path, "<u2", True)
        assert encoder.plain is None
        made = [b"".join(pieces) for pieces in encoder.encode(texts)]
        assert [np.frombuffer(m, dtype="<u2").tolist() for m in made] == [plain_ids(t, tokenizer) for t in texts]


def test_encoder_forgets_and_takes_long_texts_in_pieces(monkeypatch):
    monkeypatch.setattr(idfile, "RECENT", 8)
    monkeypatch.setattr(idfile, "LONG", 64)
    encoder = idfile.ChunkEncoder(JSON, "<u2")
    rng = random.Random(1)
    parts = [" of%%%", " a", "\n", "  the", "b!", " 12"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(60))) for _ in range(80)]
    made = [b"".join(pieces) for pieces in encoder.encode(texts)]
    assert [[*np.frombuffer(m, dtype="<u2").tolist(), 2] for m in made] == list(map(library_ids, texts))


END = "<|endoftext|>"
WITH_END = st.lists(st.sampled_from([END, "a", "b1", " ", "  ", "\n", "\t", "é", "!", "<|", "日"]), max_size=25).map("".join)


def plain_ids(text, tokenizer=Tokenizer.from_file(JSON)):
    return tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(WITH_END, max_size=4))
def test_chunks_with_added_tokens_encode_as_the_whole(texts):
    made = [b"".join(pieces) for pieces in idfile._encoder(JSON, "<u2", True).encode(texts)]
    assert [np.frombuffer(m, dtype="<u2").tolist() for m in made] == list(map(plain_ids, texts))


def test_added_tokens_with_white_space_are_not_cut(tmp_path):
    from tokenizers import AddedToken
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.add_special_tokens([AddedToken("<| two words |>", special=True),
                                  AddedToken("<left>", special=True, lstrip=True)])
    tokenizer.save(path := str(tmp_path / "more.json"))
    texts = ["a <| two words |> b", "a  \n <left> b", "", "no token"]
    made = [b"".join(pieces) for pieces in idfile.ChunkEncoder(path, "<u2", True).encode(texts)]
    assert [np.frombuffer(m, dtype="<u2").tolist() for m in made] == [plain_ids(t, tokenizer) for t in texts]


def test_token_files_query_keeps_added_tokens(spark, tmp_path):
    """The contract: the library with the given file, add_special_tokens=False."""
    from martflow.llm.queries import QUERIES
    texts = ["a " + END + " b", "plain", END + END, "x" + END + "\n\ny"]
    table(spark, list(enumerate(texts))).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(QUERIES["op6_token_files"](spark, str(tmp_path)).collect(), key=lambda r: r["doc_id"])
    want = [[*plain_ids(t), 2] for t in texts]
    assert want[0] == [64, 220, 50256, 275, 2]
    assert [(r["start"], r["n_tokens"], r["ids_crc32"]) for r in got] == [
        (sum(map(len, want[:i])), len(w), zlib.crc32(np.array(w, dtype="<u4").tobytes())) for i, w in enumerate(want)]
