"""Spelling variants against brute force."""
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from llm.conftest import EDGE_TEXTS, table
from martflow.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(docs, least_letters, least_count, spoil):
    n = Counter()
    for i, text in docs:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda x: x[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if spoil and h % spoil == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= least_letters and c >= least_count}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute(n, ratio=2):
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in n}
    best = {w: min(v, key=lambda x: (-n[x], x)) for w, v in near.items() if v}
    form = {w: f for w, f in best.items() if n[f] >= ratio * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {(w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


def rows(df):
    got = [(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


WORDS = {"abcde": 5, "abcd": 90, "abcdf": 10, "abcdfe": 5, "bbcde": 5, "xbcdf": 21, "abcdé": 3, "aaaaa": 4,
         "aaaaaa": 8, "aaaaaaa": 16, "aaaa": 1, "école": 7, "ecole": 3, "écolé": 7, "ab" * 40: 3,
         "ab" * 40 + "a": 9, "ab" * 39 + "ba": 20, "c" * 64: 4, "c" * 65: 9, "c" * 66: 30, "c" * 65 + "d": 60, "c" * 64 + "d": 3, "字典字典": 2, "字典字": 5, "🙂bcde": 3, "zzzzz": 3}


@pytest.mark.parametrize("symbols", [1, 2, 6, 40])
def test_variants_equal_brute_force(spark, symbols):
    words = spark.createDataFrame(list(WORDS.items()), "word string, n bigint").repartition(3)
    assert rows(spelling.variants(words, symbols=symbols)) == brute(WORDS)


def test_random_words_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    n = {}
    for _ in range(700):
        word = "".join(rng.choice(list("abcé"), rng.integers(3, 7)))
        n[word] = int(rng.integers(1, 40))
    words = spark.createDataFrame(list(n.items()), "word string, n bigint").repartition(3)
    assert rows(spelling.variants(words)) == brute(n)


def test_a_chain_of_forms_is_followed_to_its_end(spark):
    n = {"a" * (5 + i): 3 * 2 ** i for i in range(20)}
    words = spark.createDataFrame(list(n.items()), "word string, n bigint")
    got = rows(spelling.variants(words))
    assert got == brute(n) and {r[2] for r in got} == {"a" * 24}


@pytest.mark.parametrize("letters,count,spoil", [(5, 3, 97), (1, 1, 2), (2, 1, 0), (4, 2, 1)])
def test_vocabulary_equals_brute_force(spark, small, letters, count, spoil, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 50)
    texts = [(r["doc_id"], r["text"]) for r in small.limit(80).collect()] + EDGE_TEXTS + [
        (-7, "Éé ÉÉ ×÷ ÿAé aÀb " * 3 + "ſ ı K Ā ḱ"), (None, "word Word wOrd"), (50, "aé" * 100 + " " + "é" * 70)]
    got = {(r["word"], r["n"]) for r in spelling.vocabulary(
        table(spark, texts).repartition(3), letters, count, spoil).collect()}
    assert got == set(brute_words(texts, letters, count, spoil).items())


def test_long_texts_are_cut_behind_runs(spark, monkeypatch):
    texts = [(1, "hello world " * 500 + "x" * 300 + " hello"), (2, "é" * 500), (3, "hello " * 40)]
    want = set(brute_words(texts, 1, 1, 5).items())

    def pieces(segment):
        monkeypatch.setattr(spelling, "SEGMENT", segment)
        n = Counter()
        for prefixes, block in spelling._pieces([i for i, _ in texts], [t for _, t in texts]):
            for word, count in spelling._block_words(prefixes, block, 1, 5):
                n[word.decode("latin-1")] += count
        return {(w, c) for w, c in n.items() if w}
    want = {(w, c) for w, c in want if w}
    assert pieces(64) == want and pieces(1 << 20) == want


def test_runs_of_many_letters(spark):
    long = "abcdefghij" * 10_000
    texts = [(1, long), (2, long[1:]), (3, long), (4, long[:-1] + "x"), (5, " " * 2_000_000),
             (6, "abcde" * 600_000)]
    got = {r["word"]: (r["n"], r["n_near"]) for r in spelling.spelling_groups(
        table(spark, texts), least_count=1).collect()}
    assert sorted(got.values()) == [(1, 0), (1, 1), (1, 1), (2, 2)]


def test_empty_and_edge_tables(spark, nothing, edge):
    assert spelling.spelling_groups(nothing).collect() == []
    assert rows(spelling.spelling_groups(edge, spoil=97)) == brute(brute_words(EDGE_TEXTS, 5, 3, 97))
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([], "word string, n bigint"), ratio=1)
