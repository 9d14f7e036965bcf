"""Ranked lexical search against scoring every document."""
import math
import re
from collections import Counter

import numpy as np
import pytest

from llm.conftest import EDGE_TEXTS, SMALL, table
from martflow.llm import ranked

TERM = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))


def brute(docs, items, k):
    own = [(i, Counter(terms(t))) for i, t in docs]
    own = [(i, c) for i, c in own if c]
    total = sum(c.total() for _, c in own)
    df = Counter(t for _, c in own for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = set()
    for item, wanted in asked.items():
        scored = []
        for i, c in own:
            m = 10 + 90 * c.total() * len(own) // total
            s = sum(math.floor(1000 * math.log((2 * len(own) + 2) / (2 * df[t] + 1)))
                    * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if t in c)
            if s:
                scored.append((-s, i is None, i or 0, i))
        for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1):
            out.add((item, rank, i, -s))
    return out


def questions(spark, rows):
    return spark.createDataFrame([(i, t, 7, "x") for i, t in rows],
                                 "item_id bigint, text string, shard int, term string")


ITEMS = [(1, "The quick brown fox"), (2, None), (3, ""), (4, "word1 word2 word699 lazy"),
         (5, "nothing here matches zzzqqq"), (6, "token password secret"), (6, "apache license"),
         (None, "one two"), (7, "日本語のテキスト é don't"), (1, "The quick brown fox")]


@pytest.mark.parametrize("postings,docs_held,item_terms", [(1 << 21, 1 << 16, 1 << 20), (40, 3, 4)])
def test_edge_rows_equal_brute_force(spark, edge, monkeypatch, postings, docs_held, item_terms):
    monkeypatch.setattr(ranked, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(ranked, "SHARD_DOCS", docs_held)
    monkeypatch.setattr(ranked, "ITEM_TERMS", item_terms)
    got = ranked.search(edge, questions(spark, ITEMS), k=4)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert {tuple(r) for r in got.collect()} == brute(EDGE_TEXTS, ITEMS, 4)


@pytest.mark.parametrize("k", [1, 10])
def test_documents_equal_brute_force(spark, small, items, k):
    got = [tuple(r) for r in ranked.search(small, items, k=k).collect()]
    want = brute([(r["doc_id"], r["text"]) for r in small.collect()],
                 [(r["item_id"], r["text"]) for r in items.collect()], k)
    assert len(got) == len(want) and set(got) == want


def test_empty_tables(spark, nothing, edge):
    assert ranked.search(nothing, questions(spark, ITEMS)).collect() == []
    assert ranked.search(edge, questions(spark, [])).collect() == []
    assert ranked.search(nothing, questions(spark, [])).collect() == []


def test_best_rejects_blocks_before_they_are_read():
    """A common list behind a decisive one is looked up in single blocks only."""
    n = 40_000
    rng = np.random.default_rng(1)
    lengths = rng.integers(5, 50, n)
    found = [(np.array([1] + [2] * (i % 997 == 0), dtype=np.int64),
              np.array([1 + i % 3] + [9] * (i % 997 == 0))) for i in range(n)]
    rows = ranked._shard(0, list(range(n)), lengths.tolist(), found).to_pylist()
    m_of = lambda x: 10 + 90 * x.astype(np.int64) * n // int(lengths.sum())
    lists = [ranked._List(weight, r["df"], r["heads"], r["docs"], r["tfs"], m_of)
             for weight, r in zip((3, 9000), rows[1:], strict=True)]
    read = []
    whole, of = ranked._List.whole, ranked._List.of
    lists[0].whole = lambda m: pytest.fail("the common list was read as a whole")
    lists[0].of = lambda d, b, m: (read.append(len(set(b.tolist()))), of(lists[0], d, b, m))[1]
    m = m_of(lengths)
    docs, score = ranked._best(lists, m, 10)
    want = np.zeros(n, dtype=np.int64)
    for x in lists:
        at, s = whole(x, m)
        want[at] += s
    best = np.sort(want)[-10:]
    assert sorted(score.tolist())[-10:] == best.tolist()
    assert sum(read) < 50 < n / ranked.BLOCK


def test_query_is_the_contract(spark):
    from martflow.llm.queries import QUERIES
    rows = QUERIES["op13_ranked_search"](spark, SMALL)
    assert dict(rows.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}


def test_a_million_word_text(spark):
    docs = table(spark, [(1, "a b " * 500_000 + "needle"), (2, "needle in a stack"), (3, "x" * 2_000_000)])
    asked = [(1, "needle"), (2, "b a")]
    got = {tuple(r) for r in ranked.search(docs, questions(spark, asked)).collect()}
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()], asked, 10)
