"""Language identification and language-model scores."""
import math
import unicodedata
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm.conftest import EDGE_TEXTS, table
from martflow.llm import langid, lm


def test_held_out_accuracy(small):
    rows = langid.identify(small, keep=("lang",)).collect()
    assert len(rows) == small.count()
    held = [r for r in rows if r["held_out"]]
    assert held and sum(r["lang"] == r["lang_pred"] for r in held) / len(held) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["fit"] > 0 for r in rows)


def test_prediction_uses_neither_label_nor_held_out_rows(small):
    fold = langid.fold("doc_id")
    changed = (small.withColumn("lang", F.when(fold == 0, F.lit("xx")).otherwise(F.col("lang")))
               .withColumn("source", F.lit("other")))
    key = lambda df: {r["doc_id"]: r["lang_pred"] for r in langid.identify(df).collect()}
    assert key(small) == key(changed)


def test_texts_in_no_language(spark, small):
    model = langid.train(small)
    docs = table(spark, [(1, None), (2, ""), (3, "123 !!! 🙂"), (4, "中文字符在这里没有学习过"), (5, "²³ ½")])
    got = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    assert {i for i, r in got.items() if r["lang_pred"] == "und"} == {1, 2, 3, 5}
    assert all(got[i]["score"] == 0 and got[i]["fit"] is None for i in (1, 2, 3, 5))
    assert got[4]["fit"] < 0
    judged = langid.predict(docs, model).where(langid.accepted())
    assert judged.count() == 0


def test_long_texts_equal_short_pieces(small, monkeypatch):
    model = langid.train(small)
    want = {r["doc_id"]: r for r in langid.predict(small, model).collect()}
    monkeypatch.setattr(langid, "BLOCK_CHARS", 100)
    texts = [r["text"] for r in small.select("text").limit(20).collect()]
    import numpy as np

    def cells(text):
        out = Counter()
        for _, codes in langid._pieces([text]):
            for _, found in zip(*langid._ngrams(codes, 1 << 15), strict=True):
                out.update(np.asarray(found).tolist())
        return out
    cut = [cells(t) for t in texts]
    monkeypatch.setattr(langid, "BLOCK_CHARS", 1 << 19)
    assert cut == [cells(t) for t in texts]
    assert len(want) == small.count()


def test_nothing_learned(spark, edge, nothing):
    assert langid.identify(nothing).collect() == []
    unlabelled = edge.withColumn("lang", F.lit(None).cast("string"))
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(unlabelled).collect()} == {("und", 0.0)}


def brute_scores(texts, least):
    docs = [(t or "").encode().lower().split() for t in texts]
    one = Counter(w for d in docs for w in d)
    total = sum(one.values())
    two = Counter(p for d in docs for p in zip(d, d[1:], strict=False))
    out = []
    for d in docs:
        s = sum(math.log(one[w] / total) if i == 0 else
                math.log(two[d[i - 1], w] / one[d[i - 1]]) if two[d[i - 1], w] >= least else
                math.log(lm.BACKOFF * one[w] / total) for i, w in enumerate(d))
        out.append((len(d), round(s, 5)))
    return out


@pytest.mark.parametrize("least,bucket", [(1, 1 << 21), (2, 50), (3, 7)])
def test_scores_equal_brute_force(spark, monkeypatch, least, bucket):
    monkeypatch.setattr(lm, "BLOCK_WORDS", 64)
    texts = [t for _, t in EDGE_TEXTS[:14]] + ["a b a b a c", "a b", "b a c", "a a a a"] * 5
    docs = table(spark, list(enumerate(texts))).repartition(3)
    got = {r["doc_id"]: (r["n_words"], round(r["log_score"], 5))
           for r in lm.scores(docs, least=least, bucket=bucket).collect()}
    want = dict(enumerate(brute_scores(texts, least)))
    assert {i: n for i, (n, _) in got.items()} == {i: n for i, (n, _) in want.items()}
    assert all(abs(got[i][1] - want[i][1]) < 2e-5 for i in want)


def test_scores_of_edge_rows(edge, nothing):
    rows = lm.scores(edge).collect()
    assert len(rows) == len(EDGE_TEXTS)
    assert all((r["mean_log_score"] is None) == (r["n_words"] == 0) for r in rows)
    assert lm.scores(nothing).collect() == []


def test_rare_words_keep_their_own_counts(spark):
    """Beyond a million tokens a word met once is still itself: no pooled counts."""
    texts = [" ".join(["a b"] * 260_000)] * 2 + ["rare1 rare2", "rare3 rare4", "rare5 rare6 a"]
    docs = table(spark, list(enumerate(texts))).repartition(3)
    got = {r["doc_id"]: r["log_score"] for r in lm.scores(docs).collect()}
    want = [s for _, s in brute_scores(texts, 1)]
    assert all(abs(got[i] - s) < 1e-4 for i, s in enumerate(want))


def brute_backoff(texts, order, least):
    docs = [(t or "").encode().lower().split() for t in texts]
    n = Counter(tuple(d[i:i + k]) for d in docs for k in range(1, order + 1) for i in range(len(d) - k + 1))
    total = sum(map(len, docs))

    def score(gram):
        if len(gram) == 1:
            return math.log(n[gram] / total)
        return (math.log(n[gram] / n[gram[:-1]]) if n[gram] >= least
                else math.log(lm.BACKOFF) + score(gram[1:]))
    return [sum(score(tuple(d[max(0, i - order + 1):i + 1])) for i in range(len(d))) for d in docs]


@pytest.mark.parametrize("order,least", [(1, 1), (2, 1), (3, 1), (3, 2), (4, 3)])
def test_every_order_backs_off_step_by_step(spark, order, least):
    texts = [t for _, t in EDGE_TEXTS] + ["a b c a b d", "a b", "x b c", "b c a b", "a a a a"] * 3
    docs = table(spark, list(enumerate(texts))).repartition(3)
    got = {r["doc_id"]: r["log_score"] for r in lm.scores(docs, order=order, least=least, bucket=500).collect()}
    want = brute_backoff(texts, order, least)
    assert len(got) == len(want) and all(abs(got[i] - s) < 1e-4 for i, s in enumerate(want))


def plain_bayes(rows, buckets, orders=langid.ORDERS, alpha=langid.ALPHA):
    """Naive Bayes in plain Python: (doc_id, text, lang) -> (language, posterior)."""
    two64 = (1 << 64) - 1

    def cells(text):
        chars = " " + "".join(c if unicodedata.category(c)[0] == "L" else " " for c in text.lower()) + "  "
        for i in range(len(chars) - 2):
            code = 0
            for n in range(1, max(orders) + 1):
                code = (code * 0x9E3779B97F4A7C15 + ord(chars[i + n - 1]) + n) & two64
                if n in orders and (chars[i] != " " or (n > 1 and chars[i + 1] != " ")):
                    yield ((((code ^ (code >> 29)) * 0xBF58476D1CE4E5B9) & two64) >> 40) % buckets

    bags = {i: Counter(cells(text or "")) for i, text, _ in rows}
    learned = [(i, lang) for i, _, lang in rows if lang is not None and zlib.crc32(str(i).encode()) % 5]
    priors, counts = Counter(lang for _, lang in learned), {lang: Counter() for _, lang in learned}
    for i, lang in learned:
        counts[lang].update(bags[i])
    size = {lang: sum(c.values()) + alpha * buckets for lang, c in counts.items()}
    out = {}
    for i, bag in bags.items():
        s = {lang: math.log(priors[lang] / len(learned))
             + sum(n * math.log((counts[lang][c] + alpha) / size[lang]) for c, n in bag.items()) for lang in counts}
        best = max(sorted(s), key=s.get)
        out[i] = (best, 1 / sum(math.exp(v - s[best]) for v in s.values())) if bag else ("und", 0.0)
    return out


def test_language_equals_plain_naive_bayes(spark, small):
    """Language, posterior and fold of every row, long, odd and mixed texts included."""
    rows = [tuple(r) for r in small.select("doc_id", "text", "lang").orderBy("doc_id").limit(60).collect()]
    first = max(r[0] for r in rows) + 1
    langs = [r[2] for r in rows if r[2]]
    rows += [(first + n, t, langs[n % len(langs)] if n % 3 else None) for n, (_, t) in enumerate(EDGE_TEXTS)
             if t is None or len(t) < 20_000]
    rows += [(first + 1000 + n, f"{a[:30]} {b[:30]}", None) for n, ((_, a, _), (_, b, _)) in
             enumerate(zip(rows[:20], rows[20:40], strict=True)) if a and b]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    want = plain_bayes(rows, langid.BUCKETS)
    assert got.keys() == want.keys()
    for i, (lang, score) in want.items():
        assert got[i]["lang_pred"] == lang, i
        assert abs(got[i]["score"] - score) < 1e-6, i
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0), i


def test_the_query_backs_off_from_bigrams_met_once(spark, tmp_dir):
    """The registered query and its SQL: a bigram met once is scored by the
    shorter context, and every word by its own count."""
    import duckdb

    from martflow.llm.oracle import ORACLE
    from martflow.llm.queries import QUERIES
    texts = ["a b c", "a b d", "x y", None, "", "a b c e"]
    table(spark, list(enumerate(texts))).write.parquet(f"{tmp_dir}/documents.parquet")
    got = {r["doc_id"]: r["log_score"] for r in QUERIES["op3_lm_scores"](spark, tmp_dir).collect()}
    want = dict(enumerate(s for _, s in brute_scores(texts, 2)))
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-4 for i in want)
    assert abs(got[2] - (2 * math.log(1 / 12) + math.log(lm.BACKOFF))) < 1e-4
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_dir}/documents.parquet/*.parquet')")
    sql = {r[0]: r[2] for r in con.execute(ORACLE["op3_lm_scores"]).fetchall()}
    assert sql.keys() == got.keys() and all(abs(got[i] - sql[i]) < 1e-5 for i in sql)
