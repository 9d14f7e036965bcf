"""Toxic spans: exact marginals, held-out accuracy, edge rows."""
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.conftest import EDGE_TEXTS, table
from martflow.llm import toxicity
from martflow.llm.langid import fold

MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def mid(spark):
    return spark.read.parquet(f"{MID}/documents.parquet"), spark.read.parquet(f"{MID}/labels.parquet")


@pytest.fixture(scope="module")
def planted(spark):
    """Texts of plain words, every fourth with insults between them."""
    rng = np.random.default_rng(5)
    plain, bad = [f"wo{a}{b}" for a, b in itertools.product("abcdefghij", repeat=2)], ["scummy", "fool", "crétin"]
    rows = []
    for i in range(400):
        words = rng.choice(plain, rng.integers(8, 60)).tolist()
        if i % 4 == 0:
            for w in rng.choice(bad, rng.integers(2, 4)):
                words.insert(int(rng.integers(0, len(words) + 1)), str(w))
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    docs = table(spark, [(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y, y, "x") for i, _, y in rows], "doc_id bigint, quality int, toxic int, text string")
    return rows, docs, labels


def brute_marginals(emission, moves):
    start, up, down, stay = moves
    move = {(0, 0): 0.0, (0, 1): up, (1, 0): down, (1, 1): stay}
    total, on = 0.0, np.zeros(len(emission))
    for path in itertools.product((0, 1), repeat=len(emission)):
        s = start * path[0] + sum(e * y for e, y in zip(emission, path, strict=True))
        p = math.exp(s + sum(move[a, b] for a, b in itertools.pairwise(path)))
        total += p
        on += p * np.array(path)
    return on / total


@pytest.mark.parametrize("steps", [1, 3, 128])
def test_marginals_equal_the_sum_over_all_paths(monkeypatch, steps):
    monkeypatch.setattr(toxicity, "STEPS", steps)
    rng = np.random.default_rng(2)
    moves = np.array([-0.7, -1.1, 0.4, 0.9])
    parts = [rng.normal(0, 2, n) for n in (1, 7, 2, 10, 1, 4)]
    first = np.concatenate([np.arange(len(p)) == 0 for p in parts])
    got = toxicity.marginals(np.concatenate(parts), first, moves)
    assert np.allclose(got, np.concatenate([brute_marginals(p, moves) for p in parts]))
    assert len(toxicity.marginals(np.empty(0), np.empty(0, dtype=bool), moves)) == 0


def test_planted_insults_are_tagged_and_scored(planted):
    rows, docs, labels = planted
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == len(rows)
    for i, text, y in rows:
        assert got[i]["predicted"] == y == (got[i]["score"] >= 0.5)
        tagged = {text[s["start"]:s["end"]] for s in got[i]["spans"]}
        assert tagged <= {" ".join(p) for n in (1, 2, 3) for p in
                          itertools.product(("scummy", "fool", "crétin"), repeat=n)}
        assert bool(tagged) == bool(y)


def test_scores_use_neither_labels_nor_held_out_rows(planted):
    _, docs, labels = planted
    changed = labels.withColumn("toxic", F.when(fold("doc_id") == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("yy"))
    key = lambda df: {r["doc_id"]: r["score"] for r in df.collect()}
    assert key(toxicity.toxicity(docs, labels)) == key(toxicity.toxicity(other, changed))


def test_held_out_accuracy(mid):
    docs, labels = mid
    rows = (toxicity.toxicity(docs, labels).where("held_out").join(labels, "doc_id")
            .select("toxic", "predicted").collect())
    right = [r["toxic"] == r["predicted"] for r in rows]
    assert len(rows) > 50 and sum(right) / len(rows) >= 0.95
    assert not [r for r in rows if r["predicted"] and not r["toxic"]]


def test_near_copies_of_a_labelled_text_count_once(spark, planted):
    """A toxic text's own rare words mark nothing, however often it was copied."""
    rows, docs, labels = planted
    rng = np.random.default_rng(7)
    base = ("rareone raretwo fool rarethree scummy rarefour rarefive " * 4).split()
    copies = []
    for i in range(200):
        words = list(base)
        words[int(rng.integers(0, len(words)))] = "woaa"
        copies.append((1000 + i, " ".join(words)))
    more = docs.unionByName(table(docs.sparkSession, copies + [(5000, "woab wocd rareone woef woaj")]))
    known = labels.unionByName(spark.createDataFrame([(i, 1, 1, "x") for i, _ in copies], labels.schema))
    got = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(more, known).collect()}
    assert got[5000] == 0 and all(got[i] == y for i, _, y in rows)


def test_edge_rows_and_nothing_learned(spark, edge, nothing, planted):
    rows, docs, labels = planted
    model = toxicity.train(docs.join(labels.select("doc_id", "toxic"), "doc_id"))
    assert model.learned
    got = toxicity.predict(edge, model).collect()
    assert len(got) == len(EDGE_TEXTS) and all(0 <= r["score"] <= 1 and not r["predicted"] for r in got)
    assert toxicity.predict(nothing, model).collect() == []
    none = labels.limit(0)
    assert {r["score"] for r in toxicity.toxicity(docs, none).collect()} == {0.0}
    one = labels.withColumn("toxic", F.lit(1))
    assert {(r["score"], r["predicted"]) for r in toxicity.toxicity(docs, one).collect()} == {(0.0, 0)}
    unsure = labels.withColumn("toxic", F.lit(None).cast("int"))
    assert {r["score"] for r in toxicity.toxicity(docs, unsure).collect()} == {0.0}
    twice = labels.unionByName(labels).unionByName(unsure)
    assert (sorted(r["predicted"] for r in toxicity.toxicity(docs.unionByName(docs), twice).collect())
            == sorted(2 * [y for _, _, y in rows]))


def test_long_texts_are_cut_between_words(spark, planted, monkeypatch):
    _, docs, labels = planted
    model = toxicity.train(docs.join(labels.select("doc_id", "toxic"), "doc_id"))
    text = "woab wocd " * 60_000 + "Fool, SCUMMY " + "woef " * 50_000
    long = table(spark, [(1, text), (2, "x" * 3_000_000), (3, " " * 3_000_000 + "fool")])
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in toxicity.predict(long, model).collect()}
    at = text.index("Fool")
    assert got == {1: [(at, at + 12)], 2: [], 3: [(3_000_000, 3_000_004)]}
    texts = [text[:700], "a" * 50 + " b"]
    whole = [np.concatenate([t.word for t in toxicity._blocks(texts)])]
    monkeypatch.setattr(toxicity, "SEQUENCE", 16)
    monkeypatch.setattr(toxicity, "BLOCK", 64)
    cut = np.concatenate([t.word for t in toxicity._blocks(texts)])
    assert (cut == whole[0]).all()
