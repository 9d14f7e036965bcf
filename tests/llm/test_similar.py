"""Near duplicates and neighbours against brute force."""
import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.conftest import EDGE_TEXTS, table
from martflow.llm import ann, neardup
from martflow.llm.components import components


def shingle_set(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1)))


def groups(rows, n, percent=80):
    """{id: smallest linked id} for rows of distinct ids."""
    sets = {i: shingle_set(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def near_copies(n, seed, size=120, edits=6):
    rng = random.Random(seed)
    base = [rng.choice("abcdefghijk") + str(rng.randrange(900)) for _ in range(size)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(edits)):
            words[rng.randrange(size)] = f"new{rng.randrange(10 ** 6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("words", [2, 5])
def test_groups_equal_brute_force(spark, monkeypatch, words):
    monkeypatch.setattr(neardup, "SMALL", 8)   # so that long lists and tiles are met
    monkeypatch.setattr(neardup, "TILE", 16)
    texts = [t for seed in range(6) for t in near_copies(40 if seed == 0 else 6, seed, edits=14)]
    texts += ["short one", "short one", "Short  ONE", "a b c d e f g h", "a b c d e f g h i",
              "the the the the the", "the the", "", None, " \n"] + ["many copies of this text"] * 30
    rng = random.Random(3)
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r for r in neardup.near_duplicates(table(spark, rows), words=words).collect()}
    want = groups(rows, words)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())
    assert {i: r["n_shingles"] for i, r in got.items()} == {
        i: len(shingle_set(t, words)) for i, t in rows}


def test_edge_rows(edge):
    got = neardup.near_duplicates(edge, words=2).collect()
    assert len(got) == len(EDGE_TEXTS)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add((r["component_id"], r["kept"]))
    assert by[1] == {(1, True)} and by[2] == {(1, False)}
    assert by[None] == {(None, True)} and by[13] == {(13, True)}
    assert by[3] == {(3, True)} and by[5] == {(5, True)}
    kept = neardup.deduplicate(edge, words=2)
    assert kept.columns == edge.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(None) == 2 and ids.count(13) == 2 and 2 not in ids and 1 in ids


def test_no_documents(nothing):
    assert neardup.near_duplicates(nothing).collect() == []
    assert neardup.deduplicate(nothing).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(3, 3), (9, 7)]
    got = {tuple(r) for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {(i, 100) for i in range(100, 161)} | {(i, 7) for i in range(7, 40)}


def brute(rows, every, k):
    good = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and len(v) == 8
            and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)}
    out = set()
    for q, qv in good:
        if q % every == 0:
            found = sorted((-sum(np.float32(a).astype(float) * np.float32(b).astype(float)
                                 for a, b in zip(qv, v, strict=True)), i) for i, v in good if i != q)
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(found[:k])}
    return out


def test_neighbours_equal_brute_force_in_one_block(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(30)]          # copies, queries among them
    rows += [(200, None), (201, [0.0] * 8), (202, [1.0] * 7 + [None]), (203, [1.0] * 7 + [float("nan")]),
             (204, [1.0] * 7 + [float("inf")]), (205, [1.0] * 9), (None, [1.0] * 8), rows[0], rows[5], (206, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<float>, label int")
    got = {tuple(r) for r in ann.nearest(df, every=10, k=7).collect()}
    assert got == brute(rows, 10, 7)
    assert {tuple(r) for r in ann.nearest(df.limit(0)).collect()} == set()


def test_fewer_candidates_than_k(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [0.0, 2.0])],
                               "vec_id bigint, embedding array<float>")
    assert {tuple(r) for r in ann.nearest(df).collect()} == {
        (0, 1, 20, 0.5), (0, 2, 3, 0.0), (20, 1, 3, 1.0), (20, 2, 0, 0.5)}


def test_recall_over_many_blocks(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = {(r["query_id"], r["vec_id"]) for r in ann.nearest(rows, block=128).collect()}
    table = rows.orderBy("vec_id").toPandas()
    v, ids = np.array(table["embedding"].tolist(), dtype=float), table["vec_id"].to_numpy()
    scores = v[ids % 20 == 0] @ v.T
    scores[np.arange(len(scores)), np.flatnonzero(ids % 20 == 0)] = -np.inf
    near = np.argsort(-scores, axis=1)[:, :20]
    want = {(q, ids[j]) for q, row in zip(ids[ids % 20 == 0], near, strict=True) for j in row}
    assert len(got & want) / len(want) >= 0.9


def test_hilbert_neighbours_differ_by_one_step():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    keys = ann.hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(512))
    steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_a_task_holds_bounded_points_and_queries(spark, monkeypatch):
    """Every row a query, vectors that do not cluster: windows span all blocks."""
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    group, sizes = type(df).groupBy, []

    def spy(self, *by):
        if any(isinstance(b, str) and b == "block" for b in by):
            sizes.extend(group(self, *by, "is_query").count().collect())
        return group(self, *by)

    monkeypatch.setattr(type(df), "groupBy", spy)
    monkeypatch.setattr(ann, "_fitted_window", lambda *_: 1000)
    got = {tuple(r) for r in ann.nearest(df, every=1, k=5, curves=2, block=16).collect()}
    assert {r["is_query"] for r in sizes} == {True, False} and max(r["count"] for r in sizes) <= 16
    assert got == brute(rows, 1, 5)


def test_tiles_are_bounded_by_shingles(spark, monkeypatch):
    """A cluster of few but long texts is cut into blocks, too."""
    monkeypatch.setattr(neardup, "TILE_SHINGLES", 3000)
    rows = list(enumerate(near_copies(60, 1, size=300, edits=14)))
    df = table(spark, rows)
    group, tiles = type(df).groupBy, []

    def spy(self, *by):
        if by[-1:] and isinstance(by[-1], str) and by[-1] == "j":
            tiles.extend(group(self, *by).agg(F.sum("n").alias("shingles")).collect())
        return group(self, *by)

    monkeypatch.setattr(type(df), "groupBy", spy)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(df, words=2).collect()}
    assert tiles and max(r["shingles"] for r in tiles) <= 2 * 2 * 3000
    assert got == groups(rows, 2)


def test_a_tile_holds_little_beside_its_matrix():
    """The peak of a full tile's arithmetic, and counts beyond what floats hold."""
    n, rng = 2 * neardup.TILE, np.random.default_rng(0)
    row = np.repeat(np.arange(n), 300)
    column = np.sort(rng.integers(0, 9000, len(row)))
    size = np.full(n, 300)
    tracemalloc.start()
    linked = neardup.linked_rows(row, column, size, 80)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6 and linked.shape == (n, n)
    # 80 % exactly, of sets so large that 32-bit floats would round
    shared = 16_777_300
    row, column = np.tile([0, 1], shared), np.repeat(np.arange(shared), 2)
    for own, want in ((shared + shared // 8, True), (shared + shared // 8 + 1, False)):
        assert neardup.linked_rows(row, column, np.array([own, own]), 80)[0, 1] == (
            shared * 100 >= (2 * own - shared) * 80) == want


def test_different_texts_of_one_id_are_judged_apart(spark):
    a, b, c = ("alpha beta gamma delta epsilon " * 3 + x for x in ("one", "two three four", "five"))
    other = "nothing of the kind is said in this text at all"
    rows = [(1, a), (1, other), (1, other), (2, a), (3, other), (None, a), (None, a), (4, None), (4, ""), (5, "x")]
    docs = table(spark, rows).withColumn("kept", F.lit("k")).withColumn("__kept_id", F.lit(7)).withColumn("node", F.lit(1))
    kept = neardup.deduplicate(docs)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    assert got == sorted([(1, a), (1, other), (None, a), (None, a), (4, None), (4, ""), (5, "x")], key=str)
