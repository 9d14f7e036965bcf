"""The pipeline's stages against brute force, and the registered queries' SQL."""
import hashlib
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as pipeline
from llm.conftest import SMALL, table
from llm.test_similar import groups
from llm.test_text_scans import spans_of
from llm.test_tokens import ENC
from martflow.llm import secretscan
from martflow.llm.oracle import ORACLE
from martflow.llm.queries import QUERIES
from tools.oracle_check import digest


def test_every_operator_is_registered_once():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    columns = [d[0] for d in cur.description]
    wanted = cur.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert digest(df.columns, rows)[0] == digest(columns, wanted)[0]


def words(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.lower())


def five(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_run_equals_brute_force(spark, small, items):
    docs = {r["doc_id"]: r["text"] for r in small.collect()}
    comps = groups(list(docs.items()), 5)
    tests = [five(r["text"]) for r in items.collect()]
    want = {}
    for i, text in docs.items():
        own = five(text)
        if comps[i] != i or any(len(t & own) >= 0.8 * len(t) for t in tests if t):
            continue
        made, at = [], 0
        for start, _, _, end in spans_of(text):
            if start >= at:
                made += [text[at:start], secretscan.MARK]
            at = max(at, end)
        ids = ENC.encode_ordinary("".join(made) + text[at:])
        want[i] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in pipeline.run(spark, SMALL).collect()}
    assert got == want
    assert len(want) < len(docs)


def test_stages_keep_the_columns_and_take_effect(spark, small):
    rows = [(r["doc_id"], r["text"]) for r in small.limit(60).collect()]
    extra = [(900, None), (901, "12345 67890"), (902, rows[0][1]), (903, "password=abcdefgh12 " + rows[1][1])]
    docs = table(spark, rows + extra).select("doc_id", "text", "lang", "source", "n_chars")
    stages = dict(pipeline.STAGES)
    kept = {r["doc_id"] for r in stages["language"](spark, docs, SMALL).collect()}
    assert kept == {i for i, _ in rows} | {902, 903}
    for name in ("language", "near_duplicates", "decontamination", "secrets"):
        assert stages[name](spark, docs, SMALL).columns == docs.columns
    clean = {r["doc_id"]: r for r in stages["secrets"](spark, docs, SMALL).collect()}
    assert clean[903]["text"].startswith(secretscan.MARK) and clean[903]["n_chars"] == len(clean[903]["text"])
    assert clean[901]["text"] == "12345 67890" and clean[900]["n_chars"] is None
    before = {r["doc_id"]: r for r in docs.collect()}
    assert all(r == before[i] for i, r in clean.items() if i not in (903,) and not spans_of(before[i]["text"]))
    assert 902 not in {r["doc_id"] for r in stages["near_duplicates"](spark, docs, SMALL).collect()}


def test_stages_take_clashing_columns_and_empty_tables(spark, small, tmp_path):
    names = ["score", "fit", "lang_pred", "held_out", "__kept_id", "__id", "__h", "__cuts", "cuts", "kept", "node",
             "name", "row", "c0", "c1", "id", "h", "hashes", "n_tokens", "ids_sha256"]
    docs = small.select("*", *[F.lit(f"own {c}").alias(c) for c in names])
    for folder, rows in (("full", docs.limit(40)), ("empty", docs.limit(0))):
        rows.write.parquet(str(tmp_path / folder / "documents.parquet"))
        spark.read.parquet(f"{SMALL}/benchmark.parquet").write.parquet(str(tmp_path / folder / "benchmark.parquet"))
        sf_dir = str(tmp_path / folder)
        docs_in = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for name, stage in pipeline.STAGES[:-1]:
            out = stage(spark, docs_in, sf_dir)
            assert out.columns == docs.columns, name
            assert {r["score"] for r in out.select("score").collect()} <= {"own score"}
        got = pipeline.run(spark, sf_dir).collect()
        assert (len(got) > 0) == (folder == "full")


def test_run_on_repeated_ids(spark, small, tmp_path):
    rows = small.limit(12)
    again = rows.withColumn("text", F.concat(F.lit("an other beginning of quite some other words "), F.reverse("text")))
    rows.unionByName(rows).unionByName(again).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SMALL}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = dict(pipeline.STAGES)["near_duplicates"](spark, docs, str(tmp_path))
    texts = [r["text"] for r in kept.collect()]
    assert len(texts) == len(set(texts)) >= 12
    assert pipeline.run(spark, str(tmp_path)).count() <= len(texts)
