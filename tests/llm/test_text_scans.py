"""Secret scan, licence scan and decontamination against brute force."""
import hashlib
import re

import pytest

from llm.conftest import EDGE_TEXTS, table
from martflow.llm import decontam, licences, secretscan
from martflow.llm.trigrams import alternatives


def spans_of(text):
    found = []
    for place, rule in enumerate(secretscan.RULES):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m.group(rule.group)) >= rule.least:
                found.append((m.start(), place, rule.kind, m.end()))
    return sorted(found)


def joined(found):
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in found)


def test_trigrams_are_mandatory():
    assert alternatives("[0-9a-f]+") is None
    assert alternatives("(?i)ab?c|xyz") is None
    assert alternatives("hello[0-9]+world") == [frozenset(
        ["hel", "ell", "llo", "wor", "orl", "rld"])]
    assert sorted(map(sorted, alternatives("(abcd|bcde)x?"))) == [["abc", "bcd"], ["bcd", "cde"]]
    for rule in secretscan.RULES:
        for text in [t or "" for _, t in EDGE_TEXTS]:
            for m in re.finditer(rule.pattern, text):
                sets = alternatives(rule.pattern)
                assert sets is None or any(all(t in m.group().lower() for t in s) for s in sets)


def test_secret_report_equals_brute_force(edge):
    got = sorted((r["doc_id"] or 0, r["spans"], r["base_sha256"], r["n_assign"], r["n_access"], r["n_hex"])
                 for r in secretscan.secret_report(edge).collect())
    want = []
    for i, text in EDGE_TEXTS:
        all_of = spans_of(text)
        base = [s for s in all_of if s[1] < 3]
        want.append((i or 0, joined(all_of), hashlib.sha256(joined(base).encode()).hexdigest(),
                     *(sum(s[1] == k for s in base) for k in range(3))))
    assert got == sorted(want)


def test_secret_report_of_nothing(nothing):
    assert secretscan.secret_report(nothing).collect() == []
    assert secretscan.redact(nothing).columns == nothing.columns


def test_redaction_leaves_no_span_and_keeps_clean_rows(edge):
    out = secretscan.redact(edge)
    assert out.columns == edge.columns
    got = sorted((r["doc_id"] or 0, r["text"] or "") for r in out.collect())
    want = []
    for i, text in EDGE_TEXTS:
        text, at, made = text or "", 0, []
        for start, _, _, end in spans_of(text):
            if start >= at:
                made += [text[at:start], secretscan.MARK]
            at = max(at, end)
        # overlapping spans are one stretch
        want.append((i or 0, "".join(made) + text[at:] if made else text))
    assert got == sorted(want)


def test_scans_read_no_python(edge):
    for df in (secretscan.secret_report(edge), licences.license_scan(edge)):
        assert "Python" not in df._jdf.queryExecution().toString()
        assert "Arrow" not in df._jdf.queryExecution().toString()


def licence_row(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)
    base, found, score = [], set(), 0.0
    for t in licences.TEMPLATES:
        notice = t.words()
        for start in range(-len(notice), len(words)):
            met = [key for at, w, key in notice
                   if 0 <= start + at < len(words) and words[start + at] == w]
            if sum(met) == sum(k for _, _, k in notice) and len(met) >= licences.ENOUGH * len(notice):
                found.add(t.label)
                score = max(score, len(met) / len(notice))
                if t.base:
                    base.append((start, t.label))
    starts = [s for s, _ in base]
    return (len(words), len(base), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({b for _, b in base})), ",".join(sorted(found)), score)


def test_license_scan_equals_brute_force(edge):
    got = {}
    for r in licences.license_scan(edge).collect():
        got.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    for i, text in EDGE_TEXTS:
        if i != 15:  # 60,000 words: too slow for the brute force
            assert licence_row(text) in got[i], (i, got[i])
    assert got[15][0][0] == 60000
    assert sum(map(len, got.values())) == len(EDGE_TEXTS)


def test_license_scan_of_nothing(nothing):
    assert licences.license_scan(nothing).collect() == []


def test_contamination_finds_items_inside_long_documents(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"
    long_item = " ".join(f"term{i}" for i in range(400))
    filler = " ".join(f"filler{i}" for i in range(20000))
    damaged = long_item.split()
    damaged[200] = "changed"
    items = spark.createDataFrame(
        [(1, item), (2, long_item), (3, None), (4, ""), (5, "just three words"), (1, item),
         (None, "an item without any number is still an item")], "item_id bigint, text string")
    docs = table(spark, [
        (1, filler + " " + item.upper().replace(" ", ", ") + ". " + filler), (2, item[:60]),
        (3, filler + " " + " ".join(damaged)), (4, " ".join(long_item.split()[:250])),
        (5, "Just three words!"), (6, "there are just three words here"), (7, None), (8, ""),
        (None, item), (10, filler), (11, "AN ITEM without any number is still an item")])
    got = {(r["doc_id"], r["item_id"], r["n_item"], r["n_shared"])
           for r in decontam.contamination(docs, items).collect()}
    assert got == {(1, 1, 12, 12), (3, 2, 396, 391), (5, 5, 1, 1), (None, 1, 12, 12),
                   (11, None, 5, 5)}
    kept = decontam.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 4, 6, 7, 8, 10]


@pytest.mark.parametrize("block", [1, 50])
def test_contamination_does_not_depend_on_the_blocks(small, items, monkeypatch, block):
    want = {tuple(r) for r in decontam.contamination(small, items).collect()}
    monkeypatch.setattr(decontam, "BLOCK", block * 20)
    few = items.limit(12)
    ids = {r["item_id"] for r in few.collect()}
    assert {tuple(r) for r in decontam.contamination(small, few).collect()} == {
        r for r in want if r[1] in ids}


def test_an_item_without_a_number(spark):
    items = spark.createDataFrame([(None, "the only item has no number at all")], "item_id bigint, text string")
    docs = table(spark, [(1, "Here the only item has no number at all, as said")])
    (r,) = decontam.contamination(docs, items).collect()
    assert (r["doc_id"], r["item_id"], r["n_item"], r["n_shared"]) == (1, None, 4, 4)


def test_contamination_without_documents_or_items(spark, small, nothing, items):
    none = spark.createDataFrame([], items.schema)
    assert decontam.contamination(nothing, items).count() == 0
    assert decontam.contamination(small, none).count() == 0
    assert decontam.decontaminate(small, none).count() == small.count()
