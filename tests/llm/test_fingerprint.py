"""Sketches against exact sets of shingles."""

import hashlib

import pytest
from pyspark.sql import functions as F

from terrafold.llm import fingerprint, queries


def shingles(text):
    words = (text or "").lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def alike(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edits(docs):
    rows = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    rows = [(d, t or "") for d, t in rows]
    for (d, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        yield d, t, t[: len(t) - half] + after[:half], after


def test_edge_rows(make_docs, texts):
    docs = texts + [(10_000, "far away"), (1 << 40, "last one of all")]
    found = fingerprint.with_edits(make_docs(docs)).select("doc_id", "text", "edited", "sketch", "edited_sketch", "next_sketch").collect()
    wanted = sorted((str(d), t, e) for d, t, e, _ in edits(docs))
    assert sorted((str(r.doc_id), r.text, r.edited) for r in found) == wanted
    for r in found:
        for text, sketch in ((r.text, r.sketch), (r.edited, r.edited_sketch)):
            assert len(sketch) == min(fingerprint.K, len(shingles(text))) and sorted(set(sketch)) == list(sketch)
    assert fingerprint.with_edits(make_docs([])).count() == 0
    assert [r.edited for r in fingerprint.with_edits(make_docs([(1, "abcd")])).collect()] == ["abab"]


def test_query_on_documents(spark, sf, shared_texts):
    found = {r.doc_id: r for r in queries.op2_fingerprint(spark, sf).collect()}
    errors, by_text = [], {}
    for d, text, edited, after in edits(shared_texts):
        r = found[d]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        errors.append(abs(r.near_edited - alike(text, edited)))
        errors.append(abs(r.near_next - alike(text, after)))
        if len(shingles(text) | shingles(edited)) <= fingerprint.K:
            assert r.near_edited == pytest.approx(alike(text, edited))
    assert max(errors) < 0.2 and sum(errors) / len(errors) < 0.03


def test_estimates_and_merging(spark):
    a = " ".join(f"w{i}" for i in range(3000))
    b = " ".join(f"w{i}" for i in range(1000))
    rows = spark.createDataFrame([(a, b, "", "one two")], "a string, b string, c string, d string")
    for n in "abcd":
        rows = fingerprint.with_sketch(rows, n, f"s{n}")
    r = rows.select(
        fingerprint.resemblance(F.col("sa"), F.col("sb")).alias("j"),
        fingerprint.containment(F.col("sb"), F.col("sa")).alias("c"),
        fingerprint.distinct_shingles(F.col("sa")).alias("n"),
        fingerprint.resemblance(F.col("sc"), F.col("sc")).alias("empty"),
        fingerprint.resemblance(F.col("sc"), F.col("sd")).alias("none"),
        fingerprint.distinct_shingles(F.col("sd")).alias("one"),
        (fingerprint.merged(F.col("sa"), F.col("sb")) == F.col("sa")).alias("same"),
    ).first()
    assert abs(r.j - 1 / 3) < 0.15 and r.c > 0.7 and abs(r.n / 2996 - 1) < 0.3
    assert (r.empty, r.none, r.one, r.same) == (1.0, 0.0, 1.0, True)
    parts = rows.select(F.lit("k").alias("key"), "sa").unionByName(rows.select(F.lit("k").alias("key"), F.col("sb").alias("sa")))
    assert fingerprint.merge_groups(parts, "key", "sa").first().sa == rows.first().sa
