"""Codes of vectors against the full comparison of every part with every entry."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from terrafold.llm import codes, queries


def brute(rows, parts=16, entries=64, rounds=2, scale=256):
    """rows: (id, label, vector), all usable. ([(id, label, code, error)], listed codebooks), in Python integers."""
    from fractions import Fraction

    whole = [[math.floor(Fraction(x) * scale) for x in v] for _, _, v in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][2]))
    width = len(whole[0]) // parts if rows else 0
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(whole[i], p) for i in order[:entries]] for p in range(parts)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            owned = {}
            for v in whole:
                owned.setdefault(nearest(cut(v, p), book)[1], []).append(cut(v, p))
            books[p] = [[sum(c) // len(owned[k]) for c in zip(*owned[k])] if k in owned else e for k, e in enumerate(book)]
    found = []
    for (id_, label, _), v in zip(rows, whole):
        best = [nearest(cut(v, p), books[p]) for p in range(parts)]
        found.append((id_, label, bytes(k for _, k in best), sum(d for d, _ in best)))
    return found, ",".join(str(x) for b in books for e in b for x in e)


@pytest.fixture
def make_vectors(spark):
    def make(rows, label=T.IntegerType()):
        schema = T.StructType(
            [T.StructField("id", T.LongType()), T.StructField("label", label), T.StructField("vector", T.ArrayType(T.DoubleType()))]
            + [T.StructField(n, T.StringType()) for n in ("code", "error", "of", "ids", "trees", "part")]
        )
        return spark.createDataFrame([(*r, *["x"] * 6) for r in rows], schema).repartition(3)

    return make


def compare(frame, rows, **kwargs):
    coded, books = codes.compress(frame, **kwargs)
    wanted, listed = brute(rows, **kwargs)
    key = lambda r: tuple(map(str, r))
    limited = [(i, x, c, e if e < 1 << 63 else None) for i, x, c, e in wanted]
    assert sorted(((r.id, r.label, bytes(r.code), r.error) for r in coded.collect()), key=key) == sorted(limited, key=key)
    assert codes.listed(books) == listed
    return coded


def test_codes_with_ties_copies_and_unusable_rows(make_vectors):
    rng = random.Random(3)
    rows = [(i % 150, rng.choice([1, 2, None]), [rng.randint(-2, 2) / 256 for _ in range(32)]) for i in range(300)]
    rows += [(400 + i, 1, rows[0][2]) for i in range(150)] + [(None, None, rows[1][2])]
    bad = [(-1, 1, None), (-2, 1, [None] + [0.0] * 31), (-3, 2, [math.nan] * 32), (-4, 2, [math.inf] + [0.0] * 31), (-5, 2, [-math.inf] * 32)]
    odd = [(-9, 1, [1.0] * 16), (-8, 1, [])]
    compare(make_vectors(rows + bad + odd), rows)


def test_trees_of_many_balls_give_the_full_comparison(make_vectors, monkeypatch):
    monkeypatch.setattr(codes, "LEAF", 8)
    monkeypatch.setattr(codes, "CHUNK", 100)
    rng = random.Random(4)
    rows = [(i, 0, [rng.gauss(k % 5, 0.3) for k in range(32)]) for i in range(500)]
    compare(make_vectors(rows), rows, entries=20)


def test_balls_cover_all_points_once():
    rng = np.random.default_rng(1)
    for points in (rng.integers(-9, 9, (3000, 4)), np.zeros((2000, 4), np.int64), rng.normal(0, 90, (5000, 2)).astype(np.int64)):
        tree = codes.Balls(points.copy())
        assert sorted(tree.order.tolist()) == list(range(len(points))) and (points[tree.order] == tree.points).all()
        book = points[:64]
        covered = np.zeros(len(points), int)
        for ball, held in tree.owned(book):
            covered[tree.first[ball] : tree.last[ball]] += 1
            assert (np.diff(held) > 0).all()
        assert (covered == 1).all()
        code, error = tree.assigned(book)
        away = ((points[:, None] - book[None]) ** 2).sum(2)
        assert (code == away.argmin(1)).all() and (error == away.min(1)).all()


def test_large_components_are_exact(make_vectors):
    rng = random.Random(5)
    values = [1e12, -1e12, 1e300, 3.0, -0.001, 2.0**60 + 1024, 1.7e308]
    rows = [(i, i % 2, [rng.choice(values) if i % 7 == 0 else rng.random() for _ in range(16)]) for i in range(120)]
    coded = compare(make_vectors(rows), rows)
    totals = {r.label: r.label_error for r in codes.with_label_error(coded).collect()}
    assert totals == {0: None, 1: None}


def test_few_rows_and_none(make_vectors):
    rows = [(5, None, [0.5] * 16), (5, None, [0.25] * 16)]
    coded = compare(make_vectors(rows), rows)
    assert [r.label_error for r in codes.with_label_error(coded).collect()] == [0, 0]
    coded, books = codes.compress(make_vectors([]))
    assert coded.count() == 0 and codes.with_label_error(coded).count() == 0 and codes.listed(books) == ""
    with pytest.raises(ValueError):
        codes.compress(make_vectors([(1, 1, [1.0] * 17)]))


def test_labels_of_other_kinds(make_vectors):
    rows = [(i, "ab"[i % 2] if i % 3 else None, [i / 100] * 16) for i in range(80)]
    coded = compare(make_vectors(rows, T.StringType()), rows)
    errors = {}
    for r in coded.collect():
        errors[r.label] = errors.get(r.label, 0) + r.error
    assert {r.label: r.label_error for r in codes.with_label_error(coded).collect()} == errors


def test_query_equals_the_full_comparison(spark, sf):
    import pyarrow.parquet as pq

    table = pq.read_table(f"{sf}/embeddings.parquet").to_pylist()
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in table]
    wanted, listed = brute(rows)
    errors = {}
    for _, label, _, error in wanted:
        errors[label] = errors.get(label, 0) + error
    digest = hashlib.sha256(listed.encode()).hexdigest()
    found = queries.op12_vector_codes(spark, sf).collect()
    got = sorted((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in found)
    assert got == sorted((i, c.hex(), e, errors[x], digest) for i, x, c, e in wanted)
