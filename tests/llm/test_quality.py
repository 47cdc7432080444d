"""Quality scores on held-out rows and odd inputs."""

import zlib

import numpy as np

from terrafold.llm import quality, queries


def test_scores_of_held_out_rows(spark, sf):
    found = {r.doc_id: r for r in queries.op10_quality(spark, "/root/testdata/sf0.01").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    for doc_id, r in found.items():
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(found[d].score, q) for d, q in labels.items() if found[d].held_out]
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) > 0.9


def test_flat_trees_equal_a_walk_row_by_row():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, len(quality.FEATURES)))
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(int)
    trees = quality.grow(x, y)
    bins = trees.binned(x)
    for i in range(0, 400, 37):
        total = trees.base
        for feature, limit, leaf in zip(trees.feature, trees.limit, trees.leaf):
            node = 0
            for _ in range(quality.DEPTH):
                node = 2 * node + (2 if bins[i, feature[node]] > limit[node] else 1)
            total += leaf[node - (2**quality.DEPTH - 1)]
        assert abs(trees.score(x[i : i + 1])[0] - 1 / (1 + np.exp(-total))) < 1e-12
    assert ((trees.score(x) > 0.5) == y).mean() > 0.95


def test_odd_rows_and_labels(spark, make_docs, texts):
    docs = make_docs(texts)
    for rows in ([], [(1, 1), (2, 1), (None, 0), (6, 7), (7, None)], [(1, 1), (1, 0), (2, 0), (999, 1)]):
        trees = quality.fit(docs, spark.createDataFrame(rows, "doc_id long, quality int"))
        found = quality.score(docs, trees).collect()
        assert len(found) == len(texts) and all(0 <= r.score <= 1 for r in found)
        assert len({r.score for r in found if not (r.text or "").strip()}) <= 2
    assert quality.score(make_docs([]), trees).count() == 0
