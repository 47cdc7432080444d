"""Top-k search and web archives against brute force."""

import hashlib

from pyspark.sql import functions as F, types as T

from terrafold.llm import queries, topk, warc


def brute_top(rows, is_query, k=20, scale=64):
    import math

    usable = []
    for i, x in rows:
        if i is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        usable.append((i, [math.floor(c * scale) for c in x]))
    out = []
    for at, (q, v) in enumerate(usable):
        if is_query(q):
            product = lambda w: max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w))))
            scores = sorted((-product(w), i) for other, (i, w) in enumerate(usable) if other != at)
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def read(frame):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in frame.collect())


def vectors(spark, rows):
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])
    return spark.createDataFrame(rows, schema).withColumns({"id": F.lit("x"), "score": F.lit("y"), "block": F.lit(1)})


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, -0.5, 0.25]), (1, [1.0, -0.5, 0.25]), (2, None), (3, [None, 1.0, 2.0]), (4, [nan, 1.0, 2.0]),
        (5, [inf, 0.0, 0.0]), (20, [0.0, 0.0, 0.0]), (21, []), (22, [2.0]), (40, [-1.0, 3.0, 2.0]), (40, [-1.0, 3.0, 2.0]),
        (41, [1e30, -1e30, 1.0]), (None, [1.0, 1.0, 1.0]), (60, None), (61, [1.0, -0.5, 0.25]),
    ]
    found = topk.top_k(vectors(spark, rows), F.col("id") % 20 == 0, k=3)
    assert read(found) == brute_top(rows, lambda i: i % 20 == 0, k=3)
    assert topk.top_k(vectors(spark, []), F.col("id") % 20 == 0).count() == 0


def test_rows_that_repeat_an_id(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [3.0, 0.0]), (2, [9.0, 1.0])]
    found = topk.top_k(vectors(spark, rows), F.col("id") == 0, k=20)
    assert read(found) == [(0, 1, 2, 9 * 64**2), (0, 2, 1, 3 * 64**2), (0, 3, 1, 2 * 64**2)]
    # two queries of one id, equal and unequal, meet each other
    rows += [(20, [1.0, 1.0])] * 3 + [(20, [1.0]), (20, [1.0, 0.0])] + [(7, [0.5, 0.5])] * 9
    for k in (2, 6, 30):
        assert read(topk.top_k(vectors(spark, rows), F.col("id") % 20 == 0, k=k)) == brute_top(rows, lambda i: i % 20 == 0, k=k)


def test_copies_are_made_in_parts(spark, monkeypatch):
    monkeypatch.setattr(topk, "COPIES", 4)
    rows = [(20, [1.0, 2.0])] * 9 + [(3, [1.0, 1.0]), (4, [-1.0, 1.0])]
    assert read(topk.top_k(vectors(spark, rows), F.col("id") == 20, k=9)) == brute_top(rows, lambda i: i == 20, k=9)


def test_large_components_are_exact(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 30)
    rows = [(0, [1.0, 0.0]), (1, [1e12, 1.0]), (2, [1e11, 1.0]), (3, [float(2**54), 1.0]), (20, [1e30, -1e30]), (21, [1e30, 1e30])]
    rows += [(22, [float(2**40), 3.0]), (23, [float(2**40), 2.0]), (40, [float(2**-6), 1.0]), (60, [-1.0, float(2**41)]), (61, [3e38, 3e38])]
    found = read(topk.top_k(vectors(spark, rows), F.col("id") % 20 == 0, k=6))
    # as floats, since that is what the table holds
    import numpy as np

    rows = [(i, np.array(x, np.float32).astype(float).tolist()) for i, x in rows]
    assert found == brute_top(rows, lambda i: i % 20 == 0, k=6)
    # doubles whose masses overflow, small rests behind large components
    import random

    rng = random.Random(3)
    rows = [(i, [rng.choice([1e12, -1e12, 1e15, 1.0]), rng.choice([1e160, 0.0, 0.0, 0.0]), rng.uniform(-2, 2), rng.uniform(-2, 2), 0.0, *[rng.uniform(-1, 1) for _ in range(15)]]) for i in range(120)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert read(topk.top_k(frame, F.col("id") % 20 == 0, k=7)) == brute_top(rows, lambda i: i % 20 == 0, k=7)
    assert topk.top_k(spark.createDataFrame([(0, [1e307]), (20, [1.0])], frame.schema), F.col("id") % 20 == 0).count() == 0


def test_many_blocks_and_ties(spark, monkeypatch):
    import random

    monkeypatch.setattr(topk, "CANDIDATES", 40)
    monkeypatch.setattr(topk, "QUERIES", 7)
    rng = random.Random(0)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(20)]) for i in range(300)]
    found = topk.top_k(vectors(spark, rows), F.col("id") % 10 == 0, k=5)
    assert read(found) == brute_top(rows, lambda i: i % 10 == 0, k=5)


def test_small_products_take_the_short_form_and_stay_exact(monkeypatch):
    """Also where few of a block's candidates count, and where floors are given."""
    from types import SimpleNamespace

    import numpy as np

    forms, search = [], topk.search_block
    monkeypatch.setattr(topk, "search_block", lambda *a: (forms.append(a[3].dtype), search(*a))[1])
    rng = np.random.default_rng(6)
    for largest, form in ((30, np.float32), (1023, np.float32), (1024, np.float64), (1 << 19, np.float64), (1 << 28, np.int64), (1 << 40, object)):
        for k, spread, few in ((3, 1, 0), (40, 1, 1 << 15), (5, 30, 0), (5, 30, 1 << 15)):
            monkeypatch.setattr(topk, "FEW", few, raising=False)
            weights = largest / spread ** np.linspace(0, 1, 16)
            x = np.floor(rng.uniform(-1, 1, (300, 16)) * weights)
            x[7, 0] = x[8, 0] = largest
            ids, own = np.arange(300), [[int(c) for c in v] for v in x]
            q = np.array([0, 7, 8, 250])
            floors = np.array([topk._LEAST, 0, topk._LEAST, min(2**60, int(x[250] @ x[250]) // 8)], np.int64)
            fields = {"ids": ids, "matrix": x.T.copy(), "times": np.ones(300, np.int64), "q_ids": q, "q_matrix": x[q].T.copy(), "floors": floors}
            row = SimpleNamespace(**{n: v.tobytes() for n, v in fields.items()})
            for i, score, near, _ in topk._meeting(row, 16, k):
                wanted = ((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(own[q[i]], own[j])))), j) for j in range(300) if j != q[i])
                wanted = [(j, -s) for s, j in sorted(wanted) if -s >= floors[i]][:k]
                assert list(zip(near.tolist(), score.tolist())) == wanted
            assert {np.dtype(f) for f in forms} == {np.dtype(form)}
            forms.clear()


def brute_warc(pages):
    payloads = [(i, (h or "").encode()) for i, h in pages]
    out = []
    for i, data in payloads:
        top = max((j for j, other in payloads if other == data and j is not None), default=None)
        revisit = len(data) >= 1000 and top is not None and i != top
        kind = "revisit" if revisit else "response"
        out.append((str(i), len(data), hashlib.sha1(data).hexdigest(), kind, top if revisit else None))
    return sorted(out, key=str)


def round_trip(spark, pages, path, chunk):
    schema = "record_id long, uri string, payload string, block string, n string, last string"
    frame = spark.createDataFrame([(i, "http://é/\r\nx" if i else None, h, "b", "n", "l") for i, h in pages], schema)
    warc.write_archives(frame.repartition(2), path, chunk=chunk)
    return warc.read_chunks(spark, path)


def test_archives_round_trip(spark, tmp_path):
    odd = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 60
    long = "é€ long payload " * 900
    pages = [(1, long), (2, long), (3, None), (4, ""), (5, odd), (6, odd), (7, "short"), (8, "short"), (9, "y" * 1000), (10, "y" * 1000), (10, "y" * 1000), (None, "z" * 1200)]
    rows = round_trip(spark, pages, str(tmp_path / "a"), 777).collect()
    assert all(r.sound for r in rows)
    found = sorted(
        (
            (r.record_id or "None", r.payload_bytes, r.payload_digest, r.record_type, int(r.refers_to) if r.refers_to else None)
            for r in rows
            if r["last"]
        ),
        key=str,
    )
    assert found == brute_warc(pages)
    stored = {}
    for r in sorted(rows, key=lambda r: r.chunk):
        assert len(r.block) <= 777
        stored[r.record_id] = stored.get(r.record_id, b"") + bytes(r.block)
    assert stored["2"] == long.encode() and stored["6"] == odd.encode() and stored["1"] == b""
    assert warc.read_chunks(spark, str(tmp_path / "a"), keep_blocks=False).where("block is not null").count() == 0


def test_no_pages(spark, tmp_path):
    assert round_trip(spark, [], str(tmp_path / "b"), 100).count() == 0


def test_query_on_pages(spark, sf):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    found = [(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in queries.op8_warc(spark, sf).collect()]
    assert sorted(found, key=str) == brute_warc(pages)


def test_query_on_vectors(spark, sf):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert read(queries.op5_topk(spark, sf)) == brute_top(rows, lambda i: i % 20 == 0)
