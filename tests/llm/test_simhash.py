"""SimHash links against all pairs, and quality scores on held-out rows."""

import random
from itertools import combinations

import pytest

from terrafold.llm import queries, simhash
from terrafold.llm.components import components


def brute_print(text, shingle=3):
    import xxhash

    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in lowered.translate({i: " " for i in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance):
    """{index: least linked index} by all pairs."""
    parent = list(range(len(prints)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(range(len(prints)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= distance:
            a, b = sorted((top(a), top(b)))
            parent[b] = a
    return [top(i) for i in range(len(prints))]


def expected(docs, distance=2):
    rows = sorted((d, t) for d, t in docs if d is not None)
    prints = [brute_print(t) for _, t in rows]
    roots = brute_components(prints, distance)
    return sorted((d, f"{p:016x}", rows[r][0]) for (d, _), p, r in zip(rows, prints, roots))


def read(frame):
    rows = frame.withColumn("fingerprint", simhash.as_hex(frame.fingerprint)).collect()
    return sorted((r.doc_id, r.fingerprint, r.component_id) for r in rows if r.doc_id is not None)


def test_edge_rows(make_docs, texts):
    texts = [(d, (t or "")[:3000] if t else t) for d, t in texts]
    assert read(simhash.near_duplicates(make_docs(texts))) == expected(texts)
    assert simhash.near_duplicates(make_docs([])).count() == 0


@pytest.mark.parametrize("distance", [0, 1, 2, 3, 5])
def test_links_lose_nothing(spark, distance):
    rng = random.Random(distance)
    prints = {0, (1 << 64) - 1}
    for _ in range(60):
        base = rng.getrandbits(64)
        prints.add(base)
        for _ in range(4):
            base ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, distance + 1)))
            prints.add(base)
    prints = sorted(prints)
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    rows = spark.createDataFrame(signed, "id long, fingerprint long")
    found = {r.node: r.component for r in components(simhash.links(rows, distance)).collect()}
    assert [found.get(i, i) for i in range(len(prints))] == brute_components(prints, distance)


def test_a_dense_group_gives_a_forest(spark):
    base = random.Random(1).getrandbits(62)
    near = [(i, base ^ (1 << a) ^ (1 << b)) for i, (a, b) in enumerate(combinations(range(40), 2))]
    found = simhash.links(spark.createDataFrame(near, "id long, fingerprint long"), 2)
    assert found.count() <= 12 * len(near)
    assert components(found).select("component").distinct().count() == 1


def test_thresholds_spend_the_distance():
    costs = [[0.0, 5.0, 50.0, 900.0], [0.0, 7.0, 20.0, 80.0], [0.0, 90.0, 95.0, 99.0]]
    chosen = simhash.thresholds(costs, 2)
    every = [
        (sum(c[t + 1] for c, t in zip(costs, ts)), ts)
        for ts in [(a, b, c) for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3)]
        if sum(t + 1 for t in ts) == 3
    ]
    assert sum(c[t + 1] for c, t in zip(costs, chosen)) == min(every)[0]


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (300, 299), (299, 300)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[i] for i in range(61)} == {0} and {found[i] for i in range(100, 150)} == {100}
    assert found[300] == found[299] == 299 and len(found) == 113


def test_query_on_documents(spark, sf, shared_texts):
    found = sorted((r.doc_id, r.fingerprint, r.component_id) for r in queries.op7_simhash(spark, sf).collect())
    assert found == expected(shared_texts)


def test_a_large_spot_is_cut_into_blocks(spark, monkeypatch):
    rng = random.Random(6)
    base = rng.getrandbits(63)
    prints = {base}
    while len(prints) < 600:
        prints.add(base ^ sum(1 << b for b in rng.sample(range(63), rng.randint(1, 5))))
    prints = sorted(prints)
    monkeypatch.setattr(simhash, "SPOT", 40)
    rows = spark.createDataFrame(list(enumerate(prints)), "id long, fingerprint long")
    assert max(r["count"] for r in simhash.spots(rows, 2).groupBy("spot").count().collect()) <= 4 * 40
    label = list(range(len(prints)))
    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2 and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = [low if v == high else v for v in label]
    found = {r.node: r.component for r in simhash.components(simhash.links(rows, 2)).collect()}
    assert [found.get(i, i) for i in range(len(prints))] == label
