"""Periodic runs against a search of every lag."""

import hashlib
import random
import zlib

import numpy as np

from terrafold.llm import queries, runs


def brute(words):
    """Every maximal stretch of every lag; of equal stretches the least lag."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = q
        while i < len(words):
            start = i
            while i < len(words) and words[i] == words[i - q]:
                i += 1
            if i - start + q >= max(6, 4 * q):
                found.setdefault((start - q, i - start + q), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def of_texts(texts):
    starts = np.append(0, np.cumsum([len(t) for t in texts]))
    flat = np.array([w for t in texts for w in t], np.int64)
    return [runs.runs_of(t, o) for t, o in zip(texts, runs.openings(flat, starts))]


def random_words(rng):
    kinds, n = rng.choice([1, 2, 3, 9]), rng.choice([0, 1, 5, 6, 7, 20, 60, 200])
    words = []
    while len(words) < n:
        period = [rng.randrange(kinds) for _ in range(rng.randint(1, 12))]
        words += (period * rng.randint(1, 8))[: rng.randint(1, 80)]
    return words * rng.choice([1, 1, 4])


def test_runs_are_those_of_every_lag():
    rng, total = random.Random(1), 0
    for _ in range(1500):
        texts = [random_words(rng) for _ in range(rng.choice([1, 4]))]
        wanted = [brute(t) for t in texts]
        total += sum(map(len, wanted))
        assert of_texts(texts) == wanted
    assert total > 2000


def test_cube_free_words_have_no_run_and_hide_none():
    thue = [0]
    while len(thue) < 4096:
        thue += [1 - b for b in thue]
    assert of_texts([thue]) == [[]]
    assert of_texts([thue * 5])[0] == [(0, len(thue) * 5, len(thue))]


def test_every_period_has_a_window_length():
    for longest in (5, 6, 7, 24, 100, 5000):
        lengths = runs.window_lengths(longest)
        for q in range(1, longest // 4 + 1):
            if max(6, 4 * q) <= longest:
                assert any(2 * q <= k <= 3 * q for k in lengths), (longest, q)


def test_a_very_long_text_of_one_word_takes_one_diagonal():
    assert of_texts([[7] * 400_000]) == [[(0, 400_000, 1)]]
    assert of_texts([list(range(50)) * 8000]) == [[(0, 400_000, 50)]]


def words_of(text):
    return (text or "").encode().split()


def kept(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def test_find_handles_every_row(spark, make_docs, texts):
    texts = [*texts, (20, "la " * 9 + "end"), (21, " \x0b\x0cA b\tA b A b\nA b c"), (21, "x " * 5), (22, "née à " * 7)]
    found = runs.find(make_docs(texts)).collect()
    got = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], bytes(r.collapsed)) for r in found)
    wanted = []
    for doc_id, text in texts:
        words = words_of(text)
        of = brute(words) if len(words) < 1000 else [(0, 27000, 3)]
        wanted.append((str(doc_id), len(words), of, b" ".join(kept(words, of))))
    assert got == sorted(wanted)
    assert runs.digest(runs.find(make_docs([]))).count() == 0


def test_planted_runs_and_query(spark, sf, shared_texts):
    rows = {r.doc_id: r for r in queries.op11_periodic_runs(spark, sf).collect()}
    assert len(rows) == len(shared_texts)
    for doc_id, text in shared_texts:
        words = words_of(text)
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        found, row = brute(words), rows[doc_id]
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        assert row.n_runs == len(found)
        if best:
            assert (row.start, row.length, row.period) == best and row.exponent_milli == 1000 * best[1] // best[2]
        else:
            assert (row.start, row.length, row.period, row.exponent_milli) == (None,) * 4
        lines = "".join("%d,%d,%d\n" % r for r in found)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(b" ".join(kept(words, found))).hexdigest()


def test_planting_leaves_rows_without_words_or_id(spark, make_docs, texts):
    found = runs.with_planted_runs(make_docs(texts)).collect()
    assert len(found) == len(texts)
    assert {r.text for r in found if r.doc_id is None} == {"a text without id, not to be lost"}
    # crc32 of some of these ids ends in 0
    chosen = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0]
    for blank in (None, "", " \n "):
        rows = runs.with_planted_runs(make_docs([(i, blank) for i in chosen])).collect()
        assert {r.text for r in rows} == {blank}
