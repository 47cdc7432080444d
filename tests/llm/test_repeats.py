"""Suffix arrays and removed repeats against brute force."""

import hashlib
import random

import numpy as np
import pytest

from terrafold.llm import queries, repeats, suffix


@pytest.mark.parametrize("few, held", [(2, 4), (2, 30), (2, 4096), (512, 4096)])
def test_suffix_array_and_prefixes(monkeypatch, few, held):
    monkeypatch.setattr(suffix, "FEW_SIGNS", few)
    monkeypatch.setattr(suffix, "RANGE", held)
    rng = random.Random(few)
    for turn in range(300):
        size, top = rng.choice([0, 1, 2, 5, 20, 150]), rng.choice([2, 3, 6, 60])
        text = [rng.randrange(1, top) for _ in range(size)]
        if turn % 4 == 0:
            text = text[: max(1, size // 3)] * 5
        order = suffix.suffix_array(np.array(text, np.int64), top).tolist()
        assert order == sorted(range(len(text)), key=lambda i: text[i:])
        if not text:
            continue
        found = suffix.permuted_common_prefixes(np.array(text), np.array(order), 1)
        for before, i in zip(order, order[1:]):
            n = 0
            while max(i, before) + n < len(text) and text[i + n] == text[before + n] != 1:
                n += 1
            assert found[i] == n


def brute(docs, length):
    first = {}
    rows = [(d, (t or "").encode()) for d, t in docs]
    for d, t in rows:
        if d is not None:
            for i in range(len(t) - length + 1):
                s = t[i : i + length]
                first[s] = min(first.get(s, d), d)
    out = []
    for d, t in rows:
        gone = bytearray(len(t))
        if d is not None:
            end = 0
            for i in range(len(t) - length + 1):
                if first[t[i : i + length]] < d:
                    gone[max(i, end) : i + length] = b"\1" * (i + length - max(i, end))
                    end = i + length
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((str(d), len(t), sum(gone), runs, kept))
    return sorted(out)


def read(frame):
    rows = frame.collect()
    return sorted((str(r.doc_id), len((r.text or "").encode()), sum(r.removed[1::2]) - sum(r.removed[::2]), len(r.removed) // 2, bytes(r.kept)) for r in rows)


def test_edge_rows(make_docs, texts):
    docs = [(d, (t or "")[:20_000] if t else t) for d, t in texts]
    found = repeats.remove_repeats(make_docs(docs))
    assert read(found) == brute(docs, 50)
    assert set(found.columns) == set(make_docs(docs).columns) | {"removed", "kept"}
    assert repeats.remove_repeats(make_docs([])).count() == 0


@pytest.mark.parametrize("length", [24, 50])
def test_random_repeats(make_docs, monkeypatch, length):
    monkeypatch.setattr(repeats, "CHUNKS_PER_ROOT", 1 / 8)
    monkeypatch.setattr(repeats, "RUN", 16)
    rng = random.Random(length)
    shared = ["".join(rng.choice("ab é") for _ in range(rng.choice([length - 1, length, 90]))) for _ in range(6)] + ["a" * 400, "xy" * 150]
    docs = []
    for d in rng.sample(range(1000), 60):
        docs.append((d, "".join(rng.choice([rng.choice(shared), "".join(rng.choice("abc") for _ in range(30))]) for _ in range(rng.randint(0, 6)))))
    assert read(repeats.remove_repeats(make_docs(docs), length)) == brute(docs, length)


@pytest.mark.parametrize("split", [0, 3])
def test_split_keys(make_docs, monkeypatch, split):
    monkeypatch.setattr(repeats, "CHUNKS_PER_ROOT", 1 / 8)
    monkeypatch.setattr(repeats, "SPLIT", split)
    rng = random.Random(split)
    other = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    line = "a line that stands in all documents here, "
    docs = [(d, other(rng.randint(0, 60)) + line + other(rng.choice([3, 60]))) for d in rng.sample(range(999), 80)]
    docs += [(2000 + d, other(20) + rng.choice(docs)[1][5:] + "x" * rng.choice([0, 90])) for d in range(20)]
    assert read(repeats.remove_repeats(make_docs(docs))) == brute(docs, 50)


def test_one_line_in_all_documents_is_dealt_to_all_shards():
    import pyarrow as pa

    rng = random.Random(5)
    other = lambda n: bytes(rng.randrange(97, 123) for _ in range(n))
    texts = [other(60) + b"a line that stands in all documents here, " + other(60) for _ in range(400)]
    table = pa.table({"doc_id": list(range(400)), "bytes": texts})
    slots = lambda c: [len(c.distinct(n)[0]) for _, n in c.slots()]
    chunk = repeats._Chunk(table, 50, 1, 16)
    counts = chunk.counts()
    # windows around the line whose least part lies in the line
    assert counts.max() > 200 and max(slots(chunk)) > 1.7 * sum(slots(chunk)) / 16
    chunk.split(np.flatnonzero(counts > 100))
    dealt = slots(chunk)
    assert len(dealt) == 16 and max(dealt) < 1.25 * sum(dealt) / 16
    same = np.unique(chunk.start)
    assert len(same) == len(chunk.start)


def test_query_on_documents(spark, sf, shared_texts):
    found = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op4_repeats(spark, sf).collect())
    assert found == [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute(shared_texts, 50)]
