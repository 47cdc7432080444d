"""Word tables, packing and tree concatenation against the tokenizers library."""

import array
import hashlib
import random
import zlib

import pytest

from terrafold.llm import bpe, packing, queries
from terrafold.llm.tokens import Encoder, default_path

ALPHABET = "aabbeethin 's't!?.,  \n\t12é́ßΣİK<|endoftext|>가각ᄀ\x1c\x85  "


@pytest.fixture(scope="module")
def coder():
    return Encoder(default_path())


def expected(coder, text):
    return array.array("I", coder.tokenizer.encode(text or "", add_special_tokens=False).ids).tobytes()


def random_texts(n):
    rng = random.Random(5)
    for k in range(n):
        size = rng.choice([5, 50, 400])
        if k % 3:
            yield "".join(rng.choice(ALPHABET) for _ in range(size))
        else:
            yield rng.choice(["a", "ab", "the", "'s", "!", "́", "<|endoftext|>", "éa"]) * size


def test_word_table_gives_the_ids_of_the_library(coder):
    for text in random_texts(600):
        assert coder.encode(text.encode()) == expected(coder, text), text


def test_words_of_several_pieces_are_cut_without_the_library(coder):
    class Counted:
        calls = 0

        def encode(self, text, **options):
            Counted.calls += 1
            return coder.tokenizer.encode(text, **options)

    rng = random.Random(8)
    alphabet = "aabeo'sl19.,!?-_\x00\x1f\x7f\t\r\x0b %ÀÉÖØÞßàéöøþÿñü"
    fresh = Encoder(default_path())
    fresh.words.tokenizer = Counted()
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.choice([4, 12, 60])))
        assert fresh.encode(text.encode()) == expected(coder, text), text
    assert Counted.calls == 0
    for text in ("a×b ª·º x² ½", "ŒUVRE İ ς", "<|x a<|endoftext|>É É", "é́", "é" * 2000):
        assert fresh.encode(text.encode()) == expected(coder, text), text


def test_tree_concatenation_gives_the_ids_of_the_whole(coder):
    for k, text in enumerate(random_texts(900)):
        assert bpe.encode_text(coder, text, leaf=(8, 40, 200)[k % 3]).tobytes() == expected(coder, text), text


def test_parts_of_a_long_text_join_to_its_ids(coder):
    rng = random.Random(2)
    for unit in ("abcdefg", "the cat ", "é́"):
        text = unit * 300
        cuts = sorted(rng.sample(range(1, len(text)), 6))
        parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        if unit == "é́":  # a cut between a letter and its mark is never made
            parts = [text[i : i + 80] for i in range(0, len(text), 80)]
        ids = [coder.encode(p.encode()) for p in parts]
        assert bpe.join_parts(coder, parts, ids).tobytes() == expected(coder, text)


def test_encode_handles_every_row(coder, make_docs, texts, monkeypatch):
    monkeypatch.setattr(bpe, "SPREAD", 40_000)
    monkeypatch.setattr(bpe, "SHARE", 10_000)
    found = bpe.encode(make_docs(texts), default_path()).collect()
    decode = lambda t: coder.tokenizer.decode(
        coder.tokenizer.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False
    )
    wanted = sorted((str(d), expected(coder, t), decode(t)) for d, t in texts)
    assert sorted((str(r.doc_id), bytes(r.ids), bytes(r.decoded).decode()) for r in found) == wanted
    assert bpe.encode(make_docs([]), default_path()).count() == 0


def test_query_equals_the_library_on_whole_texts(spark, sf, coder, shared_texts):
    found = {r.doc_id: r for r in queries.op6_bpe(spark, sf).collect()}
    assert len(found) == len(shared_texts)
    for doc_id, text in shared_texts:
        ids = expected(coder, text)
        decoded = coder.tokenizer.decode(memoryview(ids).cast("I").tolist(), skip_special_tokens=False)
        assert found[doc_id].ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert found[doc_id].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_best_multiset_is_the_best_subset_sum():
    rng = random.Random(1)
    for _ in range(200):
        counts = [(n, rng.randint(1, 3)) for n in sorted(rng.sample(range(1, 40), 4), reverse=True)]
        room = rng.randint(1, 90)
        sums = {0}
        for length, times in counts:
            sums = {s + length * k for s in sums for k in range(times + 1)}
        chosen = packing.best_multiset(counts, room)
        assert sum(n * k for n, k in chosen.items()) == max(s for s in sums if s <= room)
        assert all(k <= dict(counts)[n] for n, k in chosen.items())


def test_sequences_are_full_or_a_power_of_two():
    rng = random.Random(4)
    for _ in range(60):
        lengths = [rng.choice([1, 2, rng.randint(1, 100), rng.randint(1, 9000)]) for _ in range(rng.choice([1, 5, 200]))]
        pieces = {}
        for sequence in packing.pack_lengths(lengths):
            size = sum(x[2] for x in sequence)
            assert size == 4096 or size & (size - 1) == 0
            for doc, start, length in sequence:
                pieces.setdefault(doc, []).append((start, length))
        for doc, length in enumerate(lengths):
            at = 0
            for start, part in sorted(pieces[doc]):
                assert start == at
                at += part
            assert at == length


def check_pieces(coder, rows, docs):
    ids = {d: expected(coder, t) + (2).to_bytes(4, "little") for d, t in docs}
    places, sequences = {}, {}
    for r in rows:
        piece = ids[r.doc_id][4 * r.start : 4 * (r.start + r.length)]
        assert zlib.crc32(piece) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id]) // 4
        places.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc, held in ids.items():
        times = sum(d == doc for d, _ in docs)
        assert sum(n for _, n in places[doc]) == times * len(held) // 4
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def test_pieces_cover_every_row(spark, coder, make_docs, texts):
    from pyspark.sql import functions as F

    rows = packing.pack(make_docs(texts), default_path()).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_pieces(coder, rows, texts)
    assert packing.pack(make_docs([]), default_path()).count() == 0


def test_packing_query_covers_the_documents(spark, sf, coder, shared_texts):
    check_pieces(coder, queries.op3_packing(spark, sf).collect(), shared_texts)
