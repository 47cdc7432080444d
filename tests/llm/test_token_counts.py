"""Token counts against the tokenizers library."""

import random

import pytest

from terrafold.llm import queries, token_counts
from terrafold.llm.tokens import default_path

ALPHABET = "aabbeethin 's't!?.,  \n\t12é́ßΣİK<|endoftext|>가각ᄀ\x1c\x85\x00\x7f 　ﬁ²½Ⅷ٣🙂"


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(default_path())


def expected(counter, text):
    return len(counter.tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_proven_strings_are_one_token(counter):
    assert len(counter.proven) > 30_000
    sample = random.Random(1).sample(sorted(counter.proven), 3000)
    encoded = counter.tokenizer.encode_batch([x.decode() for x in sample], add_special_tokens=False)
    assert [len(e.ids) for e in encoded] == [1] * len(sample)


def test_a_name_that_its_merges_do_not_reach_is_not_proven(counter):
    names = counter.tokenizer.get_vocab(with_added_tokens=False)
    left = [n for n in names if n.endswith("</w>") and n[:-4].isascii() and n[:-4].isalpha() and n[:-4].encode() not in counter.proven]
    for name in left[:50]:
        assert expected(counter, name[:-4]) != 1 or name[:-4] != name[:-4].lower()


def test_counts_are_those_of_the_library(counter):
    rng = random.Random(5)
    for k in range(3000):
        size = rng.choice([1, 3, 10, 50, 400])
        text = "".join(rng.choice(ALPHABET) for _ in range(size)) if k % 3 else rng.choice(["a", "the", "'s", "!", "é", "é́a"]) * size
        assert counter.count(text.encode()) == expected(counter, text), text


def test_memory_bounds_do_not_change_counts(counter, monkeypatch):
    monkeypatch.setattr(token_counts, "PIECES", 5)
    monkeypatch.setattr(token_counts, "STRETCH", 40)
    small = token_counts.Counter(default_path())
    rng = random.Random(6)
    for _ in range(300):
        text = "".join(rng.choice(ALPHABET) for _ in range(300))
        assert small.count(text.encode()) == expected(counter, text)
    assert len(small.pieces) <= 5 + len(small.proven) and len(small.chunks) <= 5


def test_every_row_is_counted(spark, counter, make_docs, texts):
    texts = [*texts, (30, "x" * 300_000), (31, "word " * 200_000)]
    found = token_counts.count_tokens(make_docs(texts), default_path()).collect()
    wanted = sorted((str(d), len((t or "").encode()), expected(counter, t)) for d, t in texts)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in found) == wanted
    assert token_counts.count_tokens(make_docs([]), default_path()).count() == 0


def test_query_equals_the_library(spark, sf, counter, shared_texts):
    found = {r.doc_id: r for r in queries.op13_token_counts(spark, sf).collect()}
    assert len(found) == len(shared_texts)
    for doc_id, text in shared_texts:
        n = expected(counter, text)
        assert (found[doc_id].n_tokens, found[doc_id].n_bytes) == (n, len((text or "").encode()))
        assert found[doc_id].over_limit == (n > 2048)
