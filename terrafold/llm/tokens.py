"""Ids of a public BPE tokenizer, fast on texts whose words return.

The tokenizer drops white space between words and merges within a word only,
so ids of a text are the ids of its words in turn. Words that a worker has met
are looked up. Others are cut as the tokenizer cuts them, if they are ASCII or
Latin-1, and their pieces looked up or merged by the library's model; the rest
goes through the whole library. The table of words is bounded; beyond its bound
words are encoded each time they come.
"""

from __future__ import annotations

import array
import re
import unicodedata

from terrafold.llm.common import worker_store
from terrafold.llm.token_counts import byte_signs

#: Words kept by a worker, the longest that is kept, and the longest that is cut here (bytes).
WORDS, WORD_BYTES, CUT_BYTES = 250_000, 48, 1000

_STOP_AFTER_SYMBOL = re.compile(rb"[^a-z0-9 \n][.,][ \n]")
_STOP = re.compile(rb"(?<=[a-z0-9])([.,])(?=[ \n])")

#: Words whose composed and small forms need no tables beyond
#: Latin-1, and how the tokenizer cuts them once they are small.
_LATIN = re.compile("[\x00-\x7fÀ-ÖØ-öø-ÿ]*+")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\x09-\x0D\x20a-z0-9ß-öø-ÿ]+")


def default_path() -> str:
    """The vocabulary the queries use, where the box keeps it."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _packed(ids: list[int]) -> bytes:
    values = array.array("I", ids)
    if values.itemsize != 4:
        values = array.array("L", ids)
    return values.tobytes()


class _Words(dict):
    """Ids by word; a word that is missing is encoded."""

    def __init__(self, tokenizer):
        super().__init__({b"": b""})
        self.tokenizer, self.merge = tokenizer, tokenizer.model.tokenize
        self.signs = byte_signs(tokenizer)

    def __missing__(self, word: bytes) -> bytes:
        if word.isalpha() and word.islower() and len(word) < CUT_BYTES:
            found = _packed([token.id for token in self.merge(word.decode())])
        else:
            found = self._cut(word)
        if len(self) < WORDS and len(word) <= WORD_BYTES:
            self[word] = found
        return found

    def _cut(self, word: bytes) -> bytes:
        """Ids of a word that may be of several pieces."""
        text = word.decode("utf-8", "replace")
        if len(word) >= CUT_BYTES or "<|" in text or not _LATIN.fullmatch(text):
            return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        pieces = [piece.encode() for piece in _PIECES.findall(text.lower())]
        if len(pieces) == 1:
            return _packed([token.id for token in self.merge(pieces[0].decode("latin-1").translate(self.signs))])
        return b"".join(map(self.__getitem__, pieces))


class Encoder:
    """Encodes whole texts as the tokenizer does, and decodes ids."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words = _Words(self.tokenizer)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        named = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.names = [name.encode() for name in named]
        self.spans = [len(name) - 4 * name.endswith("</w>") for name in named]

    def encode(self, text: bytes) -> bytes:
        """Ids of a UTF-8 text as little-endian unsigned 32-bit integers."""
        lowered = text.lower()
        if b"<|" in text or not (text.isascii() or _composed(text, lowered)):
            lowered = text  # the tokenizer itself normalises each word
        elif _STOP_AFTER_SYMBOL.search(lowered) is None:
            for old, new in ((b", ", b" , "), (b". ", b" . "), (b".\n", b" .\n"), (b",\n", b" ,\n")):
                lowered = lowered.replace(old, new)
        else:
            lowered = _STOP.sub(rb" \1", lowered)
        return b"".join(map(self.words.__getitem__, lowered.replace(b"\n", b" ").split(b" ")))

    def decode(self, ids: bytes) -> bytes:
        """Names of the ids, as the tokenizer's decoder joins them."""
        return b" ".join(map(self.names.__getitem__, memoryview(ids).cast("I")))


def _composed(text: bytes, lowered: bytes) -> bool:
    """Whether small letters in place of A-Z leave the composed form as it is."""
    return all(unicodedata.is_normalized("NFC", x.decode("utf-8", "replace")) for x in (text, lowered))


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    kept = worker_store().setdefault("encoders", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]
