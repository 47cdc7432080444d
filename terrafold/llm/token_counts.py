"""Token counts of a BPE vocabulary without encoding whole texts.

Most words of a text are a single token. ``whole_tokens`` proves, once for a
vocabulary, which of its strings are: the string must come through normaliser
and pre-tokenizer as one piece, and the merges must bring that piece to one
token, its own. A text's pre-tokens found among the proven strings count one
each; only the rest is merged, and what was merged is remembered, within a
bound.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from terrafold.llm.common import text_or_empty, worker_store

#: Merged pieces that a worker remembers, the longest (bytes), and the bytes of a text looked at together.
PIECES, PIECE_BYTES, STRETCH = 200_000, 64, 1 << 20

#: Fixed value: how the tokenizer cuts small ASCII text.
PRE_TOKENS = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x09-\x0D\x20a-z0-9]+")
SPACE = re.compile(rb"[\x09-\x0D\x20]")
END = "</w>"


def _load(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def whole_tokens(tokenizer) -> dict[bytes, str]:
    """Strings (UTF-8) that alone are one token, with their names in the vocabulary.

    A name that ends a word stands for the text its signs decode to. It is kept
    only if each step of the tokenizer is seen to leave it whole.
    """
    normal, cut, model = tokenizer.normalizer, tokenizer.pre_tokenizer, tokenizer.model
    signs = {piece: byte for byte, piece in byte_signs(tokenizer).items()}
    proven = {}
    for name, number in tokenizer.get_vocab(with_added_tokens=False).items():
        piece = name.removesuffix(END)
        if piece == name or not all(c in signs for c in piece):
            continue
        data = bytes(signs[c] for c in piece)
        try:
            text = data.decode()
        except UnicodeDecodeError:
            continue  # no text has it as a piece
        pieces = [p for p, _ in cut.pre_tokenize_str(text)]
        if normal.normalize_str(text) == text and pieces == [piece] and [t.id for t in model.tokenize(piece)] == [number]:
            proven[data] = piece
    return proven


def byte_signs(tokenizer) -> dict[int, str]:
    """The sign that stands for each byte in the vocabulary's names."""
    from tokenizers.pre_tokenizers import ByteLevel

    plain = ByteLevel(add_prefix_space=False, use_regex=False)
    found = {}
    # characters whose UTF-8 forms hold every byte that UTF-8 has
    places = [*range(0x800), *range(0x800, 0xD800, 0x800), *range(0xE000, 0x10000, 0x800), *range(0x10000, 0x110000, 0x10000)]
    for text in map(chr, places):
        (piece, _), *_ = plain.pre_tokenize_str(text)
        found |= dict(zip(text.encode(), piece))
    return found


class Counter:
    """Counts the tokens of texts as the tokenizers library gives them."""

    def __init__(self, path: str):
        self.tokenizer = _load(path)
        self.proven = whole_tokens(self.tokenizer)
        self.names = set(self.proven.values())
        self.pieces = _Merged(self._merged)
        self.chunks = _Merged(self._chunk)
        # proven strings count one without a merge
        self.pieces.update(dict.fromkeys(self.proven, 1))
        self.pieces.limit += len(self.proven)
        signs = byte_signs(self.tokenizer)
        self.signs = [signs.get(b) for b in range(256)]

    def _merged(self, piece: bytes) -> int:
        """Tokens of one small ASCII pre-token, by merging."""
        return len(self.tokenizer.model.tokenize("".join(map(self.signs.__getitem__, piece))))

    def _chunk(self, chunk: bytes) -> int:
        """Tokens of what stands between white space, beyond ASCII: cut by the library, then as others."""
        text = self.tokenizer.normalizer.normalize_str(chunk.decode("utf-8", "replace"))
        model, names = self.tokenizer.model, self.names
        return sum(1 if p in names else len(model.tokenize(p)) for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text))

    def count(self, text: bytes) -> int:
        """Tokens of a UTF-8 text, looked at in stretches that end at white space."""
        at, total = 0, 0
        while len(text) - at > STRETCH:
            end = SPACE.search(text, at + STRETCH)
            if end is None:
                break
            total, at = total + self._stretch(text[at : end.start()]), end.end()
        return total + self._stretch(text[at:] if at else text)

    def _stretch(self, text: bytes) -> int:
        if b"<|" not in text and text.isascii():
            return sum(map(self.pieces.__getitem__, PRE_TOKENS.findall(text.lower())))
        chunks, special = text.split(), 0
        if b"<|" in text:
            # special strings: the library finds them before it normalises
            named = [c for c in chunks if b"<|" in c]
            special = sum(len(self.tokenizer.encode(c.decode("utf-8", "replace"), add_special_tokens=False).ids) for c in named)
            chunks = [c for c in chunks if b"<|" not in c]
        plain = b" ".join([c for c in chunks if c.isascii()]).lower()
        other = [c for c in chunks if not c.isascii()]
        return special + sum(map(self.chunks.__getitem__, other)) + sum(map(self.pieces.__getitem__, PRE_TOKENS.findall(plain)))


class _Merged(dict):
    """Counts by piece; a missing one is counted, and kept while there is room."""

    def __init__(self, count):
        super().__init__()
        self.count, self.limit = count, PIECES

    def __missing__(self, piece: bytes) -> int:
        found = self.count(piece)
        if len(self) < self.limit and len(piece) <= PIECE_BYTES:
            self[piece] = found
        return found


def counter(path: str) -> Counter:
    """The worker's counter for a vocabulary file; the proof is made once a worker."""
    kept = worker_store().setdefault("counters", {})
    if path not in kept:
        kept[path] = Counter(path)
    return kept[path]


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every whole text.

    Special strings inside a text are special tokens, as the library takes them
    by default. Null and empty texts have none; repeated rows get equal rows, an
    empty table none. Other columns are left behind, whatever their names.
    """

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        count = counter(path).count
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.binary_length(texts).cast(pa.int64())
            found = pa.array([count(t.as_py()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, found], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
