"""Token ids by the tokenizers library, piece by piece.

The tokenizer drops white space before it splits and never looks across it, so a text's ids are those of its words in
order, and a word's those of its pieces. Texts repeat words, and words repeat pieces. The words of a stretch of texts
become codes of its different words; these are lowered and split together by the tokenizer's own rules (Latin letters
and ASCII; other words take the library's normalizer and splitter), each piece is merged by the library once a worker
and kept, up to a bound; the ids of the texts are then gathered by the codes.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

WORD_BPE = "word_bpe_49k.json"
#: Entries of the younger half of a cache; the older half has as many at most.
KEPT = 250_000
KEPT_LENGTH = 64
#: Texts of about this many bytes are encoded together.
STRETCH = 8 << 20

#: Anything but white space, printable ASCII and Latin letters that normalize to themselves and have a lower case of one letter.
OTHER = re.compile("[^\\x20\\x09-\\x0D!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e]")
#: The tokenizer's own split of words without such in lower case, each followed by a line feed.
SPLIT = re.compile("\n|'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017e]+|[0-9]|[^a-z\u00df-\u00f6\u00f8-\u017e0-9\\x20\\x09-\\x0D]+")


def byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in byte-level vocabularies: printable bytes for themselves, the others in
    order from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


LETTERS = byte_letters()


class _Kept(dict):
    """A cache of two generations: when the younger one is full it becomes the older one, whose entries return when
    they are used again."""

    def __init__(self):
        self._older = {}

    def __missing__(self, key: str) -> bytes:
        ids = self._older.get(key)
        if ids is None:
            ids = self.made(key)
        if len(key) <= KEPT_LENGTH:
            if len(self) >= KEPT:
                self._older = dict(self)
                self.clear()
            self[key] = ids
        return ids


class _Pieces(_Kept):
    """Ids of lowered pieces, little-endian unsigned 32-bit."""

    def __init__(self, tokenizer):
        super().__init__()
        # The model of a tokenizer is a new object each time; the function keeps this one.
        self._tokenize = tokenizer.model.tokenize
        self._bytes = [i.to_bytes(4, "little") for i in range(tokenizer.get_vocab_size())]

    def made(self, piece: str) -> bytes:
        if piece == "\n":  # ends a word
            return b""
        letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(LETTERS)
        ids = self._bytes
        return b"".join([ids[t.id] for t in self._tokenize(letters)])


class _Words(_Kept):
    """Ids of words of any script, by all the library's steps."""

    def __init__(self, tokenizer):
        super().__init__()
        self._tokenizer = tokenizer

    def made(self, word: str) -> bytes:
        return b"".join([i.to_bytes(4, "little") for i in self._tokenizer.encode(word, add_special_tokens=False).ids])


class WordEncoder:
    """``encode`` gives the ids of texts (UTF-8) as little-endian unsigned 32-bit integers.

    For the public word tokenizer: lower case, ASCII white space dropped and a border, letters and marks split.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self._pieces, self._words = _Pieces(tokenizer), _Words(tokenizer)

    def _of_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words, one after the other, and how many each has."""
        text = "\n".join(words) + "\n"
        if "<|" in text or OTHER.search(text):  # the first may begin a special token
            plain = [not ("<|" in w or OTHER.search(w)) for w in words]
            ids = [self._piecewise(w) if p else self._words[w] for w, p in zip(words, plain, strict=True)]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        else:
            pieces = SPLIT.findall(text.lower())
            ids = list(map(self._pieces.__getitem__, pieces))
            through = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
            ends = through[np.fromiter(map("\n".__eq__, pieces), bool, len(pieces))]
            sizes = np.diff(ends, prepend=0) // 4
        return np.frombuffer(b"".join(ids), "<u4"), sizes

    def _piecewise(self, word: str) -> bytes:
        return b"".join(map(self._pieces.__getitem__, SPLIT.findall(word.lower())))

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (binary or string), and the bounds of each text's; a null is an empty text."""
        try:
            strings = texts.cast(pa.large_string())
        except pa.ArrowInvalid:  # bytes that are no UTF-8 become U+FFFD
            strings = pa.array([None if t is None else bytes(t).decode("utf-8", "replace") for t in texts.to_pylist()], pa.large_string())
        lists = pc.ascii_split_whitespace(strings.fill_null(""))
        coded = lists.flatten().dictionary_encode()
        ids, sizes = self._of_words(coded.dictionary.to_pylist())
        code = coded.indices.to_numpy()
        counts = sizes[code]
        through = np.concatenate([[0], np.cumsum(counts)])
        begins = np.cumsum(sizes) - sizes
        places = np.arange(through[-1]) + np.repeat(begins[code] - through[:-1], counts)
        words = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
        return ids[places], through[words]

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        ids, bounds = self.encode_array(pa.array(texts, pa.large_binary()))
        return [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def encode_rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
        """The first column and the ids of the second one, for stretches of rows."""
        waiting, size = [], 0
        for batch in batches:
            waiting.append(batch)
            size += batch.column(1).nbytes
            if size >= STRETCH:
                yield self._rows(waiting)
                waiting, size = [], 0
        if waiting:
            yield self._rows(waiting)

    def _rows(self, batches: list[pa.RecordBatch]) -> tuple[list, list[bytes]]:
        ids, bounds = self.encode_array(pa.concat_arrays([b.column(1).cast(pa.large_binary()) for b in batches]))
        texts = [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        return [x for b in batches for x in b.column(0).to_pylist()], texts


@cache
def word_encoder(path: str | None = None) -> WordEncoder:
    return WordEncoder(path or public_tokenizers.path(WORD_BPE))
