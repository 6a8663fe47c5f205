"""Token ids of whole texts by a public tokenizer file, at the speed of its distinct words.

The tokenizer lower-cases, cuts a text into words (letters, single digits, runs of symbols, a few
contractions) and runs BPE inside each word. Texts of ASCII and Latin-1 letters are cut for a whole
batch with array operations; BPE runs once for each distinct word that a worker meets, and the ids
of a batch are built with one gather. Other texts go through the whole tokenizer, distinct piece
between spaces by distinct piece.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from segmill.llm.common import as_array, ragged, text_bytes

#: Bytes of words and ids that a worker remembers before it starts anew, and of the longest word that it remembers.
CACHE_BYTES, KEPT_BYTES = 192 << 20, 256
#: What a remembered word takes beside its letters and ids (a string, a dictionary entry).
_ENTRY = 130
#: Contractions that the tokenizer keeps as one word.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
#: How a sentencepiece model writes a space, and a byte.
SPACE_PIECE, _BYTE_PIECE = "\u2581", re.compile("<0x[0-9A-F]{2}>")
_BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")
_SPACE, _LETTER, _DIGIT, _SYMBOL, _ODD = range(5)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _shown() -> dict[int, str]:
    """Byte-level BPE writes a byte as a letter: itself if printable in Latin-1, else 256, 257, ..."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _byte_letters() -> dict[int, str]:
    letter = _shown()
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(128, 256)}


def _classes() -> np.ndarray:
    kind = np.full(256, _ODD, np.uint8)
    kind[33:127] = _SYMBOL
    kind[[9, 10, 11, 12, 13, 32]] = _SPACE
    kind[ord("0") : ord("9") + 1] = _DIGIT
    for first in "aA":
        kind[ord(first) : ord(first) + 26] = _LETTER
    kind[0xC3] = kind[0x80:0xC0] = _LETTER  # the two bytes of a Latin-1 letter
    return kind


_BYTES, _CLASS = _byte_letters(), _classes()
_SHOWN = {c: letter for c, letter in _shown().items() if c < 128} | _BYTES


class WordEncoder:
    """Encodes string columns with a tokenizers file; keeps the ids of words seen before.

    What it keeps is bounded in bytes: long words (texts without spaces) are encoded each time, and
    their ids are let go with the rest once all ids and words together pass `cache_bytes`.
    """

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.bpe = self.tokenizer.model.tokenize
        self.cache_bytes = cache_bytes
        self._clear()

    def _clear(self) -> None:
        self.places: tuple[dict[str, int], dict[str, int]] = ({}, {})
        self.starts = np.zeros(1024, np.int64)
        self.lengths = np.zeros(1024, np.int32)
        self.ids = np.zeros(4096, np.int32)
        self.kept = self.used = self.held = 0

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a string column, joined, and offsets (n + 1); null is empty."""
        column = pc.fill_null(as_array(column), "")
        data, offsets = text_bytes(column)
        odd = self._odd_texts(data, offsets)
        if not odd.any():
            return self._encode_plain(data, offsets)
        parts = {}
        for flag, encode in ((False, lambda c: self._encode_plain(*text_bytes(c))), (True, self._encode_other)):
            rows = np.flatnonzero(odd == flag)
            parts[flag] = (rows, *encode(column.take(pa.array(rows)))) if len(rows) else (rows, np.empty(0, np.int32), np.zeros(1, np.int64))
        lengths = np.zeros(len(column), np.int64)
        for rows, _, cuts in parts.values():
            lengths[rows] = np.diff(cuts)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = np.empty(int(ends[-1]), np.int32)
        for rows, own, _ in parts.values():
            ids[ragged(ends[rows], lengths[rows])] = own
        return ids, ends

    @staticmethod
    def _odd_texts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts with other than ASCII and Latin-1 letters, or with the mark of a special token."""
        bad = _CLASS[data] == _ODD
        if len(data) > 1:
            high = data >= 0x80
            after = data[:-1] == 0xC3
            bad[1:] |= after & ((data[1:] == 0x97) | (data[1:] == 0xB7))
            bad[1:] |= high[1:] & (data[1:] < 0xC0) & ~after
            bad[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
        if len(data):
            bad[0] |= 0x80 <= data[0] < 0xC0
        at = np.flatnonzero(bad)
        odd = np.zeros(len(offsets) - 1, bool)
        odd[np.searchsorted(offsets, at, side="right") - 1] = True
        return odd

    def _encode_plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.empty(0, np.int32), np.zeros(len(offsets), np.int64)
        low = data.copy()
        low[(data >= 65) & (data <= 90)] += 32
        second = np.flatnonzero(data[:-1] == 0xC3) + 1
        second = second[data[second] < 0xA0]
        low[second[data[second] != 0x9F]] += 32
        kind = _CLASS[low]
        cut = np.ones(len(low) + 1, bool)
        cut[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        cut[offsets] = True
        quotes = np.flatnonzero(low == ord("'"))
        if len(quotes):
            self._join_contractions(low, cut, offsets, quotes)
        bounds = np.flatnonzero(cut)
        words = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(low))
        at = self._known(words.dictionary_encode(), 0)
        lengths = self.lengths[at]
        ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        ids = self.ids[np.repeat(self.starts[at] - ends[:-1], lengths) + np.arange(ends[-1])]
        return ids, ends[np.searchsorted(bounds, offsets)]

    @staticmethod
    def _join_contractions(low: np.ndarray, cut: np.ndarray, offsets: np.ndarray, quotes: np.ndarray) -> None:
        first = quotes[cut[quotes]]
        text_end = offsets[np.searchsorted(offsets, first, side="right")]
        taken = np.zeros(len(first), bool)
        for word in CONTRACTIONS:
            size = len(word)
            fits = ~taken & (first + size <= text_end)
            for j in range(1, size):
                fits &= low[np.minimum(first + j, len(low) - 1)] == ord(word[j])
            hits = first[fits]
            cut[hits + 1] = False
            cut[hits + size] = True
            taken |= fits

    def _encode_other(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pieces = pc.split_pattern(pc.replace_substring(column.cast(pa.large_string()), "\n", " "), " ")
        at = self._known(pieces.flatten().dictionary_encode(), 1)
        lengths = self.lengths[at].astype(np.int64)
        ids = self.ids[ragged(self.starts[at], lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        cuts = pieces.offsets.to_numpy()
        return ids, ends[cuts - cuts[0]]

    def _known(self, coded: pa.DictionaryArray, whole: int) -> np.ndarray:
        """Places of the ids of each coded word (whole: of pieces for the whole tokenizer), until the next call."""
        if self.held > self.cache_bytes:
            self._clear()
        words, place = coded.dictionary.to_pylist(), self.places[whole]
        at = np.fromiter((place.get(w, -1) for w in words), np.int64, len(words))
        if len(missing := np.flatnonzero(at < 0)):
            new = [words[i] for i in missing.tolist()]
            at[missing] = self._store(new, self._encode_new(new, whole), place)
        return at[coded.indices.to_numpy(zero_copy_only=False)]

    def _encode_new(self, words: list[str], whole: int) -> list[list[int]]:
        if whole:
            return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        bpe = self.bpe
        return [[t.id for t in bpe(w if w.isascii() else w.translate(_BYTES))] if w > " " else [] for w in words]

    def _store(self, keys: list[str], ids: list[list[int]], place: dict[str, int]) -> np.ndarray:
        """Places of the words' ids; long words get one too, but are not found under it again."""
        lengths = np.fromiter(map(len, ids), np.int32, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum()))
        first, end = self.kept, self.kept + len(keys)
        self.starts = _room(self.starts, end)
        self.lengths = _room(self.lengths, end)
        self.ids = _room(self.ids, self.used + len(flat))
        self.starts[first:end] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first:end] = lengths
        self.ids[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        self.kept = end
        short = {w: k for k, w in enumerate(keys, first) if len(w) <= KEPT_BYTES}
        place.update(short)
        self.held += 4 * len(flat) + 12 * len(keys) + sum(map(len, short)) + _ENTRY * len(short)
        return np.arange(first, end)


class ByteLevelEncoder(WordEncoder):
    """The same for byte-level BPE, whose words keep their case and the space before them.

    A word is an optional space and letters, digits or symbols; white space before a word is a word
    without its last character; a few contractions begin a word of their own. plain_specials: marks
    of special tokens are ordinary text.
    """

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES, plain_specials: bool = False):
        super().__init__(path, cache_bytes)
        self.tokenizer.encode_special_tokens = plain_specials

    def _encode_new(self, words: list[str], whole: int) -> list[list[int]]:
        if whole:
            return super()._encode_new(words, whole)
        bpe = self.bpe
        return [[t.id for t in bpe(w.translate(_SHOWN))] for w in words]

    def _encode_plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.empty(0, np.int32), np.zeros(len(offsets), np.int64)
        kind = _CLASS[data]
        cut = np.ones(len(data) + 1, bool)
        cut[1:-1] = kind[1:] != kind[:-1]
        cut[offsets] = True
        inner = np.ones(len(data) + 1, bool)
        inner[offsets] = False
        ends = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] != _SPACE) & inner[1:-1]) + 1  # of white space before a word
        cut[ends - 1] = True
        cut[ends[data[ends - 1] == 32]] = False
        quotes = np.flatnonzero(data == ord("'"))
        if len(quotes):
            self._join_contractions(data, cut, offsets, quotes)
        bounds = np.flatnonzero(cut)
        words = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
        ids, ends = self._gathered(self._known(words.dictionary_encode(), 0))
        return ids, ends[np.searchsorted(bounds, offsets)]

    def _encode_other(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Other texts by the whole tokenizer, cut before a space that follows no white space: there a word always begins."""
        pieces = [_BEFORE_SPACE.split(t) for t in column.to_pylist()]
        cuts = np.cumsum([0, *map(len, pieces)])
        flat = pa.array(list(chain.from_iterable(pieces)), pa.large_string())
        ids, ends = self._gathered(self._known(flat.dictionary_encode(), 1))
        return ids, ends[cuts]

    def _gathered(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words at these places, where each word's end)."""
        lengths = self.lengths[at].astype(np.int64)
        return self.ids[ragged(self.starts[at], lengths)], np.concatenate([[0], np.cumsum(lengths)])


class PieceEncoder(ByteLevelEncoder):
    """Ids by a sentencepiece model of BPE pieces, in which a space only begins a piece.

    Such a model merges nothing across the beginning of a run of spaces, so each run with what follows
    it is encoded for itself. Texts are given with the space that the model itself puts before them.
    """

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.space = self.model.piece_to_id(SPACE_PIECE)
        self.cache_bytes = cache_bytes
        self._clear()

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = text_bytes(pc.fill_null(as_array(column), ""))
        if not len(data):
            return np.empty(0, np.int32), np.zeros(len(offsets), np.int64)
        cut = data == 32
        cut[1:] &= data[:-1] != 32
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        bounds = np.flatnonzero(cut)
        rest = np.ones(len(data), bool)
        rest[bounds] = False  # the space, which the model adds
        ends = np.append(bounds, len(data)) - np.arange(len(bounds) + 1)
        pieces = pa.LargeStringArray.from_buffers(len(bounds), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[rest]))
        ids, ends = self._gathered(self._known(pieces.dictionary_encode(), 0))
        return ids, ends[np.searchsorted(bounds, offsets)]

    def _encode_new(self, words: list[str], whole: int) -> list[list[int]]:
        return [ids if w else [self.space] for w, ids in zip(words, self.model.encode(words, num_threads=1), strict=True)]


class TokenBytes:
    """The bytes that each id of a vocabulary stands for."""

    def __init__(self, entries: list[bytes]):
        self.lengths = np.fromiter(map(len, entries), np.int64, len(entries))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    @classmethod
    def of_byte_level(cls, path: str) -> TokenBytes:
        from tokenizers import Tokenizer

        back = {letter: bytes([b]) for b, letter in _shown().items()}
        vocabulary = Tokenizer.from_file(path).get_vocab()
        entries = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            entries[i] = b"".join(back[c] for c in entry)
        return cls(entries)

    @classmethod
    def of_pieces(cls, path: str) -> TokenBytes:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
        return cls([bytes([int(p[3:5], 16)]) if _BYTE_PIECE.fullmatch(p) else p.replace(SPACE_PIECE, " ").encode() for p in pieces])

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ragged(self.starts[ids], self.lengths[ids])]


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    out = np.zeros(max(size, 2 * len(array)), array.dtype)
    out[: len(array)] = array
    return out
