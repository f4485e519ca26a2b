"""Token ids of whole texts with a public tokenizer file, fast enough for a corpus.

The tokenizers of this library split a text at white space before anything else
looks at more than one character, so the ids of a text are the ids of its white
space separated chunks, one after the other.  ``ChunkEncoder`` uses that: it keeps
the ids of chunks it has met in a bounded table and asks the tokenizers library
only about new ones.  Chunks of plain Latin letters, digits and ASCII punctuation
go straight to the library's model (their pre-tokens are read with one regular
expression); every other chunk takes the library's whole pipeline.  Arrow splits the
texts and finds the distinct chunks of a block, so that Python sees each once a block.
``tests/llm/test_operators.py`` holds both ways against ``Tokenizer.encode``.
"""

from __future__ import annotations

import os
import re
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks, and pre-tokens, kept by one worker; bounds its memory.
CACHE_ENTRIES = 120_000
#: Bytes encoded at once, about: the larger, the fewer times a chunk is met.
ENCODE_BLOCK = 2_000_000

# Letters whose lower case is one code point and that NFC leaves alone.
_LETTER = "a-zA-ZÀ-ÖØ-öø-įĲ-ňŊ-ž"
_NOT_ASCII = re.compile(r"[^\x00-\x7F]+")
_ODD = re.compile(f"[^!-~{_LETTER}\n]")
_SPLIT = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LETTER}]+|[0-9]|\n|[^0-9{_LETTER}\n]+")


def public_tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Path of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The letter that a byte-level vocabulary writes for each byte: printable
    Latin-1 bytes stand for themselves, the others follow from code point 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in table:
            table[b] = chr(256 + len(table) - len(plain))
    return table


class _Rows:
    """Rows of ids of differing lengths, one after the other in a growing array."""

    def __init__(self):
        self.flat, self.start, self.length = np.empty(1 << 16, np.uint32), np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)
        self.used = self.rows = 0

    def add(self, flat: np.ndarray, length: np.ndarray) -> int:
        """Append rows; returns the number of the first."""
        first, end, rows = self.rows, self.used + len(flat), self.rows + len(length)
        if end > len(self.flat):
            self.flat = np.resize(self.flat, 2 * end)
        if rows > len(self.start):
            self.start, self.length = np.resize(self.start, 2 * rows), np.resize(self.length, 2 * rows)
        self.flat[self.used : end] = flat
        self.length[first:rows] = length
        self.start[first:rows] = self.used + np.cumsum(length) - length
        self.used, self.rows = end, rows
        return first

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the rows ``at``, joined, and the length of each."""
        n = self.length[at]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(self.start[at] - ends + n, n)], n

    def cut(self, rows: int) -> None:
        """Forget all but the first ``rows`` rows."""
        self.rows, self.used = rows, int(self.start[rows - 1] + self.length[rows - 1]) if rows else 0


def _first(place: dict, n: int, rows: _Rows) -> dict:
    """The first ``n`` entries, which hold the first rows."""
    kept = dict(islice(place.items(), n))
    rows.cut(1 + max(kept.values(), default=-1))
    return kept


def bytes_of(chunks: pa.Array) -> list[bytes]:
    """``chunks``, which hold no line feed, as a list; one cut is faster than an object each."""
    if len(chunks) == 0:
        return []
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(chunks)], pa.int32()), chunks.cast(pa.binary())), b"\n")
    return joined[0].as_py().split(b"\n")


class ChunkEncoder:
    """Ids of texts by the tokenizer file at ``path``, without special tokens added.

    Null and empty texts have no ids.  Only files of the word-level byte pair kind
    (NFC, white space dropped, lower case, word ends marked) may be given;
    ``encode`` gives what ``Tokenizer.encode(text, add_special_tokens=False).ids`` gives.
    """

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self._whole = Tokenizer.from_file(path)
        self._words = Tokenizer(self._whole.model)  # pre-tokens between blanks, as they are
        self._words.normalizer, self._words.pre_tokenizer = normalizers.Sequence([]), pre_tokenizers.WhitespaceSplit()
        self._letters = _byte_letters()
        self._entries = entries
        self._marks = re.compile("|".join(re.escape(t.content) for t in self._whole.get_added_tokens_decoder().values()) or r"(?!)")
        vocabulary = self._whole.get_vocab(with_added_tokens=True)
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        self._place: dict[bytes, int] = {b"": 0}  # what stands before a leading blank
        self._chunks = _Rows()
        self._chunks.add(np.empty(0, np.uint32), np.zeros(1, np.int64))
        self._pieces = _Rows()
        self._pieces.add(np.empty(0, np.uint32), np.zeros(1, np.int64))
        self._piece_place: dict[str, int] = {"\n": 0}  # the end of a chunk has no ids

    def _shrink(self) -> None:
        """Of a full table the first half stays: what was met first is mostly frequent."""
        if len(self._place) > self._entries:
            self._place = _first(self._place, self._entries // 2, self._chunks)
        if len(self._piece_place) > self._entries:
            self._piece_place = _first(self._piece_place, self._entries // 2, self._pieces)

    @property
    def vocabulary_size(self) -> int:
        return self._whole.get_vocab_size(with_added_tokens=True)

    def _spelt(self, m: re.Match) -> str:
        return "".join(map(self._letters.__getitem__, m[0].encode()))

    def _learn_pieces(self, new: list[str]) -> None:
        text = _NOT_ASCII.sub(self._spelt, " ".join(new))
        ids = np.asarray(self._words.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        length = np.diff(np.flatnonzero(self._ends[ids]), prepend=-1)
        first = self._pieces.add(ids, length)
        self._piece_place.update(zip(new, range(first, first + len(new)), strict=True))

    def _learn(self, new: list[bytes]) -> None:
        text = b"\n".join(new).decode()
        lines = text.split("\n")
        odd = [m.start() for m in _ODD.finditer(text)] + [m.start() for m in self._marks.finditer(text)]
        if odd:
            ends = np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)) + 1)
            whole = np.unique(np.searchsorted(ends, odd, side="right")).tolist()
            for i in whole:
                ids = np.asarray(self._whole.encode(lines[i], add_special_tokens=False).ids, np.uint32)
                self._place[new[i]] = self._chunks.add(ids, np.array([len(ids)]))
            plain = np.delete(np.arange(len(new)), whole).tolist()
            new, text = [new[i] for i in plain], "\n".join([lines[i] for i in plain])
        if not new:
            return
        every = _SPLIT.findall(text.lower() + "\n")
        at = np.fromiter(map(self._piece_place.get, every, repeat(-1)), np.int64, len(every))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            self._learn_pieces(list(dict.fromkeys(map(every.__getitem__, missing))))
            at[missing] = list(map(self._piece_place.__getitem__, map(every.__getitem__, missing)))
        flat, n = self._pieces.take(at)
        length = np.diff(np.cumsum(n)[at == 0], prepend=0)
        first = self._chunks.add(flat, length)
        self._place.update(zip(new, range(first, first + len(new)), strict=True))

    def encode_flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text's after the other's, as unsigned 32-bit integers,
        and the number of each text's."""
        self._shrink()
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        chunks = split.flatten().dictionary_encode()
        every = bytes_of(chunks.dictionary)
        at = np.fromiter(map(self._place.get, every, repeat(-1)), np.int64, len(every))
        if missing := np.flatnonzero(at < 0).tolist():
            new = [every[i] for i in missing]
            self._learn(new)
            at[missing] = list(map(self._place.__getitem__, new))
        flat, n = self._chunks.take(at[chunks.indices.to_numpy()])
        past = np.concatenate(([0], np.cumsum(n)))[np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))]
        return flat, np.diff(past, prepend=0)

    def encode_many(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        flat, n = self.encode_flat(pa.array(texts, pa.large_string()))
        return np.split(flat, np.cumsum(n)[:-1]) if len(texts) else []

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_many([text])[0]


_encoders: dict[str, ChunkEncoder] = {}


def worker_encoder(path: str) -> ChunkEncoder:
    """The encoder of this Python worker, whose table serves all tasks it runs."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def let_go(path: str) -> None:
    """Forget this worker's encoder; the next task that needs one learns anew."""
    _encoders.pop(path, None)


def blocks(texts: list[str | None], most: int = 1_500_000):
    """Slices of ``texts`` with about ``most`` characters at most, one text at least."""
    first = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t or "") > most:
            yield slice(first, i)
            first, size = i, 0
        size += len(t or "")
    if first < len(texts):
        yield slice(first, len(texts))


def slices(batch: pa.RecordBatch, text: str = "text", most: int = ENCODE_BLOCK):
    """Slices of ``batch`` with about ``most`` bytes of text at most, one row at least."""
    size = np.cumsum(pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(size):
        past = max(first + 1, int(np.searchsorted(size, (size[first - 1] if first else 0) + most, side="right")))
        yield batch.slice(first, past - first)
        first = past
