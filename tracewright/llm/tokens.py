"""Token ids of whole texts by a public tokenizer file, with a bounded table of pre-tokens.

A byte-level tokenizer that lower-cases and splits into runs of letters, single
digits and runs of other characters gives each such pre-token ids of its own.
For texts of plain Latin letters a whole batch is split here at once, pre-tokens
are told apart by 128-bit hashes, and each worker keeps the ids of those it has
met; it asks the library's model for new ones only. Texts with any other
character, and other tokenizers, go through the library's whole chain. Marker
strings of special tokens inside a text are ordinary text.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np

#: Tokenizers of this worker, by file.
_LOADED: dict[str, "TextTokenizer"] = {}
#: Characters up to U+017F that the split below, lower-casing and normalization treat as the tokenizer does; a text
#: with any other is encoded by the library's whole chain.
_OTHER = re.compile("[^\t\n\r -~¡-įı-ſ]")
_PLAIN = 0x180
#: Texts whose ids tell whether a tokenizer splits like this.
_PROBES = (
    "It's A1b2 don't, x_y!'s", "Éa ½² straße\tñ «q»", "a \n\r b", "__ ~{|} 's'll", "we've'restart'mm'd'dd ''t !'re 'v 'l", "'",
)
#: Characters of texts worked on at once.
_BATCH = 1 << 19


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public vocabulary file; the files stay outside this repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer(path: str) -> "TextTokenizer":
    if path not in _LOADED:
        _LOADED[path] = TextTokenizer(path)
    return _LOADED[path]


def byte_letters() -> dict[int, str]:
    """The character that byte-level models use for each byte: printable ones themselves, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(0x100) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(others)}


_SPACE, _LETTER, _NUMBER, _REST = range(4)
_KIND = np.array(
    [_SPACE if c.isspace() else _LETTER if c.isalpha() else _NUMBER if c.isnumeric() else _REST for c in map(chr, range(_PLAIN))],
    dtype=np.uint8,
)
_LOWER = np.array([ord(c.lower()[0]) for c in map(chr, range(_PLAIN))], dtype=np.uint16)


def split(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the pre-tokens of lower-case code points: letter runs, digits, other runs, contractions."""
    kind = _KIND[points]
    n = len(kind)
    change = np.empty(n + 1, dtype=bool)
    change[0] = change[n] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:n])
    number = kind == _NUMBER
    change[1:n] |= number[1:]
    inside = kind != _SPACE
    begins, ends = change[:-1] & inside, change[1:] & inside
    if (points == 39).any():
        # An apostrophe that opens a run of other characters takes s, t, m, d, re, ve or ll with it.
        at = np.flatnonzero((points == 39) & begins & ends)
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        one, two = padded[at + 1], padded[at + 2]
        size = np.where(np.isin(one, [115, 116, 109, 100]), 2, 0)
        size[((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)] = 3
        at, size = at[size > 0], size[size > 0]
        ends[at] = False
        begins[at + 1] = False
        last = at + size - 1
        ends[last] = True
        after = last[last + 1 < n] + 1
        begins[after[kind[after] == _LETTER]] = True
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def _powers(base: int, size: int) -> np.ndarray:
    factors = np.full(size, base, dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


class _Hashes:
    """128-bit polynomial hashes of slices of an array."""

    BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so that they have inverses modulo 2**64

    def __init__(self):
        self.powers: list[tuple[np.ndarray, np.ndarray]] = []

    def _grow(self, n: int) -> None:
        if not self.powers or len(self.powers[0][0]) < n:
            size = 1 << max(16, (n - 1).bit_length())
            with np.errstate(over="ignore"):
                self.powers = [(_powers(base, size), _powers(pow(base, -1, 1 << 64), size)) for base in self.BASES]

    def of(self, values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(values)
        self._grow(n + 1)
        out = []
        with np.errstate(over="ignore"):
            for up, down in self.powers:
                sums = np.zeros(n + 1, dtype=np.uint64)
                np.cumsum((values + np.uint16(1)) * up[:n], out=sums[1:])
                h = (sums[stops] - sums[starts]) * down[starts]
                h ^= h >> np.uint64(31)
                h *= np.uint64(0xD6E8FEB86659FD93)
                h ^= h >> np.uint64(32)
                out.append(h)
        out[0][out[0] == 0] = 1
        return out[0], out[1]


class _Table:
    """Row numbers by 128-bit key: open addressing over arrays, all keys of a call at once."""

    def __init__(self):
        self.rows = 0
        self._size(1 << 16)

    def _size(self, slots: int) -> None:
        self.key, self.mark, self.row = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64), np.zeros(slots, np.int32)

    def find(self, key: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """Row of each key, or -1."""
        mask = np.uint64(len(self.key) - 1)
        found = np.full(len(key), -1, dtype=np.int32)
        live, at = np.arange(len(key)), key & mask
        while live.size:
            k = self.key[at]
            hit = (k == key[live]) & (self.mark[at] == mark[live])
            found[live[hit]] = self.row[at[hit]]
            on = ~hit & (k != 0)
            live, at = live[on], (at[on] + np.uint64(1)) & mask
        return found

    def add(self, key: np.ndarray, mark: np.ndarray) -> None:
        """Gives the next row numbers to keys that are new and distinct."""
        if 2 * (self.rows + len(key)) > len(self.key):
            used = self.key != 0
            old = self.key[used], self.mark[used], self.row[used]
            self._size(1 << (4 * (self.rows + len(key)) - 1).bit_length())
            self._place(*old)
        self._place(key, mark, np.arange(self.rows, self.rows + len(key), dtype=np.int32))
        self.rows += len(key)

    def _place(self, key: np.ndarray, mark: np.ndarray, row: np.ndarray) -> None:
        mask = np.uint64(len(self.key) - 1)
        live, at = np.arange(len(key)), key & mask
        while live.size:
            free = self.key[at] == 0
            self.key[at[free]], self.mark[at[free]], self.row[at[free]] = key[live[free]], mark[live[free]], row[live[free]]
            on = self.row[at] != row[live]  # of keys that want one free slot, one has it now
            on |= self.key[at] != key[live]
            live, at = live[on], (at[on] + np.uint64(1)) & mask


class TextTokenizer:
    """Encodes texts with a tokenizers file; ``words`` bounds the table."""

    def __init__(self, path: str, words: int = 500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.model = self.library.model
        self.letters = byte_letters()
        self.limit = words
        self.hashes = _Hashes()
        self.direct = True
        self._clear()
        self.direct = all(self.ids(t).tolist() == self._encode([t])[0] for t in _PROBES)
        self._clear()

    def _clear(self) -> None:
        self.table = _Table()
        self.first, self.pool, self.used = np.zeros(1 << 16, np.int64), np.zeros(1 << 18, np.uint32), 0

    def _by_model(self, piece: str) -> list[int]:
        if not piece.isascii():
            piece = piece.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(piece)]

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _learn(self, pieces: list[str], key: np.ndarray, mark: np.ndarray) -> None:
        rows = list(map(self._by_model, pieces))
        ids = np.fromiter(chain.from_iterable(rows), dtype=np.uint32)
        at, stop = self.table.rows, self.table.rows + len(rows)
        while stop + 1 > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.first[at + 1 : stop + 1] = self.used + np.cumsum(list(map(len, rows)))
        self.pool[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.table.add(key, mark)

    def _plain(self, text: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a plain text in a row, and how many there are up to each of the places ``ends`` (white space or its end)."""
        points = _LOWER[np.frombuffer(text.encode("utf-16-le"), dtype=np.uint16)]
        if not len(points):
            return np.empty(0, np.uint32), np.zeros(len(ends), np.int64)
        starts, stops = split(points)
        key, mark = self.hashes.of(points, starts, stops)
        row = self.table.find(key, mark)
        missing = np.flatnonzero(row < 0)
        if len(missing):
            one = missing[np.unique(key[missing], return_index=True)[1]]
            if self.table.rows + len(one) > self.limit:
                self._clear()
                one = np.sort(np.unique(key, return_index=True)[1])
            low = points.tobytes().decode("utf-16-le")
            self._learn([low[a:b] for a, b in zip(starts[one].tolist(), stops[one].tolist())], key[one], mark[one])
            row = self.table.find(key, mark)
        size = self.first[row + 1] - self.first[row]
        to = np.concatenate([[0], np.cumsum(size)])
        ids = self.pool[np.repeat(self.first[row] - to[:-1], size) + np.arange(to[-1])]
        return ids, to[np.searchsorted(starts, ends)]

    def ids(self, text: str | None) -> np.ndarray:
        """Ids of one whole text as unsigned 32-bit integers (null or blank: none)."""
        if not text:
            return np.empty(0, dtype=np.uint32)
        if not self.direct or _OTHER.search(text):
            return np.array(self._encode([text])[0], dtype=np.uint32)
        parts, at = [], 0
        while at < len(text):  # a very long text in parts that end at white space
            cut = text.rfind(" ", at + 1, at + _BATCH) if len(text) - at > _BATCH else len(text)
            cut = len(text) if cut < 0 else cut
            parts.append(self._plain(text[at:cut], np.empty(0, np.int64))[0])
            at = cut
        return np.concatenate(parts)

    def batch(self, texts: list[str | None], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """``ids, lengths``: the ids of some whole texts in a row, each followed by ``end_id`` if there is one."""
        chars = sum(map(len, filter(None, texts)))
        joined = "\n".join(t or "" for t in texts) if chars <= _BATCH else None
        if joined is not None and self.direct and not _OTHER.search(joined):
            ends = np.cumsum([len(t or "") + 1 for t in texts], dtype=np.int64) - 1
            flat, to = self._plain(joined, ends)
            lengths = np.diff(to, prepend=0)
        else:
            rows = [self.ids(t) for t in texts]
            flat = np.concatenate([np.empty(0, np.uint32), *rows])
            lengths = np.array([len(r) for r in rows], dtype=np.int64)
        if end_id is not None:
            flat = np.insert(flat, np.cumsum(lengths), np.uint32(end_id))
            lengths = lengths + 1
        return flat, lengths
