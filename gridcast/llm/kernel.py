"""Words, lines and window hashes of whole texts, vectorised over Arrow buffers.

Used inside ``mapInArrow`` tasks.  A word is a maximal run of bytes other
than 0x20 and 0x09-0x0D; these bytes never occur inside a multi-byte UTF-8
character, so byte runs and character runs agree.  Texts are handled in
chunks of ``CHUNK`` bytes (a longer text is a chunk of its own), which
bounds the memory of the temporary arrays by the longest text.

Hashes are multilinear: each byte is multiplied by a random 64-bit weight of
its position, the products are summed and mixed.  Windows of words use
prefix sums of a polynomial in an odd base modulo 2**64, so that the hash of
any word range costs two look-ups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1

NONSPACE = np.ones(256, dtype=bool)
NONSPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
IDENTITY = np.arange(256, dtype=np.uint8)
LOWER = IDENTITY.copy()
LOWER[0x41:0x5B] += 0x20

_TABLES: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def weights(n: int) -> np.ndarray:
    """``n`` random 64-bit weights, the same on every machine."""
    if "w" not in _TABLES or len(_TABLES["w"]) < n:
        size = max(1024, 1 << max(n - 1, 1).bit_length())
        _TABLES["w"] = mix(np.arange(1, size + 1, dtype=U64) * U64(0xD1342543DE82EF95)) | U64(1)
    return _TABLES["w"]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64."""
    if "p" not in _TABLES or len(_TABLES["p"]) < n:
        size = max(1 << 16, 1 << max(n - 1, 1).bit_length())
        inverse = pow(BASE, -1, 1 << 64)
        for key, base in (("p", BASE), ("q", inverse)):
            step = np.full(size, U64(base))
            step[0] = 1
            _TABLES[key] = np.cumprod(step, dtype=U64)
    return _TABLES["p"], _TABLES["q"]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), off


class Texts:
    """A chunk of texts: ``data`` bytes, ``off`` offsets, and their words.

    ``start``/``end`` are the words' byte ranges, ``first[i]:first[i + 1]``
    the words of text ``i``, ``doc`` the text of each word.
    """

    def __init__(self, data: np.ndarray, off: np.ndarray, lo: int):
        self.lo = lo
        self.n = len(off) - 1
        self.data = data[off[0] : off[-1]]
        self.off = off - off[0]
        non = NONSPACE[self.data]
        cut = np.zeros(len(non) + 1, bool)
        cut[self.off] = True
        before = np.empty(len(non), bool)
        before[:1] = True
        before[1:] = ~non[:-1]
        after = np.empty(len(non), bool)
        after[-1:] = True
        after[:-1] = ~non[1:]
        self.non = non
        self.start = np.flatnonzero(non & (before | cut[:-1]))
        self.end = np.flatnonzero(non & (after | cut[1:])) + 1
        self.first = np.searchsorted(self.start, self.off)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.n), self.count)

    def per_text(self, flag: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Sums of ``flag`` over the ranges between ``bounds``."""
        total = np.concatenate(([0], np.cumsum(flag, dtype=np.int64)))
        return total[bounds[1:]] - total[bounds[:-1]]

    def range_hashes(self, start: np.ndarray, length: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Hash of each of the disjoint, ascending, non-empty byte ranges."""
        if not len(start):
            return np.zeros(0, U64)
        begin = np.cumsum(length) - length
        inside = np.arange(begin[-1] + length[-1]) - np.repeat(begin, length)
        table = weights(int(length.max()) + 1)
        products = table[inside + 1] * values.astype(U64)
        return mix(np.add.reduceat(products, begin) + length.astype(U64) * table[0])

    def word_hashes(self, table: np.ndarray = IDENTITY) -> np.ndarray:
        """Hash of each word; ``table`` maps bytes first (see LOWER)."""
        return self.range_hashes(self.start, self.end - self.start, table[self.data[self.non]])

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end byte of each \\n-separated line, and its text."""
        newline = self.data == 0x0A
        starts = np.sort(np.concatenate((self.off[:-1], np.flatnonzero(newline) + 1)))
        doc = np.searchsorted(self.off[1:], np.flatnonzero(newline), side="right")
        doc = np.sort(np.concatenate((np.arange(self.n), doc)))
        ends = np.empty_like(starts)
        ends[:-1] = starts[1:] - (doc[1:] == doc[:-1])
        ends[-1:] = len(self.data)
        return starts, ends, doc


class Windows:
    """Hashes of word ranges from the words' hashes."""

    def __init__(self, words: np.ndarray):
        self.power, self.inverse = powers(len(words) + 1)
        self.sums = np.concatenate((np.zeros(1, U64), np.cumsum(words * self.power[: len(words)], dtype=U64)))

    def __call__(self, start: np.ndarray, length) -> np.ndarray:
        """Hash of the words from each ``start`` on."""
        raw = (self.sums[start + length] - self.sums[start]) * self.inverse[start]
        return mix(raw + np.asarray(length).astype(U64) * U64(0xA0761D6478BD642F))


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[Texts]:
    """The column's texts in order, chunk by chunk."""
    data, off = buffers(column)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        yield Texts(data, off[lo : hi + 1], lo)
        lo = hi


def starts_of(texts: Texts, length: int) -> np.ndarray:
    """Word positions at which a window of ``length`` words fits its text."""
    where = np.arange(len(texts.start))
    return where[where + length <= texts.first[texts.doc + 1]]


def shingles(texts: Texts, words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of each window of ``length`` words; a text of fewer
    words (but at least one) has one shingle, its whole word sequence."""
    window = Windows(words)
    at = starts_of(texts, length)
    short = np.flatnonzero((texts.count > 0) & (texts.count < length))
    values = np.concatenate((window(at, length), window(texts.first[short], texts.count[short])))
    doc = np.concatenate((texts.doc[at], short))
    return values, doc


def runs(values: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal values of one text: an order that brings them together, and
    the start of each run in that order (with the end appended)."""
    order = np.argsort(mix(values ^ mix(doc.astype(U64) + U64(1))), kind="stable")
    v, d = values[order], doc[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
    return order, np.concatenate((np.flatnonzero(new), [len(v)]))


def list_array(values: np.ndarray, count: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and each row's count."""
    off = np.concatenate(([0], np.cumsum(count))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values, kind))
