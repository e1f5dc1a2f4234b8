"""Product codes of vectors: nearest entries by a GNAT over each codebook.

A vector's components become integers ``floor(scale * x)`` and are cut into
``parts`` consecutive pieces.  Each part position has a codebook that starts
as that part of the vectors with the smallest ids; a round assigns every part
to its nearest entry (ties to the lower index) and replaces each entry by the
floored mean of its parts.  Entries without parts stay.

Search: the entries of a codebook form a GNAT (geometric near-neighbour
access tree).  A node picks split entries far from each other, gives every
other entry to its nearest split, and keeps for each (split, child) the range
of distances from the split to the child's entries.  A query that is ``d``
from a split and has ``r`` as its best distance so far drops a child whose
range lies wholly beyond ``[d - r, d + r]``.  Distances there are rounded
square roots, so that a child only goes when it is outside by more than the
rounding; entries themselves are compared by integer squares, so that ties
are true ties.  Whole batches of queries walk the tree together.

On Spark: the kept vectors are staged once as integers, a round is one pass
whose tasks add up their own parts (at most parts x entries sums leave a
task) and one small grouped sum.  Codebooks, the only thing that reaches the
driver, hold ``entries`` vectors whatever the input's size.

Cases: vectors that are null, or hold null or non-finite components, are
dropped; so are vectors of another length than the most frequent one (the
longer on ties).  With a length that is no multiple of ``parts`` the pieces
differ by one component, with an empty vector all codes are 0.  Components
saturate at ``2**30 / sqrt(length)``, which keeps all squared distances in a
long.  A null id counts as larger than others; repeated ids are ordered by
their vectors.  Fewer vectors than ``entries`` make smaller codebooks; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_enough, staged

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Splits of a node, and entries up to which a node is searched as a list.
SPLITS = 8
LEAF = 4
#: Relative rounding allowed for; that of square roots and sums is 2**-50.
ROUNDING = 2.0**-46
BROADCAST_LABELS = 100_000


def squares(points: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Squared distances of the points to one, as integers."""
    gap = points - one
    return np.einsum("ij,ij->i", gap, gap)


class Gnat:
    """Nearest entries of integer queries; ``tried`` counts the distances."""

    def __init__(self, entries: np.ndarray, splits: int = SPLITS, leaf: int = LEAF):
        self.entries = np.ascontiguousarray(entries, np.int64)
        self.splits, self.leaf, self.tried = splits, leaf, 0
        self.root = self._node(np.arange(len(entries)))

    def _node(self, members: np.ndarray):
        if len(members) <= self.leaf:
            return members, None
        points = self.entries[members]
        chosen, gaps = [0], [squares(points, points[0])]
        while len(chosen) < min(self.splits, len(members)):
            chosen.append(int(np.argmax(np.min(gaps, axis=0))))
            if chosen[-1] in chosen[:-1]:  # the rest equals a split
                chosen.pop()
                break
            gaps.append(squares(points, points[chosen[-1]]))
        owner = np.argmin(gaps, axis=0)
        owner[chosen] = np.arange(len(chosen))
        far = np.sqrt(np.array(gaps, np.float64))
        low = np.array([[far[i, owner == j].min() for j in range(len(chosen))] for i in range(len(chosen))])
        high = np.array([[far[i, owner == j].max() for j in range(len(chosen))] for i in range(len(chosen))])
        rest = np.ones(len(members), bool)
        rest[chosen] = False
        children = [self._node(members[rest & (owner == j)]) for j in range(len(chosen))]
        return members[chosen], (low, high, children)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each query's nearest entry."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        index = np.zeros(len(queries), np.int64)
        self._search(self.root, np.ascontiguousarray(queries, np.int64), np.arange(len(queries)), best, index)
        return index, best

    def _try(self, entry: int, queries, rows, best, index) -> np.ndarray:
        square = squares(queries[rows], self.entries[entry])
        self.tried += len(rows)
        better = (square < best[rows]) | ((square == best[rows]) & (entry < index[rows]))
        best[rows[better]], index[rows[better]] = square[better], entry
        return square

    def _search(self, node, queries, rows, best, index) -> None:
        heads, inner = node
        if inner is None:
            for entry in heads.tolist():
                self._try(entry, queries, rows, best, index)
            return
        low, high, children = inner
        alive = np.ones((len(rows), len(heads)), bool)
        for i, entry in enumerate(heads.tolist()):
            here = np.flatnonzero(alive[:, i])
            if not len(here):
                continue
            d = np.sqrt(self._try(entry, queries, rows[here], best, index).astype(np.float64))[:, None]
            r = np.sqrt(best[rows[here]].astype(np.float64))[:, None]
            slack = (d + r + high[i]) * ROUNDING
            alive[here] &= ~((d - r > high[i] + slack) | (d + r < low[i] - slack))
        for j, child in enumerate(children):
            below = rows[alive[:, j]]
            if len(below) and len(child[0]):
                self._search(child, queries, below, best, index)


def bounds(length: int, parts: int) -> list[tuple[int, int]]:
    """Component range of each part."""
    return [(p * length // parts, (p + 1) * length // parts) for p in range(parts)]


def _integers(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = column.flatten().cast(pa.float64())  # null rows have no values here
            value = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(size)), size)
            bad = np.bincount(row[~np.isfinite(value)], minlength=len(size)) > 0
            keep = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False) & ~bad)
            inside = np.isin(row, keep)
            limit = np.floor(2.0**30 / np.sqrt(np.maximum(size, 1)))[row[inside]]
            whole = np.clip(np.floor(value[inside] * scale), -limit, limit).astype(np.int32)
            off = np.concatenate(([0], np.cumsum(size[keep]))).astype(np.int32)
            take = pa.array(keep)
            lists = pa.ListArray.from_arrays(pa.array(off), pa.array(whole))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(take), batch.column("label").take(take), lists], ["vec_id", "label", "v"])

    return run


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(batch), len(flat) // max(len(batch), 1))


def _sums(books: list[np.ndarray]):
    """Each task's own sums: part, entry, place (-1: count) and total."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        count = [np.zeros(len(b), np.int64) for b in books]
        total = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            v = _matrix(batch)
            for p, (lo, hi) in enumerate(bounds(v.shape[1], len(books))):
                to, _ = trees[p].nearest(v[:, lo:hi])
                count[p] += np.bincount(to, minlength=len(count[p]))
                np.add.at(total[p], to, v[:, lo:hi])
        rows = []
        for p, n in enumerate(count):
            for e in np.flatnonzero(n).tolist():
                rows.append((p, e, -1, int(n[e])))
                rows += [(p, e, k, x) for k, x in enumerate(total[p][e].tolist())]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 4
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["part", "entry", "place", "total"])

    return run


def _encode(books: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        for batch in batches:
            v = _matrix(batch)
            codes, error = np.zeros((len(v), len(books)), np.uint8), np.zeros(len(v), np.int64)
            for p, (lo, hi) in enumerate(bounds(v.shape[1], len(books))):
                index, square = trees[p].nearest(v[:, lo:hi])
                codes[:, p], error = index, error + square
            text, width = codes.tobytes().hex(), 2 * len(books)
            code = [text[i * width : (i + 1) * width] for i in range(len(v))]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"])

    return run


def integer_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, label, v`` of the kept vectors, staged."""
    kinds = dict(vectors.dtypes)
    rows = vectors.select(vectors["vec_id"].alias("vec_id"), vectors["label"].alias("label"), vectors["embedding"].alias("vector"))
    found = staged(rows.mapInArrow(_integers(scale), f"vec_id {kinds['vec_id']}, label {kinds['label']}, v array<int>"), "codes-vectors")
    usual = found.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return found if usual is None else found.where(F.size("v") == usual["n"])


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks of ``integer_vectors`` after the rounds: at most ``entries``
    vectors reach the driver."""
    if entries > 256:
        raise ValueError("a code has two hex digits: at most 256 entries")
    seeds = rows.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    if not seeds:
        return []
    first = np.array([r["v"] for r in seeds], np.int64).reshape(len(seeds), -1)
    books = [first[:, lo:hi].copy() for lo, hi in bounds(first.shape[1], parts)]
    for _ in range(rounds):
        sums = rows.mapInArrow(_sums(books), "part int, entry int, place int, total long")
        new = {tuple(r[:3]): r[3] for r in sums.groupBy("part", "entry", "place").agg(F.sum("total")).collect()}
        for p, book in enumerate(books):
            for e in range(len(book)):
                if n := new.get((p, e, -1)):
                    book[e] = [new[p, e, k] // n for k in range(book.shape[1])]
    return books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components by part, entry and place."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every kept
    vector; null as ``label_error`` where the sum passes a long."""
    kinds = dict(vectors.dtypes)
    rows = integer_vectors(vectors, scale)
    books = train(rows, parts, entries, rounds)
    coded = staged(rows.mapInArrow(_encode(books), f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"), "codes-rows")
    errors = staged(coded.groupBy(F.col("label").alias("l")).agg(F.try_sum("error").alias("label_error")), "codes-labels")
    side = F.broadcast(errors) if small_enough(errors, BROADCAST_LABELS) else errors
    return coded.join(side, F.col("label").eqNullSafe(F.col("l"))).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
