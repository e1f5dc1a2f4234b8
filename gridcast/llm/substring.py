"""Repeated word spans by compacted paths of sampled k-mers.

The dealt method, a de Bruijn graph of all k-mers whose nonbranching paths
are compacted by joins, is replaced by one that samples its edges: a window
of 50 words holds 41 ten-word k-mers, and every one of them as an edge with
its two (k-1)-word nodes is about twenty times the rows of the edges below
(8.2 million for 0.51 GB of text), in each of the joins by which pointers
double.  A window chooses one of its edges, so the runs of windows that share
an edge are the paths, and they are compared whole.

A window is ``WINDOW`` consecutive words of one document.  A word goes when a
window that covers it also starts in a document with a smaller id.

Graph: an edge is a k-mer of ``KMER`` words.  Of the k-mers inside a window
the one with the smallest hash stands for the window; equal windows choose
the same edge, so only edges that occur in two documents or more can carry a
repeated window.  The consecutive windows that chose one edge occurrence
form a path through that edge: a run of windows whose words are a span of
the source with known coordinates and a fingerprint of its own.

Compaction, by joins: edge occurrences with equal path fingerprint are one
nonbranching path, kept by its first document; every later document on the
path has all the path's windows in an earlier document, so its whole source
span goes at once.  Only where an edge branches (several different paths)
are the first documents' paths opened into windows, read from the source at
the recorded coordinates, and matched window by window.  A k-mer hash and a
path or window hash with different bases are compared together: 128 bits.

Words are read twice; per document only the spans to remove come back.

Cases: null and empty texts have no words; texts shorter than a window keep
all words; rows with equal doc_id are one document's rows (neither removes
from the other), each by its own text, and each gives a row; rows with a null doc_id keep all words
and match nothing; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .common import staged

WINDOW = 50
KMER = 10


def _second(words: np.ndarray) -> np.ndarray:
    """Another hash of the words, for the fingerprints."""
    return K.mix(words ^ np.uint64(0x5851F42D4C957F2D))


def edges(t: K.Texts, window: int, kmer: int) -> tuple[np.ndarray, ...]:
    """Chosen edges of a chunk: k-mer hash, path fingerprint, text, first
    and last window of the path (word positions inside the text)."""
    words = t.word_hashes()
    at = K.starts_of(t, window)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    grams = K.Windows(words)(np.arange(max(len(words) - kmer + 1, 0)), kmer)
    # smallest hash (the leftmost on ties) among the k-mers of each window,
    # by doubling the covered width
    width = window - kmer + 1
    best = np.arange(len(grams))
    covered = 1
    while covered < width:
        step = min(covered, width - covered)
        left, right = best[:-step], best[step:]
        best = np.where(grams[right] < grams[left], right, left)
        covered += step
    chosen = best[at]
    doc = t.doc[at]
    new = np.ones(len(at), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)
    last = np.concatenate((head[1:], [len(at)])) - 1
    first_at, last_at = at[head], at[last]
    path = K.Windows(_second(words))(first_at, last_at - first_at + window)
    # the place of the edge inside its path is part of the path
    path = K.mix(path + (chosen[head] - first_at).astype(np.uint64))
    base = t.first[doc[head]]
    return grams[chosen[head]], path, doc[head], first_at - base, last_at - base


def _sha(t: K.Texts, i: int, keep: np.ndarray | None = None) -> str:
    """SHA-256 of the kept words of text ``i`` joined by one space."""
    lo, hi = t.first[i], t.first[i + 1]
    raw = t.data[t.off[i] : t.off[i + 1]].tobytes()
    starts, ends = (t.start[lo:hi] - t.off[i]).tolist(), (t.end[lo:hi] - t.off[i]).tolist()
    if keep is None:
        return hashlib.sha256(b" ".join(raw[s:e] for s, e in zip(starts, ends, strict=True))).hexdigest()
    return hashlib.sha256(b" ".join(raw[s:e] for s, e, k in zip(starts, ends, keep.tolist(), strict=True) if k)).hexdigest()


def _emit_edges(window: int, kmer: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in K.chunks(batch.column("text")):
                gram, path, doc, first, last = edges(t, window, kmer)
                own = batch.select(["doc_id", "part"]).take(pa.array(doc + t.lo))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(gram.view(np.int64)), pa.array(path.view(np.int64)), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))],
                    ["doc_id", "part", "gram", "path", "first", "last"],
                )

    return run


def _emit_windows(window: int):
    """Hashes of the windows of the listed paths, with their text's id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("paths")
            counts = np.diff(paths.offsets.to_numpy()).astype(np.int64)
            flat = paths.flatten()
            gram, first, last = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            ends = np.concatenate(([0], np.cumsum(counts)))
            for t in K.chunks(batch.column("text")):
                own = slice(ends[t.lo], ends[t.lo + t.n])
                doc = np.repeat(np.arange(t.n), counts[t.lo : t.lo + t.n])
                n = (last[own] - first[own] + 1).astype(np.int64)
                if not n.sum():
                    continue
                inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = np.repeat(first[own].astype(np.int64), n) + inside
                d = np.repeat(doc, n)
                value = K.Windows(_second(t.word_hashes()))(t.first[d] + at, window)
                ids = batch.select(["doc_id", "part"]).take(pa.array(d + t.lo))
                yield pa.RecordBatch.from_arrays([*ids.columns, pa.array(np.repeat(gram[own], n)), pa.array(value.view(np.int64)), pa.array(at.astype(np.int32))], ["doc_id", "part", "gram", "value", "at"])

    return run


def _emit_kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = batch.column("spans")
        for t in K.chunks(batch.column("text")):
            removed, sha = np.zeros(t.n, np.int64), []
            for i in range(t.n):
                own = spans[t.lo + i].values if spans[t.lo + i].is_valid else None
                keep = None
                if own is not None and len(own):
                    n = int(t.count[i])
                    cover = np.zeros(n + 1, np.int64)
                    np.add.at(cover, own.field(0).to_numpy(), 1)
                    np.add.at(cover, own.field(1).to_numpy(), -1)
                    keep = np.cumsum(cover[:-1]) == 0
                    removed[i] = n - int(keep.sum())
                sha.append(_sha(t, i, keep))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(t.lo, t.n), pa.array(t.count.astype(np.int64)), pa.array(removed), pa.array(sha, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])


def _parted(docs: DataFrame) -> DataFrame:
    """``doc_id, text, part``: ``part`` tells the texts of one id apart; it is
    0 wherever an id has one text."""
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    value = F.xxhash64(F.coalesce("text", F.lit("")))
    ids = rows.where("doc_id is not null").select("doc_id", value.alias("v")).groupBy("doc_id").agg(F.min("v").alias("x"), F.max("v").alias("y"))
    several = staged(ids.where("x < y").select(F.col("doc_id").alias("several")), "graph-several")
    if several.isEmpty():
        return rows.withColumn("part", F.lit(0).cast("long"))
    found = rows.join(several, F.col("doc_id") == F.col("several"), "left")
    return found.select("doc_id", "text", F.when(F.col("several").isNull(), F.lit(0)).otherwise(value).cast("long").alias("part"))


def repeated_spans(rows: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """Word ranges to remove from ``rows`` (doc_id, text, part): ``doc_id,
    part, lo, hi`` (hi exclusive); ranges of one text may overlap."""
    base = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "part").where("doc_id is not null")
    found = staged(base.mapInArrow(_emit_edges(window, kmer), "doc_id long, part long, gram long, path long, first int, last int"), "graph-edges")
    # edges of two documents or more
    # (each small side is staged: a join of two plain shuffles is split where one key is hot)
    shared = staged(found.groupBy("gram").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).where("x < y").select("gram"), "graph-shared")
    held = staged(found.join(shared, "gram"), "graph-held")
    # paths: first document; an edge with several paths branches
    paths = staged(held.groupBy("gram", "path").agg(F.min("doc_id").alias("source")), "graph-paths")
    later = held.join(paths, ["gram", "path"]).where("doc_id > source").select("doc_id", "part", F.col("first").alias("lo"), (F.col("last") + window).alias("hi"))
    forks = staged(paths.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "graph-forks")
    forked = staged(paths.join(forks, "gram"), "graph-forked")
    opened = held.join(forked, ["gram", "path"]).where("doc_id = source").select("doc_id", "part", F.struct("gram", "first", "last").alias("p"))
    per_text = opened.distinct().groupBy("doc_id", "part").agg(F.collect_list("p").alias("paths"))
    texts = base.join(per_text, ["doc_id", "part"]).select("doc_id", "part", "text", "paths")
    windows = staged(texts.mapInArrow(_emit_windows(window), "doc_id long, part long, gram long, value long, at int"), "graph-windows")
    firsts = staged(windows.groupBy("gram", "value").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("most")).where("source < most").drop("most"), "graph-firsts")
    again = windows.join(firsts, ["gram", "value"]).where("doc_id > source").select("doc_id", "part", F.col("at").alias("lo"), (F.col("at") + window).alias("hi"))
    return later.union(again)


def remove_repeats(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row."""
    kind = dict(docs.dtypes)["doc_id"]
    rows = _parted(docs)
    spans = staged(repeated_spans(rows, window, kmer).distinct(), "graph-spans").groupBy("doc_id", "part").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    joined = rows.join(spans.toDF("i", "p", "spans"), (F.col("doc_id") == F.col("i")) & (F.col("part") == F.col("p")), "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_emit_kept, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")
