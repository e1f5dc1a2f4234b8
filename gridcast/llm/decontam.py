"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short and documents long, so a signature of fixed size on the
document side would lose them.  Instead each item keeps the ``k`` smallest
hashes of its distinct word shingles (its bottom-k MinHash sketch), where
``k`` belongs to the item's size partition: with partition bounds doubling,
``k = floor((1 - threshold) * upper bound) + 1``.  An item whose containment
in a document reaches the threshold misses at most
``floor((1 - threshold) * size)`` shingles there, so at least one sketch
value is among the document's shingle hashes: the search loses nothing.

Documents are read once.  A bitmap of the benchmark's shingle hashes, of a
fixed number of bits, goes to every task; a text that meets a sketch bit
passes on its hashes that meet the bitmap (false hits vanish in the join).
Candidates are joined on the sketch value and verified by exact containment
of the item's shingle set.

Words are compared with A-Z lowered.  Cases: null and empty texts, and items
of fewer words than a shingle, have no shingles and never match; items with
equal shingle sets each get their own rows; repeated document rows give one
row; a null id is carried; an empty table on either side gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .common import shielded, staged, text_key

SHINGLE = 5
THRESHOLD = 0.8
#: Bits of each bitmap; 2**22 bits are 512 KB whatever the benchmark's size.
BITS = 22


def _distinct_shingles(t: K.Texts, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending by text."""
    at = K.starts_of(t, length)
    values = K.Windows(t.word_hashes(K.LOWER))(at, length)
    return values, t.doc[at]


def _item_rows(shingle: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in K.chunks(batch.column("text")):
                values, doc = _distinct_shingles(t, shingle)
                order, starts = K.runs(values, doc)
                pick = order[starts[:-1]]
                values, doc = values[pick], doc[pick]
                order = np.lexsort((values, doc))
                values, doc = values[order], doc[order]
                size = np.bincount(doc, minlength=t.n)
                upper = 1 << np.ceil(np.log2(np.maximum(size, 1) + 1)).astype(np.int64)
                k = np.floor((1 - threshold) * upper + 1e-9).astype(np.int64) + 1
                rank = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)
                sketch = rank < np.repeat(k, size)
                counts = np.bincount(doc[sketch], minlength=t.n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item_id").slice(t.lo, t.n), K.list_array(values.view(np.int64), size, pa.int64()), K.list_array(values[sketch].view(np.int64), counts, pa.int64())],
                    ["item_id", "shingles", "sketch"],
                )

    return run


def sketch_items(benchmark: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """``item_id, shingles, sketch`` of every item that has a shingle."""
    rows = benchmark.select(benchmark["item_id"].alias("item_id"), benchmark["text"].alias("text"))
    kind = dict(rows.dtypes)["item_id"]
    return rows.mapInArrow(_item_rows(shingle, threshold), f"item_id {kind}, shingles array<long>, sketch array<long>").where(F.size("shingles") > 0)


def _bitmap(items: DataFrame, column: str) -> bytes:
    """Packed bits set by the hashes in ``column``: 2**BITS bits."""
    # at most 2**BITS distinct positions, whatever the benchmark's size
    at = items.select(F.explode(column).alias("h")).select(F.col("h").bitwiseAND((1 << BITS) - 1).cast("int").alias("p")).distinct().toPandas()["p"].to_numpy()
    bits = np.zeros(1 << BITS, np.uint8)
    bits[at.astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def _hits(shingle: int, sketch, every):
    mask = np.uint64((1 << BITS) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_sketch = np.unpackbits(np.frombuffer(sketch.value, np.uint8)).view(bool)
        in_items = np.unpackbits(np.frombuffer(every.value, np.uint8)).view(bool)
        for batch in batches:
            for t in K.chunks(batch.column("text")):
                values, doc = _distinct_shingles(t, shingle)
                low = values & mask
                hot = np.zeros(t.n, bool)
                hot[doc[in_sketch[low]]] = True
                keep = np.flatnonzero(in_items[low] & hot[doc])
                values, doc = values[keep], doc[keep]
                order, starts = K.runs(values, doc)
                pick = np.sort(order[starts[:-1]])
                values, doc = values[pick], doc[pick]
                some = np.flatnonzero(hot)
                if len(some):
                    ids = batch.column("doc_id").slice(t.lo, t.n).take(pa.array(some))
                    yield pa.RecordBatch.from_arrays([ids, K.list_array(values.view(np.int64), np.bincount(doc, minlength=t.n)[some], pa.int64())], ["doc_id", "hits"])

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """Items found in documents: ``doc_id, item_id, n_shared, n_shingles``."""
    spark = docs.sparkSession
    items = staged(sketch_items(benchmark, shingle, threshold), "bench-items")
    sketch = spark.sparkContext.broadcast(_bitmap(items, "sketch"))
    every = spark.sparkContext.broadcast(_bitmap(items, "shingles"))
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    # a row number of its own, so that null and repeated ids stay apart
    found = staged(rows.mapInArrow(_hits(shingle, sketch, every), f"doc_id {kind}, hits array<long>").distinct().withColumn("row", F.monotonically_increasing_id()), "bench-hits")
    # items that share all shingles are one set, expanded at the end
    sets = items.groupBy("shingles").agg(F.first("sketch").alias("sketch")).withColumn("set", F.xxhash64("shingles"))
    keys = sets.select("set", F.explode("sketch").alias("h"))
    candidates = found.select("row", F.explode("hits").alias("h")).join(keys, "h").select("row", "set").distinct()
    pairs = candidates.join(sets.select("set", "shingles"), "set").join(found, "row")
    shared = F.size(F.array_intersect("shingles", "hits")).cast("long")
    verified = pairs.select("doc_id", "set", shared.alias("n_shared"), F.size("shingles").cast("long").alias("n_shingles"))
    verified = verified.where(F.col("n_shared") >= F.lit(threshold) * F.col("n_shingles")).groupBy("doc_id", "set", "n_shingles").agg(F.max("n_shared").alias("n_shared"))
    named = items.select("item_id", F.xxhash64("shingles").alias("set"))
    return verified.join(named, "set").select("doc_id", "item_id", "n_shared", "n_shingles").distinct()


def decontaminate(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of documents that hold no benchmark item, with all columns.  A
    text decides for itself: rows that share an id (or have none) do not
    decide for each other."""
    texts = docs.select(text_key(docs["text"]).alias("doc_id"), docs["text"].alias("text"))
    found = staged(contaminated(texts, benchmark, shingle, threshold).select(F.col("doc_id").alias("leaked")).distinct(), "bench-found")
    plain = shielded(docs, "text")
    return plain.join(found, text_key(plain["text"]) == F.col("leaked"), "left_anti").toDF(*docs.columns)
