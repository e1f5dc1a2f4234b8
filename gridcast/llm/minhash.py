"""Near-duplicate documents by BagMinHash over weighted word shingles.

A text is a bag of five-word shingles; a shingle's weight is its count.  Two
texts are linked when their weighted Jaccard similarity (sum of smaller over
sum of larger counts) is at least 0.8; classes are the components.

Signature: a bag is a region over (shingle, weight axis); every shingle
carries Poisson processes in time over its weight axis, discretised into the
blocks [0, 1), [1, 2), [2, 4), [4, 8) ...; the process of a block has the
block's length as rate, and a point belongs to the bag when its place on the
axis lies below the shingle's weight.  Points go to one of ``REGISTERS``
registers, a register keeps its earliest point, and a process stops once it
is later than the latest register: most shingles yield a point or two.  Two
bags agree in a register with probability equal to their weighted Jaccard
similarity, without bias.

Candidates: ``BANDS`` bands of ``ROWS`` registers.  Equal texts collapse
first.  A bucket's hub (the member that collides most) is paired with the
bucket's other members; pairs are verified by exact bag overlap and joined
to components, so that a group of thousands of copies costs a star, not a
square.  In a bucket that still holds several components the members are
compared inside a task, in blocks of about ``BLOCK`` members or
``BLOCK_ELEMENTS`` shingles, which bounds its memory up to one text's own
shingles: registers first, and where these agree in the threshold less
``SCREEN`` or more, the bags themselves.  A pair at the threshold falls below
that by seven standard deviations of its registers, with a probability under
1e-10, far less than the bands lose.  Only links leave the task, each from
the first band that its texts share, and no pairs of a bucket are written
out.

Cases: texts without a word (null, empty, blank) have no shingle and are a
class of their own each; texts of one to four words have their whole word
sequence as one shingle; equal rows share a class; texts that share a doc_id,
or have none, are judged each for itself; a class without any id has a null
class_id; an empty table gives no rows; other columns are carried by
``keep_one`` and ignored else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .common import connected, shielded, staged, text_key

SHINGLE = 5
THRESHOLD = 0.8
ROWS = 6
BANDS = 36
REGISTERS = ROWS * BANDS
BLOCK = 2048
BLOCK_ELEMENTS = 1 << 21
SCREEN = 0.2  # below the threshold


def bags(t: K.Texts, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: hash, text, count."""
    values, doc = K.shingles(t, t.word_hashes(), length)
    order, run = K.runs(values, doc)
    pick = order[run[:-1]]
    return values[pick], doc[pick], np.diff(run)


def signatures(values: np.ndarray, doc: np.ndarray, weight: np.ndarray, n: int, registers: int) -> np.ndarray:
    """BagMinHash registers (earliest times) of ``n`` bags: n x registers."""
    first = np.full(n * registers, np.inf)
    level, low, high = 0, 0, 1
    while True:
        inside = weight > low
        if not inside.any():
            break
        seed = K.mix(values[inside] + np.uint64(level * 0x9FB21C651E98DF25 % 2**64))
        _processes(first, seed, doc[inside], weight[inside], low, high, registers, n)
        level, low, high = level + 1, high, 2 * high
    return first.reshape(n, registers)


def _processes(first, seed, doc, weight, low, high, registers, n):
    """Run one block's Poisson processes until they pass the registers."""
    rate = float(high - low)
    clock = np.zeros(len(seed))
    step = 0
    while len(seed):
        # the fewer processes still run, the more points of each at once
        width = max(1, min(512, 32768 // len(seed)))
        steps = np.arange(step + 1, step + 1 + width, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        step += width
        a = K.mix((seed[:, None] + steps).ravel())
        gap = np.log(((a >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53).reshape(-1, width)
        times = clock[:, None] - np.cumsum(gap, axis=1) / rate
        clock = times[:, -1]
        b = K.mix(a)
        to = np.repeat(doc * registers, width) + ((b >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
        if high - low > 1:
            place = low + (b & np.uint64(0xFFFFFFFF)).astype(np.float64) * (rate * 2.0**-32)
            own = place < np.repeat(weight, width)
            np.minimum.at(first, to[own], times.ravel()[own])
        else:
            np.minimum.at(first, to, times.ravel())
        latest = first.reshape(n, registers).max(axis=1)
        go = clock < latest[doc]
        seed, doc, weight, clock = seed[go], doc[go], weight[go], clock[go]


def _sign(shingle: int, rows: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in K.chunks(batch.column("text")):
                values, doc, weight = bags(t, shingle)
                sig = signatures(values, doc, weight, t.n, rows * bands)
                some = np.flatnonzero(t.count > 0)
                if not len(some):
                    continue
                bits = K.mix(sig[some].view(np.uint64)).reshape(len(some), bands, rows)
                key = np.zeros((len(some), bands), np.uint64) + np.arange(bands, dtype=np.uint64)
                for r in range(rows):
                    key = K.mix(key + bits[:, :, r])
                take = pa.array(some + t.lo)
                raw = np.ascontiguousarray(bits.reshape(len(some), bands * rows).astype(np.uint16))
                short = pa.FixedSizeBinaryArray.from_buffers(pa.binary(raw.shape[1] * 2), len(some), [None, pa.py_buffer(raw)]).cast(pa.binary())
                lists = K.list_array(key.ravel().view(np.int64), np.full(len(some), bands), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(take), batch.column("key").take(take), lists, short], ["doc_id", "key", "bands", "sig"])

    return run


def weighted_jaccard(left: pa.Array, right: pa.Array, shingle: int) -> np.ndarray:
    """Weighted Jaccard similarity of texts, row by row."""
    out = np.zeros(len(left))
    lo, sizes = 0, np.diff(K.buffers(left)[1]) + np.diff(K.buffers(right)[1])
    ends = np.cumsum(sizes)
    while lo < len(left):
        base = ends[lo] - sizes[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, base + K.CHUNK, side="right")))
        both = [pa.chunked_array([x.slice(lo, hi - lo)]).combine_chunks() for x in (left, right)]
        sides = []
        for x in both:
            data, off = K.buffers(x)
            t = K.Texts(data, off, 0)
            sides.append(K.shingles(t, t.word_hashes(), shingle))
        values = np.concatenate((sides[0][0], sides[1][0]))
        doc = np.concatenate((sides[0][1], sides[1][1]))
        mine = np.concatenate((np.ones(len(sides[0][0]), np.int64), np.zeros(len(sides[1][0]), np.int64)))
        order, run = K.runs(values, doc)
        n = hi - lo
        if len(order):
            a = np.add.reduceat(mine[order], run[:-1])
            b = np.diff(run) - a
            d = doc[order[run[:-1]]]
            smaller = np.bincount(d, weights=np.minimum(a, b), minlength=n)
            larger = np.bincount(d, weights=np.maximum(a, b), minlength=n)
            out[lo:hi] = np.divide(smaller, larger, out=np.zeros(n), where=larger > 0)
        lo = hi
    return out


def _verify(shingle: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = pa.array(weighted_jaccard(batch.column("left"), batch.column("right"), shingle) >= threshold)
            yield batch.select(["a", "b"]).filter(ok)

    return run


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """Pairs (``a``, ``b``) whose texts reach the similarity."""
    left = texts.select(F.col("doc_id").alias("l"), F.col("text").alias("left"))
    right = texts.select(F.col("doc_id").alias("r"), F.col("text").alias("right"))
    rows = pairs.join(right, F.col("b") == F.col("r")).join(left, F.col("a") == F.col("l")).select("a", "b", "left", "right")
    return rows.mapInArrow(_verify(shingle, threshold), "a long, b long")


def _texts(docs: DataFrame, shingle: int, rows: int, bands: int) -> tuple[DataFrame, DataFrame, bool]:
    """Signatures and texts under ids that name one text each.

    The id is the doc_id.  Where a doc_id stands over several texts, or is
    null, each text gets a negative number of its own instead; the last value
    tells whether there are any.  Signatures keep the doc_id as ``own``."""
    base = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    keyed = base.withColumn("key", text_key(F.col("text")))
    signed = staged(keyed.mapInArrow(_sign(shingle, rows, bands), "doc_id long, key string, bands array<long>, sig binary"), "minhash-bands")
    per_id = signed.groupBy("doc_id").agg(F.min("key").alias("x"), F.max("key").alias("y"))
    several = staged(per_id.where("x < y OR doc_id IS NULL").select(F.col("doc_id").alias("several"), F.lit(True).alias("many")), "minhash-several")
    if several.isEmpty():
        return signed.withColumn("own", F.col("doc_id")), base, False
    number = F.lit(-1) - F.xxhash64("key").bitwiseAND(F.lit((1 << 62) - 1))

    def named(rows: DataFrame) -> DataFrame:
        found = rows.join(several, F.col("doc_id").eqNullSafe(F.col("several")), "left").withColumn("own", F.col("doc_id"))
        return found.withColumn("doc_id", F.when(F.col("many"), number).otherwise(F.col("doc_id"))).drop("several", "many")

    return staged(named(signed), "minhash-named"), named(keyed).select("doc_id", "text"), True


def _members(docs: DataFrame, shingle: int, threshold: float, rows: int, bands: int) -> tuple[DataFrame, bool]:
    """``own, key, label`` of every distinct text that has a word: its doc_id,
    its key, and the name of its class."""
    signed, base, odd = _texts(docs, shingle, rows, bands)
    # equal texts collapse to their smallest id
    groups = staged(signed.groupBy("key").agg(F.min("doc_id").alias("rep")), "minhash-groups")
    reps = signed.join(groups.select(F.col("rep").alias("doc_id"), "key"), ["doc_id", "key"]).dropDuplicates(["doc_id"])
    labels = _link(_buckets(reps), reps, base, shingle, threshold)
    members = signed.select("own", "key").join(groups, "key").join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    return members.select("own", "key", F.coalesce("label", "rep").alias("label")), odd


def near_classes(docs: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """``doc_id, class_id`` for every row; class_id is the smallest doc_id."""
    members, odd = _members(docs, shingle, threshold, rows, bands)
    if not odd:
        found = members.groupBy("own").agg(F.min("label").alias("class_id"))
        ids = docs.select(docs["doc_id"].alias("doc_id"))
        return ids.join(found, F.col("doc_id") == F.col("own"), "left").select("doc_id", F.coalesce("class_id", F.col("doc_id").cast("long")).alias("class_id"))
    members = staged(members.distinct(), "minhash-members-odd")
    named = members.groupBy(F.col("label").alias("l")).agg(F.min("own").alias("class_id"))
    found = members.join(named, F.col("label") == F.col("l")).select("own", "key", "class_id")
    ids = docs.select(docs["doc_id"].alias("doc_id"), text_key(docs["text"]).alias("k"))
    on = F.col("doc_id").cast("long").eqNullSafe(F.col("own")) & (F.col("k") == F.col("key"))
    return ids.join(found, on, "left").select("doc_id", F.coalesce("class_id", F.col("doc_id").cast("long")).alias("class_id"))


def _buckets(reps: DataFrame) -> DataFrame:
    """``bucket, id, size, degree`` for buckets of two members or more."""
    members = reps.select(F.col("doc_id").alias("id"), F.explode("bands").alias("bucket"))
    # (the small sides are staged: a join of two plain shuffles is split where one key is hot)
    shared = staged(members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "minhash-shared")
    held = staged(members.join(shared, "bucket"), "minhash-buckets")
    degree = staged(held.groupBy("id").agg(F.sum("size").alias("degree")), "minhash-degree")
    return staged(held.join(degree, "id"), "minhash-members")


def _elements(shingle: int):
    """Each text's bag as a sorted set: the hash of a shingle and its count
    so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in K.chunks(batch.column("text")):
                values, doc = K.shingles(t, t.word_hashes(), shingle)
                order, run_ = K.runs(values, doc)
                size = np.diff(run_)
                nth = np.arange(len(order)) - np.repeat(run_[:-1], size)
                values, doc = K.mix(values[order] + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), doc[order]
                order = np.lexsort((values, doc))
                lists = K.list_array(values[order].view(np.int64), np.bincount(doc, minlength=t.n), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(t.lo, t.n), lists], ["id", "elements"])

    return run


def _compare(threshold: float, screen: float):
    """Links between different labels among the members of each group."""

    def links(rows: pa.Table) -> tuple[list, list]:
        ids, labels, half, band = (rows.column(c).to_numpy() for c in ("id", "label", "half", "band"))
        sigs = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint16).reshape(len(rows), -1)
        bands = rows.column("bands").combine_chunks()
        bands = bands.flatten().to_numpy().reshape(len(rows), -1)[:, : int(band[0])]
        held = [x.values.to_numpy().view(np.uint64) for x in rows.column("elements").combine_chunks()]
        size = np.array([len(x) for x in held])
        two, a, b = half.any(), [], []
        for i in range(len(rows)):
            # inside one block every pair once, between two blocks across
            other = np.flatnonzero((labels != labels[i]) & (half > half[i] if two else np.arange(len(rows)) > i))
            other = other[np.minimum(size[other], size[i]) >= threshold * np.maximum(size[other], size[i])]
            other = other[~(bands[other] == bands[i]).any(axis=1)]
            other = other[(sigs[other] == sigs[i]).mean(axis=1) >= screen]
            if not len(other):
                continue
            flat = np.concatenate([held[j] for j in other])
            at = np.minimum(np.searchsorted(held[i], flat), size[i] - 1)
            shared = np.add.reduceat((held[i][at] == flat).astype(np.int64), np.cumsum(size[other]) - size[other])
            near = other[shared >= threshold * (size[other] + size[i] - shared)]
            a += [int(ids[i])] * len(near)
            b += ids[near].tolist()
        return a, b

    def groups(rows: pa.Table, edge: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for lo, hi in zip(edge, edge[1:], strict=False):
            x, y = links(rows.slice(int(lo), int(hi - lo)))
            a, b = a + x, b + y
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            part = rows.column("part").to_numpy()
            edge = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
            rest = rows.slice(int(edge[-1]))
            yield from groups(rows, edge)
        if rest is not None:
            yield from groups(rest, np.array([0, len(rest)]))

    return run


def _across(open_: DataFrame, reps: DataFrame, base: DataFrame, shingle: int, threshold: float, block: int, block_elements: int) -> DataFrame:
    """Links across components (``a``, ``b``) in buckets of several.  A
    bucket of more than ``block`` members or ``block_elements`` shingles is
    compared block by block: each member goes to every pair of blocks with
    its own."""
    ids = staged(open_.select(F.col("id").alias("i")).distinct(), "minhash-open")
    texts = base.join(ids, F.col("doc_id") == F.col("i")).select(F.col("doc_id").alias("id"), "text").dropDuplicates(["id"])
    bags_ = texts.mapInArrow(_elements(shingle), "id long, elements array<long>")
    whole = staged(bags_.join(reps.select(F.col("doc_id").alias("id"), "sig", "bands"), "id"), "minhash-bags")
    lengths = whole.select(F.col("id").alias("i"), F.size("elements").alias("length"))
    total = staged(open_.join(lengths, F.col("id") == F.col("i")).groupBy("bucket").agg(F.sum("length").alias("total")), "minhash-totals")
    parts = F.greatest(F.ceil(F.col("size") / block), F.ceil(F.col("total") / block_elements), F.lit(1))
    rows = open_.join(total, "bucket").withColumn("n", parts.cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("n")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    rows = rows.withColumn("part", F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")))
    # half tells the two blocks of a pair apart; one block alone has none
    rows = rows.withColumn("half", F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2))
    full = rows.join(whole, "id").withColumn("band", F.array_position("bands", F.col("bucket")) - 1)
    dealt = full.select("part", "id", "label", "half", "band", "sig", "bands", "elements").repartition("part").sortWithinPartitions("part", "id")
    return dealt.mapInArrow(_compare(threshold, threshold - SCREEN), "a long, b long")


def _link(members: DataFrame, reps: DataFrame, base: DataFrame, shingle: int, threshold: float, block: int = BLOCK, block_elements: int = BLOCK_ELEMENTS) -> DataFrame:
    """Components (``id``, ``label``) of the verified links."""
    hubs = members.groupBy("bucket").agg(F.max(F.struct("degree", (-F.col("id")).alias("least"))).alias("top"))
    hubs = staged(hubs.select("bucket", (-F.col("top.least")).alias("hub")), "minhash-hubs")
    star = members.join(hubs, "bucket").where("id <> hub")
    pairs = staged(star.select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b")).distinct(), "minhash-star")
    links = staged(_verified(pairs, base, shingle, threshold), "minhash-links")
    labels = connected(links)
    marked = staged(members.join(labels, "id", "left").select("bucket", "id", "size", F.coalesce("label", "id").alias("label")), "minhash-marked")
    spread = staged(marked.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("bucket"), "minhash-spread")
    open_ = staged(marked.where("size > 2").join(spread, "bucket"), "minhash-several")
    if open_.isEmpty():
        return labels
    more = staged(_across(open_, reps, base, shingle, threshold, block, block_elements), "minhash-more")
    return labels if more.isEmpty() else connected(links.union(more))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` with one document of each class: the smallest id (of
    one id over several texts the least text key; a null id comes last).  Of
    repeated rows one stays; rows without a word all stay but repeated ones."""
    members, odd = _members(docs, shingle, threshold, ROWS, BANDS)
    members = staged(members, "minhash-classes")
    plain = shielded(docs, "doc_id", "text")
    key = text_key(plain["text"])
    if not odd:
        lost = staged(members.where("own <> label").select(F.col("own").alias("lost")).distinct(), "minhash-lost")
        rest = plain.join(lost, plain["doc_id"] == F.col("lost"), "left_anti")
    else:
        order = F.struct(F.col("own").isNull().alias("none"), "own", "key")
        kept = members.groupBy("label").agg(F.min(order).alias("kept")).select(F.col("label").alias("l"), "kept")
        lost = members.join(kept, F.col("label") == F.col("l")).where(order != F.col("kept")).select(F.col("own").alias("lost"), F.col("key").alias("lost_key"))
        lost = staged(lost.distinct(), "minhash-lost")
        rest = plain.join(lost, plain["doc_id"].cast("long").eqNullSafe(F.col("lost")) & (key == F.col("lost_key")), "left_anti")
    twice = rest.groupBy("doc_id").count().where("count > 1")
    if not twice.isEmpty():
        rest = rest.withColumn("key", text_key(F.col("text"))).dropDuplicates(["doc_id", "key"]).drop("key")
    return rest.toDF(*docs.columns)
