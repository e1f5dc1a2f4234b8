"""Quality rules with cross-document line frequency.

A line is normalised to its words (white space collapsed, A-Z lowered) and
hashed.  Per host (``source``) the distinct documents that hold a line are
counted; copies of one text count once.  A line is above the limit when at
least ``min_docs`` documents and more than ``max_share`` of the host's
distinct texts hold it, or when ``max_docs`` documents hold it, which does
not depend on the host's size.  Lines above the limit are removed from every
document of the host; a document that keeps less than ``min_left`` of its
words is depleted and rejected, as is one that fails the base rules.

A group of ``max_docs`` near copies makes all its lines common, so that every
member would be depleted and none be left for near-duplicate removal.  Each
line that is above ``max_docs`` alone therefore has a first text (the least
key that holds it), and a text that would be depleted keeps the lines whose
first text it is: one member of the group stays.

Two passes over the texts.  The first emits (host, line, text) keys that are
counted with partial aggregates.  The removed (host, line) keys go to the
tasks as one sorted array when they are few; else they are joined with the
texts' own lines by (host, line), and each text meets only its own ones.

Cases: a null or empty text has no words and fails the base rules; a null
host is a host of its own; repeated rows are judged alike; an empty table
gives no rows; other columns are carried by ``clean`` and ignored else.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .common import shielded, small_enough, staged


@dataclass(frozen=True)
class QualityRules:
    """Limits of the base rules and of the line frequency."""

    min_words: int = 50
    max_repeat_percent: int = 50
    min_docs: int = 10
    max_share: float = 0.1
    min_left: float = 0.3
    broadcast_hosts: int = 20_000
    max_docs: int | None = None
    broadcast_lines: int = 200_000


#: A line in ten texts of a host goes, however large the host is.
PRODUCTION = QualityRules(max_docs=10)

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

VERDICT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_boiler_words long, n_boiler_lines long, base_failed boolean, kept boolean"


def _line_words(t: K.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines that have a word: start and end byte, text, first word, words."""
    start, end, doc = t.lines()
    first = np.searchsorted(t.start, start)
    words = np.searchsorted(t.start, end) - first
    some = words > 0
    return start[some], end[some], doc[some], first[some], words[some]


def _line_keys(t: K.Texts, first: np.ndarray, words: np.ndarray) -> np.ndarray:
    return K.Windows(t.word_hashes(K.LOWER))(first, words)


def _emit_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct line keys of each text, one row per text."""
    for batch in batches:
        for t in K.chunks(batch.column("text")):
            _, _, doc, first, words = _line_words(t)
            keys = _line_keys(t, first, words)
            order, run = K.runs(keys, doc)
            pick = np.sort(order[run[:-1]])
            lists = K.list_array(keys[pick].view(np.int64), np.bincount(doc[pick], minlength=t.n), pa.int64())
            host = batch.column("host").slice(t.lo, t.n)
            key = batch.column("key").slice(t.lo, t.n)
            yield pa.RecordBatch.from_arrays([host, key, lists], ["host", "key", "lines"])


def _host_lines(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``host, key`` of each row, and of each of its distinct lines with ``line``."""
    rows = docs.select(_host(docs).alias("host"), _key(docs).alias("key"), docs["text"].alias("text"))
    found = rows.mapInArrow(_emit_lines, "host long, key long, lines array<long>")
    return rows.select("host", "key"), found.select("host", "key", F.explode("lines").alias("line"))


def _host(docs: DataFrame) -> Column:
    return F.xxhash64(docs["source"].isNull(), docs["source"])


def _key(docs: DataFrame) -> Column:
    """60 bits of the text's md5, which SQL can express."""
    return F.conv(F.substring(F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def line_frequency(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Lines above the limit: ``host``, ``line`` (keys) and ``first``, the
    key of the line's first text, null when the line is above ``max_share``."""
    rows, lines = _host_lines(docs)
    # one row per host, line and text, then documents per line
    held = lines.groupBy("host", "line", "key").agg(F.lit(1).alias("one")).groupBy("host", "line").agg(F.count("*").alias("docs"), F.min("key").alias("first"))
    texts = rows.groupBy("host", "key").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("texts"))
    over = held.where(F.col("docs") >= rules.min_docs).join(texts, "host")
    share = F.col("docs") > F.col("texts") * rules.max_share
    listed = share if rules.max_docs is None else share | (F.col("docs") >= rules.max_docs)
    return over.where(listed).select("host", "line", F.when(~share, F.col("first")).alias("first"))


def _judge(t: K.Texts, find, rules: QualityRules) -> tuple[list[np.ndarray], tuple]:
    """Columns of VERDICT for a chunk, and its removed lines.  ``find`` tells
    which lines (key, text) are above the limit, and which of these have
    their first text here."""
    data = t.data
    chars = t.non & ((data & 0xC0) != 0x80)
    word_chars = t.per_text(chars, t.off)
    symbols = t.per_text(SYMBOLS[data], t.off)
    words = t.word_hashes()
    # words in 3-word windows found twice or more in the text
    at = K.starts_of(t, 3)
    cover = np.zeros(len(words) + 3, bool)
    if len(at):
        order, run = K.runs(K.Windows(words)(at, 3), t.doc[at])
        twice = np.repeat(np.diff(run) > 1, np.diff(run))
        hit = at[order[twice]]
        for k in range(3):
            cover[hit + k] = True
    repeat = t.per_text(cover[: len(words)], t.first)
    # lines with a word, equal to an earlier line
    start, end, doc, first, n = _line_words(t)
    edge = np.zeros(len(data) + 1, np.int8)
    edge[start] += 1
    edge[end] -= 1
    raw = t.range_hashes(start, end - start, data[np.cumsum(edge[:-1], dtype=np.int8) > 0])
    order, run = K.runs(raw, doc)
    dup = np.bincount(doc, minlength=t.n) - np.bincount(doc[order[run[:-1]]], minlength=t.n)
    # removed lines
    keys = _line_keys(t, first, n).view(np.int64)
    gone, own = find(keys, doc)
    words_of = lambda flag: np.bincount(doc, weights=n * flag, minlength=t.n).astype(np.int64)
    depleted = t.count - words_of(gone) < rules.min_left * t.count
    gone = gone & ~(own & depleted[doc])
    boiler = words_of(gone)
    boiler_lines = np.bincount(doc, weights=gone, minlength=t.n).astype(np.int64)
    failed = (t.count < rules.min_words) | (100 * repeat > rules.max_repeat_percent * t.count)
    kept = ~failed & (t.count - boiler >= rules.min_left * t.count)
    return [t.count, word_chars, symbols, dup, repeat, boiler, boiler_lines, failed, kept], (start[gone], end[gone], doc[gone])


def _by_list(lines: np.ndarray, first: np.ndarray):
    """Finds lines in sorted (host, line) keys; ``first`` has each one's
    first text, 0 for none."""

    def of(batch: pa.RecordBatch, t: K.Texts):
        host = K.mix(batch.column("__host").slice(t.lo, t.n).to_numpy().view(np.uint64))
        key = batch.column("__key").slice(t.lo, t.n).to_numpy()

        def find(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if not len(lines):
                return np.zeros(len(keys), bool), np.zeros(len(keys), bool)
            both = K.mix(keys.view(np.uint64) ^ host[doc])
            at = np.minimum(np.searchsorted(lines, both), len(lines) - 1)
            gone = lines[at] == both
            return gone, gone & (first[at] == key[doc]) & (first[at] != 0)

        return find

    return of


def _by_row(batch: pa.RecordBatch, t: K.Texts):
    """Finds lines in the lists that came with each row."""
    listed = batch.column("__lines").slice(t.lo, t.n)

    def find(keys: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        gone, own = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        bounds = np.searchsorted(doc, np.arange(t.n + 1))
        for i in np.flatnonzero(listed.is_valid().to_numpy(zero_copy_only=False)).tolist():
            mine, pairs = slice(bounds[i], bounds[i + 1]), listed[i].values
            line, first = (pairs.field(c).to_numpy(zero_copy_only=False) for c in ("line", "own"))
            gone[mine] = np.isin(keys[mine], line)
            own[mine] = np.isin(keys[mine], line[first])
        return gone, own

    return find


def _judge_batches(finder, rules: QualityRules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = finder()
        for batch in batches:
            for t in K.chunks(batch.column("text")):
                cols, _ = _judge(t, of(batch, t), rules)
                cols = [pa.array(c) for c in cols]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(t.lo, t.n), *cols], ["doc_id", *(x.split()[0] for x in VERDICT.split(", "))])

    return run


def _strip(t: K.Texts, i: int, start: np.ndarray, end: np.ndarray) -> str:
    """Text ``i`` without the lines at these bytes (and their newlines)."""
    lo, hi = int(t.off[i]), int(t.off[i + 1])
    out, at = [], lo
    for s, e in zip(start.tolist(), end.tolist(), strict=True):
        out.append(t.data[at:s].tobytes())
        at = min(e + 1, hi)
    out.append(t.data[at:hi].tobytes())
    text = b"".join(out)
    return (text[:-1] if at == hi and len(start) and text.endswith(b"\n") and int(end[-1]) == hi else text).decode()


def _clean_batches(finder, rules: QualityRules, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = finder()
        for batch in batches:
            for t in K.chunks(batch.column("text")):
                cols, (start, end, doc) = _judge(t, of(batch, t), rules)
                rows = batch.select(columns).slice(t.lo, t.n)
                if len(doc):
                    text = rows.column("text").to_pylist()
                    for i in np.unique(doc[cols[-1][doc]]).tolist():
                        text[i] = _strip(t, i, start[doc == i], end[doc == i])
                    rows = rows.set_column(rows.schema.get_field_index("text"), rows.schema.field("text"), pa.array(text, rows.schema.field("text").type))
                yield rows.filter(pa.array(cols[-1]))

    return run


def _with_lines(docs: DataFrame, rules: QualityRules):
    """``docs`` with the columns that a task needs, and what makes its finder."""
    spark = docs.sparkSession
    over = staged(line_frequency(docs, rules), "lines")
    rows = docs.withColumns({"__host": _host(docs), "__key": _key(docs)})
    if small_enough(over, rules.broadcast_lines) and small_enough(over.select("host").distinct(), rules.broadcast_hosts):
        # at most broadcast_lines keys
        found = over.select("host", "line", F.coalesce("first", F.lit(0)).alias("first")).toPandas().astype("int64")
        lines = K.mix(found["line"].to_numpy().view(np.uint64) ^ K.mix(found["host"].to_numpy().view(np.uint64)))
        order = np.argsort(lines)
        sent = spark.sparkContext.broadcast((lines[order], found["first"].to_numpy()[order]))
        return rows, lambda: _by_list(*sent.value)
    _, lines = _host_lines(docs)
    own = staged(lines.distinct(), "own-lines").join(over, ["host", "line"])
    listed = own.groupBy("host", "key").agg(F.collect_list(F.struct("line", F.coalesce(F.col("first") == F.col("key"), F.lit(False)).alias("own"))).alias("__lines"))
    listed = staged(listed.select(F.col("host").alias("__h"), F.col("key").alias("__k"), "__lines"), "text-lines")
    rows = rows.join(listed, (F.col("__host") == F.col("__h")) & (F.col("__key") == F.col("__k")), "left").drop("__h", "__k")
    return rows, lambda: _by_row


def judge(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Base measures and verdict of each row: ``doc_id`` and VERDICT."""
    rows, finder = _with_lines(docs.select("doc_id", "text", "source"), rules)
    return rows.drop("source").mapInArrow(_judge_batches(finder, rules), f"doc_id {dict(docs.dtypes)['doc_id']}, {VERDICT}")


def clean(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Rows of kept documents with all their columns; lines above the limit
    are removed from the text, and ``n_chars`` (if present) follows."""
    plain = shielded(docs, "doc_id", "text", "source", "n_chars")
    rows, finder = _with_lines(plain, rules)
    out = rows.mapInArrow(_clean_batches(finder, rules, plain.columns), plain.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(dict(docs.dtypes)["n_chars"]))
    return out.toDF(*docs.columns)
