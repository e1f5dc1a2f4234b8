"""License notices in whole texts: exact phrases and fuzzy short notices.

A text is reduced to its words (A-Z lowered; runs of a-z, 0-9 and non-ASCII
characters) joined by one space.  Base: the places where the words of a
phrase stand one after another.  Fuzzy: a notice of ``n`` bytes matches a
span of whole words within ``k = n // 8`` edits (bytes inserted, deleted or
replaced; notices of less than eight bytes match exactly).

Search: a notice is split into ``k + 1`` seeds of near equal length.  ``k``
edits cannot touch all of them, so a matching span holds a seed unchanged, at
most ``k`` bytes from its place in the notice.  The seeds are found by byte
search over the chunk of texts at once; each hit leaves a few spans that
start and end at word edges and whose length is within ``k`` of the notice's.
The ``regex`` library's bounded-error matching decides them and counts the
edits.  Of the spans of one notice that start at one word the one with the
fewest edits stands (the shorter on ties).

One pass over the texts without a shuffle; memory is bounded by a chunk.  A
text longer than a chunk is a chunk of its own.

Cases: a null or empty text has no words: no places, labels empty, score 0;
null and repeated ids are rows like others; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

# Phrases of the base search and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Notices of the fuzzy search and their labels.
NOTICES = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "apache license": "apache",
    "mit license": "mit",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "creative commons attribution": "cc-by",
    "redistribution and use in source": "bsd",
    "permission is hereby granted": "mit",
    "all rights reserved": "reserved",
    "released into the public domain": "public-domain",
}

#: One edit is allowed for so many bytes of a notice.
BYTES_AN_EDIT = 8
#: Texts are searched in chunks of so many bytes.
CHUNK = 1 << 20

_WORD = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
#: Lowers A-Z and turns every byte outside of words into a space.
PLAIN = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD else 0x20 for b in range(256))

COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,first_word:long,last_word:long,edits:int>>"


def plain(text: bytes) -> bytes:
    """The text's words joined by one space."""
    return b" ".join(text.translate(PLAIN).split())


@dataclass(frozen=True)
class Notice:
    """A notice with its seeds, as (offset, bytes), and its matcher."""

    text: bytes
    label: str
    edits: int
    seeds: tuple[tuple[int, bytes], ...]
    match: regex.Pattern

    @classmethod
    def of(cls, phrase: str, label: str, bytes_an_edit: int = BYTES_AN_EDIT) -> Notice:
        text = plain(phrase.encode())
        k = len(text) // bytes_an_edit
        edge = [i * len(text) // (k + 1) for i in range(k + 2)]
        seeds = tuple((a, text[a:b]) for a, b in zip(edge, edge[1:], strict=False))
        return cls(text, label, k, seeds, regex.compile(b"(?b)(?:%s){e<=%d}" % (regex.escape(text), k)))


def places(data: bytes, needle: bytes) -> Iterator[int]:
    """All places of ``needle``, overlapping ones too."""
    at = data.find(needle)
    while at >= 0:
        yield at
        at = data.find(needle, at + 1)


def spans(data: bytes, notice: Notice) -> dict[int, tuple[int, int]]:
    """Matching spans in ``data``, whose words are parted by one space and
    whose texts by a newline: start byte -> (edits, end byte)."""
    tried, found = set(), {}
    n, k = len(notice.text), notice.edits
    for offset, seed in notice.seeds:
        for at in places(data, seed):
            middle = at - offset
            for start in range(max(middle - k, 0), min(middle + k, at) + 1):
                if start and data[start - 1] not in b" \n":
                    continue
                for end in range(max(start + n - k, at + len(seed)), min(start + n + k, len(data)) + 1):
                    if (start, end) in tried or (end < len(data) and data[end] not in b" \n"):
                        continue
                    tried.add((start, end))
                    part = data[start:end]
                    if b"\n" in part or part[:1] == b" " or part[-1:] == b" ":
                        continue
                    if m := notice.match.fullmatch(part):
                        found[start] = min(found.get(start, (n, end)), (sum(m.fuzzy_counts), end))
    return found


def _scan(phrases: dict[str, str], notices: dict[str, str], bytes_an_edit: int, chunk: int):
    def of_chunk(texts: list[bytes], base: list, fuzzy: list) -> Iterator[tuple]:
        data = b"\n".join(texts)
        starts = [0]
        for t in texts:
            starts.append(starts[-1] + len(t) + 1)
        # per text: places of phrases, and spans of notices
        hits, near = {}, {}
        for phrase, label in base:
            for at in places(data, phrase):
                end = at + len(phrase)
                if (at == 0 or data[at - 1] in b" \n") and (end == len(data) or data[end] in b" \n"):
                    hits.setdefault(bisect_right(starts, at) - 1, []).append((at, label))
        for notice in fuzzy:
            for at, (edits, end) in spans(data, notice).items():
                near.setdefault(bisect_right(starts, at) - 1, []).append((at, end, notice, edits))
        for i, text in enumerate(texts):
            n_words = text.count(b" ") + 1 if text else 0
            word = lambda at, i=i: data.count(b" ", starts[i], at)
            own, more = hits.get(i, []), sorted(near.get(i, []), key=lambda x: (x[0], x[2].label, x[1]))
            at = [p for p, _ in own]
            labels = {label for _, label in own}
            every = labels | {notice.label for _, _, notice, _ in more}
            score = 1.0 if own else max((1.0 - edits / len(notice.text) for _, _, notice, edits in more), default=0.0)
            listed = [{"label": notice.label, "first_word": word(a), "last_word": word(b), "edits": edits} for a, b, notice, edits in more]
            yield (
                n_words, len(own), word(min(at)) if own else None, word(max(at)) if own else None,
                ",".join(sorted(labels)), ",".join(sorted(every)), score, listed,
            )

    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    kinds.append(pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32())])))
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = [(plain(p.encode()), label) for p, label in phrases.items()]
        fuzzy = [Notice.of(p, label, bytes_an_edit) for p, label in notices.items()]

        def emit(batch, lo, texts):
            columns = list(zip(*of_chunk(texts, base, fuzzy), strict=True))
            ids = batch.column("doc_id").slice(lo, len(texts))
            return pa.RecordBatch.from_arrays([ids, *[pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]], ["doc_id", *names])

        for batch in batches:
            column, texts, size, lo = batch.column("text").cast(pa.binary()), [], 0, 0
            for i in range(len(column)):
                value = column[i]
                texts.append(plain(value.as_py()) if value.is_valid else b"")
                size += len(texts[-1])
                if size >= chunk:
                    yield emit(batch, lo, texts)
                    texts, size, lo = [], 0, i + 1
            if texts:
                yield emit(batch, lo, texts)

    return run


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES, bytes_an_edit: int = BYTES_AN_EDIT, chunk: int = CHUNK) -> DataFrame:
    """``doc_id`` and COLUMNS of every row: places of the phrases, the labels
    of phrases and notices, the best match's share of unedited bytes as
    score, and the notices' spans."""
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(_scan(phrases, notices, bytes_an_edit, chunk), f"doc_id {kind}, {COLUMNS}")
