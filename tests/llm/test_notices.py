"""License notices against all spans of words."""

import random

import pytest

from gridcast.llm import notices
from gridcast.llm.common import load

SF = "/root/testdata/sf0.001"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def words(text):
    out, now = [], b""
    for byte in (text or "").encode():
        c = byte + 32 if 65 <= byte <= 90 else byte
        if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128:
            now += bytes([c])
        elif now:
            out.append(now)
            now = b""
    return out + [now] * bool(now)


def brute(text):
    w = words(text)
    places = [(i, label) for i in range(len(w)) for p, label in notices.PHRASES.items() if b" ".join(w[i : i + len(p.split())]) == p.encode()]
    found = {}
    for notice, label in notices.NOTICES.items():
        n, k = len(notice), len(notice) // 8
        for i in range(len(w)):
            for j in range(i + 1, min(len(w), i + len(notice.split()) + k) + 1):
                part = b" ".join(w[i:j])
                if abs(len(part) - n) <= k and (e := distance(part, notice.encode())) <= k:
                    found[i, notice, label] = min(found.get((i, notice, label), (e, j)), (e, j))
    spans = sorted((i, label, j - 1, e) for (i, _, label), (e, j) in found.items())
    score = 1.0 if places else max((1.0 - e / len(notice) for (_, notice, _), (e, _) in found.items()), default=0.0)
    at = [i for i, _ in places]
    return (
        len(w), len(places), min(at, default=None), max(at, default=None),
        ",".join(sorted({x for _, x in places})), ",".join(sorted({x for _, x in places} | {x[2] for x in found})), score, spans,
    )


def shape(row):
    return (*row[1:8], [(s.first_word, s.label, s.last_word, s.edits) for s in row.spans])


def damaged(seed, n):
    """Notices with random edits between random words."""
    r, out = random.Random(seed), []
    for _ in range(n):
        text = list(r.choice(list(notices.NOTICES)))
        for _ in range(r.randint(0, 5)):
            at = r.randrange(len(text))
            kind, c = r.randrange(3), r.choice("abcdes é-")
            text[at : at + (kind != 0)] = [] if kind == 1 else [c]
        out.append(" ".join(["The", "mit", "".join(text), r.choice(["license", "by", "x", "2.0"]), "mit license", "Licensed"][r.randrange(3) :]))
    return out


def test_matches_are_all_spans_within_the_edits(spark, odd):
    texts = damaged(4, 150) + [None, "", " .,;", "MIT LICENSE mit license MIT-License", "gnu\ngeneral-public  LICENCE.", "x" * 30_000, "apache license " * 3000, "cc by cc by", "commit license", "Ömit license"]
    rows = [(i % 7 or None, t, "en", "s", 1, "k", "h", 2) for i, t in enumerate(texts)]
    got = sorted((repr((r.doc_id, shape(r))) for r in notices.scan(spark.createDataFrame(rows, odd.schema), chunk=3000).collect()))
    seen = {t: brute(t) for t in set(texts) if t is None or len(t) < 10_000}
    seen["x" * 30_000] = (1, 0, None, None, "", "", 0.0, [])
    many = [(i, "apache", i + 1, 0) for i in range(0, 6000, 2)]
    seen["apache license " * 3000] = (6000, 3000, 0, 5998, "apache", "apache", 1.0, many)
    want = sorted(repr((r[0], seen[r[1]])) for r in rows)
    assert got == want
    assert any("lgpl" in x[5] for x in seen.values()) and any(x[1] == 0 and x[5] for x in seen.values())


def test_given_table_and_odd_rows(spark, odd, odd_rows, none):
    docs = load(spark, SF, "documents")
    got = {r.doc_id: shape(r) for r in notices.scan(docs).collect()}
    for r in docs.where("n_chars < 4000").collect():
        assert got[r.doc_id] == brute(r.text)
    assert sorted(repr((r.doc_id, r.n_words)) for r in notices.scan(odd).collect()) == sorted(repr((r[0], len(words(r[1])))) for r in odd_rows)
    assert notices.scan(none).count() == 0


@pytest.mark.parametrize("text,edits", [("released into the public domain", 3), ("mit license", 1), ("cc by", 0)])
def test_seeds_cover_the_notice(text, edits):
    notice = notices.Notice.of(text, "x")
    assert notice.edits == edits and len(notice.seeds) == edits + 1
    assert b"".join(s for _, s in notice.seeds) == text.encode() and all(text.encode()[at : at + len(s)] == s for at, s in notice.seeds)
