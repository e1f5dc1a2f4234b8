"""Archive round trip and URL filter."""

import base64
import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridcast.config import scratch_path
from gridcast.llm import queries, toxicity, urlfilter, warc

PAGES = "page_id long, url string, html string, host string, digest string"


def rows():
    big = "<p>" + "ü" * 300_000 + "</p>"
    return [
        (1, "http://www.a.org/x?y=1#z", "<b>é</b>", "h", "d"),
        (2, "https://a.org/x", "<b>é</b>", None, None),
        (3, None, None, None, None),
        (4, "", "", None, None),
        (5, "no scheme", big, None, None),
        (6, "http://A.Example.ORG/en/1 2\n3", big, None, None),
        (6, "http://A.Example.ORG/en/1 2\n3", big, None, None),
        (7, "http://a.org/x", "WARC/1.1\r\n\r\nx\r\n\r\n", None, None),
        (None, "http://a.org/x", "<b>é</b>", None, None),
        (None, None, "only", None, None),
        *[(10 + i, "http://hot.com/", f"<i>{i % 3}</i>", None, None) for i in range(60)],
    ]


def test_round_trip(spark):
    df = spark.createDataFrame(rows(), PAGES)
    least = {}
    for p, _, html, *_ in rows():
        if p is not None:
            least[html or ""] = min(least.get(html or "", p), p)
    want = []
    for p, _, html, *_ in rows():
        raw = (html or "").encode()
        first = least.get(html or "")
        again = first is not None and (p is None or p > first)
        want.append((p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", first if again else None))
    assert Counter(map(tuple, warc.round_trip(df).collect())) == Counter(want)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_lookup_reads_blocks_by_key(spark):
    df = spark.createDataFrame(rows(), PAGES)
    root = scratch_path(spark, "warc-test")
    captures = warc.write_archive(df, f"{root}/data", min_revisit_bytes=8, file_bytes=500)
    assert captures.select("file").distinct().count() > 3
    shards = warc.build_index(captures, f"{root}/index", block=3)
    urls = spark.createDataFrame([("http://hot.com/#top",), ("http://nowhere.net/",), ("https://a.org/x",), (None,)], "url string")
    found = warc.lookup(urls, shards, f"{root}/index")
    assert Counter(r.key for r in found.collect()) == {"com,hot)/": 60, "org,a)/x": 3, "-": 2}
    read = warc.read_records(found, f"{root}/data").collect()
    assert {r.record_type for r in read if r.payload_bytes < 8} == {"response"}
    assert sum(r.target_uri == "http://hot.com/" for r in read) == 60


def test_url_filter(spark):
    urls = [
        ("http://x.org/", "org/", "allow"),
        ("http://x.org", None, "allow"),
        ("https://a.example.org/es/1?q#f", "example.org/es/", "block"),
        ("https://notexample.org/es/1", "org/", "allow"),
        ("http://EXAMPLE.org/en/12", "example.org/en/1", "block"),
        ("ftp://b.com/de/", "com/de/", "block"),
        ("ftp://b.com/fr/?x", "com/fr/", "allow"),
        ("ftp://com/fr/x", "com/fr/", "allow"),
        ("http://www.site.net:80/p/?b=2&a=1&utm_source=x#f", None, "block"),
        ("https://SITE.net/p?a=1&b=2", None, "block"),
        ("https://site.net/p?a=1&b=3", None, "allow"),
        ("mailto:x", None, "allow"),
        ("", None, "allow"),
        (None, None, "allow"),
        ("http:///path", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, u, "extra") for i, (u, _, _) in enumerate(urls)], "page_id long, url string, rule string")
    listed = spark.createDataFrame([("https://site.net/p?a=1&b=2",), ("bad",), (None,)], "url string").select(urlfilter.canonical(F.col("url")).alias("canon"))
    out = {r.page_id: r for r in urlfilter.judge(pages, listed).collect()}
    for i, (u, rule, verdict) in enumerate(urls):
        assert (out[i].rule, out[i].verdict) == (rule, verdict), u
    assert (out[2].host, out[2].path) == ("a.example.org", "/es/1")
    assert (out[11].host, out[11].path) == (out[13].host, out[13].path) == ("", "")
    assert urlfilter.judge(pages.limit(0), listed).count() == 0
    assert {r.listed for r in urlfilter.judge(pages, listed.limit(0)).collect()} == {False}


def test_full_filter_still_exact(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "MAX_BLOCKS", 1)
    pages = spark.range(3000).selectExpr("id as page_id", "concat('http://h.net/', id) as url")
    listed = pages.where("page_id % 2 = 0").select(urlfilter.canonical(pages["url"]).alias("canon"))
    out = urlfilter.judge(pages, listed)
    assert out.where("listed <> (page_id % 2 = 0)").count() == 0 and out.count() == 3000


def test_toxicity(spark):
    sf = "/root/testdata/sf0.1"
    out = queries.op8_pattern_grammar(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    seen = out.join(labels, "doc_id").where("held_out").selectExpr("avg(int(predicted = toxic)) as accuracy", "sum(int(predicted = 1 and toxic = 1)) / sum(toxic) as recall").first()
    assert seen.accuracy > 0.97 and seen.recall > 0.85
    assert out.where("score < 0 or score > 1 or score is null").count() == 0


def test_toxicity_edges(spark, odd, none):
    lexicon = toxicity.Lexicon({"idiot": 4.0}, {"lowei": 3.0})
    f = lambda text: dict(zip(toxicity.FEATURES, toxicity.clause(text.split(), lexicon), strict=True))
    assert f("what an idiot")["plain"] == 4
    assert f("you are an idiot")["aimed"] == 4
    assert f("he is not an idiot")["negated"] == 4
    assert f("she said idiot")["reported"] == 4
    assert f("kill you loweient") == {"plain": 0, "aimed": 3, "negated": 0, "reported": 0, "threat": 1, "best": 3, "clauses": 1}
    assert not any(f("kill the lights").values())
    labels = spark.createDataFrame([(i, None, i % 2) for i in range(1, 23)] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    out = toxicity.score(odd, labels)
    assert out.count() == odd.count() and out.where("score is null or held_out is null").count() == 0
    assert toxicity.score(odd, labels.limit(0)).select("score").distinct().count() == 1
    assert toxicity.score(none, labels).count() == 0


def test_toxicity_clauses():
    lexicon = toxicity.Lexicon({"idiot": 4.0}, {}, {"shoot": 2.0, "burn": 2.5})
    f = lambda text: dict(zip(toxicity.FEATURES, toxicity.clause(text.split(), lexicon), strict=True))
    assert f("you do not have to be an idiot")["negated"] == 4
    two = f("they said he is an idiot but you are an idiot")
    assert two["reported"] == 4 and two["aimed"] == 4
    assert f("i will shoot you")["threat"] == 2 and not any(f("i will shoot the scene").values())
    assert f("he threatened to burn your house")["threat"] == 2.5
    assert f("she wrote that he will burn your house")["reported"] == 2.5
    assert f("no one will shoot you")["negated"] == 2


def _tags_by_definition(tags):
    """The final tag of every token, from what stands around it."""
    out = []
    for i, t in enumerate(tags):
        since = max((k + 1 for k in range(i) if tags[k] == "turn"), default=0)
        if t in ("insult", "threat"):
            near = any(tags[k] == "target" for k in range(max(i - 4, 0), min(i + 5, len(tags))))
            if "negation" in tags[since:i]:
                t = "negated"
            elif "report" in tags[since:i]:
                t = "reported"
            elif near:
                t = {"insult": "aimed", "threat": "menace"}[t]
        out.append(t)
    return out


def test_toxicity_grammar_equals_its_definition():
    """Every sequence of up to five tags, and random long ones; the composed
    machine does what its parts do one after the other."""
    rng = random.Random(8)
    some = [[*t] for n in range(6) for t in itertools.product(toxicity.TAGS, repeat=n)]
    some += [rng.choices(toxicity.TAGS, k=rng.randrange(6, 60)) for _ in range(3000)]
    for tags in some:
        weighted = [(t, float(i + 1)) for i, t in enumerate(tags)]
        got = toxicity.rewrite(weighted)
        assert [t for t, _ in got] == _tags_by_definition(tags)
        assert [w for _, w in got] == [w for _, w in weighted]
        apart = toxicity.AIM.run(toxicity.REPORT.run(toxicity.NEGATE.run(weighted)))
        assert toxicity.FROM_LEFT.run(weighted) == apart
    doubled = toxicity._machine(1, lambda s, t: (0, t, 2.0))
    assert doubled.then(doubled).run([("insult", 1.5)]) == [("insult", 6.0)]
    assert toxicity.FROM_LEFT.states <= toxicity.NEGATE.states * toxicity.REPORT.states * toxicity.AIM.states


def test_toxicity_learns_threats(spark):
    rows = [(f"so i will {'smash' if bad else 'greet'} you tomorrow {i}", bad) for i in range(60) for bad in (True, False)]
    rows += [(f"they smash the nuts {i}", False) for i in range(60)]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, toxic boolean"))
    assert "smash" in lexicon.threats and "greet" not in lexicon.threats
    grammar = toxicity.Grammar(toxicity.Lexicon(threats=lexicon.threats))
    assert grammar.features(pa.array(["I will SMASH you", "smash the nuts"]))[:, 4].tolist() == [pytest.approx(np.log1p(lexicon.threats["smash"])), 0]


def test_toxicity_beside_non_ascii_punctuation():
    """Each mark in front of and behind a lexicon word: scored as if apart."""
    grammar = toxicity.Grammar(toxicity.Lexicon({"idiot": 4.0, "tonto": 4.0}, {"lowei": 3.0}))
    marks = "¿¡“”„‘’«»‹›…–—\u00a0\u2009\u202f\u3000、。（）\u0301€🙂"
    words = ["idiot", "tonto", "loweient", "kill you"]
    texts = [f"you {a}{w}{b} x" for w in words for m in marks for a, b in ((m, ""), ("", m), (m, m))]
    plain = [f"you {a} {w} {b} x" for w in words for m in marks for a, b in ((m, ""), ("", m), (m, m))]
    got = grammar.features(pa.array(texts))
    assert (got == grammar.features(pa.array(plain))).all() and (got[:, 5] > 0).all()
    assert not grammar.features(pa.array(["you éidiot", "you idiotß", "you 日idiot", "you _idiot", "you ٣idiot"])).any()
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    inside = toxicity._in_token(np.frombuffer(every.encode(), np.uint8)).tobytes()
    want = b"".join(bytes([bool(toxicity.TOKEN.match(c))]) * len(c.encode()) for c in every)
    assert inside == want
