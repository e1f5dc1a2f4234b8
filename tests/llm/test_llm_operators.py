"""Each operator against its plain definition: odd rows and a given table."""

import dataclasses
import math
import random
from collections import Counter

import brute
import corpus_pipeline
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from gridcast.llm import common, decontam, linedup, minhash, mixing, quality, shard, substring

SF = "/root/testdata/sf0.001"


def given(table):
    return pq.read_table(f"{SF}/{table}.parquet").to_pydict()


def rows_of(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_quality(spark, odd, odd_rows, none):
    got = Counter(map(tuple, quality.judge(odd).collect()))
    assert got == Counter(brute.quality([(r[0], r[1], r[3]) for r in odd_rows])[0])
    assert quality.judge(none).count() == 0
    w = lambda seed, n: " ".join(f"w{seed}x{k}" for k in range(n))
    rows = [(i, "\n".join(w(f"f{k}", 12) if k != i % 5 else w(f"v{i}", 3) for k in range(6)), "en", "big") for i in range(14)]
    rows += [(100 + i, w(f"o{i}", 60) + ("\nSome   Shared line" if i < 11 else ""), "en", "big") for i in range(150)]
    df = spark.createDataFrame([(*r, 0, None, None, None) for r in rows], odd.schema)
    got = Counter(map(tuple, quality.judge(df, quality.PRODUCTION).collect()))
    want, over = brute.quality([(r[0], r[1], r[3]) for r in rows], max_docs=10)
    assert got == Counter(want) and any(over.values())
    # depleted documents are rejected, and not all of their family
    assert 0 < sum(not r[-2] and not r[-1] for r in want) < 14
    d = given("documents")
    rules = quality.QualityRules(min_docs=2, max_share=0.02, min_left=0.9)
    got = Counter(map(tuple, quality.judge(common.load(spark, SF, "documents"), rules).collect()))
    want, over = brute.quality(list(zip(d["doc_id"], d["text"], d["source"], strict=True)), 2, 0.02, 0.9)
    assert over and got == Counter(want)


def test_quality_many_hosts_joins(spark):
    docs = common.load(spark, SF, "documents")
    rules = quality.QualityRules(min_docs=2, max_share=0.02)
    few = quality.QualityRules(min_docs=2, max_share=0.02, broadcast_hosts=0)
    assert Counter(map(tuple, quality.judge(docs, rules).collect())) == Counter(map(tuple, quality.judge(docs, few).collect()))


def test_quality_clean(spark, odd, none):
    words = [f"w{i}" for i in range(60)]
    boiler = "All RIGHTS   reserved here"
    rows = [(i, "\n".join([boiler, " ".join(words[: 50 + i % 7]) + f" {i}", boiler.lower()]), "en", "s", 1, None, None, None) for i in range(20)]
    rows += [(100 + i, "\n".join([boiler] * 30), "en", "s", 1, None, None, None) for i in range(2)]
    df = spark.createDataFrame(rows, odd.schema)
    out = {r.doc_id: r for r in quality.clean(df).collect()}
    assert set(out) == set(range(20))
    for i in range(20):
        assert out[i].text == " ".join(words[: 50 + i % 7]) + f" {i}"
        assert out[i].n_chars == len(out[i].text)
    assert quality.clean(odd).columns == odd.columns
    assert quality.clean(none).count() == 0


def test_quality_limit_does_not_grow_with_the_host(spark, odd):
    """A line in ten texts goes from a host of 500 as from one of 99; near
    copies, all of whose lines are common, still leave one text."""
    line = "this page is part of our archive"
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    rows = [(f"{h}{i}", own(f"{h}{i}") + ("\n" + line if i < 10 else ""), h) for h, n in (("a", 500), ("b", 99)) for i in range(n)]
    rows += [(f"c{i}", "\n".join(own(f"c{k}") if k != i % 5 else own(f"c{k}") + f" v{i}" for k in range(5)), "a") for i in range(60)]
    docs = spark.createDataFrame([(i, t, "en", h, len(t), None, None, None) for i, (_, t, h) in enumerate(rows)], odd.schema)
    out = {rows[r.doc_id][0]: r.text for r in corpus_pipeline.quality_rules(spark, docs, "").collect()}
    assert all(out[f"{h}{i}"] == own(f"{h}{i}") for h, n in (("a", 500), ("b", 99)) for i in range(n))
    family = [k for k in out if k[0] == "c"]
    assert 1 <= len(family) < 60 and any(len(out[k].split("\n")) == 5 for k in family)
    want = Counter(map(tuple, quality.clean(docs, corpus_pipeline.LINE_RULES).collect()))
    joined = dataclasses.replace(corpus_pipeline.LINE_RULES, broadcast_lines=0)
    assert Counter(map(tuple, quality.clean(docs, joined).collect())) == want


def check_shards(got, texts, shards):
    by = {}
    for doc_id, size, crc, law, sh, slot, grown in got:
        assert (size, crc, law, grown) == (brute.size(texts[doc_id]), brute.crc(texts[doc_id]), "bytes", None)
        by.setdefault(sh, []).append((slot, size))
    assert all(sorted(s for s, _ in v) == list(range(len(v))) for v in by.values())
    assert all(0 <= k < shards for k in by)
    of = {}
    for doc_id, _, _, _, sh, _, _ in got:
        assert of.setdefault(texts[doc_id] or "", sh) == sh
    return {k: sum(s for _, s in v) for k, v in by.items()}


def test_shards(spark, odd, odd_rows, none):
    texts = {r[0]: r[1] for r in odd_rows if r[0] is not None}
    got = [r for r in map(tuple, shard.assign(odd).collect()) if r[0] is not None]
    assert shard.assign(odd).count() == len(odd_rows)
    assert shard.assign(none).count() == 0
    plain = spark.createDataFrame([r for r in odd_rows if r[0] is not None][:22], odd.schema)
    check_shards([tuple(r) for r in shard.assign(plain).collect()], texts, 40)
    assert len(got) == len(odd_rows) - 2
    d = given("documents")
    texts = dict(zip(d["doc_id"], d["text"], strict=True))
    for shards in (3, 40):
        sizes = check_shards([tuple(r) for r in shard.assign(common.load(spark, SF, "documents"), shards).collect()], texts, shards)
        assert len(sizes) == shards


@pytest.mark.parametrize("seed", range(3))
def test_marks_are_the_groups_at_the_cuts(spark, seed):
    """Cuts inside runs of equally large groups, at their borders and past the end."""
    r = random.Random(seed)
    groups = sorted(((r.choice((20, 50, 90)), f"{r.getrandbits(60):016x}") for _ in range(700)), key=lambda g: (-g[0], g[1]))
    runs = sorted(Counter(b for b, _ in groups).items(), reverse=True)
    first = sorted([0, runs[0][1], runs[0][1] - 1, *r.sample(range(700), 9), 700, 700])
    heads = spark.createDataFrame(r.sample(groups, 700), "bytes long, key string").repartition(5)
    got = shard._marks(heads, np.array([b for b, _ in runs]), np.array([n for _, n in runs]), first)
    assert got == [groups[g] if g < 700 else (None, None) for g in first]


def optimum(sizes, shards):
    """Smallest largest part over all contiguous partitions (dynamic programming)."""
    total = np.concatenate(([0], np.cumsum(sizes)))
    best = [float(x) for x in total]
    for _ in range(shards - 1):
        best = [0.0] + [min(max(best[j], total[i] - total[j]) for j in range(i + 1)) for i in range(1, len(total))]
    return best[-1]


@pytest.mark.parametrize("seed", range(12))
def test_cuts_are_minimax(seed):
    r = random.Random(seed)
    sizes = sorted((r.choice([r.randint(16, 30), r.randint(16, 400), 500]) for _ in range(r.randint(1, 60))), reverse=True)
    shards = r.randint(1, 9)
    runs = sorted(Counter(sizes).items(), reverse=True)
    first = shard.cuts(np.array([s for s, _ in runs]), np.array([n for _, n in runs]), shards)
    assert first == sorted(first) and first[0] == 0 and len(first) == shards
    parts = [sum(sizes[a:b]) for a, b in zip(first, [*first[1:], len(sizes)], strict=True)]
    assert max(parts) == optimum(sizes, shards)


def test_near_classes(spark, odd, odd_rows, none):
    d = given("documents")
    got = dict(rows_of(minhash.near_classes(common.load(spark, SF, "documents")), "doc_id", "class_id"))
    assert got == brute.near_classes(list(zip(d["doc_id"], d["text"], strict=True)))
    distinct = {r[0]: r[1] for r in odd_rows if r[0] is not None}
    got = rows_of(minhash.near_classes(odd), "doc_id", "class_id")
    assert len(got) == len(odd_rows)
    assert {k: v for k, v in got if k is not None} == brute.near_classes(list(distinct.items()))
    # a null id is judged by its text: a copy of 11, and one without a word
    assert {v for k, v in got if k is None} == {dict(got)[11], None}
    assert minhash.near_classes(none).count() == 0


def test_near_copies_of_an_original_that_is_not_the_smallest(spark, none):
    """Copies 0..59 differ from each other by more than the limit, but each
    is near the original 60: one class, and a chain joins it."""
    r = random.Random(5)
    words = [f"w{r.randint(0, 10**6)}" for _ in range(400)]
    rows = []
    for i in range(60):
        w = list(words)
        for p in r.sample(range(5, 395), 8):
            w[p] = f"x{i}y{p}"
        rows.append((i, " ".join(w)))
    rows.append((60, " ".join(words)))
    rows += [(61, "\n".join(words)), (62, " ".join(words[:200] + [f"z{i}" for i in range(200)]))]
    df = spark.createDataFrame([(i, t, None, None, None, None, None, None) for i, t in rows], none.schema)
    got = dict(rows_of(minhash.near_classes(df), "doc_id", "class_id"))
    assert got == brute.near_classes(rows)
    assert got[60] == got[61] == 0 and got[62] == 62


@pytest.mark.parametrize("block,elements", [(3, 1 << 30), (2048, 150), (2048, 1)])
def test_blocks_of_a_bucket_lose_no_link(spark, monkeypatch, block, elements):
    """A chain of texts, each a few words from the next, and one very long
    text: buckets hold several components and are cut into blocks."""
    rng = random.Random(5)
    text, rows = [f"w{k}" for k in range(60)], []
    for i in range(40):
        rows.append((i, " ".join(text)))
        for _ in range(rng.choice((1, 1, 3))):
            text[rng.randrange(60)] = f"x{i}"
    rows.append((99, " ".join(rows[0][1].split() * 200)))
    want = brute.near_classes(rows)
    assert len(set(want.values())) > 3
    monkeypatch.setattr(minhash._link, "__defaults__", (block, elements))
    used = []
    across = minhash._across
    monkeypatch.setattr(minhash, "_across", lambda *a: used.append(a[-2:]) or across(*a))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert dict(rows_of(minhash.near_classes(df), "doc_id", "class_id")) == want
    assert used == [(block, elements)]


def test_screen_loses_no_pair_at_the_threshold():
    """Bags at 0.85 whose registers agree in 65 % by chance are still linked,
    and the chance to miss one at the threshold is far below the bands'."""
    n, least = minhash.REGISTERS, minhash.THRESHOLD - minhash.SCREEN
    missed = sum(math.comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(math.ceil(least * n)))
    assert missed < 1e-3 * (1 - 0.8**minhash.ROWS) ** minhash.BANDS
    left = np.arange(n, dtype=np.uint16)
    right = np.where(np.arange(n) < 0.65 * n, left, left + 1000).astype(np.uint16)
    bands = [[0, *range(1, 36)], [0, *range(101, 136)]]
    elements = [np.arange(200), np.concatenate((np.arange(185), np.arange(900, 915)))]
    rows = {"part": [1, 1], "id": [1, 2], "label": [1, 2], "half": [0, 0], "band": [0, 0], "sig": [left.tobytes(), right.tobytes()], "bands": bands, "elements": elements}
    links = minhash._compare(minhash.THRESHOLD, least)(iter([pa.RecordBatch.from_pydict(rows)]))
    assert [(x["a"], x["b"]) for batch in links for x in batch.to_pylist()] == [(1, 2)]


def test_keep_one(spark, odd, odd_rows, none):
    out = minhash.keep_one(odd)
    assert out.columns == odd.columns
    kept = Counter(r.doc_id for r in out.collect())
    classes = brute.near_classes(list({r[0]: r[1] for r in odd_rows if r[0] is not None}.items()))
    assert {k for k in kept if k is not None} == set(classes.values())
    # of the null ids one is a copy and goes, the other has no word and stays
    assert all(n == 1 for n in kept.values()) and None in kept
    assert minhash.keep_one(none).count() == 0


def test_signatures_are_unbiased():
    r = np.random.default_rng(3)
    n, registers = 40, 512
    values = r.integers(0, 2**63, n).astype(np.uint64)
    left, right = r.integers(0, 9, n), r.integers(0, 9, n)
    both = np.concatenate((values[left > 0], values[right > 0]))
    doc = np.concatenate((np.zeros((left > 0).sum(), np.int64), np.ones((right > 0).sum(), np.int64)))
    weight = np.concatenate((left[left > 0], right[right > 0]))
    hits = []
    for seed in range(12):
        s = minhash.signatures(both + np.uint64(seed * 1001), doc, weight, 2, registers)
        hits.append((s[0] == s[1]).mean())
    true = np.minimum(left, right).sum() / np.maximum(left, right).sum()
    assert abs(np.mean(hits) - true) < 4 * np.sqrt(true * (1 - true) / (12 * registers))


def test_repeats(spark, odd, odd_rows, none):
    got = Counter(map(tuple, substring.remove_repeats(odd).collect()))
    assert got == Counter(brute.without_repeats([(r[0], r[1]) for r in odd_rows]))
    assert substring.remove_repeats(none).count() == 0
    d = given("documents")
    got = Counter(map(tuple, substring.remove_repeats(common.load(spark, SF, "documents")).collect()))
    assert got == Counter(brute.without_repeats(list(zip(d["doc_id"], d["text"], strict=True))))


@pytest.mark.parametrize("seed", range(3))
def test_repeats_in_tangled_passages(spark, none, seed):
    r = random.Random(seed)
    pool = [[r.choice("abcd") + str(r.randint(0, 3)) for _ in range(r.randint(5, 40))] for _ in range(8)]
    rows = [(i, " ".join(w for _ in range(r.randint(1, 8)) for w in r.choice(pool))) for i in range(40)]
    df = spark.createDataFrame([(i, t, None, None, None, None, None, None) for i, t in rows], none.schema)
    got = Counter(map(tuple, substring.remove_repeats(df, window=12, kmer=4).collect()))
    assert got == Counter(brute.without_repeats(rows, 12))


def test_containment(spark, odd, odd_rows, none):
    items = [(1, odd_rows[10][1]), (2, " ".join((odd_rows[10][1] or "").split(" ")[:20])), (3, "a b"), (4, None), (5, ""), (6, "The quick brown Fox jumps over"), (None, " ".join(odd_rows[5][1].split(" ")[3:40])), (7, odd_rows[10][1])]
    bench = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id int")
    got = Counter(map(tuple, decontam.contaminated(odd, bench).collect()))
    docs = list({(r[0], r[1]) for r in odd_rows})
    assert got == Counter(brute.contained(docs, items))
    assert decontam.contaminated(none, bench).count() == 0
    assert decontam.contaminated(odd, bench.limit(0)).count() == 0
    left = decontam.decontaminate(odd, bench)
    assert left.columns == odd.columns
    # a text decides for itself: of the two null ids only the one with the passage goes
    hit = {t for _, t in docs if brute.contained([(0, t)], items)}
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted((r[0] for r in odd_rows if r[1] not in hit), key=str)
    d, b = given("documents"), given("benchmark")
    got = set(map(tuple, decontam.contaminated(common.load(spark, SF, "documents"), common.load(spark, SF, "benchmark")).collect()))
    assert got == brute.contained(list(zip(d["doc_id"], d["text"], strict=True)), list(zip(b["item_id"], b["text"], strict=True)))


def near_lines(rows, min_words=8):
    """First line, links and fate of each line, by comparing all pairs."""
    lines = [(i, n, " ".join(brute.words(x))) for i, t in rows for n, x in enumerate((t or "").split("\n")) if t is not None and brute.words(x)]
    key = lambda i, n: (i is not None, i or 0, n)
    first = {}
    for i, n, x in lines:
        first[x] = min(first.get(x, key(i, n)), key(i, n))

    def near(a, b):
        a, b = sorted((a, b), key=len)
        if len(b) - len(a) > 1 or len(a) < min_words:
            return False
        p = 0
        while p < len(a) and a[p] == b[p]:
            p += 1
        return a[p + (len(a) == len(b)) :] == b[p + 1 :]

    words = {x: x.split(" ") for x in first}
    info = {x: [first[x], 0] for x in first}
    for x in first:
        for y in first:
            if x != y and near(words[x], words[y]):
                info[x][0] = min(info[x][0], first[y])
                info[x][1] += 1
    back = lambda k: (k[1] if k[0] else None, k[2])
    return Counter((i, n, *back(info[x][0]), info[x][1], key(i, n) == info[x][0]) for i, n, x in lines)


@pytest.mark.parametrize("seed", range(2))
def test_lines(spark, odd, odd_rows, none, seed):
    r = random.Random(seed)
    base = [[r.choice("abc") for _ in range(r.randint(1, 12))] for _ in range(12)]
    rows = [(x[0], x[1]) for x in odd_rows if x[0] not in (14, 15, 5)] if seed else []
    for i in range(30, 60):
        text = []
        for _ in range(r.randint(0, 6)):
            w = list(r.choice(base))
            for _ in range(r.choice([0, 1, 1, 2])):
                p = r.randrange(len(w) + 1)
                w[p : p + r.randint(0, 1)] = [r.choice("abcd")] * r.randint(0, 1)
            text.append(r.choice([" ", "  ", "\t"]).join(w))
        rows.append((i, "\n".join(text)))
    df = spark.createDataFrame([(i, t, None, None, None, None, None, None) for i, t in rows], none.schema)
    assert Counter(map(tuple, linedup.dedup_lines(df).collect())) == near_lines(rows)
    assert linedup.dedup_lines(none).count() == 0


def test_template_lines_form_no_pairs(spark, none):
    """3,000 lines that differ in one word: all linked to each other."""
    rows = [(i, f"this is the shared line with number {i} inside it", None, None, None, None, None, None) for i in range(3000)]
    out = linedup.dedup_lines(spark.createDataFrame(rows, none.schema)).collect()
    assert {(r.first_doc_id, r.n_links) for r in out} == {(0, 2999)}
    assert [r.doc_id for r in out if r.kept] == [0]


def test_lines_join_instead_of_broadcast(spark, monkeypatch):
    docs = common.load(spark, SF, "documents")
    want = Counter(map(tuple, linedup.dedup_lines(docs).collect()))
    monkeypatch.setattr(linedup, "BROADCAST_LINES", 0)
    assert Counter(map(tuple, linedup.dedup_lines(docs).collect())) == want


def test_mix(spark, odd, odd_rows, none):
    out = mixing.mix(odd, {"s0": 3.0, "s1": 1.0, "gone": 1.0}, total=400)
    assert out.columns == odd.columns
    n = Counter(r.source for r in out.collect())
    assert set(n) == {"s0", "s1"} and 150 < n["s0"] < 330 and 40 < n["s1"] < 140
    assert mixing.mix(none).count() == 0
    assert mixing.mix(odd, {}).count() == 0
    again = mixing.mix(odd.repartition(5), {"s0": 3.0, "s1": 1.0, "gone": 1.0}, total=400)
    assert Counter(map(str, out.collect())) == Counter(map(str, again.collect()))


def test_mix_follows_the_poisson_law(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "if(id % 4 = 0, 'b', null) as source")
    rate = {"b": 0.7 * 30_000 / 5_000}
    out = mixing.replicate(docs, {"b": 0.7}, total=21_000)
    copies = Counter(out.groupBy("doc_id").count().selectExpr("count").rdd.map(lambda r: r[0]).collect())
    lam, p = rate["b"], np.exp(-rate["b"])
    for k in range(0, 12):
        share = (copies[k] if k else 5_000 - sum(copies.values())) / 5_000
        assert abs(share - p) < 5 * np.sqrt(p * (1 - p) / 5_000) + 1e-4, k
        p = p * lam / (k + 1)
    rates = mixing.rates(docs, {"b": 1.0}, total=5_000 * 2_000).first()
    assert rates["rate"] == 2000.0 and abs(rates["cdf"][-1] - 1) < 1e-9


def test_one_id_over_several_texts(spark, none):
    """Rows that share a doc_id (or have none) are judged each by its text."""
    words = lambda seed, n: " ".join(f"w{seed}x{k}" for k in range(n))
    long, other = words("a", 300), words("b", 80)
    near = long.replace("wax150", "changed")
    texts = [(1, long), (2, long), (2, other), (2, words("c", 60)), (3, near), (4, other), (None, near), (None, words("d", 70)), (None, words("d", 70)), (5, words("e", 9))]
    df = spark.createDataFrame([(i, t, "en", "s", 1, None, None, None) for i, t in texts], none.schema)
    got = Counter(map(tuple, substring.remove_repeats(df).collect()))
    assert got == Counter(brute.without_repeats(texts))
    classes = rows_of(minhash.near_classes(df), "doc_id", "class_id")
    want = [(1, 1), (2, 1), (2, 2), (2, 2), (3, 1), (4, 2), (None, 1), (None, None), (None, None), (5, 5)]
    assert Counter(classes) == Counter(want)
    kept = Counter((r.doc_id, r.text) for r in minhash.keep_one(df).collect())
    assert kept == Counter([(1, long), (2, other), (2, words("c", 60)), (None, words("d", 70)), (5, words("e", 9))])
    bench = spark.createDataFrame([(9, words("c", 20))], "item_id long, text string")
    left = Counter((r.doc_id, r.text) for r in decontam.decontaminate(df, bench).collect())
    assert left == Counter(texts) - Counter([(2, words("c", 60))])


def test_columns_that_clash_with_helpers(spark, none):
    """Stages carry any other column through, whatever its name."""
    names = ["__host", "__key", "__lines", "__u", "__n", "__cdf", "__src", "__copy", "__order", "leaked", "lost", "key", "label", "own", "other0"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` int" for n in names)
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(60)), "en", f"s{i % 2}", 1, *range(len(names))) for i in range(30)]
    df = spark.createDataFrame(rows, schema)
    bench = spark.createDataFrame([(1, "some words that stand in no document")], "item_id long, text string")
    for out in (quality.clean(df, quality.PRODUCTION), quality.clean(df, dataclasses.replace(quality.PRODUCTION, broadcast_lines=0)), minhash.keep_one(df), decontam.decontaminate(df, bench), mixing.mix(df)):
        assert out.columns == df.columns
        assert all(tuple(r)[5:] == tuple(range(len(names))) for r in out.collect())
