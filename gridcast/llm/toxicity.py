"""Toxicity by a weighted finite-state pattern grammar.

Transducers are tables of states: from a state and a tag, an arc leads to a
next state, an output tag and a weight.  A first transducer tags the tokens of
a clause as insults, threats, targets, negations, reporting words and turns
("but"); the others rewrite the tags: negation and reported speech reach from
their word to a turn or the clause's end, a target aims insults and threats up
to four tokens behind it, and the same machine run from the right those before
it.  The machines that read from the left are composed into one table, which
is run once over a clause.  Weights of insults and threats are multiplied by
the arcs on their path and summed by the tag they ended with, so that matched
clauses score, not isolated words.  Clauses without a core (insult or threat)
score nothing, so only clauses around a core are run.

Insults, as whole words or stems (``lowe*``), and their weights are learned
from the labelled rows: log odds of the share of toxic and clean texts that
hold them.  Threats are learned in the same way, as words between an intent
("will", "threatened to") and a target, beside a short list.  A logistic
regression on the clause sums turns the tags into a
score.  At most about ``sample_rows`` labelled rows are used, chosen by a
hash of their id; every document is scored on its whole text.

Cases: null and empty texts have no clause and get the score of a text
without a core; labels that are null are ignored, several labels of a
document are averaged; without toxic labels the score is constant; a null
doc_id counts as the text ''; repeated rows score alike; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .common import staged

SAMPLE_ROWS = 20_000
MIN_SUPPORT = 5
MIN_SHARE = 0.005
MIN_LOG_ODDS = 1.8
MIN_EVIDENCE = 16.0
MAX_LEXICON = 2000
STEMS = (4, 5, 6, 7, 8)
FOLDS = 5

#: Function words of the grammar in four languages (fixed values).
THREATS = frozenset("kill killing hurt destroy murder strangle umbringen töten schlagen tuer frapper matar golpear".split())
TARGETS = frozenset("you your yours yourself u he she him her they them du dich dir euch ihr sie tu toi te vous il elle ils elles tú ti usted él ella ellos ellas".split())
NEGATIONS = frozenset("not no never nobody nicht kein keine keinen nie ne pas jamais nunca jamás ni".split())
REPORTS = frozenset("said says say wrote writes called calls quoted sagte sagt schrieb nannte dit écrit appelle dijo dice escribió llamó".split())
TURNS = frozenset("but yet though although however aber doch sondern jedoch mais cependant pourtant pero sino aunque".split())
INTENTS = frozenset("will ll gonna going want wants threaten threatens threatened werde wird will drohte vais va menace voy amenaza amenazó".split())
TARGET_SCOPE = 4
INTENT_SCOPE = 3
FEATURES = ("plain", "aimed", "negated", "reported", "threat", "best", "clauses")

#: What the first transducer writes, and what the others may add.
TAGS = ("", "insult", "threat", "target", "negation", "report", "turn")
REWRITTEN = ("negated", "reported", "aimed", "menace")
CORES = ("insult", "threat")
#: Feature that the final tag of a token counts for; a threat that is aimed at
#: nobody counts for none.
FINAL = {"insult": "plain", "aimed": "aimed", "negated": "negated", "reported": "reported", "menace": "threat"}

TOKEN = re.compile(r"\w+")
IN_TOKEN = np.zeros(256, bool)
IN_TOKEN[0x30:0x3A] = IN_TOKEN[0x41:0x5B] = IN_TOKEN[0x61:0x7B] = IN_TOKEN[0x5F] = True
ENDS_CLAUSE = np.zeros(256, bool)
ENDS_CLAUSE[list(b".!?;:\n|")] = True


@dataclass(frozen=True)
class Lexicon:
    """Insult weights by whole word and by stem; threat weights by word."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    threats: dict[str, float] = field(default_factory=dict)

    def weight(self, token: str) -> float:
        found = self.words.get(token, 0.0)
        for n in STEMS:
            found = max(found, self.stems.get(token[:n], 0.0))
        return found


    def threat(self, token: str) -> float:
        return self.threats.get(token, 1.0 if token in THREATS else 0.0)

    def core(self, token: str) -> bool:
        return bool(self.threat(token) or self.weight(token))


@dataclass(frozen=True)
class Transducer:
    """Letter transducer that reads every tag in every state.

    ``arcs[state, tag]`` is (next state, output tag, weight); state 0 starts."""

    states: int
    arcs: dict[tuple[int, str], tuple[int, str, float]]

    def run(self, tags: list[tuple[str, float]]) -> list[tuple[str, float]]:
        state, out = 0, []
        for name, w in tags:
            state, name, by = self.arcs[state, name]
            out.append((name, w * by))
        return out

    def then(self, other: Transducer) -> Transducer:
        """Composition: one machine that does what this one and then
        ``other`` would do; states that cannot be reached are left out."""
        number, todo, arcs = {(0, 0): 0}, [(0, 0)], {}
        for p, q in todo:
            for tag in (*TAGS, *REWRITTEN):
                p2, mid, w = self.arcs[p, tag]
                q2, out, by = other.arcs[q, mid]
                if (p2, q2) not in number:
                    number[p2, q2] = len(number)
                    todo.append((p2, q2))
                arcs[number[p, q], tag] = (number[p2, q2], out, w * by)
        return Transducer(len(number), arcs)


def _machine(states: int, arc) -> Transducer:
    return Transducer(states, {(s, t): arc(s, t) for s in range(states) for t in (*TAGS, *REWRITTEN)})


def scope(opens: str, becomes: str) -> Transducer:
    """Cores between the tag ``opens`` and a turn or the end are rewritten."""
    return _machine(2, lambda s, t: (1 if t == opens else 0 if t == "turn" else s, becomes if s and t in CORES else t, 1.0))


def near(opens: str, reach: int, becomes: dict[str, str]) -> Transducer:
    """Cores up to ``reach`` tokens behind the tag ``opens`` are rewritten."""
    return _machine(reach + 1, lambda s, t: (reach if t == opens else max(s - 1, 0), becomes.get(t, t) if s else t, 1.0))


NEGATE = scope("negation", "negated")
REPORT = scope("report", "reported")
AIM = near("target", TARGET_SCOPE, {"insult": "aimed", "threat": "menace"})
#: The grammar: one machine from the left, one from the right.
FROM_LEFT = NEGATE.then(REPORT).then(AIM)
FROM_RIGHT = AIM


def tag(tokens: list[str], lexicon: Lexicon) -> list[tuple[str, float]]:
    """First transducer (one state): a tag and a weight for each token."""
    out = []
    for t in tokens:
        if w := lexicon.weight(t):
            out.append(("insult", w))
        elif w := lexicon.threat(t):
            out.append(("threat", w))
        elif t in TARGETS:
            out.append(("target", 0.0))
        elif t in NEGATIONS:
            out.append(("negation", 0.0))
        elif t in REPORTS:
            out.append(("report", 0.0))
        elif t in TURNS:
            out.append(("turn", 0.0))
        else:
            out.append(("", 0.0))
    return out


def rewrite(tags: list[tuple[str, float]]) -> list[tuple[str, float]]:
    """The composed grammar over the tags of a clause."""
    return FROM_RIGHT.run(FROM_LEFT.run(tags)[::-1])[::-1]


def clause(tokens: list[str], lexicon: Lexicon) -> np.ndarray:
    """Sums of a clause's weights by final tag (FEATURES)."""
    out = np.zeros(len(FEATURES))
    for name, w in rewrite(tag(tokens, lexicon)):
        if w and name in FINAL:
            out[FEATURES.index(FINAL[name])] += w
    if out.any():
        out[5] = out[:5].max()
        out[6] = 1.0
    return out


def _codes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The first four bytes of each token as a number (short ones padded)."""
    code = np.zeros(len(start), np.uint32)
    for i in range(4):
        byte = data[np.minimum(start + i, len(data) - 1)].astype(np.uint32)
        code |= np.where(length > i, byte, 0).astype(np.uint32) << np.uint32(8 * i)
    return code


def _fold(code: np.ndarray) -> np.ndarray:
    return (code * np.uint32(2654435761)) >> np.uint32(16)


@cache
def _word_points() -> np.ndarray:
    """Which code points TOKEN takes as part of a word."""
    out = np.zeros(0x110000, bool)
    for m in TOKEN.finditer("".join(map(chr, range(len(out))))):
        out[m.start() : m.end()] = True
    return out


def _in_token(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text belong to a token, by the rule of TOKEN."""
    inside = IN_TOKEN[data]
    lead = np.flatnonzero(data >= 0xC0)
    if not len(lead):
        return inside
    size = 2 + (data[lead] >= 0xE0).astype(np.int64) + (data[lead] >= 0xF0)
    point = (data[lead] & (0x7F >> size)).astype(np.int64)
    for k in range(1, 4):
        more = size > k
        point[more] = point[more] << 6 | (data[lead[more] + k] & 0x3F)
    word = _word_points()[point]
    for k in range(4):
        some = lead[word & (size > k)]
        inside[some + k] = True
    return inside


class Grammar:
    """The composed grammar over whole texts."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.table = np.zeros(1 << 16, bool)
        entries = [*lexicon.words, *lexicon.stems, *lexicon.threats, *THREATS]
        raw = [x.encode()[:4] for x in entries]
        if raw:
            code = np.array([int.from_bytes(x.ljust(4, b"\0"), "little") for x in raw], np.uint32)
            self.table[_fold(code)] = True

    def features(self, column: pa.Array) -> np.ndarray:
        """Feature sums of each text: rows x FEATURES."""
        out = np.zeros((len(column), len(FEATURES)))
        for t in K.chunks(pc.utf8_lower(column)):
            data = t.data
            if not len(data):
                continue
            inside = _in_token(data)
            edge = np.zeros(len(data) + 1, bool)
            edge[t.off] = True
            before = np.concatenate(([False], inside[:-1])) & ~edge[:-1]
            after = np.concatenate((inside[1:], [False])) & ~edge[1:]
            start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
            hit = np.flatnonzero(self.table[_fold(_codes(data, start, end - start))])
            if not len(hit):
                continue
            cut = np.concatenate(([-1], np.flatnonzero(ENDS_CLAUSE[data]), [len(data)]))
            seen = set()
            for h in hit.tolist():
                token = data[start[h] : end[h]].tobytes().decode()
                if not self.lexicon.core(token):
                    continue
                c = int(np.searchsorted(cut, start[h], side="right"))
                doc = int(np.searchsorted(t.off, start[h], side="right")) - 1
                if (doc, c) in seen:
                    continue
                seen.add((doc, c))
                lo, hi = max(int(cut[c - 1]) + 1, int(t.off[doc])), min(int(cut[c]), int(t.off[doc + 1]))
                f = clause(TOKEN.findall(data[lo:hi].tobytes().decode()), self.lexicon)
                best = max(out[t.lo + doc, 5], f[5])
                out[t.lo + doc] += f
                out[t.lo + doc, 5] = best
        out[:, [0, 1, 2, 3, 4, 6]] = np.log1p(out[:, [0, 1, 2, 3, 4, 6]])
        return out


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """About ``rows`` labelled training rows at most: ``text, toxic``."""
    marks = labels.select(labels["doc_id"].alias("__id"), labels["toxic"].alias("__toxic")).where("__toxic is not null and __id is not null")
    marks = marks.groupBy("__id").agg((F.avg("__toxic") >= 0.5).alias("toxic")).where(~held_out(F.col("__id")))
    share = min(1.0, rows / max(marks.count(), 1))
    marks = marks.where(F.pmod(F.xxhash64("__id"), F.lit(1_000_000)) < int(share * 1_000_000))
    found = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text")).join(marks, F.col("doc_id") == F.col("__id"))
    return found.select(F.coalesce("text", F.lit("")).alias("text"), "toxic")


def _forms(text: str) -> set[str]:
    """Whole words (``=word``), stems (``stem*``) and words between an intent
    and a target (``!word``) of a text."""
    every = TOKEN.findall(text.lower())
    tokens = {t for t in every if len(t) >= 3 and not t.isdigit()}
    out = {f"={t}" for t in tokens} | {f"{t[:n]}*" for t in tokens for n in STEMS if len(t) >= n}
    for at in (i for i, t in enumerate(every) if t in INTENTS):
        for i in range(at + 1, min(at + 1 + INTENT_SCOPE, len(every))):
            if every[i] in tokens and not TARGETS.isdisjoint(every[i + 1 : i + 1 + INTENT_SCOPE]):
                out.add(f"!{every[i]}")
    return out


def _emit_forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        count = Counter(x for t in batch.column("text").to_pylist() for x in _forms(t))
        yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], ["form", "n"])


def _count_forms(wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep, count = wanted.value, Counter()
        for batch in batches:
            for t in batch.column("text").to_pylist():
                count.update(x for x in _forms(t) if x in keep)
        yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], ["form", "n"])

    return run


def _evidence(n: int, m: int, bad: int, good: int) -> float:
    """Likelihood ratio of a form in n of bad and m of good texts."""
    share = (n + m) / (bad + good)
    return 2 * sum(k * np.log(k / (total * p)) for k, total, p in ((n, bad, share), (bad - n, bad, 1 - share), (m, good, share), (good - m, good, 1 - share)) if k > 0 and p > 0)


def learn_lexicon(rows: DataFrame, min_support: int = MIN_SUPPORT, max_size: int = MAX_LEXICON) -> Lexicon:
    """Insults and threats from labelled rows (``text, toxic``)."""
    spark = rows.sparkSession
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get(True, 0), sizes.get(False, 0)
    if not bad:
        return Lexicon()
    least = max(min_support, int(MIN_SHARE * bad))
    # counted per text: at most texts x forms / support candidates, all from the bounded sample
    toxic = rows.where("toxic").select("text").mapInArrow(_emit_forms, "form string, n long").groupBy("form").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    hits = {r["form"]: r["n"] for r in toxic.collect()}
    wanted = spark.sparkContext.broadcast(frozenset(hits))
    clean = rows.where("not toxic").select("text").mapInArrow(_count_forms(wanted), "form string, n long").groupBy("form").agg(F.sum("n").alias("n"))
    misses = {r["form"]: r["n"] for r in clean.collect()}
    odds = {f: float(np.log((n + 0.5) / (bad + 1)) - np.log((misses.get(f, 0) + 0.5) / (good + 1))) for f, n in hits.items()}
    sure = {f: _evidence(n, misses.get(f, 0), bad, good) for f, n in hits.items() if odds[f] >= MIN_LOG_ODDS}
    best = sorted((f for f in sure if sure[f] >= MIN_EVIDENCE), key=lambda f: (-sure[f], f))[:max_size]
    words, threats = ({f[1:]: odds[f] for f in best if f[0] == mark} for mark in "=!")
    return Lexicon(words, {f[:-1]: odds[f] for f in best if f[0] not in "=!"}, threats)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps; intercept first."""
    x = np.hstack((np.ones((len(x), 1)), x))
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _emit_features(lexicon: Lexicon):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(lexicon)
        for batch in batches:
            f = grammar.features(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *(pa.array(f[:, i]) for i in range(f.shape[1]))], ["toxic", *FEATURES])

    return run


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[Lexicon, np.ndarray]:
    """The lexicon and the weights of the clause sums."""
    chosen = staged(sample(docs, labels, rows), "toxic-sample")
    lexicon = learn_lexicon(chosen)
    if not lexicon.words and not lexicon.stems and not lexicon.threats:
        return lexicon, np.array([-2.0, *[0.0] * len(FEATURES)])
    # bounded by the sample: a few numbers per row
    seen = chosen.mapInArrow(_emit_features(lexicon), "toxic boolean, " + ", ".join(f"{f} double" for f in FEATURES)).toPandas()
    return lexicon, fit(seen[list(FEATURES)].to_numpy(), seen["toxic"].to_numpy(dtype=float))


def _emit_scores(lexicon: Lexicon, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(lexicon)
        for batch in batches:
            z = grammar.features(batch.column("text")) @ weights[1:] + weights[0]
            score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return run


def score(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    lexicon, weights = learn(docs, labels, rows)
    base = docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"), held_out(docs["doc_id"]).alias("held_out"))
    return base.mapInArrow(_emit_scores(lexicon, weights), f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, score double, predicted int")
