"""Plain definitions of the operators' results, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def quality_base(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = Counter(grams)
    cover = set()
    for i, g in enumerate(grams):
        if seen[g] > 1:
            cover |= {i, i + 1, i + 2}
    failed = len(w) < 50 or 100 * len(cover) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover), failed


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def quality(rows, min_docs=10, max_share=0.1, min_left=0.3, max_docs=None):
    """rows: (doc_id, text, source); verdict per row, and the removed lines,
    each with its first text unless it is above the share."""
    norm = lambda line: " ".join(words(lower(line)))
    key = lambda text: hashlib.md5((text or "").encode()).hexdigest()
    texts, held = defaultdict(set), defaultdict(set)
    for _, text, host in rows:
        texts[host].add(text or "")
        for line in (text or "").split("\n"):
            if words(line):
                held[host, norm(line)].add(text or "")
    over = {}
    for k, v in held.items():
        if len(v) >= min_docs and len(v) > max_share * len(texts[k[0]]):
            over[k] = None
        elif max_docs and len(v) >= max(min_docs, max_docs):
            over[k] = min(map(key, v))
    out = []
    for doc_id, text, host in rows:
        base = quality_base(text)
        gone = [x for x in (text or "").split("\n") if words(x) and (host, norm(x)) in over]
        size = lambda lines: sum(len(words(x)) for x in lines)
        if base[0] - size(gone) < min_left * base[0]:
            gone = [x for x in gone if over[host, norm(x)] != key(text)]
        boiler = size(gone)
        out.append((doc_id, *base[:5], boiler, len(gone), base[5], not base[5] and base[0] - boiler >= min_left * base[0]))
    return out, over


def bag(text, length=5):
    w = words(text)
    if not w:
        return Counter()
    if len(w) < length:
        return Counter([tuple(w)])
    return Counter(tuple(w[i : i + length]) for i in range(len(w) - length + 1))


def similarity(a, b):
    return sum((a & b).values()) / max(sum((a | b).values()), 1)


def near_classes(rows, threshold=0.8):
    """rows: (doc_id, text) with distinct ids; class of each id."""
    bags = {i: bag(t) for i, t in rows}
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    index = defaultdict(list)
    for i, b in bags.items():
        for s in b:
            index[s].append(i)
    tried = set()
    for members in index.values():
        for x in range(len(members)):
            for y in range(x):
                pair = (members[y], members[x])
                if pair not in tried:
                    tried.add(pair)
                    if similarity(bags[pair[0]], bags[pair[1]]) >= threshold:
                        a, b = sorted((find(pair[0]), find(pair[1])))
                        root[b] = a
    return {i: find(i) for i in root}


def without_repeats(rows, window=50):
    """rows: (doc_id, text); per row doc_id, words, removed, sha256."""
    first = {}
    for i, t in rows:
        w = words(t)
        for p in range(len(w) - window + 1):
            k = tuple(w[p : p + window])
            if i is not None:
                first[k] = min(first.get(k, i), i)
    out = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p : p + window])] < i:
                gone |= set(range(p, p + window))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def contained(docs, items, length=5, threshold=0.8):
    """docs, items: (id, text); set of (doc, item, shared, size)."""

    def grams(t):
        w = words(lower(t or ""))
        return {tuple(w[i : i + length]) for i in range(len(w) - length + 1)}

    sets = [(i, grams(t)) for i, t in items]
    out = set()
    for d, t in docs:
        g = grams(t)
        for i, s in sets:
            if s and len(s & g) >= threshold * len(s):
                out.add((d, i, len(s & g), len(s)))
    return out


def size(text):
    return len((text or "").encode()) + 16


def crc(text):
    return zlib.crc32((text or "").encode())
