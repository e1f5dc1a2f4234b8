"""Conversation repair against a plain table of all edits."""

import hashlib
import random
import re
import zlib

import pytest

from gridcast.llm import repair
from gridcast.llm.common import load

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, code string, at long, c int, place int"


def table(codes):
    """Least (cost, audit) row by row over the written pattern's states."""
    to = {"": "u", "s": "u", "u": "a", "a": "u"}
    label = {"": (0, "")}

    def inserts(label):
        for _ in range(3):
            for state, (c, audit) in list(label.items()):
                new = (c + 2, audit + "I")
                label[to[state]] = min(label.get(to[state], new), new)
        return label

    label = inserts(label)
    for code in codes:
        new = {}
        for state, (c, audit) in label.items():
            moves = [(state, 3, "D")]
            if code not in "bd":
                low, more = code.lower(), code.isupper()
                moves.append((to[state], 2 + more, "R"))
                if (low == "s" and state == "") or low == to[state]:
                    moves.append((low, 0 + more, "K"))
            for x, price, letter in moves:
                new[x] = min(new.get(x, (c + price, audit + letter)), (c + price, audit + letter))
        label = inserts(new)
    return min(v for k, v in label.items() if k in ("", "a"))


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        blank = lambda x: " " if x is None else x
        kind = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def repaired(rows):
    """Of one conversation's rows: the result without its id."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    codes, seen = "", set()
    for _, _, role, text in rows:
        shown = text.strip(" \t\n\r\x0b\x0c")
        low = role[:1] if role[:1] in ("s", "u", "a") else "o"
        codes += "b" if not shown else "d" if (role, text) in seen else low if shown[-1] in ".!?" else low.upper()
        seen.add((role, text))
    cost, audit = table(codes)
    turns = {r[1] for r in rows if r[1] is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    first = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False))
    out, at, written = [], 0, ""
    for x in audit:
        row = None if x == "I" else rows[at]
        at += x != "I"
        if x == "D":
            continue
        role = row[2] if x == "K" else "assistant" if written == "u" else "user"
        written = role[:1]
        out.append(f"{role}:{'' if x == 'I' else row[3]}")
    sha = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return gaps, codes.count("b"), codes.count("d"), sum(c.isupper() for c in codes), illegal, cost, audit, sha


def expected(rows):
    hurt, out = damaged(rows), []
    for conv in {r[0] for r in rows}:
        own = [r for r in hurt if r[0] == conv]
        out.append((conv, *(repaired(own) if own else (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest()))))
    return sorted(out, key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "code", 7, 8, 9) for r in rows], SCHEMA)
    return sorted(map(tuple, repair.damage_and_repair(df, **kw).collect()), key=repr)


def test_cheapest_is_the_least_of_all_audits():
    r = random.Random(1)
    for n in list(range(12)) * 20 + [300]:
        codes = "".join(r.choices("suaoSUAObd", (1, 5, 5, 1, 1, 2, 2, 1, 1, 1), k=n))
        assert repair.cheapest(codes) == table(codes)
    # the empty result, and one that only inserts can complete
    assert repair.cheapest("") == (0, "") and repair.cheapest("s") == (3, "D") and repair.cheapest("su") == (2, "KKI")


def test_blocks_give_the_whole_path():
    r = random.Random(2)
    for n in list(range(2, 40)) * 2 + [500]:
        codes = "".join(r.choices("suaoSUAObd", (1, 4, 4, 1, 1, 2, 2, 1, 1, 1), k=n))
        size = r.randint(1, 9) if n < 100 else 64
        parts = [codes[i : i + size] for i in range(0, n, size)]
        solved = [repair.segments(p, i == 0, i == len(parts) - 1) for i, p in enumerate(parts)]
        path = repair.combine(iter(solved))
        chosen = [next(x for x in s if x[:2] == (a, b)) for s, a, b in zip(solved, path, path[1:], strict=False)]
        assert (sum(x[2] for x in chosen), "".join(x[3] for x in chosen)) == table(codes)


def odd_rows():
    r = random.Random(6)
    texts = ["Yes.", "no", "Well?\n", " ", "", None, "é!", "x" * 3000 + ".", " "]
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    rows = []
    for conv in list(range(40)) + [None]:
        for turn in range(r.randint(1, 9)):
            rows.append((conv, None if r.random() < 0.1 else turn * r.choice((1, 1, 2)), r.choices(roles, (6, 6, 2, 1, 1, 1, 1))[0], r.choice(texts)))
    # ties of turns, repeated rows, and one conversation of very many rows
    rows += rows[:25] + [(c, t, "user", "Again.") for c, t, _, _ in rows[30:60]]
    return rows + [(77, i, ("user", "assistant")[i % 2] if i % 7 else "user", f"word {i % 90}" + "." * (i % 5 > 0)) for i in range(1500)]


@pytest.mark.parametrize("block", [5, repair.BLOCK])
def test_odd_rows(spark, block):
    rows = odd_rows()
    got = run(spark, rows, block=block)
    assert got == expected(rows)
    # every conversation is there, also one that lost all its rows
    assert any(x[7] == "" for x in got) or all(len(x[7]) for x in got)


def test_lost_conversations_and_empty_table(spark):
    gone = [(c, 0, "user", "Hi.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert len(gone) > 3
    assert run(spark, gone) == expected(gone) and all(x[7] == "" for x in expected(gone))
    assert run(spark, []) == []


def test_given_table(spark):
    df = load(spark, SF, "conversations")
    want = expected([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    assert sorted(map(tuple, repair.damage_and_repair(df).collect()), key=repr) == want
