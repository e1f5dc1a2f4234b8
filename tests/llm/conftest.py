import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id long, text string, lang string, source string, n_chars int, key string, host string, copy int"


def prose(seed, n):
    import random

    r = random.Random(seed)
    return [("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 7)))) for _ in range(n)]


@pytest.fixture(scope="session")
def odd_rows():
    """Texts at the edges: null, empty, blank, one word, one very long word,
    repeated rows, copies, near copies, shared passages, odd white space."""
    base = prose(1, 300)
    passage = prose(2, 70)
    long = prose(3, 30_000)
    texts = {
        1: None,
        2: "",
        3: " \t\n\r\x0b\x0c ",
        4: "one",
        5: "x" * 20_000,
        6: " ".join(base),
        7: " ".join(base),
        8: " ".join(base[:150] + ["changed"] + base[151:]),
        9: "\n".join(" ".join(base[i : i + 12]) for i in range(0, 300, 12)) + "\n",
        10: " ".join(prose(4, 80) + passage + prose(5, 60)),
        11: " ".join(passage),
        12: " ".join(prose(6, 90) + passage[:55]),
        13: " ".join(passage[10:] + prose(7, 40) + passage[:60]),
        14: " ".join(long),
        15: " ".join(long[:15_000] + ["other"] + long[15_000:]),
        16: "a b c " * 60,
        17: "same line here\nsame line here\n\n\nsame  line here\nÄÖ ü€ 日本  x y 🙂",
        18: "É " * 55 + "\r\n" + "é\tÉ\x0bz " * 20,
        19: "one\x1ftwo " + " ".join(prose(8, 60)) + " #*$%&|<> ",
        20: " ".join(base[:50]),
        21: " ".join(base[:49]),
        22: " ".join(["the"] * 120),
    }
    rows = [(i, t, "en", f"s{i % 3}" if i != 8 else None, len(t or ""), "k", "h", 7) for i, t in texts.items()]
    rows += [rows[5], rows[9], (None, " ".join(passage), None, None, None, None, None, None), (None, None, "en", "s1", 0, "k", "h", 7)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
