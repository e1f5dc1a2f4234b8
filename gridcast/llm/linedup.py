"""Line dedup by a deletion-neighbourhood join, in DataFrame functions only.

A line is its words joined by one space; its first occurrence has the
smallest (doc_id, line number).  Lines of at least ``min_words`` words are
near when one word inserted, deleted or replaced makes them equal; shorter
lines only match exactly.  A line is dropped when an equal or near line
stands earlier: the earliest is kept.

1. A pair within one edit shares its first or its last half of words, so a
   line whose halves occur in no other line has no partner.  Only the others
   emit their neighbourhood.
2. A line of ``n`` words emits ``n`` variants, each without one word, and
   itself, as hashed keys; variants that no other line has are dropped.
3. Equal variants of lines of equal length with the same word left out are
   one group whose members are all near each other: the group's earliest
   line and its size give every member's links without forming pairs.
   A variant that equals a whole line one word shorter is a link of its own.
4. Words decide: each member is compared with its group's earliest line, or
   the shorter line with the longer one.

Cases: null and empty texts, and lines without a word, give no row; a null
doc_id counts as the smallest; repeated rows are judged alike; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_enough, staged

MIN_WORDS = 8
#: Tables of line keys are broadcast up to so many rows.
BROADCAST_LINES = 400_000


def normal(line: Column) -> Column:
    """The line's words joined by one space."""
    odd = line.contains("\t") | line.contains("\r") | line.contains("\x0b") | line.contains("\x0c")
    plain = F.when(odd, F.translate(line, "\t\r\x0b\x0c", "    ")).otherwise(line)
    single = F.when(plain.contains("  "), F.regexp_replace(plain, " +", " ")).otherwise(plain)
    return F.trim(single)


def lines_of(docs: DataFrame) -> DataFrame:
    """``doc_id, line_no, line`` of every line that has a word."""
    split = docs.select(docs["doc_id"].alias("doc_id"), F.posexplode(F.split(docs["text"], "\n")).alias("line_no", "raw"))
    return split.select("doc_id", "line_no", normal(F.col("raw")).alias("line")).where("line <> ''")


def _side(keys: DataFrame) -> DataFrame:
    """A staged table of keys: broadcast up to its limit, else shuffled."""
    return F.broadcast(keys) if small_enough(keys, BROADCAST_LINES) else keys


def _xor(hashes: Column) -> Column:
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: a.bitwiseXOR(h))


def _halves() -> Column:
    """Keys of the first and last halves, rounded down and up: a pair within
    one edit shares one of them."""
    down, up = "int(n / 2)", "int((n + 1) / 2)"
    keys = [f"xxhash64('{side}', {h}, substring_index(line, ' ', {sign}{h}))" for h in (down, up) for side, sign in (("first", ""), ("last", "-"))]
    return F.expr(f"if(n % 2 = 0, array({', '.join(keys[:2])}), array({', '.join(keys)}))")


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, line_no, first_doc_id, first_line_no, n_links, kept`` of every
    line: the earliest equal or near line, and the number of different lines
    that are near."""
    lines = lines_of(docs)
    words = (F.octet_length("line") - F.octet_length(F.replace(F.col("line"), F.lit(" "), F.lit(""))) + 1).cast("int")
    keyed = lines.withColumn("n", words).select("doc_id", "line_no", F.xxhash64("line").alias("id"), F.xxhash64(F.lit(7), "line").alias("id2"), "n", F.when(F.col("n") >= min_words, _halves()).alias("halves"))
    held = staged(keyed, "lines-all")

    # 1. lines with a half in common with another line
    halves = held.where("halves is not null").select("id", F.explode("halves").alias("half"))
    common = staged(halves.groupBy("half").agg(F.min("id").alias("x"), F.max("id").alias("y")).where("x < y").select("half"), "lines-common")
    pick = staged(halves.join(_side(common), "half", "left_semi").select(F.col("id").alias("w")).distinct(), "lines-wanted")
    pick = _side(pick)
    firsts = staged(held.groupBy("id", "id2").agg(F.min(F.struct("doc_id", "line_no")).alias("first"), F.count("*").alias("copies")), "lines-first")
    texts = lines.withColumn("id", F.xxhash64("line")).join(pick, F.col("id") == F.col("w"), "left_semi")
    texts = texts.select("id", F.xxhash64(F.lit(7), "line").alias("id2"), "line").dropDuplicates(["id", "id2"])
    mine = firsts.join(pick, F.col("id") == F.col("w"), "left_semi").select("id", "id2", "first")
    near = staged(texts.join(mine, ["id", "id2"]).select("id", "id2", "first", F.split("line", " ").alias("words")).withColumn("n", F.size("words")), "lines-near")

    # 2. the neighbourhood: word positions are left out of the key here, so
    # that a variant meets lines of equal length and lines one word shorter
    hashed = near.select("id", "id2", "n", F.transform("words", lambda w: F.xxhash64(w)).alias("h")).withColumn("all", _xor(F.col("h")))
    variants = hashed.select("id", "id2", "n", F.posexplode(F.transform("h", lambda h: F.col("all").bitwiseXOR(h))).alias("at", "key"))
    whole = hashed.select("id", "id2", F.col("n"), F.lit(-1).alias("at"), F.col("all").alias("key"))
    every = variants.select("id", "id2", F.col("n") - 1, "at", "key").toDF("id", "id2", "m", "at", "key").union(whole.toDF("id", "id2", "m", "at", "key"))
    shared = staged(every.groupBy("m", "key").agg(F.min("id").alias("x"), F.max("id").alias("y")).where("x < y").select("m", "key"), "lines-shared")
    met = staged(every.join(_side(shared), ["m", "key"]), "lines-met")

    # 3. and 4. equal length: the group of a left-out word
    member = met.where("at >= 0").select("id", "id2", "at").join(near, ["id", "id2"])
    rest = F.concat(F.slice("words", F.lit(1), F.col("at")), F.slice("words", F.col("at") + 2, F.greatest(F.col("n") - 1 - F.col("at"), F.lit(0))))
    spot = staged(member.select("id", "id2", "first", "n", "at", F.xxhash64("n", "at", rest).alias("k1"), F.xxhash64(F.lit(7), "n", "at", rest).alias("k2")), "lines-spot")
    groups = staged(spot.groupBy("k1", "k2").agg(F.count("*").alias("size"), F.min(F.struct("first", "id", "id2")).alias("top")).where("size > 1"), "lines-groups")
    replaced = spot.join(groups, ["k1", "k2"]).select("id", "id2", "at", "size", F.col("top.first").alias("other"), F.col("top.id").alias("tid"), F.col("top.id2").alias("tid2"))
    mine = near.select("id", "id2", F.col("words").alias("mine"))
    top = near.select(F.col("id").alias("tid"), F.col("id2").alias("tid2"), F.col("words").alias("theirs"))
    same = lambda words: F.concat(F.slice(words, F.lit(1), F.col("at")), F.slice(words, F.col("at") + 2, F.greatest(F.size(words) - 1 - F.col("at"), F.lit(0))))
    checked = replaced.join(mine, ["id", "id2"]).join(top, ["tid", "tid2"]).where((F.size("mine") == F.size("theirs")) & (same("mine") == same("theirs")))
    links = checked.select("id", "id2", (F.col("size") - 1).alias("links"), "other")

    # one word more: a variant that is a whole line
    short = met.where("at < 0").select(F.col("id").alias("sid"), "m", "key")
    longer = met.where("at >= 0").select("id", "m", "key", "at").join(short, ["m", "key"]).select("id", "sid", "at")
    a = near.select("id", "id2", F.col("first").alias("first_long"), F.col("words").alias("long"))
    b = near.select(F.col("id").alias("sid"), F.col("id2").alias("sid2"), F.col("first").alias("first_short"), F.col("words").alias("short"))
    fit = longer.join(a, "id").join(b, "sid").where(same("long") == F.col("short")).select("id", "id2", "sid", "sid2", "first_long", "first_short").distinct()
    one = F.lit(1).cast("long")
    links = links.union(fit.select("id", "id2", one, "first_short")).union(fit.select("sid", "sid2", one, "first_long"))
    found = staged(links.groupBy("id", "id2").agg(F.sum("links").alias("n_links"), F.min("other").alias("other")), "lines-links")

    # lines that stand alone are their own earliest; the others are looked up
    own = found.join(near.select("id", "id2", "first"), ["id", "id2"]).select("id", "id2", F.least("first", "other").alias("earliest"), "n_links")
    again = firsts.where("copies > 1").select("id", "id2", F.col("first").alias("earliest"), F.lit(0).cast("long").alias("n_links"))
    info = staged(own.union(again).groupBy("id", "id2").agg(F.min("earliest").alias("earliest"), F.max("n_links").alias("n_links")), "lines-info")
    here = F.struct("doc_id", "line_no")
    out = held.select("doc_id", "line_no", "id", "id2").join(_side(info), ["id", "id2"], "left").withColumn("earliest", F.coalesce("earliest", here))
    links = F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")
    return out.select("doc_id", "line_no", F.col("earliest.doc_id").alias("first_doc_id"), F.col("earliest.line_no").alias("first_line_no"), links, (here == F.col("earliest")).alias("kept"))
