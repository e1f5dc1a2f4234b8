"""Mixing sources to target weights by Poisson replication.

A source with weight share ``s`` and ``n`` documents has the mean repetition
rate ``s * total / n``.  Each document draws its number of copies by
inverting the Poisson distribution with that mean at a uniform number hashed
from seed and document; it is exploded by that
number and the copies are shuffled by a second hash.  The draw needs no
state: the same rows and seed give the same mix in any order of execution.

The inversion table of a source is an array of cumulative probabilities up
to ``rate + 12 * sqrt(rate) + 30`` (the tail beyond is below 1e-16), built
once per source.  The per-source table is broadcast when its row count is
below ``broadcast_sources`` and joined otherwise.

Cases: a null source is a source of its own; sources without a weight (or
with weight 0) give no rows; a null doc_id draws like an id; repeated rows
draw alike; an empty table gives no rows; all columns are carried by
``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shielded, small_enough, staged

SEED = 20_240_601
#: Weight of a source with n documents is n ** TEMPERATURE unless given.
TEMPERATURE = 0.5
BROADCAST_SOURCES = 20_000


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from the md5 of the joined parts (52 bits)."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def rates(docs: DataFrame, weights: dict[str, float] | None = None, total: int | None = None, temperature: float = TEMPERATURE) -> DataFrame:
    """``src, n_docs, rate, cdf``: mean copies of a document per source."""
    spark = docs.sparkSession
    per = docs.groupBy(docs["source"].alias("src")).agg(F.count("*").alias("n_docs"))
    if weights is None:
        per = per.withColumn("weight", F.pow(F.col("n_docs").cast("double"), F.lit(temperature)))
    else:
        given = spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "s string, weight double")
        per = per.join(given, F.col("src").eqNullSafe(F.col("s"))).drop("s")
    per = staged(per.where("weight > 0"), "mix-sources")
    whole = per.agg(F.sum("weight").alias("w"), F.sum("n_docs").alias("d")).first()
    if not whole["w"]:
        return per.withColumn("rate", F.lit(0.0)).withColumn("cdf", F.array(F.lit(1.0)))
    wanted = float(total if total is not None else whole["d"])
    rate = F.col("weight") / F.lit(whole["w"]) * F.lit(wanted) / F.col("n_docs")
    top = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30).cast("int")
    # log p(k) = log p(k - 1) + log(rate) - log(k)
    step = F.aggregate(
        F.sequence(F.lit(1), top),
        F.struct((-F.col("rate")).alias("log"), F.exp(-F.col("rate")).alias("sum"), F.array(F.exp(-F.col("rate"))).alias("cdf")),
        lambda s, k: F.struct(
            (s["log"] + F.log(F.col("rate")) - F.log(k.cast("double"))).alias("log"),
            (s["sum"] + F.exp(s["log"] + F.log(F.col("rate")) - F.log(k.cast("double")))).alias("sum"),
            F.concat(s["cdf"], F.array(s["sum"] + F.exp(s["log"] + F.log(F.col("rate")) - F.log(k.cast("double"))))).alias("cdf"),
        ),
        lambda s: s["cdf"],
    )
    return per.withColumn("rate", rate).withColumn("cdf", step)


def replicate(docs: DataFrame, weights: dict[str, float] | None = None, total: int | None = None, seed: int = SEED, temperature: float = TEMPERATURE) -> DataFrame:
    """One row per copy: all columns plus ``__copy`` (from 0) and ``__order``,
    the random key of the global shuffle."""
    per = staged(rates(docs, weights, total, temperature).select(F.col("src").alias("__src"), F.col("cdf").alias("__cdf")), "mix-rates")
    side = F.broadcast(per) if small_enough(per, BROADCAST_SOURCES) else per
    drawn = docs.join(side, docs["source"].eqNullSafe(F.col("__src")))
    name = docs["doc_id"].cast("string")
    if "text" in docs.columns:
        name = F.coalesce(name, F.md5(F.coalesce(docs["text"], F.lit("")).cast("binary")))
    u = uniform(f"{seed}:draw", name)
    copies = F.size(F.filter("__cdf", lambda c: c <= F.col("__u")))
    rows = drawn.withColumn("__u", u).withColumn("__n", copies).where("__n > 0")
    exploded = rows.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    key = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(f"{seed}:order"), F.coalesce(name, F.lit("")), F.col("__copy").cast("string")).cast("binary")), 1, 15), 16, 10).cast("long")
    return exploded.withColumn("__order", key).drop("__src", "__cdf", "__u", "__n")


def shuffled(rows: DataFrame) -> DataFrame:
    """Global shuffle: dealt by the random key, sorted by it in each part."""
    return rows.repartition("__order").sortWithinPartitions("__order")


def mix(docs: DataFrame, weights: dict[str, float] | None = None, total: int | None = None, seed: int = SEED, temperature: float = TEMPERATURE) -> DataFrame:
    """The mixed corpus with the columns of ``docs``, shuffled globally."""
    plain = shielded(docs, "doc_id", "text", "source")
    rows = replicate(plain, weights, total, seed, temperature)
    return shuffled(rows).select(*plain.columns).toDF(*docs.columns)
