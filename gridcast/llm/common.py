"""Shared helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.config import scratch_path


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the result no
    longer depends on its lineage or on any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key(text: Column) -> Column:
    """128-bit key of a text; null counts as empty."""
    filled = F.coalesce(text, F.lit(""))
    return F.concat(F.xxhash64(filled).cast("string"), F.lit(":"), F.xxhash64(F.lit(11), filled).cast("string"))


def shielded(docs: DataFrame, *used: str) -> DataFrame:
    """``docs`` with every column but the ``used`` ones under a plain number,
    so that helper columns clash with none; ``toDF(*docs.columns)`` undoes it."""
    return docs.select(*[docs[f"`{c}`"].alias(c if c in used else f"other{i}") for i, c in enumerate(docs.columns)])


def columns_of(df: DataFrame, *names: str) -> list[Column]:
    """The named columns, whatever other columns a table carries."""
    return [df[n] for n in names]


def small_enough(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no more than that."""
    return len(df.select(F.lit(1)).take(rows + 1)) <= rows


def connected(links: DataFrame) -> DataFrame:
    """Components of the graph with links (``a``, ``b``): one row per vertex
    with ``id`` and ``label``, the smallest id of its component.

    Alternating large-star and small-star steps; every step is a group
    aggregate plus a join on staged tables, so that a vertex with very many
    links is never gathered into one task.
    """
    state = lambda df: tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
    edges = staged(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "links")
    vertices = edges.select(F.col("a").alias("id")).union(edges.select(F.col("b").alias("id"))).distinct()
    before = state(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("m"))
        # large-star: each larger neighbour of v moves to v's least neighbour
        large = both.join(least, F.col("a") == F.col("v")).where("b > a").select(F.col("m").alias("a"), "b").distinct()
        # small-star: v and its smaller neighbours move to the least of them
        down = large.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("m"))
        moved = large.join(down, F.col("b") == F.col("v")).select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y"))
        after = staged(moved.where("x < y").distinct().select(F.col("x").alias("a"), F.col("y").alias("b")), "links")
        edges, now = after, state(after)
        if now == before:
            break
        before = now
    labels = edges.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("label"))
    return staged(vertices.join(labels, "id", "left").select("id", F.coalesce("label", "id").alias("label")), "labels")
