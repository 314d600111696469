"""A feed of any size cut from the given documents, skewed on purpose.

A third of all rows falls into one month and a third into one group.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from threadsift.sources.writers import write_feed_json

PUBLISHED_ROWS = 3_000_000

WORDS = 30


def make_feed(spark: SparkSession, sf_dir: str, path: str, rows: int) -> int:
    """Writes at least ``rows`` rows as JSON Lines and returns how many."""
    words = F.split("text", " ")
    starts = F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1)), F.lit(WORDS))
    pieces = (
        spark.read.parquet(f"{sf_dir}/documents.parquet")
        .select("doc_id", "source", "lang", words.alias("words"), F.posexplode(starts).alias("piece", "at"))
        .withColumn("body", F.array_join(F.slice("words", F.col("at"), WORDS), " "))
        .drop("words", "at")
    )
    size = pieces.count()
    copies = -(-rows // size)
    n = F.xxhash64("doc_id", "piece", "copy")
    part = lambda salt, k: F.pmod(F.xxhash64("doc_id", "piece", "copy", F.lit(salt)), F.lit(k))
    hot_month = F.lit(1325376000) + part(2, 31 * 86400)
    other = F.lit(1262304000) + part(3, 5 * 365 * 86400)
    feed = pieces.repartition(64).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    feed = feed.select(
        F.hex(n).alias("id"),
        F.when(part(1, 200) == 0, "[deleted]").otherwise(F.col("body")).alias("body"),
        (part(4, 41) - 15).alias("score"),
        F.when(part(5, 3) == 0, hot_month).otherwise(other).alias("created_utc"),
        F.when(part(6, 3) == 0, "hot")
        .otherwise(F.concat("source", F.lit("_"), part(7, 2000).cast("string")))
        .alias("subreddit"),
        F.col("lang").alias("subreddit_id"),
        F.concat(F.lit("u"), part(8, 500000).cast("string")).alias("author"),
        F.when(part(9, 30) == 0, 1).otherwise(0).alias("controversiality"),
    )
    write_feed_json(feed, path)
    return size * copies
