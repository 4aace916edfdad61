"""Corpus operators: paragraphs, cleaning, priority deduplication, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kaghamar.functions.text import WS, clean_chunk, share_percent
from kaghamar.session import cut_lineage, small

MIN_CHARS = 50


def paragraphs(df: DataFrame, key: str, text: str, separator: str = rf"\n{WS}*\n+", least: int = MIN_CHARS, at_end: str | None = None) -> DataFrame:
    """(key, pos, paragraph): pieces between blank lines.

    Line ends are unified first. Pieces of fewer than `least` characters are dropped, the last one of
    a file only if it is blank: of every row, or of those whose column `at_end` says that they end
    their file without a blank line. pos counts all pieces.
    """
    lines = F.regexp_replace(F.col(text), r"\r\n|\r", "\n")
    end = F.col(at_end) if at_end else F.lit(True)
    pieces = df.select(F.col(key), end.alias("_end"), F.split(lines, separator, -1).alias("p")).select(key, "_end", F.size("p").alias("n"), F.posexplode("p").alias("pos", "paragraph"))
    long = F.length("paragraph") >= least
    last = F.col("_end") & (F.col("pos") == F.col("n") - 1) & F.regexp_replace("paragraph", WS, "").isNotNull() & (F.length(F.regexp_replace("paragraph", WS, "")) > 0)
    return pieces.filter(long | last).select(key, "pos", "paragraph")


def with_rank(df: DataFrame, order: DataFrame) -> DataFrame:
    """Only rows of listed sources, with the source's priority; `order` has one row per source and is broadcast while it is small."""
    return df.join(small(order), "source")


def cleaned(df: DataFrame, text: str = "text", keep: str | None = None) -> DataFrame:
    """The rows with `clean`, cleaned in one projection."""
    return df.withColumn("clean", clean_chunk(F.col(text), keep) if keep else clean_chunk(F.col(text)))


def flag_paragraphs(df: DataFrame, order: DataFrame, tie: str, least: int = MIN_CHARS, dedup: bool = True) -> DataFrame:
    """Every ranked paragraph with its fate: kept, short or duplicate.

    Short ones go before duplicates are looked for. The survivor of equal texts is the first by
    (priority, pos, tie); the shuffle carries a digest, and the survivor is found by a partial
    aggregate, so a text that a third of all rows share gathers no rows anywhere.
    """
    rows = with_rank(cleaned(df.filter(F.col("text").isNotNull())), order)
    rows = rows.withColumn("chars_in", F.length("text")).withColumn("chars_out", F.length("clean")).withColumn("digest", F.md5("clean"))
    rows = rows.select("source", "priority", "pos", tie, "chars_in", "chars_out", "digest")
    if dedup:
        rows = cut_lineage(rows)  # narrow rows, read twice; the texts are cleaned once
    short = F.col("chars_out") < least
    if not dedup:
        return rows.withColumn("fate", F.when(short, "short").otherwise("kept"))
    place = F.struct("priority", "pos", tie)
    first = rows.filter(~short).groupBy("digest").agg(F.min(place).alias("first")).select(F.col("first")[tie].alias(tie), F.lit(True).alias("is_first"))
    flagged = rows.join(first, tie, "left")
    return flagged.withColumn("fate", F.when(short, "short").when(F.col("is_first"), "kept").otherwise("duplicate")).drop("is_first")


def source_stats(flagged: DataFrame, order: DataFrame) -> DataFrame:
    """One row per listed source; sources without rows are missing ones with zeros."""
    count = lambda fate: F.sum((F.col("fate") == fate).cast("long"))
    stats = flagged.groupBy("source").agg(
        F.sum(F.col("chars_in").cast("long")).alias("chars_in"),
        F.sum(F.when(F.col("fate") == "kept", F.col("chars_out") + 2).otherwise(0).cast("long")).alias("chars_out"),
        count("kept").alias("kept"), count("short").alias("dropped_short"), count("duplicate").alias("dropped_duplicates"),
    )
    out = order.join(stats, "source", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return out.select(
        "source", "priority", F.when(F.col("kept").isNull(), "missing").otherwise("ok").alias("status"),
        *(zero(c) for c in ("chars_in", "chars_out", "kept", "dropped_short", "dropped_duplicates")),
    ).withColumn("compression_pct", share_percent(F.col("chars_in") - F.col("chars_out"), F.col("chars_in"))).withColumn(
        "duplicate_pct", share_percent(F.col("dropped_duplicates"), F.col("kept") + F.col("dropped_duplicates"))
    )


def totals(stats: DataFrame) -> DataFrame:
    """The global row over all sources."""
    names = ("chars_in", "chars_out", "kept", "dropped_short", "dropped_duplicates")
    out = stats.agg(*(F.sum(c).alias(c) for c in names))
    return out.withColumn("compression_pct", share_percent(F.col("chars_in") - F.col("chars_out"), F.col("chars_in")))


def keep_first(df: DataFrame, by: Column, order: list[str]) -> DataFrame:
    """One row per value of `by`, the first in the order of columns that together name a row.

    Only the value's digest and those columns are aggregated, partially before the shuffle, so that a
    value of very many rows gathers nowhere; whole rows move once, by their own names.
    """
    first = df.groupBy(F.md5(by).alias("_digest")).agg(F.min(F.struct(*order)).alias("_first"))
    return df.join(first.select("_first.*"), order, "left_semi")


def first_reason(reasons: list[tuple[str, Column]]) -> Column:
    """The name of the first condition that holds, `kept` if none does."""
    out = F.lit("kept")
    for name, condition in reversed(reasons):
        out = F.when(condition, name).otherwise(out)
    return out


def without_done(df: DataFrame, done: DataFrame, on: str) -> DataFrame:
    """Rows whose key no manifest row holds."""
    return df.join(done.select(on).distinct(), on, "left_anti")


def sample_per_group(df: DataFrame, group: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """At most n rows per group, by the digest of seed and key, so that the sample is the same everywhere.

    A first pass by (group, hash bucket) keeps the n smallest digests of each bucket, so that no task
    ranks a whole group.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    rows = df.withColumn("digest", digest).withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(64)))
    part = F.row_number().over(Window.partitionBy(group, "bucket").orderBy("digest"))
    rows = rows.withColumn("r", part).filter(F.col("r") <= n)
    rank = F.row_number().over(Window.partitionBy(group).orderBy("digest"))
    return rows.withColumn("r", rank).filter(F.col("r") <= n).drop("r", "digest", "bucket")
