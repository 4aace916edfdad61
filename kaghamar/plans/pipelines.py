"""End-to-end runs: sources to a deduplicated corpus, pairs to chat tokens, texts to token files."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kaghamar.functions.text import ASSISTANT, END, USER
from kaghamar.operators import corpus, qa, tokens
from kaghamar.session import cut_lineage, written
from kaghamar.sources import readers, sinks

#: Merge order of the corpus sources, the first wins.
SOURCE_ORDER = ("wiki", "wikisource", "wiktionary", "wikiquote", "arlis", "ccnews", "glot500", "hplt3", "culturax", "finetranslations", "mc4", "cc100")
#: Benchmark configurations that go into training and evaluation.
TRAIN_CONFIGS = ("exam_history", "exam_literature", "exam_math", "include-mcqa", "public-services-mcqa")
EVAL_CONFIGS = ("simpleqa", "squad-in-context-qa", "belebele-in-context-mcqa")
#: Builders of each configuration from its raw rows; add to it to add one.
BENCHMARKS: dict[str, Callable[[DataFrame], DataFrame]] = {
    **{c: (lambda df, c=c: qa.exam_pairs(df, c)[0]) for c in TRAIN_CONFIGS[:3]},
    "include-mcqa": lambda df: qa.four_choice_pairs(df, [f"option_{o}" for o in "abcd"], "include-mcqa"),
    "public-services-mcqa": qa.public_service_pairs,
    "simpleqa": lambda df: qa.open_pairs(df, "simpleqa"),
    "squad-in-context-qa": lambda df: qa.open_pairs(df, "squad-in-context-qa", "context"),
    "belebele-in-context-mcqa": lambda df: qa.four_choice_pairs(df, [f"mc_answer{i}" for i in (1, 2, 3, 4)], "belebele-in-context-mcqa", "flores_passage"),
}


def benchmark_pairs(frames: dict[str, DataFrame], configs: tuple[str, ...]) -> DataFrame:
    """The union of the configurations that are there."""
    parts = [BENCHMARKS[c](frames[c]) for c in configs if c in frames]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def prepare_corpus(spark: SparkSession, paths: dict[str, str], out: str, dedup: bool = True, order: tuple[str, ...] = SOURCE_ORDER) -> DataFrame:
    """Read, split, clean, deduplicate and write the corpus with its statistics; gives the statistics.

    Paragraph ids follow the rows of the sources as read; a source that isn't there counts as missing.
    """
    ranks = spark.createDataFrame(list(zip(order, range(1, len(order) + 1))), "source string, priority int")
    texts = readers.load_sources(spark, paths).filter("text is not null")
    texts = texts.select(F.struct("source", F.monotonically_increasing_id().alias("n")).alias("doc"), "text", "at_end")
    pieces = corpus.paragraphs(texts, "doc", "text", at_end="at_end").select("doc.source", F.struct("doc.n", "pos").alias("pos"), F.col("paragraph").alias("text"))
    rows = cut_lineage(pieces.withColumn("para_id", F.monotonically_increasing_id()))  # ids are given once
    flagged = cut_lineage(corpus.flag_paragraphs(rows, ranks, "para_id", dedup=dedup))
    stats = cut_lineage(corpus.source_stats(flagged, ranks))
    kept = flagged.filter("fate = 'kept'").select("para_id", "priority").join(corpus.cleaned(rows).select("para_id", "source", "clean"), "para_id")
    kept.select("para_id", "source", "priority", F.col("clean").alias("text")).write.mode("overwrite").option("compression", "zstd").parquet(os.path.join(out, "paragraphs"))
    written = spark.read.parquet(os.path.join(out, "paragraphs"))
    sinks.write_text(written, os.path.join(out, "text"), order=["priority", "para_id"])
    sinks.write_stats(stats, corpus.totals(stats), os.path.join(out, "stats.json"))
    return stats


def merge_instructions(files: list[DataFrame]) -> DataFrame:
    """Pairs of several files, the first file's first row of an instruction wins; (instruction, input, output, source)."""
    out = None
    for rank, part in enumerate(files):
        part = part.withColumn("rank", F.lit(rank)).withColumn("row", F.monotonically_increasing_id())
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return qa.merge_pairs(written(out), "rank", "row").drop("rank", "row", "norm")


def tokenize(df: DataFrame, key: str, text: str, out: str, specials: tuple[str, ...] = (), vocabulary: DataFrame | None = None) -> DataFrame:
    """Character vocabulary, token table and its train and valid parts; gives (split, n_tokens).

    A vocabulary given is extended by the special tokens and then by the text's new characters.
    """
    own = cut_lineage(tokens.char_vocabulary(df, text))
    tagged = cut_lineage(tokens.add_tokens(own if vocabulary is None else vocabulary, list(specials)))
    vocabulary = tagged if vocabulary is None else cut_lineage(tokens.add_tokens(tagged, own))
    encoded = tokens.encode_chars(df.select(key, text), text, vocabulary, specials)
    sinks.write_tokens(encoded, os.path.join(out, "tokens"), key, "tokens")
    table = df.sparkSession.read.parquet(os.path.join(out, "tokens"))
    tokens.split_tokens(table, key, "tokens").write.mode("overwrite").partitionBy("split").parquet(os.path.join(out, "splits"))
    sinks.save_vocabulary(vocabulary, os.path.join(out, "char_tokenizer.json"), list(specials))
    splits = df.sparkSession.read.parquet(os.path.join(out, "splits"))
    return splits.groupBy("split").agg(F.sum(F.size("tokens")).alias("n_tokens"))


def prepare_chat(pairs: DataFrame, out: str, vocabulary: DataFrame | None = None) -> DataFrame:
    """Appropriate pairs as tagged chats and their tokens; gives (split, n_tokens).

    A vocabulary of the first stage is kept, the tags and the chats' new characters go after it.
    """
    rows = pairs.filter(qa.appropriate(F.col("instruction"), F.col("input"), F.col("output")) & F.col("instruction").isNotNull())
    chats = rows.select(qa.chat(F.col("instruction"), F.col("input"), F.col("output")).alias("chat"))
    chats = chats.withColumn("id", F.monotonically_increasing_id())
    chats.write.mode("overwrite").parquet(os.path.join(out, "chats"))
    written = pairs.sparkSession.read.parquet(os.path.join(out, "chats"))
    # one text, a line for each chat
    first = written.agg(F.min("id")).scalar()
    lines = written.select("id", F.when(F.col("id") == first, F.col("chat")).otherwise(F.concat(F.lit("\n"), "chat")).alias("chat"))
    return tokenize(lines, "id", "chat", out, (USER, ASSISTANT, END), vocabulary)


def record_done(done: DataFrame, path: str, on: str) -> None:
    """Append names to a manifest; readers of it leave them out next time."""
    done.select(on).withColumn("done_at", F.current_timestamp()).write.mode("append").parquet(path)


def throughput(df: DataFrame, run: str, step: str, n_tokens: str, seconds: str, steps: int) -> DataFrame:
    """(run, step, tokens per second so far, seconds left) of the logs of training runs."""
    upto = Window.partitionBy(run).orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    spent, read = F.sum(seconds).over(upto), F.sum(n_tokens).over(upto)
    return df.select(run, step, (read / spent).alias("tokens_per_s"), (spent / (F.col(step) + 1) * (F.lit(steps) - F.col(step) - 1)).alias("seconds_left"))
