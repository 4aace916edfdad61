"""Sinks: merged text, statistics, pair files, token files and tokenizer files."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kaghamar.operators.tokens import check_16_bits
from kaghamar.session import cut_lineage


def write_text(df: DataFrame, path: str, text: str = "text", order: list[str] | None = None) -> None:
    """Paragraphs with a blank line after each, ranged by `order` over the files."""
    rows = df.orderBy(*order) if order else df
    rows.select(F.col(text).alias("value")).write.mode("overwrite").option("lineSep", "\n\n").text(path)


def write_file(spark: SparkSession, path: str, content: str) -> None:
    """One small file on whatever file system the path names."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(context._jsc.hadoopConfiguration()).create(place, True)
    out.write(bytearray(content.encode("utf-8")))
    out.close()


def write_stats(stats: DataFrame, totals: DataFrame, path: str) -> None:
    """{sources, order, totals} as one JSON file; one row per source, so a handful of rows."""
    rows = [r.asDict() for r in stats.orderBy("priority").collect()]
    body = {"sources": {r["source"]: r for r in rows}, "order": [r["source"] for r in rows], "totals": totals.first().asDict()}
    write_file(stats.sparkSession, path, json.dumps(body, ensure_ascii=False, indent=2))


def write_pairs(df: DataFrame, path: str, compression: str = "gzip") -> None:
    """Pairs as compressed JSON lines."""
    df.write.mode("overwrite").option("compression", compression).json(path)


def write_pairs_array(df: DataFrame, path: str, order: list[str]) -> None:
    """Pairs as one JSON array in one file, for readers that want that; its lines are made by all tasks, and one writes them."""
    rows = df.orderBy(*order).select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"), F.monotonically_increasing_id().alias("i"))
    rows = cut_lineage(rows)  # the order is that of the ids given once
    first = rows.agg(F.min("i")).scalar()
    lines = rows.select("i", F.concat(F.when(F.col("i") == first, "[").otherwise(","), "value").alias("value"))
    end = df.sparkSession.range(1).select(F.lit((1 << 63) - 1).alias("i"), F.when(first.isNull(), "[]").otherwise("]").alias("value"))
    lines.unionByName(end).coalesce(1).sortWithinPartitions("i").select("value").write.mode("overwrite").text(path)


def _shared(folder: str) -> str:
    """The folder as tasks open it: a path that all executors mount."""
    if "://" in folder and not folder.startswith("file:"):
        raise ValueError(f"{folder} is no folder that tasks can write files in")
    path = "/" + folder.removeprefix("file:").lstrip("/") if folder.startswith("file:") else folder
    os.makedirs(path, exist_ok=True)
    return path


def write_lines(df: DataFrame, folder: str, value: str, codec: str = "zst", level: int = 12) -> DataFrame:
    """Lines as zstd or xz files, one per task, compressed as streams; (file, n_lines).

    The folder must be one that all executors share. A task writes to a name of its own attempt and renames it.
    """
    folder = _shared(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import lzma

        import zstandard
        from pyspark import TaskContext

        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}.{codec}"
        draft, count = os.path.join(folder, f".{name}.{context.taskAttemptId()}"), 0
        with open(draft, "wb") as raw, (lzma.open(raw, "wb") if codec == "xz" else zstandard.ZstdCompressor(level=level).stream_writer(raw)) as file:
            for batch in batches:
                lines = batch.column("v").drop_null().to_pylist()
                file.write("".join(x + "\n" for x in lines).encode("utf-8"))
                count += len(lines)
        os.replace(draft, os.path.join(folder, name))
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count], pa.int64())], ["file", "n_lines"])

    return cut_lineage(df.select(F.col(value).alias("v")).mapInArrow(run, "file string, n_lines long"))


def zstd_file(source: str, target: str, level: int = 12) -> None:
    """A zstd copy of one local file, as a stream."""
    import zstandard

    with open(source, "rb") as a, open(target, "wb") as b:
        zstandard.ZstdCompressor(level=level).copy_stream(a, b)


def unzstd_file(source: str, target: str) -> None:
    import zstandard

    with open(source, "rb") as a, open(target, "wb") as b:
        zstandard.ZstdDecompressor().copy_stream(a, b)


def write_tokens(df: DataFrame, path: str, key: str, tokens: str) -> None:
    """The token table, the primary sink; ids are checked against 16 bits."""
    check_16_bits(df, tokens).select(key, tokens).write.mode("overwrite").option("compression", "zstd").parquet(path)


def export_token_bins(df: DataFrame, folder: str, key: str, tokens: str) -> DataFrame:
    """Unsigned 16-bit little-endian files, one per range of keys, named in key order; (file, n_tokens) when run.

    The folder must be one that all executors share.
    A task writes to a name of its own attempt and renames it, so a repeated task leaves one file.
    """
    folder = _shared(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        from pyspark import TaskContext

        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}.bin"
        draft, count = os.path.join(folder, f".{name}.{context.taskAttemptId()}"), 0
        with open(draft, "wb") as file:
            for batch in batches:
                ids = batch.column("t").flatten().to_numpy(zero_copy_only=False)
                file.write(ids.astype("<u2").tobytes())
                count += len(ids)
        os.replace(draft, os.path.join(folder, name))
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([count], pa.int64())], ["file", "n_tokens"])

    rows = check_16_bits(df, tokens).select(F.col(key).alias("k"), F.col(tokens).alias("t"))
    return rows.repartitionByRange("k").sortWithinPartitions("k").mapInArrow(run, "file string, n_tokens long")


def save_vocabulary(vocabulary: DataFrame, path: str, specials: list[str]) -> None:
    """A character tokenizer's JSON file; bounded by Unicode."""
    rows = vocabulary.orderBy("id").collect()
    write_file(vocabulary.sparkSession, path, json.dumps({"type": "char", "chars": [r["token"] for r in rows], "special_tokens": specials}, ensure_ascii=False))


def load_vocabulary(spark, path: str) -> tuple[DataFrame, list[str]]:  # noqa: ANN001
    body = json.loads(spark.read.text(path, wholetext=True).first()[0])
    return spark.createDataFrame(list(enumerate(body["chars"])), "id int, token string").select("token", "id"), body["special_tokens"]


def tokenizer_file(folder: str) -> tuple[str, str]:
    """(kind, path) of the one tokenizer in a folder; having both kinds, or none, is an error."""
    folder = "/" + folder.removeprefix("file:").lstrip("/") if folder.startswith("file:") else folder
    found = [(kind, path) for kind, name in (("char", "char_tokenizer.json"), ("bpe", "bpe_tokenizer.json")) if os.path.exists(path := os.path.join(folder, name))]
    if len(found) != 1:
        raise FileNotFoundError(f"{len(found)} tokenizers in {folder}, one is needed")
    return found[0]


def pairs_per_file(df: DataFrame) -> DataFrame:
    """(file, n_pairs) of a DataFrame read from files."""
    return df.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n_pairs"))
