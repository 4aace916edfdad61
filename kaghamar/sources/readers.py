"""Readers of local copies of the corpus formats; each gives (source, pos?, text) or raw records.

Formats that Spark splits are read by Spark; xz and zstd, which it may lack, are decoded file by file as streams, in
Arrow batches; token files by ranges of bytes. pos orders the texts of a source: file name, place of the split in the file, row in it.
"""

from __future__ import annotations

import io
import lzma
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kaghamar.functions.text import is_redirect, strip, strip_legal_html, strip_wiki_markup
from kaghamar.operators.corpus import first_reason

PAGE = "ns string, title string, revision struct<text: struct<_VALUE: string, _xml_space: string>>"


def ordered(df: DataFrame) -> DataFrame:
    """The rows with `pos`, increasing in file order."""
    place = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"))
    return df.withColumn("pos", F.struct(place.alias("p"), F.monotonically_increasing_id().alias("i")))


def wiki_pages(spark: SparkSession, path: str) -> DataFrame:
    """(ns, raw) of a MediaWiki export, compressed or not; a namespace that is no number counts as none."""
    pages = spark.read.format("xml").option("rowTag", "page").schema(PAGE).load(path)
    return pages.select(F.expr("try_cast(ns as int)").alias("ns"), F.coalesce(F.col("revision.text._VALUE"), F.lit("")).alias("raw"))


def wiki_reason(ns: Column, raw: Column, clean: Column, raw_least: int = 200, clean_over: int = 100) -> Column:
    """Why a page is skipped: ns, empty, redirect, short or kept; the first that holds."""
    return first_reason([
        ("ns", F.coalesce(ns, F.lit(-1)) != 0), ("empty", F.coalesce(raw, F.lit("")) == ""), ("redirect", is_redirect(raw)),
        ("short", (F.length(raw) < raw_least) | (F.length(clean) <= clean_over)),
    ])


def wiki_articles(spark: SparkSession, path: str, source: str) -> DataFrame:
    """(source, text) of the articles that stay."""
    pages = wiki_pages(spark, path).withColumn("text", strip_wiki_markup(F.col("raw")))
    kept = pages.filter(wiki_reason(F.col("ns"), F.col("raw"), F.col("text")) == "kept")
    return kept.select(F.lit(source).alias("source"), "text")


def _file_system(path: str):  # noqa: ANN202
    """(file system, path in it) of a path as Spark names it; files are read as streams, so none is too large for a cell."""
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def _opened(path: str):  # noqa: ANN202
    """A text stream over an xz, zstd or plain file, with every kind of line end as \\n."""
    system, name = _file_system(path)
    source = system.open_input_stream(name, compression=None)
    if name.endswith((".zst", ".zstd")):
        import zstandard

        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(source, read_across_frames=True), "utf-8", "ignore")
    if name.endswith(".xz"):
        return lzma.open(source, "rt", encoding="utf-8", errors="ignore")
    return io.TextIOWrapper(source, "utf-8", "ignore")


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the files, one task for each while there are cores; their contents aren't read."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    return files.repartition(max(1, min(files.count(), 10_000)), "path")


def _decoded(spark: SparkSession, path: str, schema: str, rows_of: Callable[[str], Iterator[tuple]]) -> DataFrame:
    """Rows of each file, in batches of at most 10,000 rows or about 8 million characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in schema.split(", ")]
        for batch in batches:
            for name in batch.column("path").to_pylist():
                rows, size = [], 0
                for row in rows_of(name):
                    rows.append(row)
                    size += len(row[2])
                    if len(rows) == 10_000 or size > 8_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names)

    return _files(spark, path).select("path").mapInArrow(run, schema)


def decoded_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_no, value) of files in codecs that Spark may lack, decoded as streams in bounded batches."""

    def rows_of(name: str) -> Iterator[tuple]:
        with _opened(name) as lines:
            for i, line in enumerate(lines):
                yield name, i, line.removesuffix("\n")

    return _decoded(spark, path, "path string, line_no long, value string", rows_of)


def decoded_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, doc_no, text, at_end): runs of lines between blank ones; at_end where the file ends without a blank line."""

    def rows_of(name: str) -> Iterator[tuple]:
        with _opened(name) as lines:
            held: list[str] = []
            number = 0
            for line in lines:
                if line.strip():
                    held.append(line)
                elif held:
                    yield name, number, "".join(held).removesuffix("\n"), False
                    held, number = [], number + 1
            if held:
                yield name, number, "".join(held).removesuffix("\n"), True

    return _decoded(spark, path, "path string, doc_no long, text string, at_end boolean", rows_of)


def json_texts(lines: DataFrame, value: str = "value", field: str = "text", least: int = 50) -> DataFrame:
    """(text): the field of each line that is a JSON object, stripped, of `least` characters or more.

    Blank and malformed lines and those without the field are skipped.
    """
    record = F.from_json(F.col(value), f"`{field}` string", {"mode": "PERMISSIVE"})
    text = strip(record[field])
    return lines.select(text.alias("text")).filter(F.col("text").isNotNull() & (F.length("text") >= least))


def legal_texts(lines: DataFrame, value: str = "value", key: str | None = None, least: int = 100) -> DataFrame:
    """(key?, part, text): of each JSON record with a long enough body, its title, if any, then the body."""
    record = F.from_json(F.col(value), "title string, body string", {"mode": "PERMISSIVE"})
    keys = [F.col(key)] if key else []
    rows = lines.select(*keys, strip(F.coalesce(record["title"], F.lit(""))).alias("title"), strip_legal_html(F.coalesce(record["body"], F.lit(""))).alias("body"))
    parts = F.filter(F.array("title", "body"), lambda x: x != "")
    return rows.filter(F.length("body") >= least).select(*keys, F.posexplode(parts).alias("part", "text"))


def records(df: DataFrame, text: str, least: int = 50, only: dict[str, str] | None = None, *carry: str) -> DataFrame:
    """(*carry, text): stripped texts of rows that equal `only`; filters and columns reach the scan."""
    for column, value in (only or {}).items():
        df = df.filter(F.col(column) == value)
    return df.select(*carry, strip(F.col(text)).alias("text")).filter(F.length("text") >= least)


def bitext_side(df: DataFrame, lang: str, least: int = 5) -> DataFrame:
    """(text): distinct lines of one language on either side of a bitext."""
    sides = F.array(F.struct(F.col("src_lang").alias("lang"), F.col("src_text").alias("text")), F.struct(F.col("tgt_lang").alias("lang"), F.col("tgt_text").alias("text")))
    rows = df.select(F.explode(sides).alias("s")).filter(F.col("s.lang") == lang).select(strip(F.col("s.text")).alias("text"))
    return rows.filter(F.length("text") >= least).distinct()


def shards(files: DataFrame, done: DataFrame, name: str = "name", prefixes: tuple[str, ...] = ("2023_", "2024_"), suffix: str = ".parquet") -> DataFrame:
    """Names that begin and end as told and are not done yet; a failed shard is not done."""
    begins = F.lit(False)
    for p in prefixes:
        begins = begins | F.col(name).startswith(p)
    return files.filter(begins & F.col(name).endswith(suffix)).join(done.select(name).distinct(), name, "left_anti")


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of files that each hold one JSON array, with their place in it."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.from_json("value", f"array<struct<{schema}>>")).alias("pos", "r")).select("pos", "r.*")


#: Tokens of one row of a token file, and rows that one task reads.
BLOCK_TOKENS, TASK_BLOCKS = 1 << 20, 32


def token_bins(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS, where: str = "true") -> DataFrame:
    """(path, block, tokens): unsigned 16-bit little-endian token files of any size, by ranges of bytes.

    `where` is a condition on path and block; only the blocks that meet it are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for name, block in zip(batch.column("path").to_pylist(), batch.column("block").to_pylist()):
                system, place = _file_system(name)
                with system.open_input_file(place) as file:
                    content = file.read_at(2 * block_tokens, 2 * block_tokens * block)
                part = pa.array(np.frombuffer(content[: len(content) // 2 * 2], "<u2").astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([block], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part)], ["path", "block", "tokens"])

    files = spark.read.format("binaryFile").load(path).filter("length > 1").select("path", "length")
    last = F.ceil(F.floor(F.col("length") / 2) / block_tokens).cast("int") - 1
    ranges = files.select("path", F.explode(F.sequence(F.lit(0), last)).alias("block")).filter(where)
    ranges = ranges.withColumn("task", F.floor(F.col("block") / TASK_BLOCKS)).repartition("path", "task")
    return ranges.select("path", "block").mapInArrow(run, "path string, block int, tokens array<int>")


def first_split(spark: SparkSession, folder: str, order: tuple[str, ...] = ("train", "validation", "test")) -> DataFrame:
    """The rows of the first split of a data set: the first subfolder of the order that is there, else the first by name."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(folder)
    names = sorted(s.getPath().getName() for s in place.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(place) if s.isDirectory())
    if not names:
        raise FileNotFoundError(f"no split in {folder}")
    return spark.read.parquet(f"{folder}/{next((n for n in order if n in names), names[0])}")


#: Readers by source, each (spark, path) -> DataFrame with `text`; add to it to add a source.
REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "wiki": lambda s, p: wiki_articles(s, p, "wiki"),
    "wikisource": lambda s, p: wiki_articles(s, p, "wikisource"),
    "wiktionary": lambda s, p: wiki_articles(s, p, "wiktionary"),
    "wikiquote": lambda s, p: wiki_articles(s, p, "wikiquote"),
    "arlis": lambda s, p: legal_texts(decoded_lines(s, p)).select("text"),
    "cc100": lambda s, p: decoded_documents(s, p).select("text", "at_end"),
    "hplt3": lambda s, p: json_texts(decoded_lines(s, p) if p.endswith((".zst", ".zstd", ".xz")) else s.read.text(p)),
    "ccnews": lambda s, p: records(s.read.parquet(p), "plain_text", 50, {"language": "hy"}),
    "opensubtitles": lambda s, p: bitext_side(s.read.parquet(p), "hy"),
    "culturax": lambda s, p: records(s.read.parquet(p), "text"),
    "mc4": lambda s, p: records(s.read.parquet(p), "text"),
    "glot500": lambda s, p: records(s.read.parquet(p), "text"),
    "finetranslations": lambda s, p: records(s.read.parquet(p), "og_full_text"),
}


def load_sources(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(source, text, at_end): the union of the named sources, each by its reader.

    at_end tells the text that ends a raw text file without a blank line; the other formats end every text with one.
    """
    out = None
    for name, path in paths.items():
        rows = REGISTRY[name](spark, path)
        end = F.col("at_end") if "at_end" in rows.columns else F.lit(False)
        rows = rows.select(F.lit(name).alias("source"), "text", end.alias("at_end"))
        out = rows if out is None else out.unionByName(rows)
    return out
