"""Character tokens, public subword models, token splits and blocks.

Tokens are arrays of ints per row; ids must fit 16 bits where a binary sink asks for it. Order over
rows comes from a key; running sums are kept per range of keys, so no task sees all rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kaghamar.functions.codepoints import flatten
from kaghamar.session import cut_lineage

VALID_SHARE = 0.1


def char_vocabulary(df: DataFrame, text: str) -> DataFrame:
    """(token, id): the distinct characters in code-point order, ids from 0.

    Characters are made distinct per row before the shuffle; the result is bounded by Unicode.
    """
    chars = df.select(F.explode(F.array_distinct(F.split(text, ""))).alias("token")).filter("token <> ''").distinct()
    return chars.withColumn("id", (F.row_number().over(Window.orderBy("token")) - 1).cast("int"))


def _codes(vocabulary: DataFrame) -> dict[str, int]:
    """The vocabulary on the driver; Unicode bounds its size, special tokens aside."""
    return {r["token"]: r["id"] for r in vocabulary.collect()}


def encode_chars(df: DataFrame, text: str, vocabulary: DataFrame, specials: tuple[str, ...] = (), out: str = "tokens") -> DataFrame:
    """`out`: ids of the characters; the longest special token first; characters without an id are dropped.

    A batch's code points go through one lookup table at once. Null texts give null.
    """
    codes = _codes(vocabulary)
    parts = re.compile("|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True))) if specials else None
    stand_in = {s: chr(0xD800 + i) for i, s in enumerate(specials)}

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids(texts: pa.Array) -> pa.Array:
        table = np.full(0x110000, -1, np.int32)
        for token, i in codes.items():
            if len(token) == 1:
                table[ord(token)] = i
        for s, c in stand_in.items():
            table[ord(c)] = codes.get(s, -1)
        if parts is None:
            points, offsets = flatten(texts)
        else:
            # each special token as one code point that no text can hold
            rows = [parts.sub(lambda m: stand_in[m[0]], t or "").encode("utf-32-le", "surrogatepass") for t in texts.to_pylist()]
            points, offsets = np.frombuffer(b"".join(rows), np.uint32), np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])])
        found = table[points]
        kept = np.concatenate([[0], np.cumsum(found >= 0)])[offsets]
        nulls = np.append(np.asarray(texts.is_null()), False)
        return pa.ListArray.from_arrays(pa.array(kept, pa.int32(), mask=nulls), pa.array(found[found >= 0]))

    return df.withColumn(out, ids(F.col(text)))


def decode_chars(df: DataFrame, tokens: str, vocabulary: DataFrame, out: str = "text") -> DataFrame:
    """`out`: the characters of the ids; unknown ids are dropped."""
    names = {i: t for t, i in _codes(vocabulary).items()}
    longer = [t for t in names.values() if len(t) > 1]
    stand_in = {t: chr(0xD800 + i) for i, t in enumerate(longer)}
    back = {ord(c): t for t, c in stand_in.items()}
    size = max(names, default=-1) + 1

    @F.arrow_udf(T.StringType())
    def text(ids: pa.Array) -> pa.Array:
        table = np.zeros(size + 1, np.uint32)
        for i, t in names.items():
            table[i] = ord(stand_in.get(t, t))
        present = np.zeros(size + 1, bool)
        present[list(names)] = True
        lengths = np.array([0 if n is None else n for n in pc.list_value_length(ids).to_pylist()], np.int64)
        flat = np.asarray(pc.fill_null(ids.flatten(), -1))
        known = np.where((flat >= 0) & (flat < size), flat, size)
        keep = present[known]
        ends = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], np.cumsum(lengths)])]
        whole = table[known[keep]].tobytes().decode("utf-32-le", "surrogatepass")
        rows = [whole[a:b].translate(back) if back else whole[a:b] for a, b in zip(ends[:-1], ends[1:])]
        return pa.array(rows, pa.string(), mask=np.asarray(ids.is_null()))

    return df.withColumn(out, text(F.col(tokens)))


def add_tokens(vocabulary: DataFrame, tokens: list[str] | DataFrame) -> DataFrame:
    """The vocabulary with new tokens after its last id, in sorted order (a list keeps its own); known ones change nothing."""
    spark = vocabulary.sparkSession
    if isinstance(tokens, DataFrame):
        new = tokens.select("token").distinct().withColumn("place", F.row_number().over(Window.orderBy("token")))
    else:
        new = spark.createDataFrame([(t, i) for i, t in enumerate(dict.fromkeys(tokens))] or [("", 0)], "token string, place int").filter("token <> ''")
    new = new.join(vocabulary.select("token"), "token", "left_anti")
    size = vocabulary.agg(F.coalesce(F.max("id"), F.lit(-1)) + 1).scalar()
    numbered = new.withColumn("r", F.row_number().over(Window.orderBy("place")))
    return vocabulary.select("token", "id").unionByName(numbered.select("token", (size + F.col("r") - 1).cast("int").alias("id")))


@lru_cache(maxsize=4)
def _piece_model(path: str):  # noqa: ANN202
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def encode_pieces(df: DataFrame, key: str, text: str, model: str, specials: tuple[str, ...] = ()) -> DataFrame:
    """(key, tokens): ids by a public piece model, per row, special tokens numbered after its vocabulary.

    The path is a parameter and the model is loaded once per worker. Null texts give null.
    """
    split = re.compile("(" + "|".join(re.escape(s) for s in sorted(specials, key=len, reverse=True)) + ")") if specials else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _piece_model(model)
        number = {s: tool.vocab_size() + i for i, s in enumerate(specials)}

        def ids(text: str | None) -> list[int] | None:
            if text is None:
                return None
            if split is None:
                return tool.encode(text)
            return [i for part in split.split(text) if part for i in ([number[part]] if part in number else tool.encode(part))]

        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array([ids(t) for t in batch.column("t").to_pylist()], pa.list_(pa.int32()))], ["k", "tokens"])

    narrow = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    return narrow.mapInArrow(run, f"k {narrow.schema['k'].dataType.simpleString()}, tokens array<int>").withColumnRenamed("k", key)


def decode_pieces(df: DataFrame, key: str, tokens: str, model: str, specials: tuple[str, ...] = ()) -> DataFrame:
    """(key, text): the texts of the ids; unknown pieces are dropped, special tokens stand verbatim."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = _piece_model(model)
        size, unknown = tool.vocab_size(), tool.unk_id()

        def text(ids: list[int] | None) -> str | None:
            if ids is None:
                return None
            out, run_of = [], []
            for i in [*ids, None]:
                if i is None or i >= size:
                    out.append(tool.decode(run_of))
                    run_of = []
                    if i is not None and i - size < len(specials):
                        out.append(specials[i - size])
                elif i != unknown:
                    run_of.append(i)
            return "".join(out)

        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array([text(t) for t in batch.column("t").to_pylist()], pa.string())], ["k", "text"])

    narrow = df.select(F.col(key).alias("k"), F.col(tokens).alias("t"))
    return narrow.mapInArrow(run, f"k {narrow.schema['k'].dataType.simpleString()}, text string").withColumnRenamed("k", key)


def with_offsets(df: DataFrame, key: str, tokens: str) -> DataFrame:
    """The rows with `_n`, their number of tokens, and `start`: how many tokens come before them in the order of unique keys.

    Only keys and numbers are ranged, into as many parts as Spark makes of them: one window runs within a part and one over the
    parts' sums. Offsets are joined back by key, so that token arrays are never sorted by a window.
    """
    n = F.coalesce(F.size(tokens), F.lit(0)).cast("long")
    narrow = df.select(key, n.alias("_n")).repartitionByRange(key).withColumn("_b", F.spark_partition_id())
    narrow = cut_lineage(narrow)  # parts stay as they are
    sums = narrow.groupBy("_b").agg(F.sum("_n").alias("_s"))
    base = sums.withColumn("_base", F.sum("_s").over(Window.orderBy("_b")) - F.col("_s")).drop("_s")
    inner = F.sum("_n").over(Window.partitionBy("_b").orderBy(key)) - F.col("_n")
    offsets = narrow.withColumn("_in", inner).join(F.broadcast(base), "_b").select(key, "_n", (F.col("_base") + F.col("_in")).alias("start"))
    return df.join(offsets, key)


def split_tokens(df: DataFrame, key: str, tokens: str, share: float = VALID_SHARE) -> DataFrame:
    """(key, split, start, tokens): the first int(N * (1 - share)) tokens are train, the rest valid; a row on the cut is divided."""
    placed = with_offsets(df, key, tokens)
    size = F.coalesce(F.size(tokens), F.lit(0)).cast("long")
    placed = placed.withColumn("_cut", df.agg(F.floor(F.sum(size) * F.lit(1 - share)).cast("long")).scalar())
    left = F.greatest(F.lit(0), F.least(F.col("_n"), F.col("_cut") - F.col("start"))).cast("int")
    train = placed.filter(left > 0).select(key, F.lit("train").alias("split"), "start", F.slice(tokens, F.lit(1), left).alias("tokens"))
    valid = placed.filter(left < F.col("_n")).select(key, F.lit("valid").alias("split"), (F.col("start") + left).alias("start"), F.slice(tokens, left + 1, (F.col("_n") - left).cast("int")).alias("tokens"))
    return train.unionByName(valid)


def context_blocks(df: DataFrame, key: str, tokens: str, width: int) -> DataFrame:
    """(block_id, tokens): the whole stream in blocks of `width` + 1 tokens that overlap by one; an incomplete last one is dropped."""
    placed = with_offsets(df, key, tokens).filter("_n > 0")
    first, last = F.greatest(F.floor((F.col("start") - 1) / width), F.lit(0)), F.floor((F.col("start") + F.col("_n") - 1) / width)
    parts = placed.select(F.col("start"), F.col("_n"), F.col(tokens).alias("t"), F.explode(F.sequence(first, last)).alias("block_id"))
    begin = F.greatest(F.col("start"), F.col("block_id") * width)
    end = F.least(F.col("start") + F.col("_n"), (F.col("block_id") + 1) * width + 1)
    parts = parts.filter(end > begin).select("block_id", begin.alias("at"), F.slice("t", (begin - F.col("start") + 1).cast("int"), (end - begin).cast("int")).alias("t"))
    blocks = parts.groupBy("block_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "t"))), lambda x: x["t"])).alias("tokens"))
    return blocks.filter(F.size("tokens") == width + 1)


def check_16_bits(df: DataFrame, tokens: str) -> DataFrame:
    """The rows, failing where an id doesn't fit an unsigned 16-bit sink."""
    bad = F.exists(tokens, lambda i: (i < 0) | (i > 65535))
    return df.withColumn(tokens, F.when(bad, F.raise_error(F.lit("a token id doesn't fit 16 bits"))).otherwise(F.col(tokens)))
