"""Copies hidden by formatting: skip-and-fold rolling hashes, checked by two-pointer comparison.

Every character goes through one table that says which folded letters or digits it stands for, if
any. Row hashes are two polynomials over those, read straight off the character stream, so no
canonical string is built. Rows whose hashes collide are compared with the group's first row by two
pointers that skip what the table skips.

Defined results: nulls and texts without a letter or digit are no records; identical rows are
copies; a JSON record is compared field by field at every depth, whatever the order of the fields
(the last of repeated field names holds); broken JSON is no record.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from decimal import Decimal
from functools import lru_cache
from itertools import zip_longest
from json.decoder import scanstring

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kaghamar.functions.codepoints import flatten, slices
from kaghamar.session import cut_lineage, small

#: Odd multipliers of the two polynomials, and what letters are turned into before they enter one.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
SPREAD = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
MASK = (1 << 64) - 1
#: Rows of a group of copies that one salt takes.
SALT_ROWS = 50_000


def folded(char: str) -> str:
    """The letters and digits that a character stands for, letter case aside."""
    return "".join(c for c in char.casefold() if unicodedata.category(c)[0] == "L" or unicodedata.category(c) == "Nd")


@lru_cache(maxsize=1)
def fold_table() -> tuple[np.ndarray, np.ndarray]:
    """(letters[3, n], number of letters[n]) of each code point below 0x20000; above, a point is a letter itself if it is one."""
    size = 0x20000
    letters, count = np.zeros((3, size), np.uint32), np.zeros(size, np.uint8)
    for point in range(size):
        if found := folded(chr(point)):
            count[point] = len(found)
            for i, c in enumerate(found[:3]):
                letters[i, point] = ord(c)
    return letters, count


def lookup(points: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    letters, count = fold_table()
    low = np.minimum(points, 0x1FFFF)
    kept = count[low]
    folds = [letters[i][low] for i in range(3)]
    if (high := points >= 0x20000).any():
        kept = np.where(high, points < 0xE0000, kept).astype(np.uint8)
        folds[0] = np.where(high, points, folds[0])
    return folds, kept


_powers = {base: np.ones(1, np.uint64) for base in BASES}


def powers(base: int, upto: int) -> np.ndarray:
    have = _powers[base]
    if len(have) <= upto:
        have = np.full(max(upto + 1, 2 * len(have)), base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have


def rolling_hashes(points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, hash, letters and digits) of each row of a flat code-point array."""
    folds, kept = lookup(points)
    upto = np.concatenate([[0], np.cumsum(kept, dtype=np.int64)])
    total = upto[offsets[1:]] - upto[offsets[:-1]]
    place = upto[:-1] - np.repeat(upto[offsets[:-1]], np.diff(offsets))
    most, out = int(total.max(initial=0)) + 3, []
    for base, spread in zip(BASES, SPREAD):
        value, power = np.zeros(len(points), np.uint64), powers(base, most)
        for i in range(3):
            if i == 0 or (kept > i).any():
                mixed = (folds[i].astype(np.uint64) + np.uint64(1)) * np.uint64(spread)
                mixed ^= mixed >> np.uint64(29)
                value += np.where(kept > i, mixed * power[place + i], np.uint64(0))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
        h = sums[offsets[1:]] - sums[offsets[:-1]]
        h = (h ^ (h >> np.uint64(31))) * np.uint64(spread)
        out.append((h ^ (h >> np.uint64(27)) ^ total.astype(np.uint64)).view(np.int64))
    return out[0], out[1], total


def same_letters(a: str, b: str) -> bool:
    """Two-pointer comparison that skips all but letters and digits."""
    if a == b:
        return True
    stream = lambda s: (c for x in s for c in fold_one(x))
    return all(x == y for x, y in zip_longest(stream(a), stream(b)))


fold_one = lru_cache(maxsize=1 << 16)(folded)


def _no_constant(_: str) -> None:
    raise ValueError("no JSON value")


def parse(chunk: str | None) -> object:
    """The JSON value; ValueError if there is none."""
    if chunk is None:
        raise ValueError("null")
    try:
        return json.loads(chunk, parse_constant=_no_constant, parse_float=Decimal)
    except RecursionError:
        return parse_deep(chunk)


_BLANKS = re.compile(r"[ \t\n\r]*")
_SCALAR = re.compile(r"[^\s\[\]{},:\"]+")


def parse_deep(chunk: str) -> object:
    """What `parse` returns, with a stack of its own, for values nested deeper than `json` can read."""
    at, size = 0, len(chunk)
    stack: list[tuple[object, str | None]] = []  # open holders, each with the name of the field being read
    top: list[object] = []
    while True:
        # a value
        at = _BLANKS.match(chunk, at).end()
        c = chunk[at : at + 1]
        if c and c in "[{":
            value: object = [] if c == "[" else {}
            at = _BLANKS.match(chunk, at + 1).end()
            if chunk[at : at + 1] == ("]" if c == "[" else "}"):
                at += 1
            else:
                name = None
                if c == "{":
                    name, at = _field_name(chunk, at)
                stack.append((value, name))
                continue
        elif c == '"':
            value, at = scanstring(chunk, at + 1, True)
        elif m := _SCALAR.match(chunk, at):
            value, at = json.loads(m[0], parse_constant=_no_constant, parse_float=Decimal), m.end()
        else:
            raise ValueError("no JSON value")
        # what it ends
        while True:
            holder, name = stack[-1] if stack else (top, None)
            if isinstance(holder, dict):
                holder[name] = value
            else:
                holder.append(value)
            at = _BLANKS.match(chunk, at).end()
            if not stack:
                if at < size:
                    raise ValueError("more than one value")
                return top[0]
            c = chunk[at : at + 1]
            at += 1
            if c == ",":
                if isinstance(holder, dict):
                    name, at = _field_name(chunk, _BLANKS.match(chunk, at).end())
                    stack[-1] = (holder, name)
                break
            if c != ("}" if isinstance(holder, dict) else "]"):
                raise ValueError("a holder isn't closed")
            value = stack.pop()[0]


def _field_name(chunk: str, at: int) -> tuple[str, int]:
    """The name at this place, and the place behind its colon."""
    if chunk[at : at + 1] != '"':
        raise ValueError("no field name")
    name, at = scanstring(chunk, at + 1, True)
    at = _BLANKS.match(chunk, at).end()
    if chunk[at : at + 1] != ":":
        raise ValueError("no colon")
    return name, at + 1


def same_json(a: object, b: object) -> bool:
    """Whether two JSON values are the same record; with a stack of its own, whatever their depth."""
    stack = [(a, b)]
    while stack:
        a, b = stack.pop()
        if isinstance(a, str) and isinstance(b, str):
            same = same_letters(a, b)
        elif isinstance(a, dict) and isinstance(b, dict):
            same = a.keys() == b.keys()
            stack += [(v, b[k]) for k, v in a.items()] if same else []
        elif isinstance(a, list) and isinstance(b, list):
            same = len(a) == len(b)
            stack += zip(a, b)
        elif isinstance(a, bool) or isinstance(b, bool) or a is None or b is None:
            same = a is b
        else:
            same = isinstance(a, (int, Decimal)) and isinstance(b, (int, Decimal)) and a == b
        if not same:
            return False
    return True


def _mix(*parts: int) -> int:
    h = 0x243F6A8885A308D3
    for p in parts:
        h = ((h ^ (p & MASK)) * 0x9E3779B97F4A7C15) & MASK
        h ^= h >> 32
    return h


def _key_hash(text: str, seed: int) -> int:
    h = seed
    for c in text.encode("utf-8", "surrogatepass"):
        h = ((h ^ c) * 0x100000001B3) & MASK
    return h


_cached_key = lru_cache(maxsize=1 << 14)(_key_hash)


def json_hashes(values: list[object]) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each JSON value; fields add up, so that their order doesn't count."""
    # every value after those it holds, and each record's values in one run
    order: list[object] = []
    for v in values:
        stack = [v]
        begin = len(order)
        while stack:
            v = stack.pop()
            order.append(v)
            if isinstance(v, dict):
                stack += v.values()
            elif isinstance(v, list):
                stack += v
        order[begin:] = order[begin:][::-1]
    leaves = [v for v in order if isinstance(v, str)]
    points, offsets = flatten(pa.array([x.encode("utf-8", "replace").decode() for x in leaves], pa.string()))
    first, second, _ = rolling_hashes(points, offsets)
    out = []
    for hashes, seed in ((first, 1), (second, 2)):
        rest = iter(hashes.tolist())

        done: list[int] = []  # hashes of values whose holder is still to come
        for v in order:
            if isinstance(v, str):
                h = _mix(seed, 3, next(rest))
            elif isinstance(v, (dict, list)):
                held = done[len(done) - len(v) :]
                del done[len(done) - len(v) :]
                if isinstance(v, dict):
                    h = _mix(seed, 5, len(v), sum([_mix(_cached_key(k, seed), x) for k, x in zip(v, held)]))
                else:
                    h = _mix(seed, 7, len(v), *held)
            elif v is None or isinstance(v, bool):
                h = _mix(seed, 11, {None: 0, False: 1, True: 2}[v])
            else:
                h = _mix(seed, 13, hash(v))  # equal numbers hash alike
            done.append(h)
        out.append(np.array(done, np.uint64).view(np.int64))
    return out[0], out[1]


def _hashes(df: DataFrame, as_json: bool) -> DataFrame:
    """(id, h1, h2) of the rows of (id, t) that are records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "t"):
                if not as_json:
                    first, second, total = rolling_hashes(*flatten(batch.column("t")))
                    keep = np.flatnonzero(total)
                else:
                    values, keep = [], []
                    texts = batch.column("t").to_pylist()
                    has_letter = rolling_hashes(*flatten(batch.column("t")))[2] > 0
                    for i, t in enumerate(texts):
                        if has_letter[i]:
                            try:
                                values.append(parse(t))
                                keep.append(i)
                            except ValueError:
                                pass
                    first, second = json_hashes(values)
                    keep = np.array(keep, np.int64)
                if not as_json:
                    first, second = first[keep], second[keep]
                yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(keep)), pa.array(first), pa.array(second)], ["id", "h1", "h2"])

    return df.mapInArrow(run, "id long, h1 long, h2 long")


def _verified(pairs: DataFrame, as_json: bool) -> DataFrame:
    """The (first_id, copy_id) whose texts are the same record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            same = [x == y or (same_json(parse(x), parse(y)) if as_json else same_letters(x, y)) for x, y in zip(a, b)]
            yield batch.filter(pa.array(same, pa.bool_())).select(["first_id", "copy_id"])

    return pairs.mapInArrow(run, "first_id long, copy_id long")


def formatting_copies(df: DataFrame, key: str, text: str, as_json: bool = False, salt_rows: int = SALT_ROWS) -> DataFrame:
    """(first_id, copy_id): each copy and the smallest id of its record.

    Hashes are grouped before any text moves; only texts of colliding rows are shuffled. A group and
    its first text are repeated once per `salt_rows` rows, over which its copies are spread.
    """
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("t")).filter("id is not null and t is not null")
    hashes = cut_lineage(_hashes(rows, as_json))  # 24 bytes a row, read twice; each text is hashed once
    groups = hashes.groupBy("h1", "h2").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count("*").alias("n")).filter("n > 1")
    groups = cut_lineage(groups.select("h1", "h2", "first_id", (F.lit(1) + F.col("n") / salt_rows).cast("int").alias("salts")))
    # a row learns the salts of its group, if it is a large one, before rows and groups are brought together
    large = small(groups.filter("salts > 1").select("h1", "h2", F.col("salts").alias("of")))
    salted = hashes.join(large, ["h1", "h2"], "left").withColumn("salt", F.pmod(F.xxhash64("id"), F.coalesce("of", F.lit(1))).cast("int"))
    every = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    members = salted.join(every, ["h1", "h2", "salt"]).filter("id <> first_id").select("first_id", F.col("id").alias("copy_id"), "salt")
    copies = members.join(rows.select(F.col("id").alias("copy_id"), F.col("t").alias("b")), "copy_id")
    firsts = groups.select("first_id", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    firsts = firsts.join(rows.select(F.col("id").alias("first_id"), F.col("t").alias("a")), "first_id")
    return _verified(copies.join(firsts, ["first_id", "salt"]).select("first_id", "copy_id", "a", "b"), as_json)


def collapse(df: DataFrame, key: str, text: str, as_json: bool = False) -> DataFrame:
    """(key, copies): one row per record, by its smallest id, with its number of rows."""
    pairs = formatting_copies(df, key, text, as_json)
    counts = pairs.groupBy("first_id").agg(F.count("*").alias("more"))
    rows = df.select(F.col(key).cast("long").alias("first_id")).filter("first_id is not null")
    kept = rows.join(pairs.select(F.col("copy_id").alias("first_id")), "first_id", "left_anti")
    return kept.join(counts, "first_id", "left").select(F.col("first_id").alias(key), (F.coalesce("more", F.lit(0)) + 1).alias("copies"))
