"""Records of an evaluation split that also stand, exactly or almost, in the training split.

Two records match if at most one word in `ONE_IN` of the longer has to be inserted, dropped or
replaced. Records are reduced to their distinct normalised texts first, so that copies are joined
back by id and never multiply the search. Then a partitioned suffix array finds shared spans:

* a training text of n words is cut into n // 4 + 1 segments of two to four words, one more than any
  partner may have edits, so that at least one of them stands whole in the partner (each edit spoils
  one segment at most);
* every place of an evaluation text is a suffix; suffixes are dealt out by their first words, and each
  part is a sorted array of them over all texts of the part;
* a segment bisects the array for the run of suffixes whose common prefix with it is as long as the
  segment; where the common prefix ends, so does the run. Of those the ones whose place agrees with
  the edits allowed are shared spans;
  Two texts of which one has more words that the other lacks than edits are allowed, by bit sets of a
  fixed width, share none;
* spans are merged for each pair of records; a pair whose spans cover fewer segments than its edits
  must leave whole is no match, and a bit-parallel edit distance over the words decides the rest.

Rows of the search have a fixed width and there are n of them at most for n words; words move only for
pairs that are left. What neither side's bit table of spans holds isn't moved at all. A first word
sequence that very many rows share is split in both directions, over parts of `PART_ROWS` rows a side.

Defined results: null instructions and those without a word match nothing; repeated items each have
their pairs; texts of fewer than four words match only if equal.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kaghamar.functions.codepoints import flatten, slices
from kaghamar.llm.quality import word_hashes
from kaghamar.session import small, written

ONE_IN = 5
#: Rows of one first word sequence that a part takes of either side.
PART_ROWS = 50_000
#: Bits of the table of spans, as a power of two: a bound that doesn't follow the corpus.
BITS = 22
#: Evaluation texts up to this length may have a training partner with segments of two words.
TWO_WORDS = 10
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xBF58476D1CE4E5B9)]


class _Kept(dict):
    """Code point -> itself, or nothing for punctuation, symbols and invisible signs."""

    def __missing__(self, point: int) -> int | None:
        category = unicodedata.category(chr(point))
        self[point] = None if category[0] in "PS" or category == "Cf" else point
        return self[point]


_kept = _Kept()


def normalised(text: str | None) -> str:
    """Small words without punctuation, one space apart."""
    return " ".join(text.lower().translate(_kept).split()) if text else ""


def edits_within(a: list, b: list, k: int) -> bool:
    """Whether at most k words must be inserted, dropped or replaced (bit-parallel)."""
    if abs(len(a) - len(b)) > k:
        return False
    if not a or not b:
        return max(len(a), len(b)) <= k
    peq: dict = {}
    for i, w in enumerate(a):
        peq[w] = peq.get(w, 0) | 1 << i
    size = len(a)
    full, top = (1 << size) - 1, 1 << (size - 1)
    pv, mv, score, left = full, 0, size, len(b)
    for w in b:
        eq = peq.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        score += 1 if ph & top else -1 if mh & top else 0
        left -= 1
        if score - left > k:
            return False
        ph = (ph << 1 | 1) & full
        pv = (mh << 1) & full | ~(xv | ph) & full
        mv = ph & xv
    return score <= k


def _items(df: DataFrame, key: str, text: str) -> DataFrame:
    """(item_id, digest, norm) of the items that hold a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norms = [normalised(t) for t in batch.column("t").to_pylist()]
            digests = [hashlib.blake2b(n.encode("utf-8", "surrogatepass"), digest_size=16).digest() for n in norms]
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(digests, pa.binary()), pa.array(norms, pa.string())], ["item_id", "digest", "norm"])

    narrow = df.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t")).filter("k is not null and t is not null")
    return narrow.mapInArrow(run, "item_id long, digest binary, norm string").filter("norm <> ''")


class Spans:
    """The words of a batch of normalised texts, and hashes of the spans that begin at each."""

    def __init__(self, norms: pa.Array):
        points, offsets = flatten(norms)
        rows = len(offsets) - 1
        row_of = np.repeat(np.arange(rows), np.diff(offsets))
        space = points == 32
        first = np.zeros(len(points) + 1, bool)
        first[offsets] = True
        begin = np.flatnonzero(~space & (np.append(True, space[:-1])[: len(points)] | first[:-1]))
        end = np.flatnonzero(~space & (np.append(space[1:], True)[: len(points)] | first[1:])) + 1
        self.row = row_of[begin]
        self.start = np.searchsorted(self.row, np.arange(rows + 1))
        self.size = np.diff(self.start)
        words = word_hashes(points, begin, end)
        #: The words of each text as a set of 128 bits.
        self.marks = np.zeros((2, rows), np.uint64)
        bit = (words >> np.uint64(20)) % np.uint64(128)
        for i in range(2):
            mine = bit >> np.uint64(6) == i
            np.bitwise_or.at(self.marks[i], self.row[mine], np.uint64(1) << (bit[mine] & np.uint64(63)))
        padded = np.concatenate([words, np.zeros(3, np.uint64)])
        n = len(words)
        two = self._mixed(padded[:n] * _MIX[0] ^ padded[1 : n + 1] * _MIX[1])
        #: Of the span of two words, and of three.
        self.look = {2: two ^ _MIX[0], 3: self._mixed(two ^ padded[2 : n + 2] * _MIX[2])}
        #: The fourth word.
        self.fourth = (padded[3:] >> np.uint64(32)).astype(np.int64)
        self.span = {2: self._mixed(self.look[2]), 3: self._mixed(self.look[3]), 4: self._mixed(self.look[3] ^ (self.fourth.astype(np.uint64) + np.uint64(1)) * _MIX[1])}

    @staticmethod
    def _mixed(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(31))) * _MIX[3]
        return h ^ (h >> np.uint64(29))

    def places(self) -> np.ndarray:
        return np.arange(len(self.row)) - self.start[self.row]

    def suffixes(self) -> Iterator[tuple[int, np.ndarray]]:
        """(words of the first look, word) of every suffix: by three words, in short texts also by two."""
        left = self.size[self.row] - self.places()
        yield 3, np.flatnonzero((left >= 3) & (self.size[self.row] >= 4))
        yield 2, np.flatnonzero((left >= 2) & (self.size[self.row] >= 4) & (self.size[self.row] <= TWO_WORDS))

    def segments(self) -> tuple[np.ndarray, np.ndarray]:
        """(first word, length) of the segments of every text of four words or more."""
        n = np.where(self.size >= 4, self.size, 0)
        many = np.where(n > 0, n // 4 + 1, 0)
        row = np.repeat(np.arange(len(n)), many)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        short, longer = n // np.maximum(many, 1), n % np.maximum(many, 1)
        length = short[row] + (nth < longer[row])
        return self.start[row] + nth * short[row] + np.minimum(nth, longer[row]), length


def _bucket(span: np.ndarray) -> np.ndarray:
    return (span >> np.uint64(64 - BITS)).astype(np.int64)


def _table(words: DataFrame) -> np.ndarray:
    """The bit table as bytes of 0 and 1 from (word, bits): at most 2^(BITS - 6) rows."""
    found = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[np.asarray(found.column("word"))] = np.asarray(found.column("bits")).view(np.uint64)
    return np.unpackbits(out.view(np.uint8), bitorder="little")


def _suffix_bits(texts: DataFrame) -> np.ndarray:
    """Which spans of two to four words evaluation texts hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = np.zeros(1 << BITS, np.uint8)
        for whole in batches:
            for batch in slices(whole, "norm"):
                spans = Spans(batch.column("norm"))
                for words, at in spans.suffixes():
                    have[_bucket(spans.span[words][at])] = 1
                    if words == 3:
                        have[_bucket(spans.span[4][at])] = 1
        bits = np.packbits(have, bitorder="little").view(np.int64)
        some = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(bits[some])], ["word", "bits"])

    return _table(texts.filter("in_eval").select("norm").mapInArrow(run, "word long, bits long"))


#: What both sides of the search carry beside the words of a span.
COLUMNS = ("length", "text_id", "place", "size", "mark0", "mark1")
_ROW = "look long, fourth long, span long, length int, text_id long, place int, size int, mark0 long, mark1 long"


def _rows(batch: pa.RecordBatch, spans: Spans, at: np.ndarray, look: np.ndarray, length: np.ndarray, span: np.ndarray) -> pa.RecordBatch:
    row = spans.row[at]
    columns = [look.view(np.int64), spans.fourth[at], span.view(np.int64), length.astype(np.int32), np.asarray(batch.column("text_id"))[row], (at - spans.start[row]).astype(np.int32), spans.size[row].astype(np.int32), *(m[row].view(np.int64) for m in spans.marks)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [x.split()[0] for x in _ROW.split(", ")])


def _segments(texts: DataFrame, seen: np.ndarray) -> DataFrame:
    """The segments of training texts that some evaluation text may hold."""
    shared = texts.sparkSession.sparkContext.broadcast(np.packbits(seen))  # 2^(BITS - 3) bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = np.unpackbits(shared.value)
        for whole in batches:
            for batch in slices(whole, "norm"):
                spans = Spans(batch.column("norm"))
                at, length = spans.segments()
                span = np.choose(length - 2, [spans.span[2][at], spans.span[3][at], spans.span[4][at]]) if len(at) else np.zeros(0, np.uint64)
                keep = have[_bucket(span)] > 0
                at, length, span = at[keep], length[keep], span[keep]
                yield _rows(batch, spans, at, np.where(length == 2, spans.look[2][at], spans.look[3][at]), length, span)

    return texts.filter("in_train").select("text_id", "norm").mapInArrow(run, _ROW)


def _suffixes(texts: DataFrame, seen: np.ndarray) -> DataFrame:
    """The suffixes of evaluation texts that may begin with a training text's segment."""
    shared = texts.sparkSession.sparkContext.broadcast(np.packbits(seen))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = np.unpackbits(shared.value)
        for whole in batches:
            for batch in slices(whole, "norm"):
                spans = Spans(batch.column("norm"))
                for words, at in spans.suffixes():
                    keep = have[_bucket(spans.span[words][at])] > 0
                    if words == 3:
                        keep |= have[_bucket(spans.span[4][at])] > 0
                    at = at[keep]
                    left = spans.size[spans.row[at]] - (at - spans.start[spans.row[at]])
                    yield _rows(batch, spans, at, spans.look[words][at], np.minimum(left, 4 if words == 3 else 2), spans.span[words][at])

    return texts.filter("in_eval").select("text_id", "norm").mapInArrow(run, _ROW)


def _dealt(segments: DataFrame, suffixes: DataFrame, part_rows: int) -> DataFrame:
    """Both sides with (look, i, j): a look with many rows is cut into i parts of segments and j of suffixes, and each meets each."""
    frequent = {}
    for name, rows in (("a", segments), ("b", suffixes)):
        if rows.count() > part_rows:  # told by the table's own figures; else no look can have more
            counts = rows.groupBy("look").agg(F.count("*").alias("n")).filter(F.col("n") > part_rows)
            frequent[name] = small(counts.select("look", F.ceil(F.col("n") / part_rows).cast("int").alias(name)))
    out = None
    for is_eval, rows in ((False, segments), (True, suffixes)):
        for name in ("a", "b"):
            rows = rows.join(frequent[name], "look", "left") if name in frequent else rows.withColumn(name, F.lit(1))
        a, b = F.coalesce("a", F.lit(1)), F.coalesce("b", F.lit(1))
        own, other = (b, a) if is_eval else (a, b)
        # the places of one evaluation text stay together, so that a segment meets a text in one part
        mine = F.pmod(F.xxhash64("text_id") if is_eval else F.xxhash64("text_id", "place"), own).cast("int")
        every = F.explode(F.sequence(F.lit(0), other - 1))
        i, j = (every, mine) if is_eval else (mine, every)
        rows = rows.select("look", i.alias("i"), j.alias("j"), F.lit(is_eval).alias("is_eval"), "fourth", *COLUMNS)
        out = rows if out is None else out.unionByName(rows)
    return out


class SuffixArray:
    """The suffixes of one part in the order of their words, cut to the four that a segment may have."""

    def __init__(self, rows: dict[str, np.ndarray]):
        # a suffix that ends after three words sorts before all that go on
        self.looks, group = np.unique(rows["look"], return_inverse=True)
        after = np.where(rows["length"] == 4, rows["fourth"] + 1, 0)
        order = np.lexsort((rows["place"], rows["text_id"], after, group))
        self.prefix = (group[order].astype(np.int64) << 33) | after[order]
        self.rows = {c: rows[c][order] for c in COLUMNS}

    def runs(self, look: np.ndarray, fourth: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """[low, high) of the suffixes whose common prefix with each segment is the whole segment."""
        at = np.minimum(np.searchsorted(self.looks, look), max(len(self.looks) - 1, 0))
        known = self.looks[at] == look if len(self.looks) else np.zeros(len(look), bool)
        base = at.astype(np.int64) << 33
        low = np.searchsorted(self.prefix, base + np.where(length == 4, fourth + 1, 0), "left")
        high = np.searchsorted(self.prefix, base + np.where(length == 4, fourth + 1, (1 << 33) - 1), "right")
        return np.where(known, low, 0), np.where(known, high, 0)


#: Candidates that are held at once while a run is filtered.
AT_ONCE = 1 << 20


def shared_spans(segments: dict[str, np.ndarray], suffixes: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, ...]]:
    """(train_text, eval_text, words, train words, eval words) of the spans of one part, one for a segment and a text at most."""
    array = SuffixArray(suffixes)
    there = array.rows
    low, high = array.runs(*(segments[c] for c in ("look", "fourth", "length")))
    many = high - low
    upto = np.cumsum(many)
    first = 0
    while first < len(many):
        # as many segments as fill AT_ONCE, or one with a longer run
        last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + AT_ONCE, "right")))
        for begin in range(0, int(many[first]) if last == first + 1 else 1, AT_ONCE):
            if last == first + 1:
                take = np.arange(low[first] + begin, min(low[first] + begin + AT_ONCE, high[first]))
                which = np.full(len(take), first)
            else:
                n = many[first:last]
                which = np.repeat(np.arange(first, last), n)
                take = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[which]
            p, n = segments["place"][which], segments["size"][which]
            q, e = there["place"][take], there["size"][take]
            allowed = np.maximum(n, e) // ONE_IN
            near = (np.abs(p - q) + np.abs((n - p) - (e - q)) <= allowed) & (segments["text_id"][which] != there["text_id"][take])
            which, take, allowed = which[near], take[near], allowed[near]
            mine, theirs = ([side[m][at].view(np.uint64) for m in ("mark0", "mark1")] for side, at in ((segments, which), (there, take)))
            lacking = lambda x, y: sum(np.bitwise_count(a & ~b).astype(np.int32) for a, b in zip(x, y))
            near = (lacking(mine, theirs) <= allowed) & (lacking(theirs, mine) <= allowed)
            which, take = which[near], take[near]
            if len(which):
                order = np.lexsort((there["text_id"][take], which))
                which, take = which[order], take[order]
                new = np.append(True, (which[1:] != which[:-1]) | (there["text_id"][take[1:]] != there["text_id"][take[:-1]]))
                which, take = which[new], take[new]
                yield segments["text_id"][which], there["text_id"][take], segments["length"][which], segments["size"][which], there["size"][take]
        first = last


def _search(dealt: DataFrame) -> DataFrame:
    """(train_text, eval_text, words, train_words, eval_words): the shared spans of every part."""
    names = ["train_text", "eval_text", "words", "train_words", "eval_words"]
    columns = ("look", "fourth", *COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0

        def settle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            is_eval = rows.column("is_eval").to_numpy()
            # the parts of one look never meet: what tells them apart goes into the look
            look = rows.column("look").to_numpy() ^ (rows.column("i").to_numpy().astype(np.int64) << 40) ^ (rows.column("j").to_numpy().astype(np.int64) << 16)
            sides = []
            for side in (~is_eval, is_eval):
                sides.append({c: (look if c == "look" else rows.column(c).to_numpy())[side] for c in columns})
            if len(sides[0]["look"]) and len(sides[1]["look"]):
                for found in shared_spans(*sides):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names)

        def ends(batch: pa.RecordBatch) -> tuple:
            return tuple(batch.column(c)[batch.num_rows - 1].as_py() for c in ("look", "i", "j"))

        for batch in batches:
            if not batch.num_rows:
                continue
            # rows come sorted by part: settle what is complete once enough of it is held
            if count >= 200_000:
                last = ends(held[-1])
                same = np.ones(batch.num_rows, bool)
                for c, v in zip(("look", "i", "j"), last):
                    same &= batch.column(c).to_numpy() == v
                rest = int(same.argmin()) if not same.all() else batch.num_rows
                held.append(batch.slice(0, rest))
                if rest < batch.num_rows:
                    yield from settle(pa.Table.from_batches(held))
                    held, count = [batch.slice(rest)], batch.num_rows - rest
                continue
            held.append(batch)
            count += batch.num_rows
        if held:
            yield from settle(pa.Table.from_batches(held))

    sorted_rows = dealt.repartition("look", "i", "j").sortWithinPartitions("look", "i", "j")
    return sorted_rows.mapInArrow(run, "train_text long, eval_text long, words int, train_words int, eval_words int")


def _exact(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose texts match word by word, with the share of the longer one's words that shared spans cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                x, y = a.split(" "), b.split(" ")
                keep.append(edits_within(x, y, max(len(x), len(y)) // ONE_IN))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["train_text", "eval_text", "coverage"])

    sides = [texts.select(F.col("text_id").alias(i), F.col("norm").alias(c)) for i, c in (("train_text", "a"), ("eval_text", "b"))]
    joined = pairs.join(sides[0], "train_text").join(sides[1], "eval_text").select("train_text", "eval_text", "coverage", "a", "b")
    return joined.mapInArrow(run, "train_text long, eval_text long, coverage double")


def overlaps(train: DataFrame, evaluation: DataFrame, key: str = "item_id", text: str = "instruction", part_rows: int = PART_ROWS) -> DataFrame:
    """(train_id, eval_id, exact, coverage): every pair of a training and an evaluation record that match.

    coverage is the share of the longer text's words in the segments that stand whole in both.
    """
    items = written(_items(train, key, text).withColumn("is_eval", F.lit(False)).unionByName(_items(evaluation, key, text).withColumn("is_eval", F.lit(True))))
    texts = items.groupBy("digest", "norm").agg(F.min("item_id").alias("text_id"), F.max("is_eval").alias("in_eval"), (~F.min("is_eval")).alias("in_train"))
    texts = written(texts)
    segments = written(_segments(texts, _suffix_bits(texts)))
    bucket = f"shiftrightunsigned(span, {64 - BITS})"
    suffixes = written(_suffixes(texts, _table(segments.selectExpr(f"{bucket} >> 6 AS word", f"shiftleft(1L, cast({bucket} & 63 AS int)) AS bits"))))
    spans = _search(_dealt(segments, suffixes, part_rows))
    merged = spans.groupBy("train_text", "eval_text").agg(
        F.count("*").alias("whole"), F.sum("words").alias("words"), F.first("train_words").alias("n"), F.first("eval_words").alias("e")
    )
    longer = F.greatest("n", "e")
    needed = F.floor(F.col("n") / 4) + 1 - F.floor(longer / ONE_IN)
    pairs = merged.filter(F.col("whole") >= needed).select("train_text", "eval_text", F.least(F.col("words") / longer, F.lit(1.0)).alias("coverage"))
    same = texts.filter("in_eval and in_train").select(F.col("text_id").alias("train_text"), F.col("text_id").alias("eval_text"), F.lit(1.0).alias("coverage"))
    found = _exact(pairs, texts).withColumn("exact", F.lit(False)).unionByName(same.withColumn("exact", F.lit(True)))
    member = items.select("item_id", "is_eval", "digest").join(texts.select("digest", "text_id"), "digest").select("item_id", "is_eval", "text_id")
    t = member.filter(~F.col("is_eval")).select(F.col("text_id").alias("train_text"), F.col("item_id").alias("train_id"))
    e = member.filter("is_eval").select(F.col("text_id").alias("eval_text"), F.col("item_id").alias("eval_id"))
    return found.join(t, "train_text").join(e, "eval_text").select("train_id", "eval_id", "exact", "coverage")


def overlap_report(pairs: DataFrame, train: DataFrame, evaluation: DataFrame, key: str = "item_id", source: str = "source") -> DataFrame:
    """(split, source, n_rows, n_overlapping, mean_coverage): how many of each split's and source's records have a match.

    mean_coverage is over the overlapping records, each by its best partner; null where none overlaps.
    """

    def side(df: DataFrame, split: str, ids: str) -> DataFrame:
        hit = pairs.groupBy(F.col(ids).alias("id")).agg(F.max("coverage").alias("hit"))
        rows = df.select(F.col(key).cast("long").alias("id"), F.col(source).alias("source")).join(hit, "id", "left")
        return rows.groupBy("source").agg(F.count("*").alias("n_rows"), F.count("hit").alias("n_overlapping"), F.avg("hit").alias("mean_coverage")).select(F.lit(split).alias("split"), "source", "n_rows", "n_overlapping", "mean_coverage")

    return side(train, "train", "train_id").unionByName(side(evaluation, "eval", "eval_id"))
