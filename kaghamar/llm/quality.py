"""Per-paragraph statistics of form and the structural kind they show.

Every text becomes five small distributions: character classes, word classes (function words,
numbers, single letters, words seen before ...), word lengths, lengths of the phrases between marks,
and line shapes. Each block is compared by Jensen-Shannon divergence with the profiles of prose in
several languages and of the forms that lists, tables and junk take; the nearest profile names the
kind. All of it is computed over a batch's flat code points in numpy.

Defined results: null and blank texts have zero counts and the kind null; a text shorter than
`MIN_CHARS` characters is no case of list, table or junk, so its kind is `short`.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kaghamar.functions.codepoints import flatten, slices
from kaghamar.llm.quality_seeds import FUNCTION_WORDS, seeds

MIN_CHARS = 50
KINDS = ("prose", "list", "table", "junk")

(LOWER, UPPER, LATIN1, DIGIT, SPACE, NEWLINE, TAB, STOP, COMMA, CELL, INLINE, BRACKET, DASH, CODE, BROKEN, MARK, LEADER, WIDE, SKIP) = range(19)
CLASSES = 19
STOPS, COMMAS, CELLS, INLINES, DASHES = ".!?։…؟。:", ",،՝`", "|;؛", "•>#/\\·→▪●◦<", "-–—‐‒―"
BLOCKS = {"chars": CLASSES, "words": 8, "lengths": 8, "phrases": 6, "lines": 8}
#: How much each block's divergence counts.
WEIGHTS = {"chars": 1.6, "words": 1.5, "lengths": 0.6, "phrases": 1.0, "lines": 1.0}
_CODE_SIGNS = "{}=_*&^%$@~+§"


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """The character class of each code point below 0x20000."""
    table = np.full(0x20000, MARK, np.uint8)
    for point in range(0x20000):
        c = chr(point)
        cat = unicodedata.category(c)
        if cat[0] == "L":
            table[point] = UPPER if cat in ("Lu", "Lt") else LOWER
        elif cat[0] == "N":
            table[point] = DIGIT
        elif cat == "Cf" or cat[0] == "M":
            table[point] = SKIP
        elif cat[0] == "Z":
            table[point] = SPACE
        elif cat in ("Cc", "Cn", "Cs", "Co"):
            table[point] = BROKEN
        elif cat in ("Pi", "Pf", "Ps", "Pe"):
            table[point] = BRACKET
    for c in map(chr, range(0xC0, 0x250)):
        if table[ord(c)] in (LOWER, UPPER):
            table[ord(c)] = LATIN1
    for point in [*range(0x2500, 0x25A0), 0xFFFD, *range(0x80, 0xA0), *range(0xA1, 0xAB), *range(0xAC, 0xB7), *range(0xB8, 0xBB), *range(0xBC, 0xC0)]:
        table[point] = BROKEN
    table[0xAD] = SKIP
    for chars, cls in ((" ", SPACE), ("\t", TAB), ("\n", NEWLINE), ("\r", SKIP), (STOPS, STOP), (COMMAS, COMMA), (CELLS, CELL), ("՛՞՜՚'’‘", SKIP), (INLINES, INLINE), ("()[]\"“”„«»", BRACKET), (DASHES, DASH), (_CODE_SIGNS, CODE)):
        for c in chars:
            table[ord(c)] = cls
    return table


VOWELS = np.frombuffer("aeiouy".encode("utf-32-le"), np.uint32)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_STEP, _BACK = 0x100000001B3, pow(0x100000001B3, -1, 1 << 64)
_steps: dict[int, np.ndarray] = {}


def step_powers(step: int, upto: int) -> np.ndarray:
    have = _steps.get(step, np.ones(1, np.uint64))
    if len(have) <= upto:
        have = np.full(max(upto + 1, 2 * len(have)), step, np.uint64)
        have[0] = 1
        _steps[step] = have = np.multiply.accumulate(have)
    return have


def word_hashes(points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of code points; equal spans hash alike wherever they stand."""
    mixed = (points.astype(np.uint64) + np.uint64(1)) * _SPREAD
    mixed ^= mixed >> np.uint64(32)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * step_powers(_STEP, len(points))[: len(points)], dtype=np.uint64)])
    h = (sums[end] - sums[begin]) * step_powers(_BACK, len(points))[begin]
    return h ^ (h >> np.uint64(29))


@lru_cache(maxsize=1)
def lower_table() -> np.ndarray:
    table = np.arange(0x20000, dtype=np.uint32)
    for point in range(0x20000):
        low = chr(point).lower()
        if len(low) == 1:
            table[point] = ord(low)
    return table


def _span_hash(words: list[str], size: int) -> np.ndarray:
    joined = "".join(words)
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(w) for w in words])
    return word_hashes(points, np.concatenate([[0], ends[:-1]]), ends)


class Figures:
    """Counts and distributions of a batch of texts, as arrays over its rows."""

    def __init__(self, points: np.ndarray, offsets: np.ndarray):
        rows = self.rows = len(offsets) - 1
        self.chars = np.diff(offsets)
        low = np.minimum(points, 0x1FFFF)
        cls = class_table()[low]
        # what is neither seen nor counted goes first: CR, joiners, combining marks, marks written inside words
        shown = cls != SKIP
        self.hidden = np.bincount(np.repeat(np.arange(rows), self.chars)[~shown], minlength=rows) if not shown.all() else np.zeros(rows, np.int64)
        if not shown.all():
            kept = np.concatenate([[0], np.cumsum(shown)])
            offsets, cls, low = kept[offsets], cls[shown], low[shown]
        size = len(cls)
        row_of = np.repeat(np.arange(rows, dtype=np.int32), np.diff(offsets))
        # a capital counts as one only inside a word, after a small letter: upper case and title case are no form
        upper = cls == UPPER
        if upper.any():
            upper[1:] &= cls[:-1] != LOWER
            cls[upper] = LOWER
        # » parts entries where it closes no quotation
        close = low == 0xBB
        if close.any():
            spare = np.bincount(row_of[close], minlength=rows) > 1 + np.bincount(row_of[low == 0xAB], minlength=rows)
            cls[close & spare[row_of]] = INLINE
        # runs of three or more full stops are leaders, of three or more spaces are gaps
        if size > 2:
            for mark, into in ((low == 46, LEADER), (cls == SPACE, WIDE)):
                three = mark[2:] & mark[1:-1] & mark[:-2]
                if three.any():
                    run = np.zeros(size, bool)
                    run[2:] |= three
                    run[1:-1] |= three
                    run[:-2] |= three
                    cls[run] = into
        self.char_counts = np.bincount(row_of * np.int64(CLASSES) + cls, minlength=rows * CLASSES).reshape(rows, CLASSES)
        first = np.zeros(size + 1, bool)
        first[offsets] = True
        # words: runs of letters and digits
        inside = (cls <= DIGIT)
        before = np.concatenate([[False], inside[:-1]]) & ~first[:-1] if size else inside
        begin = np.flatnonzero(inside & ~before)
        after = np.concatenate([inside[1:], [False]]) & ~first[1:] if size else inside
        end = np.flatnonzero(inside & ~after) + 1
        word_row = row_of[begin] if size else np.zeros(0, np.int32)
        length = end - begin
        lowered = lower_table()[low]
        hashes = word_hashes(lowered, begin, end)
        function = np.isin(hashes, function_hashes())
        single = length == 1  # letters set apart are no words, even where one of them could be
        function &= ~(single & (np.append(single[1:], False) | np.append(False, single[:-1])[: len(single)]))
        digits = np.concatenate([[0], np.cumsum(cls == DIGIT)])
        number = digits[end] - digits[begin]
        self.words = np.bincount(word_row, minlength=rows)
        order = np.lexsort((hashes, word_row))
        same = np.zeros(len(order), bool)
        if len(order) > 1:
            same[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (word_row[order[1:]] == word_row[order[:-1]])
        kind = np.full(len(begin), 1, np.int64)  # 1 a plain new word
        kind[same] = 5
        kind[(length == 1) & ~function] = 3
        kind[(number > 0) & (number < length)] = 4
        # words of Latin letters that nobody could pronounce: five consonants on end, or three and no vowel
        hard = (low >= 97) & (low <= 122) & ~np.isin(low, VOWELS) if size else inside
        hard |= (low >= 65) & (low <= 90) & ~np.isin(low + 32, VOWELS)
        if hard.any():
            run = hard[:-4] & hard[1:-3] & hard[2:-2] & hard[3:-1] & hard[4:] if size > 4 else np.zeros(0, bool)
            runs = np.concatenate([[0], np.cumsum(run), np.full(size - len(run), run.sum())])
            hards = np.concatenate([[0], np.cumsum(hard)])
            inner = runs[np.maximum(end - 4, begin)] - runs[begin]
            kind[((length >= 5) & (inner > 0)) | ((length >= 3) & (hards[end] - hards[begin] == length))] = 7
        kind[function] = 0
        kind[number == length] = 2
        kind[length > 24] = 6
        width = BLOCKS["words"]
        self.word_kinds = np.bincount(word_row * np.int64(width) + kind, minlength=rows * width).reshape(rows, width)
        self.distinct = self.words - np.bincount(word_row[same], minlength=rows)
        width = BLOCKS["lengths"]
        bucket = np.searchsorted([2, 3, 5, 7, 10, 14, 25], length, "right")
        self.lengths = np.bincount(word_row * np.int64(width) + bucket, minlength=rows * width).reshape(rows, width)
        self.word_chars = np.bincount(word_row, length, minlength=rows)
        self.function = self.word_kinds[:, 0]
        # phrases: words between marks; weighted by their words
        # (a line break ends a phrase only where the line before it is short, as prose may be wrapped)
        breaks = np.isin(cls, (STOP, COMMA, CELL, INLINE, BRACKET, TAB, WIDE, LEADER, CODE, BROKEN))
        newline = cls == NEWLINE
        breaks &= cls != TAB
        starts = np.flatnonzero(np.concatenate([newline, [False]]) | first) if size else np.zeros(1, np.int64)
        self._lines(starts, size, row_of, cls, low, begin)
        if size:
            breaks |= self.entry_rows[row_of] & newline
            breaks |= self.cell_rows[row_of] & (cls == TAB)
            loose = (cls == TAB) & ~self.cell_rows[row_of]
            if loose.any():
                moved = np.bincount(row_of[loose], minlength=rows)
                self.char_counts[:, TAB] -= moved
                self.char_counts[:, SPACE] += moved
        ticks = np.cumsum(breaks)
        phrase = ticks[begin] * np.int64(1) if size else np.zeros(0, np.int64)
        change = np.ones(len(begin), bool)
        if len(begin) > 1:
            change[1:] = (phrase[1:] != phrase[:-1]) | (word_row[1:] != word_row[:-1])
        at = np.flatnonzero(change)
        count = np.diff(np.append(at, len(begin)))
        width = BLOCKS["phrases"]
        bucket = np.searchsorted([2, 3, 4, 6, 10], count, "right")
        self.phrases = np.bincount(word_row[at] * np.int64(width) + bucket, count, minlength=rows * width).reshape(rows, width)

    def _lines(self, starts: np.ndarray, size: int, row_of: np.ndarray, cls: np.ndarray, low: np.ndarray, begin: np.ndarray) -> None:
        """Shapes of the lines that hold a word or mark, weighted by their characters."""
        rows, width = self.rows, BLOCKS["lines"]
        self.entry_rows = self.cell_rows = np.zeros(rows, bool)
        self.stop_lines = np.zeros(rows, np.int64)
        if not size:
            self.lines, self.line_shapes = np.zeros(rows, np.int64), np.zeros((rows, width))
            return
        starts = np.unique(starts[starts < size])
        line_end = np.append(starts[1:], size)
        row = row_of[starts]

        def per_line(flag: np.ndarray) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(flag)])
            return sums[line_end] - sums[starts]

        blank = np.isin(cls, (SPACE, NEWLINE, TAB, WIDE))
        ink = per_line(~blank)
        words = np.zeros(size + 1, np.int64)
        words[begin + 1] = 1
        sums = np.cumsum(words)
        words = sums[line_end] - sums[starts]
        position = np.arange(size)
        last_ink = np.maximum.accumulate(np.where(blank, -1, position))[line_end - 1]
        filled = np.where(blank, size, position)
        first_ink = np.minimum.accumulate(filled[::-1])[::-1][starts]
        first_ink = np.minimum(first_ink, size - 1)
        tail = cls[np.maximum(last_ink, 0)]
        tail_prev = cls[np.maximum(last_ink - 1, 0)]
        head, head_next = cls[first_ink], cls[np.minimum(first_ink + 1, size - 1)]
        head_third = cls[np.minimum(first_ink + 2, size - 1)]
        stop = (tail == STOP) | ((tail == BRACKET) & (tail_prev == STOP))
        cells = per_line((cls == CELL) | (cls == TAB))
        gaps = (cls == WIDE) & ~np.concatenate([[False], (cls == WIDE)[:-1]])
        cells += per_line(gaps)
        commas = per_line(low == 44)
        leader = per_line(cls == LEADER)
        number_head = (head == DIGIT) & np.isin(head_next, (STOP, BRACKET, DASH, DIGIT)) & (np.isin(head_third, (SPACE, BRACKET, STOP, DASH, DIGIT)))
        bullet = np.isin(head, (DASH, INLINE, CODE)) | number_head
        some = ink > 0
        shape = np.full(len(starts), 7)
        shape[(words >= 5) & ~stop] = 0
        shape[(words <= 4) & (words > 0)] = 2
        shape[stop & (words >= 4)] = 1
        shape[bullet & (words <= 6) & ~stop] = 3
        grid = (cells >= 2) & (words <= 3 * (cells + 1))
        shape[grid] = 4
        shape[(commas >= 2) & (words <= 2 * commas + 3)] = 5
        shape[(leader > 0) & (words <= 8)] = 6
        self.lines = np.bincount(row[some], minlength=rows)
        self.stop_lines = np.bincount(row[some & stop], minlength=rows)
        self.line_shapes = np.bincount(row[some] * np.int64(width) + shape[some], ink[some].astype(float), minlength=rows * width).reshape(rows, width)
        # line breaks and tabs end phrases in the rows most of whose lines look like entries or cells
        entry = some & ~stop & (bullet | (head == DIGIT) | (words <= 4))
        lines = np.maximum(self.lines, 1)
        self.entry_rows = np.bincount(row[entry], minlength=rows) >= 0.7 * lines
        self.cell_rows = np.bincount(row[some & (grid | (per_line(cls == TAB) > 0) & ~stop)], minlength=rows) >= 0.7 * lines

    def blocks(self) -> dict[str, np.ndarray]:
        raw = {"chars": self.char_counts, "words": self.word_kinds, "lengths": self.lengths, "phrases": self.phrases, "lines": self.line_shapes}
        out = {}
        for name, counts in raw.items():
            total = counts.sum(1, keepdims=True)
            out[name] = (counts / np.maximum(total, 1)).astype(np.float32)
        return out


@lru_cache(maxsize=1)
def function_hashes() -> np.ndarray:
    return np.unique(_span_hash(FUNCTION_WORDS, 0))


@lru_cache(maxsize=1)
def profiles() -> tuple[list[tuple[str, str]], dict[str, np.ndarray]]:
    """The mean distributions of each (kind, form)."""
    names, blocks = [], {k: [] for k in BLOCKS}
    for name, texts in seeds().items():
        figures = Figures(*flatten(pa.array(texts))).blocks()
        names.append(name)
        for k in BLOCKS:
            blocks[k].append(figures[k].mean(0))
    return names, {k: np.array(v, np.float32) for k, v in blocks.items()}


def _entropy(p: np.ndarray) -> np.ndarray:
    return -(p * np.log2(np.maximum(p, 1e-9))).sum(-1)


def divergences(figures: Figures) -> np.ndarray:
    """[rows, profiles]: the weighted Jensen-Shannon divergence over all blocks."""
    names, prof = profiles()
    mine = figures.blocks()
    total = np.zeros((figures.rows, len(names)), np.float32)
    for k, w in WEIGHTS.items():
        own, theirs = _entropy(mine[k]), _entropy(prof[k])
        for j in range(len(names)):
            total[:, j] += w * (_entropy((mine[k] + prof[k][j]) / 2) - (own + theirs[j]) / 2)
    # a form without what makes it up is out of the question, and so is prose against plain evidence
    c, words = figures.char_counts, np.maximum(figures.words, 1)
    parts = c[:, COMMA] + c[:, CELL]
    short_phrases = figures.phrases[:, 4:].sum(1) == 0
    listed = short_phrases & ((figures.lines == 1) & (parts >= 3) | (figures.lines >= 5) & figures.entry_rows)
    listed |= (figures.phrases[:, 5] == 0) & (figures.lines == 1) & (parts >= 4)
    listed &= c[:, STOP] == 0
    unreadable = (figures.word_kinds[:, 7] >= 2) & (figures.word_kinds[:, 7] >= 0.15 * words) | (figures.word_kinds[:, 6] >= 0.5 * words) & (figures.words > 0)
    for j, (kind, form) in enumerate(names):
        out = np.zeros(figures.rows, bool)
        if form.startswith(("tags", "trail")):
            out |= c[:, INLINE] < 2
        elif form.startswith("lines"):
            out |= (figures.lines < 3) | (2 * figures.stop_lines > figures.lines) | (c[:, STOP] >= 2) | (c[:, STOP] > 0) & ~short_phrases
        elif form.startswith("commas"):
            out |= c[:, STOP] >= 2
        elif form.startswith("repeat"):
            out |= figures.distinct > 0.35 * words
        if kind == "prose":
            out |= listed | unreadable
        elif kind == "list":
            out |= unreadable
        if kind in ("list", "table"):
            out |= figures.words < 3
        total[out, j] = np.inf
    return total


STATS = "n_chars long, n_words long, n_lines long, mean_word_length double, symbol_ratio double, digit_ratio double, stop_line_share double, common_word_share double, distinct_word_share double, divergence_prose double, divergence_kind double, kind string"


def describe(column: pa.Array) -> list[pa.Array]:
    """The columns of `STATS` for one string column."""
    names, _ = profiles()
    points, offsets = flatten(column)
    f = Figures(points, offsets)
    d = divergences(f)
    kinds = np.array([KINDS.index(k) for k, _ in names])
    best = np.stack([d[:, kinds == i].min(1) for i in range(len(KINDS))], 1)
    kind = best.argmin(1)
    c, words, chars = f.char_counts, np.maximum(f.words, 1), np.maximum(f.chars, 1)
    letters = c[:, [LOWER, UPPER, LATIN1, DIGIT, SPACE, NEWLINE, TAB, WIDE]].sum(1)
    blank = (c.sum(1) - c[:, [SPACE, NEWLINE, TAB, WIDE]].sum(1)) == 0
    label = np.array([*KINDS, "short"], object)[np.where(f.chars < MIN_CHARS, 4, kind)]
    return [
        pa.array(f.chars), pa.array(f.words), pa.array(f.lines), pa.array(f.word_chars / words),
        pa.array((c.sum(1) - letters) / chars), pa.array(c[:, DIGIT] / chars), pa.array(f.stop_lines / np.maximum(f.lines, 1)),
        pa.array(f.function / words), pa.array(f.distinct / words), pa.array(best[:, 0].astype(float)), pa.array(best.min(1).astype(float)),
        pa.array(label, pa.string(), mask=blank),
    ]


def kinds_of(column: pa.Array) -> np.ndarray:
    """The kind of each text as an object array; None for blank texts. For operators that need it beside their own work."""
    return np.array(describe(column)[-1].to_pylist(), object)


def text_quality(df: DataFrame, key: str = "para_id", text: str = "text") -> DataFrame:
    """(key, statistics ..., kind) of every row; a narrow pass without a shuffle."""
    names = ["k", *(x.split()[0] for x in STATS.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "t", 1 << 20):
                yield pa.RecordBatch.from_arrays([batch.column("k"), *describe(batch.column("t"))], names)

    narrow = df.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    out = narrow.mapInArrow(run, "k long, " + STATS)
    return out.withColumnRenamed("k", key)
