"""Scores of abusive, hateful or sexually explicit language.

Texts are folded to one plain alphabet: letters are read in the alphabet most of their word is
written in (so that look-alikes count as what they look like), small, without accents and
ignorables, Armenian and Cyrillic romanised; repeated letters count once, signs and digits that touch
a letter may stand for letters, and words spelled letter by letter are joined. An Aho-Corasick
automaton of the weighted lexicon runs over the folded text; around signs and digits a trie of the
lexicon is walked, in which a sign takes every branch and a digit those of the letters it looks
like. The score is the largest sum of weights
within `STRETCH` folded characters of a hit, less the exception phrases there; that is the normalisation by
length, so that a long text is no case for many faint hits far apart, and no shelter for a strong one.

Defined results: null and blank texts have the score 0.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kaghamar.functions.codepoints import flatten, slices
from kaghamar.llm.abuse_lexicon import LEXICON
from kaghamar.llm.langid import ROMAN
from kaghamar.llm.lookalikes import looks, script_of

STRETCH = 110
#: A text is a case from this score on; an entry of this weight is one by itself.
THRESHOLD = 1.05
#: Common romanisation of Cyrillic, so that one lexicon entry covers both alphabets.
CYRILLIC = dict(zip("абвгдеёжзийклмнопрстуфхцчшщъыьэюяіїєґ", "a b v g d e e zh z i y k l m n o p r s t u f kh c ch sh sch - y - e yu ya i yi ye g".split()))
LATIN, CYR, ARM = range(3)
LETTER, DROP, GAP, STOP, SIGN, DIGIT = range(6)
#: What a sign is in folded text: the only one between two letters; one of several there; one at a word's edge. The latter two may also part words.
INNER, INNER_RUN, EDGE = b"?!\""
#: The same for the digit 0; the others follow it.
DIGIT_INNER, DIGIT_RUN, DIGIT_EDGE = 0x30, 0xB0, 0xC0
#: Folded letters that each digit looks like.
LEET = ("o", "i l", "z", "e z", "a ch", "s", "b g", "t", "b v", "g q")
_OWN = {"ւ": "u"}  # so that both spellings of ու end up as u
_FOLD_LATIN = {"ß": "ss", "ø": "o", "æ": "ae", "œ": "oe", "ı": "i", "ł": "l"}


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kind[n], script[n], folded[3, 3, n]): what each code point is, and its up to three folded
    characters when the word is read as Latin, Cyrillic or Armenian."""
    size = 0x20000
    kind = np.full(size, GAP, np.uint8)
    script = np.full(size, 3, np.uint8)
    folded = np.zeros((3, 3, size), np.uint8)
    turn = looks()
    for point in range(size):
        c = chr(point)
        cat = unicodedata.category(c)
        if cat[0] == "M" or cat == "Cf" or c in "՛՞՜՚'’‘":
            kind[point] = DROP
            continue
        if cat == "Nd":
            kind[point] = DIGIT
        elif c in "@*#$%_+&":
            kind[point] = SIGN
        elif c in ".!?։…:":
            kind[point] = STOP
        if cat[0] != "L":
            continue
        kind[point] = LETTER
        plain = unicodedata.normalize("NFKD", c).lower()
        plain = "".join(x for x in plain if unicodedata.category(x)[0] == "L")
        if not plain:
            continue
        where = script_of(c)
        script[point] = {"LATIN": LATIN, "GREEK": LATIN, "CYRILLIC": CYR, "ARMENIAN": ARM}.get(where, 3)
        for s, name in ((LATIN, "LATIN"), (CYR, "CYRILLIC"), (ARM, "ARMENIAN")):
            letters = plain
            if where != name and len(plain) == 1:
                letters = (turn[name].get(c) or turn[name].get(plain, plain)).lower()
            roman = "".join(_OWN.get(x) or ROMAN.get(x) or CYRILLIC.get(x) or _FOLD_LATIN.get(x) or (x if x.isascii() and x.isalpha() else "") for x in letters)
            for i, x in enumerate(roman.replace("-", "")[:3]):
                folded[s, i, point] = ord(x)
            if not roman:
                folded[s, 0, point] = ord("~")  # a letter of another alphabet
    return kind, script, folded


class Folded:
    """The folded texts of a batch as one string of bytes with a blank before and after each row."""

    def __init__(self, points: np.ndarray, offsets: np.ndarray):
        rows = len(offsets) - 1
        table_kind, table_script, table_folded = tables()
        low = np.minimum(points, 0x1FFFF)
        kind = table_kind[low]
        row_of = np.repeat(np.arange(rows, dtype=np.int64), np.diff(offsets))
        # a hyphen at the end of a line joins the word's parts
        if len(points) > 2:
            wrap = (low[:-2] == 45) & ((low[1:-1] == 10) | (low[1:-1] == 13)) & (kind[2:] == LETTER) | (low[:-2] == 45) & (low[1:-1] == 13) & (low[2:] == 10)
            at = np.flatnonzero(wrap)
            kind[at] = DROP
            kind[at + 1] = DROP
            kind[at[low[at + 2] == 10] + 2] = DROP
        keep = kind != DROP
        low, kind, row_of = low[keep], kind[keep], row_of[keep]
        size = len(low)
        bound = np.append(row_of[1:] != row_of[:-1], True) if size else np.zeros(0, bool)
        letter = kind == LETTER
        prior = np.append(False, letter[:-1] & ~bound[:-1])[:size]
        after = np.append(letter[1:] & ~bound[:-1], False)[:size]
        # a lone sign or digit between letters stands for a letter; what else touches one may do so, or part words
        wild = ((kind == SIGN) | (kind == DIGIT)) & prior & after
        inner = letter | wild
        begin = inner & ~(np.append(False, inner[:-1])[:size] & np.append(True, ~bound[:-1])[:size])
        word = np.cumsum(begin) - 1
        n = int(word[-1]) + 1 if size and word[-1] >= 0 else 0
        script = table_script[low]
        told = letter & (script < 3)
        most = np.bincount(word[told] * 3 + script[told], minlength=3 * n).reshape(n, 3) if n else np.zeros((0, 3), np.int64)
        main = (most + np.array([0, 1, 2]) * 0.1).argmax(1)  # of equal shares, the alphabet that is not Latin
        read = np.where(inner, main[np.maximum(word, 0)] if n else 0, 0)
        out = [np.where(letter, table_folded[read, i, low], 0).astype(np.uint8) for i in range(3)]
        mask = self._masks(low, kind, letter, wild, row_of, prior, after)
        out[0] = np.where(mask > 0, mask, np.where(letter, out[0], 32)).astype(np.uint8)
        self.spelled = np.unique(row_of[self._single(begin, inner, word, n, row_of, bound)]) if n else np.zeros(0, np.int64)
        # rows are set apart by two blanks
        flat = np.stack(out, 1)
        many = np.flatnonzero(bound)
        pad = np.zeros((size, 2), np.uint8)
        pad[many] = 10
        flat = np.concatenate([flat, pad], 1).ravel()
        rows_flat = np.repeat(row_of, 5)
        used = flat > 0
        flat, rows_flat = np.append(np.uint8(10), flat[used]), np.append(0, rows_flat[used])
        # ou is one letter, and repeated letters (and blanks) count once
        drop = np.zeros(len(flat), bool)
        if len(flat) > 1:
            drop[:-1] = (flat[:-1] == ord("o")) & (flat[1:] == ord("u"))
            flat, rows_flat = flat[~drop], rows_flat[~drop]
            same = np.append(False, (flat[1:] == flat[:-1]) & ~_IS_MASK[flat[1:]])
            flat, rows_flat = flat[~same], rows_flat[~same]
        flat = np.where(flat == 10, 32, flat)
        self.bytes, self.row = flat, rows_flat

    @staticmethod
    def _masks(low: np.ndarray, kind: np.ndarray, letter: np.ndarray, lone: np.ndarray, row_of: np.ndarray, prior: np.ndarray, after: np.ndarray) -> np.ndarray:
        """What each sign or digit of a run that touches a letter is in folded text, 0 elsewhere."""
        out = np.zeros(len(low), np.uint8)
        sign = (kind == SIGN) | (kind == DIGIT)
        if not sign.any():
            return out
        joined = sign[1:] & sign[:-1] & (row_of[1:] == row_of[:-1])
        begin = np.flatnonzero(sign & ~np.append(False, joined))
        end = np.flatnonzero(sign & ~np.append(joined, False))
        left, right, length = prior[begin], after[end], end - begin + 1
        # emphasis: a run of one sign before a word, and as many of it after a later one
        mark = low[begin]
        emphatic = ((mark == ord("*")) | (mark == ord("_"))) & (np.minimum.reduceat(np.append(low, 0x1FFFF), np.stack([begin, end + 1], 1).ravel())[::2] == mark)
        emphatic &= np.maximum.reduceat(np.append(low, 0), np.stack([begin, end + 1], 1).ravel())[::2] == mark
        if len(begin) > 1:
            opens = emphatic[:-1] & emphatic[1:] & (mark[:-1] == mark[1:]) & (length[:-1] == length[1:]) & (row_of[begin[:-1]] == row_of[begin[1:]])
            opens &= ~left[:-1] & right[:-1] & left[1:] & ~right[1:]
            emphatic = np.append(opens, False) | np.append(False, opens)
        else:
            emphatic[:] = False
        # longer runs than any word of the lexicon hide none
        may = (left | right) & ~emphatic & (length <= longest_word())
        place = np.where(left & right, 1, 2)
        each, place = np.repeat(may, length), np.repeat(place, length)
        at = np.flatnonzero(sign)
        place[lone[at]] = 0
        digits = np.array([unicodedata.decimal(chr(c), 0) for c in low[at].tolist()], np.uint8)
        signs = np.array([INNER, INNER_RUN, EDGE], np.uint8)[place]
        numbers = np.array([DIGIT_INNER, DIGIT_RUN, DIGIT_EDGE], np.uint8)[place] + digits
        out[at] = np.where(each, np.where(kind[at] == DIGIT, numbers, signs), 0)
        return out

    @staticmethod
    def _single(begin: np.ndarray, inner: np.ndarray, word: np.ndarray, n: int, row_of: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Places of words in a run of four or more words of one or two letters: perhaps spelled out."""
        length = np.bincount(word[inner], minlength=n)
        at = np.flatnonzero(begin)
        short = length <= 2
        row = row_of[at]
        run = np.zeros(n, bool)
        if n >= 4:
            four = short[:-3] & short[1:-2] & short[2:-1] & short[3:] & (row[:-3] == row[3:])
            one = (length == 1).astype(int)
            four &= one[:-3] + one[1:-2] + one[2:-1] + one[3:] >= 3
            run[:-3] |= four
        return at[run]

    def text(self) -> str:
        return self.bytes.tobytes().decode("latin-1")


def fold(text: str) -> str:
    """The folded form of one text, without blanks at its ends."""
    return Folded(*flatten(pa.array([text]))).text().strip()


def join_spelled(text: str) -> str:
    """The text with words that were spelled letter by letter put together."""
    import regex

    unit = r"(?:[sckgzdt]h|ts|dz|\p{L}|[@*])"
    return regex.sub(rf"(?<![\p{{L}}@*]){unit}(?:[ \t\n.\-_·]{{1,3}}{unit}){{3,}}(?![\p{{L}}@*])", lambda m: " " + regex.sub(r"[ \t\n.\-_·]+", "", m[0]) + " ", text, flags=regex.I)


def entries() -> Iterator[tuple[float, str, bool]]:
    """(weight, words, whether the last word may go on) of each entry of the lexicon."""
    for weight, block in LEXICON.items():
        for entry in block.replace("\n", " ").split(";"):
            if entry := entry.strip():
                yield weight, entry.rstrip("*"), entry.endswith("*")


@lru_cache(maxsize=1)
def patterns() -> dict[str, tuple[int, float, str, bool]]:
    """Folded pattern -> (entry number, weight, words, whether the last word may go on); of entries folded alike the weightiest."""
    out: dict[str, tuple[int, float, str, bool]] = {}
    for number, (weight, words, open_end) in enumerate(entries(), 1):
        pattern = f" {fold(words)}" + " " * (not open_end)
        if pattern not in out or abs(out[pattern][1]) < abs(weight):
            out[pattern] = (number, weight, words, open_end)
    return out


@lru_cache(maxsize=1)
def longest_word() -> int:
    return max(len(w) for _, words, _ in entries() for w in words.split())


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """Patterns -> (entry number, weight, length)."""
    tool = ahocorasick.Automaton()
    for pattern, (number, weight, _, _) in patterns().items():
        tool.add_word(pattern, (number, weight, len(pattern)))
    tool.make_automaton()
    return tool


class Masked:
    """A trie of the lexicon, walked over folded text with signs and digits that may stand for letters."""

    def __init__(self) -> None:
        self.children: list[dict[int, int]] = [{}]
        #: For each node, the nodes behind the next letter, and what that letter is in folded text.
        self.letters: list[dict[int, str]] = [{}]
        self.ends: list[list[tuple[int, float, bool, int]]] = [[]]
        self.blank = [False]
        self.most = 0
        _, table_script, table_folded = tables()
        for pattern, (number, weight, words, open_end) in patterns().items():
            units: list[list[tuple[str, ...]]] = [[(" ",)]]
            for word in words.split():
                points = [p for p in flatten(pa.array([word]))[0].tolist() if tables()[0][p] == LETTER]
                main = int(np.bincount([table_script[p] for p in points if table_script[p] < 3]).argmax())
                letters = ["".join(map(chr, filter(None, table_folded[main, :, p].tolist()))) for p in points]
                letters = [x for x in letters if x]
                i = 0
                while i < len(letters):
                    pair = letters[i : i + 2]
                    if len(pair) == 2 and (pair[0] == pair[1] or pair == ["o", "u"]):  # as one letter, or two of which one is hidden
                        units.append([(pair[1],), tuple(pair)])
                        i += 2
                    else:
                        units.append([(letters[i],)])
                        i += 1
                units.append([(" ",)])
            if open_end:
                units.pop()
            size = len(pattern.strip())
            for chosen in product(*units):
                self._add([x for part in chosen for x in part], (number, weight, open_end, size))

    def _child(self, node: int, byte: int) -> int:
        if byte not in self.children[node]:
            self.children[node][byte] = len(self.children)
            self.children.append({})
            self.letters.append({})
            self.ends.append([])
            self.blank.append(byte == 32)
        return self.children[node][byte]

    def _add(self, letters: list[str], entry: tuple[int, float, bool, int]) -> None:
        node = 0
        for letter in letters:
            begin = node
            for c in letter:
                before, node = node, self._child(node, ord(c))
                if c != " ":
                    self.letters[before].setdefault(node, c)
            if len(letter) > 1:
                self.letters[begin][node] = letter
        if entry not in self.ends[node]:
            self.ends[node].append(entry)
        self.most = max(self.most, sum(map(len, letters)))

    @staticmethod
    def _shown(hidden: int, read: int, seen: int, edge: int) -> bool:
        """Whether enough of a word is seen: a third, and more if letters at its edge are hidden."""
        return not hidden and not read or 0 < seen and hidden <= 2 * seen and (not edge or seen > 1 + (edge > 1))

    def hits(self, folded: bytes, start: int, end: int) -> list[tuple[int, float]]:
        """(entry number, weight) of the entries that begin with the gap at `start` and lie before `end`.

        Of those that read a sign or digit as a letter, only the weightiest: it is one word, whichever it is.
        """
        plain: list[tuple[int, float]] = []
        best: tuple[int, float] | None = None
        node = self.children[0][32]
        at = start + 1
        while at < end and not _IS_MASK_LIST[c := folded[at]]:
            if c == 32 and self.blank[node]:
                at += 1
                continue
            if (node := self.children[node].get(c, -1)) < 0:
                return plain
            at += 1
        begun = bytes(folded[start + 1 : at])
        seen = len(begun) - begun.rfind(b" ") - 1
        # node, letters of the word hidden, read from digits, seen, hidden at its edge; of the entry hidden, seen, digits that look like another letter, digits read; whether the last is hidden at an edge
        states = {(node, 0, 0, seen, 0, 0, len(begun) - begun.count(b" "), 0, 0, False)}
        for place in range(at, end):
            c, after = folded[place], set()
            masked = _IS_MASK_LIST[c]
            for node, hidden, read, seen, edge, hid, saw, odd, digits, last in states:
                if c == 32 or masked and c != INNER and not DIGIT_INNER <= c < DIGIT_INNER + 10:  # a gap
                    if self.blank[node]:
                        after.add((node, hidden, read, seen, edge, hid, saw, odd, digits, last))
                    elif (to := self.children[node].get(32, -1)) >= 0 and self._shown(hidden, read, seen, edge):
                        after.add((to, 0, 0, 0, 0, hid, saw, odd, digits, False))
                if c == 32:
                    continue
                if not masked:
                    if (to := self.children[node].get(c, -1)) >= 0:
                        after.add((to, hidden, read, seen + 1, edge, hid, saw + 1, odd, digits, False))
                    continue
                if c in (INNER, INNER_RUN, EDGE):
                    outer = c == EDGE
                    for to in self.letters[node]:
                        after.add((to, hidden + 1, read, seen, edge + outer, hid + 1, saw, odd, digits, outer))
                    continue
                outer = c >= DIGIT_EDGE
                like = LEET[c - (DIGIT_EDGE if outer else DIGIT_RUN if c >= DIGIT_RUN else DIGIT_INNER)].split()
                for to, letter in self.letters[node].items():
                    if letter in like:
                        after.add((to, hidden, read + 1, seen, edge, hid, saw, odd, digits + 1, False))
                    elif not outer and not hid:  # one letter of an entry may be any digit
                        after.add((to, hidden + 1, read, seen, edge, hid + 1, saw, odd + 1, digits, False))
            states = {s for s in after if not s[7] or s[5] == 1}
            if not states:
                break
            for node, hidden, read, seen, edge, hid, saw, odd, digits, last in states:
                for number, weight, open_end, size in self.ends[node]:
                    if hid + digits and (size <= 3 or saw < 2) or not self._shown(hidden, read, seen, edge):
                        continue
                    if open_end and last and size < 5:
                        continue  # a short beginning of a word whose end is hidden says nothing
                    if not hid and not digits:
                        plain.append((number, weight))
                    elif best is None or (abs(weight), -number) > (abs(best[1]), -best[0]):
                        best = (number, weight)
        return plain + [best] * (best is not None)


_IS_MASK = np.zeros(256, bool)
_IS_MASK[[INNER, INNER_RUN, EDGE, *(b + i for b in (DIGIT_INNER, DIGIT_RUN, DIGIT_EDGE) for i in range(10))]] = True
_IS_MASK_LIST = _IS_MASK.tolist()


@lru_cache(maxsize=1)
def masked() -> Masked:
    return Masked()


def masked_hits(folded: Folded) -> Iterator[tuple[int, int, int, float]]:
    """(row, first place, entry number, weight) of the entries about signs or digits."""
    flat, row = folded.bytes, folded.row
    signs = np.flatnonzero(_IS_MASK[flat])
    if not len(signs):
        return
    tool, text = masked(), flat.tobytes()
    gap = np.flatnonzero((flat == 32) | _IS_MASK[flat] & (flat != INNER) & ~((flat >= DIGIT_INNER) & (flat < DIGIT_INNER + 10)))
    upto = np.searchsorted(signs, gap)
    near = np.append(signs, len(flat) + tool.most + 1)[upto] - gap <= tool.most
    gap = gap[near & (gap + 1 < len(flat))]
    rows = row[gap + 1]
    ends = np.searchsorted(row, rows, "right")
    first = tool.children[tool.children[0][32]]
    for start, r, end in zip(gap.tolist(), rows.tolist(), ends.tolist()):
        c = text[start + 1]
        if c in first or _IS_MASK_LIST[c] or c == 32:
            # the first blank of the next row ends the last word of this one
            for number, weight in tool.hits(text, start, end):
                yield r, start, number, weight


def scores(column: pa.Array) -> np.ndarray:
    """The score of each text."""
    points, offsets = flatten(column)
    rows = len(offsets) - 1
    best = np.zeros(rows)
    if not len(points):
        return best
    folded = Folded(points, offsets)
    _collect(folded, np.arange(rows), best)
    if len(folded.spelled):
        texts = [join_spelled(points[offsets[i] : offsets[i + 1]].tobytes().decode("utf-32-le", "replace")) for i in folded.spelled]
        _collect(Folded(*flatten(pa.array(texts))), folded.spelled, best, least=4)
    return best


def _collect(folded: Folded, names: np.ndarray, best: np.ndarray, least: int = 0) -> None:
    """Raise best[names[row]] to the largest sum of distinct entries of `least` letters or more in a stretch of the row."""
    row = folded.row
    open_hits: list[tuple[int, int, float]] = []
    open_row = -1

    def settle() -> None:
        """The best stretch about each hit, by two pointers over the row's hits in the order of their places.

        An entry counts once in a stretch; exception phrases weigh against what is no case by itself.
        """
        held: dict[int, int] = {}
        strong = weak = 0  # in thousandths, so that adding and taking away leaves nothing behind
        first = last = top = 0
        for at, _, weight in open_hits:
            while last < len(open_hits) and open_hits[last][0] <= at + STRETCH:
                _, number, w = open_hits[last]
                held[number] = held.get(number, 0) + 1
                if held[number] == 1:
                    strong, weak = (strong + round(1000 * w), weak) if w >= THRESHOLD else (strong, weak + round(1000 * w))
                last += 1
            while open_hits[first][0] < at - STRETCH:
                _, number, w = open_hits[first]
                held[number] -= 1
                if not held[number]:
                    strong, weak = (strong - round(1000 * w), weak) if w >= THRESHOLD else (strong, weak - round(1000 * w))
                first += 1
            if weight > 0:
                top = max(top, strong + max(0, weak))
        best[names[open_row]] = max(best[names[open_row]], top / 1000)

    hits = []
    for end, (number, weight, length) in automaton().iter(folded.text()):
        at = row[end]
        if length - 2 < least:
            continue
        if row[end - length + 1] == at or length > 1 and row[end - length + 2] == at:
            hits.append((int(at), end - length, number, weight))
    about_signs = [(r, start - 1, number, weight) for r, start, number, weight in masked_hits(folded)]
    for at, place, number, weight in sorted(hits + about_signs):
        if at != open_row:
            if open_hits:
                settle()
            open_hits, open_row = [], at
        open_hits.append((place, number, weight))
    if open_hits:
        settle()


def abuse_scores(df: DataFrame, key: str, text: str, *carry: str) -> DataFrame:
    """(key, *carry, score): one row per input row; a narrow pass without a shuffle."""
    columns = [F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(carry))]
    names = ["k", *(f"c{i}" for i in range(len(carry)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "t", 1 << 20):
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(scores(batch.column("t")))], [*names, "score"])

    narrow = df.select(*columns)
    kinds = ", ".join(f"`{c}` {narrow.schema[c].dataType.simpleString()}" for c in names)
    out = narrow.mapInArrow(run, f"{kinds}, score double")
    return out.select(F.col("k").alias(key), *(F.col(f"c{i}").alias(c) for i, c in enumerate(carry)), "score")
