"""Language of each text and of each segment of a mixed one, by nearest centroids.

Texts are cut into sentences; each sentence becomes a TF-IDF vector of hashed runs of two and three letters and
is compared by cosine with several centroids per language, found by spherical k-means over labelled
sentences. A sentence nearer to no centroid than that centroid's own training distance allows is
rejected, and so is one clearly nearer to a centroid of a language that isn't of the corpus. Adjacent
sentences of one language form a segment.

The centroids are fitted on the driver from seed sentences and at most `FIT_ROWS` labelled rows
(chosen by the hash of their id); labels of mixed texts are put right by fitting twice, the second
time without the sentences that the first fit assigns to another language.

Defined results: null and blank texts have no language; a text of sentences too short to count is
looked at as a whole; one that is rejected as a whole, too, has no language (`und` in segments).
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
from kaghamar.llm import quality
from kaghamar.llm.langid_seeds import seed_sentences
from kaghamar.llm.quality_seeds import PROSE

#: Bound of the labelled sample that the centroids are fitted on.
FIT_ROWS = 3000
BUCKETS = 1 << 15
CENTROIDS = 3
#: Words of a sentence for it to count as one, and the words after which a run without a stop is cut.
LEAST_WORDS, MOST_WORDS, PIECE = 4, 30, 10
#: A sentence is rejected below this share of the least similarity in training, or below this similarity at once,
#: whichever is less: training sentences resemble each other more than what people write elsewhere.
SLACK, FLOOR = 0.55, 0.08
#: How much nearer a language that isn't of the corpus must be for a sentence to be rejected.
MARGIN = 1.1
#: A sentence of less confidence than this (half of it is none) doesn't speak for a language in a text of several.
SURE = 0.55
SEED_LANGS = {"ru": slice(-9, -7), "uk": slice(-7, -6), "en": slice(-6, -4), "fr": slice(-4, -3), "de": slice(-3, -2), "fa": slice(-2, -1), "ka": slice(-1, None)}


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """Each code point below 0x20000 as a small plain letter: 0 to be skipped, 32 for what parts words."""
    table = np.full(0x20000, 32, np.uint32)
    for point in range(0x20000):
        c = chr(point)
        cat = unicodedata.category(c)
        if cat[0] == "L":
            plain = unicodedata.normalize("NFKC", c).lower()
            table[point] = ord(plain) if len(plain) == 1 else ord(plain[0])
        elif cat[0] == "M" or cat == "Cf":
            table[point] = 0
    for c in "՛՞՜՚'’‘":
        table[ord(c)] = 0
    return table


#: First code points of Latin, other, Cyrillic, Armenian, other, Arabic, other, Georgian, other.
SCRIPTS = np.array([0x250, 0x400, 0x530, 0x590, 0x600, 0x780, 0x10A0, 0x1100])
STOPS = frozenset(".!?։…؟。:")


@lru_cache(maxsize=1)
def stop_points() -> np.ndarray:
    table = np.zeros(0x20000, bool)
    for c in STOPS:
        table[ord(c)] = True
    return table


class Units:
    """The sentences of a batch: `start`, `end` (code points), `row`, `words`."""

    def __init__(self, points: np.ndarray, offsets: np.ndarray):
        self.rows = len(offsets) - 1
        size = len(points)
        low = np.minimum(points, 0x1FFFF)
        self.letter = letter_table()[low]
        row_of = np.repeat(np.arange(self.rows, dtype=np.int64), np.diff(offsets))
        space = (low == 32) | (low == 10) | (low == 9) | (low == 13) | (low == 160)
        before = np.append(True, space[:-1])[:size]
        after = np.append(space[1:], True)[:size]
        cut = stop_points()[low] & after
        cut |= ((low == 47) | (low == 124) | (low == 8212)) & before & after  # / | and the long dash between texts
        visible = self.letter > 32
        starts = np.zeros(size + 1, bool)
        starts[offsets] = True
        word_begin = visible & ~(np.append(False, visible[:-1])[:size] | np.append(False, (self.letter == 0)[:-1])[:size]) | visible & starts[:-1]
        # a new unit begins at the row's start and after a cut
        begin = starts[:-1] | np.append(False, cut[:-1])[:size] if size else starts[:0]
        unit = np.cumsum(begin) - 1 if size else np.zeros(0, np.int64)
        words = np.bincount(unit[word_begin], minlength=int(unit[-1]) + 1) if size else np.zeros(0, np.int64)
        if (words > MOST_WORDS).any():  # no stop for long: pieces of some words
            nth = np.cumsum(word_begin) - 1
            first = nth[np.flatnonzero(begin)] + ~word_begin[np.flatnonzero(begin)]
            begin |= word_begin & (words[unit] > MOST_WORDS) & ((nth - first[unit]) % PIECE == 0)
            unit = np.cumsum(begin) - 1
            words = np.bincount(unit[word_begin], minlength=int(unit[-1]) + 1)
        self.unit, self.words = unit, words
        self.start = np.flatnonzero(begin)
        self.end = np.append(self.start[1:], size)
        self.row = row_of[self.start] if size else np.zeros(0, np.int64)
        self.script = np.zeros(len(self.words), np.int64)  # of most letters; known once the grams are

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """(unit, bucket) of each run of two and of three letters, words set off by one space."""
        keep = self.letter > 0
        letter, unit = self.letter[keep], self.unit[keep]
        if len(letter) == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # a foreign phrase inside a sentence doesn't count: only the script of most of its letters does
        script = np.searchsorted(SCRIPTS, letter, "right")
        n = len(self.words)
        parted = letter == 32
        most = np.bincount(unit[~parted] * (len(SCRIPTS) + 1) + script[~parted], minlength=n * (len(SCRIPTS) + 1)).reshape(n, -1).argmax(1)
        self.script[: len(most)] = most
        letter = np.where(parted | (script == most[unit]), letter, 32)
        parted = letter == 32
        once = ~(parted & np.append(False, parted[:-1]))
        letter, unit = letter[once].astype(np.uint64), unit[once]
        if len(letter) < 3:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b, c = letter[:-2], letter[1:-1], letter[2:]
        ok = (unit[:-2] == unit[2:]) & (b != 32)
        two = (unit[:-1] == unit[1:]) & (letter[:-1] != letter[1:])
        pairs = ((letter[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (letter[1:] * np.uint64(0xD6E8FEB86659FD93)))[two]
        pairs = (pairs ^ (pairs >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (c * np.uint64(0x165667B19E3779F9))
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return np.concatenate([unit[:-2][ok], unit[:-1][two]]), (np.concatenate([h[ok], pairs]) >> np.uint64(49)).astype(np.int64)


def counted(unit: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, bucket, count) of the distinct pairs, in the order of the units."""
    if not len(unit):
        return unit, bucket, np.zeros(0, np.float32)
    key = np.sort(unit * BUCKETS + bucket)
    first = np.append(True, key[1:] != key[:-1])
    at = np.flatnonzero(first)
    key = key[at]
    return key // BUCKETS, key % BUCKETS, np.diff(np.append(at, len(unit))).astype(np.float32)


def _latin(units: Units) -> np.ndarray:
    """Whether most letters of each unit are Latin."""
    latin = (units.letter >= 97) & (units.letter <= 122)
    n = len(units.words)
    return np.bincount(units.unit[latin], minlength=n) * 2 > np.bincount(units.unit[units.letter > 32], minlength=n)


#: A common romanisation of Armenian, from which seed sentences of hy in Latin letters are made.
ROMAN = dict(zip("աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցւփքօֆ", "a b g d e z e y t zh i l kh ts k h dz gh ch m y n sh o ch p j r s v t r c v p q o f".split())) | {"ու": "u", "\u0587": "ev"}


def romanised(text: str) -> str:
    text = text.lower().replace("ու", "u").replace("։", ".")
    return "".join(ROMAN.get(c, "" if c in "՞՛՜" else c) for c in text)


class Centroids:
    """Languages, unit centroids [BUCKETS, n], idf and the least similarity of each centroid."""

    def __init__(self, texts: list[str], langs: list[str], fixed: list[bool]):
        units = Units(*flatten(pa.array(texts)))
        lang = np.array(langs, object)[units.row]
        sure = np.array(fixed)[units.row]
        lang[units.words < LEAST_WORDS] = None
        u, b, c = counted(*units.grams())
        seen = np.bincount(b, minlength=BUCKETS)
        self.idf = np.log((1 + len(units.words)) / (1 + seen)).astype(np.float32) + 1
        value = c * self.idf[b]
        norm = np.sqrt(np.bincount(u, value**2, len(units.words))).astype(np.float32)
        value /= norm[u]
        ok = np.array([x is not None for x in lang]) & (norm > 0)
        # a mixed text's label is wrong for some of its sentences: fit one centroid per language, then
        # several on the sentences that agree with it, then again on those that agree with these
        lang[(lang == "hy") & _latin(units)] = "hy-Latn"  # hy in Latin letters is a class of its own until it is named
        use = ok & ((lang != "hy-Latn") | sure)
        for k in (1, CENTROIDS, CENTROIDS):
            self._fit(u, b, value, lang, use, k, units.script)
            best = self.classes[self._near(u, b, value, units.script).argmax(1)]
            use = ok & ((best == lang) | sure)
        self._fit(u, b, value, lang, use, CENTROIDS, units.script)

    def _fit(self, u: np.ndarray, b: np.ndarray, value: np.ndarray, lang: np.ndarray, ok: np.ndarray, k: int, script: np.ndarray) -> None:
        columns, names, least = [], [], []
        for name in sorted({x for x in lang[ok]}):
            members = np.flatnonzero(ok & (lang == name))
            place = np.full(len(ok), -1)
            place[members] = np.arange(len(members))
            mine = place[u] >= 0
            rows, cols, vals = place[u[mine]], b[mine], value[mine]
            n = 1 if name.startswith("~") else min(k, len(members))
            centre = np.zeros((BUCKETS, n), np.float32)
            pick = self._spread(rows, cols, vals, len(members), n)
            for j, i in enumerate(pick):
                centre[cols[rows == i], j] = vals[rows == i]
            for _ in range(6):
                near = self._dots(rows, cols, vals, centre, len(members)).argmax(1)
                for j in range(n):
                    own = near[rows] == j
                    if own.any():
                        centre[:, j] = np.bincount(cols[own], vals[own], BUCKETS)
                centre /= np.maximum(np.linalg.norm(centre, axis=0), 1e-9)
            dots = self._dots(rows, cols, vals, centre, len(members))
            near = dots.argmax(1)
            size = np.bincount(near, minlength=n)
            keep = (size >= 0.02 * len(members)) | (size == size.max())  # a few odd sentences make no centroid
            if not keep.all():
                centre, n = centre[:, keep], int(keep.sum())
                dots = dots[:, keep]
                near = dots.argmax(1)
            columns.append(centre)
            names += [name] * n
            least += [float(np.quantile(dots[near == j, j], 0.02)) if (near == j).any() else 1.0 for j in range(n)]
        self.classes = np.array(names, object)
        #: The centroids that units of each script may be near to.
        pairs = set(zip(script[ok].tolist(), lang[ok]))
        self.columns = {s: np.flatnonzero([(s, x) in pairs for x in names]) for s in range(len(SCRIPTS) + 1)}
        self._narrow = {}
        self.known = np.array([not x.startswith("~") for x in names])
        self.langs = np.array([x.split("-")[0] for x in names], object)
        names = self.langs.tolist()
        self.order = list(dict.fromkeys(names))
        self.group = np.array([self.order.index(x) for x in names])
        self.weights = np.concatenate(columns, 1)
        self.least = np.minimum(np.array(least, np.float32) * SLACK, FLOOR)

    @staticmethod
    def _dots(u: np.ndarray, b: np.ndarray, value: np.ndarray, weights: np.ndarray, rows: int) -> np.ndarray:
        out = np.zeros((rows, weights.shape[1]), np.float32)
        if len(u):
            at = np.flatnonzero(np.append(True, u[1:] != u[:-1]))
            out[u[at]] = np.add.reduceat(weights[b] * value[:, None], at, axis=0)
        return out

    def _spread(self, rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, n: int, k: int) -> list[int]:
        """Far-apart members to start from: each the least similar to those before."""
        picked = [0]
        close = np.zeros(n, np.float32) - 1
        while len(picked) < k:
            centre = np.zeros((BUCKETS, 1), np.float32)
            own = rows == picked[-1]
            centre[cols[own], 0] = vals[own]
            close = np.maximum(close, self._dots(rows, cols, vals, centre, n)[:, 0])
            picked.append(int(close.argmin()))
        return picked

    def _nearest(self, u: np.ndarray, b: np.ndarray, value: np.ndarray, script: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language's number, confidence, accepted) of each unit."""
        rows = len(script)
        dots = self._near(u, b, value, script)
        strange = dots[:, ~self.known].max(1, initial=0)
        best = np.where(self.known, dots, -1).argmax(1)
        top = dots[np.arange(rows), best]
        per_lang = np.stack([dots[:, self.group == g].max(1) for g in range(len(self.order))], 1)
        per_lang[np.arange(rows), self.group[best]] = 0
        second = np.maximum(per_lang.max(1), 0) if per_lang.shape[1] else np.zeros(rows)
        confidence = np.where(top > 0, top / np.maximum(top + second, 1e-9), 0)
        return self.group[best], confidence, (top >= self.least[best]) & (strange <= MARGIN * top)

    def _near(self, u: np.ndarray, b: np.ndarray, value: np.ndarray, script: np.ndarray) -> np.ndarray:
        """[unit, centroid]: the similarities; a script of -1 means that any centroid may be near."""
        rows = len(script)
        dots = np.zeros((rows, len(self.classes)), np.float32)
        place = np.zeros(rows, np.int64)
        for s in np.unique(script).tolist():
            mine = np.flatnonzero(script == s)
            columns = self.columns[s] if s >= 0 else np.arange(len(self.classes))
            if len(columns):
                place[mine] = np.arange(len(mine))
                some = script[u] == s
                dots[np.ix_(mine, columns)] = self._dots(place[u[some]], b[some], value[some], self.narrow(s, columns), len(mine))
        return dots

    def narrow(self, script: int, columns: np.ndarray) -> np.ndarray:
        """The weights of some columns, side by side in memory."""
        if script not in self._narrow:
            self._narrow[script] = np.ascontiguousarray(self.weights[:, columns])
        return self._narrow[script]

    def classify(self, unit: np.ndarray, bucket: np.ndarray, script: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(language's number, confidence, accepted, has grams) of units given their grams and scripts."""
        n = len(script)
        u, b, c = counted(unit, bucket)
        value = c * self.idf[b]
        norm = np.sqrt(np.bincount(u, value.astype(np.float64) ** 2, n)).astype(np.float32)
        value = value / np.maximum(norm[u], 1e-9)
        return (*self._nearest(u, b, value, script), norm > 0)


def fit(spark_rows: list[tuple[str, str]]) -> Centroids:
    """Centroids from seed sentences and labelled (text, lang) rows."""
    native = [t for t in PROSE if any("ա" <= c <= "ֆ" for c in t)]
    seeds = [(t, "hy") for t in native] + [(romanised(t), "hy") for t in native] + [(t, lang) for lang, part in SEED_LANGS.items() for t in PROSE[part]]
    more = seed_sentences()
    seeds += more + [(romanised(t), "hy") for t, lang in more if lang == "hy"]
    texts = [t for t, _ in seeds] + [t for t, _ in spark_rows]
    langs = [x for _, x in seeds] + [x for _, x in spark_rows]
    return Centroids(texts, langs, [True] * len(seeds) + [False] * len(spark_rows))


def labelled_sample(labels: DataFrame, corpus: DataFrame, rows: int = FIT_ROWS) -> list[tuple[str, str]]:
    """At most `rows` labelled paragraphs of prose, chosen by the hash of their id."""
    some = labels.filter("tab = 'corpus_raw' and lang is not null and coalesce(quality, 1) = 1").select(F.col("row_id").alias("para_id"), F.col("lang").alias("truth"))
    some = some.orderBy(F.xxhash64("para_id"), "para_id").limit(rows)  # a bounded number of ids: safe to broadcast
    found = corpus.select("para_id", "text").join(F.broadcast(some), "para_id").filter("text is not null").collect()
    return [(r["text"], r["truth"]) for r in sorted(found, key=lambda r: r["para_id"])]


class Identified:
    """Languages of a batch of texts."""

    def __init__(self, model: Centroids, column: pa.Array, kinds: np.ndarray):
        points, offsets = flatten(column)
        units = self.units = Units(points, offsets)
        rows, n = units.rows, len(units.words)
        gram_unit, gram = units.grams()
        groups, confidence, accepted, has = model.classify(gram_unit, gram, units.script)
        order = np.array(model.order, object)
        listed = np.isin(kinds, ("list",))
        counts = accepted & has & (confidence >= SURE) & (units.words >= LEAST_WORDS) & ~listed[units.row] if n else np.zeros(0, bool)
        self.lang, self.confidence, self.counts = order[groups], confidence, counts
        # the whole text is looked at only where no sentence of it counts
        told = np.bincount(units.row[counts], minlength=rows) > 0
        rest = ~told[units.row[gram_unit]] if n else np.zeros(0, bool)
        names = np.cumsum(~told) - 1
        least, most = np.full(rows, 99), np.full(rows, -1)
        np.minimum.at(least, units.row, units.script)
        np.maximum.at(most, units.row, units.script)
        whole = model.classify(names[units.row[gram_unit[rest]]] if n else gram_unit, gram[rest], np.where(least == most, most, -1)[~told])
        self.whole_lang, self.whole_confidence, self.any = np.full(rows, None, object), np.zeros(rows), told.copy()
        self.whole_lang[~told], self.whole_confidence[~told], self.any[~told] = order[whole[0]], whole[1], whole[2] & whole[3]
        self.order = model.order
        self.sentences = np.bincount(units.row[counts] * len(model.order) + groups[counts], minlength=rows * len(model.order)).reshape(rows, -1)

    def languages(self, row: int) -> list[str]:
        """The languages with a full sentence in the row; else that of the whole text, if it is accepted."""
        found = [self.order[g] for g in np.flatnonzero(self.sentences[row])]
        return found or ([self.whole_lang[row]] if self.any[row] else [])


def _narrow(df: DataFrame, key: str, text: str, label: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"), F.col(label).cast("string").alias("l"))


def wrong_labels(df: DataFrame, model: Centroids, key: str = "para_id", text: str = "text", label: str = "lang") -> DataFrame:
    """(key, lang): the true languages of rows whose label is absent or wrong, or which hold several."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "t", 1 << 20):
                kinds = quality.kinds_of(batch.column("t"))
                found = Identified(shared.value, batch.column("t"), kinds)
                keys, labels = batch.column("k").to_pylist(), batch.column("l").to_pylist()
                out: list[tuple[int, str]] = []
                for i in np.flatnonzero(~np.isin(kinds, ("table", "junk")) & (kinds != None)):  # noqa: E711
                    langs = found.languages(i)
                    if len(langs) > 1 or langs and langs[0] != labels[i]:
                        out += [(keys[i], x) for x in langs]
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([x for _, x in out], pa.string())], ["k", "lang"])

    return _narrow(df, key, text, label).mapInArrow(run, "k long, lang string").withColumnRenamed("k", key)


def segments(df: DataFrame, model: Centroids, key: str = "para_id", text: str = "text", label: str = "lang") -> DataFrame:
    """(key, label, segment, begin, end, lang, confidence): each text's runs of sentences of one language.

    begin and end count code points; sentences too short to tell or rejected join the run before
    them. A text in one language has one segment.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    names = ["k", "label", "segment", "begin", "end", "lang", "confidence"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "t", 1 << 20):
                kinds = quality.kinds_of(batch.column("t"))
                found = Identified(shared.value, batch.column("t"), kinds)
                units, keys, labels = found.units, batch.column("k").to_pylist(), batch.column("l").to_pylist()
                base = np.searchsorted(units.row, np.arange(units.rows + 1))
                out: list[list] = []
                for i in range(units.rows):
                    mine = range(base[i], base[i + 1])
                    if kinds[i] is None or not len(mine):
                        continue
                    zero, runs = units.start[mine[0]], []
                    for u in mine:
                        if found.counts[u] and (not runs or runs[-1][2] not in (None, found.lang[u])):
                            runs.append([units.start[u] - zero, units.end[u] - zero, found.lang[u], [found.confidence[u]]])
                        elif not runs:
                            runs.append([0, units.end[u] - zero, None, []])
                        else:
                            runs[-1][1] = units.end[u] - zero
                            if found.counts[u]:
                                runs[-1][2] = found.lang[u]
                                runs[-1][3].append(found.confidence[u])
                    for n, (a, b, lang, sure) in enumerate(runs):
                        lang = lang or (found.whole_lang[i] if found.any[i] else "und")
                        out.append([keys[i], labels[i], n, int(a), int(b), lang, float(np.mean(sure)) if sure else float(found.whole_confidence[i])])
                columns = list(zip(*out)) or [[] for _ in names]
                types = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    schema = "k long, label string, segment int, begin int, end int, lang string, confidence double"
    return _narrow(df, key, text, label).mapInArrow(run, schema).withColumnRenamed("k", key)
