"""One consistent form for texts that look alike but differ in their characters.

One pass over the texts finds tokens that hold a style variant, an invisible character, a split
accent or letters of two alphabets, and the distinct clean words beside them. Both are brought
together by a coarse key of what they look like (number of letters, the first two and the last);
there, a trie of the clean words is walked with a weighted edit automaton in which look-alikes and
ignorables cost nothing and an unlisted letter of another alphabet inside a word half an edit, and the
cheapest, most frequent word within half an edit becomes the canonical spelling. Tokens that no word
matches are normalised by table.

Defined results: null texts have no tokens and stay null; joiners between Persian letters and inside
emoji, differing punctuation marks and whole words of another alphabet stay as they are; a word of
two alphabets is changed only if all letters of the lesser one look like letters of the other.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kaghamar.functions.codepoints import flatten, slices
from kaghamar.llm import quality

#: Letters of each alphabet beside those of others that look like them. Row: one look; columns: Latin, Cyrillic, Greek, Armenian.
LOOKS = """
a а α . | c с ϲ . | e е . . | o о ο օ | p р ρ . | x х χ . | y у γ . | i і ι . | j ј ϳ յ | s ѕ . . | h һ . հ | n п η ո | u . υ ս | q ԛ . զ | g . . ց
A А Α . | B В Β . | C С Ϲ . | E Е Ε . | H Н Η . | I І Ι . | J Ј . . | K К Κ . | M М Μ . | O О Ο Օ | P Р Ρ . | S Ѕ . Տ | T Т Τ . | X Х Χ . | Y У Υ . | N . Ν . | Z . Ζ . | U . . Ս | L . . Լ
k к κ . | m м . . | t т τ . | b ь . . | r г . . | v ѵ ν . | w ԝ ω . | d ԁ . . | l ӏ . ւ | f . . ֆ | z . . . | ï ї ϊ . | ë ё . . | ó . ό . | d . . ժ | p . . ք | m . . տ | w . . ա | n . . ռ | h . . ի | t . . ե | r . . ր | g . . գ | q . . գ | y . . վ | i . . ի | S . . Տ | Q . . Զ | . З . Յ | o . . ծ | ƒ . . ֆ | D . . Դ | b . . Ե | U Ц . Ս | P . . Ք
"""  # fmt: skip
#: Letters that the corpus's languages write with.
ORDINARY = {
    "LATIN": "abcdefghijklmnopqrstuvwxyzàâæçéèêëîïôœùûüÿäöß",
    "CYRILLIC": "абвгдеёжзийклмнопрстуфхцчшщъыьэюяіїєґ",
    "ARMENIAN": "աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցւփքօֆև",
}
COLUMNS = ("LATIN", "CYRILLIC", "GREEK", "ARMENIAN")
SCRIPTS = ("", *COLUMNS, "ARABIC", "GEORGIAN", "HEBREW", "other")
PERSIAN_JOINER, JOINER, SELECTOR = "‌", "‍", "️"


@lru_cache(maxsize=1)
def looks() -> dict[str, dict[str, str]]:
    """script -> {letter of another script: the letter of this one that it looks like}."""
    out: dict[str, dict[str, str]] = {s: {} for s in COLUMNS}
    for group in LOOKS.replace("\n", "|").split("|"):
        letters = group.split()
        for i, to in enumerate(letters):
            if to != ".":
                for j, c in enumerate(letters):
                    if j != i and c != ".":
                        out[COLUMNS[i]].setdefault(c, to)
    return out


@lru_cache(maxsize=1)
def look_class() -> dict[str, str]:
    """The representative of each letter's look; the first row of a pair in `LOOKS` decides."""
    out: dict[str, str] = {}
    for group in LOOKS.replace("\n", "|").split("|"):
        letters = [c for c in group.split() if c != "."]
        known = [out[c] for c in letters if c in out]
        for c in letters:
            out.setdefault(c, known[0] if known else letters[0])
    return out


def script_of(c: str) -> str:
    name = unicodedata.name(unicodedata.normalize("NFKC", c)[:1] or c, "")
    return next((s for s in SCRIPTS[1:-1] if name.startswith(s)), "other")


def is_style(c: str) -> bool:
    """A letter or digit that only differs in width or style, or joins several, from the usual ones."""
    point = ord(c)
    return 0xFF10 <= point <= 0xFF5A or 0x1D400 <= point <= 0x1D7FF or 0xFB00 <= point <= 0xFB17 or 0xFB50 <= point <= 0xFDFB or 0xFE70 <= point <= 0xFEFC or 0x2100 <= point <= 0x214F and unicodedata.category(c) in ("Lu", "Ll") or 0x24B6 <= point <= 0x24E9 or 0x1F130 <= point <= 0x1F149 or 0xFF66 <= point <= 0xFFDC


OK, STYLE, SPACE, HIDDEN, ACCENT = range(5)
NOTHING, LETTER, DIGIT = range(3)


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(what is odd, letter or digit, script) of each code point below 0x20000."""
    odd, sort, script = np.zeros(0x20000, np.uint8), np.zeros(0x20000, np.uint8), np.zeros(0x20000, np.uint8)
    for point in range(0x20000):
        c = chr(point)
        cat = unicodedata.category(c)
        if cat == "Cf" or c in "͏ᅟᅠㅤﾠ឴឵" or 0xFE00 <= point <= 0xFE0F:
            odd[point] = HIDDEN
        elif cat in ("Zs", "Zl", "Zp") and c != " ":
            odd[point] = SPACE
        elif cat == "Mn" and 0x300 <= point <= 0x36F or point in (0x653, 0x654, 0x655):
            odd[point] = ACCENT
        elif cat[0] == "L" or cat == "Nd" or cat == "So" and is_style(c):
            sort[point] = DIGIT if cat == "Nd" else LETTER
            if is_style(c) and unicodedata.normalize("NFKC", c) != c:
                odd[point] = STYLE
            if cat[0] == "L" or cat == "So":
                script[point] = SCRIPTS.index(script_of(c))
    return odd, sort, script


_IGNORED = r"\p{Cf}\u034F\u115F\u1160\u3164\uFFA0\uFE00-\uFE0F"
#: A word or number with what clings to it; joiners and selectors that an emoji before them needs stay out.
_BOXED = "\u24B6-\u24E9\U0001F130-\U0001F149"
TOKEN = regex.compile(rf"(?:(?<![\p{{So}}\p{{Sk}}])[{_IGNORED}])*[\p{{L}}\p{{Nd}}{_BOXED}][\p{{L}}\p{{Nd}}\p{{M}}{_IGNORED}{_BOXED}]*")
ODD_SPACE = regex.compile(r"[\p{Zs}\p{Zl}\p{Zp}--[ ]]", regex.V1)
ARABIC = regex.compile(r"\p{Arabic}")


def visible_form(token: str) -> str:
    """The token without ignorables that nothing needs, in usual width and style, accents joined."""
    out = []
    for i, c in enumerate(token):
        before, after = token[i - 1 : i], token[i + 1 : i + 2]
        if c == PERSIAN_JOINER and ARABIC.match(before) and ARABIC.match(after):
            out.append(c)
        elif c == JOINER and before == "ه" and not after.isalpha() or c == SELECTOR and after == "\u20e3":
            out.append(c)
        elif (p := ord(c)) >= 0x20000 or tables()[0][p] != HIDDEN:
            out.append(unicodedata.normalize("NFKC", c) if is_style(c) else c)
    return unicodedata.normalize("NFC", "".join(out))


def by_table(token: str) -> str:
    """The token's usual form by table alone."""
    plain = visible_form(token)
    letters = [(c, script_of(c)) for c in plain if c.isalpha()]
    count: dict[str, int] = {}
    for _, s in letters:
        count[s] = count.get(s, 0) + 1
    if len(count) < 2:
        return plain
    # first an alphabet in which all are ordinary letters of the corpus's languages, then the one of most letters
    turned = {s: [c if own == s else looks().get(s, {}).get(c) for c, own in letters] for s in count}
    for main in sorted(count, key=lambda s: (not all(c and c.lower() in ORDINARY.get(s, "") for c in turned[s]), -count[s], s == "LATIN", s)):
        turn = looks().get(main, {})
        if None not in turned[main]:
            return "".join(c if not c.isalpha() or script_of(c) == main else turn[c] for c in plain)
    return plain


def skeleton(token: str) -> str:
    """What a token looks like: letters without accents, each by the representative of its look."""
    plain = unicodedata.normalize("NFD", visible_form(token).replace(PERSIAN_JOINER, ""))
    turn = look_class()
    return "".join(turn.get(c, c) for c in plain if unicodedata.category(c) != "Mn")


def is_odd(token: str) -> bool:
    return visible_form(token) != token or len({script_of(c) for c in token if c.isalpha()}) > 1


#: What an edit costs: a letter for one of the same look, and what nobody sees, nothing; inside a word a letter of
#: another alphabet without a listed look, half; anything else, one. A word within `ACCEPTED` is taken.
FOREIGN, OTHER, ACCEPTED = 0.5, 1.0, 0.5


@lru_cache(maxsize=1 << 16)
def _parts(c: str) -> str:
    """The usual letters and accents that a character shows."""
    return unicodedata.normalize("NFD", unicodedata.normalize("NFKC", c) if is_style(c) else c)


@lru_cache(maxsize=1 << 16)
def _script(c: str) -> str:
    return script_of(c) if c.isalpha() else ""


class Trie:
    """Words with counts, walked by a weighted edit automaton; letters and their accents are steps of their own."""

    def __init__(self) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.word: list[tuple[int, str] | None] = [None]

    def add(self, word: str, count: int) -> None:
        node = 0
        for c in unicodedata.normalize("NFD", word):
            if c not in self.children[node]:
                self.children[node][c] = len(self.children)
                self.children.append({})
                self.word.append(None)
            node = self.children[node][c]
        self.word[node] = (count, word)

    def cheapest(self, token: str, most: float = ACCEPTED) -> tuple[float, str] | None:
        """(cost, word) of the cheapest word within `most`; of equal ones the most frequent, then the smallest."""
        turn = look_class()

        def inserted(states: dict[int, float]) -> dict[int, float]:
            stack = list(states) if most >= OTHER else []
            while stack:
                node = stack.pop()
                if (cost := states[node] + OTHER) <= most:
                    for child in self.children[node].values():
                        if cost < states.get(child, most + 1):
                            states[child] = cost
                            stack.append(child)
            return states

        states: dict[int, float] = inserted({0: 0.0})
        steps = [p for c in token for p in _parts(c)]
        for i, c in enumerate(steps):
            if _hidden(c):
                continue  # costs nothing and leads nowhere
            look, script, inside = turn.get(c, c), _script(c), 0 < i < len(steps) - 1
            after: dict[int, float] = {}
            for node, cost in states.items():
                if cost + OTHER <= most:
                    after[node] = min(after.get(node, most + 1), cost + OTHER)
                for d, child in self.children[node].items():
                    if d == c or turn.get(d, d) == look:
                        new = cost
                    else:
                        new = cost + (FOREIGN if inside and script and (other := _script(d)) and other != script else OTHER)
                    if new <= most and new < after.get(child, most + 1):
                        after[child] = new
            states = inserted(after)
            if not states:
                return None
        found = [(cost, -self.word[n][0], self.word[n][1]) for n, cost in states.items() if self.word[n]]
        return (min(found)[0], min(found)[2]) if found else None


def _hidden(c: str) -> bool:
    return c != PERSIAN_JOINER and ((p := ord(c)) >= 0xE0000 or p < 0x20000 and tables()[0][p] == HIDDEN)


def meeting(look: str) -> str:
    """Where a token meets the words that it may be: by number of letters, the first two and the last."""
    return f"{len(look)}{look[:2]}{look[-1:]}"


def _observe(texts: pa.Array, ids: list, skip: np.ndarray) -> tuple[list[tuple[int, str]], list[tuple[str, int]]]:
    """((id, odd token) ..., (clean word, count) ...) of a batch; rows in `skip` give no odd tokens."""
    odd, sort, script = tables()
    points, offsets = flatten(texts)
    size, rows = len(points), len(ids)
    if not size:
        return [], []
    low = np.minimum(points, 0x1FFFF)
    what, kind = odd[low], sort[low]
    what[points >= 0xE0000] = HIDDEN
    row_of = np.repeat(np.arange(rows, dtype=np.int32), np.diff(offsets))
    flagged = np.bincount(row_of[what > 0], minlength=rows) > 0
    seen = (what != HIDDEN) & (what != ACCENT)
    scripts, row_seen = script[low[seen]], row_of[seen]
    mixed = (scripts[1:] != scripts[:-1]) & (scripts[1:] > 0) & (scripts[:-1] > 0) & (row_seen[1:] == row_seen[:-1])
    flagged[row_seen[1:][mixed]] = True
    found: list[tuple[int, str]] = []
    for i in np.flatnonzero(flagged & ~skip):
        text = points[offsets[i] : offsets[i + 1]].tobytes().decode("utf-32-le")
        tokens = {t for t in TOKEN.findall(text) if is_odd(t)} | set(ODD_SPACE.findall(text))
        found += [(ids[i], t) for t in tokens]
    # distinct clean words: runs of letters of one script in rows without anything odd
    inside = (kind == LETTER) & ~flagged[row_of]
    first = np.zeros(size + 1, bool)
    first[offsets] = True
    begin = np.flatnonzero(inside & ~(np.append(False, inside[:-1])[:size] & ~first[:-1]))
    end = np.flatnonzero(inside & ~(np.append(inside[1:], False) & ~first[1:])) + 1
    hashes = quality.word_hashes(points, begin, end)
    _, at, n = np.unique(hashes, return_index=True, return_counts=True)
    words = [(points[begin[i] : end[i]].tobytes().decode("utf-32-le"), k) for i, k in zip(at.tolist(), n.tolist()) if end[i] - begin[i] > 1]
    return found, words


def observations(df: DataFrame, tab: str, key: str, text: str, skip_junk: bool) -> DataFrame:
    """(tab, row_id, token, look, n, canonical): odd tokens with their row, clean words with a null row and their count in a batch.

    canonical is filled where no word is needed to tell it: for odd spaces. look is where a token meets words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "t", 1 << 20):
                kinds = quality.kinds_of(batch.column("t")) if skip_junk else np.full(batch.num_rows, None)
                found, words = _observe(batch.column("t"), batch.column("k").to_pylist(), kinds == "junk")
                tokens = [t for _, t in found] + [w for w, _ in words]
                columns = [pa.array([k for k, _ in found] + [None] * len(words), pa.int64()), pa.array(tokens, pa.string()), pa.array([skeleton_of(t) for t in tokens], pa.string())]
                # what kind of space it is needs no word
                plain = pa.array([" " if ODD_SPACE.fullmatch(t) else None for t, _ in zip((t for _, t in found), found)] + [None] * len(words), pa.string())
                yield pa.RecordBatch.from_arrays([*columns, pa.array([1] * len(found) + [n for _, n in words], pa.int64()), plain], ["row_id", "token", "look", "n", "canonical"])

    narrow = df.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    return narrow.mapInArrow(run, "row_id long, token string, look string, n long, canonical string").withColumn("tab", F.lit(tab))


@lru_cache(maxsize=1 << 17)
def skeleton_of(token: str) -> str:
    return meeting(skeleton(token))


def spellings(seen: DataFrame) -> DataFrame:
    """(token, canonical) of each distinct odd token among `seen` that isn't told yet.

    Words and tokens that may be the same meet in one partition, after equal ones have been counted together.
    """
    counts = seen.filter("canonical is null").groupBy("look", "token", F.col("row_id").isNull().alias("clean")).agg(F.sum("n").alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look, trie, words, tokens = None, None, [], []

        def settle() -> list[tuple[str, str]]:
            if not tokens:
                return []
            trie = Trie()
            for w, n in words:
                trie.add(w, n)
            return [(t, (trie.cheapest(t) or (0, by_table(t)))[1]) for t in tokens]

        for batch in batches:
            out: list[tuple[str, str]] = []
            for a, token, clean, n in zip(*(batch.column(c).to_pylist() for c in ("look", "token", "clean", "n"))):
                if a != look:
                    out += settle()
                    look, words, tokens = a, [], []
                if clean:
                    words.append((token, n))
                else:
                    tokens.append(token)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.string()), pa.array([y for _, y in out], pa.string())], ["token", "canonical"])
        out = settle()
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.string()), pa.array([y for _, y in out], pa.string())], ["token", "canonical"])

    grouped = counts.repartition("look").sortWithinPartitions("look", F.desc("clean"), "token")
    return grouped.mapInArrow(run, "token string, canonical string")


def altered_tokens(seen: DataFrame) -> DataFrame:
    """(tab, row_id, token, canonical) of every odd token whose canonical spelling differs.

    Each token stands once on one side of the join, so a token that very many rows hold is split by
    the adaptive execution (or the other side is small, and broadcast); odd spaces, the commonest, aren't joined.
    """
    changed = spellings(seen).filter("token <> canonical")
    rows = seen.filter("row_id is not null")
    asked = rows.filter("canonical is null").drop("canonical").join(changed, "token")
    return asked.select("tab", "row_id", "token", "canonical").unionByName(rows.filter("canonical is not null").select("tab", "row_id", "token", "canonical"))


def _rewrite(text: str, turn: dict[str, str]) -> str:
    text = TOKEN.sub(lambda m: turn.get(m[0], m[0]), text)
    return ODD_SPACE.sub(lambda m: turn.get(m[0], m[0]), text)


def canonical_texts(df: DataFrame, tab: str, key: str, text: str, altered: DataFrame) -> DataFrame:
    """(tab, row_id, text, altered): every row's text in one form; only altered rows are rewritten."""
    maps = altered.filter(F.col("tab") == tab).groupBy("row_id").agg(F.map_from_entries(F.collect_set(F.struct("token", "canonical"))).alias("turn"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns = batch.column("turn").to_pylist()
            texts = batch.column("text").to_pylist()
            new = [_rewrite(t, dict(m)) if m and t else t for t, m in zip(texts, turns)]
            yield pa.RecordBatch.from_arrays([batch.column("row_id"), pa.array(new, pa.string()), pa.array([bool(m) for m in turns])], ["row_id", "text", "altered"])

    rows = df.select(F.col(key).cast("long").alias("row_id"), F.col(text).cast("string").alias("text")).join(maps, "row_id", "left")
    return rows.mapInArrow(run, "row_id long, text string, altered boolean").select(F.lit(tab).alias("tab"), "row_id", "text", "altered")
