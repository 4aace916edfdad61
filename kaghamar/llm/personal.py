"""Personal information in free text, by a linear-chain conditional random field.

Texts are cut into words, number groups, addresses of mail and web, and marks. Each token's features
tell its shape, its endings, and whether it belongs to short lists (given names, street types, words
that announce a document); a token's scores come from its own features and those of its neighbours.
The field is trained on the driver from the small labelled table of `personal_seeds`; lines are
decoded by Viterbi in numpy, many at a time. Lines in which no token's score could pay for leaving
the state "nothing" are not decoded, which changes no result. The field decides; of what it finds only
the form is checked: a name has two words, an address a house number, and so on.

Defined results: null and empty texts have no items and stay as they are; lines are counted from 0
in the text split at `\\n`, empty lines included; repeated items on a line count once per kind.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kaghamar.functions.codepoints import slices
from kaghamar.llm.langid import romanised
from kaghamar.llm.personal_seeds import GIVEN, labelled

STATES = ("nothing", "email", "phone", "identity", "address", "name")
_AT = r"(?: ?@ ?| ?[(\[{<] ?@ ?[)\]}>] ?| ?[(\[{<] ?(?:at|AT|шнік|собака|շնիկ|շուն) ?[)\]}>] ?| (?:собака|շնիկ) )"
_DOT = r"(?:\.| ?[(\[{] ?(?:dot|DOT|точка|կետ) ?[)\]}] ?)"
MAIL = rf"[A-Za-z0-9][\w.+\-]*{_AT}[A-Za-z0-9\-]+(?:{_DOT}[A-Za-z0-9\-]+)+|[A-Za-z0-9][\w.+\-]*(?:{_AT}| (?:at|AT) (?!(?:the|an?|this|that|every|each|one|your|my|our|his|her|its|their) ))[A-Za-z0-9\-]+(?: (?:dot|DOT|точка|կետ) [A-Za-z0-9\-]+)+"
WEB = r"(?:https?://|www\.)\S+"
#: Numbers that can be one to call: by a country's code, in groups after a 0 with one kind of mark between, and other usual groupings.
PHONE_FORM = (
    r"(?:\+ ?\d{1,3}(?:[ .\-]?\(?\d{1,4}\)?){2,6}(?<=[\d)])|" + "|".join(rf"(?=(?:\D?\d){{9}})0\d{{1,3}}(?:{mark}\d{{2,4}}){{2,4}}" for mark in (" ", r"\.", "-"))
    + r"|\(0\d{1,4}\)[ \-]?\d{2,4}(?:[ .\-]\d{2,4}){1,3}|8[ \-]?9\d{2}[ \-]\d{3}[ \-]\d{2}[ \-]\d{2}|\+ ?\d{1,3}(?:[ \-]?\(?\d{2,4}\)?)(?:[ .\-]?\d{2,6}){1,4}|00\d{3}[\- ]\d{2}[\- ]\d{6}|0\d{8}|0\d{2}[ /]\d{2,3}[\- ]\d{2,3}(?:[\- ]\d{2})?|0\d{2}-\d{2,3}-\d{2}-\d{2}|0\d{2}-\d{3}-\d{3}|\(0\d{2}\) ?\d{2} \d{2} \d{2}|\(0\d{2}\) ?\d{3}[ \-]\d{3}|\d{3}-\d{4}|1-\d{3}-\d{3}-\d{4}|8 ?\(\d{3}\) ?\d{3}-\d{2}-\d{2}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}-\d{3}-\d{4})(?![\-/.]?\d)"
)
SOCIAL_FORM = r"(?:\d{10}|\d{5}-\d{5}|\d{4} \d{3} \d{3})(?![\-/.]?\d)"
NUMBER = rf"(?<!\d){PHONE_FORM}|(?<!\d){SOCIAL_FORM}|\d+(?:[./:\-]\d+)*"
TOKEN = re.compile(rf"\n|{WEB}|{MAIL}|{NUMBER}|[^\W\d_]+|\S")
IS_MAIL, IS_WEB = re.compile(MAIL), re.compile(WEB)
STREET = frozenset("փող փողոց փողոցի փ պողոտա պող պողոտայի նրբանցք նրբ նրբանցքի խճուղի խճուղու փակուղի հրապարակ place quai chemin impasse allée street st road rd lane avenue ave drive dr alley square boulevard blvd court ул улица улице пр проспект переулок пер шоссе бульвар набережная площадь rue straße strasse փողոցում".split())
#: Words that name a street only beside other capital words, and the endings of German street names.
STREET_CAPITAL = frozenset("crescent way terrace close gardens row circle parkway highway trail quay mews grove hill walk".split())
STREET_ENDING = re.compile(r".{3,}(?:straße|strasse|gasse|weg|allee|platz|damm|ufer)$")
HOUSE = frozenset("շենք տուն տանը թիվ բն բնակարան д дом кв квартира корпус apt flat suite house".split())
DOCUMENT = frozenset("անձնագիր անձնագրի passport паспорт паспорта հծհ համարանիշ համարանիշը սոցքարտ սոցիալական նույնականացման քարտ id соцкарты соц ssn social identity card карта համարը card номер".split())
CALLS = frozenset("հեռ հեռախոս հեռախոսահամար զանգահարեք զանգել զանգահարել телефон тел позвоните call phone tel text at mobile ext".split())
PERSON = frozenset("պարոն տիկին օրիորդ ընթերցող գնորդ հեղինակ հեղինակը պահակը ստորագրություն քաղաքացի mr mrs ms applicant tenant author for зовут спросить заявитель господин госпожа տրված contact director manager teacher guide winner singer doctor professor neighbour manager директор учитель врач автор наш տնօրեն տնօրենը ուսուցիչ ուսուցիչը բժիշկ բժիշկը დირექტორი დირექტორმა მასწავლებელი ექიმი".split())
#: What people do, of which the one who does it stands before or behind.
ACTS = frozenset("sent wrote said says told lives lived works worked signed sold bought opened showed asked answered came met won sang teaches пришёл пришла сказал сказала написал написала рассказал рассказала отправил отправила подписал подписала подготовил подготовила беседовал беседовала говорил говорила ասաց ասել պատմեց պատմել գրեց եկավ երգեց հանդես խոսեց դիմել դիմեց ապրում աշխատում წერდა დაწერა მოვიდა მუშაობს თქვა გახსნა ლაპარაკობს".split())
LITTLE = frozenset("the a an in on at of and to is was i if by for with as it not after before since every our one this yesterday early last about near le la les un une der die das ein im в на и по с около вчера после до этот наш старый новый и է և որ եթե ըստ այդ պետք ո ոչ երեկ այսօր".split())
SURNAME = re.compile(r"(?:[ա-ֆև]{3,}(?:յան|եան|յանց|ունի)(?:ի|ին|ը|ն|ից|ով|ների|ները)?|[a-z]{3,}(?:yan|ian|yants)(?:i|in|y)?|[а-яё]{3,}(?:ов|ова|ев|ева|ёв|ин|ина|ын|енко|ук|юк|чук|ский|ская|ян|янц|ич)(?:а|у|ым|ой)?|[ა-ჰ]{2,}(?:ძე|შვილი|იანი|ელი|ავა|ური)(?:მ|ს|ის)?)$")
NOT_SURNAME = re.compile(r"(?:միջնադ|վայրկ|կայան|արձան|գարնան|աշնան|ձմեռ|ամառ|շատ)")
#: Abstract nouns, times of day and place names that end like a surname are none.
ABSTRACT = re.compile(r"ությ?[եա]ն|^(?:առավոտ|երեկո|ցերեկ|գիշեր|կեսօր|օր|ամ|դար)յան|ունի")
PHONE, SOCIAL = re.compile(PHONE_FORM), re.compile(SOCIAL_FORM)


@lru_cache(maxsize=1)
def given_names() -> frozenset[str]:
    native = [x.lower() for names in GIVEN.values() for x in names.split()]
    return frozenset(native + [romanised(x).lower() for x in native if "ա" <= x[0] <= "ֆ"])


def features(token: str) -> list[str]:
    """What a token looks like; equal tokens have equal features."""
    if token == "\n":
        return ["end"]
    if IS_MAIL.fullmatch(token):
        return ["mail"]
    if IS_WEB.match(token):
        return ["web"]
    if token[0].isdigit() or token[0] in "+(" and len(token) > 1:
        digits = sum(c.isdigit() for c in token)
        out = ["number", f"digits={min(digits, 14)}"]
        if PHONE.fullmatch(token):
            out += ["phone", "phone+" if token[0] == "+" or token.startswith("00") else "phone0" if token[0] in "0(" else "phone-"]
        if SOCIAL.fullmatch(token):
            out.append("social")
        if token.isdigit():
            out.append(f"plain={min(digits, 11)}")
            if digits == 9 and token.startswith("00"):
                out.append("card")
            if digits == 7:
                out.append("seven")
        if re.fullmatch(r"\d{1,3}(?:/\d{1,3})?", token):
            out.append("house number")
        if ":" in token:
            out.append("time")
        return out
    if not token[0].isalpha():
        return ["mark", f"mark={token}"]
    low = token.lower()
    case = "caseless" if low == token.upper() else "upper" if token.isupper() and len(token) > 1 else "capital" if token[0].isupper() else "small"
    script = "arm" if "ա" <= low[0] <= "և" else "cyr" if "а" <= low[0] <= "ё" else "lat" if low[0].isascii() else "other"
    out = ["word", case, script, f"{case}-{script}"]
    for name, words in (("street", STREET), ("house", HOUSE), ("document", DOCUMENT), ("calls", CALLS), ("person", PERSON), ("little", LITTLE), ("acts", ACTS)):
        if low in words:
            out.append(name)
    if case in ("capital", "upper") and low in STREET_CAPITAL or STREET_ENDING.match(low):
        out.append("street")
    if low in given_names():
        out += ["given", f"given-{case}"]
    if SURNAME.match(low) and not NOT_SURNAME.match(low) and not ABSTRACT.search(low):
        out += ["surname", f"surname-{case}"]
    if len(token) == 1 and case != "small":
        out.append("initial")
    if len(token) == 2 and token.isascii() and token.isupper():
        out.append("series")
    if low in ("ք", "г", "քաղաք"):
        out.append("town")
    return out


NEIGHBOURS = (-3, -2, -1, 0, 1, 2)


class Field:
    """Weights of the linear-chain field: [neighbour][feature][state] and [state][state]."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        examples = []
        for text, spans in labelled():
            tokens = [(m.start(), m.end(), m[0]) for m in TOKEN.finditer(text)]
            tags = [next((STATES.index(k) for a, b, k in spans if a <= s < b), 0) for s, _, _ in tokens]
            examples.append(([[self.number.setdefault(f, len(self.number)) for f in features(t)] for _, _, t in tokens], np.array(tags)))
        size, k = len(self.number), len(STATES)
        self.weights = np.zeros((len(NEIGHBOURS), size, k))
        self.move = np.zeros((k, k))
        self._train(examples)

    def _train(self, examples: list, rounds: int = 10, rate: float = 0.25, decay: float = 1e-5) -> None:
        """Adagrad on the log-likelihood, with forward and backward sums."""
        squares, move_squares = np.full_like(self.weights, 1e-2), np.full_like(self.move, 1e-2)
        order, k = np.random.default_rng(3), len(STATES)
        flat, flat_squares = self.weights.reshape(-1, k), squares.reshape(-1, k)
        width = self.weights.shape[1]
        designs = []
        for feats, tags in examples:  # (token, weight row) of all features of all neighbours
            pairs = [(t, o * width + f) for o, d in enumerate(NEIGHBOURS) for t in range(len(tags)) if 0 <= t + d < len(tags) for f in feats[t + d]]
            at, row = np.array(pairs).T
            used, place = np.unique(row, return_inverse=True)
            design = np.zeros((len(used), len(tags)))
            np.add.at(design, (place, at), 1)
            designs.append((used, design, tags))
        for _ in range(rounds):
            for i in order.permutation(len(examples)):
                used, design, tags = designs[i]
                n = len(tags)
                score = design.T @ flat[used]
                ahead, back = np.zeros_like(score), np.zeros_like(score)
                ahead[0] = score[0]
                move = np.exp(self.move)
                for t in range(1, n):
                    top = ahead[t - 1].max()
                    ahead[t] = score[t] + top + np.log(np.exp(ahead[t - 1] - top) @ move)
                for t in range(n - 2, -1, -1):
                    m = score[t + 1] + back[t + 1]
                    top = m.max()
                    back[t] = top + np.log(move @ np.exp(m - top))
                total = np.logaddexp.reduce(ahead[-1])
                grad = -np.exp(ahead + back - total)
                grad[np.arange(n), tags] += 1
                m = (score + back)[1:]
                pair = np.exp(ahead[:-1, :, None] + self.move[None] + m[:, None, :] - total).sum(0)
                grad_move = -pair
                np.add.at(grad_move, (tags[:-1], tags[1:]), 1)
                g = design @ grad - decay * flat[used]
                flat_squares[used] += g**2
                flat[used] += rate * g / np.sqrt(flat_squares[used])
                move_squares += grad_move**2
                self.move += rate * grad_move / np.sqrt(move_squares)

    def scores(self, token: str) -> np.ndarray:
        """[neighbour, state]: what the token adds to the scores of its neighbours."""
        known = [self.number[f] for f in features(token) if f in self.number]
        return self.weights[:, known].sum(1)


class Tagger:
    """Decodes batches of texts; remembers token types up to a bound."""

    def __init__(self, field: Field, memory: int = 200_000):
        self.field, self.memory = field, memory
        self._clear()
        move = field.move
        #: The most that leaving "nothing" and coming back can gain by transitions, by whichever kinds and if only one of both happens.
        self.gain = max(0.0, float(move[0, 1:].max() - move[0, 0])) + max(0.0, float(move[1:, 0].max() - move[0, 0]))
        self.gain_inside = max(0.0, float(move[1:, 1:].max() - move[0, 0]))

    def _clear(self) -> None:
        self.number: dict[str, int] = {"\n": 0}
        self.table = [self.field.scores("\n")]
        self.cached = np.array(self.table)

    def types(self, tokens: list[str]) -> np.ndarray:
        number = self.number
        fresh = set(tokens).difference(number)
        if fresh:
            if len(number) + len(fresh) > self.memory:
                self._clear()
                number = self.number
                fresh = set(tokens)
                fresh.discard("\n")
            alike: dict[tuple, np.ndarray] = {}
            for t in fresh:
                key = tuple(features(t))
                if key not in alike:
                    alike[key] = self.field.scores(t)
                number[t] = len(self.table)
                self.table.append(alike[key])
            self.cached = np.array(self.table)
        return np.fromiter((number[t] for t in tokens), np.int64, len(tokens))

    def states(self, tokens: list[str]) -> np.ndarray:
        """The best state of each token of a stream whose lines are ended by line-break tokens."""
        kind = self.types(tokens)
        size, k = len(tokens), len(STATES)
        line_end = kind == 0
        line = np.cumsum(line_end) - line_end
        score = np.zeros((size, k))
        for o, d in enumerate(NEIGHBOURS):
            gave = self.cached[kind, o]
            if d < 0:
                same = line[:d] == line[-d:]
                score[-d:] += gave[:d] * same[:, None]
            elif d > 0:
                same = line[d:] == line[:-d]
                score[:-d] += gave[d:] * same[:, None]
            else:
                score += gave
        best = np.zeros(size, np.int8)
        margin = score[:, 1:].max(1) - score[:, 0] + self.gain_inside + self.gain
        margin[line_end] = -1
        lines = np.unique(line[margin > 0])
        begins = np.append(0, np.flatnonzero(line_end) + 1)
        ends = np.append(np.flatnonzero(line_end), size)
        begins, ends = begins[lines], ends[lines]
        length = ends - begins
        for low, high in ((1, 16), (16, 48), (48, 160), (160, 1 << 62)):
            pick = np.flatnonzero((length >= low) & (length < high))
            for some in np.array_split(pick, max(1, len(pick) * min(high, 4096) // 400_000)):
                if len(some):
                    self._viterbi(score, begins[some], length[some], best)
        return best

    def _viterbi(self, score: np.ndarray, begin: np.ndarray, length: np.ndarray, best: np.ndarray) -> None:
        order = np.argsort(-length)
        begin, length = begin[order], length[order]
        n, most, k = len(begin), int(length[0]), len(STATES)
        came = np.zeros((most, n, k), np.int8)
        now = score[begin].copy()
        final = np.zeros((n, k))
        for t in range(1, most + 1):
            active = int(np.searchsorted(-length, -t, "left"))  # lines longer than t
            final[active : len(now)] = now[active:]
            if t == most or not active:
                final[: len(now)] = np.where((length[: len(now)] <= t)[:, None], now, final[: len(now)])
                break
            step = now[:active, :, None] + self.field.move[None]
            came[t, :active] = step.argmax(1)
            now = step.max(1) + score[begin[:active] + t]
        state = final.argmax(1)
        for t in range(most - 1, -1, -1):
            active = np.flatnonzero(length > t)
            if not len(active):
                continue
            best[begin[active] + t] = state[active]
            if t:
                state[active] = came[t, active, state[active]]


def accepted(kind: str, tokens: list[str]) -> bool:
    """Whether a span that the field found has the form of its kind; whether it is one, the field has decided."""
    kinds = [features(t) for t in tokens]
    if kind == "email":
        return any(IS_MAIL.fullmatch(t) for t in tokens)
    if kind == "phone":
        return any("phone" in f for f in kinds)
    if kind == "identity":
        return any("social" in f or "card" in f for f in kinds) or any("seven" in f for f in kinds) and any("series" in f for f in kinds)
    if kind == "address":
        return any("street" in f for f in kinds) and any("house number" in f for f in kinds)
    words = [(t, f) for t, f in zip(tokens, kinds) if t[0].isalpha()]
    # words without capitals are names only if a list or a shape says so
    if len(words) < 2 or any("small" in f and "given" not in f and "surname" not in f for _, f in words) or not any(len(t) > 2 for t, _ in words):
        return False
    plain = any("small" in f for _, f in words)
    caseless = any("caseless" in f for _, f in words)
    return not plain and not caseless or any("given" in f for _, f in words) or caseless and any("surname" in f for _, f in words)


def spans(tokens: list[str], states: np.ndarray) -> Iterator[tuple[int, int, str]]:
    """(first, past the last, kind) of the accepted spans of equal states; line breaks end spans."""
    at = np.flatnonzero(states)
    i = 0
    while i < len(at):
        j = i
        while j + 1 < len(at) and at[j + 1] == at[j] + 1 and states[at[j + 1]] == states[at[i]] and tokens[at[j + 1]] != "\n":
            j += 1
        first, last, kind = int(at[i]), int(at[j]) + 1, STATES[states[at[i]]]
        if accepted(kind, tokens[first:last]):
            yield first, last, kind
        i = j + 1


@lru_cache(maxsize=1)
def trained() -> Field:
    return Field()


_taggers: dict[int, Tagger] = {}


def _tagger(field: Field) -> Tagger:
    """One tagger per worker and field, so that its memory serves all its tasks."""
    key = hash(field.move.tobytes())
    if key not in _taggers:
        _taggers.clear()
        _taggers[key] = Tagger(field)
    return _taggers[key]


def _stream(texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """The tokens of all texts, each ended by a line break, and where each text begins."""
    tokens: list[str] = []
    begins = []
    find = TOKEN.findall
    for t in texts:
        begins.append(len(tokens))
        if t:
            tokens += find(t)
        tokens.append("\n")
    return tokens, np.array([*begins, len(tokens)], np.int64)


def personal_lines(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, line_no, kind): the lines that hold an item, one row per kind; a pass without a shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = _tagger(shared.value)
        for whole in batches:
            for batch in slices(whole, "t"):
                keys, out = batch.column("k").to_pylist(), set()
                tokens, begins = _stream(batch.column("t").to_pylist())
                states = tagger.states(tokens)
                breaks = np.cumsum(np.fromiter((t == "\n" for t in tokens), np.int64, len(tokens)))
                for first, _, kind in spans(tokens, states):
                    doc = int(np.searchsorted(begins, first, "right")) - 1
                    out.add((keys[doc], int(breaks[first] - (breaks[begins[doc] - 1] if begins[doc] else 0)), kind))
                columns = list(zip(*sorted(out, key=str))) or [(), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string())], ["k", "line_no", "kind"])

    narrow = df.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    return narrow.mapInArrow(run, "k long, line_no int, kind string").withColumnRenamed("k", key)


def redact(texts: list[str | None], tagger: Tagger) -> list[str | None]:
    """The texts with [KIND] in place of each item; all are tagged as one stream."""
    places: list[tuple[int, int]] = []
    tokens: list[str] = []
    begins = [0]
    for t in texts:
        for m in TOKEN.finditer(t or ""):
            places.append(m.span())
            tokens.append(m[0])
        places.append((0, 0))
        tokens.append("\n")
        begins.append(len(tokens))
    found: dict[int, list[tuple[int, int, str]]] = {}
    for first, last, kind in spans(tokens, tagger.states(tokens)):
        found.setdefault(bisect_right(begins, first) - 1, []).append((places[first][0], places[last - 1][1], kind))
    out = list(texts)
    for i, items in found.items():
        parts, at = [], 0
        for begin, end, kind in items:
            parts += [texts[i][at:begin], f"[{kind.upper()}]"]
            at = end
        out[i] = "".join(parts) + texts[i][at:]
    return out


def redacted(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text): every row's text with typed placeholders in place of the items."""
    shared = df.sparkSession.sparkContext.broadcast(trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = _tagger(shared.value)
        for whole in batches:
            for batch in slices(whole, "t"):
                yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(redact(batch.column("t").to_pylist(), tagger), pa.string())], ["k", "t"])

    narrow = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    return narrow.mapInArrow(run, narrow.schema).select(F.col("k").alias(key), F.col("t").alias(text))
