"""Defects of prompt and response pairs.

A suffix automaton of the prompt's words is walked with the response's words: the runs it can follow
are copied, and what they leave tells a copy from an answer that repeats the question first. Refusals
are found by an Aho-Corasick automaton of first-person phrases, broken ends by a stack of delimiters
and the shape of the last line, and the language by votes of stopwords and letters.

Defined results: a null or blank output is `empty` and nothing else; a null instruction is taken as
empty, so it can neither be copied nor ask for a language; repeated rows each have their defects; a
copy that reaches the prompt's last word isn't `truncated`.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Stand-ins for no value, in small letters.
NO_VALUE = {"null", "none", "nan", "na", "nil", "undefined", "nulltext", "empty", "չկա", "դատարկ", "нет", "пусто", "tbd", "todo"}
#: First-person phrases that decline, as runs of small words without marks.
REFUSALS = """
չեմ կարող պատասխանել; չեմ կարող կատարել; չեմ կարող օգնել; տեղեկություն տալ չեմ կարող; չեմ կարող տրամադրել; չեմ կարող տեղեկություն; չեմ կարող քննարկել; չեմ կարող գրել; չեմ կարող ասել;
իրավունք չունեմ օգնելու; իրավունք չունեմ; ստիպված եմ հրաժարվել; ստիպված եմ մերժել; հրաժարվում եմ պատասխանել; հնարավորություններից դուրս է; պատասխանել չեմ կարող; չեմ կարողանա; ի վիճակի չեմ; լեզվական մոդել բայց;
չեմ ցանկանում խոսել; չեմ ցանկանում պատասխանել; չեմ ուզում պատասխանել; չեմ պատասխանի այդ; չեմ պատասխանի այս; չեմ պատասխանելու; նախընտրում եմ չպատասխանել; նախընտրում եմ չխոսել; կխուսափեմ պատասխանել; կխուսափեմ պատասխանելուց; մերժում եմ; չեմ կարող աջակցել; չեմ կարող մասնակցել; չեմ կարող բավարարել; չեմ կարող կիսվել;
не могу ответить; не могу помочь; не вправе; помочь с этим запросом не получится; не получится помочь; вынужден отказать; вынуждена отказать; не могу обсуждать; не могу предоставить; не могу выполнить; отказываюсь отвечать; не буду отвечать; не стану отвечать; не хочу отвечать; предпочитаю не отвечать; не могу говорить об; не могу рассказать; не могу поделиться; не могу написать; не смогу ответить; не смогу помочь;
i cannot help; i cant help; i can not help; cannot help with; i cannot answer; i cant answer; i am not able to; im not able to; i am unable to; im unable to; i must decline; decline to discuss; against my guidelines; i cannot provide; i cant provide; i cannot assist; i cant assist; i wont be able to; i refuse to; i cannot do that; i cant do that; i cannot discuss; i cant discuss; i cannot share; i cant share; i cannot write; i cant write; i will not answer; i wont answer; i would rather not; id rather not; i cannot fulfill; i cant fulfill; i cannot comply; i cant comply;
je ne peux pas répondre; je ne suis pas en mesure; je refuse de; je préfère ne pas; je ne répondrai pas; ich kann nicht antworten; ich möchte nicht antworten; ich kann das nicht; ich darf nicht; das kann ich nicht beantworten; не буду відповідати; ich kann dabei nicht helfen; ich muss ablehnen; не можу відповісти; не можу допомогти
"""
#: Runs of small words after which an ellipsis stands for more of the same.
WHOLE_ELLIPSES = (" և այլն", " եւ այլն", " և այլք", " и так далее", " и тому подобное", " и т д", " and so on", " and so forth", " etc", " et cetera", " und so weiter", " usw")
ASKS = regex.compile(r"\b(?!հայ)\p{Armenian}{2,}եր[եէ]ն\b|\b(?:in|into|to) (?:English|Russian|French|German|Persian|Georgian|Ukrainian|Spanish|Latin|Greek)\b|по-?(?:русски|английски|французски|немецки)|на (?:русск|английск|французск|немецк)\w+", regex.I)
STOPWORDS = {
    "hy": "և է էր են որ այդ իսկ քանի երբ ապա եթե պետք ավելի քան մինչև ըստ թե այն այս մի ու բայց սակայն որպեսզի թեև ուստի որովհետև մասին համար իր նա ես դու այո ոչ ev e er en or ayd isk qani erb apa ete petq aveli qan minchev yst te ayn ays mi bayc sakayn orpeszi teev usti orovhetev masin hamar ayo voch och",
    "ru": "и в на не что как по с за из этот он она это для но а к у же его ее все также или чтобы однако",
    "uk": "і й та у що як з до про від але або вона він коли",
    "en": "the a an of and in to is was that by for with on as it at from but or not are were be this which after before",
    "fr": "le la les de des et un une dans est que du au aux pour par sur ne pas il elle mais ou avec ce cette qui",
    "de": "der die das und ein eine den von mit ist dem im zu auf für des nicht sich als auch es aber oder",
    "fa": "و در به از که این را با است آن بر یک برای تا هم بود شد",
    "ka": "და არის რომ ეს იყო თუ არ მაგრამ ან როგორც",
}
VOTE = {w: tuple(lang for lang, words in STOPWORDS.items() if w in words.split()) for w in {w for words in STOPWORDS.values() for w in words.split()}}
WORD = regex.compile(r"[\p{L}\p{N}]+")
INSIDE = regex.compile(r"[\p{Cf}\p{M}՛՞՜՚'’‘]")
OPENERS, CLOSERS = "«([{„“", "»)]}”"
MATES = {")": "(", "]": "[", "}": "{", "»": "«"}
TERMINATORS = "։.!?:…؟。"
ENUMERATOR = regex.compile(r"(?:^|\n)[ \t]*(?:\d+[.)]|[-*•–])?[ \t]*(?:\*\*|__|\*)?[ \t]*$")
VERBS = frozenset("է էր են էին եմ ես եք ենք կա կան չէ չեն e er en ein is are was were has had est sont ist sind есть был была".split())
#: Words before a copy that still count as a lead-in, and words of a list entry or a short answer.
LEAD_IN, ENTRY, SHORT = 6, 5, 7
#: Words beside the sentences that decline, or excuse it, from which on an answer is one all the same.
REST = 40
#: Words of sentences that only excuse, explain or soften a refusal.
EXCUSES = regex.compile(r"\b(?:sorry|apologi[sz]e|unfortunately|guidelines?|policy|policies|language model|as an ai|consult|because|understand|instead|ներող\w*|ցավում|ցավոք|որովհետև|քանի որ|ուղեցույց\w*|կանոններ\w*|լեզվական մոդել\w*|արհեստական բանականություն\w*|դիմե՛?ք|խորհուրդ եմ տալիս|փոխարեն|հասկանում եմ|извин\w*|к сожалению|потому что|поскольку|правил\w*|языков\w+ модел\w+|обратитесь|вместо этого|понимаю|désolée?|malheureusement|leider|entschuldig\w*)\b", regex.I)
SENTENCE = regex.compile(r"(?<=[։!?…؟。\n]|\.(?=\s))")


def words_of(text: str) -> list[str]:
    """Small words of letters and digits; marks written inside words and ignorables don't part them."""
    text = unicodedata.normalize("NFKC", INSIDE.sub("", text)) if not text.isascii() else INSIDE.sub("", text)
    return WORD.findall(text.lower().replace("-\n", "").replace("-\r\n", ""))


class SuffixAutomaton:
    """All runs of words of a prompt."""

    def __init__(self, words: list[str]):
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        last = 0
        for w in words:
            here = len(self.next)
            self.next.append({})
            self.length.append(self.length[last] + 1)
            self.link.append(0)
            p = last
            while p >= 0 and w not in self.next[p]:
                self.next[p][w] = here
                p = self.link[p]
            if p >= 0:
                q = self.next[p][w]
                if self.length[p] + 1 == self.length[q]:
                    self.link[here] = q
                else:
                    copy = len(self.next)
                    self.next.append(dict(self.next[q]))
                    self.length.append(self.length[p] + 1)
                    self.link.append(self.link[q])
                    while p >= 0 and self.next[p].get(w) == q:
                        self.next[p][w] = copy
                        p = self.link[p]
                    self.link[q] = self.link[here] = copy
            last = here

    def covered(self, words: list[str], least: int) -> list[bool]:
        """Which words lie in a run of at least `least` words that the prompt holds."""
        out = [False] * len(words)
        state = run = 0
        for i, w in enumerate(words):
            while state and w not in self.next[state]:
                state = self.link[state]
                run = self.length[state]
            if w in self.next[state]:
                state = self.next[state][w]
                run += 1
            else:
                state = run = 0
            if run >= least:
                out[i - run + 1 : i + 1] = [True] * run
        return out


def copies(prompt: list[str], answer: list[str]) -> bool:
    """Whether the answer is the prompt again, a lead-in and repetition aside."""
    if not prompt or not answer or len(answer) < 0.6 * len(prompt):
        return False
    if len(set(answer) & set(prompt)) < 0.5 * len(set(prompt)):
        return False
    hit = SuffixAutomaton(prompt).covered(answer, min(3, len(prompt)))
    if sum(hit) < 0.8 * len(prompt):
        return False
    first = hit.index(True)
    inside = hit[first:].count(False)
    return first <= LEAD_IN and hit[-1] and inside <= 0.1 * sum(hit)


@lru_cache(maxsize=1)
def refusal_automaton() -> ahocorasick.Automaton:
    tool = ahocorasick.Automaton()
    for phrase in REFUSALS.replace("\n", " ").split(";"):
        if phrase.strip():
            tool.add_word(f" {phrase.strip()} ", phrase.strip())
    tool.make_automaton()
    return tool


def refuses(text: str, answer: list[str]) -> bool:
    """Whether the answer, all of it but a few words beside the sentences that decline or excuse it, declines."""
    declines = lambda words: next(refusal_automaton().iter(" " + " ".join(words) + " "), None) is not None
    if not declines(answer):
        return False
    if len(answer) <= REST:
        return True
    rest, declined = 0, False
    for sentence in SENTENCE.split(text):
        words = words_of(sentence)
        if declines(words):
            declined = True
        elif not EXCUSES.search(INSIDE.sub("", sentence)):
            rest += len(words)
    return declined and rest <= REST


def is_list(text: str) -> bool:
    """Several short entries, on lines or between commas, and no verb."""
    parts = [p for line in text.split("\n") for p in line.split(",") if p.strip()]
    return len(parts) >= 2 and all(0 < len(w := words_of(p)) <= ENTRY and not VERBS & set(w) for p in parts)


def trails_off(text: str, answer: list[str]) -> bool:
    """Whether an ellipsis ends what is whole: a list that goes on, or a short sentence whose predicate has its complement.

    Such a sentence has a verb, and its last word is a noun in the ablative or instrumental; one that
    breaks off ends in a word that another must follow, or in a long train of clauses.
    """
    if (" " + " ".join(answer[-4:])).endswith(WHOLE_ELLIPSES):
        return True
    sentences = [s for s in SENTENCE.split(text.rstrip(" .…")) if s.strip()]
    last = words_of(sentences[-1]) if sentences else []
    return 3 <= len(last) <= ENTRY and bool(VERBS & set(last[:-1])) and last[-1].endswith(("ից", "ով"))


def truncated(text: str, answer: list[str]) -> bool:
    """Whether the text breaks off before its last sentence, quotation, entry or word is complete."""
    text = text.rstrip().rstrip("​‎⁠﻿").rstrip()
    stack: list[str] = []
    for c in text:
        if c in "«([{":
            stack.append(c)
        elif c in MATES and MATES[c] in stack:
            while stack.pop() != MATES[c]:
                pass
    if stack or text.count("**") % 2 or text.count("```") % 2 or text.count("“") + text.count("„") > text.count("”") + text.count("“") * ("„" in text) or text.count('"') % 2:
        return True
    last_line = text.rsplit("\n", 1)[-1]
    if text.count("\n") and ENUMERATOR.match(last_line):
        return not last_line.strip(" \t—–-*_") == "" or last_line.strip() in ("*", "-", "•")
    body = text.rstrip(" \t\n\r—–*_")
    if text.endswith(("-", "‐")) and body == text.rstrip(" \t\n\r—–*_") and not text.endswith((" -", "\n-")):
        return True
    if not body:
        return False
    tail = body[-1]
    if tail in ",;՝՛،" or tail in OPENERS:
        return True
    if body.endswith(("…", "...")) and not body.endswith(("։...", "....", "։…")):
        return not trails_off(body, answer)
    if tail in TERMINATORS or tail in CLOSERS + "\"'’”":
        return False
    if is_list(body):
        return False
    return len(answer) > SHORT or bool(VERBS & set(answer)) or any(c in TERMINATORS for c in body[:-1] if c != ".")


def other_language(text: str, answer: list[str], prompt: str) -> bool:
    """Whether the answer, a short lead-in aside, is in another language that nobody asked for."""
    if ASKS.search(prompt):
        return False
    votes: dict[str, float] = {}
    foreign = letters = 0
    for i, w in enumerate(answer):
        if not w[0].isalpha():
            continue
        armenian = "ԱԲ"[0] <= w[0].upper() <= "Ֆ" or w[0] == "և"
        letters += 1
        foreign += not armenian
        for lang in VOTE.get(w, ()):
            votes[lang] = votes.get(lang, 0) + 1 / len(VOTE[w])
    if letters < 3 or foreign <= 0.5 * letters:
        return False
    native, best = votes.get("hy", 0), max((v for k, v in votes.items() if k != "hy"), default=0)
    latin = sum(1 for w in answer if w[0].isascii() and w[0].isalpha())
    return not (latin > 0.5 * letters and native > best)


def defects(instruction: str | None, output: str | None) -> list[str]:
    """The defects of one pair."""
    plain = output or ""
    answer = words_of(plain)
    if not answer or " ".join(answer) in NO_VALUE or "".join(answer) in NO_VALUE and len(answer) <= 2:
        return ["empty"]
    prompt_text = instruction or ""
    found = []
    prompt = words_of(prompt_text)
    copied = copies(prompt, answer)
    if refuses(plain, answer):
        found.append("refusal")
    if copied:
        found.append("copies_question")
    if truncated(plain, answer) and not (copied and answer[-1] == prompt[-1]):
        found.append("truncated")
    if other_language(plain, answer, prompt_text):
        found.append("other_language")
    return found


def pair_defects(df: DataFrame, key: str = "pair_id", instruction: str = "instruction", output: str = "output") -> DataFrame:
    """(key, defect): one row per defect of each pair; a narrow pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, out = batch.column("k").to_pylist(), []
            for k, a, b in zip(keys, batch.column("i").to_pylist(), batch.column("o").to_pylist()):
                out += [(k, d) for d in defects(a, b)]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.int64()), pa.array([d for _, d in out], pa.string())], ["k", "defect"])

    narrow = df.select(F.col(key).cast("long").alias("k"), F.col(instruction).cast("string").alias("i"), F.col(output).cast("string").alias("o"))
    return narrow.mapInArrow(run, "k long, defect string").withColumnRenamed("k", key)
