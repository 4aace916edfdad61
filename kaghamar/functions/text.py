"""Scalar text transforms as Column expressions; all of them stay inside code generation.

Python's notion of white space is spelled out as one class, because Java's \\s and trim() only know
ASCII; regular expressions that use `.` or anchors carry (?d), so that only \\n ends a line.
"""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space as Python's str.strip() and \s see it.
WS_CHARS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WS = f"[{WS_CHARS}]"
#: Characters that cleaning keeps.
CLEAN_KEEP = r"\u0530-\u058F\uFB13-\uFB17 \n\t.,;:!?\-()\"'0-9"
#: Letters of the two Armenian ranges (their punctuation is no letter).
SCRIPT_LETTERS = r"\u0531-\u0556\u0559\u0560-\u0588\uFB13-\uFB17"
#: Substrings that betray broken translations.
ARTIFACTS = ("<unk>", "[unk]", "[UNK]", "<|", "|>", "{{", "}}", "[[", "]]")
#: Substrings that keep a pair from the chat set.
BLOCKLIST = ("kill", "murder", "suicide", "drug", "cocaine", "heroin", "sex", "porn", "nude", "violent", "torture", "weapon", "bomb", "terrorist", "hack someone", "steal")
#: Tags of the chat format.
USER, ASSISTANT, END = "<|user|>", "<|assistant|>", "<|end|>"
#: What redirect pages begin with.
REDIRECTS = ("#REDIRECT", "#ՎԵՐԱՀՂՈՒՄ")
#: Marks of transient service errors.
TRANSIENT = ("rate", "429", "overloaded", "busy", "500", "502", "503", "504", "inference error", "timeout")
#: Wiki markup rules in their order, as (pattern, replacement); groups are written $1.
WIKI_RULES = (
    (r"<[^>]+>", ""),
    (r"\{\{[^}]*\}\}", ""),
    (r"\[\[(?:[^|\]]*\|)?([^\]]*)\]\]", "$1"),
    (rf"\[https?://[^{WS_CHARS}]+{WS}*([^\]]*)\]", "$1"),
    (r"\[\[(?:Категория|Category|Պատկdelays|File|Файл|Image):[^\]]*\]\]", ""),
    (r"'{2,}", ""),
    (r"(?d)={2,}(.+?)={2,}", "$1"),
    (r"(?ds)<ref[^>]*>.*?</ref>", ""),
    (r"<ref[^/]*/?>", ""),
    (r"&[a-zA-Z]+;", " "),
    (r"&#[0-9]+;", " "),
    (r"(?ds)\{\|.*?\|\}", ""),
    (rf"(?dm)^{WS}*[|!].*$", ""),
    (r"\n{3,}", "\n\n"),
    (rf"(?dm)^{WS}*[*#:;]+{WS}*$", ""),
)


def strip(c: Column) -> Column:
    """Python's str.strip()."""
    return F.regexp_replace(c, rf"^{WS}+|{WS}+\z", "")


def ws_clean(c: Column) -> Column:
    """Runs of white space as one space, none at the ends; null as empty."""
    return strip(F.regexp_replace(F.coalesce(c, F.lit("")), f"{WS}+", " "))


def norm_key(c: Column) -> Column:
    """The key that instructions are compared by."""
    return F.lower(ws_clean(c))


@F.arrow_udf(StringType())
def composed(s: pa.Array) -> pa.Array:
    """Canonical composition (NFC), for which Spark has no built-in."""
    return pa.array([t if t is None or t.isascii() else unicodedata.normalize("NFC", t) for t in s.to_pylist()], pa.string())


def clean_chunk(c: Column, keep: str = CLEAN_KEEP) -> Column:
    """Compose, delete what `keep` doesn't list (neighbours fuse), collapse blanks and blank lines, strip.

    Of the default characters, composition only makes the Greek question mark a semicolon, so that
    stays inside code generation; for others the whole text is composed.
    """
    c = F.translate(c, "\u037e", ";") if keep == CLEAN_KEEP else composed(c)
    # joining the runs to keep is over ten times faster than replacing one character at a time
    c = F.array_join(F.regexp_extract_all(c, F.lit(f"[{keep}]+"), F.lit(0)), "")
    return strip(F.regexp_replace(F.regexp_replace(c, r"[ \t]+", " "), r"\n{3,}", "\n\n"))


def script_ratio(c: Column, letters: str = SCRIPT_LETTERS) -> Column:
    """Share of a script's letters among all letters; 0 without letters."""
    total = F.regexp_count(c, F.lit(r"\p{L}"))
    return F.when(total > 0, F.regexp_count(c, F.lit(f"[{letters}]")) / total).otherwise(F.lit(0.0))


def strip_wiki_markup(c: Column) -> Column:
    for pattern, into in WIKI_RULES:
        c = F.regexp_replace(c, pattern, into)
    return strip(c)


@F.pandas_udf(StringType())
def unescape_html(s: pd.Series) -> pd.Series:
    """All named and numbered entities; Spark has no built-in for them."""
    return s.map(html.unescape, na_action="ignore")


def strip_legal_html(c: Column) -> Column:
    """Entities first, then line breaks, paragraph ends, tags, blanks and blank lines."""
    c = F.regexp_replace(F.regexp_replace(unescape_html(c), r"(?i)<br\s*/?>", "\n"), r"(?i)</p>", "\n\n")
    c = F.regexp_replace(F.regexp_replace(c, r"<[^>]+>", ""), r"[ \t]+", " ")
    return strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def any_of(c: Column, substrings: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for s in substrings:
        out = out | c.contains(s)
    return out


def starts_with_any(c: Column, prefixes: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for s in prefixes:
        out = out | c.startswith(s)
    return out


def is_redirect(c: Column) -> Column:
    return starts_with_any(c, REDIRECTS)


def is_transient_error(c: Column) -> Column:
    return any_of(F.lower(c), TRANSIENT)


def is_data_file(c: Column) -> Column:
    """JSON files other than progress sidecars."""
    return c.endswith(".json") & ~c.endswith("_progress.json")


#: The fence before and after a whole response.
FENCE_OPEN, FENCE_CLOSE = rf"^```(?:jsonl?)?{WS}*\n?", rf"\n?```{WS}*\z"


def strip_fences(c: Column) -> Column:
    """Without a code fence around the whole text, if it begins with one."""
    inner = F.regexp_replace(F.regexp_replace(strip(c), FENCE_OPEN, ""), FENCE_CLOSE, "")
    return F.when(strip(c).startswith("```"), strip(inner)).otherwise(strip(c))


def fenced_part(c: Column) -> Column:
    """What stands between the first two fences, without a language name; the text itself if there are none."""
    part = F.try_element_at(F.split(c, "```"), F.lit(2))
    return strip(F.when(c.contains("```"), F.regexp_replace(part, "^json", "")).otherwise(c))


def share_percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, 0 where there is nothing."""
    return F.when(whole > 0, F.round(part / whole * 100, 1)).otherwise(F.lit(0.0))


def clock(seconds: Column) -> Column:
    """hh:mm:ss."""
    s = seconds.cast("long")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60)


def minutes(seconds: Column) -> Column:
    """3m07s."""
    s = seconds.cast("long")
    return F.format_string("%dm%02ds", F.floor(s / 60), s % 60)
