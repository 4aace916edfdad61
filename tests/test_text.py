"""Scalar transforms against plain Python."""

import html
import random
import re
import unicodedata

from pyspark.sql import functions as F

from kaghamar.functions import text as X

ALPHABET = list("abԱբգև՞։ .,;!?-\t\n\r0") + ["\x85", "\xa0", " ", " ", " ", "　", "\x1c", ";", "ﬓ", "«", "́", "[", "]", "|", "{", "}", "'", "=", "&", "<", ">", "#", "*"]


def texts(n=400, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 40))) for _ in range(n)] + ["", None, "a" * 50_000]


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r["o"] for r in df.select("i", expression(F.col("t")).alias("o")).orderBy("i").collect()]


def test_strip_and_ws_clean_follow_python(spark):
    values = texts()
    assert column(spark, values, X.strip) == [v.strip() if v is not None else None for v in values]
    assert column(spark, values, X.ws_clean) == [re.sub(r"\s+", " ", v or "").strip() for v in values]


def test_clean_chunk_follows_python(spark):
    def plain(t):
        t = unicodedata.normalize("NFC", t)
        t = re.sub(r"[^԰-֏ﬓ-ﬗ \n\t.,;:!?\-()\"'0-9]", "", t)
        return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", t)).strip()

    values = texts(seed=2)
    assert column(spark, values, X.clean_chunk) == [plain(v) if v is not None else None for v in values]


def test_script_ratio(spark):
    assert column(spark, ["Աբ ab", "", "123", "աբգ։", None], X.script_ratio) == [0.5, 0.0, 0.0, 1.0, 0.0]


def test_legal_html(spark):
    values = ["&lt;b&gt;x&lt;/b&gt;&nbsp;y<br/>z</p>w", "&#171;ա&#187;", None, ""]
    assert column(spark, values, X.strip_legal_html) == ["x\xa0y\nz\n\nw", "«ա»", None, ""]


def test_wiki_markup(spark):
    values = ["'''Ա''' [[b|c]] [[d]] {{t}} &nbsp;x", "== Գլուխ ==\n* \nտեքստ\n| a\n", "[https://a.b c d]", "a<ref>b</ref>", None]
    assert column(spark, values, X.strip_wiki_markup) == ["Ա c d   x", "Գլուխ \n\nտեքստ", "c d", "ab", None]


def test_predicates_and_formats(spark):
    assert column(spark, ["#REDIRECT x", "#redirect", "#ՎԵՐԱՀՂՈՒՄ y", None], X.is_redirect) == [True, False, True, None]
    assert column(spark, ["a.json", "a_progress.json", "a.txt"], X.is_data_file) == [True, False, False]
    assert column(spark, ["HTTP 503", "Rate limit", "bad key"], X.is_transient_error) == [True, True, False]
    assert column(spark, ["```json\n[1]\n```", "[1]", " x "], X.strip_fences) == ["[1]", "[1]", "x"]
    assert column(spark, ["a```json[1]```b", "x"], X.fenced_part) == ["[1]", "x"]
    assert column(spark, ["3725", "59"], lambda c: X.clock(c.cast("int"))) == ["01:02:05", "00:00:59"]
    assert column(spark, ["67"], lambda c: X.minutes(c.cast("int"))) == ["1m07s"]
    assert column(spark, ["&amp;lt;"], X.unescape_html) == [html.unescape("&amp;lt;")]
