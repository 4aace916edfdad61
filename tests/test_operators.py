"""Corpus, pair, token and metric operators on small rows."""

import math

import pytest
from pyspark.sql import functions as F

from kaghamar.operators import corpus, metrics, parsing, qa, tokens

LONG = "Սա բավական երկար պարբերություն է, որ մնա մաքրելուց հետո նույնպես։"


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_paragraphs(spark):
    df = spark.createDataFrame([(1, f"{LONG}\r\n \r\n{LONG}x\n\nkurt\n\nlast"), (2, "only"), (3, ""), (4, None), (5, "a\n\n  ")], "k int, t string")
    found = rows(corpus.paragraphs(df.filter("t is not null"), "k", "t"), "k", "pos", "paragraph")
    assert found == [(1, 0, LONG), (1, 1, LONG + "x"), (1, 3, "last"), (2, 0, "only")]


def order(spark):
    return spark.createDataFrame([("wiki", 1), ("mc4", 2), ("none", 3)], "source string, priority int")


def test_priority_dedup_and_stats(spark):
    data = [(1, "mc4", 0, LONG), (2, "wiki", 5, LONG), (3, "wiki", 6, LONG), (4, "wiki", 7, "short"), (5, "unlisted", 0, LONG), (6, None, 0, LONG), (7, "mc4", 1, None)]
    df = spark.createDataFrame(data, "para_id int, source string, pos int, text string")
    flagged = corpus.flag_paragraphs(df, order(spark), "para_id")
    assert rows(flagged, "para_id", "fate") == [(1, "duplicate"), (2, "kept"), (3, "duplicate"), (4, "short")]
    stats = corpus.source_stats(flagged, order(spark))
    assert rows(stats, "source", "status", "kept", "dropped_short", "dropped_duplicates") == [("mc4", "ok", 0, 0, 1), ("none", "missing", 0, 0, 0), ("wiki", "ok", 1, 1, 1)]
    total = corpus.totals(stats).first()
    assert (total["kept"], total["dropped_duplicates"]) == (1, 2)
    kept = corpus.flag_paragraphs(df, order(spark), "para_id", dedup=False).filter("fate = 'kept'")
    assert kept.count() == 3
    empty = corpus.source_stats(corpus.flag_paragraphs(df.limit(0), order(spark), "para_id"), order(spark))
    assert {r["status"] for r in empty.collect()} == {"missing"}


def test_sample_is_stable_and_bounded(spark):
    df = spark.range(500).select(F.col("id"), (F.col("id") % 3 == 0).alias("g"))
    a, b = (rows(corpus.sample_per_group(df.repartition(n), "g", "id", 7), "g", "id") for n in (1, 5))
    assert a == b and len(a) == 14


def test_labels(spark):
    data = [("int", None, 0), ("int", None, 3), ("int", None, 4), ("int", None, 5), ("str", "1", None), ("str", "4", None), ("str", "5", None), ("str", "0", None), ("str", "b", None), ("str", "H", None), ("str", "?", None), (None, None, None)]
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(data)], "i int, k string, s string, n int")
    place = lambda strict: [r[0] for r in df.orderBy("i").select(qa.single_label(F.col("k"), F.col("s"), F.col("n"), F.lit(4), strict)).collect()]
    assert place(False) == [0, 3, 3, None, 0, 3, None, None, 1, 7, None, None]
    assert place(True)[:4] == [None, 2, 3, None]


def test_mcq_limits(spark):
    df = spark.createDataFrame([(1, ["a ", "b"], 1), (2, ["x"] * 11, 0), (3, ["a"], 4)], "i int, c array<string>, p int")
    i, o = qa.mcq(F.lit("Q"), F.col("c"), F.col("p"), F.lit("ctx"))
    found = df.select("i", i.alias("q"), o.alias("a")).orderBy("i").collect()
    assert (found[0]["q"], found[0]["a"]) == ("Տեքստ:\nctx\n\nՀարց: Q\n\nԱ) a\nԲ) b", "Բ) b")
    assert found[1]["q"] is None and found[2]["a"] is None


def test_exam_routes(spark):
    data = [(7, "q", "c", None, None, "str", "ans", None), (1, "q", None, "t", ["x", "y"], "int", None, 1), (6, "q", None, None, ["x", "y"], "str", "9", None), (3, "q", None, None, ["x"], "str", "1", None), (1, "", None, None, ["x"], "int", None, 0)]
    df = spark.createDataFrame(data, "task_type int, question string, context string, task string, choices array<string>, label_kind string, label_str string, label_int int")
    pairs, skipped = qa.exam_pairs(df, "e")
    assert rows(pairs, "output", "source") == [("ans", "armbench/e/open"), ("Բ) y", "armbench/e/mcq")]
    assert rows(skipped, "task_type", "n_skipped") == [(3, 1), (6, 1)]


def test_public_services_and_open(spark):
    df = spark.createDataFrame([("q", "a", ["b", "c"]), ("q2", "a", []), ("", "a", [])], "question string, answer string, distractors array<string>")
    pairs = qa.public_service_pairs(df).collect()
    assert len(pairs) == 3
    choice = next(p for p in pairs if p["source"].endswith("mcq"))
    assert choice["output"][3:] == "a" and choice["output"] in choice["instruction"]
    squad = spark.createDataFrame([("c", "q", ["x", "y"]), ("", "q", ["z"]), ("c", "q", [])], "context string, question string, answer array<string>")
    assert rows(qa.open_pairs(squad, "s", "context"), "instruction", "output") == [("q", "z"), ("Տեքստ:\nc\n\nՀարց: q", "x")]


def test_aya_boundaries(spark):
    a = "ա" * 20
    data = [(1, "բ" * 10, a), (2, "բ" * 9, a), (3, "բ" * 10, "ա" * 19), (4, "բ" * 10, a + "[["), (5, "բ" * 10, "ա" * 15 + "x" * 6), (6, a, a), (7, None, a), (8, "x" * 6 + "բ" * 8, a)]
    df = spark.createDataFrame([(*d, "s") for d in data], "k int, q string, a string, d string")
    assert rows(qa.aya_pairs(df, "q", "a", "d", "k"), "k") == [(1,), (8,)]


def test_merge_and_chat(spark):
    df = spark.createDataFrame([(1, 0, "A  b", "x"), (2, 1, "a B", "y"), (3, 0, " ", "z"), (4, 0, None, "z")], "pair_id int, rank int, instruction string, output string")
    assert rows(qa.merge_pairs(df, "rank", "pair_id"), "pair_id") == [(1,)]
    chat = df.limit(1).select(qa.chat(F.lit(" i "), F.lit("n"), F.lit("o ")).alias("c"))
    assert chat.first()["c"] == "<|user|>i\nn<|end|><|assistant|>o<|end|>"
    assert chat.select(qa.response(F.col("c"))).first()[0] == "o"
    fits = df.limit(1).select(qa.appropriate(F.lit("Essex"), F.lit(None).cast("string"), F.lit("long enough")), qa.appropriate(F.lit("x"), F.lit(""), F.lit("123456789"))).first()
    assert tuple(fits) == (False, False)


@pytest.mark.parametrize(
    ("text", "count"),
    [
        ('{"question": "q", "answer": "%s"}\n' * 3, 3), ('{"question": "q", "answer": "%s"}\n' * 2, 2), ('```json\n[{"instruction": "q", "output": "%s"}]\n```', 1),
        ('x {"question": "q "w"", "answer": "%s"} y', 1), ('{"question": "q", "answer": "%s"} tail', 1), ("nothing", 0), ("", 0), (None, 0), ('{"question": "q", "answer": 5}', 0), ("[1, 2", 0),
    ],
)
def test_response_tiers(text, count):
    answer = "a" * 21
    assert len(parsing.parse_pairs(text.replace("%s", answer) if text else text)) == count


def test_response_frame(spark):
    df = spark.createDataFrame([(1, '{"question": "q", "answer": "%s"}' % ("a" * 30)), (2, None)], "k int, t string")
    assert rows(parsing.parsed_pairs(df, "k", "t"), "k", "pos", "instruction") == [(1, 0, "q")]
    assert parsing.parse_array('```json[{"question": "q", "answer": "%s"}]```' % ("a" * 30)) == [("q", "a" * 30)]
    assert parsing.parsed_pairs(df.limit(0), "k", "t").count() == 0


def test_char_tokens(spark):
    df = spark.createDataFrame([(1, "ab<|x|>b"), (2, ""), (3, None), (4, "zé")], "k int, t string")
    vocabulary = tokens.char_vocabulary(df.filter("k = 1"), "t")
    grown = tokens.add_tokens(vocabulary, ["<|x|>", "<|x|>y"])
    assert tokens.add_tokens(grown, ["<|x|>"]).count() == grown.count()
    encoded = tokens.encode_chars(df, "t", grown, ("<|x|>", "<|x|>y"))
    found = {r["k"]: r["tokens"] for r in encoded.collect()}
    size = vocabulary.count()
    assert found[1][2] == size and len(found[1]) == 4 and found[2] == [] and found[3] is None and found[4] == []
    back = {r["k"]: r["t2"] for r in tokens.decode_chars(encoded, "tokens", grown, "t2").collect()}
    assert back[1] == "ab<|x|>b"


def test_split_and_blocks(spark):
    data = [(i, list(range(10 * i, 10 * i + n))) for i, n in enumerate([3, 0, 5, 1, 9, 2, 7])] + [(9, None)]
    df = spark.createDataFrame(data, "k int, t array<int>")
    stream = [x for _, t in data if t for x in t]
    parts = tokens.split_tokens(df, "k", "t").orderBy("start").collect()
    cut = math.floor(len(stream) * 0.9)
    assert [x for p in parts if p["split"] == "train" for x in p["tokens"]] == stream[:cut]
    assert [x for p in parts if p["split"] == "valid" for x in p["tokens"]] == stream[cut:]
    for width in (2, 4, 13, 40):
        blocks = tokens.context_blocks(df, "k", "t", width).orderBy("block_id").collect()
        assert [b["tokens"] for b in blocks] == [stream[i : i + width + 1] for i in range(0, len(stream) - width, width)]
    with pytest.raises(Exception, match="16 bits"):
        tokens.check_16_bits(spark.createDataFrame([([65536],)], "t array<int>"), "t").collect()


def test_pieces_round_trip(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    model = public_tokenizers.path("piece_bpe_32k.model")
    df = spark.createDataFrame([(1, "<|u|>Hello world<|e|>"), (2, ""), (3, None)], "k int, t string")
    ids = tokens.encode_pieces(df, "k", "t", model, ("<|u|>", "<|e|>"))
    back = {r["k"]: r["text"] for r in tokens.decode_pieces(ids, "k", "tokens", model, ("<|u|>", "<|e|>")).collect()}
    assert back == {1: "<|u|>Hello world<|e|>", 2: "", 3: None}


def test_metrics(spark):
    df = spark.createDataFrame([("a", 1, 3.0), ("a", 2, 2.0), ("a", 3, 2.0), ("a", 4, 1.0), ("b", 1, 25.0)], "g string, s int, l double")
    best = metrics.running_best(df, "g", "s", "l")
    assert rows(best, "g", "s", "is_best") == [("a", 1, True), ("a", 2, True), ("a", 3, False), ("a", 4, True), ("b", 1, True)]
    assert best.filter("g = 'b'").select(metrics.perplexity(F.col("l"))).first()[0] == pytest.approx(math.exp(20))
    steps = spark.range(0, 30, 5).select(metrics.learning_rate(F.col("id"), 1.0, 0.1, 10, 20).alias("lr"))
    assert [round(r["lr"], 6) for r in steps.collect()] == [0.0, 0.5, 1.0, 0.55, 0.1, 0.1]
    values = spark.createDataFrame([([3.0, 1.0, 2.0, 2.0],), ([1.0],)], "v array<double>")
    assert [r[0] for r in values.select(metrics.top_k(F.col("v"), 2)).collect()] == [[3.0, 2.0, 2.0], [1.0]]
    topics = spark.createDataFrame([("x",), ("y",)], "topic string")
    assert metrics.batch_plan(spark, topics, 61, 15).count() == 2 * 3
    plan = metrics.prompts(metrics.batch_plan(spark, topics, 1, 15), "{topic} no. {batch}")
    assert rows(plan, "prompt") == [("x no. 1",), ("y no. 1",)]
