"""End-to-end runs on files written here."""

import json

from pyspark.sql import functions as F

from kaghamar.plans import pipelines
from kaghamar.sources import sinks

LONG = "Սա բավական երկար պարբերություն է, որ մնա մաքրելուց հետո նույնպես։"


def test_corpus_to_tokens(spark, tmp_path):
    spark.createDataFrame([(f"{LONG}\n\n{LONG} Երկրորդ։\n\nկարճ",)], "text string").write.parquet(str(tmp_path / "mc4"))
    spark.createDataFrame([(LONG, ), (LONG + " Երրորդ։",)], "text string").write.parquet(str(tmp_path / "culturax"))
    out = str(tmp_path / "out")
    stats = {r["source"]: r for r in pipelines.prepare_corpus(spark, {"mc4": str(tmp_path / "mc4"), "culturax": str(tmp_path / "culturax")}, out).collect()}
    assert (stats["culturax"]["kept"], stats["mc4"]["kept"], stats["mc4"]["dropped_duplicates"], stats["wiki"]["status"]) == (2, 1, 1, "missing")
    text = "".join(p.read_text() for p in sorted((tmp_path / "out" / "text").glob("part-*")))
    assert text.count("\n\n") == 3 and text.index("Երրորդ") < text.index("Երկրորդ")
    assert json.loads((tmp_path / "out" / "stats.json").read_text())["totals"]["kept"] == 3
    rows = spark.read.parquet(out + "/paragraphs")
    counts = {r["split"]: r["n_tokens"] for r in pipelines.tokenize(rows, "para_id", "text", str(tmp_path / "tok")).collect()}
    assert sum(counts.values()) == sum(len(r["text"]) for r in rows.collect()) and counts["train"] == int(sum(counts.values()) * 0.9)


def test_pairs_to_chat(spark, tmp_path):
    files = [spark.createDataFrame([("Հարց մեկ", "", "Պատասխան երկար " * 3, "a"), ("x", "", "how to steal", "a"), (None, None, None, None)], "instruction string, input string, output string, source string"),
             spark.createDataFrame([("հարց  ՄԵԿ", "", "Ուրիշ պատասխան", None), ("Հարց երկու", "մուտք", "Պատասխան երկու", None)], "instruction string, input string, output string, source string")]
    merged = pipelines.merge_instructions(files)
    assert sorted(r["instruction"] for r in merged.collect()) == ["x", "Հարց երկու", "Հարց մեկ"]
    counts = pipelines.prepare_chat(merged, str(tmp_path / "chat"))
    assert counts.agg(F.sum("n_tokens")).first()[0] > 0
    assert spark.read.parquet(str(tmp_path / "chat" / "chats")).count() == 2
    assert sinks.tokenizer_file(str(tmp_path / "chat"))[0] == "char"


def test_benchmarks_and_manifest(spark, tmp_path):
    simple = spark.createDataFrame([("q", "a")], "question string, answer string")
    assert pipelines.benchmark_pairs({"simpleqa": simple}, pipelines.EVAL_CONFIGS).count() == 1
    names = spark.createDataFrame([("2023_a",), ("2023_b",)], "name string")
    pipelines.record_done(names.limit(1), str(tmp_path / "done"), "name")
    from kaghamar.operators.corpus import without_done

    assert without_done(names, spark.read.parquet(str(tmp_path / "done")), "name").count() == 1
    speed = pipelines.throughput(spark.range(3).withColumn("run", F.lit("a")).withColumn("n", F.lit(10)).withColumn("s", F.lit(2.0)), "run", "id", "n", "s", 5).orderBy("id").collect()
    assert [(r["tokens_per_s"], r["seconds_left"]) for r in speed] == [(5.0, 8.0), (5.0, 6.0), (5.0, 4.0)]
