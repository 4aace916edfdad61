"""Readers and sinks on files written here."""

import json
import lzma

import pytest
from pyspark.sql import functions as F

from kaghamar.operators import corpus, tokens
from kaghamar.sources import readers, sinks

BODY = "Հոդված առաջին։ " * 12


def page(ns, text):
    return f"<page><title>t</title><ns>{ns}</ns><revision><text xml:space='preserve'>{text}</text></revision></page>"


def test_wiki_pages(spark, tmp_path):
    texts = [(0, BODY * 2), (1, BODY * 2), ("x", BODY * 2), (0, "#REDIRECT [[a]]" + BODY * 2), (0, "#ՎԵՐԱՀՂՈՒՄ " + BODY * 2), (0, "ա" * 199), (0, "ա" * 200), (0, "{{" + "x" * 300 + "}}" + "ա" * 100), (0, "{{" + "x" * 300 + "}}" + "ա" * 101)]
    (tmp_path / "w.xml").write_text("<mediawiki>" + "".join(page(*t) for t in texts) + "</mediawiki>", encoding="utf-8")
    pages = readers.wiki_pages(spark, str(tmp_path / "w.xml"))
    assert pages.count() == len(texts)
    found = readers.wiki_articles(spark, str(tmp_path / "w.xml"), "wiki")
    assert sorted(len(r["text"]) for r in found.collect()) == [101, 200, len((BODY * 2).strip())]


def test_compressed_lines(spark, tmp_path):
    lines = [json.dumps({"title": "Օրենք", "body": "<p>" + BODY + "</p>&#171;ա&#187;"}, ensure_ascii=False), "", "{broken", json.dumps({"title": "", "body": BODY}, ensure_ascii=False), json.dumps({"title": "x", "body": "կարճ"})]
    with lzma.open(tmp_path / "a.xz", "wt", encoding="utf-8") as file:
        file.write("\n".join(lines))
    found = readers.legal_texts(readers.decoded_lines(spark, str(tmp_path / "a.xz"))).collect()
    assert [r["text"][:5] for r in found] == ["Օրենք", "Հոդվա", "Հոդվա"]
    with lzma.open(tmp_path / "b.xz", "wt") as file:
        file.write("")
    assert readers.decoded_lines(spark, str(tmp_path / "b.xz")).count() == 0


@pytest.mark.parametrize("codec", ["gzip", "bzip2"])
def test_json_lines(spark, tmp_path, codec):
    rows = [json.dumps({"text": "ա" * 49}), json.dumps({"text": " " + "ա" * 50}), json.dumps({"text": None}), "{oops", "", json.dumps({"other": 1})]
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.option("compression", codec).text(str(tmp_path / "j"))
    assert [len(r["text"]) for r in readers.json_texts(spark.read.text(str(tmp_path / "j"))).collect()] == [50]


def test_zstd(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(json.dumps({"text": "ա" * 50}, ensure_ascii=False) + "\n{\n", encoding="utf-8")
    sinks.zstd_file(str(tmp_path / "a.jsonl"), str(tmp_path / "a.zst"))
    sinks.unzstd_file(str(tmp_path / "a.zst"), str(tmp_path / "b.jsonl"))
    assert (tmp_path / "a.jsonl").read_bytes() == (tmp_path / "b.jsonl").read_bytes()
    assert readers.REGISTRY["hplt3"](spark, str(tmp_path / "a.zst")).count() == 1


def test_documents_of_a_raw_text_file(spark, tmp_path):
    short = "Տող մեկ այստեղ է և այլն"
    body = f"{short}\r\n{short}\n{short}\n{BODY}\n\n  \n{short}\n\n{BODY}\n{short}"
    with lzma.open(tmp_path / "hy.txt.xz", "wt", encoding="utf-8", newline="") as file:
        file.write(body)
    rows = readers.REGISTRY["cc100"](spark, str(tmp_path / "hy.txt.xz")).collect()
    assert [(r["text"].count("\n"), r["at_end"]) for r in rows] == [(3, False), (0, False), (1, True)]
    (tmp_path / "b.txt").write_text(f"{BODY}\n\nկարճ", encoding="utf-8")
    for name, kept in (("hy.txt.xz", 2), ("b.txt", 2)):
        docs = readers.load_sources(spark, {"cc100": str(tmp_path / name)}).withColumn("k", F.monotonically_increasing_id())
        assert corpus.paragraphs(docs, "k", "text", at_end="at_end").count() == kept
    assert corpus.paragraphs(docs.withColumn("at_end", F.lit(False)), "k", "text", at_end="at_end").count() == 1


def test_large_files_are_read_by_path(spark, tmp_path):
    """A sparse token file beyond what one cell holds, by ranges; only the ranges looked at are read."""
    with open(tmp_path / "big.bin", "wb") as file:
        file.truncate((2 << 30) + 6)
        file.seek(2 << 30)
        file.write(bytes([1, 0, 2, 0, 3, 0]))
    blocks = readers.token_bins(spark, str(tmp_path / "big.bin"), 1 << 20, "block % 512 = 0").select("block", F.size("tokens").alias("n"), F.element_at("tokens", -1).alias("last"))
    assert sorted(map(tuple, blocks.collect())) == [(0, 1 << 20, 0), (512, 1 << 20, 0), (1024, 3, 3)]


def test_written_lines_come_back(spark, tmp_path):
    rows = spark.createDataFrame([(f"տող {i}",) for i in range(50)] + [(None,)], "v string")
    for codec in ("zst", "xz"):
        folder = str(tmp_path / codec)
        assert sinks.write_lines(rows, folder, "v", codec).agg(F.sum("n_lines")).first()[0] == 50
        assert sorted(r["value"] for r in readers.decoded_lines(spark, folder).collect()) == sorted(f"տող {i}" for i in range(50))
    sinks.write_pairs_array(rows.limit(0), str(tmp_path / "none"), ["v"])
    assert readers.json_array(spark, str(tmp_path / "none"), "v: string").count() == 0


def test_parquet_scan_prunes_and_pushes(spark, tmp_path):
    df = spark.createDataFrame([("ա" * 60, "hy", 1), ("ա" * 60, "en", 2), (None, "hy", 3), ("կարճ", "hy", 4)], "plain_text string, language string, more int")
    df.write.parquet(str(tmp_path / "p"))
    out = readers.REGISTRY["ccnews"](spark, str(tmp_path / "p"))
    assert out.count() == 1
    plan = out._jdf.queryExecution().toString()
    assert "EqualTo(language,hy)" in plan and "more" not in plan.split("ReadSchema")[1]


def test_bitext_shards_arrays(spark, tmp_path):
    pairs = spark.createDataFrame([("hy", "բարև ", "en", "hello"), ("en", "hello", "hy", "բարև"), ("hy", "այոո", "hy", "բարև ձեզ"), ("hy", None, "en", "x")], "src_lang string, src_text string, tgt_lang string, tgt_text string")
    assert sorted(r["text"] for r in readers.bitext_side(pairs, "hy", 4).collect()) == ["այոո", "բարև", "բարև ձեզ"]
    assert [r["text"] for r in readers.bitext_side(pairs, "hy").collect()] == ["բարև ձեզ"]
    files = spark.createDataFrame([("2023_a.parquet",), ("2024_b.parquet",), ("2022_c.parquet",), ("2023_d.txt",)], "name string")
    assert [r["name"] for r in readers.shards(files, files.filter("name like '2024%'")).collect()] == ["2023_a.parquet"]
    (tmp_path / "a.json").write_text('[{"instruction": "i", "output": "o"}, {"instruction": "j"}]')
    found = readers.json_array(spark, str(tmp_path / "a.json"), "instruction: string, output: string").orderBy("pos").collect()
    assert [(r["pos"], r["instruction"], r["output"]) for r in found] == [(0, "i", "o"), (1, "j", None)]


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(2, "բ"), (1, "ա"), (3, "գ")], "k int, text string")
    sinks.write_text(df, str(tmp_path / "t"), order=["k"])
    text = "".join(p.read_text(encoding="utf-8") for p in sorted((tmp_path / "t").glob("part-*")))
    assert text == "ա\n\nբ\n\nգ\n\n"
    ids = spark.createDataFrame([(i, [i, 65535]) for i in range(6)], "k int, t array<int>")
    done = sinks.export_token_bins(ids, str(tmp_path / "bins"), "k", "t").collect()
    assert sum(r["n_tokens"] for r in done) == 12
    back = readers.token_bins(spark, str(tmp_path / "bins")).orderBy("path", "block").collect()
    assert [x for r in back for x in r["tokens"]] == [x for i in range(6) for x in (i, 65535)]
    sinks.write_tokens(ids, str(tmp_path / "tokens"), "k", "t")
    assert spark.read.parquet(str(tmp_path / "tokens")).count() == 6
    sinks.write_pairs(df, str(tmp_path / "pairs"))
    assert sum(r["n_pairs"] for r in sinks.pairs_per_file(spark.read.json(str(tmp_path / "pairs"))).collect()) == 3


def test_stats_and_vocabulary_files(spark, tmp_path):
    order = spark.createDataFrame([("wiki", 1), ("none", 2)], "source string, priority int")
    rows = spark.createDataFrame([(1, "wiki", 0, BODY)], "para_id int, source string, pos int, text string")
    stats = corpus.source_stats(corpus.flag_paragraphs(rows, order, "para_id"), order)
    sinks.write_stats(stats, corpus.totals(stats), str(tmp_path / "s.json"))
    body = json.loads((tmp_path / "s.json").read_text())
    assert body["order"] == ["wiki", "none"] and body["totals"]["kept"] == 1
    vocabulary = tokens.char_vocabulary(rows, "text")
    sinks.save_vocabulary(vocabulary, str(tmp_path / "char_tokenizer.json"), ["<|end|>"])
    again, specials = sinks.load_vocabulary(spark, str(tmp_path / "char_tokenizer.json"))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, vocabulary.collect())) and specials == ["<|end|>"]
    assert sinks.tokenizer_file(str(tmp_path))[0] == "char"
    with pytest.raises(FileNotFoundError):
        sinks.tokenizer_file(str(tmp_path / "nowhere"))


def test_union_of_sources(spark, tmp_path):
    spark.createDataFrame([("ա" * 60,)], "text string").write.parquet(str(tmp_path / "m"))
    spark.createDataFrame([("բ" * 60,)], "og_full_text string").write.parquet(str(tmp_path / "f"))
    out = readers.load_sources(spark, {"mc4": str(tmp_path / "m"), "finetranslations": str(tmp_path / "f")})
    assert sorted(r["source"] for r in out.collect()) == ["finetranslations", "mc4"]
    assert readers.ordered(spark.read.parquet(str(tmp_path / "m"))).filter(F.col("pos").isNotNull()).count() == 1
