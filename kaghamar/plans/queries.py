"""The registered queries over the reference's own operators; their SQL is in `sql`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kaghamar.functions import text as X
from kaghamar.operators import corpus, metrics, parsing, qa, tokens
from kaghamar.plans import pipelines
from kaghamar.plans.sql import ORACLE
from kaghamar.session import cut_lineage, scratch, small, spread
from kaghamar.sources import readers, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: Letters and digits of the fixture language beside the default characters, for the Latin variant.
LATIN_KEEP = X.CLEAN_KEEP + "A-Za-z"

#: Tables that are worth dealing out when they come in fewer pieces than there are cores.
TEXT_TABLES = frozenset(("documents", "corpus_raw", "raw_chunks", "aya_armenian", "armenian_qa_qwen", "qa_merged", "armbench_train", "armbench_eval"))


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows) if name in TEXT_TABLES else rows


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three answer tables with their file's rank."""
    columns = ["pair_id", "instruction", "input", "output", "source"]
    out = None
    for rank, name in enumerate(("armenian_qa_qwen", "qa_merged", "aya_armenian")):
        part = table(spark, sf_dir, name).select(*columns, F.lit(rank).alias("rank"))
        out = part if out is None else out.unionByName(part)
    return out


def _flagged(spark: SparkSession, sf_dir: str, dedup: bool = True) -> DataFrame:
    return corpus.flag_paragraphs(table(spark, sf_dir, "corpus_raw"), table(spark, sf_dir, "source_order"), "para_id", dedup=dedup)


@query
def corpus_paragraph_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.paragraphs(table(spark, sf_dir, "documents").filter("text is not null"), "doc_id", "text")


@query
def corpus_line_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.paragraphs(table(spark, sf_dir, "documents").filter("text is not null"), "doc_id", "text", separator="\n", least=80)


@query
def corpus_clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.cleaned(table(spark, sf_dir, "corpus_raw")).select("para_id", "clean")


@query
def corpus_clean_latin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.cleaned(table(spark, sf_dir, "corpus_raw"), keep=LATIN_KEEP).select("para_id", "clean")


@query
def corpus_priority_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flagged(spark, sf_dir).filter("fate = 'kept'").select("para_id", "source", "pos", F.col("chars_out").alias("n_chars"))


@query
def corpus_no_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flagged(spark, sf_dir, dedup=False).filter("fate = 'kept'").select("para_id", "source", "pos", F.col("chars_out").alias("n_chars"))


@query
def corpus_source_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.source_stats(_flagged(spark, sf_dir), table(spark, sf_dir, "source_order"))


@query
def corpus_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.totals(corpus.source_stats(_flagged(spark, sf_dir), table(spark, sf_dir, "source_order")))


@query
def exact_doc_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", F.md5("text").alias("digest"))
    return docs.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).select("doc_id", "copies")


@query
def bitext_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct Armenian lines of instruction-output pairs taken as a bitext."""
    rows = table(spark, sf_dir, "qa_merged").select(F.lit("hy").alias("src_lang"), F.col("instruction").alias("src_text"), F.when(F.col("source").isNull(), "en").otherwise("hy").alias("tgt_lang"), F.col("output").alias("tgt_text"))
    return readers.bitext_side(rows, "hy")


@query
def sft_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa.merge_pairs(_pairs(spark, sf_dir), "rank", "pair_id").select("pair_id", "rank", "norm")


@query
def sft_source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _pairs(spark, sf_dir)
    kept = qa.merge_pairs(pairs, "rank", "pair_id").select("pair_id", F.lit(1).alias("is_kept"))
    rows = pairs.withColumn("norm", X.norm_key(F.col("instruction"))).filter("norm <> ''").join(kept, "pair_id", "left")
    return rows.groupBy(F.coalesce("source", F.lit("unknown")).alias("source")).agg(F.count("is_kept").alias("kept"), (F.count("*") - F.count("is_kept")).alias("dropped")).orderBy(F.desc("kept"), "source")


@query
def aya_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa.aya_pairs(table(spark, sf_dir, "aya_armenian"), "instruction", "output", "source", "pair_id").select("pair_id", "instruction", "output")


@query
def aya_skip_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "aya_armenian").select(X.ws_clean(F.col("instruction")).alias("instruction"), X.ws_clean(F.col("output")).alias("output"))
    return rows.groupBy(corpus.first_reason(qa.aya_reasons(F.col("instruction"), F.col("output"))).alias("reason")).agg(F.count("*").alias("n"))


@query
def aya_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample per dataset, filter, keep the first of equal questions; with each dataset's yield."""
    sample = cut_lineage(corpus.sample_per_group(table(spark, sf_dir, "aya_armenian"), "source", "pair_id", 200))
    good = corpus.keep_first(qa.aya_pairs(sample, "instruction", "output", "source", "pair_id"), X.norm_key(F.col("instruction")), ["pair_id"])
    pool = sample.groupBy("source").agg(F.count("*").alias("pool"))
    kept = good.groupBy("source").agg(F.count("*").alias("kept")).withColumnRenamed("source", "s")
    out = pool.join(kept, F.col("source").eqNullSafe(F.col("s")), "left").withColumn("kept", F.coalesce("kept", F.lit(0)))
    return out.select("source", "pool", "kept", F.round(F.col("kept") * 100 / F.greatest("pool", F.lit(1)), 3).alias("yield_pct"))


@query
def source_sample_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.sample_per_group(table(spark, sf_dir, "aya_armenian"), "source", "pair_id", 50).select("source", "pair_id")


@query
def letter_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "corpus_raw").filter("text is not null")
    return rows.select("para_id", F.regexp_count("text", F.lit(f"[{X.SCRIPT_LETTERS}]")).alias("n_script"), X.script_ratio(F.col("text"), "A-Za-z").alias("latin_ratio"))


@query
def min_length_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.records(table(spark, sf_dir, "corpus_raw"), "text", 50, None, "para_id")


@query
def lang_filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.records(table(spark, sf_dir, "corpus_raw"), "text", 50, {"lang": "hy"}, "para_id")
    return rows.select("para_id", (F.octet_length("text") + 2).alias("n_bytes"))


@query
def skip_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages; ns is the id modulo four."""
    pages = table(spark, sf_dir, "documents").select((F.col("doc_id") % 4).cast("int").alias("ns"), "text")
    reason = readers.wiki_reason(F.col("ns"), F.col("text"), X.strip_wiki_markup(F.col("text")))
    return pages.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query
def wiki_markup_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", X.strip_wiki_markup(F.col("text")).alias("text"))


@query
def wiki_markup_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on text put into markup, so that each rule has work."""
    marked = F.concat(F.lit("== Վերնագիր ==\n'''"), F.col("output"), F.lit("'''<ref name=\"a\">b</ref> [[Category:X]] [[a|b|c]] [[plain]] [https://x.example/y label] {{t|u}} &nbsp; &#160;\n{| t\n| c\n|}\n| row\n * \n#:;\n\n\n\nend <br/>"))
    return table(spark, sf_dir, "qa_merged").filter("output is not null").select("pair_id", X.strip_wiki_markup(marked).alias("text"))


@query
def html_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "raw_chunks").filter("chunk is not null").select("chunk_id", X.strip_legal_html(F.col("chunk")).alias("text"))


@query
def jsonl_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "raw_chunks")
    body = X.strip(F.from_json("chunk", "body string", {"mode": "PERMISSIVE"})["body"])
    return rows.select("chunk_id", body.alias("text")).filter(F.length("text") >= 50)


@query
def legal_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.legal_texts(table(spark, sf_dir, "raw_chunks"), "chunk", "chunk_id")


@query
def artifact_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").filter(X.any_of(F.col("text"), X.ARTIFACTS)).select("doc_id")


@query
def blocklist_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).filter(qa.appropriate(F.col("instruction"), F.col("input"), F.col("output"))).select("pair_id")


@query
def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "qa_merged").filter("instruction is not null and output is not null")
    return rows.select("pair_id", qa.chat(F.col("instruction"), F.col("input"), F.col("output")).alias("chat"))


@query
def chat_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format(spark, sf_dir).select("pair_id", qa.response(F.col("chat")).alias("response"))


@query
def fence_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "qa_merged").filter("output is not null")
    fenced = F.when(F.col("pair_id") % 2 == 0, F.concat(F.lit("```json\n"), F.col("output"), F.lit("\n```"))).otherwise(F.col("output"))
    return rows.select("pair_id", X.strip_fences(fenced).alias("text"), X.fenced_part(fenced).alias("part"))


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question per nation: its region among the regions; the label's form changes with the key."""
    region = table(spark, sf_dir, "region")
    names = region.agg(F.transform(F.array_sort(F.collect_list(F.struct("r_regionkey", "r_name"))), lambda r: r["r_name"])).scalar()
    rows = table(spark, sf_dir, "nation").withColumn("names", names)
    rows = rows.join(small(region), F.col("n_regionkey") == F.col("r_regionkey"))
    form = F.col("n_nationkey") % 3
    return rows.select(
        "n_nationkey", "n_regionkey", "r_name", F.col("names").alias("choices"), F.concat(F.lit(" Where is "), F.col("n_name"), F.lit("? ")).alias("question"),
        F.when(form == 0, "int").otherwise("str").alias("label_kind"),
        F.when(form == 1, (F.col("n_regionkey") + 1).cast("string")).when(form == 2, F.char(F.col("n_regionkey") + 65)).alias("label_str"),
        F.when(form == 0, F.col("n_regionkey")).alias("label_int"),
    )


@query
def label_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = qa.single_label(F.col("label_kind"), F.col("label_str"), F.col("label_int"), F.size("choices"))
    return _nations(spark, sf_dir).select("n_nationkey", place.alias("place"))


@query
def mcq_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = qa.single_label(F.col("label_kind"), F.col("label_str"), F.col("label_int"), F.size("choices"))
    instruction, output = qa.mcq(F.col("question"), F.col("choices"), place, F.when(F.col("n_nationkey") % 2 == 0, F.col("r_name")))
    return _nations(spark, sf_dir).select("n_nationkey", instruction.alias("instruction"), output.alias("output"))


def _exam(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.get(F.array(F.lit(1), F.lit(6), F.lit(7), F.lit(2)), (F.col("n_nationkey") % 4).cast("int"))
    return _nations(spark, sf_dir).select("question", F.when(F.col("n_nationkey") % 2 == 0, F.col("r_name")).alias("context"), F.when(F.col("n_nationkey") % 5 == 0, F.lit("Task")).alias("task"), "choices", "label_kind", "label_str", "label_int", kind.alias("task_type"))


@query
def exam_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa.exam_pairs(_exam(spark, sf_dir), "exam_history")[0]


@query
def exam_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa.exam_pairs(_exam(spark, sf_dir), "exam_history")[1]


@query
def public_service_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _nations(spark, sf_dir).select("question", F.col("r_name").alias("answer"), F.filter("choices", lambda c: c != F.col("r_name")).alias("distractors"))
    return qa.public_service_pairs(rows)


@query
def four_choice_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _nations(spark, sf_dir).select("question", "label_kind", "label_str", "label_int", F.col("r_name").alias("passage"), *(F.get("choices", F.lit(i)).alias(f"option_{o}") for i, o in enumerate("abcd")))
    return qa.four_choice_pairs(rows, [f"option_{o}" for o in "abcd"], "belebele-in-context-mcqa", "passage")


@query
def open_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "armbench_eval").select(F.col("instruction").alias("question"), F.col("output").alias("answer"), F.col("input").alias("context"))
    return qa.open_pairs(rows, "squad-in-context-qa", "context")


@query
def resume_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "qa_merged").filter("output is not null").select(X.norm_key(F.col("instruction")).alias("norm"))
    return corpus.without_done(table(spark, sf_dir, "aya_armenian").withColumn("norm", X.norm_key(F.col("instruction"))), done, "norm").select("pair_id")


@query
def batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of each region's topic that the generated pairs don't cover yet."""
    plan = metrics.batch_plan(spark, table(spark, sf_dir, "nation").select(F.format_string("topic%02d", "n_nationkey").alias("topic")), 5000, 15)
    return corpus.without_done(plan, table(spark, sf_dir, "armenian_qa_qwen").filter("batch_key is not null"), "batch_key")


@query
def shard_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "raw_chunks").select(F.concat(F.date_format("fetched_at", "yyyy_"), F.col("chunk_id").cast("string"), F.lit(".parquet")).alias("name"), "chunk_id")
    return readers.shards(names, names.filter("chunk_id % 3 = 0")).select("name")


@query
def char_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.char_vocabulary(table(spark, sf_dir, "corpus_raw"), "text")


def _chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = cut_lineage(char_vocab(spark, sf_dir))
    return tokens.encode_chars(table(spark, sf_dir, "qa_merged").select("pair_id", "output"), "output", vocabulary).select("pair_id", "tokens")


@query
def char_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chars(spark, sf_dir).select("pair_id", F.size("tokens").alias("n"), F.aggregate("tokens", F.lit(0).cast("long"), lambda a, x: (a * 31 + x) % 1000003).alias("checksum"))


@query
def char_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = cut_lineage(char_vocab(spark, sf_dir))
    return tokens.decode_chars(_chars(spark, sf_dir), "tokens", vocabulary).select("pair_id", "text")


@query
def vocab_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus vocabulary, the chat tags after it, then the characters of the answers that it lacks."""
    tagged = tokens.add_tokens(cut_lineage(char_vocab(spark, sf_dir)), [X.USER, X.ASSISTANT, X.END])
    return tokens.add_tokens(cut_lineage(tagged), tokens.char_vocabulary(table(spark, sf_dir, "raw_chunks"), "chunk"))


@query
def token_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chars(spark, sf_dir).agg(F.count("*").alias("n_rows"), F.sum(F.coalesce(F.size("tokens"), F.lit(0)).cast("long")).alias("n_tokens"))


@query
def token_split_90_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = tokens.split_tokens(cut_lineage(_chars(spark, sf_dir)), "pair_id", "tokens")
    return parts.select("pair_id", "split", "start", F.size("tokens").alias("n"))


@query
def pack_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = tokens.context_blocks(cut_lineage(_chars(spark, sf_dir)), "pair_id", "tokens", 256)
    return blocks.select("block_id", F.get("tokens", F.lit(0)).alias("first_token"), F.get("tokens", F.lit(256)).alias("last_token"), F.aggregate("tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


@query
def piece_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    chats = chat_format(spark, sf_dir)
    return tokens.encode_pieces(chats, "pair_id", "chat", public_tokenizers.path("piece_bpe_32k.model"), (X.USER, X.ASSISTANT, X.END))


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model response per pair: its JSON line or array, fenced or broken by turns."""
    rows = table(spark, sf_dir, "armenian_qa_qwen").filter("instruction is not null and output is not null")
    line = F.to_json(F.struct(F.col("instruction").alias("question"), F.col("output").alias("answer")))
    turn = F.col("pair_id") % 4
    text = F.when(turn == 0, line).when(turn == 1, F.concat(F.lit("```json\n["), line, F.lit("]\n```"))).when(turn == 2, F.concat(line, F.lit(" trailing"))).otherwise(F.concat(F.lit('Here: {"question": "'), F.col("instruction"), F.lit('", "answer": "'), F.col("output"), F.lit('"}')))
    return rows.select("pair_id", "instruction", "output", text.alias("response"))


@query
def response_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.parsed_pairs(_responses(spark, sf_dir), "pair_id", "response")


@query
def response_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.parsed_pairs(_responses(spark, sf_dir), "pair_id", "response", plain=True)


@query
def lr_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 12000).alias("step")).distinct()
    return steps.select("step", F.round(metrics.learning_rate(F.col("step"), 3e-4, 3e-5, 500, 10000), 10).alias("lr"), X.clock(F.col("step")).alias("clock"), X.minutes(F.col("step")).alias("minutes"))


@query
def running_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.abs("value").alias("loss"))
    best = metrics.running_best(rows, "user_id", "event_id", "loss")
    uncapped = metrics.perplexity(F.col("loss") / 10, capped=False)
    return best.select("event_id", F.round("best_before", 6).alias("best_before"), "is_best", F.round(metrics.perplexity(F.col("loss")), 3).alias("perplexity"), F.round(uncapped, 6).alias("uncapped"))


@query
def mean_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return rows.groupBy("event_type").agg(F.count("value").alias("n"), F.round(F.avg(F.abs("value")), 6).alias("mean_loss"))


@query
def topk_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    return rows.select("vec_id", F.size(metrics.top_k(F.col("v"), 5)).alias("n"), F.round(F.array_min(metrics.top_k(F.col("v"), 5)), 6).alias("threshold"))


# Readers and sinks, by files that a query writes into a folder of its own.


@query
def wiki_articles_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers as pages of an XML export, read back: those that stay, cleaned."""
    text = F.concat(F.lit("'''Վերնագիր''' "), F.col("output"), F.lit(" [[File:a.jpg|b]] {{t}}"))
    rows = table(spark, sf_dir, "qa_merged").filter("output is not null").filter(~F.col("output").rlike("[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\r\\ufffe\\uffff]"))
    pages = rows.select((F.col("pair_id") % 5).cast("string").alias("ns"), F.col("pair_id").cast("string").alias("title"), F.struct(F.struct(text.alias("_VALUE"), F.lit("preserve").alias("_xml_space")).alias("text")).alias("revision"))
    folder = scratch(spark)
    pages.write.format("xml").option("rootTag", "mediawiki").option("rowTag", "page").save(folder)
    return readers.wiki_articles(spark, folder, "wiki")


@query
def zstd_json_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs as zstd files of JSON lines, read back: the texts of 50 characters or more."""
    lines = table(spark, sf_dir, "corpus_raw").select(F.to_json(F.struct("para_id", "text")).alias("line"))
    folder = scratch(spark)
    sinks.write_lines(lines, folder, "line", "zst")
    return readers.json_texts(readers.decoded_lines(spark, folder))


@query
def xz_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers as xz files of documents between blank lines, read back and cut into paragraphs."""
    lines = table(spark, sf_dir, "qa_merged").filter("output is not null").select(F.concat(F.lit("\n"), "output", F.lit("\n")).alias("line"))
    folder = scratch(spark)
    sinks.write_lines(lines, folder, "line", "xz")
    documents = readers.REGISTRY["cc100"](spark, folder).withColumn("doc", F.monotonically_increasing_id())
    return corpus.paragraphs(documents, "doc", "text", at_end="at_end").select("paragraph")


@query
def source_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sources by their readers in one table: rows and characters of each."""
    rows, folder = table(spark, sf_dir, "corpus_raw"), scratch(spark)
    rows.select("text").write.parquet(f"{folder}/mc4")
    rows.select(F.col("text").alias("og_full_text")).write.parquet(f"{folder}/finetranslations")
    rows.select(F.col("text").alias("plain_text"), F.col("lang").alias("language")).write.parquet(f"{folder}/ccnews")
    texts = readers.load_sources(spark, {name: f"{folder}/{name}" for name in ("mc4", "finetranslations", "ccnews")})
    return texts.groupBy("source").agg(F.count("*").alias("n_texts"), F.sum(F.length("text").cast("long")).alias("n_chars"))


@query
def first_split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark)
    for split, name in (("test", "armbench_eval"), ("train", "armbench_train")):
        table(spark, sf_dir, name).select("item_id").write.parquet(f"{folder}/{split}")
    return readers.first_split(spark, folder)


@query
def pairs_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs as one JSON array, read back with their places."""
    folder = scratch(spark)
    sinks.write_pairs_array(table(spark, sf_dir, "qa_merged").select("pair_id", "instruction", "input", "output"), folder, ["pair_id"])
    return readers.json_array(spark, folder, "pair_id: bigint, instruction: string, input: string, output: string")


@query
def merged_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned paragraphs on one line each as a text file with blank lines between, read back."""
    rows = corpus.cleaned(table(spark, sf_dir, "corpus_raw")).select("para_id", F.regexp_replace("clean", r"\n+", " ").alias("text")).filter("text <> ''")
    folder = scratch(spark)
    sinks.write_text(rows, folder, "text", ["para_id"])
    return spark.read.option("lineSep", "\n\n").text(folder).select(F.col("value").alias("text"))


@query
def stats_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics as their JSON file holds them: the totals."""
    stats = cut_lineage(corpus_source_stats(spark, sf_dir))
    path = f"{scratch(spark)}/stats.json"
    sinks.write_stats(stats, corpus.totals(stats), path)
    names = ("chars_in", "chars_out", "kept", "dropped_short", "dropped_duplicates")
    return spark.read.option("multiLine", True).json(path).select(*(F.col(f"totals.{c}").alias(c) for c in names), F.size("order").cast("long").alias("n_sources"))


@query
def pairs_in_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of two sets as compressed JSON lines: how many pairs their files hold."""
    folder, counts = scratch(spark), None
    for name in ("qa_merged", "aya_armenian"):
        sinks.write_pairs(table(spark, sf_dir, name).select("pair_id", "instruction", "output"), f"{folder}/{name}")
        part = sinks.pairs_per_file(spark.read.json(f"{folder}/{name}")).select(F.lit(name).alias("name"), "n_pairs")
        counts = part if counts is None else counts.unionByName(part)
    return counts.groupBy("name").agg(F.sum("n_pairs").alias("n_pairs"))


@query
def token_bin_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Character tokens as unsigned 16-bit files, read back by ranges: their number and sums."""
    folder = scratch(spark)
    files = cut_lineage(sinks.export_token_bins(_chars(spark, sf_dir), folder, "pair_id", "tokens"))
    ids = readers.token_bins(spark, folder, 1 << 14).select(F.explode("tokens").alias("id")).select(F.col("id").cast("long").alias("id"))
    told = files.agg(F.sum("n_tokens")).scalar()
    return ids.agg(F.count("*").alias("n_tokens"), F.sum("id").alias("total"), F.sum(F.col("id") * F.col("id")).alias("squares")).withColumn("n_written", told)


@query
def vocabulary_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The character vocabulary as its file holds it."""
    folder = scratch(spark)
    sinks.save_vocabulary(char_vocab(spark, sf_dir), f"{folder}/char_tokenizer.json", [X.END])
    return sinks.load_vocabulary(spark, f"{folder}/char_tokenizer.json")[0]


@query
def manifest_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that a manifest written in two goes doesn't hold yet."""
    names, folder = table(spark, sf_dir, "armenian_qa_qwen").filter("batch_key is not null").select("batch_key").distinct(), scratch(spark)
    for digit in ("1", "2"):
        pipelines.record_done(names.filter(F.col("batch_key").endswith(digit)), folder, "batch_key")
    return corpus.without_done(names, spark.read.parquet(folder), "batch_key")


@query
def orphan_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored files that no record refers to."""
    stored = table(spark, sf_dir, "raw_chunks").select(F.md5(F.col("chunk_id").cast("string")).alias("blob"), "chunk_id")
    return corpus.without_done(stored, stored.filter("chunk_id % 4 <> 1").select("blob"), "blob").select("chunk_id")


@query
def data_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ending = F.get(F.array(F.lit(".json"), F.lit("_progress.json"), F.lit(".txt")), (F.col("pair_id") % 3).cast("int"))
    names = table(spark, sf_dir, "qa_merged").select("pair_id", F.concat(F.coalesce("source", F.lit("none")), ending).alias("name"))
    return names.filter(X.is_data_file(F.col("name")))


@query
def transient_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents taken as error messages that a retry may mend."""
    return table(spark, sf_dir, "documents").filter(X.is_transient_error(F.col("text"))).select("doc_id")


@query
def batch_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = metrics.batch_plan(spark, table(spark, sf_dir, "nation").select(F.col("n_name").alias("topic")), 500, 15)
    return metrics.prompts(plan, "Write about {topic}, part {batch}: {topic}!").select("topic", "batch_idx", "prompt")


@query
def first_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The preview of a merged set: its first three pairs."""
    return table(spark, sf_dir, "qa_merged").orderBy("pair_id").limit(3).select("pair_id", "instruction")


@query
def run_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events as the log of a run of 10,000 steps."""
    steps = table(spark, sf_dir, "events").select("user_id", "event_id", F.lit(512).alias("n"), (F.col("event_id") % 7 + 1).cast("double").alias("s"))
    speed = pipelines.throughput(steps, "user_id", "event_id", "n", "s", 10_000)
    return speed.select("event_id", F.round("tokens_per_s", 6).alias("tokens_per_s"), F.round("seconds_left", 3).alias("seconds_left"))


@query
def chat_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chats by the corpus vocabulary and the tags after it, each tag as one token, and back."""
    vocabulary = cut_lineage(tokens.add_tokens(cut_lineage(char_vocab(spark, sf_dir)), [X.USER, X.ASSISTANT, X.END]))
    ids = tokens.encode_chars(chat_format(spark, sf_dir), "chat", vocabulary, (X.END, X.USER, X.ASSISTANT))
    back = tokens.decode_chars(ids, "tokens", vocabulary, "back")
    return back.select("pair_id", F.size("tokens").alias("n"), F.aggregate("tokens", F.lit(0).cast("long"), lambda a, x: (a * 31 + x) % 1000003).alias("checksum"), "back")


@query
def piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chats by a public piece model with the tags after its vocabulary, and back."""
    import public_tokenizers

    ids = piece_encode(spark, sf_dir)
    tags = F.filter("tokens", lambda i: i >= 32_000)
    counts = ids.select("pair_id", F.size(tags).alias("n_tags"), F.get(tags, F.lit(0)).alias("first_tag"), F.element_at(tags, -1).alias("last_tag"))
    back = tokens.decode_pieces(ids, "pair_id", "tokens", public_tokenizers.path("piece_bpe_32k.model"), (X.USER, X.ASSISTANT, X.END))
    return back.join(counts, "pair_id")


@query
def benchmark_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training and evaluation configurations of the registry that are there, each side in one table."""
    exam, nations = _exam(spark, sf_dir), _nations(spark, sf_dir)
    four = nations.select("question", "label_kind", "label_str", "label_int", *(F.get("choices", F.lit(i)).alias(f"option_{o}") for i, o in enumerate("abcd")))
    simple = table(spark, sf_dir, "armbench_eval").select(F.col("instruction").alias("question"), F.col("output").alias("answer"))
    frames = {"exam_math": exam, "exam_history": exam, "include-mcqa": four, "simpleqa": simple}
    sides = [pipelines.benchmark_pairs(frames, configs).withColumn("side", F.lit(side)) for side, configs in (("train", pipelines.TRAIN_CONFIGS), ("eval", pipelines.EVAL_CONFIGS))]
    return sides[0].unionByName(sides[1]).select("side", "source", "instruction", "output")


@query
def instruction_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pair files in the order of their priority; the first row of an instruction wins."""
    files = [spark.read.parquet(f"{sf_dir}/{name}.parquet").select("instruction", "input", "output", "source") for name in ("armenian_qa_qwen", "qa_merged", "aya_armenian")]
    return pipelines.merge_instructions(files).select(X.norm_key(F.col("instruction")).alias("norm"), "source", "output")


@query
def chat_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appropriate pairs as chats, their tokens by the corpus vocabulary extended, and the two parts."""
    return pipelines.prepare_chat(table(spark, sf_dir, "qa_merged").filter("output is not null"), scratch(spark), cut_lineage(char_vocab(spark, sf_dir)))


@query
def token_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers as token tables in two parts, with the kind of tokenizer that the folder holds."""
    folder = scratch(spark)
    parts = pipelines.tokenize(table(spark, sf_dir, "qa_merged").select("pair_id", "output"), "pair_id", "output", folder)
    return parts.withColumn("kind", F.lit(sinks.tokenizer_file(folder)[0]))


@query
def prepared_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of two sources end to end: read, cut, cleaned, merged by priority; the statistics of all sources."""
    folder = scratch(spark)
    rows = table(spark, sf_dir, "documents").filter("text is not null")
    for name, some in (("culturax", "doc_id % 2 = 0"), ("mc4", "doc_id % 2 = 1")):
        rows.filter(some).select("text").write.parquet(f"{folder}/{name}")
    return pipelines.prepare_corpus(spark, {name: f"{folder}/{name}" for name in ("mc4", "culturax")}, f"{folder}/out")


def _several(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of three pairs, each in a shape that another tier reads best; texts without what JSON escapes."""
    plain = lambda c: X.ws_clean(F.regexp_replace(F.col(c), r'["\\{}\[\]`\x00-\x1f\x7f-\x9f\u2028\u2029]', " ")).alias(c)
    rows = table(spark, sf_dir, "armenian_qa_qwen").select("pair_id", plain("instruction"), plain("output")).filter("instruction <> '' and length(output) > 20")

    def pair(n: int, question: str = "question", answer: str = "answer") -> Column:
        return F.concat(F.lit(f'{{"{question}": "'), "instruction", F.lit(f' {n}", "{answer}": "'), "output", F.lit('"}'))

    lines = F.concat_ws("\n", pair(1), pair(2, "instruction", "output"), pair(3))
    array = F.concat(F.lit("Sure:\n["), F.concat_ws(", ", pair(1), pair(2), pair(3)), F.lit("]\n"))
    both = F.concat(F.lit("```json\n["), F.concat_ws(",\n", pair(1), pair(2)), F.lit("]\n```"))
    broken = F.concat(F.lit("{"), F.concat_ws(",\n", *(F.replace(F.replace(pair(n), F.lit("{"), F.lit("")), F.lit("}"), F.lit("")) for n in (1, 2, 3))), F.lit(","))
    turned = [F.concat(F.lit('{"answer": "'), "output", F.lit('", "question": "'), "instruction", F.lit(f' {n}"}} and so on')) for n in (1, 2, 3)]
    turn = F.col("pair_id") % 5
    return rows.select("pair_id", F.when(turn == 0, lines).when(turn == 1, array).when(turn == 2, both).when(turn == 3, broken).otherwise(F.concat_ws("\n", *turned)).alias("response"))


@query
def response_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.parsed_pairs(_several(spark, sf_dir), "pair_id", "response").select("pair_id", "pos", "instruction", "output")
