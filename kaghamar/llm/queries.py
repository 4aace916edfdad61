"""The registered queries of the training-data operators, pN_ for problem N, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kaghamar.llm import abuse, blocks, bpe, formatting, langid, lookalikes, overlap, pairs, personal, quality
from kaghamar.session import cut_lineage, spread


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return rows if name == "labels" else spread(rows)


def p1_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every paragraph and answer."""
    corpus = abuse.abuse_scores(_table(spark, sf_dir, "corpus_raw"), "para_id", "text", "source").withColumnRenamed("para_id", "row_id")
    answers = abuse.abuse_scores(_table(spark, sf_dir, "qa_merged"), "pair_id", "output", "source").withColumnRenamed("pair_id", "row_id")
    return corpus.select(F.lit("corpus_raw").alias("tab"), "row_id", "source", "score").unionByName(answers.select(F.lit("qa_merged").alias("tab"), "row_id", "source", "score"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Abusive, hateful or sexually explicit paragraphs and answers."""
    return p1_scores(spark, sf_dir).filter(F.col("score") >= abuse.THRESHOLD).select("tab", "row_id")


def p1_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, cases and their rate for each table and source (null source included)."""
    case = (F.col("score") >= abuse.THRESHOLD).cast("long")
    return p1_scores(spark, sf_dir).groupBy("tab", "source").agg(F.count("*").alias("n_rows"), F.sum(case).alias("n_cases"), F.avg(case.cast("double")).alias("rate"))


def _language_model(spark: SparkSession, sf_dir: str) -> langid.Centroids:
    return langid.fit(langid.labelled_sample(_table(spark, sf_dir, "labels"), _table(spark, sf_dir, "corpus_raw")))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True languages of the paragraphs whose label is absent or wrong or which hold several languages."""
    return langid.wrong_labels(_table(spark, sf_dir, "corpus_raw"), _language_model(spark, sf_dir))


def p2_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph's segments with language and confidence."""
    return langid.segments(_table(spark, sf_dir, "corpus_raw"), _language_model(spark, sf_dir))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defects of the pairs of both tables."""
    columns = ["pair_id", "instruction", "output"]
    both = _table(spark, sf_dir, "aya_armenian").select(*columns).unionByName(_table(spark, sf_dir, "armenian_qa_qwen").select(*columns))
    return pairs.pair_defects(both).distinct()


def _lookalike_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = lookalikes.observations(_table(spark, sf_dir, "corpus_raw"), "corpus_raw", "para_id", "text", skip_junk=True)
    answers = lookalikes.observations(_table(spark, sf_dir, "qa_merged"), "qa_merged", "pair_id", "output", skip_junk=False)
    return lookalikes.altered_tokens(cut_lineage(corpus.unionByName(answers)))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that hold a character standing for the usual one, or a superfluous one."""
    return _lookalike_tokens(spark, sf_dir).select("tab", "row_id").distinct()


def p4_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of both tables in one form, and whether it was altered."""
    altered = cut_lineage(_lookalike_tokens(spark, sf_dir))
    corpus = lookalikes.canonical_texts(_table(spark, sf_dir, "corpus_raw"), "corpus_raw", "para_id", "text", altered)
    return corpus.unionByName(lookalikes.canonical_texts(_table(spark, sf_dir, "qa_merged"), "qa_merged", "pair_id", "output", altered))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of each record of corpus_raw and raw_chunks."""
    text = formatting.formatting_copies(_table(spark, sf_dir, "corpus_raw"), "para_id", "text")
    json = formatting.formatting_copies(_table(spark, sf_dir, "raw_chunks"), "chunk_id", "chunk", as_json=True)
    both = text.withColumn("tab", F.lit("corpus_raw")).unionByName(json.withColumn("tab", F.lit("raw_chunks")))
    return both.select("tab", "first_id", "copy_id")


def p5_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per record of both tables with its number of copies."""
    text = formatting.collapse(_table(spark, sf_dir, "corpus_raw"), "para_id", "text")
    json = formatting.collapse(_table(spark, sf_dir, "raw_chunks"), "chunk_id", "chunk", as_json=True)
    both = text.select(F.lit("corpus_raw").alias("tab"), F.col("para_id").alias("row_id"), "copies")
    return both.unionByName(json.select(F.lit("raw_chunks").alias("tab"), F.col("chunk_id").alias("row_id"), "copies"))


def _overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.overlaps(_table(spark, sf_dir, "armbench_train"), _table(spark, sf_dir, "armbench_eval"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a training and an evaluation item with the same or nearly the same instruction."""
    found = _overlaps(spark, sf_dir)
    return found.select(F.least("train_id", "eval_id").alias("item_lo"), F.greatest("train_id", "eval_id").alias("item_hi"))


def p6_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping items per split and source."""
    found = cut_lineage(_overlaps(spark, sf_dir))
    return overlap.overlap_report(found, _table(spark, sf_dir, "armbench_train"), _table(spark, sf_dir, "armbench_eval"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs that are lists, tables or junk."""
    return quality.text_quality(_table(spark, sf_dir, "corpus_raw")).filter(F.col("kind").isin("list", "table", "junk")).select("para_id", "kind")


def p7_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph's figures of form and the kind they show."""
    return quality.text_quality(_table(spark, sf_dir, "corpus_raw"))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of every document."""
    return bpe.encode_documents(_table(spark, sf_dir, "documents"))


def p9_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The block, and the place in it, of every document or piece of one."""
    return blocks.fill_blocks(bpe.token_counts(_table(spark, sf_dir, "documents")))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the documents that hold personal information, by kind."""
    return personal.personal_lines(_table(spark, sf_dir, "documents")).distinct()


def p10_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with typed placeholders in place of personal information."""
    return personal.redacted(_table(spark, sf_dir, "documents"))


QUERIES = {
    "p1_found": p1_found,
    "p1_scores": p1_scores,
    "p1_rates": p1_rates,
    "p2_found": p2_found,
    "p2_segments": p2_segments,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p4_texts": p4_texts,
    "p5_found": p5_found,
    "p5_records": p5_records,
    "p6_found": p6_found,
    "p6_report": p6_report,
    "p7_found": p7_found,
    "p7_statistics": p7_statistics,
    "p8_ids": p8_ids,
    "p9_blocks": p9_blocks,
    "p10_found": p10_found,
    "p10_texts": p10_texts,
}
#: Letters and digits in order, letter case aside, as far as SQL folds case.
_FOLD = "regexp_replace(replace(replace(lower({0}), 'ß', 'ss'), chr(1415), chr(1381) || chr(1410)), '[^\\p{{L}}\\p{{Nd}}]', '', 'g')"
_RECORDS = f"""tree AS (SELECT c.chunk_id, t.fullkey, t.type, CASE WHEN t.type = 'VARCHAR' THEN {_FOLD.format("json_extract_string(t.atom, '$')")} ELSE CAST(t.atom AS VARCHAR) END AS v
    FROM (SELECT * FROM raw_chunks WHERE json_valid(chunk)) c, json_tree(c.chunk) t),
  records AS (
    SELECT 'corpus_raw' AS tab, para_id AS id, {_FOLD.format("text")} AS k FROM corpus_raw WHERE {_FOLD.format("text")} <> ''
    UNION ALL SELECT 'raw_chunks', chunk_id, string_agg(fullkey || ' ' || type || ' ' || coalesce(v, ''), chr(10) ORDER BY fullkey) FROM tree GROUP BY chunk_id)"""

ORACLE: dict[str, str] = {
    "p5_found": f"WITH {_RECORDS}, f AS (SELECT *, min(id) OVER (PARTITION BY tab, k) AS first_id FROM records) SELECT tab, first_id, id AS copy_id FROM f WHERE id <> first_id",
    "p5_records": f"""WITH {_RECORDS}, f AS (SELECT tab, min(id) AS row_id, count(*) AS copies FROM records GROUP BY tab, k)
      SELECT tab, row_id, copies FROM f UNION ALL SELECT 'corpus_raw', para_id, 1 FROM corpus_raw WHERE para_id NOT IN (SELECT id FROM records)
      UNION ALL SELECT 'raw_chunks', chunk_id, 1 FROM raw_chunks WHERE chunk_id NOT IN (SELECT id FROM records)""",
}
