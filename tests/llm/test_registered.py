"""Every registered query on the smallest fixture: its columns, and its SQL where there is one."""

import glob
import os

import pytest

from kaghamar.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "p1_found": "tab string, row_id bigint", "p2_found": "para_id bigint, lang string", "p3_found": "pair_id bigint, defect string", "p4_found": "tab string, row_id bigint", "p5_found": "tab string, first_id bigint, copy_id bigint",
    "p6_found": "item_lo bigint, item_hi bigint", "p7_found": "para_id bigint, kind string", "p8_ids": "doc_id bigint, ids array<int>", "p10_found": "doc_id bigint, line_no int, kind string",
}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no fixture")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    if name in COLUMNS:
        assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == COLUMNS[name]
    rows = [tuple(str(v) for v in r) for r in df.collect()]
    assert rows and (name not in COLUMNS or len(rows) == len(set(rows)))
    if name in ORACLE:
        duckdb = pytest.importorskip("duckdb")
        con = duckdb.connect()
        for path in glob.glob(SF + "/*.parquet"):
            con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
        frame = con.sql(ORACLE[name]).df()[df.columns]
        assert sorted(rows) == sorted(tuple(str(v) for v in r) for r in frame.itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no fixture")
def test_every_document_and_row_is_there(spark):
    documents, corpus = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "corpus_raw"))
    assert QUERIES["p8_ids"](spark, SF).count() == QUERIES["p10_texts"](spark, SF).count() == documents.count()
    assert QUERIES["p7_statistics"](spark, SF).count() == corpus.count()
    assert QUERIES["p1_scores"](spark, SF).filter("tab = 'corpus_raw'").count() == corpus.count()
