"""The pipeline's stages, each on its predecessor's rows, against SQL; the packed rows against the tokenizer."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from loanlens.llm import packing, sql
from tests.compare import compare
from tests.llm.rows import SCHEMA
from tests.llm.test_packing import ids, law

SF = "/root/testdata/sf0.01"


def expected(con: duckdb.DuckDBPyConnection) -> dict[str, object]:
    """doc_id and text (and copies) after each stage, by SQL."""
    con.sql(f"CREATE TABLE kept AS WITH {sql.quality_ctes()} SELECT n.* EXCLUDE (rid) FROM judged j JOIN numbered n USING (rid) WHERE kept")
    con.sql(f"""CREATE TABLE clean AS WITH {sql.line_ctes('kept')}, numbered AS (SELECT row_number() OVER () AS rid, * FROM kept)
        SELECT n.doc_id, c.clean AS text, n.lang, n.source, length(c.clean) AS n_chars FROM line_clean c JOIN numbered n USING (rid)
        WHERE len(dropped) = 0 OR regexp_matches(clean, '[^\\x20\\x09-\\x0D]')""")
    con.sql(f"CREATE TABLE single AS WITH RECURSIVE {sql.jaccard_ctes('clean')} SELECT clean.* FROM clean JOIN classes USING (doc_id) "
            "WHERE doc_id = component_id")
    con.sql(f"CREATE TABLE mixture AS WITH {sql.mixing_ctes('single')} SELECT s.*, copies FROM mix JOIN single s USING (doc_id)")
    rows = lambda t: con.sql(f"SELECT doc_id, text, lang, source, n_chars FROM {t}").fetchall()
    repeated = con.sql("SELECT doc_id, text, lang, source, n_chars FROM (SELECT *, unnest(range(copies)) FROM mixture)").fetchall()
    return {"quality rules": rows("kept"), "line dedup": rows("clean"), "near duplicates": rows("single"), "mixing": repeated}


def test_every_stage(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = expected(con)
    docs = source = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == source.columns
        got = sorted(tuple(r) for r in docs.collect())
        assert got == sorted(map(tuple, want[name])), name
        assert got
    counts = [len(want[name]) for name, _ in corpus_pipeline.STAGES[:-1]]
    assert counts[0] < docs.sparkSession.read.parquet(f"{SF}/documents.parquet").count() and counts[1] < counts[0] and counts[2] <= counts[1]
    # the mixture holds some texts twice: give each copy an id of its own for the check
    unique = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(sorted(map(tuple, want["mixing"])))], docs.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, unique, SF).collect()
    texts = {r["doc_id"]: ids(r["text"]) for r in unique.collect()}
    assert law(packed, packing.Limits(), texts) == 0


def test_run_is_all_stages(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.count() > 0 and "sequence_id" in rows.columns
    assert entry.queries()["pipeline"] is corpus_pipeline.run


def test_stages_bear_an_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0, name


NAMES = [n for n in entry.oracle_sql() if n.startswith("op")]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    n, problems = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], sf)
    assert not problems, problems
    assert n > 0
