"""The pipeline's stages take effect on what they are given; the registered queries run."""

from __future__ import annotations

import zlib

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check_oracle import _rows
from circulation.llm import queries
from circulation.llm.common import written
from conftest import SF_SMALL


def test_stages_keep_columns_and_whole_rows(cluster):
    docs = cluster.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(cluster, docs, SF_SMALL), f"test-{name}")
        rows = docs.collect()
        assert docs.columns == columns and len(rows) == len({r["doc_id"] for r in rows})
        assert {r["doc_id"] for r in rows} <= before and rows
        assert all(r["n_chars"] == len(r["text"]) for r in rows)
        before = {r["doc_id"] for r in rows}
    packed = corpus_pipeline.STAGES[-1][1](cluster, docs, SF_SMALL).collect()
    assert {r["doc_id"] for r in packed} == before
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "pii", "best_fit_packing"]


def test_clean_labelled_documents_pass_the_quality_stage(cluster):
    docs = cluster.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in cluster.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.quality_rules(cluster, docs, SF_SMALL).collect()}
    clean = [r for r in docs.collect() if labels.get(r["doc_id"]) == 1 and len((r["text"] or "").split()) >= 50]
    assert clean and all(r["doc_id"] in kept for r in clean)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracles(cluster, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = entry.queries()[name](cluster, SF_SMALL)
    want = con.sql(entry.oracle_sql()[name])
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(want.columns)
    assert _rows(df.columns, got) == _rows(want.columns, want.fetchall())


def test_shards_of_the_registered_query(cluster):
    rows = entry.queries()["op5_byte_shards"](cluster, SF_SMALL).collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in cluster.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert len(rows) == len(texts) and {r["law"] for r in rows} == {"bytes"}
    for r in rows:
        assert r["size"] == len(texts[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]])


def test_stages_take_odd_rows(documents, cluster):
    """Nulls in any column, empty and very long texts, repeated rows, clashing extra columns, and an empty table."""
    from pyspark.sql import functions as F

    words = [f"word{i % 97}" for i in range(120)]
    rows = [(1, None), (2, ""), (3, " ".join(words)), (3, " ".join(words)), (None, " ".join(reversed(words))), (4, "long " * 40_000 + "end")]
    extra = {c: F.lit(7) for c in ("rows_total", "listed", "node", "rank", "row", "kept", "leaks")}
    docs = documents(rows, extra).withColumn("lang", F.when(F.col("doc_id") != 3, F.col("lang")))
    for table in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(cluster, table, "/root/testdata/sf0.001")
            assert out.columns == table.columns, name
            assert out.count() <= table.count(), name
        packed = corpus_pipeline.STAGES[-1][1](cluster, table, "/root/testdata/sf0.001")
        assert {r["doc_id"] for r in packed.select("doc_id").collect()} == {r["doc_id"] for r in table.select("doc_id").collect()}
