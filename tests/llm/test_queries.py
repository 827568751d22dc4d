"""Registered queries, their SQL, and the pipeline."""

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from fleetpulse.llm.queries import ORACLE, QUERIES
from tools.compare import canonical


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_matches_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    cursor = con.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(cursor.fetchall(), columns)


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14)) and "pipeline" in names


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        from fleetpulse.llm.common import staged

        docs = staged(stage(spark, docs, sf_dir), name)
        now = docs.count()
        if name != "mixing_to_weights":
            assert docs.columns == columns and 0 < now <= before
            before = now
    assert docs.columns == [*columns, "copy"] and docs.count() > 0
    assert docs.groupBy("doc_id").count().where("count > 3").count() == 0
