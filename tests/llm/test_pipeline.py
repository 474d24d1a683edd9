"""The stages one after the other, each against what its operator says about its own input."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
FOLDER = "/root/testdata/sf0.001"
if not Path(FOLDER).exists():
    pytest.skip("driver tables are not here", allow_module_level=True)

import __spark_entry__ as entry_module  # noqa: E402
import corpus_pipeline  # noqa: E402

from rivertally.llm import mixing, quality_rules, simhash  # noqa: E402
from rivertally.session import durable  # noqa: E402


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, outs = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = durable(stage(spark, docs, FOLDER))
        assert docs.columns == columns or k == len(corpus_pipeline.STAGES) - 1
        outs.append(docs)
    ids = [{r.doc_id for r in o.select("doc_id").collect()} for o in outs]
    source = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert ids[0] == {r.doc_id for r in quality_rules.quality_rules(source).where("kept").collect()}
    assert ids[1] == ids[0] and outs[1].agg({"n_chars": "sum"}).first()[0] < outs[0].agg({"n_chars": "sum"}).first()[0]
    assert ids[2] == {r.component_id for r in simhash.simhash_report(outs[1]).collect()}
    slots = {r.doc_id: (r.slot, r.place) for r in mixing.mixing_report(outs[2]).collect()}
    assert ids[3] == ids[2] and [r.doc_id for r in mixing.mixed(outs[2]).collect()] == sorted(ids[2], key=slots.get)
    assert ids[4] == ids[3]


def test_empty_and_awkward(spark, awkward, empty):
    for docs in (empty, awkward):
        for _, stage in corpus_pipeline.STAGES:
            docs = durable(stage(spark, docs, FOLDER))
        docs.count()


duckdb = pytest.importorskip("duckdb")
from check_queries import TABLES, canonical  # noqa: E402


@pytest.mark.parametrize("name", sorted(n for n in entry_module.oracle_sql() if n.startswith("op")))
def test_sql(spark, name):
    db = duckdb.connect()
    for table in TABLES.split():
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df, want = entry_module.queries()[name](spark, FOLDER), db.sql(entry_module.oracle_sql()[name])
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(want.fetchall(), want.columns)


def test_names():
    names = [n for n in entry_module.queries() if n.startswith("op")]
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] and "pipeline" in entry_module.queries()
