import random

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check_queries import compare
from stargrain.llm import line_dedup
from stargrain.llm.queries import ORACLES, QUERIES
from stargrain.plans.catalogue.base import TABLES
from tests.llm.fixtures import awkward, frame


def test_registered():
    assert set(QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_beside_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in (*TABLES, "documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    result, _ = compare(spark, con, name, sf_dir)
    assert result.startswith("ok"), result


def test_stages_keep_columns_and_clean_documents(spark, sf_dir):
    docs = frame(spark, [r for r in awkward() if r[0] != 800])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, sf_dir)
        assert got.columns == docs.columns, name
        if name != "quality classifier":
            ids = [r.doc_id for r in got.select("doc_id").collect()]
            assert set(range(5, 125, 10)) - {35} <= set(ids), name


def test_lines_of_every_length_go(spark, sf_dir):
    rng = random.Random(4)
    own = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(30))
    recurring = ["Share", "Read more", "posted by user number 12", " ".join(["this", "licence", *["words"] * 60]), " ".join(["this", "licence", *["words"] * 59, "2024"])]
    rows = [(10 * j + k, f"{own()}\n{line}\n{own()}") for j, line in enumerate(recurring) for k in range(5)]
    rows += [(100 + k, f"{own()}\n{line}") for k, line in enumerate(["Share it", "seen once", "12"])]
    got = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, frame(spark, rows), sf_dir).collect()}
    for d, t in rows:
        assert got[d] == (t if d >= 100 else "\n".join(t.split("\n")[::2])), d
    op8 = {r.doc_id: r.n_dropped for r in line_dedup.line_dedup(frame(spark, rows)).collect()}  # the range of its SQL
    assert {d for d, n in op8.items() if n} == set(range(20, 25))


def test_run_packs_what_the_stages_leave(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    starts = got.filter("start = 0").count()
    assert 0 < starts <= spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert got.filter("length < 1 OR length > 2048").count() == 0
