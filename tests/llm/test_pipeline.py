"""The pipeline's stages against plain versions, on edges, and its queries by name."""

import numpy as np
import pytest

import corpus_pipeline
from docrel.llm import decontaminate, queries
from tests.llm.test_operators import DOCS, EDGES, docs_of, jaccard_groups


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("sf")
    rng = np.random.default_rng(8)
    words = [f"wort{i}" for i in range(300)]
    good = lambda: " ".join(rng.choice(words, 60))
    rows = []
    for i in range(300):
        text = good()
        rows.append((i, " ".join(w + "%%#" for w in text.split()) if i % 5 == 0 else text))
    items = [(i, good()) for i in range(5)]
    rows += [(300 + i, rows[i][1]) for i in range(1, 40)] + [(400 + i, good() + " " + items[i % 5][1] + " " + good()) for i in range(20)] + EDGES
    docs_of(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_each_stage_on_what_the_one_before_keeps(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, tables)
        assert after.columns == docs.columns
        after.write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        ids = {r.doc_id for r in after.select("doc_id").collect()}
        if name == "quality":
            assert all(i in ids for i in range(300) if i % 5) and sum(i in ids for i in range(0, 300, 5)) <= 3
        if name == "simhash":
            rows = [(r.doc_id, r.text) for r in before.select("doc_id", "text").collect()]
            assert sorted(map(str, (r.doc_id for r in after.collect()))) == sorted(map(str, jaccard_groups(rows))) and len(ids) < len(rows) - 20
        if name == "decontaminate":
            items = spark.read.parquet(f"{tables}/benchmark.parquet").collect()
            plain = [decontaminate.normalise(i.text) for i in items]
            leaked = {r.doc_id for r in before.collect() if any(p in decontaminate.normalise(r.text) for p in plain)}
            assert leaked and ids == {r.doc_id for r in before.collect()} - leaked
        if name == "mixing":
            assert after.subtract(before).isEmpty()
        before = after
    last = corpus_pipeline.STAGES[-1][1](spark, before, tables)
    assert last.count() == before.count()


def test_run_and_empty_tables(spark, tables, tmp_path):
    assert corpus_pipeline.run(spark, tables).count() > 0
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_names():
    names = list(queries.queries())
    assert names[0] == "pipeline" and [int(n[2:].split("_")[0]) for n in names[1:]] == list(range(1, 11))
    assert set(queries.oracle_sql()) <= set(names)
