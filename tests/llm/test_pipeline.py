"""The pipeline's stages against brute force on their own inputs, and the
registered queries against their SQL."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from conftest import SF_SMALL
from shelfwise.llm import quality
from shelfwise.llm.common import read_table
from shelfwise.plans.oracle import compare, duckdb_views
from test_decontamination import brute as contaminated
from test_line_dedup import brute as without_lines
from test_near_dedup import brute as components
from test_tokens_and_packing import check_packing


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Every stage's input and output, written and read again."""
    docs, out = read_table(spark, SF_SMALL, "documents"), {}
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF_SMALL).write.parquet(path)
        out[name] = (docs, spark.read.parquet(path))
        docs = out[name][1]
    return out


def texts(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_all_but_the_last_return_documents(stages, spark):
    columns = read_table(spark, SF_SMALL, "documents").dtypes
    for name, (_, after) in list(stages.items())[:-1]:
        assert after.dtypes == columns, name


def test_quality_stage_drops_what_the_query_rejects(stages, spark):
    before, after = stages["quality"]
    scored = quality.quality_scores(before, read_table(spark, SF_SMALL, "labels"))
    keep = {r.doc_id for r in scored.where("predicted = 1").collect()}
    assert texts(after) == [t for t in texts(before) if t[0] in keep]


def test_line_stage(stages):
    before, after = stages["line_dedup"]
    assert texts(after) == [(i, t) for i, _, _, t in sorted(without_lines(texts(before), 60), key=lambda r: r[0])]
    assert after.where("n_chars <> length(text)").count() == 0


def test_near_duplicate_stage(stages):
    before, after = stages["near_dedup"]
    keep = {i for i, _, _, kept in components(texts(before), 5) if kept}
    assert texts(after) == [t for t in texts(before) if t[0] in keep]


def test_decontamination_stage(stages, spark):
    before, after = stages["decontamination"]
    items = [(r.item_id, r.text) for r in read_table(spark, SF_SMALL, "benchmark").collect()]
    bad = {r[0] for r in contaminated(texts(before), items)}
    assert texts(after) == [t for t in texts(before) if t[0] not in bad]


def test_packing_stage_and_run(stages, spark):
    before, after = stages["packing"]
    check_packing(after.collect(), dict(texts(before)), 4096)
    key = lambda df: sorted((r.doc_id, r.start, r.ids_crc32) for r in df.collect())
    assert key(pipeline.run(spark, SF_SMALL)) == key(after)


@pytest.mark.parametrize("name", [n for n in sorted(entry.oracle_sql()) if n.startswith("op")])
def test_queries_equal_their_sql(spark, name):
    assert not compare(entry.queries()[name](spark, SF_SMALL), entry.oracle_sql()[name], duckdb_views(SF_SMALL))


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in entry.queries() and [n for n, _ in pipeline.STAGES][0] == "quality"
