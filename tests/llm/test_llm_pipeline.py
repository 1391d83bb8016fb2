"""The corpus pipeline, stage by stage, against brute force on whole small tables."""

import pytest

import corpus_pipeline
import llm_fixtures as fx
from landfall.llm import near_duplicates
from landfall.llm.common import stored, words
from test_llm_models import check_packing
from test_llm_search import plain_components, plain_contamination

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage got and gave."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, FOLDER), f"test-{name}")
        seen[name] = (docs, out)
        docs = out
    return seen


def test_filters_keep_columns_and_only_remove(stages):
    for name, (docs, out) in list(stages.items())[:-1]:
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        before, after = set(map(tuple, docs.collect())), list(map(tuple, out.collect()))
        assert set(after) <= before and len(after) == len(set(after)), name
        assert 0.5 * len(before) < len(after) <= len(before), name


def test_toxic_labels_mostly_go(spark, stages):
    docs, out = stages["toxicity"]
    marks = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in out.select("doc_id").collect()}
    gone = {r["doc_id"] for r in docs.select("doc_id").collect()} - kept
    clean = [d for d, toxic in marks.items() if not toxic]
    assert sum(d in kept for d in clean) >= 0.99 * len(clean)
    assert sum(marks.get(d) == 1 for d in gone) >= 0.3 * sum(marks.values())


def test_one_of_each_group_stays(stages):
    docs, out = stages["near_duplicates"]
    kind = near_duplicates.EXACT
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    prints = [
        near_duplicates.simhash(near_duplicates.shingle_hashes(words(text), kind.shingle))[0]
        for _, text in rows
    ]
    roots = plain_components([p % 2**64 for p in prints], kind.distance)
    expected = [rows[i][0] for i, root in enumerate(roots) if i == root]
    assert sorted(r["doc_id"] for r in out.select("doc_id").collect()) == expected
    assert len(expected) < len(rows)


def test_contaminated_documents_go(spark, stages):
    docs, out = stages["decontamination"]
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()
    judged = plain_contamination(docs.select("doc_id", "text").collect(), items)
    clean = sorted(r[0] for r in judged if not r[5])
    assert sorted(r["doc_id"] for r in out.select("doc_id").collect()) == clean
    assert len(clean) < len(judged)


def test_packing_of_what_is_left(stages):
    docs, out = stages["packing"]
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    check_packing([tuple(r) for r in out.collect()], rows)


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, FOLDER).select("doc_id", "piece", "ids_crc32").collect()
    expected = stages["packing"][1].select("doc_id", "piece", "ids_crc32").collect()
    assert fx.multiset(got) == fx.multiset(expected)
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("rows", [fx.ROWS, []])
def test_stages_on_awkward_rows(spark, rows):
    docs = fx.documents(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, FOLDER), f"test-{name}")
        if name != "packing":
            assert out.columns == docs.columns, name
        docs = out
    assert (docs.count() > 0) == bool(rows)
