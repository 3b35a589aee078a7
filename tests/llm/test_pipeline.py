"""The registered queries, and the pipeline stage by stage."""

import sys
from collections import Counter, defaultdict
from pathlib import Path

import corpus_pipeline
import pytest
from millrace.llm import mixing, queries
from millrace.session import Workspace, drop_workspaces
from pyspark.sql import functions as F
from test_rows import expected_mixture, library_ids, linked_components

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import __spark_entry__ as entry_points  # noqa: E402
import compare  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    frame = queries.QUERIES[name](spark, SF_DIR)
    assert compare.differences(frame, compare.views(SF_DIR).sql(queries.ORACLES[name])) == []
    drop_workspaces()


def test_everything_is_registered():
    names = list(entry_points.queries())
    for number in range(1, 11):
        assert sum(n.startswith(f"op{number}_") for n in names) == 1
    assert "pipeline" in names and set(entry_points.oracle_sql()) <= set(names)


def test_sharding_query(spark):
    rows = queries.QUERIES["op2_shard_minimax"](spark, SF_DIR).collect()
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}
    assert {r["shard"] for r in rows} <= set(range(40)) and len(rows) == 200


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before the first stage and after each."""
    with Workspace(spark, "stages") as work:
        docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
        odd = [(10**6, None, "en", None, 0), (10**6 + 1, "", None, "src1", 0), (10**6 + 2, "?!", "en", "src1", 2),
               (None, docs.first()["text"], "en", "src1", 9)]
        docs = docs.unionAll(spark.createDataFrame(odd, docs.schema))
        found = [docs]
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, found[-1], SF_DIR)
            made.write.parquet(work.path(f"out_{name}"))
            found.append(spark.read.parquet(work.path(f"out_{name}")))
        yield found


def rows_of(docs):
    return [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]


def test_all_but_the_last_stage_return_documents(stages):
    for made in stages[:-1]:
        assert made.columns == corpus_pipeline.COLUMNS


def test_language_drops_what_has_none(stages):
    left = {i for i, _, _ in rows_of(stages[0])} - {i for i, _, _ in rows_of(stages[1])}
    assert left == {10**6, 10**6 + 1, 10**6 + 2}


def test_quality_keeps_the_good(spark, stages):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {i for i, _, _ in rows_of(stages[2])}
    good = [i for i, v in labels.items() if v == 1]
    bad = [i for i, v in labels.items() if v == 0]
    assert sum(i in kept for i in good) >= 0.9 * len(good)
    assert sum(i in kept for i in bad) <= 0.5 * len(bad)


def test_one_of_each_group_stays(stages):
    before = [r for r in rows_of(stages[2]) if r[0] is not None]
    want = {i for i, (_, _, kept) in linked_components(before, 80).items() if kept}
    after = Counter(i for i, _, _ in rows_of(stages[3]))
    assert {i for i in after if i is not None} == want and set(after.values()) == {1}


def test_two_texts_under_one_id(spark):
    """A text stays though its id also stands for a copy; near-equal texts of one id do not both."""
    one, two, three = (" ".join(f"{w}{k}" for k in range(40)) for w in "abc")
    rows = [(1, one), (2, one.upper()), (2, two), (3, three), (3, three + " end"), (3, three), (4, three + " end"), (5, ""), (5, "?")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = sorted((i, t) for i, t, _ in rows_of(corpus_pipeline.near_duplicates(spark, docs, SF_DIR)))
    of_three = [t for i, t in left if i == 3]
    assert [r for r in left if r[0] != 3] == [(1, one), (2, two), (5, ""), (5, "?")]
    assert len(of_three) == 1 and of_three[0] in (three, three + " end")


def test_mixture_repeats_documents(spark, stages):
    before, after = rows_of(stages[3]), Counter(rows_of(stages[4]))
    assert set(after) <= set(before) and max(after.values()) <= 3
    sizes, targets = expected_mixture(before)
    taken, largest = Counter(), Counter()
    for (_, text, source), times in after.items():
        taken[source] += times * len(text.split())
    for _, text, source in before:
        largest[source] = max(largest[source], len(text.split()))
    assert all(abs(taken[s] - targets[s]) <= largest[s] for s in targets)
    again = corpus_pipeline.mixture(spark, stages[3], SF_DIR)
    assert Counter(rows_of(again)) == after


def test_sequences_hold_every_document(stages):
    documents = Counter((i, len(library_ids("byte_bpe_50k.json", t, 0))) for i, t, _ in rows_of(stages[4]))
    held, room = Counter(), defaultdict(int)
    for r in stages[5].collect():
        held[r["doc_id"], r["doc_tokens"]] += r["length"]
        room[r["sequence_id"]] += r["length"]
    assert held == Counter({k: n * k[1] for k, n in documents.items()})
    assert max(room.values()) <= 1024


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF_DIR)
        assert made.count() == 0
        docs = docs if made.columns == docs.columns else None


def test_run_applies_all_stages(spark):
    made = corpus_pipeline.run(spark, SF_DIR)
    assert made.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0
    assert made.count() > 100
    drop_workspaces()


def test_threshold_levels_end(spark, work):
    """Many rows of one hash are one step that no finer bucket splits."""
    rows = spark.createDataFrame([(1, "a", 10, 77)] * 50 + [(2, "a", 1, 99)], "doc_id long, source string, size long, hash long")
    aims = spark.createDataFrame([("a", 501, 100.0)], "source string, source_size long, target double")
    assert mixing.thresholds(rows, aims, work, 3).first()["last_hash"] == 76
