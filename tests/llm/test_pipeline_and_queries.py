import random

import plain
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from sheaf.llm import langid, linededup, mixing, nearjoin, queries
from sheaf.llm.common import word_count

SMALL = "/root/testdata/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_all_operators_are_registered():
    names = set(contract.queries())
    assert {name.split("_")[0] for name in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= names and set(queries.SQL) <= set(queries.QUERIES)


def test_language_query(spark):
    rows = queries.op1_language(spark, SMALL).collect()
    lang = {r.doc_id: r.lang for r in documents(spark).collect()}
    judged = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and sum(r.lang_pred == lang[r.doc_id] for r in judged) / len(judged) > 0.95


def test_stages(spark, tmp_path):
    """Each stage against what its operator is tested for, on what the one before kept."""
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "lines", "near_duplicates", "mixture", "packing"]
    docs = documents(spark)
    columns = docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{number}")
        result = spark.read.parquet(f"{tmp_path}/{number}")
        rows = result.collect()
        if name != "packing":
            assert result.columns == columns
        after = {r.doc_id: r.text for r in rows} if name != "packing" else {}
        if name == "language":
            assert all(before[i] == t for i, t in after.items()) and len(after) > 0.97 * len(before)
        elif name == "lines":
            sims = {i: t for i, t in before.items()}
            assert all(set((t or "").split("\n")) <= set((sims[i] or "").split("\n")) for i, t in after.items())
        elif name == "near_duplicates":
            root = plain.near(list(before.items()), 80)
            assert set(after) == {i for i in before if root[i] == i}
        elif name == "mixture":
            assert set(after) <= set(before)
        else:
            ends = {}
            for r in rows:
                ends[r.sequence_id] = ends.get(r.sequence_id, 0) + r.length
            assert max(ends.values()) <= 2048 and {r.doc_id for r in rows} == set(before)
        docs, before = result, after or before


def test_run_is_the_stages_in_order(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    again = corpus_pipeline.run(spark, SMALL).collect()
    key = lambda rs: sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in rs)
    assert rows and key(rows) == key(again)


@pytest.mark.parametrize("number", range(4))
def test_stages_take_odd_tables(spark, number):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, _row int"
    rng = random.Random(number)
    vocab = plain.vocabulary(rng)
    say = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    rows = [(i, say(30), "xx", "s", 1, "k", 2) for i in range(20)] + [(None,) * 7, (5, "", None, None, None, None, None), (5, say(4), None, None, 0, "", 0)]
    _, stage = corpus_pipeline.STAGES[number]
    for frame in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        result = stage(spark, frame.repartition(3), SMALL)
        assert result.columns == frame.columns and result.count() <= 3 * len(rows)
