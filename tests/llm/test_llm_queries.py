"""The registered corpus queries on the given tables, and the pipeline's stages."""

from __future__ import annotations

import os
from collections import defaultdict

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from compare import TABLES, same_rows
from footfall.llm import quality_classifier as classifier
from footfall.llm.common import table
from footfall.llm.oracle import SQL
from footfall.llm.queries import QUERIES
from test_llm_joins import brute_components, brute_hits
from test_llm_models import brute_pii

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")


def test_every_operator_is_registered():
    names = set(queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= names and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    database = duckdb.connect()
    for each in TABLES:
        database.execute(f"CREATE VIEW {each} AS SELECT * FROM '{SF_DIR}/{each}.parquet'")
    cursor = database.execute(SQL[name])
    columns = [column[0] for column in cursor.description]
    result = QUERIES[name](spark, SF_DIR)
    assert sorted(result.columns) == sorted(columns)
    assert not same_rows(result.columns, [tuple(r) for r in result.collect()], columns, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_covers_its_table(spark, name):
    source, key = ("pages", "page_id") if name.startswith("op9") else ("documents", "doc_id")
    wanted = {r[0] for r in table(spark, SF_DIR, source).select(key).collect()}
    assert {r[0] for r in QUERIES[name](spark, SF_DIR).select(key).collect()} == wanted


def test_stages_do_what_brute_force_does(spark):
    docs = table(spark, SF_DIR, "documents")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    model = classifier.train(classifier.document_statistics(docs), table(spark, SF_DIR, "labels"))
    texts = {r.doc_id: r for r in docs.collect()}
    scores = model.scores([classifier.statistics(r.text.encode()) for r in texts.values()])
    good = {d for d, s in zip(texts, scores) if s >= classifier.ACCEPT}
    kept = stages["quality_classifier"](spark, docs, SF_DIR)
    assert {r.doc_id for r in kept.collect()} == good and 0 < len(good) < len(texts)

    kept = stages["jaccard_join"](spark, docs, SF_DIR)
    groups = brute_components([(d, r.text) for d, r in texts.items()])
    assert {r.doc_id for r in kept.collect()} == {d for d, (_, root) in groups.items() if d == root}

    items = [(r.item_id, r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    clean = {d for d, r in texts.items() for n, hit, _ in [brute_hits(r.text, items)] if not hit or 20 * hit < n}
    kept = stages["decontamination"](spark, docs, SF_DIR)
    assert {r.doc_id for r in kept.collect()} == clean

    masked = stages["personal_data"](spark, docs, SF_DIR)
    assert masked.columns == columns
    rows = {r.doc_id: r for r in masked.collect()}
    assert set(rows) == set(texts)
    for doc_id, r in rows.items():
        assert not brute_pii(r.text) and r.n_chars == len(r.text) or r == texts[doc_id]


def test_stages_take_whatever_comes(spark, tmp_path):
    fields = "doc_id BIGINT, text STRING, row INT, masked STRING, n_chars BIGINT"
    rows = [(1, "a b c d e f", 1, "m", 9), (1, "a b c d e f", 1, "m", 9), (None, None, None, None, None),
            (None, "A B C D E F", 2, "n", 1), (3, "", 3, "o", 0), (4, "mail a@b.cd", 4, "p", 11)]
    docs = spark.createDataFrame(rows, fields)
    for name, columns in (("labels", "doc_id BIGINT, quality INT, toxic INT"), ("benchmark", "item_id BIGINT, text STRING")):
        spark.createDataFrame([], columns).write.parquet(f"{tmp_path}/{name}.parquet")
    found = defaultdict(list)
    for name, run in corpus_pipeline.STAGES[:-1]:
        result = run(spark, docs, str(tmp_path))
        assert result.columns == docs.columns and result.schema == docs.schema
        found[name] = [tuple(r) for r in result.collect()]
        assert run(spark, docs.limit(0), str(tmp_path)).count() == 0
    order = lambda rs: sorted(map(repr, rs))
    assert order(found["quality_classifier"]) == order(rows) == order(found["decontamination"])
    assert order(found["jaccard_join"]) == order([rows[0], *rows[2:3], *rows[4:]])
    assert (4, "mail <EMAIL>", 4, "p", 12) in found["personal_data"] and len(found["personal_data"]) == 6
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert packed.count() == 6


def test_the_stage_states_its_rule_of_similarity(spark, tmp_path, monkeypatch):
    from footfall.llm.jaccard_join import jaccard_join

    monkeypatch.setattr(jaccard_join, "__defaults__", (5, 80, *jaccard_join.__defaults__[2:]))
    words = [f"w{i}" for i in range(480)]
    docs = spark.createDataFrame(
        [(1, " ".join(words[:400])), (2, " ".join(words)), (3, " ".join(words[:470]))], "doc_id BIGINT, text STRING")
    kept = dict(corpus_pipeline.STAGES)["jaccard_join"](spark, docs.filter("doc_id < 3"), str(tmp_path))
    assert {r.doc_id for r in kept.collect()} == {1, 2}  # 0.832
    kept = dict(corpus_pipeline.STAGES)["jaccard_join"](spark, docs.filter("doc_id > 1"), str(tmp_path))
    assert {r.doc_id for r in kept.collect()} == {2}  # 0.979
