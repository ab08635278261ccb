import pytest
from pyspark.sql import functions as F
from conftest import SF_SMALL
from llm_fixtures import no_docs  # noqa: F401

import __spark_entry__ as E
import corpus_pipeline
from repotrend.llm import minhash, pii, pu_quality, spaced_seed
from repotrend.llm.oracle import ORACLE
from repotrend.llm.queries import QUERIES


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    from tools.oracle_check import compare, duck

    r = compare(spark, name, QUERIES[name], ORACLE[name], SF_SMALL, duck(SF_SMALL))
    assert r["ok"], r


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    extra = [(90_001, None), (None, "a text without an id, and joe@example.org"), (None, None), (90_002, ""), (90_003, "x" * 30_000)]
    rows = spark.createDataFrame([(i, t, "en", None, None) for i, t in extra], docs.schema)
    before = docs.union(rows).withColumn("id", docs.lang).cache()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, before, SF_SMALL)
        path = f"{tmp_path}/{k}"
        out.write.parquet(path)
        out = spark.read.parquet(path)
        texts = {r.doc_id: r.text for r in before.collect()}
        ids = {r.doc_id for r in out.collect()}
        if name == "quality":
            model = pu_quality.trained(before, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
            assert ids == {r.doc_id for r in pu_quality.with_scores(before, model).where("score >= 0.3").collect()}
        elif name == "near_duplicates":
            assert ids - {None} == {r.doc_id for r in minhash.near_duplicates(before, n=5).where("kept").collect()} - {None}
            assert out.where("doc_id IS NULL").count() == before.where("doc_id IS NULL").count()
        elif name == "decontamination":
            found = {r.doc_id for r in spaced_seed.contaminated(before, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")).collect()}
            assert found and ids == set(texts) - found
        elif name == "pii":
            assert {r.doc_id: r.text for r in out.collect()} == {i: pii.redacted(t) for i, t in texts.items()}
        else:
            assert all(r.round_trip and r.n_tokens == len(r.ids) for r in out.collect()) and out.count() == before.count()
        if name != "encode":
            assert set(before.columns) == set(out.columns)
            assert out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        before = out


def test_pipeline_of_an_empty_table(spark, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0


def test_decontamination_is_by_row(spark):
    leak = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").first().text
    rows = [(None, leak), (None, "clean text without an id"), (1, "clean text of a repeated id"), (1, f"now {leak}"), (2, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = corpus_pipeline.decontamination_stage(spark, docs, SF_SMALL)
    assert out.columns == docs.columns
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, (rows[k] for k in (1, 2, 4, 5))))


def test_columns_named_like_those_used_within_stay(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    names = ["score", "key", "number", "row", "k", "n", "i", "__score", "__key", "__row", "component_id"]
    more = docs.limit(60).withColumns({c: F.concat(F.lit(f"{c} "), "doc_id") for c in names}).cache()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, more, SF_SMALL)
        assert out.columns == more.columns, name
        assert all(r[c] == f"{c} {r.doc_id}" for r in out.collect() for c in names), name


def test_short_items_remove_nothing(spark, tmp_path):
    spark.createDataFrame([(1, "the word"), (2, "a b c d e")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, "here is the word"), (2, "now a b c d e"), (3, None), (4, "")], "doc_id long, text string")
    out = corpus_pipeline.decontamination_stage(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in out.collect()) == [1, 3, 4]


def test_near_duplicates_are_by_row(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(7, a, "de"), (3, a + " end", "en"), (3, b, "fr"), (3, b, "en"), (None, b, "en"), (None, c, "en"), (None, c, "en"), (None, c + " end", "en"), (8, "", "en"), (9, None, "en")]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, lang string")
        out = corpus_pipeline.near_duplicate_stage(spark, docs, SF_SMALL)
        got = [tuple(r) for r in out.collect()]
        assert out.columns == docs.columns and len(got) == 5
        assert {r[:2] for r in got} - {(None, c), (None, c + " end")} == {(3, a + " end"), (3, b), (8, ""), (9, None)}
        if order is rows:
            first = got
    assert sorted(map(str, got)) == sorted(map(str, first))
