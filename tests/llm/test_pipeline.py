"""The pipeline as a whole, and the registered queries."""

from __future__ import annotations

import random
import re

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from farelake.llm import catalog

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = entry.queries()
    assert [n for n in range(1, 14) if not any(re.match(rf"op{n}_", q) for q in names)] == []
    assert "pipeline" in names and set(catalog.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_sql_counterparts(spark, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        db.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    expected = db.sql(catalog.oracle_sql()[name])
    found = catalog.queries()[name](spark, SF).select(*expected.columns)
    assert sorted(map(tuple, found.collect())) == sorted(expected.fetchall())


@pytest.fixture(scope="module")
def planted(spark):
    """The documents and, with ids from 100,000 on, a copy, a near copy, junk and a repeated passage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id")
    good = docs.join(labels, "doc_id").where("lang = 'en' and n_chars between 1500 and 6000").orderBy("doc_id").collect()
    clean, other = [r for r in good if len(set(r.text.split())) > 150][:2]
    words = clean.text.split()
    draw = random.Random(6)  # the words of a good document in another order: good, and no copy of anything
    passage, before, after = ([draw.choice(other.text.split()) for _ in range(n)] for n in (55, 120, 120))
    rows = [
        (100_000, clean.text, "en", "s", 0),
        (100_001, " ".join([*words[:100], "another", *words[101:]]), "en", "s", 0),
        (100_002, " ".join(f"{w.upper()}!!" for w in words), "en", "s", 0),
        (100_003, " ".join([*before, *passage]), "en", "s", 0),
        (100_004, " ".join([*passage, *after]), "en", "s", 0),
        (100_005, "123 456 !!", "en", "s", 0),
        (100_006, None, None, None, None),
    ]
    return docs.unionByName(spark.createDataFrame(rows, docs.schema)), after


def test_stages(spark, planted):
    docs, unique = planted
    columns = docs.columns
    after = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given = {r.doc_id for r in docs.collect()}
        rows = stage(spark, docs, SF).collect()
        docs = spark.createDataFrame(rows, docs.schema)
        assert docs.columns == columns and {r.doc_id for r in rows} <= given
        after[name] = {r.doc_id: r for r in rows}
    assert 100_005 not in after["language"] and 100_006 not in after["language"]
    assert 100_002 in after["language"] and 100_002 not in after["quality"]
    assert {100_000, 100_001} <= set(after["quality"])
    assert not {100_000, 100_001} & set(after["near duplicates"])
    assert after["passages"][100_003].text == after["near duplicates"][100_003].text
    assert after["passages"][100_004].text == " ".join(unique)
    assert after["passages"][100_004].n_chars == len(after["passages"][100_004].text)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == set(after["passages"])


def test_run(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.count() > 0 and {"doc_id", "sequence_id", "offset", "length"} <= set(found.columns)


def test_quality_keeps_all_where_nothing_is_labelled(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("doc_id", F.col("doc_id") + 10**9)
    assert corpus_pipeline.keep_good_quality(spark, docs, SF).count() == docs.count()


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0


def stage_rows(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()), key=repr)


def test_near_duplicates_lose_no_different_document(spark):
    """Different texts with one id both stay, of equal texts one does, also without ids; odd columns are carried."""
    texts = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(6)]
    rows = [(1, texts[0], 7), (1, texts[1], 7), (2, texts[0], 7), (None, texts[2], 7), (None, texts[2], 7), (None, texts[3], 7)]
    rows += [(3, texts[4], 7), (3, texts[4], 7), (4, None, 7), (4, "", 7), (None, None, 7), (5, texts[2], 7)]
    names = "doc_id long, text string, _first int, _kept int, component_id int, _key int, order int, none int, _row int"
    docs = spark.createDataFrame([(*r[:2], *[7] * 7) for r in rows], names)
    kept = corpus_pipeline.keep_one_of_similar(spark, docs, SF)
    assert kept.columns == docs.columns and kept.select("_first", "_row").distinct().collect() == [(7, 7)]
    expected = [(1, texts[0]), (1, texts[1]), (5, texts[2]), (None, texts[3]), (3, texts[4]), (4, None), (4, ""), (None, None)]
    assert stage_rows(kept) == sorted(expected, key=repr)


def test_one_long_text_does_not_empty_a_language(spark):
    """A text beyond the sample's bytes that is first in hash order; and odd columns."""
    from farelake.llm import language

    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang in ('en', 'de')")
    long_text = " ".join(docs.where("lang = 'en'").first()["text"].split() * 400)
    long_text = long_text * (1 + 17_000_000 // len(long_text))
    ids = spark.range(50_000, 52_000).orderBy(F.xxhash64("id")).first()["id"]
    added = spark.createDataFrame([(ids, long_text, "en", "s", 1)], docs.schema)
    # Repeated ids, and columns whose names the sampling used to use.
    odd = docs.unionByName(docs.withColumn("text", F.concat("text", F.lit(" again")))).unionByName(added)
    odd = odd.withColumns({c: F.lit(7) for c in ("id", "calibrates", "l", "rank", "_row", "t")})
    models = language.learn(odd, F.lit(True))
    judged = language.identify(docs.select("doc_id", "text", "lang"), models)
    right = judged.where("_row.lang = lang_pred and not rejected").count()
    assert right >= 0.97 * docs.where("text rlike '[a-z]'").count()


def test_stages_carry_odd_columns_and_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    odd = docs.withColumns({c: F.lit(7) for c in ("id", "calibrates", "_first", "_kept", "score", "kept", "_bucket", "_id", "_text")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, SF).columns == odd.columns, name
        assert stage(spark, odd.where("false"), SF).collect() == [], name
    assert corpus_pipeline.STAGES[-1][1](spark, odd.where("false"), SF).collect() == []
