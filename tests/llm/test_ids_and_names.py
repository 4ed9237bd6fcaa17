"""64-bit ids beside nulls, odd column names and column types, in every operator."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from visitmart.llm.common import labelled_sample
from visitmart.llm.decontamination import contaminated
from visitmart.llm.language_id import language_id
from visitmart.llm.mixing import draw, mixture
from visitmart.llm.packing import pack
from visitmart.llm.quality import quality
from visitmart.llm.simhash import keep_one, simhash_groups
from visitmart.llm.token_counts import token_counts
from visitmart.llm.toxicity import toxicity
from visitmart.llm.warc import archive, archive_digests, fetch

IDS = [2**60 + 1, None, 2**60 + 3, 2**63 - 1, -(2**63), None, 2**53 + 1, -(2**53) - 1, 5]


@pytest.fixture(scope="module")
def large(spark):
    text = " ".join(f"word{i} and other words." for i in range(12))
    rows = [(i, f"{text} number {k % 4}", "en" if k % 2 else "de", "a" if k % 3 else None) for k, i in enumerate(IDS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, k % 2, k % 2) for k, i in enumerate(IDS)], "doc_id long, quality int, toxic int")


def ids(df, column="doc_id"):
    return sorted((r[0] for r in df.select(column).collect()), key=str)


WANT = sorted(IDS, key=str)


def test_each_operator_keeps_all_bits(large, labels):
    for got in (language_id(large), quality(large, labels), toxicity(large, labels), token_counts(large), simhash_groups(large), mixture(large)):
        assert ids(got) == WANT
    segments = pack(large).select(F.explode("segments.doc_id").alias("doc_id"))
    assert ids(segments) == WANT


def test_components_are_ids(large):
    groups = simhash_groups(large).collect()
    assert {r["component_id"] for r in groups} <= set(IDS) - {None}
    kept = [r["doc_id"] for r in keep_one(large).collect()]
    assert set(kept) <= set(IDS) and -(2**63) in kept


def test_items_and_documents_of_a_match(spark, large):
    items = spark.createDataFrame([(2**62 + 1, large.first()["text"]), (-(2**61) - 1, "no such words anywhere in there at all")], "item_id long, text string")
    got = contaminated(large, items).collect()
    assert sorted((r["doc_id"] for r in got), key=str) == WANT and {r["item_id"] for r in got} == {2**62 + 1}


@pytest.mark.parametrize("with_null", [False, True])
def test_no_payload_is_lost(spark, with_null):
    pages = [(2**60 + 1, "u", "<p>a</p>"), (2**60 + 3, "u", "<p>a</p>"), (2**60 + 5, "u", "<p>b</p>"), (-(2**63), "u", "<p>c</p>"), (2**63 - 1, "u", "<p>c</p>")]
    pages += [(None, "u", "<p>a</p>"), (None, None, None)] if with_null else []
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    rows = archive_digests(df).collect()
    assert ids(spark.createDataFrame(rows), "page_id") == sorted((p[0] for p in pages), key=str)
    responses = {(r["page_id"], r["payload_digest"]) for r in rows if r["record_type"] == "response"}
    for r in rows:  # each digest has a response, and each revisit refers to one
        assert any(d == r["payload_digest"] for _, d in responses)
        assert r["record_type"] == "response" or (r["refers_to"], r["payload_digest"]) in responses
    assert {r["page_id"]: r["refers_to"] for r in rows}[2**60 + 3] == 2**60 + 1
    assert [bytes(r["payload"]) for r in fetch(archive(df), [2**63 - 1, -(2**63), 2**60 + 5]).orderBy("page_id").collect()] == [b"<p>c</p>", b"<p>b</p>"]


ODD = ["words", "extra", "epochs", "blocks", "turns", "cut", "__key", "__row", "__number", "__doc", "odd.name", "gone", "range", "at", "key", "h"]


def test_columns_of_any_name_and_type(large):
    df = large.select("*", *[F.lit(i).alias(c) for i, c in enumerate(ODD)], F.create_map(F.lit("a"), F.lit(1)).alias("a map"))
    mixed = draw(df)
    assert mixed.columns == df.columns and mixed.count() > 0
    assert {tuple(r)[4:-1] for r in mixed.collect()} == {tuple(range(len(ODD)))}
    once = keep_one(df)
    assert once.columns == df.columns and once.schema == df.schema
    assert sorted(ids(once), key=str) == sorted(ids(keep_one(large)), key=str)


def test_an_id_of_many_texts_stays_within_the_sample(spark):
    docs = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    docs = docs.union(spark.createDataFrame([(8, "x" * 5000), (9, "short"), (10, "short too")], "doc_id long, text string"))
    labels = spark.createDataFrame([(7, 1), (8, 0), (9, 0), (10, 0)], "doc_id long, quality int")
    got = labelled_sample(docs, labels, "quality", 20, 2000)
    assert sum(c == "1" for c, _ in got) == 20
    assert all(t in ("short", "short too") for c, t in got if c == "0")  # the long one is passed over


def test_a_session_without_the_checkpoint_setting(tmp_path):
    code = (
        "from pyspark.sql import SparkSession\n"
        "from visitmart.llm.common import materialize, shared_dir\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "assert not s.conf.get('spark.checkpoint.dir', None)\n"
        "assert materialize(s.range(3), 'x').count() == 3 and shared_dir(s) == shared_dir(s)\n"
        "print('fine')\n"
    )
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": str(Path(__file__).resolve().parents[2])}
    env.pop("PYSPARK_SUBMIT_ARGS", None)
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)
    assert "fine" in done.stdout, done.stderr[-2000:]
