import zlib

import pytest
from pyspark.sql import functions as F

from visitmart.llm.language_id import language_id
from visitmart.llm.quality import keep_good, layout, quality, train
from visitmart.llm.toxicity import toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").where("doc_id % 3 = 0").cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_flag(documents):
    got = language_id(documents.limit(200), per_language=20).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)


def test_language_accuracy_on_held_out(documents):
    got = language_id(documents).where("held_out").join(documents, "doc_id")
    right, all_rows, sure, wrong = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.sum(F.col("confident").cast("int")), F.sum((F.col("confident") & (F.col("lang") != F.col("lang_pred"))).cast("int"))).first()
    assert right / all_rows > 0.97 and sure > 0.9 * all_rows and wrong <= 0.03 * sure


def scores(df, labels, column):
    rows = df.where("held_out").join(labels, "doc_id").select(F.col(column).alias("y"), "score", "predicted").collect()
    hit = sum(r["y"] == 1 and r["predicted"] == 1 for r in rows)
    return sum(r["y"] == r["predicted"] for r in rows) / len(rows), hit / max(1, sum(r["predicted"] for r in rows)), hit / sum(r["y"] for r in rows)


def test_quality_on_held_out(documents, labels):
    accuracy, precision, recall = scores(quality(documents, labels), labels, "quality")
    assert accuracy > 0.93 and recall > 0.97


def test_toxicity_on_held_out(spark, labels):
    every = spark.read.parquet(f"{SF}/documents.parquet")
    accuracy, precision, recall = scores(toxicity(every, labels), labels, "toxic")
    # a part of the toxic labels of these tables stand on texts without any sign of it
    assert accuracy > 0.93 and precision > 0.85 and recall > 0.6


def test_odd_rows_and_missing_labels(spark, odd, nothing, labels):
    own = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (7, 1, 1), (8, 0, 0), (4, 1, 0), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    for run in (lambda d, x: quality(d, x), lambda d, x: toxicity(d, x)):
        got = run(odd, own).collect()
        assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
        assert len(run(odd, own.limit(0)).collect()) == odd.count()
        assert run(nothing, own).count() == 0
    got = {r["doc_id"]: r for r in language_id(odd, per_language=5).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 12, 13)] == ["und"] * 5 and got[6]["lang_pred"] != "und"
    assert language_id(nothing).count() == 0
    assert {r["lang_pred"] for r in language_id(odd, per_language=5, reject=True).collect()} >= {"und"}
    kept = keep_good(odd, own)
    assert kept.columns == odd.columns and kept.count() <= odd.count()
    assert keep_good(odd, own.limit(0)).count() == odd.count() and keep_good(nothing, own).count() == 0


def test_network_sees_the_whole_document():
    good, bad = "calm words in a row ", "calm words ##### !!! "
    sample = [(str(i % 2), (good if i % 2 else bad) * (2 + i % 5)) for i in range(300)]
    model = train(sample, epochs=6)
    late = good * 60_000 + bad * 3
    assert model.scores([good * 60_000])[0] > 0.5 > model.scores([late])[0]
    data, first = layout([b"", b"abc", b"x" * 9])
    assert len(first) == 3 and len(data) % 4 == 0
    pieces = [good * n + bad * (n % 2) for n in range(1, 9)]
    assert abs(model.scores(pieces, size=50) - model.scores(pieces)).max() < 1e-4


def test_more_languages_than_dimensions():
    from visitmart.llm import language_id as li

    sample = [(f"l{k:02d}", " ".join(f"{'abcdefghijklmnopqrstuvwxyz'[k]}q{'xyz'[i % 3]}w{j}" for j in range(9))) for k in range(20) for i in range(30)]
    wide, narrow = li.train(sample, dim=8), li.train(sample, dim=32)
    assert wide.scores.shape[1] == 8 and narrow.scores.shape[1] == 20
    for m in (wide, narrow):
        p, _ = m.probabilities([t for _, t in sample])
        assert sum(m.languages[i] == c for i, (c, _) in zip(p.argmax(1), sample, strict=True)) > 0.9 * len(sample)
