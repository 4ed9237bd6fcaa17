import duckdb
from pyspark.sql import functions as F

from visitmart.llm import mixing
from visitmart.llm.mixing import MIXTURE_SQL, WORD, draw, mixture, plan, split_quotas


def rows(df):
    return sorted((str(tuple(r)) for r in df.select("doc_id", "size", "source_size", "target", "taken", "shards").collect()))


def from_sql(df, tmp_path):
    path = f"{tmp_path}/documents"
    df.select("doc_id", "text", "source").write.parquet(path)
    c = duckdb.connect()
    c.sql(f"create view documents as from '{path}/*.parquet'")
    return sorted(str(r) for r in c.sql(f"select doc_id, size, source_size, target, taken, shards from ({MIXTURE_SQL})").fetchall())


def test_equals_sql(spark, data, odd, tmp_path):
    assert rows(mixture(odd)) == from_sql(odd, tmp_path / "a")
    docs = spark.read.parquet(f"{data}/documents.parquet")
    assert rows(mixture(docs)) == from_sql(docs, tmp_path / "b")


def test_targets_caps_and_reruns(spark, data, nothing):
    docs = spark.read.parquet(f"{data}/documents.parquet").withColumn("source", F.when(F.col("doc_id") % 50 == 0, None).otherwise(F.col("source")))
    got = mixture(docs).join(docs.select("doc_id", "source"), "doc_id")
    by = got.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.first("source_size").alias("size")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 1 and r["taken"] <= 3 * r["size"] for r in by)
    assert abs(sum(r["target"] for r in by) - sum(r["size"] for r in by)) < 1e-3
    assert got.where("taken > 3 * size").count() == 0
    assert rows(mixture(docs)) == rows(mixture(docs.repartition(7)))
    assert mixture(nothing).count() == 0 and draw(nothing).count() == 0


def test_cut_among_repeated_rows_equals_sql(spark, tmp_path):
    for n, copies in enumerate((7, 40)):
        texts = [(1, "a b c", "x")] * copies + [(2, "", "x"), (3, None, "x")] + [(10 + i, "one two three four " * (i % 5 + 1), "y") for i in range(30)]
        docs = spark.createDataFrame(texts, "doc_id long, text string, source string")
        assert rows(mixture(docs)) == from_sql(docs, tmp_path / str(n))


def test_drawn_rows_hold_the_words_taken(spark, data, odd):
    for docs in (odd, spark.read.parquet(f"{data}/documents.parquet")):
        mix = draw(docs, words_per_shard=10_000)
        assert mix.columns == docs.columns
        words = mix.select(F.sum(F.regexp_count("text", F.lit(WORD)))).first()[0]
        assert words == mixture(docs).agg(F.sum("taken")).first()[0]


def test_words_are_taken_by_shards_only(spark, data, monkeypatch):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    draws = plan(docs, words_per_shard=10_000).select(F.explode("__draws").alias("d")).groupBy("d.shard").agg(F.sum("d.words").alias("w"))
    by_shard = {r["shard"]: r["w"] for r in draws.collect()}
    assert len(by_shard) > 4
    lost = 3
    whole = mixing.split_quotas

    def without_one(quotas, shards, seed):
        shard_of = F.transform("shard_of", lambda s: F.when(s != lost, s))
        return whole(quotas, shards, seed).select("__key", shard_of.alias("shard_of"))

    monkeypatch.setattr(mixing, "split_quotas", without_one)
    assert mixture(docs, words_per_shard=10_000).agg(F.sum("taken")).first()[0] == sum(by_shard.values()) - by_shard[lost]


def test_many_sources_and_any_number_of_ranges(spark, tmp_path):
    docs = spark.createDataFrame([(i, "w " * (i % 13), f"s{i % 411}") for i in range(3000)], "doc_id long, text string, source string")
    want = from_sql(docs, tmp_path)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    assert rows(mixture(docs)) == want
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_shards_get_disjoint_runs_and_even_quotas(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    p = plan(docs, words_per_shard=10_000, block_docs=2)
    draws = p.select("doc_id", F.explode("__draws").alias("d")).select("doc_id", "d.*")
    assert draws.count() == draws.select("doc_id", "epoch").distinct().count()
    quotas = spark.createDataFrame([("a", 100), ("b", 37), ("c", 1), ("d", 0)], "__key string, quota long")
    split = {r["__key"]: r["shard_of"] for r in split_quotas(quotas, 8, 1).collect()}
    assert {k: len(v) for k, v in split.items()} == {"a": 100, "b": 37, "c": 1}
    sizes = [sum(v.count(s) for v in split.values()) for s in range(8)]
    assert max(sizes) - min(sizes) <= 2


def test_a_node_splits_its_quotas_as_drawn_without_replacement(spark):
    quotas = spark.createDataFrame([(f"s{i}", 20) for i in range(200)], "__key string, quota long")
    split = {r["__key"]: r["shard_of"] for r in split_quotas(quotas, 4, 3).collect()}
    assert all(len(v) == 20 and v == sorted(v) for v in split.values())
    assert [sum(v.count(s) for v in split.values()) for s in range(4)] == [1000] * 4
    left = [v.count(0) + v.count(1) for v in split.values()]
    # hypergeometric: 2,000 of 4,000 units, of which 20 are a source's
    want = 2000 * (20 / 4000) * (1 - 20 / 4000) * 2000 / 3999
    assert abs(sum((x - 10) ** 2 for x in left) / 200 - want) < 1.6
    below = [(v.count(0), v.count(0) + v.count(1)) for v in split.values()]  # the left child draws anew
    assert abs(sum((a - n / 2) ** 2 for a, n in below) / 200 - sum(n / 4 for _, n in below) / 200) < 1


def test_large_nodes_are_split_alike(spark):
    quotas = spark.createDataFrame([("a", 900), ("b", 370), ("c", 1), ("d", 0), ("e", 2)], "__key string, quota long")
    got = [sorted(map(tuple, split_quotas(quotas, 16, 1, most).collect())) for most in (10**6, 300, 1)]
    assert got[0] == got[1] == got[2] and len(got[0]) == 4
    assert split_quotas(quotas.limit(0), 4, 1).count() == 0 and split_quotas(quotas, 1, 1).count() == 4
