import public_tokenizers
from test_similar import plain_groups

import corpus_pipeline
from visitmart.llm.decontamination import contaminated
from visitmart.llm.mixing import mixture
from visitmart.llm.packing import tokens
from visitmart.llm.quality import quality


def test_each_stage_does_what_its_operator_says(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("labels", "benchmark"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.materialize(stage(spark, docs, data), name)
        assert out.columns == docs.columns
        ids = sorted(r["doc_id"] for r in out.select("doc_id").collect())
        if name == "quality":
            assert ids == sorted(r["doc_id"] for r in quality(docs, labels).where("predicted = 1").collect())
        elif name == "near_dedup":
            rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
            assert ids == sorted({rows[i]["doc_id"] for i in plain_groups([r["text"] for r in rows])})
        elif name == "decontamination":
            bad = {r["doc_id"] for r in contaminated(docs, bench).collect()}
            assert ids == sorted({r["doc_id"] for r in docs.collect()} - bad)
        else:
            taken = {r["doc_id"]: -(-r["taken"] // r["size"]) for r in mixture(docs).where("taken > 0").collect()}
            assert ids == sorted(i for i, n in taken.items() for _ in range(n))
        kept[name] = len(ids)
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, data).collect()
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    assert sum(r["n_tokens"] for r in packed) == sum(len(tokens(r["text"], path)) + 1 for r in docs.collect())
    assert corpus_pipeline.run(spark, data).count() == len(packed)


def test_names(spark):
    import __spark_entry__ as entry

    queries = entry.queries()
    assert "pipeline" in queries and {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries if q.startswith("op") and q[2].isdigit()}
