"""One query for each training-data operator, over whole tables, with the SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmart.llm.common import table
from visitmart.llm.decontamination import contaminated
from visitmart.llm.embedding_dedup import embedding_groups
from visitmart.llm.language_id import language_id
from visitmart.llm.minhash import EDITED_SQL, edited_likeness
from visitmart.llm.mixing import MIXTURE_SQL, mixture
from visitmart.llm.packing import pack
from visitmart.llm.quality import quality
from visitmart.llm.repair import REPAIRED_SQL, damaged, repair
from visitmart.llm.simhash import simhash_groups
from visitmart.llm.token_counts import token_counts
from visitmart.llm.toxicity import toxicity
from visitmart.llm.warc import DIGESTS_SQL, archive_digests
from visitmart.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(table(spark, sf_dir, "embeddings"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_digests(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(table(spark, sf_dir, "documents"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations")), gone="gone")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` is null where it exceeds a long."""
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_packing, op2_embedding_dedup, op3_language_id, op4_token_counts, op5_simhash, op6_quality, op7_mixing, op8_warc, op9_toxicity, op10_decontamination, op11_minhash, op12_repair, op13_whitening)}


def oracle_sql() -> dict[str, str]:
    return {"op7_mixing": MIXTURE_SQL, "op8_warc": DIGESTS_SQL, "op11_minhash": EDITED_SQL, "op12_repair": REPAIRED_SQL}
