"""Cleaning a corpus: quality rules, near-duplicates, secrets, mix, ids.

``STAGES`` lists the stages; each takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's docs.
All but the last return the columns of the documents they got.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintage.llm import bpe, minhash, mixing, rules, secrets
from vintage.llm.common import fresh, ship, table
from vintage.llm.queries import vocabulary
from vintage.session import checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    judged = rules.judge(docs)
    quality = judged.columns[-1]
    return judged.filter(F.col(f"{quality}.kept")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or
    more) the document with the smallest id stays (documents without an id
    come last); of rows with equal id and equal text one. Documents that share
    an id but not the text are documents of their own."""
    ship(spark)
    key, one = fresh(docs, "row_key", "one")
    rows = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    found = minhash.near_duplicates(rows, id_col=key, shingle=5).groupBy(F.col("doc_id").alias(key)).agg(F.min("component_id").alias("component"))
    ids = rows.groupBy(key).agg(F.min("doc_id").alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", key)).alias("first")
    kept = ids.join(found, key).groupBy("component").agg(first).select(f"first.{key}")
    # rows that agree in id and text may differ elsewhere: which one stays is fixed by their content
    rank = F.xxhash64(*[f.name for f in docs.schema if "map<" not in f.dataType.simpleString()])
    stays = rows.join(kept, key, "left_semi").groupBy(key).agg(F.min_by(F.struct(*docs.columns), rank).alias(one))
    return stays.select(f"{one}.*").select(*docs.columns)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; the character count follows the text."""
    found = secrets.scan(docs)
    text = secrets.masked(F.col("text"), F.col(found.columns[-1]))
    masked = found.withColumn("text", text)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(dict(docs.dtypes)["n_chars"]))
    return masked.select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    mixed = mixing.mix(docs, carry=True)
    out = mixing.emit(mixed, docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*docs.columns)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, and whether decoding gives them back."""
    ship(spark)
    both = bpe.encode(docs.select("doc_id", "source", "text"), vocabulary(), decoded_col="decoded")
    return both.select("doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scans", secret_scans),
    ("source_mixing", source_mixing),
    ("bpe_encoding", bpe_encoding),
]

#: Near-duplicates and tokenizer ids have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder of
    spark.checkpoint.dir and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
