"""The corpus pipeline: quality rules, near-duplicate removal, benchmark
decontamination, mixing, and token shards in training order.

Defined cases, for every stage: a document without words has no quality, so
NULL, empty and blank texts go in the first; a NULL id is one like others, after
all numbers where an order counts; copies tie, and the smallest id of a group
stays; texts of any length are worked on whole; an empty table stays empty;
columns beyond those of ``documents`` pass through to the last stage, whatever
their names.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written and read again as the next one's ``docs``; all but the last return
the columns of ``documents``. A row is known by its id and text together, so
repeated ids are no trouble; rows equal in both are one document from the
second stage on. No SQL gives the rows of the last stage (tokens), so
``ORACLE_SQL`` is None; stages and whole are tested against a plain-Python model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.llm import decontam, line_quality, mixing, ngram_join, training_order
from sheaf.llm.common import pick, table
from sheaf.session import scratch_path

KEY, PLACE = "_pipeline_key", "_pipeline_place"


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a key that sorts by doc_id (NULL last), then text."""
    number = F.lpad(F.hex(F.col("doc_id").cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return docs.withColumn(KEY, F.concat(F.coalesce(number, F.lit("~")), F.md5(F.coalesce("text", F.lit("\x00null")))))


def _as_docs(keyed: DataFrame, *names: str) -> DataFrame:
    return pick(keyed, KEY, *names).withColumnRenamed(KEY, "doc_id")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose their failing lines."""
    return line_quality.clean(docs, "text", "n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each component stays."""
    keyed = _keyed(docs)
    found = ngram_join.join(_as_docs(keyed, "text"))
    stay = found.filter("doc_id = component_id").select(F.col("doc_id").alias(KEY)).distinct()
    return keyed.join(stay, KEY, "left_semi").dropDuplicates([KEY]).select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    keyed = _keyed(docs)
    found = decontam.judge(_as_docs(keyed, "text"), table(spark, sf_dir, "benchmark"))
    bad = found.filter("contaminated").select(F.col("doc_id").alias(KEY)).distinct()
    return keyed.join(bad, KEY, "left_anti").select(*docs.columns)


def weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in the order of the mix."""
    keyed = _keyed(docs)
    sized = _as_docs(keyed, "source", "text").select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"))
    order = mixing.mix_order(sized.dropDuplicates(["doc_id"])).select(F.col("doc_id").alias(KEY), F.col("place").alias(PLACE))
    return keyed.dropDuplicates([KEY]).join(order, KEY).repartitionByRange(PLACE).sortWithinPartitions(PLACE).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in training order; returns where each sequence is."""
    return training_order.training_order(docs, scratch_path(spark, "tokens"))


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("mixing to target weights", weights),
    ("token binary output", tokens),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"stage-{k}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
