"""A training corpus from raw documents: stages that each apply one operator of tripmill.llm to what the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import jaccard, lines, mixing, packing, quality
from tripmill.session import shared_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: SQL has no expectation-maximisation, fitted scorer or tokenizer, so stages are tested against brute force.
ORACLE_SQL = None


def _columns(docs: DataFrame) -> DataFrame:
    """The columns of documents, with n_chars as it now is."""
    text_size = F.length(F.coalesce(F.col("text"), F.lit(""))).cast("long")
    return docs.select(*[text_size.alias(c) if c == "n_chars" else F.col(c) for c in COLUMNS])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label quality classifier does not reject.

    Null and empty texts, and those of blanks alone, go. Repeated rows and rows with a null doc_id are judged each.
    """
    return _columns(quality.classify(docs.select(*COLUMNS)).where("quality_kept"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an other document with a larger doc_id keeps. None goes; a text may become empty."""
    docs = docs.select(*COLUMNS)
    return _columns(lines.LineIndex.build(docs).dedup(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document of smallest doc_id.

    Of rows equal in doc_id and text one stays; rows that share a doc_id but not the text stay or go together, as links
    are between doc_ids. A row with a null doc_id has no component, and stays. A null or empty text is near nothing, and
    stays. An empty table gives no rows.
    """
    docs = docs.select(*COLUMNS)
    classes = jaccard.jaccard_join(docs)
    gone = classes.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti")
    named = kept.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id", "text"])
    return _columns(named.unionByName(kept.where(F.col("doc_id").isNull())))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the Pareto mix takes them: a row per copy.

    Texts without words, a null one too, add nothing to a source and are taken as the order says. Nulls in source are a source.
    Equal rows are ranked alike, as the order is by doc_id. An empty table gives no rows.
    """
    mixed = mixing.pareto_mix(docs.select(*COLUMNS)).where("copies > 0")
    return _columns(mixed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document in its training sequence; a null or empty text is a piece of the end id alone."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", one_of_each_group),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.option("compression", "zstd").parquet(path)
        docs = spark.read.parquet(path)
    return docs
