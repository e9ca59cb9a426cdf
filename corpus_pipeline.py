"""The corpus pipeline: toxicity, quality rules, near duplicates, repeated passages, packing.

Every stage gets the documents its predecessor kept and, but for the last, returns
documents with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import catalog, chunks, jaccard, packing, quality, toxicity
from tidemark.llm.joins import BROADCAST_ROWS, stored
from tidemark.session import scratch_path


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The documents whose id and text are not among the dropped (doc_id, mark).

    Marks tell texts apart that share an id. A document without id or text is compared
    like any other.
    """
    mark = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    gone = stored(dropped.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).distinct(), "dropped")
    on = docs["doc_id"].eqNullSafe(gone["_id"]) & (mark == gone["_mark"])
    return docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, on, "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; learnt from the labels that are not held out."""
    catalog.prepare(spark)
    model = toxicity.fit(docs, catalog.table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_outliers(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule, or lie far from their language and source, go."""
    catalog.prepare(spark)
    return _without(docs, quality.judge(docs).where("NOT kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest id stays, once; so does every unlinked one.

    Documents without words are linked with nothing and stay, as do those without an id.
    """
    catalog.prepare(spark)
    found = jaccard.join_components(docs).where("component_id <> doc_id").select(F.col("doc_id").alias("_id")).distinct()
    found = stored(found, "copies")
    kept = docs.join(F.broadcast(found) if found.count() <= BROADCAST_ROWS else found, docs["doc_id"] == found["_id"], "left_anti")
    # Rows that repeat an id are copies of one document: the first by its text stays.
    twice = stored(kept.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "twice")
    if not twice.limit(1).count():
        return kept
    repeated = kept.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min(F.struct(*[F.col(c) for c in ["text", *[c for c in docs.columns if c not in ("doc_id", "text")]]])).alias("r")
    ).select(*[F.col("doc_id") if c == "doc_id" else F.col(f"r.{c}") for c in docs.columns])
    return kept.join(twice, "doc_id", "left_anti").select(*docs.columns).unionByName(repeated)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in an earlier document are cut out of later ones."""
    catalog.prepare(spark)
    return chunks.dedup(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into windows of 1024 tokens."""
    catalog.prepare(spark)
    return packing.pack(docs, catalog.tokenizer(catalog.MERGES))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_outliers),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("packing", pack_windows),
]

# No stage but the last could be put in SQL without the ones before it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again by the next."""
    docs = catalog.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
