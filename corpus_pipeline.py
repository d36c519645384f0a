"""Training-data pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all documents that its
predecessor kept, and returns a DataFrame; all but the last return the columns
of ``documents``. ``run`` writes each result as a table below
``spark.checkpoint.dir`` and reads it back as the next stage's documents.

Defined cases, for every stage: a null or empty text is an empty document; it is
not toxic evidence, has no line to lose, no near duplicate and no benchmark item,
and packs as one end id; a null id stays null; repeated rows are judged alike
(one row of a near-duplicate component stays, the smallest id); columns of any
name beside ``doc_id`` and ``text`` are carried along as they are (``n_chars`` is
counted anew where lines go); an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postsift.llm import decontaminate, jaccard, line_dedup, packing, toxicity
from postsift.llm.common import find_package, read_table, store
from postsift.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models, learned from all labelled ones of this stage's documents, do not reject."""
    find_package(spark)
    learned = toxicity.fit(toxicity.labelled_rows(docs, read_table(spark, sf_dir, "labels")))
    return toxicity.keep(docs, learned)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds; ``n_chars`` counts what is left."""
    find_package(spark)
    # whole rows go along in a struct, so no column of theirs meets one of the operator's
    packed = docs.select("doc_id", "text", F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    kept = line_dedup.drop_repeated_lines(packed, carry=["row"])
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return kept.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    find_package(spark)
    return jaccard.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.remove(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences of all documents."""
    find_package(spark)
    pieces = packing.pack(docs, vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

# The toxicity models and the packing cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
