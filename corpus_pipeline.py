"""From raw documents to a training mix: five stages, each one operator of ``revisa.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; what it keeps is written as
Parquet and read again as the next stage's docs.  All but the last return the columns of
documents.  The stages, and what each decides on all that its predecessor kept:

1. toxicity: documents the class-conditional models reject go;
2. line dedup: lines an earlier document holds go (n_chars follows the text);
3. SimHash near-dedup: of each near group the smallest doc_id stays;
4. benchmark decontamination: documents holding a test window go;
5. mixing: words each document gives to the mix.

Rows with a null doc_id pass the third stage; in the fourth, the text alone decides on each
row.  An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revisa.llm import decontam, line_dedup, mixing, simhash, toxicity
from revisa.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = docs.columns
    out = line_dedup.dedup_lines(docs, keep=[c for c in names if c not in ("doc_id", "text", "n_chars")])
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*names)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs, shingle=4, max_bits=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document is known here by the digest of its text, which alone decides, and not by its id, which may be null or repeated."""
    text = F.sha2(F.col("text").cast("string").cast("binary"), 256)
    found = decontam.decontaminate(docs.select(text.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"), window=10, slop=None)
    gone = found.where("contaminated").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, text == F.col("_gone"), "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]

#: Language models, hashes and components are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over sf_dir's documents, the result of each but the last written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
