"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

Each source asks for its share of the budget by weight; a source whose share exceeds
``max_epochs`` of its own size is clamped there and the excess is shared again by weight
among the others until none is above its cap.  Every document is then taken in whole
repetitions, plus one more for a seeded part of the source: documents stand in the order
of a seeded hash, and the extra repetition covers the words before the source's cut (the
document on the cut is taken in part, a fractional repetition).

The cut is found without ordering a whole source in one task: words are summed per
source and hash bucket (map-side combined), the bucket holding the cut is found from
those sums, and only that bucket's documents are ordered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revisa.llm.common import written

#: Hash buckets per source, as hexadecimal digits of the order hash.
BUCKET_DIGITS = 3


def sized(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, size in words and the seeded order hash of each row."""
    size = F.coalesce(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")
    text = F.md5(F.coalesce(F.col("text"), F.lit("")))
    u = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), text))
    return docs.select("doc_id", "source", size.alias("size"), u.alias("u"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], budget: float, max_epochs: float) -> DataFrame:
    """(source, source_size, target) by water-filling.

    Sources are numbered by code point, null last; ``weights`` repeats over them.
    Each round is one small aggregate over the sources; two sums come to the driver.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1  # one row per source
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    per = written(per.select("source", "source_size", weight.alias("weight")), "mix-sources")
    cap = F.col("source_size") * float(max_epochs)
    total = budget * float(per.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0])
    clamped = F.lit(False)
    level, n = 0.0, -1
    while True:
        row = per.agg(
            F.coalesce(F.sum(F.when(clamped, cap)), F.lit(0.0)).alias("capped"),
            F.coalesce(F.sum(F.when(~clamped, F.col("weight"))), F.lit(0.0)).alias("weight"),
            F.count(F.when(clamped, 1)).alias("n"),
        ).first()
        if row["n"] == n or row["weight"] == 0.0:
            break
        n = row["n"]
        level = (total - row["capped"]) / row["weight"]
        clamped = F.col("weight") * level > cap
    return per.select("source", "source_size", F.when(F.lit(row["weight"] == 0.0) | clamped, cap).otherwise(F.col("weight") * level).alias("target"))


def mix_sources(
    docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), budget: float = 1.5, max_epochs: float = 2.0, seed: int = 42
) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target (its source's) and taken (words, repeats counted).

    ``budget`` is the mix's share of all words.  Words a source takes are its target
    rounded to whole words.  A null text has size 0; rows with equal id and text are
    interchangeable and each counts; a source without words has target 0; an empty
    table gives no rows.
    """
    small = written(sized(docs, seed), "mix-sizes")
    targets = source_targets(small, weights, budget, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = targets.select(F.col("source").alias("_source"), "source_size", "target", whole.alias("whole"))
    plan = plan.withColumn("extra", F.round("target").cast("long") - F.col("whole") * F.col("source_size"))

    bucket = F.substring("u", 1, BUCKET_DIGITS)
    sums = small.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("source").orderBy("bucket")) - F.col("words")
    sums = sums.withColumn("before", before).select(F.col("source").alias("_s"), "bucket", "words", "before")
    cut = plan.join(sums, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("before") <= F.col("extra")) & (F.col("extra") < F.col("before") + F.col("words")), "left")
    cut = written(cut.select("_source", "source_size", "target", "whole", "extra", F.col("bucket").alias("cut_bucket"), "before"), "mix-plan")
    return _taken(small, cut)


def _taken(rows: DataFrame, cut: DataFrame) -> DataFrame:
    bucket = F.substring("u", 1, BUCKET_DIGITS)
    both = rows.join(cut, F.col("source").eqNullSafe(F.col("_source")), "left")
    on_cut = bucket.eqNullSafe(F.col("cut_bucket"))
    ahead = F.sum("size").over(Window.partitionBy("source").orderBy("u").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    # no cut bucket: the extra repetition covers the whole source or nothing
    plain = F.when(F.col("cut_bucket").isNull(), F.when(F.col("extra") > 0, F.col("size")).otherwise(F.lit(0))).otherwise(
        F.when(bucket < F.col("cut_bucket"), F.col("size")).otherwise(F.lit(0))
    )
    partial = F.least(F.col("size"), F.greatest(F.lit(0), F.col("extra") - F.col("before") - F.col("ahead")))
    outside = both.where(~on_cut).withColumn("more", plain.cast("long"))
    inside = both.where(on_cut).withColumn("ahead", ahead).withColumn("more", partial.cast("long")).drop("ahead")
    names = ["doc_id", "source", "size", "source_size", "target"]
    return outside.unionByName(inside).select(*names, (F.col("whole") * F.col("size") + F.col("more")).cast("long").alias("taken"))
