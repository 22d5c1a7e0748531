"""The operators' queries over the given tables: thin digests of what the operators return."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revisa.llm import chat, decontam, langid, license_scan, line_dedup, lm, merkle, mixing, quality, simhash, toxicity, variants, warc
from revisa.llm.common import table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = warc.captures(table(spark, sf_dir, "pages"), min_bytes=0)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], rows.schema)
    return chat_digest(chat.format_parts(rows.unionByName(added)))


def chat_digest(parts: DataFrame) -> DataFrame:
    """What the formatted parts and loss ranges say, read back from them alone, a part at a time."""

    def run(batches):
        now, known = chat.Digest(), None
        for batch in batches:
            ids, out = [], []
            for i in range(batch.num_rows):
                key = batch.column(0)[i]
                if known is not None and not key.equals(known):
                    ids.append(known)
                    out.append(now.row())
                    now = chat.Digest()
                known = key
                now.add(*(batch.column(c)[i].as_py() for c in (2, 3, 4)))
            if out:
                yield rows_of(ids, out)
        if known is not None:
            yield rows_of([known], [now.row()])

    def rows_of(ids, out):
        columns = [pa.array(list(c)) for c in zip(*out)]
        return pa.RecordBatch.from_arrays([pa.array([x.as_py() for x in ids], ids[0].type), *columns], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    kind = parts.schema["conv_id"].dataType.simpleString()
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return ordered.mapInArrow(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_groups(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated"
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc,
        op2_quality_rules,
        op3_chat_formatting,
        op4_license_scan,
        op5_line_dedup,
        op6_toxicity,
        op7_simhash_dedup,
        op8_decontamination,
        op9_mixing,
        op10_language_id,
        op11_spelling_variants,
        op12_merkle_manifest,
        op13_lm_scoring,
    )
}
