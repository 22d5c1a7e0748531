"""License scans by diagonal voting.

Every text's rolling word k-gram hashes are joined in Spark with the places of those
hashes in a small set of templates.  A hit at word i of the text and word j of a template
votes for the diagonal i - j; votes are counted per text, template and diagonal (map-side
combined), diagonals with too few votes go, neighbouring ones (words inserted or left
out) are merged, and the merged spans are verified word by word against the text.

Short phrases must stand complete on one diagonal; longer templates need ``MIN_COVER`` of
their words on the merged diagonals.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revisa.llm.common import flat, pieces
from revisa.llm.words import byte_table, find_words, rolling

TABLE = byte_table("alnum", lower=True)
K = 2
#: Widest gap between merged diagonals, least share of a template's k-grams on one diagonal, least verified share of its words.
GAP, MIN_VOTES, MIN_COVER = 3, 0.15, 0.7

# Phrases that must stand word by word, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Opening words of public license notices, and their labels.
NOTICES = {
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files": "mit",
    "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License": "apache-2.0",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met": "bsd",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License": "gpl-notice",
    "This work is licensed under the GNU General Public License": "gpl-work",
    "This work is licensed under a Creative Commons Attribution License": "creative-commons",
}


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_BYTES).split()


_BYTES = bytes(int(TABLE[b]) or 32 for b in range(256))


class Template:
    def __init__(self, text: str, label: str, exact: bool):
        self.words, self.label, self.exact = words_of(text.encode()), label, exact


def templates(phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES) -> list[Template]:
    return [Template(t, x, True) for t, x in phrases.items()] + [Template(t, x, False) for t, x in notices.items()]


def template_grams(spark: SparkSession, known: list[Template], k: int = K) -> DataFrame:
    """(gram, template, place) of every k-gram of the templates."""
    rows = []
    for number, t in enumerate(known):
        text = b" ".join(t.words)
        w = find_words(np.frombuffer(text, np.uint8), np.array([0, len(text)]), TABLE)
        grams, at = rolling(w.hash, w.text, k)
        rows += [(g, number, p) for g, p in zip(grams.view(np.int64).tolist(), at.tolist())]
    return spark.createDataFrame(rows, "gram long, template int, place int")


def named_rows(docs: DataFrame) -> DataFrame:
    """doc_id, a hash of the text (with the id it names a row) and the text, null as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("th"), text.alias("text"))


def text_grams(rows: DataFrame, k: int = K) -> DataFrame:
    """(doc_id, th, at, gram): every rolling k-gram of every text."""

    def run(batches):
        for batch in pieces(batches, "text", 1 << 20):
            words = find_words(*flat(batch.column(2)), TABLE)
            grams, at = rolling(words.hash, words.text, k)
            owner = words.text[at]
            take = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array((at - words.first[owner]).astype(np.int32)), pa.array(grams.view(np.int64))],
                names=["doc_id", "th", "at", "gram"],
            )

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, th long, at int, gram long")


def spans(rows: DataFrame, known: list[Template], k: int = K) -> DataFrame:
    """(doc_id, th, spans[template, low, high, votes]): merged diagonals with enough votes."""
    spark = rows.sparkSession
    hits = text_grams(rows, k).join(F.broadcast(template_grams(spark, known, k)), "gram")  # a few hundred rows, fixed by the templates
    votes = hits.groupBy("doc_id", "th", "template", (F.col("at") - F.col("place")).alias("diagonal")).agg(F.count_distinct("at").alias("votes"))  # a repeated row votes once
    total = F.array(*[F.lit(len(t.words) - k + 1) for t in known])[F.col("template")]
    exact = F.array(*[F.lit(t.exact) for t in known])[F.col("template")]
    votes = votes.where(F.when(exact, F.col("votes") == total).otherwise(F.col("votes") >= F.greatest(F.lit(1), F.ceil(total * MIN_VOTES))))
    by = Window.partitionBy("doc_id", "th", "template").orderBy("diagonal")
    opens = F.coalesce(exact | (F.col("diagonal") - F.lag("diagonal").over(by) > GAP), F.lit(True))
    runs = votes.withColumn("run", F.sum(opens.cast("int")).over(by))
    merged = runs.groupBy("doc_id", "th", "template", "run").agg(F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.sum("votes").alias("votes"))
    return merged.groupBy("doc_id", "th").agg(F.collect_list(F.struct("template", "low", "high", "votes")).alias("spans"))


def cover(words: list[bytes], t: Template, low: int, high: int) -> tuple[float, int]:
    """Share of the template's words found on the diagonals from low to high, and the first word of the span."""
    found, first = 0, len(words)
    for place, word in enumerate(t.words):
        for at in range(max(low + place, 0), min(high + place + 1, len(words))):
            if words[at] == word:
                found, first = found + 1, min(first, at)
                break
    return found / len(t.words), first


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, notices: dict[str, str] = NOTICES) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score.

    n_base counts the places of the phrases; first_word and last_word are their smallest
    and largest start.  ``labels`` adds those of the notices whose span verifies; score is
    the best verified share of a template's words (0 without any).  A null text has no
    words; rows with equal id and text have equal results; null ids keep their rows.
    """
    known = templates(phrases, notices)
    rows = named_rows(docs)
    voted = spans(rows, known).select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "spans")
    both = rows.join(voted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left").select("doc_id", "text", "spans")

    def run(batches):
        for batch in pieces(batches, "text"):
            data, off = flat(batch.column(1))
            buf = data.tobytes()
            n_words = find_words(data, off, TABLE).per_text
            out = []
            for i, found in enumerate(batch.column(2).to_pylist()):
                starts, base, labels, score = [], set(), set(), 0.0
                words = words_of(buf[off[i] : off[i + 1]]) if found else []
                for s in found or []:
                    t = known[s["template"]]
                    share, first = cover(words, t, s["low"], s["high"])
                    if t.exact and share == 1.0:
                        starts.append(first)
                        base.add(t.label)
                    elif t.exact or share < MIN_COVER:
                        continue
                    labels.add(t.label)
                    score = max(score, share)
                out.append((len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]
            columns = [pa.array(list(c), kind) for c, kind in zip(zip(*out), kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words.astype(np.int64)), *columns],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return both.mapInArrow(run, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
