"""Delimited dumps whose quoted fields may hold line breaks, read by many tasks.

A file is read as physical lines by Spark's splittable text source.  Whether a line begins
inside a quoted field depends on all lines before it, but each line, and so each block, only
maps "begins outside" and "begins inside" to how it ends.  These maps are composed block by
block (a prefix scan over one small row per block), which tells every block how it begins;
then each block's lines are put together to records on their own.  The one record that
crosses the end of a block is put together from that block's open end and the fragments at
the start of the blocks behind it.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revisa.sources.shared import written_once

PLACE = ["_file", "_block"]


class Quotes:
    """How a physical line carries the state "inside a quoted field" from its start to its end."""

    def __init__(self, sep: str, escape: str | None, quote: str = '"'):
        s, q = re.escape(sep), re.escape(quote)
        e = re.escape(escape) if escape and escape != quote else None
        self.quote = quote
        # the inside of a quoted field; a doubled quote, or an escaped character, does not close it
        inner = f"(?:[^{q}{e or ''}]|{q}{q}" + (f"|{e}.|{e}$)*" if e else ")*")
        skipped = f"(?:{e}.|[^{s}{e}])" if e else f"[^{s}]"
        plain = f"(?:{e}.|[^{s}{q}{e}]){skipped}*" if e else f"[^{s}{q}]{skipped}*"
        closed = f"{q}{inner}{q}(?!{q}){skipped}*"
        self._fields = re.compile(f"(?:(?:{closed}|{plain}|){s})*", re.S)
        self._opened = re.compile(f"{q}{inner}$", re.S)
        self._close = re.compile(f"{inner}{q}(?!{q}){skipped}*", re.S)

    def ends_inside(self, line: str, inside: bool) -> bool:
        if self.quote not in line:
            return inside
        at = 0
        if inside:
            closed = self._close.match(line)
            if not closed:
                return True
            at = closed.end()
            if at == len(line):
                return False
            at += 1  # the separator behind the field
        at = self._fields.match(line, at).end()
        return bool(self._opened.match(line, at))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(_file, _block, _line, value): physical lines with their block; ``_line`` ascends inside a block."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"), "value")


def block_starts(physical: DataFrame, quotes: Quotes) -> DataFrame:
    """(_file, _block, _inside, _first): how every block begins, and whether the file's first record does in it."""

    def maps(batches):
        place, ends, any_ = None, None, False
        for batch in batches:
            for file, block, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (file, block) != place:
                    if place is not None:
                        yield row(place, ends, any_)
                    place, ends, any_ = (file, block), [False, True], False
                any_ = any_ or value not in ("", "\r")
                if quotes.quote in value:
                    ends = [quotes.ends_inside(value, e) for e in ends]
        if place is not None:
            yield row(place, ends, any_)

    def row(place, ends, any_):
        return _rows([(*place, *ends, any_)], [*PLACE, "_out", "_in", "_any"], MAP_KINDS)

    def scan(batches):
        file, inside, before = None, False, False
        for batch in batches:
            told = []
            for f, block, out, in_, any_ in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if f != file:
                    file, inside, before = f, False, False
                told.append((f, block, inside, any_ and not before))
                inside, before = in_ if inside else out, before or any_
            if told:
                yield _rows(told, [*PLACE, "_inside", "_first"], MAP_KINDS)

    each = physical.select(*PLACE, "value").mapInArrow(maps, "_file string, _block long, _out boolean, _in boolean, _any boolean")
    return each.repartition("_file").sortWithinPartitions(*PLACE).mapInArrow(scan, "_file string, _block long, _inside boolean, _first boolean")


MAP_KINDS = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
RECORD_KINDS = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.bool_(), pa.bool_()]
RECORD = "_file string, _block long, _record long, _header boolean, text string"


def _rows(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def records(spark: SparkSession, path: str, sep: str, escape: str | None) -> DataFrame:
    """(_file, _block, _record, _header, text): every record with the place where it begins.

    ``_record`` counts from 0 in its block, ``_header`` marks each file's first.  Empty lines
    outside quotes are no records.  Memory is bounded by one record.
    """
    quotes = Quotes(sep, escape)
    physical = lines(spark, path)
    # written, so that its size is known: one row a file, and one for each block that begins inside a field
    known = written_once(block_starts(physical, quotes).where("_inside or _first"), "blocks-begun")
    marked = physical.join(known, PLACE, "left").sortWithinPartitions(*PLACE, "_line")

    def assemble(batches):
        place, inside, first, held, n, head = None, False, False, [], 0, False
        out: list[tuple] = []

        def end(open_):
            nonlocal held, n, head
            text = "\n".join(held)
            if not open_ and text.endswith("\r"):
                text = text[:-1]
            if head or open_ or text:
                out.append((*place, -1 if head else n, first and n == 0 and not head, text, head, open_))
                n += not head
            held, head = [], False

        for batch in batches:
            for file, block, value, begins, first_here in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if (file, block) != place:
                    if held:
                        end(inside)
                    place, n, inside, head, first = (file, block), 0, bool(begins), bool(begins), bool(first_here)
                held.append(value)
                inside = quotes.ends_inside(value, inside)
                if not inside:
                    end(False)
            if out:
                yield told(out)
                out.clear()
        if held:
            end(inside)
        if out:
            yield told(out)

    def told(rows):
        return _rows(rows, [*PLACE, "_record", "_header", "text", "_head", "_open"], RECORD_KINDS)

    def mend(batches):
        started, held = None, []
        for batch in batches:
            out = []
            for file, block, n, header, text, head, open_ in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if not head:
                    if started is not None:  # a file may end inside a quoted field
                        out.append((*started, "\n".join(held)))
                    started, held = (file, block, n, header), []
                held.append(text)
                if not open_:
                    out.append((*started, "\n".join(held)))
                    started, held = None, []
            if out:
                yield whole(out)
        if started is not None:
            yield whole([(*started, "\n".join(held))])

    def whole(rows):
        return _rows(rows, [*PLACE, "_record", "_header", "text"], RECORD_KINDS)

    pieces = marked.select(*PLACE, "value", "_inside", "_first").mapInArrow(assemble, RECORD + ", _head boolean, _open boolean")
    crossing = pieces.where("_head or _open").repartition("_file").sortWithinPartitions("_file", "_block", "_record")
    mended = crossing.mapInArrow(mend, RECORD)
    return pieces.where("not _head and not _open").select(*PLACE, "_record", "_header", "text").unionByName(mended)
