"""CSV files with quoted multi-line cells, read by many tasks.

Spark's own multi-line reader gives a whole file to one task.  Here a file is
read as lines, a block of it per task, and whether a block begins inside a
quoted cell is settled afterwards:

1. Every line is classed for both cases, its block beginning outside or inside
   a quoted cell: which record of the block it belongs to, and whether it is
   blank, a record of its own, or part of one.  Lines and classes are stored
   as one table, so both later reads see the same blocks.
2. A block either ends in the same state in both cases, keeps the state or
   flips it.  A window over the blocks of a file (a row each) gives the state
   every block begins in, and the record an unfinished cell belongs to.
3. Lines that are records go straight on.  Only lines of multi-line records
   are grouped, by the place where the record starts.

Quotes follow RFC 4180: a cell is quoted if its first character is a quote,
doubled quotes stand for one, other quotes are text.  Lines end in ``\\n`` or
``\\r\\n`` (in quoted cells either is kept as it is); a file of lone ``\\r``
is one line.  Text is UTF-8.  The first record of every file is its header;
blank lines are skipped; short rows get nulls, further cells are dropped.  A
cell left open at the end of a file ends there.  Files that can't be split
(gzip) are one block.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsim.session import store_table

# A row for every line: its block, its number there, and for a block that
# begins outside (0) or inside (1) a quoted cell: the record (0 continues
# the block before), the kind of line and whether a cell is open after it.
LINES = ("file string, block long, n long, line string, "
         "r0 long, k0 int, o0 int, r1 long, k1 int, o1 int")
BLANK, SINGLE, PART = 0, 1, 2


def classed_lines(lines: DataFrame) -> DataFrame:
    """``LINES`` of ``(file, block, line)``, the lines of a block in order."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def opens(line: str, inside: bool) -> bool:
            """Whether a quoted cell is open at the end of ``line``."""
            if '"' not in line:
                return inside
            at = 0
            while True:
                if not inside:
                    if line.startswith('"', at):
                        inside, at = True, at + 1
                        continue
                else:
                    at = line.find('"', at)
                    if at < 0:
                        return True
                    if line.startswith('"', at + 1):
                        at += 2
                        continue
                    inside, at = False, at + 1
                at = line.find(",", at) + 1               # text up to the next cell
                if at == 0:
                    return False

        here, n, state = None, 0, []
        for b in batches:
            out: list[list] = [[] for _ in range(8)]
            for key in zip(*(b.column(x).to_pylist() for x in range(3))):
                line = key[2]
                if key[:2] != here:
                    here, n, state = key[:2], 0, [(0, False), (0, True)]
                    if here[1] == 0:
                        line = line.removeprefix("﻿")
                row = [n, line]
                for x, (record, inside) in enumerate(state):
                    after = opens(line, inside)
                    if inside:
                        kind = PART
                    elif line in ("", "\r"):
                        kind = BLANK
                    else:
                        record, kind = record + 1, PART if after else SINGLE
                    state[x] = record, after
                    row += [record, kind, int(after)]
                n += 1
                for c, v in zip(out, row):
                    c.append(v)
            types = [pa.int64(), pa.string(), *[pa.int64(), pa.int32(), pa.int32()] * 2]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, t) for c, t in zip(out, types))],
                                             ["file", "block", "n", "line", "r0", "k0", "o0", "r1", "k1", "o1"])

    return lines.select("file", "block", "line").mapInArrow(work, LINES)


def block_states(classed: DataFrame) -> DataFrame:
    """Per block ``(file, block, inside, before, from_block, from_record)``:
    whether it begins inside a quoted cell, how many records of its file begin
    before it, and the record that a cell open at its start belongs to."""
    blocks = classed.groupBy("file", "block").agg(
        F.max("r0").alias("r0"), F.max("r1").alias("r1"), F.max_by("o0", "n").alias("o0"), F.max_by("o1", "n").alias("o1"))
    order = Window.partitionBy("file").orderBy("block")
    upto, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    flips = blocks.withColumn("flips", F.sum((F.col("o0") > F.col("o1")).cast("int")).over(upto))
    settled = F.when(F.col("o0") == F.col("o1"), F.struct("o0", "flips"))
    last = flips.withColumns({"_at": F.last(settled, ignorenulls=True).over(before), "_flips": F.lag("flips").over(order)})
    inside = F.pmod(F.coalesce(F.col("_at.o0") + F.col("_flips") - F.col("_at.flips"), F.col("_flips"), F.lit(0)), F.lit(2)) == 1
    known = last.withColumn("inside", inside).withColumn("records", F.when(F.col("inside"), F.col("r1")).otherwise(F.col("r0")))
    start = F.last(F.when(F.col("records") > 0, F.struct("block", "records")), ignorenulls=True).over(before)
    return known.withColumns({"before": F.coalesce(F.sum("records").over(before), F.lit(0)), "_start": start}).select(
        "file", "block", "inside", "before", F.col("_start.block").alias("from_block"), F.col("_start.records").alias("from_record"))


def stored_lines(spark: SparkSession, path: str) -> DataFrame:
    """The classed lines of the CSV files of ``path``, stored."""
    raw = spark.read.option("lineSep", "\n").text(path)
    raw = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))
    return store_table(classed_lines(raw), "csv-lines")


def records(classed: DataFrame) -> DataFrame:
    """``(file, block, record, text)``: every record of stored lines but the
    headers, under the place where it starts."""
    pick = lambda x: F.when(F.col("inside"), F.col(f"{x}1")).otherwise(F.col(f"{x}0"))
    lines = classed.join(block_states(classed), ["file", "block"]).select(
        "file", "block", "n", "line", "before", "from_block", "from_record", pick("r").alias("record"), pick("k").alias("kind"))
    lines = lines.filter(F.col("kind") != BLANK).withColumn("header", (F.col("before") == 0) & (F.col("record") == 1))
    single = lines.filter((F.col("kind") == SINGLE) & ~F.col("header")).select("file", "block", "record", F.col("line").alias("text"))
    goes_on = F.col("record") == 0
    parts = lines.filter(F.col("kind") == PART).select(
        "file", "header", "before", F.struct("block", "n", "line").alias("part"),
        F.when(goes_on, F.col("from_block")).otherwise(F.col("block")).alias("block"),
        F.when(goes_on, F.col("from_record")).otherwise(F.col("record")).alias("record"))
    # a group is one record: as large as a row of the result
    joined = parts.groupBy("file", "block", "record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["line"]), "\n").alias("text"),
        F.bool_or("header").alias("header")).filter(~F.col("header"))
    whole = single.unionByName(joined.select("file", "block", "record", "text"))
    return whole.withColumn("text", F.regexp_replace("text", r"\r\z", ""))


def read_blocks(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The CSV files of ``path`` as a table: columns of ``schema`` by place,
    or strings named by the first header, and ``_file``, ``_block``, ``_pos``,
    where a row starts."""
    if schema is None:
        # reads one record
        schema = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).schema
    return parsed(records(stored_lines(spark, path)), schema)


def parsed(records: DataFrame, schema: T.StructType) -> DataFrame:
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    row = F.from_csv("text", ddl, {"multiLine": "true", "escape": '"', "lineSep": "\n"}).alias("_row")
    got = records.select(F.col("file").alias("_file"), F.col("block").alias("_block"), F.col("record").alias("_pos"), row)
    return got.select(*[F.col("_row").getField(f.name).alias(f.name) for f in schema.fields], "_file", "_block", "_pos")
