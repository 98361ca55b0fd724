"""CSV files with line breaks inside quotes, read by many tasks.

Spark splits a text file by bytes and hands out whole lines, but a split may begin inside a quoted
value. So every block of lines is followed twice, as if it began outside and as if it began inside a
quote, which gives the state it ends in for either. One row a block is then put in order per file, and
the state of each block follows from that of the block before. Knowing it, a second pass cuts records;
those that reach across blocks leave one fragment in each and are put together by the block in which
they began. No file is read by one task, and none is opened by the driver.

A quote opens a value only at its start. Inside, two quotes stand for one; what follows the closing
quote up to the next comma belongs to the value; quotes elsewhere are signs like others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendloom import session

_FIELD = r'(?:"(?:[^"]|"")*+"[^,]*|[^",][^,]*)?'
_CLOSED = re.compile(f"{_FIELD}(?:,{_FIELD})*")
_CLOSING = re.compile(f'(?:[^"]|"")*+"[^,]*(?:,{_FIELD})*')
_BOM = "﻿"
BROADCAST_ROWS = 500_000  # blocks that begin inside quotes, some hundred bytes each
_WHERE = ["path", "name", "size", "start"]
_WHERE_TYPES = "path string, name string, size long, start long"


def open_after(line: str, inside: bool) -> bool:
    """Whether a quote is open at the end of a line, given whether one was open at its start."""
    if '"' not in line:
        return inside
    return (_CLOSING if inside else _CLOSED).fullmatch(line) is None


def _lines(spark: SparkSession, paths: str | Sequence[str], glob: str | None) -> DataFrame:
    reader = spark.read.option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    meta = [F.col(f"_metadata.{m}").alias(a) for m, a in zip(("file_path", "file_name", "file_size", "file_block_start"), _WHERE)]
    return reader.text(paths if isinstance(paths, str) else list(paths)).select(*meta, "value")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list, list[str]]]:
    """(place, rest of the first row, lines): stretches of a block, in order; a block may come in several."""
    for batch in batches:
        places = list(zip(*(batch.column(i).to_pylist() for i in range(4))))
        lines = batch.column(4).to_pylist()
        others = [batch.column(i) for i in range(5, batch.num_columns)]
        at = 0
        for i in range(1, len(lines) + 1):
            if i == len(lines) or places[i] != places[at]:
                yield places[at], [c[at].as_py() for c in others], lines[at:i]
                at = i


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per block: the state at its end for both states at its start, whether a record begins in it
    after a start inside quotes, and, at the start of a file, the first record."""
    now, rows = None, []

    def close() -> None:
        if now is not None:
            place, outside, inside, begins, header, _ = now
            rows.append((*place, outside, inside, begins, "\n".join(header) if place[3] == 0 else None))

    for place, _, lines in _runs(batches):
        if now is None or now[0] != place:
            close()
            now = [place, False, True, False, [], True]
        for line in lines:
            now[3] |= not now[2]
            if now[5] and place[3] == 0 and (now[4] or line.strip("\r" + _BOM)):
                now[4].append(line)
            now[1], now[2] = open_after(line, now[1]), open_after(line, now[2])
            now[5] &= now[1] or not now[4]
    close()
    if rows:
        yield _batch(rows, [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string()], [*_WHERE, "outside", "inside", "begins", "header"])


def _batch(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _chain(blocks: pd.DataFrame) -> pd.DataFrame:
    """Of one file: the blocks that begin inside quotes, and the block their first record began in."""
    out, state, owner = [], False, 0
    for b in blocks.sort_values("start").itertuples():
        if state:
            out.append((b.path, b.start, owner))
        if not state or b.begins:
            owner = b.start
        state = b.inside if state else b.outside
    return pd.DataFrame(out, columns=["path", "start", "owner"]).astype({"start": "int64", "owner": "int64"})


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records, and fragments of records that reach across blocks (``owner`` not null)."""
    names = [*_WHERE, "row_no", "owner", "record"]
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    place, held, inside, owner, seq, heading, rows = None, [], False, None, 0, False, []

    def close() -> None:
        if place is not None and held:
            row_no = -1 if heading else place[3] + seq
            rows.append((*place, row_no, place[3] if owner is None else owner, "\n".join(held)))

    for where, (began,), lines in _runs(batches):
        if where != place:
            close()
            place, held, owner, inside, seq, heading = where, [], began, began is not None, 0, where[3] == 0
        for line in lines:
            held.append(line)
            inside = open_after(line, inside)
            if not inside:
                if held[0].strip("\r" + _BOM) or len(held) > 1:
                    if not heading:
                        rows.append((*place, place[3] + seq, owner, "\n".join(held)))
                    heading = False
                held, owner, seq = [], None, seq + 1
        if len(rows) > 10_000:
            yield _batch(rows, types, names)
            rows = []
    close()
    if rows:
        yield _batch(rows, types, names)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = session.run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_records(spark: SparkSession, paths: str | Sequence[str], glob: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The records of CSV files and their headers.

    Records are (path, name, size, row_no, record): the text of each, line breaks and quotes as they
    are, without headers and empty lines. ``row_no`` grows within a file and is unique there. Headers
    are (path, header, crlf), a row per file that holds a line; ``crlf`` files end lines with two signs.
    """
    lines = _lines(spark, paths, glob)
    blocks = _stored(lines.mapInArrow(_follow, _WHERE_TYPES + ", outside boolean, inside boolean, begins boolean, header string"), "blocks")
    # A row per block of a file: as many rows as the file has splits.
    several = blocks.filter("start > 0").select("path").distinct()
    chained = blocks.join(several, "path", "left_semi").groupBy("path").applyInPandas(_chain, "path string, start long, owner long")
    chained = _stored(chained, "chained")
    if chained.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        placed = lines.join(F.broadcast(chained), ["path", "start"], "left")
    else:  # a join that moves lines has to put them back in order
        placed = lines.withColumn("_at", F.monotonically_increasing_id()).join(chained, ["path", "start"], "left")
        placed = placed.sortWithinPartitions("path", "start", "_at")
    placed = placed.select(*_WHERE, "value", "owner")
    cut = placed.mapInArrow(_cut, _WHERE_TYPES + ", row_no long, owner long, record string")
    whole = cut.filter(F.col("owner").isNull()).select("path", "name", "size", "row_no", "record")
    parts = F.array_sort(F.collect_list(F.struct("start", "row_no", "record")))
    joined = (
        cut.filter(F.col("owner").isNotNull())
        .groupBy("path", "name", "size", "owner")
        .agg(parts.alias("parts"))
        .select("path", "name", "size", F.col("parts")[0]["row_no"].alias("row_no"), F.array_join("parts.record", "\n").alias("record"))
    )
    records = whole.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", ""))
    first = blocks.filter("start = 0").select("path", F.ltrim("header", F.lit(_BOM)).alias("header"))
    headers = first.select("path", F.regexp_replace("header", "\r$", "").alias("header"), F.endswith("header", F.lit("\r")).alias("crlf"))
    return records.filter((F.col("row_no") >= 0) & (F.col("record") != "")), headers.filter("header <> ''")
