"""CSV records whose quoted fields hold line breaks, from files that are still read in splits.

Whether a line break ends a record depends on all quotes before it in the file. Reading a split
either begins inside a quoted field or not; both cases are followed through the split, which gives
what state each of them ends in. Those pairs, one for each split, are composed along each file,
and a second pass then knows the state that every split begins in. It emits the records that lie
within a split, and the pieces of records that reach over a boundary, which are few and are put
together by a shuffle of the pieces alone.
"""

import csv
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from studymart.session import materialise

#: A record can't be longer; a quote that nothing closes would swallow the rest of its file.
RECORD_CHARS = 16 << 20

_SPLITS = "path string, block long, outside boolean, inside boolean, breaks boolean"
_SPLITS_ARROW = pa.schema(
    [("path", pa.string()), ("block", pa.int64()), ("outside", pa.bool_()), ("inside", pa.bool_()), ("breaks", pa.bool_())]
)
_PIECES = "path string, block long, kind int, first boolean, text string"
_PIECES_ARROW = pa.schema(
    [("path", pa.string()), ("block", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()), ("text", pa.string())]
)
_WHOLE, _CONTINUES, _BEGINS = 0, 1, 2


class UnclosedQuote(ValueError):
    """A quoted field isn't closed within the longest record."""


def _after_field(line: str, at: int) -> int:
    """Where the field after the next comma begins; beyond the line after its last field."""
    comma = line.find(",", at)
    return len(line) + 1 if comma < 0 else comma + 1


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line that begins inside a quoted field, or outside, ends inside one.

    A quote opens a field only where the field begins; within a quoted field two are one of text.
    """
    if '"' not in line:
        return inside
    at = 0
    while at <= len(line):
        if not inside and not line.startswith('"', at):
            at = _after_field(line, at)
            continue
        at += not inside
        while (closing := line.find('"', at)) >= 0 and line.startswith('"', closing + 1):
            at = closing + 2
        if closing < 0:
            return True
        inside, at = False, _after_field(line, closing)
    return False


def _lines(spark: SparkSession, paths, glob, file_pattern, base_path) -> DataFrame:
    """(path, block, value): every line, in order within a split, without its line feed; day folders beside."""
    reader = spark.read.option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if base_path:
        reader = reader.option("basePath", base_path)
    lines = reader.text(list(paths))
    place = F.col("_metadata")
    if file_pattern:
        lines = lines.where(place["file_path"].rlike(file_pattern))
    return lines.select(place["file_path"].alias("path"), place["file_block_start"].alias("block"), "*")


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _split_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What state each split ends in, begun outside or inside, and whether any line ends inside."""
    split, rows = None, []
    for batch in batches:
        for path, block, line in zip(*(c.to_pylist() for c in batch.columns)):
            if (path, block) != split:
                if split:
                    rows.append((*split, outside, inside, breaks))
                split, outside, inside, breaks = (path, block), False, True, False
            outside, inside = ends_inside(line, outside), ends_inside(line, inside)
            breaks = breaks or outside
    if split:
        rows.append((*split, outside, inside, breaks))
    yield _table(rows, _SPLITS_ARROW)


def _states(ends: DataFrame) -> DataFrame:
    """(path, block, after): the state after each split that has quotes.

    A split maps (outside, inside) to a pair of states. What a file's splits do to its start is
    folded in order; there is a row for each split that has quotes.
    """
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A split whose two ends are equal forgets what was before: only the splits since the last such
    # one count, and each of those keeps the state or turns it.
    known = F.last(F.when(F.col("outside") == F.col("inside"), F.struct("block", "outside")), ignorenulls=True).over(before)
    turns = F.sum(F.when(F.col("outside") & ~F.col("inside"), 1).otherwise(0)).over(before)
    states = ends.withColumn("known", known).withColumn("turns", turns)
    at_known = F.last(F.when(F.col("outside") == F.col("inside"), F.col("turns")), ignorenulls=True).over(before)
    states = states.withColumn("since", F.col("turns") - F.coalesce(at_known, F.lit(0)))
    start = F.coalesce("known.outside", F.lit(False))
    state = F.when(F.col("since") % 2 == 1, ~start).otherwise(start)
    return states.select("path", "block", state.alias("after"))


class _Begun:
    """The state after each split with quotes, for files in which a record reaches over a boundary."""

    def __init__(self, rows):
        self.files: dict[str, tuple[list, list]] = {}
        for path, block, after in rows:
            blocks, states = self.files.setdefault(path, ([], []))
            blocks.append(block)
            states.append(after)

    def inside(self, path: str, block: int) -> bool:
        blocks, states = self.files.get(path, ((), ()))
        i = bisect_left(blocks, block)
        return states[i - 1] if i else False


def _header_of(text: str) -> list[str]:
    return next(csv.reader([text.removesuffix("\r")], strict=False), [])


def _check_header(path: str, text: str, header: list[str]) -> None:
    if _header_of(text) != header:
        raise ValueError(f"the header of {path} is {_header_of(text)}, not {header}")


def _pieces(
    begun: _Begun, header: list[str], longest: int, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """Records within splits, and the pieces of those that reach over a boundary."""
    split, inside, kind, first, held, size, rows, total = None, False, _WHOLE, False, [], 0, [], 0

    def close(last: int) -> None:
        nonlocal first, size, total
        if held:
            text = "\n".join(held)
            if first and last == _WHOLE:
                _check_header(split[0], text, header)
            rows.append((*split, last, first, text))
            total += size
            held.clear()
            first, size = False, 0

    for batch in batches:
        for path, block, line in zip(*(c.to_pylist() for c in batch.columns)):
            if (path, block) != split:
                close(_BEGINS if kind == _WHOLE else kind)
                split, first, inside = (path, block), block == 0, begun.inside(path, block)
                kind = _CONTINUES if inside else _WHOLE
            held.append(line)
            size += len(line) + 1
            if size > longest:
                raise UnclosedQuote(f"a quoted field of {path} after byte {block} isn't closed within {longest} characters")
            inside = ends_inside(line, inside)
            if not inside:
                close(kind)
                kind = _WHOLE
            if total >= 4 << 20 or len(rows) >= 10_000:
                yield _table(rows, _PIECES_ARROW)
                rows, total = [], 0
    close(_BEGINS if kind == _WHOLE else kind)
    yield _table(rows, _PIECES_ARROW)


def _assembled(pieces: DataFrame, header: list[str]) -> DataFrame:
    """(path, first, text) of the records that reach over boundaries: a beginning and what continues it."""
    order = Window.partitionBy("path").orderBy("block", "kind")
    began = F.last(F.when(F.col("kind") == _BEGINS, F.col("block")), ignorenulls=True)
    pieces = pieces.withColumn("began", began.over(order.rowsBetween(Window.unboundedPreceding, 0)))
    parts = F.array_sort(F.collect_list(F.struct("block", "kind", "text")))
    records = pieces.groupBy("path", "began").agg(F.max("first").alias("first"), parts.alias("parts"))
    records = records.select("path", "first", F.array_join("parts.text", "\n").alias("text"))
    named = F.lit(",".join(header))
    told = F.raise_error(F.concat(F.lit("the header of "), F.col("path"), F.lit(" differs")))
    plain = F.replace(F.rtrim(F.col("text"), F.lit("\r")), F.lit('"'), F.lit(""))
    return records.withColumn("text", F.when(F.col("first") & (plain != named), told).otherwise(F.col("text")))


def split_records(
    spark: SparkSession,
    paths: Sequence[str],
    header: Sequence[str],
    glob: str | None = None,
    file_pattern: str | None = None,
    base_path: str | None = None,
) -> DataFrame | None:
    """(path, first, text): the records of all files, or None where no quoted field holds a line break.

    ``first`` marks the header of a file, which must be the given one. Records end at a line feed. A
    record longer than ``RECORD_CHARS`` raises `UnclosedQuote`; one that the end of its file cuts is
    kept, as a malformed record. What is sent to all tasks is a state for each split of those files
    in which a record reaches over a boundary.
    """
    lines, header = _lines(spark, paths, glob, file_pattern, base_path), list(header)
    days = [c for c in lines.columns if c not in ("path", "block", "value")]
    kinds = {c: lines.schema[c].dataType for c in days}
    lines = lines.select("path", "block", "value")
    ends = materialise(lines.where(F.contains("value", F.lit('"'))).mapInArrow(_split_ends, _SPLITS), "csv_splits")
    if ends.where("breaks").isEmpty():
        return None
    states = _states(ends)
    crossed = states.withColumn("crossed", F.max("after").over(Window.partitionBy("path"))).where("crossed")
    rows = crossed.orderBy("path", "block").select("path", "block", "after").toLocalIterator()
    begun = _Begun((r.path, r.block, r.after) for r in rows)
    shared, longest = spark.sparkContext.broadcast(begun), RECORD_CHARS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pieces(shared.value, header, longest, batches)

    pieces = lines.mapInArrow(run, _PIECES)
    if begun.files:  # two readings of one scan: another scan might be split otherwise
        pieces = materialise(pieces, "csv_pieces")
    records = pieces.where(F.col("kind") == _WHOLE).select("path", "first", "text")
    if begun.files:
        records = records.unionByName(_assembled(pieces.where(F.col("kind") != _WHOLE), header))
    for c in days:  # as the scan of a folder of days gives them
        value = F.url_decode(F.regexp_extract("path", f"/{re.escape(c)}=([^/]+)/", 1))
        records = records.withColumn(c, value.cast(kinds[c]))
    return records


def parsed(records: DataFrame, names: Sequence[str], corrupt: str) -> DataFrame:
    """The fields of records as text, malformed ones kept in a side column; headers and empty lines are left out."""
    fields = ", ".join(f"`{n}` string" for n in [*names, corrupt])
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    text = F.rtrim(F.col("text"), F.lit("\r"))
    rows = records.where(~F.col("first")).withColumn("text", text).where("text <> ''")
    others = [c for c in records.columns if c not in ("path", "first", "text")]
    return rows.select(F.from_csv("text", fields, options).alias("r"), *others).select("r.*", *others)
