"""CSV records with line breaks inside quotes, from files that stay split.

A split of a file does not know whether it starts inside a quoted field. Read once from both possibilities, it becomes a
function from the state at its start to that at its end; chained in file order, these give the start of every split. Each
split then cuts its own lines into records. Only a record that runs over the end of its split is put together across tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rasterloom.session import ship, stored

WHOLE, OPEN, REST = 0, 1, 2
_EMITTED = 4 << 20


def ends_inside(line: str, inside: bool, sep: str = ",") -> bool:
    """Whether a quoted field is open at the end of a line that starts with one open or not.

    A quote opens a field only as its first character; elsewhere it is text. A doubled quote stays inside; after any other
    one the field goes on unquoted to the next separator.
    """
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            while at >= 0 and line[at + 1 : at + 2] == '"':
                at = line.find('"', at + 2)
            if at < 0:
                return True
            inside = False
        elif line[at : at + 1] == '"':
            inside, at = True, at + 1
            continue
        at = line.find(sep, at)
        if at < 0:
            return False
        at += len(sep)


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """(file, block, lines) of the runs of rows of one split."""
    start = 0
    while start < batch.num_rows:
        rest = batch.slice(start)
        file, block = rest.column(0)[0], rest.column(1)[0]
        same = pc.and_(pc.equal(rest.column(0), file), pc.equal(rest.column(1), block))
        end = pc.index(same, False).as_py()
        end = rest.num_rows if end < 0 else end
        yield file.as_py(), block.as_py(), rest.column(2).slice(0, end)
        start += end


def _ends(sep: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, outside, inside): the state at the end of a split, by that at its start."""
    now, ends = None, (False, True)
    for batch in batches:
        for file, block, lines in _runs(batch):
            if (file, block) != now:
                if now:
                    yield _row(now, ends)
                now, ends = (file, block), (False, True)
            for line in lines.filter(pc.match_substring(lines, '"')).to_pylist():
                outside = ends_inside(line, ends[0], sep)
                ends = (outside, outside if ends[0] == ends[1] else ends_inside(line, ends[1], sep))
    if now:
        yield _row(now, ends)


def _row(split: tuple[str, int], ends: tuple[bool, bool]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([x]) for x in (*split, *ends)], names=["file", "block", "outside", "inside"])


def _chained(splits: pa.Table) -> pa.Table:
    """The splits of one file that start inside a quoted field, and -1 if the file ends inside one."""
    inside, found = False, []
    for row in splits.sort_by("block").to_pylist():
        if inside:
            found.append((row["file"], row["block"]))
        inside = row["inside"] if inside else row["outside"]
    if inside:
        found.append((row["file"], -1))
    return pa.table({"file": pa.array([f for f, _ in found], pa.string()), "block": pa.array([b for _, b in found], pa.int64())})


def _cut(starts, sep: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, row, kind, record): whole records, one open at the end of its split, and the rest of an earlier one."""
    known = starts.value
    now, row, inside, held, kind = None, 0, False, [], WHOLE
    out, size = [], 0

    def end(kind: int) -> None:
        nonlocal row, size
        text = "\n".join(held)
        if text:
            out.append((*now, row, kind, text))
            size += len(text) + 64
            row += kind != REST
        held.clear()

    for batch in batches:
        for file, block, lines in _runs(batch):
            if (file, block) != now:
                if held:
                    end(OPEN if kind == WHOLE else REST)
                now, row, inside = (file, block), 0, (file, block) in known
                kind = REST if inside else WHOLE
            for line in lines.to_pylist():
                held.append(line)
                if inside or '"' in line:
                    inside = ends_inside(line, inside, sep)
                if not inside:
                    end(kind)
                    kind = WHOLE
                if size >= _EMITTED:
                    yield _records(out)
                    out, size = [], 0
    if held:
        end(OPEN if kind == WHOLE else REST)
    if out:
        yield _records(out)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
    names = ["file", "block", "row", "kind", "record"]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def records(spark: SparkSession, path: str | list[str], sep: str = ",") -> DataFrame:
    """(file, block, row, record): the non-empty records of text files, where each starts, and its number in that split.

    Line breaks inside a record are line feeds. A field left open takes the rest of its file, as a reader of the whole file
    would have it. The driver holds the splits that start inside a field, one entry for each at most.
    """
    ship(spark)
    lines = _lines(spark, path)
    ends = lines.mapInArrow(partial(_ends, sep), "file string, block long, outside boolean, inside boolean")
    # Each split is a row, so a file's are bounded by its size over that of a split.
    inside = ends.groupBy("file").applyInArrow(lambda splits: _chained(splits), "file string, block long").collect()
    starts = spark.sparkContext.broadcast({(r.file, r.block) for r in inside})
    split = sorted({r.file for r in inside if r.block >= 0})
    unclosed = sorted({r.file for r in inside if r.block < 0})
    cut = partial(_cut, starts, sep)
    schema = "file string, block long, row long, kind int, record string"
    found = lines.mapInArrow(cut, schema)
    if split:  # read once for whole records and for the pieces of others, from the same splits
        found = stored(found, "records")
    # In a file without a record over a border, only its last one can be open.
    closed = F.when(F.col("kind") == OPEN, F.concat("record", F.lit('"'))).otherwise(F.col("record"))
    whole = found.where((F.col("kind") == WHOLE) | ~F.col("file").isin(split)).withColumn("record", closed).drop("kind")
    if not split:
        return whole
    pieces = found.where((F.col("kind") != WHOLE) & F.col("file").isin(split))  # a few rows a split
    before = Window.partitionBy("file").orderBy("block", F.desc("kind")).rowsBetween(Window.unboundedPreceding, 0)
    owner = F.last(F.when(F.col("kind") == OPEN, F.struct("block", "row")), ignorenulls=True).over(before)
    joined = pieces.withColumn("owner", owner).groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("block", "record"))).alias("parts"))
    last = F.col("file").isin(unclosed) & (F.col("owner") == F.max("owner").over(Window.partitionBy("file")))
    text = F.concat(F.array_join("parts.record", "\n"), F.when(last, '"').otherwise(""))
    return whole.unionByName(joined.select("file", "owner.block", "owner.row", text.alias("record")))
