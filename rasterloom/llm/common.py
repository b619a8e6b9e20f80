"""Reading tables, handing bounded models to tasks, and walking Arrow batches in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.session import ship, stored

__all__ = ["blocks", "column", "emit", "lower_ascii", "ship", "sifted", "stored", "table", "vocabulary"]

BLOCK_BYTES = 16 << 20
EMIT_BYTES = 4 << 20
#: Bits of the bitmap over the hashes of wanted rows, in parts of 2 ** 15.
SIFT_BITS = 1 << 26


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> bytes:
    """The content of a public tokenizer's file, read where the plan is made and handed to the tasks."""
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def column(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, upper, lower))


def sifted(rows: DataFrame, hash_: Column, wanted: DataFrame, bits: int = SIFT_BITS) -> DataFrame:
    """The rows whose ``hash_`` (a long) is in the column ``hash`` of ``wanted``, and some others; no row is shuffled.

    Spares an exact join the rows that cannot meet, before they are shuffled. What is broadcast are ``bits`` at most,
    8 MB; the more rows are wanted, the more others stay: one in 16 at 4 million, most beyond 50 million.
    """
    split = lambda h: (F.shiftright(F.pmod(h, F.lit(bits)), 15), F.pmod(h, F.lit(1 << 15)).cast("int"))
    part, at = split(F.col("hash"))
    parts = wanted.select(part.alias("sift_part"), at.alias("at")).groupBy("sift_part").agg(F.bitmap_construct_agg("at").alias("sift_bits"))
    part, at = split(hash_)
    rows = rows.withColumns({"sift_part": part, "sift_at": at}).join(F.broadcast(parts), "sift_part")
    byte = F.conv(F.hex(F.expr("substring(sift_bits, cast(sift_at div 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    return rows.where(F.getbit(byte, F.expr("sift_at % 8")) == 1).drop("sift_part", "sift_at", "sift_bits")


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """Rows in blocks of about ``limit`` bytes; a larger single row is a block of its own."""
    held, size = [], 0
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            take = batch.num_rows - start
            while take > 1 and size + batch.slice(start, take).nbytes > limit:
                take = take // 2
            part = batch.slice(start, take)
            if held and size + part.nbytes > limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(part)
            size += part.nbytes
            start += take
    if held:
        yield pa.Table.from_batches(held)


def emit(schema: pa.Schema, rows: Iterator[tuple[int, tuple]], limit: int = EMIT_BYTES) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``limit`` bytes from (bytes, row) pairs."""
    held, size = [], 0
    for nbytes, row in rows:
        held.append(row)
        size += nbytes + 64
        if size >= limit:
            yield _batch(schema, held)
            held, size = [], 0
    if held:
        yield _batch(schema, held)


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
