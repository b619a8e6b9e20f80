"""Token counts with a whole-token shortcut.

Before any text is read, every vocabulary string is merged on its own; those that end as one token are proven. In
the texts a pre-token that is proven counts one without any merging, and only the other distinct pre-tokens of a
block are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.bpe import Merges, Numbered, _arrow_type, from_json, replay
from rasterloom.llm.common import blocks, column, emit, ship
from rasterloom.llm.pretokens import pretokens


def proven(model: Merges) -> frozenset[str]:
    """The vocabulary strings that are one pre-token and that the merges turn into one token."""
    tokens = [t for t in model.tokens if t]
    _, counts = replay(tokens, model)
    out = set()
    for token, n in zip(tokens, counts.tolist(), strict=True):
        if n == 1:
            try:
                text = token.decode()
            except UnicodeDecodeError:
                continue  # part of a character: no pre-token
            out.add(text)
    return frozenset(out)


def count_block(texts: list[str], model: Merges, whole: frozenset[str], special: list[str]) -> list[int]:
    """Tokens of each text; a special string is one token and ends the text before it."""
    known = Numbered()
    rows, fixed = [], []
    for text in texts:
        parts, marks = [text], 0
        for mark in special:
            if mark in text:
                parts = [piece for part in parts for piece in part.split(mark)]
        if len(parts) > 1:
            marks = len(parts) - 1
        single, others = 0, []
        for part in parts:
            words = pretokens(part)
            many = [w for w in words if w not in whole]
            single += len(words) - len(many)
            others += many
        rows.append(np.fromiter(map(known.__getitem__, others), np.int32, len(others)))
        fixed.append(single + marks)
    _, counts = replay([w.encode() for w in known], model)
    return [n + int(counts[row].sum()) for n, row in zip(fixed, rows, strict=True)]


def count_tokens(docs: DataFrame, model: bytes, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of each row, for a JSON vocabulary without added begin or end tokens.

    ``model`` is the content of the vocabulary file, whose size bounds what is handed to the tasks. A null text
    counts as empty: zero bytes, zero tokens. Repeated rows give repeated results; other columns are not read, so
    their names cannot clash; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    merges, special = from_json(model)
    if len(special) > 1:
        raise ValueError("more than one special string: their order of precedence is not defined here")
    shared = spark.sparkContext.broadcast((model, proven(merges)))
    rows = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    schema = pa.schema([("id", _arrow_type(rows)), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, whole = shared.value
        own, marks = _cached(data)

        def each():
            for block in blocks(batches):
                texts = [t or "" for t in block.column("text").to_pylist()]
                counts = count_block(texts, own, whole, marks)
                for key, text, n in zip(block.column("id").to_pylist(), texts, counts, strict=True):
                    yield 24, (key, len(text.encode()), n)

        yield from emit(schema, each())

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit).withColumnRenamed("id", id_col)


_held: dict[int, tuple[Merges, list[str]]] = {}


def _cached(data: bytes) -> tuple[Merges, list[str]]:
    key = hash(data)
    if key not in _held:
        _held[key] = from_json(data)
    return _held[key]
