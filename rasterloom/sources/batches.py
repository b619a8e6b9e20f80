"""Helpers of Arrow batch jobs: output cut by bytes, files read a little ahead."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa

from rasterloom.sources import storage

#: Results that a worker holds before it hands them on; several workers of a task are alive at once.
FLUSH_BYTES = 1 << 20
READ_AHEAD = 8

CONTENT = {"content": pa.binary(), "status": pa.string(), "error": pa.string()}
CONTENT_SCHEMA = "content binary, status string, error string"


def schema_of(df, columns: Sequence[str], *added: str) -> str:
    """Schema text of some columns of ``df`` and further fields."""
    kept = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns]
    return ", ".join([*kept, *added])


def emit(
    batch: pa.RecordBatch,
    keep: Sequence[str],
    added: dict[str, pa.DataType],
    results: Iterable[tuple[tuple, int]],
) -> Iterator[pa.RecordBatch]:
    """Put result columns beside the kept ones.

    ``results`` gives (values, bytes) for each row in order; a batch is cut as soon as it holds
    enough bytes, so a batch of names may grow into any amount of content.
    """
    start, held, rows = 0, 0, []
    for place, (values, size) in enumerate(results):
        rows.append(values)
        held += size
        if held >= FLUSH_BYTES or place + 1 == batch.num_rows:
            part = batch.slice(start, len(rows))
            made = [pa.array([r[i] for r in rows], t) for i, t in enumerate(added.values())]
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in keep] + made, names=[*keep, *added]
            )
            start, held, rows = place + 1, 0, []


def read_ahead(uris: Sequence[str | None]) -> Iterator[tuple[bytes | None, str | None]]:
    """(content, error) of each file in order; a few files are fetched while one is worked on."""

    def fetch(uri):
        try:
            return storage.read_bytes(uri), None
        except Exception as problem:
            return None, f"read_failed: {problem}"

    with ThreadPoolExecutor(READ_AHEAD) as pool:
        waiting = deque()
        for uri in uris:
            waiting.append(pool.submit(fetch, uri))
            if len(waiting) > READ_AHEAD:
                yield waiting.popleft().result()
        while waiting:
            yield waiting.popleft().result()
