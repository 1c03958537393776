"""Memory of reused Python workers, given back at the end of a task."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

Rows = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

caches: list[dict] = []
"""What operators keep in a worker for their next task; work of another kind empties them."""


def release() -> None:
    """Give what the process has freed back to the system; a worker lives on and keeps it otherwise."""
    pa.default_memory_pool().release_unused()
    try:
        trim = ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # not every C library has it
        return
    trim(0)


def letting_go(rows: Rows, *, keep: bool = False) -> Rows:
    """``rows``, which gives its memory back when its task's batches are through; with ``keep``, ``caches`` stay as they are."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keep:
            for cache in caches:
                cache.clear()
        yield from rows(batches)
        release()

    return wrapped


def letting_go_of_groups(group: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``group``, which gives back what it worked with before its result is sent; an idle worker keeps it otherwise."""

    def wrapped(table: pa.Table) -> pa.Table:
        made = group(table)
        release()
        return made

    return wrapped
