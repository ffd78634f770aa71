"""Arrow batches of texts as UTF-8 bytes, in slices of bounded size."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes of text that one step of a kernel works on; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20
#: Bytes and rows of a batch that goes to a Python worker at most, unless the session asks for fewer.
BATCH_BYTES, BATCH_ROWS = 2 << 20, 1_000


#: What kernels keep in a worker from task to task, by name.
_KEPT: dict[str, object] = {}


def kept(function):
    """A function whose last result stays in the worker until a scan runs that does not name it."""
    _KEPT[function.__name__] = cached = lru_cache(maxsize=1)(function)
    return cached


def _give_back(names: tuple[str, ...]) -> None:
    """Frees what only other scans keep, and gives free memory back to the system."""
    for name, cached in _KEPT.items():
        if name not in names:
            cached.cache_clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library keeps its memory
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def map_batches(frame: DataFrame, scan: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema, keeps: tuple[str, ...] = ()) -> DataFrame:
    """``frame.mapInArrow`` with batches of bounded size, whose workers hold on to no more than ``keeps`` between tasks.

    Batches stand outside the heap of an executor, a few for each task, both ways. The
    two settings of the session are lowered where they are larger, and stay so.
    """

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _give_back(keeps)
        yield from scan(batches)
        _give_back(keeps)

    conf = frame.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES), ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)):
        now = conf.get(key)
        bytes_now = _bytes(now)
        if bytes_now <= 0 or bytes_now > most:
            conf.set(key, str(most))
    return frame.mapInArrow(tidy, schema)


def _bytes(setting: str) -> int:
    """A number of bytes such as 64m or 67108864b."""
    text = setting.strip().lower().removesuffix("b")
    scale = {"k": 10, "m": 20, "g": 30}.get(text[-1:], 0)
    return int(text.rstrip("kmg")) << scale


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, data, offsets): text i of ``rows`` is data[offsets[i]:offsets[i + 1]]; a null text is empty."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        wide = pa.types.is_large_string(column.type)
        n, kind = len(column), np.int64 if wide else np.int32
        if not n:
            continue
        buffers = column.buffers()
        ends = np.frombuffer(buffers[1], kind)[column.offset : column.offset + n + 1].astype(np.int64)
        data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
        if column.null_count:  # a null may span bytes in Arrow; none are read
            gone = np.asarray(column.is_null())
            if (np.diff(ends)[gone] > 0).any():
                column = column.fill_null("")
                buffers = column.buffers()
                ends = np.frombuffer(buffers[1], kind)[column.offset : column.offset + n + 1].astype(np.int64)
                data = np.frombuffer(buffers[2], np.uint8)
        low = 0
        while low < n:
            high = max(low + 1, int(np.searchsorted(ends, ends[low] + most, "right")) - 1)
            high = min(high, n)
            yield batch.slice(low, high - low), data[ends[low] : ends[high]], ends[low : high + 1] - ends[low]
            low = high
