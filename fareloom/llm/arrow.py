"""Helpers for Arrow batches in Python workers: raw UTF-8 buffers, bounded chunks, words and their hashes."""

import ctypes

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once in a Python worker; a longer single text is worked on alone.
CHUNK_BYTES = 1 << 18

#: Rows of whole texts in an Arrow batch, and about how many bytes; Spark's 10,000 are tens of MB for each of several copies in an executor.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20
#: Bytes of input files for a shuffle partition.
SHUFFLE_BYTES = 64 << 20

_ODD = 0x9E3779B97F4A7C15


def prepare(docs) -> None:
    """Settings of the session for an operator over ``docs``: small Arrow batches, as rows are whole texts, and shuffle
    partitions that grow with the input (they are raised, never lowered; adaptive execution merges small ones)."""
    from fareloom.session import input_size  # not at the top: this module travels to workers, which may lack the package

    conf, spark = docs.sparkSession.conf, docs.sparkSession
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
    wanted = input_size(docs) // SHUFFLE_BYTES
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        conf.set("spark.sql.shuffle.partitions", str(wanted))


def trimmed(run):
    """``run`` for the batches of a task, after which memory that is free goes back to the system: the workers of an
    executor live for many tasks and share its memory. Where the C library cannot do that, nothing changes."""

    def task(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return task


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES):
    """Slices of a batch whose texts have at most ``limit`` bytes together (one text at least)."""
    offsets = utf8(batch.column(column))[1]
    start, n = 0, batch.num_rows
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), n)
        yield batch.slice(start, end - start)
        start = end


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column as one array, and the n + 1 places where texts begin in it; null is empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    n, kind = len(column), np.int64 if wide else np.int32
    if n == 0 or at is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(at, kind, n + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Roller:
    """Hashes of any byte spans of a buffer from one running sum; its tables grow to the longest buffer seen."""

    BASE = 0x5851F42D4C957F2D
    INVERSE = pow(BASE, -1, 1 << 64)

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        n = len(data) + 1
        if len(self.up) < n:
            self.up, self.down = (
                np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n - 1, base, np.uint64))))
                for base in (self.BASE, self.INVERSE)
            )
        out = np.zeros(n, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: n - 1], out=out[1:])
        return out

    def spans(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.down[start])


def word_table() -> np.ndarray:
    """True for the bytes that part words: space and 0x09 to 0x0D."""
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def lower_table() -> np.ndarray:
    """Lower case for A-Z, all other bytes as they are."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


def word_spans(data: np.ndarray, offsets: np.ndarray, parting: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each text the number of words before it (n + 1 entries)."""
    if not len(data):
        empty = np.empty(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    inside = ~parting[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, offsets)


def shingle_hashes(words: np.ndarray, begin: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words of each text, all of a shorter text as one, and where each text's begin.

    ``begin`` has for each text the number of words before it, and the total.
    """
    counts = np.diff(begin)
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    at = np.concatenate(([0], np.cumsum(n)))
    place = np.arange(at[-1]) - np.repeat(at[:-1], n) + np.repeat(begin[:-1], n)
    left = np.repeat(begin[1:], n) - place
    full = place[left >= size]
    out = np.zeros(at[-1], np.uint64)
    joined = np.full(len(full), size, np.uint64)
    for k in range(size):
        joined = mix(joined + words[full + k] * np.uint64(_ODD))
    out[left >= size] = joined
    for i in np.flatnonzero(left < size):
        h = np.full(1, left[i], np.uint64)
        for k in range(left[i]):
            h = mix(h + words[place[i] + k : place[i] + k + 1] * np.uint64(_ODD))
        out[i] = h[0]
    return out, at


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


def binaries(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([np.ascontiguousarray(p).tobytes() for p in parts], pa.binary())
