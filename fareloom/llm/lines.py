"""Line dedup: hash normalised lines, count documents for each hash, drop what is too common, reassemble."""

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm import arrow
from fareloom.session import materialize


def _texts(column: pa.Array):
    data, offsets = arrow.utf8(column)
    raw = data.tobytes()
    return (raw[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True))


def _digest(key: bytes) -> bytes:
    return xxhash.xxh3_128_digest(key)


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars < 2 or len(key.decode()) >= min_chars)


def _keys(text: bytes, min_chars: int) -> set[bytes]:
    """Distinct keys: lines without white space at either end, A-Z lowered (bytes do both for ASCII alone)."""
    return {k for k in (x.strip() for x in text.lower().split(b"\n")) if _long_enough(k, min_chars)}


def common_lines(docs: DataFrame, min_chars: int = 1, min_docs: int = 10) -> DataFrame:
    """(h1, h2): 128-bit hashes of the keys found in at least ``min_docs`` documents. Counts are added up within
    a batch before they are shuffled, so a line of a third of all documents is one row a batch. Rows of a doc_id that
    has several count once for each hash; rows without a doc_id are documents of their own."""

    def run(batches):
        for batch in batches:
            found = Counter()
            for text in _texts(batch.column("text")):
                found.update(_keys(text, min_chars))
            hashes = np.frombuffer(b"".join(map(_digest, found)), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[:, 0]), pa.array(hashes[:, 1]), pa.array(list(found.values()), pa.int64())], names=["h1", "h2", "n"]
            )

    def each(batches):
        for batch in batches:
            keys = [_keys(text, min_chars) for text in _texts(batch.column("text"))]
            hashes = np.frombuffer(b"".join(_digest(k) for ks in keys for k in ks), "<i8").reshape(-1, 2)
            at = pa.array(np.repeat(np.arange(len(keys)), [len(ks) for ks in keys]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(at), pa.array(hashes[:, 0]), pa.array(hashes[:, 1])], names=["doc_id", "h1", "h2"])

    several = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    several = materialize(several, "several")
    texts = docs.select("doc_id", "text")
    kind = "h1 bigint, h2 bigint, n bigint"
    if several.isEmpty():
        counted = texts.select("text").mapInArrow(arrow.trimmed(run), kind)
    else:
        counted = texts.join(several, "doc_id", "left_anti").select("text").mapInArrow(arrow.trimmed(run), kind)
        again = texts.join(several, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(arrow.trimmed(each), "doc_id bigint, h1 bigint, h2 bigint")
        counted = counted.unionByName(again.distinct().select("h1", "h2", F.lit(1).cast("bigint").alias("n")))
    return counted.groupBy("h1", "h2").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs).select("h1", "h2")


def dedup_lines(docs: DataFrame, min_chars: int = 1, min_docs: int = 10) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, kept_text.

    A text is split at \\n; keys of at least ``min_chars`` code points that occur in ``min_docs`` documents or more
    lose all their lines everywhere. A null or empty text is one empty line, whose key is too short to count, so
    it stays. Rows of one doc_id count as one document, those without a doc_id as one each. Only doc_id and text
    are read.

    The common hashes are written first, so that Catalyst knows their size and broadcasts them only if it is small.
    """
    common = materialize(common_lines(docs, min_chars, min_docs), "common-lines")
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_id"), F.coalesce("doc_id", F.lit(-1)).alias("id"))

    def hashes(batches):
        for batch in batches:
            keys = [list(_keys(text, min_chars)) for text in _texts(batch.column("text"))]
            found = np.frombuffer(b"".join(_digest(k) for ks in keys for k in ks), "<i8").reshape(-1, 2)
            at = pa.array(np.repeat(np.arange(len(keys)), [len(ks) for ks in keys]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id").take(at), batch.column("id").take(at), pa.array(found[:, 0]), pa.array(found[:, 1])],
                names=["row_id", "id", "h1", "h2"],
            )

    held = keyed.select("row_id", "id", "text").mapInArrow(arrow.trimmed(hashes), "row_id bigint, id bigint, h1 bigint, h2 bigint")
    dropped = held.join(common, ["h1", "h2"], "left_semi").groupBy("row_id", "id").agg(F.collect_set("h1").alias("dropped"))

    def rebuild(batches):
        for batch in batches:
            lines, gone, kept = [], [], []
            for text, drop in zip(_texts(batch.column("text")), batch.column("dropped").to_pylist(), strict=True):
                parts = text.split(b"\n")
                n = len(parts)
                if drop:
                    out = {h.to_bytes(8, "little", signed=True) for h in drop}
                    low = (x.strip() for x in text.lower().split(b"\n"))
                    parts = [x for x, k in zip(parts, low, strict=True) if not _long_enough(k, min_chars) or _digest(k)[:8] not in out]
                lines.append(n)
                gone.append(n - len(parts))
                kept.append(b"\n".join(parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lines, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "kept_text"],
            )

    return (
        keyed.join(dropped, ["row_id", "id"], "left").select("doc_id", "text", "dropped")
        .mapInArrow(arrow.trimmed(rebuild), "doc_id bigint, n_lines bigint, n_dropped bigint, kept_text string")
    )
