"""Token ids in files: canonical length-limited Huffman codes in blocks that are read on their own."""

import os
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from fareloom.llm import arrow, huffman
from fareloom.session import input_size, materialize, new_path

#: Ids in a block (a longer document is a block of its own), and ids between two checkpoints.
BLOCK_IDS, CHECKPOINT_IDS = 1 << 20, 256
#: Longest code. The vocabulary must have at most 2 ** MAX_BITS ids.
MAX_BITS = 18
#: Bytes of distinct segments' hashes and ids that a worker keeps at most, about 30 for each.
CACHE_BYTES = 24 << 20
#: Bytes of input files for a range of documents, which one task sorts and encodes.
RANGE_BYTES = 16 << 20
#: Rows of the written blocks are megabytes: row groups of Parquet's usual size would be held by every task that writes.
ROW_GROUP = {"parquet.block.size": str(8 << 20)}

BLOCKS = "part int, seq int, n bigint, doc_ids array<bigint>, lens array<bigint>, ids binary"
FILES = "start bigint, n bigint, doc_ids array<bigint>, lens array<bigint>, payload binary, checkpoints binary"


class Encoder:
    """Ids of whole texts, for a byte-level vocabulary with the usual pattern (letters, digits, marks, white space).

    A text is cut before each space or line break that has no white space beside it, where its pieces part anyway.
    Segments are found, hashed and looked up as arrays; each distinct one is encoded once as long as it is kept.
    Strings of special tokens in a text become their ids, as in the library, or with ``plain`` ordinary text.
    """

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.space = np.zeros(256, bool)
        self.space[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
        self.two, self.three = 0xC2, np.isin(np.arange(256), (0xE1, 0xE2, 0xE3))  # first bytes of white space beyond ASCII
        self.roller = arrow.Roller()
        self.clear()

    def clear(self):
        self.hashes, self.places = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.pool, self.starts = np.empty(0, self.kind), np.zeros(1, np.int64)

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where segments begin, and how many bytes of white space come before each byte."""
        white = self.space[data]
        odd = (data == self.two) | self.three[data]
        solid = ~(white | odd)
        before = solid.copy()  # may stand before a cut
        if len(data) > 2:
            high = data >= 0x80
            before[1:] &= ~(high[1:] & (data[:-1] == self.two))
            before[2:] &= ~(high[2:] & self.three[data[:-2]])
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        cut = (data == 0x20) | (data == 0x0A)
        cut[1:] &= before[:-1]
        cut[:-1] &= solid[1:] & ~edge[1:-1]
        cut[-1:] = False
        cut |= edge[:-1]
        return np.flatnonzero(cut), np.concatenate(([0], np.cumsum(white | odd)))

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each with ``end_id`` after it, and how many each has."""
        if len(data):
            start, white = self.cuts(data, offsets)
            end = np.append(start[1:], len(data))
            h = self.roller.spans(self.roller.sums(data), start, end)
        else:
            start = end = np.empty(0, np.int64)
            white, h = np.zeros(1, np.int64), np.empty(0, np.uint64)
        distinct, first, back = np.unique(h, return_index=True, return_inverse=True)
        if self.hashes.nbytes + self.places.nbytes + self.starts.nbytes + self.pool.nbytes > CACHE_BYTES:
            self.clear()
        at = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == distinct[inside]
        self.learn(data, distinct[~known], start[first[~known]], end[first[~known]], white)
        pool, starts = self.pool, self.starts
        place = self.places[np.searchsorted(self.hashes, distinct)][back]
        n = starts[place + 1] - starts[place]
        total = np.concatenate(([0], np.cumsum(n)))
        ids = pool[np.repeat(starts[place] - total[:-1], n) + np.arange(total[-1])]
        counts = np.diff(total[np.searchsorted(start, offsets)])
        if end_id is None:
            return ids, counts
        return np.insert(ids, np.cumsum(counts), end_id), counts + 1

    def learn(self, data, hashes, start, end, white):
        """Encode new segments: those with no white space inside many at a time, the others one by one."""
        if not len(hashes):
            return
        plain = white[end] == white[np.minimum(start + 1, end)]
        head = data[start]
        order, flat, sizes = [], [self.pool], []
        spaced, broken, bare = plain & (head == 0x20), plain & (head == 0x0A), white[end] == white[start]
        for group, skip in ((spaced, 0), (broken, 1), (bare, 0), (~(spaced | broken | bare), None)):
            members = np.flatnonzero(group)
            for i in range(0, len(members), 5000):
                part = members[i : i + 5000]
                ids, n = self.apart(data, start[part], end[part]) if skip is None else self.together(data, start[part] + skip, end[part])
                if skip:
                    ids, n = np.insert(ids, np.cumsum(n) - n, self.line[0]), n + 1
                order.append(part)
                flat.append(ids)
                sizes.append(n)
        self.keep(hashes, order, flat, sizes)

    def keep(self, hashes, order, flat, sizes):
        """Add segments to the pool: which ones, their ids after those of the pool, and how many each has."""
        place = np.empty(len(hashes), np.int64)
        place[np.concatenate(order)] = np.arange(len(hashes)) + len(self.starts) - 1
        self.pool = np.concatenate(flat)
        self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum(np.concatenate(sizes))))
        merged = np.concatenate((self.hashes, hashes))
        by = np.argsort(merged, kind="stable")
        self.hashes, self.places = merged[by], np.concatenate((self.places, place))[by]

    def together(self, data, start, end) -> tuple[np.ndarray, np.ndarray]:
        """Ids of segments without a line break, from one call: the line breaks put between them are ids of their own."""
        n = end - start + 1
        at = np.cumsum(n)
        text = np.full(at[-1], 0x0A, np.uint8)
        inside = np.ones(at[-1], bool)
        inside[at - 1] = False
        text[inside] = data[np.repeat(start - (np.cumsum(n - 1) - (n - 1)), n - 1) + np.arange((n - 1).sum())]
        ids = np.array(self.tokenizer.encode_batch_fast([text[:-1].tobytes().decode()], add_special_tokens=False)[0].ids, self.kind)
        breaks = np.flatnonzero(ids == self.line[0])
        if len(self.line) != 1 or len(breaks) != len(n) - 1:
            return self.apart(data, start, end)
        return np.delete(ids, breaks), np.diff(np.concatenate(([-1], breaks, [len(ids)]))) - 1

    def apart(self, data, start, end) -> tuple[np.ndarray, np.ndarray]:
        texts = [data[a:b].tobytes().decode() for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for x in found for i in x], self.kind), np.array([len(x) for x in found], np.int64)


def encoder(path: str) -> Encoder:
    """One for the life of a worker, which runs many tasks."""
    kept = sys.modules.setdefault("_token_encoders", types.ModuleType("_token_encoders")).__dict__
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def _blocks(ordered: DataFrame, path: str, end_id: int) -> DataFrame:
    """Documents, in order within each partition, to rows of ``BLOCKS``."""

    def run(batches):
        tokens, part = encoder(path), TaskContext.get().partitionId()
        ids, lens, blobs, held, seq = [], [], [], 0, 0

        def block():
            return pa.RecordBatch.from_pydict(
                {"part": [part], "seq": [seq], "n": [held], "doc_ids": [ids], "lens": [lens], "ids": [b"".join(blobs)]},
                schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lens", pa.list_(pa.int64())), ("ids", pa.binary())]),
            )

        for batch in batches:
            for piece in arrow.chunks(batch, "text", 2 * arrow.CHUNK_BYTES):
                found, counts = tokens.encode(*arrow.utf8(piece.column("text")), end_id)
                ends = np.cumsum(counts)
                for doc_id, n, end in zip(piece.column("doc_id").to_pylist(), counts.tolist(), ends.tolist(), strict=True):
                    if held and held + n > BLOCK_IDS:
                        yield block()
                        ids, lens, blobs, held, seq = [], [], [], 0, seq + 1
                    ids.append(doc_id)
                    lens.append(n)
                    blobs.append(found[end - n : end].tobytes())
                    held += n
        if held:
            yield block()

    return ordered.mapInArrow(arrow.trimmed(run), BLOCKS)


def _counts(blocks: DataFrame, kind: str) -> DataFrame:
    """How often each id occurs over all blocks: (id, n)."""

    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for blob in batch.column("ids"):
                found = np.bincount(np.frombuffer(blob.as_buffer(), kind), minlength=len(total))
                found[: len(total)] += total
                total = found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], names=["id", "n"])

    return blocks.select("ids").mapInArrow(arrow.trimmed(run), "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def _lengths(codes: DataFrame) -> np.ndarray:
    """Code lengths by id. At most one row an id of the vocabulary comes to the driver."""
    found = codes.select("id", "bits").toArrow()
    ids = found.column("id").to_numpy()
    lengths = np.zeros(int(ids.max(initial=-1)) + 1, np.int64)
    lengths[ids] = found.column("bits").to_numpy()
    return lengths


def _starts(blocks: DataFrame) -> DataFrame:
    """(part, seq, start): ids before each block, by a running sum over partitions and one within each partition."""
    sizes = blocks.select("part", "seq", "n")
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("before", F.coalesce(F.sum("n").over(within), F.lit(0))).join(parts, "part").select(
        "part", "seq", (F.col("part_start") + F.col("before")).alias("start")
    )


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, order=("doc_id",), max_bits: int = MAX_BITS) -> None:
    """Encode every whole text and write ``path``/codes (id, n, bits) and ``path``/blocks, Parquet rows of ``FILES``.

    ``docs`` has doc_id and text; ``order`` names the columns whose ascending order (null first) the ids follow,
    ties by doc_id and text. Each document ends with ``end_id``; null and empty texts have that id alone. Code
    lengths come from the counts of all ids. A block is a row: it can be read without any other, and from any
    checkpoint. Encoded ids are kept once in the shared folder between counting and coding.
    """
    arrow.prepare(docs)
    keep = list(dict.fromkeys([*order, "doc_id", "text"]))
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), input_size(docs) // RANGE_BYTES)
    ordered = docs.select(*keep).repartitionByRange(parts, *order).sortWithinPartitions(*keep).select("doc_id", "text")
    blocks = materialize(_blocks(ordered, tokenizer, end_id), "ids", options=ROW_GROUP)
    kind = "<u2" if blocks.where("octet_length(ids) <> 2 * n").isEmpty() else "<u4"
    counted = _counts(blocks, kind).toArrow()
    ids = counted.column("id").to_numpy()
    counts = np.zeros(int(ids.max(initial=-1)) + 1, np.int64)
    counts[ids] = counted.column("n").to_numpy()
    lengths = huffman.code_lengths(counts, max_bits)
    spark = docs.sparkSession
    table = pa.table({"id": pa.array(ids, pa.int32()), "n": pa.array(counts[ids], pa.int64()), "bits": pa.array(lengths[ids], pa.int32())})
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{path}/codes")

    def run(batches):
        codes = huffman.canonical(lengths)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                found = np.frombuffer(row.column("ids")[0].as_buffer(), kind).astype(np.int64)
                payload, checkpoints = huffman.pack(found, codes, lengths, CHECKPOINT_IDS)
                yield pa.RecordBatch.from_arrays(
                    [row.column("start"), row.column("n"), row.column("doc_ids"), row.column("lens"), pa.array([payload], pa.binary()), pa.array([checkpoints.astype("<i8").tobytes()], pa.binary())],
                    names=["start", "n", "doc_ids", "lens", "payload", "checkpoints"],
                )

    placed = blocks.join(_starts(blocks), ["part", "seq"])
    placed.select("start", "n", "doc_ids", "lens", "ids").mapInArrow(arrow.trimmed(run), FILES).write.options(**ROW_GROUP).parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids): each document's place among all ids, and its ids as unsigned 32-bit little-endian integers."""
    lengths = _lengths(spark.read.parquet(f"{path}/codes"))

    def run(batches):
        decoder = huffman.Decoder(lengths)
        for batch in batches:
            for i in range(batch.num_rows):
                n, first = batch.column("n")[i].as_py(), batch.column("start")[i].as_py()
                lens = batch.column("lens")[i].values.to_numpy()
                checkpoints = np.frombuffer(batch.column("checkpoints")[i].as_buffer(), "<i8")
                ids = decoder.unpack(batch.column("payload")[i].as_py(), n, checkpoints, CHECKPOINT_IDS)
                ends = np.cumsum(lens)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[i].values, pa.array(first + ends - lens, pa.int64()), arrow.binaries(np.split(ids.astype("<u4"), ends[:-1]))],
                    names=["doc_id", "start", "ids"],
                )

    return spark.read.schema(FILES).parquet(f"{path}/blocks").mapInArrow(arrow.trimmed(run), "doc_id bigint, start bigint, ids binary")


def token_table(docs: DataFrame, tokenizer: str, end_id: int = 0, order=("doc_id",)) -> DataFrame:
    """Write token files to a new folder of the shared one, read them back, and return per document
    doc_id, start, n_tokens and ids_crc32 (unsigned, over little-endian unsigned 32-bit ids)."""
    path = new_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer, end_id, order)
    return read_token_files(docs.sparkSession, path).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def in_file_order(docs: DataFrame) -> tuple[DataFrame, tuple[str, ...]]:
    """(doc_id, text and where a row stands in its files), and the names of the latter: the order they were written in.

    Rows that were not read from files have no such place; they are ordered by doc_id.
    """
    try:
        placed = docs.select(
            "doc_id", "text", F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).try_cast("bigint").alias("part"),
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
        )
    except AnalysisException:
        return docs.select("doc_id", "text"), ("doc_id",)
    return placed, ("part", "file", "row")
