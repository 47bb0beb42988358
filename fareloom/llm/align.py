"""Cross-tokenizer alignment: groups of tokens between common ends, and links between overlapping tokens."""

import os
import sys
import types
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm import arrow
from fareloom.llm.token_files import Encoder
from fareloom.session import materialize

#: Bytes of text that are aligned at once, and that one pair of dictionaries covers.
TEXT_BYTES, WINDOW_BYTES = 1 << 20, 1 << 16
#: Linked pairs (one a document and distinct pair) of a row of the written table.
ROW_PAIRS = 1 << 20
#: Fixed by the vocabulary format: the mark of a space in a piece.
SPACE_MARK = "▁"

ROWS = (
    "part int, seq int, doc_ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>,"
    " digests array<string>, a array<int>, b array<int>, docs array<bigint>, ends array<bigint>, pairs binary, times binary"
)
ROW_TYPES = [
    pa.int32(), pa.int32(), *[pa.list_(pa.int64())] * 5, pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()),
    pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(),
]
ROW_NAMES = [part.split()[0] for part in ROWS.split(", ")]


class Bytes:
    """The bytes of each token of a vocabulary, as one array and where each begins."""

    def __init__(self, tokens: list[bytes]):
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def joined(self, ids: np.ndarray) -> np.ndarray:
        n = self.sizes[ids]
        return self.data[np.repeat(self.starts[ids] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


class ByteLevel(Encoder):
    """Byte-level pairs; strings of special tokens are plain text."""

    def __init__(self, path: str):
        super().__init__(path, plain=True)
        # the usual alphabet of byte-level vocabularies: printable bytes stand for themselves, the others follow from U+0100
        shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
        hidden = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
        size = self.tokenizer.get_vocab_size()
        entries = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.bytes = Bytes([bytes(byte[c] for c in e) if all(c in byte for c in e) else e.encode() for e in entries])


class Pieces(Encoder):
    """Pieces with a mark for spaces, of texts that begin with the space the vocabulary's library puts before them.

    No piece of such a vocabulary has the mark after another character, so texts are cut before each run of spaces,
    and each distinct segment is encoded once. With a vocabulary that has such pieces, texts stay whole.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.whole = any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces)
        self.bytes = Bytes([
            bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)
        ])
        self.lone = self.library.encode("x ")[len(self.library.encode("x")) :]  # a space at the end of a text
        self.kind = np.dtype("<u2" if len(pieces) <= 1 << 16 else "<u4")
        self.roller = arrow.Roller()
        self.clear()

    def cuts(self, data, offsets):
        cut = np.zeros(len(data) + 1, bool)
        if not self.whole:
            cut[1:-1] = (data[1:] == 0x20) & (data[:-1] != 0x20)
        cut[offsets] = True
        return np.flatnonzero(cut[:-1]), None

    def learn(self, data, hashes, start, end, white):
        if len(hashes):
            texts = [data[a + 1 : b].tobytes().decode() for a, b in zip(start.tolist(), end.tolist(), strict=True)]
            found = [ids if t else self.lone for t, ids in zip(texts, self.library.encode(texts, num_threads=1), strict=True)]
            flat = np.array([i for x in found for i in x], self.kind)
            self.keep(hashes, [np.arange(len(hashes))], [self.pool, flat], [np.array([len(x) for x in found], np.int64)])


def vocabulary(kind: type, path: str) -> Encoder:
    """One for the life of a worker, which runs many tasks."""
    kept = sys.modules.setdefault("_token_vocabularies", types.ModuleType("_token_vocabularies")).__dict__
    key = f"{kind.__name__}:{path}"
    if key not in kept:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        kept[key] = kind(path)
    return kept[key]


class Aligned(NamedTuple):
    """Tokens of several texts in a row, their groups and links; ``*_at`` holds where each text begins (n + 1 places)."""

    a: np.ndarray  # ids
    b: np.ndarray
    a_at: np.ndarray
    b_at: np.ndarray
    a_sizes: np.ndarray  # tokens of each group
    b_sizes: np.ndarray
    groups_at: np.ndarray
    link_a: np.ndarray  # place of the token
    link_b: np.ndarray
    links_at: np.ndarray


def before(counts: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(1, np.int64), np.cumsum(counts, dtype=np.int64)))


def spaced(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts, each with a space before it unless it is empty, and where each begins."""
    data, offsets = arrow.utf8(texts)
    full = offsets[1:] > offsets[:-1]
    return np.insert(data, offsets[:-1][full], 0x20), before(np.diff(offsets) + full)


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens at whose ends both tokenizers cut, in order.

    The ends of a range of bytes are the keys of two dictionaries; what the key sets share, sorted, are the cuts.
    """
    at_a, at_b = [], []
    total = int(ends_a[-1]) if len(ends_a) else 0
    for start in range(0, total, WINDOW_BYTES):
        (i, j), (k, m) = (np.searchsorted(ends, (start, start + WINDOW_BYTES), "right").tolist() for ends in (ends_a, ends_b))
        index_a = dict(zip(ends_a[i:j].tolist(), range(i, j), strict=True))
        index_b = dict(zip(ends_b[k:m].tolist(), range(k, m), strict=True))
        shared = sorted(index_a.keys() & index_b.keys())
        at_a.extend(map(index_a.__getitem__, shared))
        at_b.extend(map(index_b.__getitem__, shared))
    return np.array(at_a, np.int64), np.array(at_b, np.int64)


def links(ends_a, ends_b, at_a, at_b) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of a and b in each group, and the places of all pairs of tokens that overlap, group by group.

    Where one side of a group is a single token it meets all tokens of the other; else each token of a meets those from
    the first that ends after its start to the first that ends no sooner than it does.
    """
    a_sizes, b_sizes = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
    lo, hi = np.repeat(at_b - b_sizes + 1, a_sizes), np.repeat(at_b, a_sizes)
    many = np.repeat((a_sizes > 1) & (b_sizes > 1), a_sizes)
    start = np.concatenate((np.zeros(1, np.int64), ends_a[:-1]))[: len(ends_a)]
    lo[many] = np.searchsorted(ends_b, start[many], "right")
    hi[many] = np.searchsorted(ends_b, ends_a[many], "left")
    n = hi - lo + 1
    return a_sizes, b_sizes, np.repeat(np.arange(len(n)), n), np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)


def align(texts: pa.Array, a: Encoder, b: Encoder) -> Aligned:
    """Both tokenizers' ids of each text with a space before it, their groups and links.

    Texts that are null or empty, and those which the joined bytes of either tokenizer do not give back, have no tokens.
    """
    while True:
        data, at = spaced(texts)
        (ids_a, n_a), (ids_b, n_b) = a.encode(data, at), b.encode(data, at)
        size = np.diff(at)
        a_at, b_at = before(n_a), before(n_b)
        ends_a, ends_b = np.cumsum(a.bytes.sizes[ids_a]), np.cumsum(b.bytes.sizes[ids_b])
        odd = np.diff(before(a.bytes.sizes[ids_a])[a_at]) != size
        odd |= np.diff(before(b.bytes.sizes[ids_b])[b_at]) != size
        if not odd.any():
            wrong = (a.bytes.joined(ids_a) != data) | (b.bytes.joined(ids_b) != data)
            odd[np.searchsorted(at, np.flatnonzero(wrong), "right") - 1] = True
        if not odd.any():
            break
        texts = pa.array([None if bad else t for bad, t in zip(odd.tolist(), texts.to_pylist(), strict=True)], texts.type)
    at_a, at_b = common_ends(ends_a, ends_b)
    a_sizes, b_sizes, link_a, link_b = links(ends_a, ends_b, at_a, at_b)
    groups_at = np.searchsorted(at_a, a_at, "left")
    links_at = np.searchsorted(link_a, a_at, "left")
    return Aligned(ids_a, ids_b, a_at, b_at, a_sizes, b_sizes, groups_at, link_a, link_b, links_at)


_WIDTH = 11  # digits of a 32-bit id and what follows it


def decimals(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the decimal digits of each id, and how many there are."""
    ids = ids.astype(np.int64)
    powers = 10 ** np.arange(1, _WIDTH, dtype=np.int64)
    size = 1 + (ids[:, None] >= powers).sum(axis=1)
    place = size[:, None] - 1 - np.arange(_WIDTH)
    return (ids[:, None] // 10 ** np.maximum(place, 0) % 10 + 48).astype(np.uint8), size


def written(found: Aligned, digits: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The groups of each text as ``a1,a2|b1;a3|b2,b3`` in one array, and where each begins; each but an empty one has one more byte."""
    table, size = digits
    n = len(found.a) + len(found.b)
    ids, after = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
    a_end, b_end = np.cumsum(found.a_sizes), np.cumsum(found.b_sizes)
    at_a = np.arange(len(found.a)) + np.repeat(b_end - found.b_sizes, found.a_sizes)
    at_b = np.arange(len(found.b)) + np.repeat(a_end, found.b_sizes)
    ids[at_a], ids[at_b] = found.a, found.b
    after[at_a[a_end - 1]], after[at_b[b_end - 1]] = ord("|"), ord(";")
    rows, n = table[ids], size[ids]
    rows[np.arange(len(ids)), n] = after
    width = rows.shape[1]
    text = rows[np.arange(width) <= n[:, None]]
    return text, before(n + 1)[found.a_at + found.b_at]


def aligned_groups(docs: DataFrame, byte_bpe: str, pieces: str) -> DataFrame:
    """(doc_id, text) to doc_id, a_ids, b_ids, and a_sizes, b_sizes: how many tokens of each side each group has.

    A group ends wherever tokens of both sides end. Null and empty texts, and texts that one of the tokenizers does
    not give back byte for byte, have empty lists. Rows are independent: repeats give repeats, an empty table nothing;
    a null doc_id stays null; other columns are ignored. A very long text is aligned by itself, in ranges of its bytes.
    """

    def run(batches):
        a, b = vocabulary(ByteLevel, byte_bpe), vocabulary(Pieces, pieces)
        for batch in batches:
            for part in arrow.chunks(batch, "text", TEXT_BYTES):
                found = align(part.column("text"), a, b)
                lists = [(found.a_at, found.a), (found.b_at, found.b), (found.groups_at, found.a_sizes), (found.groups_at, found.b_sizes)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x.astype(np.int32))) for at, x in lists]],
                    names=["doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes"],
                )

    arrow.prepare(docs)
    kind = "doc_id bigint, a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>"
    return docs.select("doc_id", "text").mapInArrow(arrow.trimmed(run), kind)


class _Held:
    """What goes into one row of the written table: documents, distinct pairs, and each document's part of them."""

    def __init__(self, part: int, seq: int):
        self.part, self.seq, self.n = part, seq, 0
        self.columns, self.keys, self.refs, self.times, self.ends = [[] for _ in range(6)], [], [], [], []

    def add(self, doc_ids, found: Aligned, digests):
        keys, back = np.unique(found.a[found.link_a].astype(np.int64) << 32 | found.b[found.link_b].astype(np.int64), return_inverse=True)
        owner = np.repeat(np.arange(len(digests)), np.diff(found.links_at))
        each, times = np.unique(owner * max(len(keys), 1) + back, return_counts=True)
        numbers = (np.diff(at) for at in (found.a_at, found.b_at, found.groups_at, found.links_at))
        for column, values in zip(self.columns, (doc_ids, *(x.tolist() for x in numbers), digests), strict=True):
            column.extend(values)
        self.ends.append(self.n + np.searchsorted(each, (np.arange(len(digests)) + 1) * max(len(keys), 1)))
        self.keys.append(keys)
        self.refs.append(each % max(len(keys), 1))
        self.times.append(times)
        self.n += len(each)

    def row(self, codec) -> pa.RecordBatch:
        keys = np.unique(np.concatenate(self.keys))
        refs = np.concatenate([np.searchsorted(keys, k)[r] if len(r) else r for k, r in zip(self.keys, self.refs, strict=True)])
        docs = np.bincount(refs, minlength=len(keys))
        packed = [codec.compress(x.astype("<u4").tobytes(), asbytes=True) for x in (np.diff(refs, prepend=0), np.concatenate(self.times))]
        values = [self.part, self.seq, *self.columns, keys >> 32, keys & 0xFFFFFFFF, docs, np.concatenate(self.ends), *packed]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, ROW_TYPES, strict=True)], names=ROW_NAMES)


def link_counts(docs: DataFrame, byte_bpe: str, pieces: str) -> DataFrame:
    """(doc_id, text) to doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, a row each.

    A pair of ids counts for each document that links it; n_best are the links whose count is the highest of
    their a id, count_sum adds up the counts of all links. Null and empty texts, and texts that one of the
    tokenizers does not give back byte for byte, have zeros and ''. Rows are documents: repeated rows count each; a null doc_id
    stays null; an empty table gives no row; other columns are ignored; a very long text is a piece of work of its own.

    Texts are encoded once. A row of the written table holds about a million linked pairs of some documents, by
    number, and its distinct pairs, of which only these are shuffled: to the counts, and back to the row.
    """

    def run(batches):
        a, b = vocabulary(ByteLevel, byte_bpe), vocabulary(Pieces, pieces)
        digits = decimals(np.arange(max(len(a.bytes.sizes), len(b.bytes.sizes))))
        codec, held = pa.Codec("zstd", compression_level=1), _Held(TaskContext.get().partitionId(), 0)
        for batch in batches:
            for part in arrow.chunks(batch, "text", TEXT_BYTES):
                found = align(part.column("text"), a, b)
                text, at = written(found, digits)
                view = memoryview(text)
                digests = [sha256(view[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                held.add(part.column("doc_id").to_pylist(), found, digests)
                if held.n >= ROW_PAIRS:
                    yield held.row(codec)
                    held = _Held(held.part, held.seq + 1)
        if held.keys:
            yield held.row(codec)

    def total(batches):
        codec = pa.Codec("zstd")
        for batch in batches:
            for i in range(batch.num_rows):
                ends = batch.column("ends")[i].values.to_numpy()
                n = int(ends[-1])
                refs, times = (
                    np.frombuffer(codec.decompress(batch.column(name)[i].as_buffer(), 4 * n), "<u4") for name in ("pairs", "times")
                )
                refs = np.cumsum(refs, dtype=np.uint32)
                counted = batch.column("counted")[i].values
                count, best = np.zeros((2, len(counted) if counted is not None else 0), np.int64)
                if n:
                    place = counted.field("pos").to_numpy()
                    count[place], best[place] = counted.field("n").to_numpy(), counted.field("best").to_numpy(zero_copy_only=False)
                sums = [before(times * x[refs])[np.concatenate(([0], ends))] for x in (best, count)]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(name)[i].values for name in ROW_NAMES[2:7]], *[pa.array(np.diff(x)) for x in sums], batch.column("digests")[i].values],
                    names=["doc_id", *ROW_NAMES[3:7], "n_best", "count_sum", "groups_sha256"],
                )

    arrow.prepare(docs)
    rows = materialize(docs.select("doc_id", "text").mapInArrow(arrow.trimmed(run), ROWS), "alignments")
    pairs = rows.select("part", "seq", F.posexplode(F.arrays_zip("a", "b", "docs")).alias("pos", "p"))
    pairs = pairs.select("part", "seq", "pos", "p.a", "p.b", "p.docs")
    counts = materialize(pairs.groupBy("a", "b").agg(F.sum("docs").alias("n")), "pair-counts")
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    counts = counts.join(highest, "a").select("a", "b", "n", (F.col("n") == F.col("highest")).alias("best"))
    counted = pairs.join(counts, ["a", "b"]).groupBy("part", "seq").agg(F.collect_list(F.struct("pos", "n", "best")).alias("counted"))
    kind = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    return rows.drop("a", "b", "docs").join(counted, ["part", "seq"], "left").mapInArrow(arrow.trimmed(total), kind)
