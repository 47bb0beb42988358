"""Repeated passages: suffixes are sorted one bucket at a time, long ties by the ranks of a difference cover."""

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm import arrow
from fareloom.session import materialize

#: Bytes of text that one group of documents has on average, bytes of the seeds that choose buckets, and suffixes sorted at once.
GROUP_BYTES, SEED, BLOCK = 4 << 20, 20, 1 << 18
#: A difference cover: every difference modulo 13 is one of two of its members.
PERIOD, COVER = 13, (0, 1, 3, 9)
#: Window starts of a segment at most, as its answer is a mask of 32 bits.
RUN = 32

INFO = "chunk bigint, kind int, id bigint, row_id bigint, x binary, y binary"
NOTES = "bucket bigint, chunk bigint, h binary, ordinal binary, doc binary, length binary, data binary"


# ---------------------------------------------------------------- sorting


def _words(text: np.ndarray, at: np.ndarray, end: np.ndarray, n: int) -> list[np.ndarray]:
    """The n bytes from each place, and how many of them lie before ``end``, as big-endian words that sort like them."""
    have = np.minimum(end - at, n)
    columns = np.zeros((-(-(n + 1) // 8) * 8, len(at)), np.uint8)
    for k in range(n):
        inside = k < have
        columns[k, inside] = text[at[inside] + k]
    columns[n] = have
    whole = np.ascontiguousarray(columns.T).view(">u8").astype(np.uint64)
    return [whole[:, k] for k in range(whole.shape[1])]


def _ranked(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys (the first counts most), and each one's rank from 1; equals share one."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    if len(order):
        new[0] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return order, rank


def cover_ranks(text: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Ranks (from 1) of the suffixes at places of the cover, 0 at all others; ``end`` is where each place's segment ends.

    Names of the next PERIOD bytes, then of pairs of names: a place one period on is in the cover as well.
    """
    rank = np.zeros(len(text) + PERIOD, np.int64)
    sample = np.flatnonzero(np.isin(np.arange(len(text)) % PERIOD, COVER))
    if not len(sample):
        return rank
    limit, longest = end[sample], int((end[sample] - sample).max())
    rank[sample] = _ranked(_words(text, sample, limit, PERIOD))[1]
    reach = PERIOD
    while reach < longest:
        on = np.where(sample + reach < limit, rank[np.minimum(sample + reach, len(rank) - 1)], 0)
        rank[sample] = _ranked([rank[sample], on])[1]
        reach *= 2
    return rank


def _shifts() -> np.ndarray:
    """For two places modulo PERIOD, how far on both are in the cover."""
    return np.array([[next(d for d in range(PERIOD) if (a + d) % PERIOD in COVER and (b + d) % PERIOD in COVER) for b in range(PERIOD)] for a in range(PERIOD)])


def sort_block(text: np.ndarray, end: np.ndarray, starts: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """``starts`` in the order of their suffixes, each up to the end of its segment (PERIOD bytes or more are left).

    The first PERIOD bytes are compared as such. Longer ties need one look-up a pair: PERIOD or fewer bytes on,
    both suffixes are in the cover and ranked. All ties are split side by side around one member each.
    """
    shift = _shifts()
    order, group = _ranked(_words(text, starts, end[starts], PERIOD))
    starts, group = starts[order], group[order]
    left = np.arange(len(starts))
    while True:
        g = group[left]
        edge = np.concatenate(([True], g[1:] != g[:-1]))[: len(g)]
        first = np.flatnonzero(edge)
        sizes = np.diff(np.append(first, len(g)))
        tied = np.repeat(sizes > 1, sizes)
        left, sizes = left[tied], sizes[sizes > 1]
        if not len(left):
            return starts
        first = np.cumsum(sizes) - sizes
        at = starts[left]
        pivot = np.repeat(at[first + sizes // 2], sizes)
        d = shift[at % PERIOD, pivot % PERIOD]
        side = np.sign(rank[at + d] - rank[pivot + d])
        # within each tie: smaller, equal, larger; equals are done
        by = np.lexsort((side, np.repeat(first, sizes)))
        starts[left], side = at[by], side[by]
        group[left] = np.repeat(first, sizes) * 3 + side + 1
        left = left[side != 0]


def earlier(h: np.ndarray, docs: np.ndarray, lengths: np.ndarray, data: np.ndarray, size: int) -> np.ndarray:
    """For each segment a mask of its windows of ``size`` bytes that occur in a segment of a smaller document.

    Segments of one ``h`` hold all windows of that bucket. Buckets are sorted one block at a time.
    """
    masks = np.zeros(len(h), np.uint32)
    order = np.argsort(h, kind="stable")
    begin = np.cumsum(lengths) - lengths
    counts = (lengths - size + 1)[order]
    sums = np.cumsum(counts)
    a = 0
    while a < len(order):
        b = max(a + 1, int(np.searchsorted(sums, (sums[a - 1] if a else 0) + BLOCK, "right")))
        while b < len(order) and h[order[b]] == h[order[b - 1]]:
            b += 1
        took = order[a:b]
        n = lengths[took]
        place = np.repeat(begin[took] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        text, start = data[place], np.cumsum(n) - n
        end = np.repeat(start + n, n)
        c = counts[a:b]
        within = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        starts = np.repeat(start, c) + within
        owner = np.zeros(len(text), np.int64)
        owner[starts] = np.repeat(np.arange(len(took)), c)
        ordered = sort_block(text, end, starts, cover_ranks(text, end))
        same = np.zeros(len(ordered), bool)
        if len(ordered) > 1:
            equal = np.ones(len(ordered) - 1, bool)
            for k in range(size):
                equal &= text[ordered[1:] + k] == text[ordered[:-1] + k]
            same[1:] = equal
        group = np.flatnonzero(~same)
        doc = docs[took[owner[ordered]]]
        least = np.repeat(np.minimum.reduceat(doc, group), np.diff(np.append(group, len(doc))))
        hit = ordered[least < doc]
        bits = np.left_shift(np.uint32(1), (hit - start[owner[hit]]).astype(np.uint32))
        np.bitwise_or.at(masks, took[owner[hit]], bits)
        a = b
    return masks


# ---------------------------------------------------------------- buckets


def _runs(data: np.ndarray, offsets: np.ndarray, roller: arrow.Roller, size: int):
    """Runs of windows whose smallest seed hash is the same: that hash, text, start, windows, hash of the bytes.

    The seed hash is a function of a window's bytes, so equal windows have the same one wherever they are.
    """
    lengths = np.maximum(np.diff(offsets) - size + 1, 0)
    if not lengths.sum():
        return [np.empty(0, k) for k in (np.uint64, np.int64, np.int64, np.int64, np.uint64)]
    sums = roller.sums(data)
    seeds = np.arange(len(data) - SEED + 1)
    least = roller.spans(sums, seeds, seeds + SEED)
    width, reach = size - SEED + 1, 1
    whole = least
    while reach * 2 <= width:
        whole = np.minimum(whole[: len(whole) - reach], whole[reach:])
        reach *= 2
    if reach < width:
        more = width - reach
        whole = np.minimum(whole[: len(whole) - more], whole[more:])
    text = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(offsets[:-1], lengths)
    h = whole[at]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])))
    first = np.flatnonzero(new)
    inside = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))
    first = np.flatnonzero(inside % RUN == 0)
    count = np.diff(np.append(first, len(h)))
    start = at[first]
    return h[first], text[first], start, count, roller.spans(sums, start, start + count + size - 1)


class Chunk:
    """The documents of a group that are not copies of smaller ones, and their segments."""

    def __init__(self, docs: pa.Table, info: pa.Table, size: int):
        docs = docs.select(["doc_id", "row_id", "text"]).sort_by([("doc_id", "ascending"), ("row_id", "ascending"), ("text", "ascending")])
        self.docs, self.size = docs.combine_chunks(), size
        self.text = pa.concat_arrays(self.docs.column("text").chunks or [pa.array([], pa.string())])
        self.data, self.offsets = arrow.utf8(self.text)
        copies = set(zip(info.column("id").to_pylist(), info.column("row_id").to_pylist(), strict=True)) if len(info) else set()
        keys = list(zip(self.docs.column("doc_id").to_pylist(), self.docs.column("row_id").to_pylist(), strict=True))
        self.copy = np.array([k in copies for k in keys], bool)
        self.nameless = np.array([k[0] is None for k in keys], bool)
        self.ids = np.array([k[0] or 0 for k in keys], np.int64)
        self._segments()

    def pieces(self):
        """Slices of documents with a bounded number of bytes."""
        a, n = 0, len(self.ids)
        while a < n:
            b = max(a + 1, int(np.searchsorted(self.offsets, self.offsets[a] + arrow.CHUNK_BYTES, "right")) - 1)
            yield a, min(b, n)
            a = min(b, n)

    def _segments(self):
        roller, found = arrow.Roller(), []
        for a, b in self.pieces():
            own = ~(self.copy | self.nameless)[a:b]
            low = self.offsets[a]
            h, text, start, count, content = _runs(self.data[low : self.offsets[b]], self.offsets[a : b + 1] - low, roller, self.size)
            good = own[text] if len(text) else np.empty(0, bool)
            found.append((h[good], text[good] + a, start[good] + low, count[good], content[good]))
        if not found:
            found = [[np.empty(0, k) for k in (np.uint64, np.int64, np.int64, np.int64, np.uint64)]]
        self.h, self.owner, self.start, self.count, content = (np.concatenate(x) for x in zip(*found, strict=True))
        doc = self.ids[self.owner] if len(self.owner) else np.empty(0, np.int64)
        order = np.lexsort((doc, self.count, content, self.h))
        key = (self.h[order], content[order], self.count[order])
        new = np.ones(len(order), bool)
        new[1:] = reduce(np.logical_or, (k[1:] != k[:-1] for k in key))
        #: the first run of each distinct segment, in the order of h; and the distinct segment of each run
        self.first = order[new]
        self.segment = np.empty(len(order), np.int64)
        self.segment[order] = np.cumsum(new) - 1
        self.least = doc[self.first]

    def hashes(self) -> np.ndarray:
        h = self.h[self.first]
        return h[np.concatenate(([True], h[1:] != h[:-1]))[: len(h)]]

    def bytes_of(self, run: np.ndarray) -> np.ndarray:
        n = self.count[run] + self.size - 1
        at = np.repeat(self.start[run] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.data[at]


def _short(h: np.ndarray) -> np.ndarray:
    """The low six bytes of each hash."""
    return np.ascontiguousarray(h.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6]


def _long(x: bytes) -> np.ndarray:
    out = np.zeros((len(x) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(x, np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1).astype(np.uint64)


def _cuts(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket ranges that sorted hashes fall in, and where they begin and end."""
    bucket = ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))[: len(h)])
    return bucket[first], np.append(first, len(h))


def _empty(schema: str) -> pa.Table:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")]).empty_table()


def _info(rows: list[tuple]) -> pa.Table:
    blank = _empty(INFO)
    return pa.Table.from_pydict({n: [r[i] for r in rows] for i, n in enumerate(blank.column_names)}, schema=blank.schema)


def repeated_passages(docs: DataFrame, size: int = 50, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, spans (start, end of each maximal removed run) and kept (binary).

    Removed is each byte covered by a string of ``size`` bytes that also starts in a document with a smaller doc_id;
    texts are UTF-8 bytes as given, and no string crosses documents.

    1. Equal texts: of all but the smallest doc_id everything goes (if ``size`` bytes long), known from digests.
    2. Documents are grouped by a hash, a bounded number of bytes a group. A window belongs to the suffix bucket of
       its smallest seed hash. Each group tells which buckets it has; a bucket that lies in one group alone, with one
       content, has nothing to compare. That needs six bytes a bucket and group, however often it occurs there.
    3. Each group sends its distinct segments (runs of windows of one bucket) of the other buckets, once each, with the
       smallest document that has it. Buckets are sorted a block at a time, see ``sort_block``; windows that
       are equal for ``size`` bytes are neighbours then. Back come masks of windows that a smaller document has.
    4. Each group marks: all windows of a segment that a smaller document of the group has too, and the masks.

    A bucket of very many distinct segments is one block of one task; its copies within groups have been folded by
    then. Null text is empty. Texts shorter than ``size`` are kept. A null doc_id is neither smaller nor larger
    than others: it is kept whole and supplies nothing. Rows with equal doc_id do not remove from each other; repeated rows are
    judged alike. Extra columns are not read.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-total // group_bytes))
    keyed = docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).alias("chunk"), "doc_id", F.xxhash64("text").alias("row_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    thin = keyed.where(f"doc_id IS NOT NULL AND octet_length(text) >= {size}").select("chunk", "doc_id", "row_id", F.md5("text").alias("digest"))
    smallest = thin.groupBy("digest").agg(F.min("doc_id").alias("first"))
    copies = thin.join(smallest, "digest").where("doc_id > first").select(
        "chunk", F.lit(0).alias("kind"), F.col("doc_id").alias("id"), "row_id", F.lit(None).cast("binary").alias("x"), F.lit(None).cast("binary").alias("y")
    ).distinct()
    copies = materialize(copies, "copies")
    rows = keyed.groupBy("chunk")

    def tell(key, left, right):
        if not len(left):
            return _empty("bucket bigint, chunk bigint, x binary")
        h = Chunk(left, right, size).hashes()
        bucket, at = _cuts(h, groups)
        short = _short(h)
        blobs = [short[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
        return pa.table({"bucket": pa.array(bucket, pa.int64()), "chunk": pa.array([key[0].as_py()] * len(blobs), pa.int64()), "x": pa.array(blobs, pa.binary())})

    def shared(table):
        chunks = table.column("chunk").to_numpy()
        lists = [np.unique(_long(x.as_py())) for x in table.column("x")]
        where = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        h = np.concatenate(lists)
        order = np.argsort(h, kind="stable")
        h, where = h[order], where[order]
        twice = np.zeros(len(h) + 1, bool)
        twice[1:-1] = h[1:] == h[:-1]
        hit = twice[1:] | twice[:-1]
        h, where = h[hit], where[hit]
        by = np.argsort(where, kind="stable")
        at = np.searchsorted(where[by], np.arange(len(lists) + 1))
        return _info([(int(chunks[i]), 1, None, None, _short(h[by[at[i] : at[i + 1]]]).tobytes(), None) for i in range(len(lists)) if at[i + 1] > at[i]])

    def send(key, left, right):
        if not len(left):
            return _empty(NOTES)
        chunk = Chunk(left, right, size)
        h = chunk.h[chunk.first]
        told = [x.as_py() for x, k in zip(right.column("x"), right.column("kind").to_pylist(), strict=True) if k == 1]
        known = np.sort(_long(b"".join(told)))
        low = h & np.uint64((1 << 48) - 1)
        at = np.minimum(np.searchsorted(known, low), max(len(known) - 1, 0))
        good = known[at] == low if len(known) else np.zeros(len(h), bool)
        again = np.zeros(len(h) + 1, bool)
        again[1:-1] = h[1:] == h[:-1]
        good |= again[1:] | again[:-1]
        ordinal = np.flatnonzero(good)
        if not len(ordinal):
            return _empty(NOTES)
        bucket, cuts = _cuts(h[ordinal], groups)
        rows = []
        for b, x, y in zip(bucket, cuts[:-1], cuts[1:], strict=True):
            mine = ordinal[x:y]
            run = chunk.first[mine]
            rows.append((int(b), key[0].as_py(), h[mine].astype("<u8").tobytes(), mine.astype("<i8").tobytes(), chunk.least[mine].astype("<i8").tobytes(), (chunk.count[run] + size - 1).astype("<i8").tobytes(), chunk.bytes_of(run).tobytes()))
        blank = _empty(NOTES)
        return pa.Table.from_pydict({n: [r[i] for r in rows] for i, n in enumerate(blank.column_names)}, schema=blank.schema)

    def settle(table):
        def joined(name, kind):
            return np.frombuffer(b"".join(x.as_py() for x in table.column(name)), kind)

        ordinal = joined("ordinal", "<i8")
        masks = earlier(joined("h", "<u8"), joined("doc", "<i8"), joined("length", "<i8"), joined("data", np.uint8), size)
        chunks, sizes = table.column("chunk").to_numpy(), [len(x.as_py()) // 8 for x in table.column("ordinal")]
        rows, a = [], 0
        for c, n in zip(chunks, sizes, strict=True):
            m, o = masks[a : a + n], ordinal[a : a + n]
            a += n
            if m.any():
                rows.append((int(c), 2, None, None, o[m != 0].astype("<i8").tobytes(), m[m != 0].astype("<u4").tobytes()))
        return _info(rows)

    def mark(key, left, right):
        out = {"doc_id": [], "n_bytes": [], "spans": [], "kept": []}
        kinds = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])
        if not len(left):
            return kinds.empty_table()
        chunk = Chunk(left, right, size)
        masks = np.zeros(len(chunk.first), np.uint32)
        for x, y, k in zip(right.column("x").to_pylist(), right.column("y").to_pylist(), right.column("kind").to_pylist(), strict=True):
            if k == 2:
                masks[np.frombuffer(x, "<i8")] = np.frombuffer(y, "<u4")
        later = chunk.ids[chunk.owner] > chunk.least[chunk.segment]
        full = ((np.uint64(1) << chunk.count.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)
        mask = np.where(later, full, masks[chunk.segment])
        hit = np.flatnonzero(mask)
        diff = np.zeros(len(chunk.data) + size + 1, np.int32)
        for k in range(RUN):
            at = chunk.start[hit[(mask[hit] >> np.uint32(k)) & np.uint32(1) != 0]] + k
            diff[at] += 1
            diff[at + size] -= 1
        for i in np.flatnonzero(chunk.copy):
            diff[chunk.offsets[i]] += 1
            diff[chunk.offsets[i + 1]] -= 1
        gone = np.cumsum(diff)[: len(chunk.data)] > 0
        raw = chunk.data.tobytes()
        edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
        up, down = edge[::2], edge[1::2]
        ids = chunk.docs.column("doc_id").to_pylist()
        for i, (a, b) in enumerate(zip(chunk.offsets[:-1].tolist(), chunk.offsets[1:].tolist(), strict=True)):
            first, last = np.searchsorted(down, a, "right"), np.searchsorted(up, b, "left")
            spans = [(max(int(x), a), min(int(y), b)) for x, y in zip(up[first:last], down[first:last], strict=True)]
            parts, at = [], a
            for x, y in spans:
                parts.append(raw[at:x])
                at = y
            out["doc_id"].append(ids[i])
            out["n_bytes"].append(b - a)
            out["spans"].append([{"start": x - a, "end": y - a} for x, y in spans])
            out["kept"].append(b"".join([*parts, raw[at:b]]))
        return pa.Table.from_pydict(out, schema=kinds)

    info = copies.groupBy("chunk")
    told = rows.cogroup(info).applyInArrow(tell, "bucket bigint, chunk bigint, x binary")
    common = told.groupBy("bucket").applyInArrow(shared, INFO)
    notes = rows.cogroup(copies.unionByName(common).groupBy("chunk")).applyInArrow(send, NOTES)
    answers = notes.groupBy("bucket").applyInArrow(settle, INFO)
    return rows.cogroup(copies.unionByName(answers).groupBy("chunk")).applyInArrow(
        mark, "doc_id bigint, n_bytes bigint, spans array<struct<start: bigint, end: bigint>>, kept binary"
    )
