"""Canonical length-limited prefix codes over ids, as numpy arrays."""

import numpy as np


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Bits of each symbol's code, none above ``limit``, with the least total for these counts (package-merge); 0: no code."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    n = len(used)
    if n == 0:
        return lengths
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need codes of more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    if n == 1:
        lengths[order] = 1
        return lengths
    leaves = counts[order].astype(np.float64)
    row, marks = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        packages = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate((leaves, packages))
        place = np.argsort(both, kind="stable")
        row = both[place]
        marks.append(place < n)
    take, depth = 2 * n - 2, np.zeros(n, np.int64)
    for is_leaf in reversed(marks):
        taken = int(np.count_nonzero(is_leaf[:take]))
        depth[:taken] += 1
        take = 2 * (take - taken)
    lengths[order] = depth
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes that follow from the lengths alone: shorter first, then by symbol."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    if len(order):
        top = int(lengths.max())
        steps = np.uint64(1) << (top - lengths[order]).astype(np.uint64)
        codes[order] = (np.cumsum(steps) - steps) >> (top - lengths[order]).astype(np.uint64)
    return codes


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray, every: int) -> tuple[bytes, np.ndarray]:
    """The ids' codes as one bit string, highest bit first, and the bit offset of each ``every``-th id."""
    bits = lengths[ids]
    end = np.cumsum(bits)
    at = end - bits
    if not len(ids):
        return b"", at
    word = at >> 5
    lanes = codes[ids] << (64 - (at & 31) - bits).astype(np.uint64)
    first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    sums = np.add.reduceat(lanes, first)
    out = np.zeros(int(word[-1]) + 2, np.uint64)
    out[word[first]] = sums >> np.uint64(32)
    out[word[first] + 1] += sums & np.uint64(0xFFFFFFFF)
    return out.astype(">u4").tobytes()[: (int(end[-1]) + 7) // 8], at[::every]


class Decoder:
    """One table look-up an id: the next bits give the symbol and how many of them it used."""

    def __init__(self, lengths: np.ndarray):
        self.top = max(1, int(lengths.max(initial=0)))
        self.symbols = np.zeros(1 << self.top, np.uint32)
        self.used = np.ones(1 << self.top, np.uint8)
        coded = np.flatnonzero(lengths)
        order = coded[np.lexsort((coded, lengths[coded]))]
        steps = np.int64(1) << (self.top - lengths[order])
        filled = int(steps.sum())
        self.symbols[:filled] = np.repeat(order, steps)
        self.used[:filled] = np.repeat(lengths[order], steps)

    def unpack(self, data: bytes, n: int, checkpoints: np.ndarray, every: int) -> np.ndarray:
        """All ids of a block: the runs between checkpoints are read side by side."""
        words = np.frombuffer(data + b"\0" * (16 - len(data) % 4), ">u4").astype(np.uint64)
        out = np.zeros((every, len(checkpoints)), np.uint32)
        at, last = checkpoints.astype(np.int64), len(data) * 8
        right, mask = np.uint64(64 - self.top), np.uint64((1 << self.top) - 1)
        for k in range(min(every, n)):
            word = at >> 5
            both = (words[word] << np.uint64(32)) | words[word + 1]
            bits = ((both >> (right - (at & 31).astype(np.uint64))) & mask).astype(np.int64)
            out[k] = self.symbols[bits]
            at = np.minimum(at + self.used[bits], last)
        return out.T.reshape(-1)[:n]
