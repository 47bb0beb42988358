"""Language identification: which languages have an n-gram is looked up as a bit mask; the counts of bits decide."""

import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm import arrow

#: Lengths of the n-grams, in letters; a word has one space before and after it.
ORDERS = (2, 3, 4)
#: Training texts of a language (on average, if it has more), the share of them that an n-gram must occur in, and at least how many.
TEXTS, SHARE, LEAST = 4000, 0.02, 2
#: Hash functions of the filter, and its rows for each n-gram that was put in.
HASHES, ROOM = 3, 16


def _letters() -> np.ndarray:
    """True for the code points that are letters; made once in the life of a worker."""
    kept = sys.modules.setdefault("_letter_table", types.ModuleType("_letter_table")).__dict__
    if "table" not in kept:
        kept["table"] = np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return kept["table"]


def grams(texts: list[str | None], orders=ORDERS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams of the texts, the text of each, and for each text whether it has a letter.

    Texts are lower-cased; what is not a letter only parts words.
    """
    lower = [(t or "").lower() for t in texts]
    points = np.frombuffer("\n".join([*lower, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    place = np.repeat(np.arange(len(lower)), [len(t) + 1 for t in lower])
    letter = _letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    x = np.concatenate(([np.uint64(32)], np.where(letter, points, 32)[keep].astype(np.uint64)))
    inner = np.concatenate(([False], letter[keep]))
    place = np.concatenate(([0], place[keep]))
    has = np.zeros(len(lower), bool)
    has[place[inner]] = True
    hashes, where = [], []
    for n in orders:
        m = len(x) - n + 1
        if m <= 0:
            continue
        good = np.ones(m, bool)
        for k in range(1, n - 1):
            good &= inner[k : k + m]
        if n == 2:
            good &= inner[:m] | inner[1 : 1 + m]
        at = np.flatnonzero(good)
        h = np.full(len(at), n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + x[at + k]
        hashes.append(arrow.mix(h))
        where.append(place[at + 1])
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64), has
    return np.concatenate(hashes), np.concatenate(where), has


def _chunk_texts(batches):
    for batch in batches:
        for part in arrow.chunks(batch, "text"):
            yield part, part.column("text").to_pylist()


class Masks:
    """Bit-sliced Bloom filters: row r has a bit for each language whose filter has bit r set, so one look-up of a few
    rows and an AND of them ask the filters of up to 64 languages at once. More languages are more tables."""

    def __init__(self, entries: list[np.ndarray]):
        size = max(64, ROOM * sum(map(len, entries)))
        self.rows = 1 << int(size - 1).bit_length()
        self.languages = len(entries)
        self.tables = []
        for first in range(0, len(entries), 64):
            group = entries[first : first + 64]
            kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if np.dtype(k).itemsize * 8 >= len(group))
            table = np.zeros(self.rows, kind)
            for bit, hashes in enumerate(group):
                for rows in self._rows(hashes):
                    table[np.unique(rows)] |= kind(1 << bit)
            self.tables.append(table)
        #: chance that a filter claims an n-gram that was not put in
        self.false = np.array([np.mean(self.tables[i // 64] >> (i % 64) & 1) ** HASHES for i in range(self.languages)])

    def _rows(self, hashes: np.ndarray):
        step = arrow.mix(hashes) | np.uint64(1)
        for _ in range(HASHES):
            yield (hashes & np.uint64(self.rows - 1)).astype(np.int64)
            hashes = hashes + step

    def counts(self, hashes: np.ndarray, where: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For each text its number of n-grams, and for each language how many the language has, without the false ones."""
        total = np.bincount(where, minlength=n)
        found = np.zeros((self.languages, n))
        masks = [None] * len(self.tables)
        for rows in self._rows(hashes):
            masks = [t[rows] if m is None else m & t[rows] for m, t in zip(masks, self.tables, strict=True)]
        for i in range(self.languages):
            hit = (masks[i // 64] >> masks[i // 64].dtype.type(i % 64)) & masks[i // 64].dtype.type(1)
            found[i] = np.bincount(where[hit.astype(bool)], minlength=n)
        return total, np.maximum(0, (found - total * self.false[:, None]) / (1 - self.false[:, None]))


def train(texts: DataFrame, per_language: int = TEXTS, share: float = SHARE) -> dict:
    """Model from (doc_id, text, lang): the names of the languages and their filters.

    Of a language with more than ``per_language`` texts, about as many are taken by a hash of doc_id. Its filter
    gets the n-grams that at least ``share`` of these texts have, so a stray text of another language adds nothing;
    that also bounds what comes to the driver: at most 1 / ``share`` times the n-grams of a text.
    """
    arrow.prepare(texts)
    known = texts.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(sizes, key=lambda s: (-sizes[s], s))
    if not names:
        return {"names": [], "masks": None}
    chance = F.create_map(*[F.lit(v) for s in names for v in (s, per_language / sizes[s])])
    unit = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 40)) / float(1 << 40)

    def run(batches):
        for part, lists in _chunk_texts(batches):
            hashes, where, _ = grams(lists)
            codes, langs = np.unique(part.column("lang").to_numpy(zero_copy_only=False), return_inverse=True)
            for i, lang in enumerate(codes):
                mine = langs[where] == i
                h, at = hashes[mine], where[mine]
                order = np.lexsort((at, h))
                h, at = h[order], at[order]
                new_gram = np.concatenate(([True], h[1:] != h[:-1]))[: len(h)]
                new_text = new_gram | np.concatenate(([True], at[1:] != at[:-1]))[: len(h)]
                seen, n = h[new_gram], np.bincount(np.cumsum(new_gram)[new_text] - 1, minlength=int(new_gram.sum()))
                texts_here = int((langs == i).sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * (len(seen) + 1), pa.string()), pa.array([None, *arrow.signed(seen).tolist()], pa.int64()), pa.array([texts_here, *n.tolist()], pa.int64())],
                    names=["lang", "h", "n"],
                )

    taken = known.where(unit < chance[F.col("lang")]).mapInArrow(arrow.trimmed(run), "lang string, h bigint, n bigint")
    summed = taken.groupBy("lang", "h").agg(F.sum("n").alias("n"))
    texts_taken = summed.where("h IS NULL").select("lang", F.col("n").alias("texts"))
    common = summed.where("h IS NOT NULL").join(F.broadcast(texts_taken), "lang").where(F.col("n") >= F.greatest(F.lit(LEAST), share * F.col("texts")))
    found = common.select("lang", "h").toArrow()
    langs, hashes = np.array(found.column("lang").to_pylist(), object), found.column("h").to_numpy().view(np.uint64)
    return {"names": names, "masks": Masks([np.sort(hashes[langs == s]) for s in names])}


def predicted(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, lang_pred, score) of whole texts; the score is the share of a text's n-grams that the language has."""
    names, masks = model["names"], model["masks"]

    def run(batches):
        for part, lists in _chunk_texts(batches):
            hashes, where, has = grams(lists)
            if names:
                total, found = masks.counts(hashes, where, len(lists))
                best = found.argmax(axis=0)
                score = np.where(has, np.clip(found[best, np.arange(len(lists))] / np.maximum(total, 1), 0, 1), 0.0)
                lang = [names[b] if ok else "und" for b, ok in zip(best, has, strict=True)]
            else:
                score, lang = np.zeros(len(lists)), ["und"] * len(lists)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(arrow.trimmed(run), "doc_id bigint, lang_pred string, score double")


def accepted(docs: DataFrame, model: dict, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all columns, whose text has a language and at least ``least`` of its n-grams."""

    def run(batches):
        names, masks = model["names"], model["masks"]
        for part, lists in _chunk_texts(batches):
            if not names:
                continue
            hashes, where, has = grams(lists)
            total, found = masks.counts(hashes, where, len(lists))
            yield part.filter(pa.array(has & (found.max(axis=0) >= least * total)))

    return docs.mapInArrow(arrow.trimmed(run), docs.schema)


def identify(docs: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    Learns text and lang of rows whose crc32(doc_id as text) mod ``folds`` is not ``held``; predicts from the text alone.
    Null, empty and letterless texts are ``und`` with score 0; so is everything if no row has a language. Of equal
    languages the one with more training texts wins, then the first by name: a text none of whose n-grams is known
    gets that with score 0. Long texts are read whole; a null doc_id is neither held out nor learned from;
    repeated rows are judged alike. Extra columns are not read.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    return predicted(docs, train(docs.where(fold != held))).select(
        "doc_id", F.coalesce(fold == held, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
