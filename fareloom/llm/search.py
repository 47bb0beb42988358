"""Ranked lexical search: trees of shared term paths over blocks of documents, searched by branch and bound."""

import heapq
import math
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm import arrow
from fareloom.session import materialize

#: Terms of the items that are searched at once, about; and entries (a term of a document) of a tree.
ITEM_TERMS, TREE_ENTRIES = 1_000_000, 1 << 19
#: Groups of tasks whose best documents are merged before all are.
SALTS = 64
#: Fixed by the ranking: parts of a document's length that count, saturation, and the units of weights and scores.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LENGTH, BASE, UNIT, SATURATION = 90, 10, 1_000_000_000, 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Stands for a null doc_id, which comes after all others.
NO_ID = 1 << 63


def parting() -> np.ndarray:
    """True for the bytes that part terms: all of ASCII but digits and letters."""
    table = np.arange(256) < 0x80
    for first, last in ("09", "AZ", "az"):
        table[ord(first) : ord(last) + 1] = False
    return table


def hashes(terms: list[str]) -> np.ndarray:
    texts = arrow.utf8(pa.array(terms, pa.string()))
    roller = arrow.Roller()
    return roller.spans(roller.sums(texts[0]), texts[1][:-1], texts[1][1:])


def restricted(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, text) to doc_id, n (all terms with repeats), and places in ``terms`` and counts of those the document has.

    Documents without any term have no row.
    """
    wanted = hashes(terms)
    order = np.argsort(wanted)
    wanted, size = wanted[order], max(len(terms), 1)

    def run(batches):
        roller, parts, lower = arrow.Roller(), parting(), arrow.lower_table()
        for batch in batches:
            for piece in arrow.chunks(batch, "text"):
                data, offsets = arrow.utf8(piece.column("text"))
                data = lower[data]
                start, end, begin = arrow.word_spans(data, offsets, parts)
                found = roller.spans(roller.sums(data), start, end)
                place = np.minimum(np.searchsorted(wanted, found), len(wanted) - 1) if len(wanted) else np.zeros(len(found), np.int64)
                hit = np.flatnonzero(wanted[place] == found) if len(wanted) else np.empty(0, np.int64)
                owner = np.searchsorted(begin, hit, "right") - 1
                key, counts = np.unique(owner * size + order[place[hit]], return_counts=True)
                n = np.diff(begin)
                at = pa.array(np.searchsorted(key, np.arange(len(n) + 1) * size), pa.int32())
                out = pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(n), *[pa.ListArray.from_arrays(at, pa.array(x.astype(np.int32))) for x in (key % size, counts)]],
                    names=["doc_id", "n", "terms", "counts"],
                )
                yield out.filter(pa.array(n > 0))

    return docs.select("doc_id", "text").mapInArrow(arrow.trimmed(run), "doc_id bigint, n bigint, terms array<int>, counts array<int>")


def lengths(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Each document's m."""
    if LENGTH * int(n.max(initial=0)) * documents < 1 << 63:
        return BASE + LENGTH * n * documents // total
    return np.array([BASE + LENGTH * x * documents // total for x in n.tolist()], np.int64)


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds for each unit of its weight: grows with tf, falls with m."""
    return UNIT * tf // (1000 * tf + SATURATION * m)


class Tree:
    """A trie over documents whose terms are in the order of frequency; paths without a fork are one step.

    ``nodes`` holds for each fork its children side by side: which they are (below zero: a fork), the best gain of
    each term that occurs beneath each child, from the highest count and the lowest m there, and the lowest doc_id.
    Documents with equal terms, counts and m are one child with their ``k`` lowest doc_ids: they have the same score.
    """

    def __init__(self, doc_ids: list[int], m: np.ndarray, at: np.ndarray, terms: np.ndarray, counts: np.ndarray, k: int):
        same: dict = {}
        big = terms.astype(">u4")
        for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
            same.setdefault((big[a:b].tobytes(), counts[a:b].tobytes(), int(m[i])), []).append(i)
        leaves = [same[key] for key in sorted(same)]
        self.docs = [heapq.nsmallest(k, (doc_ids[i] for i in group)) for group in leaves]
        first = [group[0] for group in leaves]
        paths = [terms[at[i] : at[i + 1]] for i in first]
        tops = [counts[at[i] : at[i + 1]].astype(np.int64) for i in first]
        least = [int(m[i]) for i in first]
        shared = np.array([self._shared(x, y) for x, y in zip(paths[:-1], paths[1:], strict=True)], np.int64)
        forks, todo = [], [(0, len(paths), None)]
        while todo:  # a fork comes before those beneath it
            lo, hi, parent = todo.pop()
            if parent is not None:
                forks[parent].append(-len(forks) - 1 if hi - lo > 1 else lo)
            if hi - lo > 1 or parent is None:
                inner = shared[lo : hi - 1]
                cut = lo + 1 + np.flatnonzero(inner == inner.min(initial=0 if parent is None else np.iinfo(np.int64).max))
                edges = [lo, *cut.tolist(), hi]
                forks.append([])
                todo.extend((a, b, len(forks) - 1) for a, b in zip(edges[:-1], edges[1:], strict=True))
        self.nodes = [None] * len(forks)
        beneath: dict = {}
        for f in reversed(range(len(forks))):
            children = forks[f]
            parts = [beneath.pop(c) if c < 0 else (paths[c], tops[c], least[c], self.docs[c][0]) for c in children]
            sizes = [len(p[0]) for p in parts]
            term, top = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            low = np.array([p[2] for p in parts], np.int64)
            ids = [p[3] for p in parts]
            self.nodes[f] = (children, np.concatenate(([0], np.cumsum(sizes))), term, gain(top, np.repeat(low, sizes)), ids)
            order = np.argsort(term, kind="stable")
            heads = np.flatnonzero(np.diff(term[order], prepend=-1))
            beneath[-f - 1] = (term[order][heads], np.maximum.reduceat(top[order], heads) if len(heads) else top, int(low.min()), min(ids))

    @staticmethod
    def _shared(x: np.ndarray, y: np.ndarray) -> int:
        n = min(len(x), len(y))
        differ = np.flatnonzero(x[:n] != y[:n])
        return int(differ[0]) if len(differ) else n

    def search(self, weights: np.ndarray, best: list, k: int) -> None:
        """Bring ``best``, a heap of (score, -doc_id), up to date for one item, whose terms have ``weights``; depth first.

        What cannot come before the last of ``best`` is not entered: neither by its highest score nor by its lowest doc_id.
        """
        todo = [(0, 0, 0)]
        while todo:
            bound, lowest, fork = todo.pop()
            if bound and len(best) == k and (bound, lowest) <= best[0]:
                continue
            children, at, term, gains, ids = self.nodes[fork]
            weight = weights[term]
            used = np.flatnonzero(weight)
            sums = np.concatenate(([0], np.cumsum(weight[used] * gains[used])))[np.searchsorted(used, at)]
            bounds = np.diff(sums)
            able = np.flatnonzero(bounds >= (best[0][0] if len(best) == k else 1))
            able = able[np.argsort(bounds[able], kind="stable")]
            inner = []
            for i, high in zip(able[::-1].tolist(), bounds[able[::-1]].tolist(), strict=True):
                if children[i] < 0:
                    inner.append((high, -ids[i], -children[i] - 1))
                    continue
                for doc_id in self.docs[children[i]]:
                    if len(best) < k:
                        heapq.heappush(best, (high, -doc_id))
                    elif (high, -doc_id) > best[0]:
                        heapq.heapreplace(best, (high, -doc_id))
                    else:
                        break
            todo.extend(reversed(inner))


def _best(vectors: DataFrame, items: dict, rank: np.ndarray, weight: np.ndarray, documents: int, total: int, k: int, kind: str) -> DataFrame:
    """The ``k`` best documents of each task for each item: item_id, doc_id, score, salt. ``items`` maps ids to places of terms."""

    def run(batches):
        heaps = {item: [] for item in items}
        dense = np.zeros(len(rank), np.int64)
        held, entries = [], 0

        def search():
            doc_ids = [NO_ID if d is None else d for b in held for d in b.column("doc_id").to_pylist()]
            n = np.concatenate([b.column("n").to_numpy() for b in held])
            lists = [[b.column(c).flatten().to_numpy() for b in held] for c in ("terms", "counts")]
            sizes = np.concatenate([np.diff(b.column("terms").offsets.to_numpy()) for b in held])
            places, counts = rank[np.concatenate(lists[0])], np.concatenate(lists[1])
            order = np.lexsort((places, np.repeat(np.arange(len(n)), sizes)))
            tree = Tree(doc_ids, lengths(n, documents, total), np.concatenate(([0], np.cumsum(sizes))), places[order], counts[order], k)
            for item, terms in items.items():
                dense[rank[terms]] = weight[terms]
                tree.search(dense, heaps[item], k)
                dense[rank[terms]] = 0

        for batch in batches:
            batch = batch.filter(pa.compute.greater(pa.compute.list_value_length(batch.column("terms")), 0))
            start = 0
            while start < batch.num_rows:
                ends = batch.column("terms").offsets.to_numpy()[start:] - batch.column("terms").offsets[start].as_py()
                fit = max(1, int(np.searchsorted(ends, TREE_ENTRIES - entries, "right")) - 1)
                held.append(batch.slice(start, fit))
                start += fit
                entries += int(ends[min(fit, len(ends) - 1)])
                if entries >= TREE_ENTRIES // 2:
                    search()
                    held, entries = [], 0
        if held:
            search()
        found = [(item, None if -d == NO_ID else -d, score) for item, heap in heaps.items() for score, d in heap]
        item, doc_id, score = zip(*found, strict=True) if found else ((), (), ())
        salt = [TaskContext.get().partitionId() % SALTS] * len(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, item_type), pa.array(doc_id, pa.int64()), pa.array(score, pa.int64()), pa.array(salt, pa.int32())],
            names=["item_id", "doc_id", "score", "salt"],
        )

    item_type = pa.string() if kind == "string" else pa.int64()
    return vectors.select("doc_id", "n", "terms", "counts").mapInArrow(arrow.trimmed(run), f"item_id {kind}, doc_id bigint, score bigint, salt int")


def top(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` documents (doc_id, text) of the highest score above 0 for each item (item_id, text): item_id, rank, doc_id, score.

    Terms, weights and scores are those of the module's constants. Only the items' terms of a document are kept, with
    their counts, in a written table. Each task reads it a tree at a time: terms in falling order of the documents that have
    them, so that paths are shared; at each fork the highest counts and the lowest m beneath bound the scores, and only
    subtrees that can still reach the ``k`` best found so far are entered. The best of all tasks are merged in two steps.

    Items are searched in blocks of about ``ITEM_TERMS`` terms, so what a task holds does not grow with them. Rows of one
    item_id are one item with the terms of all of them; a null item_id is an item. Null, empty and wordless texts have no
    terms: such items have no rows, such documents do not count. Equal scores go by ascending doc_id, a null one last;
    repeated rows are documents of their own. An empty table on either side gives no rows; other columns are ignored.
    """
    arrow.prepare(docs)
    kind = items.schema["item_id"].dataType.simpleString()
    if kind != "string":
        kind = "bigint"
    each = F.explode(F.expr(f"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), r'{TERM}', 0)"))
    pairs = materialize(items.select(F.col("item_id").cast(kind).alias("item_id"), each.alias("term")).distinct(), "item-terms")
    blocks = -(-pairs.count() // ITEM_TERMS)
    out = docs.sparkSession.createDataFrame([], f"item_id {kind}, doc_id bigint, score bigint, salt int")
    for block in range(blocks):
        rows = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        terms = sorted({r.term for r in rows})
        place = {t: i for i, t in enumerate(terms)}
        wanted = {
            item: np.array([place[r.term] for r in group], np.int64)
            for item, group in groupby(sorted(rows, key=lambda r: (r.item_id is not None, r.item_id or 0 if kind == "bigint" else r.item_id or "")), key=lambda r: r.item_id)
        }
        vectors = materialize(restricted(docs, terms), "term-vectors")
        documents, total = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not documents:
            continue
        df = np.zeros(len(terms), np.int64)
        for term, n in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # at most the block's terms
            df[term] = n
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
        rank = np.empty(len(terms), np.int64)
        rank[np.argsort(-df, kind="stable")] = np.arange(len(terms))
        out = out.unionByName(_best(vectors, wanted, rank, weight, documents, total, k, kind))
    merged = top(top(out, ["item_id", "salt"], k).drop("rank"), ["item_id"], k)
    return merged.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
