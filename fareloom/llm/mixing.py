"""Mixing sources to target weights: blocks with release times and deadlines, earliest deadline first."""

import heapq
import math
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.ranks import ranked, stratum, unit
from fareloom.session import materialize

#: Documents of a block at least, and blocks of a mixture (and the short last ones of the sources) at most: with more
#: documents blocks are longer, so that the one task which goes through them has no more steps, whatever the input.
BLOCK, MOST_BLOCKS = 32, 1 << 22
#: Rows of the plan that are handed to Spark at once.
PLAN_ROWS = 1 << 16


def by_deadline(blocks: list[int], weights: list[float]):
    """(source, block, release, deadline) for each slot from 0, by earliest deadline first with exact weights.

    Were blocks divisible, each source in use would get its part of every slot, in proportion to the weights, and one that is
    used up would leave its part to the others. A block may start in the slot in which its share begins to be
    served and must be done with the slot in which it is served whole. Some order meets all these deadlines, so earliest
    deadline first does: at no time is a source a whole block ahead of or behind its share. Sources without a
    positive weight follow when all others are used up, in proportion to their blocks.
    """
    sources, at = range(len(blocks)), 0
    first, rest = [s for s in sources if weights[s] > 0], [s for s in sources if not weights[s] > 0]
    for group, weight in ((first, weights), (rest, blocks)):
        n = [blocks[s] for s in group]
        for i, block, release, deadline in _served(n, [weight[s] for s in group]):
            yield group[i], block, at + release, at + deadline
        at += sum(n)


def _served(n: list[int], weights: list[float]):
    """``by_deadline`` for positive weights. A source's block i is served whole when (i + 1) / weight is passed by a clock
    that runs at one over the weights in use; floats are fractions over a power of two, so sums are those of integers."""
    if not n:
        return
    parts = [float(w).as_integer_ratio() for w in weights]
    scale = math.lcm(*[d for _, d in parts])
    w = [x * (scale // d) for x, d in parts]
    ends, served, active = [], [0], [sum(w)]
    for end, i in sorted((Fraction(n[i], w[i]), i) for i in range(len(n))):
        if not ends or end > ends[-1]:
            ends.append(end)
            served.append(served[-1])
            active.append(active[-1])
        served[-1] += n[i]
        active[-1] -= w[i]
    stage = [0] * len(n)

    def slots(i, k):
        """The slots before and after which k blocks of a source are served; k grows from call to call."""
        j = stage[i]
        while k * ends[j].denominator > ends[j].numerator * w[i]:
            j += 1
        stage[i] = j
        x = k * active[j]
        return served[j] + x // w[i], served[j] - (-x // w[i])

    block, release, begun = [0] * len(n), [0] * len(n), [0] * len(n)
    ready, later = [], []
    for i in range(len(n)):
        begun[i], deadline = slots(i, 1)
        ready.append((deadline, i))
    heapq.heapify(ready)
    for t in range(sum(n)):
        while later and later[0][0] <= t:
            _, deadline, i = heapq.heappop(later)
            heapq.heappush(ready, (deadline, i))
        deadline, i = heapq.heappop(ready)
        if t >= deadline:
            raise AssertionError("a deadline was missed")
        yield i, block[i], release[i], deadline
        block[i] += 1
        if block[i] < n[i]:
            release[i] = begun[i]
            begun[i], deadline = slots(i, block[i] + 1)
            if release[i] <= t + 1:
                heapq.heappush(ready, (deadline, i))
            else:
                heapq.heappush(later, (release[i], deadline, i))


def block_plan(counts: DataFrame, weights: dict | None, power: float, block: int) -> DataFrame:
    """One row per block, from (stratum, n): stratum, block, release, deadline, slot, and start, the documents before it.

    Each slot depends on the one before it, so one task goes through them, a step per block, of which there are about
    ``MOST_BLOCKS`` at most; it holds a few numbers a source, and hands over the blocks as it goes."""
    target = None if weights is None else {"" if s is None else f"={s}": float(w) for s, w in weights.items()}
    if target and not all(map(math.isfinite, target.values())):
        raise ValueError("weights have to be finite")

    def run(batches):
        found = sorted(row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        names, n = pa.array([s for s, _ in found], pa.string()), [k for _, k in found]
        w = [k**power if target is None else target.get(s, 0.0) for s, k in found]
        del found
        blocks = [-(-k // block) for k in n]
        order = by_deadline(blocks, w)
        slot = start = 0
        while rows := list(islice(order, PLAN_ROWS)):
            sizes = [min(block, n[s] - b * block) for s, b, _, _ in rows]
            starts = [start]
            for size in sizes:
                starts.append(starts[-1] + size)
            start = starts.pop()
            source, *numbers = zip(*rows, strict=True)
            numbers += [range(slot, slot + len(rows)), starts]
            slot += len(rows)
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(source, pa.int64())), *[pa.array(x, pa.int64()) for x in numbers]],
                names=["stratum", "block", "release", "deadline", "slot", "start"],
            )

    kind = "stratum string, block bigint, release bigint, deadline bigint, slot bigint, start bigint"
    return counts.select("stratum", "n").repartition(1).mapInArrow(run, kind)


def mixed(docs: DataFrame, weights: dict | None = None, power: float = 0.5, by: str = "source", seed: int = 29, block: int | None = None) -> DataFrame:
    """``docs`` in one struct column ``row``, with stratum, block, release, deadline, slot and position in the mixture.

    Each source is shuffled by a seeded hash of doc_id and cut into blocks of ``block`` documents, which take the
    slots of ``by_deadline``; position counts documents from 0. Without ``block``, blocks have ``BLOCK`` documents, or as many
    more as keep them to ``MOST_BLOCKS``. ``weights`` maps sources (None: the null source) to finite weights; without it a
    source of n documents gets n ** ``power``. No document is dropped or repeated: when a source is used up, the others go on
    in their proportions. The last block of a source may be short.

    Places follow from the rank within the source and a written plan of one row a block, for any number of sources.
    Null sources are a source; a null doc_id is a value like others; null and empty texts are documents like others, very
    long ones too; repeated rows get places of their own, ties of doc_id go by a hash of the text; an empty table gives no rows;
    no column name can clash, as rows travel as one struct, and columns may have any type.
    """
    tie = [F.col(c) for c in ("doc_id", "text") if c in docs.columns]
    held = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), stratum(by).alias("stratum"),
        unit(F.lit(str(seed)), "doc_id").alias("unit"), F.xxhash64(*tie).alias("tie"),
    )
    counts = materialize(docs.select(stratum(by).alias("stratum")).groupBy("stratum").agg(F.count(F.lit(1)).alias("n")), "mixture-sources")
    if block is None:
        block = max(BLOCK, -(-(counts.agg(F.sum("n")).first()[0] or 0) // MOST_BLOCKS))
    plan = materialize(block_plan(counts, weights, power, block), "mixture-plan")
    placed = ranked(held, "stratum", "unit", ["tie"]).withColumn("block", F.expr(f"group_rank div {block}"))
    return placed.join(plan, ["stratum", "block"]).select(
        "row", "stratum", "block", "release", "deadline", "slot", (F.col("start") + F.col("group_rank") % block).alias("position")
    )


def mixing_table(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source and the places of ``mixed``."""
    return mixed(docs.select("doc_id", "source"), **options).select(
        "row.doc_id", "row.source", "block", "release", "deadline", "slot", "position"
    )


def in_mixed_order(docs: DataFrame, **options) -> DataFrame:
    """All rows and columns of ``docs``, sorted by position in the mixture; written files keep that order."""
    return mixed(docs, **options).orderBy("position").select("row.*")
