"""Near-duplicate documents: one-permutation hashing, banded buckets, star-shaped candidates, exact links."""

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm import arrow
from fareloom.llm.graph import components
from fareloom.session import materialize

#: Two sets at the limit of 0.85 miss each other in all 40 bands of 6 rows with a chance of 6e-9, at 0.8 of 8e-6.
BANDS, ROWS = 40, 6


def _sets(batch: pa.RecordBatch, size: int, roller: arrow.Roller) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a batch."""
    parting, lower = arrow.word_table(), arrow.lower_table()
    for part in arrow.chunks(batch, "text"):
        data, offsets = arrow.utf8(part.column("text"))
        start, end, begin = arrow.word_spans(data, offsets, parting)
        words = roller.spans(roller.sums(lower[data]), start, end)
        shingles, at = arrow.shingle_hashes(words, begin, size)
        for i in range(part.num_rows):
            yield np.unique(shingles[at[i] : at[i + 1]])


def _signature(values: np.ndarray, bins: int) -> np.ndarray:
    """One value a bin from one hash of each element; an empty bin takes the value of the first full bin of its own random walk."""
    place = ((values >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    if len(first) == 1:
        return np.full(bins, values[0])
    out, full = np.zeros(bins, np.uint64), np.zeros(bins, bool)
    out[place[first]], full[place[first]] = values[first], True
    empty, tries, step = np.flatnonzero(~full), 0, 16
    while len(empty):
        walk = np.arange(tries, tries + step, dtype=np.uint64) + (empty.astype(np.uint64)[:, None] << np.uint64(32))
        donors = (arrow.mix(walk) % np.uint64(bins)).astype(np.int64)
        found = full[donors]
        hit = found.any(axis=1)
        out[empty[hit]] = out[donors[hit, found[hit].argmax(axis=1)]]
        empty, tries = empty[~hit], tries + step
    return out


def signatures(docs: DataFrame, size: int = 5, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, text) to doc_id, n_shingles, set_id (a digest of the set) and one bucket key for each band.

    Null and empty texts and texts without a word have no shingle, no digest and no bucket.
    """

    def run(batches):
        roller = arrow.Roller()
        salt = arrow.mix(np.arange(bands, dtype=np.uint64))
        for batch in batches:
            counts, digests, keys = [], [], []
            for values in _sets(batch, size, roller):
                counts.append(len(values))
                if not len(values):
                    digests.append(None)
                    keys.append([])
                    continue
                digests.append(blake2b(values.tobytes(), digest_size=16).digest())
                key = salt.copy()
                for column in _signature(values, bands * rows).reshape(bands, rows).T:
                    key = arrow.mix(key + column)
                keys.append(arrow.signed(key))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "set_id", "buckets"],
            )

    return docs.select("doc_id", "text").mapInArrow(arrow.trimmed(run), "doc_id bigint, n_shingles bigint, set_id binary, buckets array<bigint>")


def shingle_sets(docs: DataFrame, size: int = 5) -> DataFrame:
    """(doc_id, text) to doc_id and the whole sorted shingle set, eight bytes each."""

    def run(batches):
        roller = arrow.Roller()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), arrow.binaries(list(_sets(batch, size, roller)))], names=["doc_id", "shingles"]
            )

    return docs.select("doc_id", "text").mapInArrow(arrow.trimmed(run), "doc_id bigint, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets have 100 * common >= percent * together."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate((x, y)), kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * common >= percent * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(arrow.trimmed(run), "a bigint, b bigint")


def unsettled(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of documents in different components, among them all whose similarity is at least ``percent``.

    ``rest`` has doc_id and component. Shingles are ordered by the number of documents in ``rest`` that have them.
    Two sets as alike as asked for share one among the first n - ceil(percent * n / 100) + 1 of their n shingles,
    and from its place in both follows how many more they can share. Shingles that no other document has come
    first: a copy with many changes of its own is out at once, however large its group. Of the smaller set (of sets of
    one size, either) the shared one is even among the first n - ceil(2 * percent * n / (100 + percent)) + 1, so sets
    are looked for by those alone: what a family of texts shares comes later if each has enough of its own not to be
    alike. Rows meet by shingle and pair of components, so that no two of one component ever do.
    """

    def explode(batches):
        for batch in batches:
            for part in arrow.chunks(batch, "shingles"):
                values, offsets = arrow.utf8(part.column("shingles"))
                sizes = np.diff(offsets) // 8
                at = pa.array(np.repeat(np.arange(part.num_rows), sizes))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(at), part.column("component").take(at), pa.array(np.repeat(sizes, sizes)), pa.array(values.view(np.int64))],
                    names=["doc_id", "component", "n", "h"],
                )

    held = sets.join(rest, "doc_id").select("doc_id", "component", "shingles")
    held = materialize(held.mapInArrow(arrow.trimmed(explode), "doc_id bigint, component bigint, n bigint, h bigint"), "set-rows")
    common = held.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    held = held.join(common, "h")
    first = f"n - ({percent} * n + 99) div 100 + 1"
    able = held.groupBy("doc_id", "n").agg(F.count(F.lit(1)).alias("known")).where(f"n - known < {first}")
    order = Window.partitionBy("doc_id").orderBy("df", "h")
    prefix = (
        held.join(able.select("doc_id", "known"), "doc_id").withColumn("place", F.col("n") - F.col("known") + F.row_number().over(order))
        .where(f"place <= {first}").select("h", "doc_id", "component", "n", "place")
    )
    prefix = materialize(prefix, "prefixes")
    short = prefix.where(f"place <= n - ({2 * percent} * n + {99 + percent}) div {100 + percent} + 1")
    other = short.selectExpr("h", "doc_id AS other", "component AS other_component", "n AS other_n", "place AS other_place")
    meet = prefix.select("h", "component").distinct().join(other.select("h", "other_component").distinct(), "h").where("component <> other_component")
    return (
        prefix.join(meet, ["h", "component"]).join(other, ["h", "other_component"])
        .where(f"other_n <= n AND 100 * other_n >= {percent} * n")
        .where(f"(100 + {percent}) * (1 + least(n - place, other_n - other_place)) >= {percent} * (n + other_n)")
        .select(F.least("doc_id", "other").alias("a"), F.greatest("doc_id", "other").alias("b")).distinct()
    )


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 85, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest linked doc_id), kept.

    Documents with equal sets fold into the smallest id first, so copies meet as one. In each bucket that two or
    more sets share, the member that meets most others over all its buckets is the centre of a star; only
    centre-member pairs are compared, on whole sets. What a star cannot decide are members of a bucket that are
    still in different components afterwards: these go through ``unsettled``, so no link that shares a bucket is lost.

    Null, empty and wordless texts are linked with nothing. Rows that share a doc_id are one document with
    several texts: a link of any of them counts for all. A row without a doc_id can be named by nothing: its
    component_id is null and it is kept. Extra columns are ignored.
    """
    arrow.prepare(docs)
    sig = materialize(signatures(docs, size, bands, rows), "signatures")
    named = sig.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = named.groupBy("set_id").agg(F.min("doc_id").alias("rep"))
    same = named.select("set_id", "doc_id").join(classes, "set_id").where("doc_id <> rep").selectExpr("rep AS a", "doc_id AS b")
    reps = named.join(classes, "set_id").where("doc_id = rep").dropDuplicates(["set_id"])
    held = reps.select("doc_id", "n_shingles", F.explode("buckets").alias("bucket"))
    shared = held.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    held = materialize(held.join(shared, "bucket"), "buckets")

    degree = held.groupBy("doc_id").agg(F.sum("members").alias("degree"))
    centre = held.join(degree, "doc_id").groupBy("bucket").agg(
        F.max(F.struct("degree", (-F.col("doc_id")).alias("minus"), "n_shingles")).alias("c")
    ).select("bucket", (-F.col("c.minus")).alias("centre"), F.col("c.n_shingles").alias("centre_n"))
    alike_size = f"100 * least(n_shingles, {{0}}) >= {percent} * greatest(n_shingles, {{0}})"
    pairs = materialize(
        held.join(centre, "bucket").where("doc_id <> centre").where(alike_size.format("centre_n"))
        .select(F.least("doc_id", "centre").alias("a"), F.greatest("doc_id", "centre").alias("b")).distinct(),
        "pairs",
    )
    wanted = held.select("doc_id").distinct()
    sets = materialize(
        shingle_sets(docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi"), size).distinct(), "sets"
    )
    links = materialize(confirmed(pairs, sets, percent).unionByName(same).distinct(), "confirmed")
    found = components(links)

    held = held.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id")
    )
    mixed = held.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    rest = held.join(mixed.select("bucket"), "bucket", "left_semi").select("doc_id", "component").distinct()
    more = unsettled(materialize(rest, "unsettled"), sets, percent).join(pairs, ["a", "b"], "left_anti")
    more = materialize(confirmed(more, sets, percent), "confirmed")
    if not more.isEmpty():
        found = components(links.unionByName(more))
    return (
        sig.select("doc_id", "n_shingles").join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .select(
            "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
            F.expr("coalesce(doc_id = coalesce(component, doc_id), true)").alias("kept"),
        )
    )


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with all columns, of the document of each component that ``near_duplicates`` keeps.

    Where several rows have one doc_id, each different text of it is a document: the first by text stands for the
    doc_id, the others come after all ids. Of rows equal in doc_id and text one stays. Rows without a doc_id, with null or
    empty text and without a word stay. An empty table stays empty; a very long text is a document like others. Written
    lists of what goes, which are short beside the documents, are joined to the texts.
    """
    several = materialize(docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "several")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if several.isEmpty():
        gone = materialize(near_duplicates(docs, **options).where("NOT kept").select("doc_id").distinct(), "gone")
        return docs.join(gone, "doc_id", "left_anti").select(*columns)
    rows = docs.join(several, "doc_id", "left_semi").select(F.struct(*columns).alias("row"))
    same = Window.partitionBy("row.doc_id", "row.text").orderBy(F.lit(0))
    rows = rows.withColumn("copy", F.row_number().over(same)).where("copy = 1").drop("copy")
    first = Window.partitionBy("row.doc_id").orderBy("row.text")
    behind = F.shiftrightunsigned(F.xxhash64("row.doc_id", "row.text"), 2).bitwiseOR(F.lit(1 << 62))
    rows = rows.withColumn("key", F.when(F.row_number().over(first) == 1, F.col("row.doc_id")).otherwise(behind))
    single = docs.join(several, "doc_id", "left_anti").select(F.struct(*columns).alias("row"), F.col("doc_id").alias("key"))
    rows = materialize(single.unionByName(rows), "row-keys")
    judged = near_duplicates(rows.select(F.col("key").alias("doc_id"), "row.text"), **options)
    gone = materialize(judged.where("NOT kept").select(F.col("doc_id").alias("key")).distinct(), "gone")
    return rows.join(gone, "key", "left_anti").select("row.*")
