"""Joining similar documents by a token-group matrix: which groups of similar sets can hold a partner, and only those opened."""

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm import arrow
from fareloom.llm.graph import components
from fareloom.llm.near_dup import _sets
from fareloom.session import materialize

#: Hashes below this, a quarter of all, are looked at in every document; a set with too many of its own has no partner.
SAMPLE = 1 << 62
#: Sets of a group at most, and shingles of a group or of the sets that are held against it at once (a longer set is alone).
MEMBERS, SHINGLES = 64, 1 << 16
#: Orders whose first shingle names a bucket with a centre.
BUCKETS = 4


def sampled(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, text) to doc_id, n (shingles of the set), set_id (a digest of the set), key (its first 8 bytes) and the sampled shingles."""

    def run(batches):
        roller = arrow.Roller()
        for batch in batches:
            sets = list(_sets(batch, size, roller))
            ids = [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            few = [s[: np.searchsorted(s, np.uint64(SAMPLE))] for s in sets]
            at = np.concatenate(([0], np.cumsum([len(x) for x in few])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(ids, pa.binary()),
                    pa.array([i and int.from_bytes(i[:8], "little", signed=True) for i in ids], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate([np.empty(0, np.uint64), *few]).view(np.int64))),
                ],
                names=["doc_id", "n", "set_id", "key", "sample"],
            )

    return docs.select("doc_id", "text").mapInArrow(arrow.trimmed(run), "doc_id bigint, n bigint, set_id binary, key bigint, sample array<bigint>")


def whole_sets(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, text) to set_id, n, shingles (sorted, eight bytes each) and the bucket keys, one for each of several orders."""

    def run(batches):
        roller = arrow.Roller()
        salts = arrow.mix(np.arange(1, BUCKETS + 1, dtype=np.uint64))
        for batch in batches:
            sets = [s for s in _sets(batch, size, roller) if len(s)]
            keys = [[int(arrow.signed(arrow.mix(s ^ salt).min(keepdims=True))[0]) for salt in salts] for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array([blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                 arrow.binaries(sets), pa.array(keys, pa.list_(pa.int64()))],
                names=["set_id", "n", "shingles", "buckets"],
            )

    return docs.select("doc_id", "text").mapInArrow(arrow.trimmed(run), "set_id binary, n bigint, shingles binary, buckets array<bigint>")


def exploded(sets: DataFrame) -> DataFrame:
    """(sid, n, shingles) to a row a shingle: sid, n, h."""

    def run(batches):
        for batch in batches:
            for part in arrow.chunks(batch, "shingles"):
                values, offsets = arrow.utf8(part.column("shingles"))
                sizes = np.diff(offsets) // 8
                at = pa.array(np.repeat(np.arange(part.num_rows), sizes))
                yield pa.RecordBatch.from_arrays(
                    [part.column("sid").take(at), part.column("n").take(at), pa.array(values.view(np.int64))], names=["sid", "n", "h"]
                )

    return sets.select("sid", "n", "shingles").mapInArrow(arrow.trimmed(run), "sid bigint, n bigint, h bigint")


def grouped(sets: DataFrame) -> DataFrame:
    """Sets in the order of their bucket keys, cut into groups: sid, grp."""

    def run(batches):
        base, grp, members, held = TaskContext.get().partitionId() << 32, -1, MEMBERS, 0
        for batch in batches:
            out = []
            for n in batch.column("n").to_pylist():
                if members >= MEMBERS or held + n > SHINGLES:
                    grp, members, held = grp + 1, 0, 0
                members, held = members + 1, held + n
                out.append(base + grp)
            yield pa.RecordBatch.from_arrays([batch.column("sid"), pa.array(out, pa.int64())], names=["sid", "grp"])

    order = [*[F.col("buckets")[i] for i in range(BUCKETS)], F.col("sid")]
    return sets.repartitionByRange(*order).sortWithinPartitions(*order).select("sid", "n").mapInArrow(arrow.trimmed(run), "sid bigint, grp bigint")


def opened(pairs: DataFrame, sets: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the sets ``sid`` and the members of the groups ``grp`` of ``pairs``: similar enough, not the same set.

    Each group meets its sets in lots of bounded size. A set has to share enough shingles with the union of a group,
    counting the least a member of a fitting size needs; only then is it compared with the members.
    """

    def run(batches):
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                members = [np.frombuffer(m["shingles"], np.uint64) for m in row["members"]]
                size = np.array([len(m) for m in members], np.int64)
                union, place = np.unique(np.concatenate(members), return_inverse=True)
                starts = np.cumsum(size) - size
                for q in row["lot"]:
                    mine = np.frombuffer(q["shingles"], np.uint64)
                    fit = (100 * np.minimum(size, len(mine)) >= percent * np.maximum(size, len(mine))) & (size <= len(mine))
                    if not fit.any():
                        continue
                    at = np.minimum(np.searchsorted(union, mine), len(union) - 1)
                    at = at[union[at] == mine]
                    if (100 + percent) * len(at) < percent * (len(mine) + int(size[fit].min())):
                        continue
                    hit = np.zeros(len(union), np.int64)
                    hit[at] = 1
                    common = np.add.reduceat(hit[place], starts)
                    for i in np.flatnonzero(fit & (100 * common >= percent * (size + len(mine) - common))).tolist():
                        if row["members"][i]["sid"] != q["sid"]:
                            found.append((q["sid"], row["members"][i]["sid"]))
            a, b = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    asked = pairs.join(sets.select("sid", "n", "shingles"), "sid")
    lots = pairs.join(sets.select("sid", "n"), "sid").groupBy("grp").agg(F.sum("n").alias("all_n"))
    asked = asked.join(lots, "grp").withColumn("part", F.expr(f"pmod(xxhash64(sid), all_n div {SHINGLES} + 1)"))
    asked = asked.groupBy("grp", "part").agg(F.collect_list(F.struct("sid", "shingles")).alias("lot"))
    return asked.join(groups, "grp").select("lot", "members").mapInArrow(arrow.trimmed(run), "a bigint, b bigint")


def qualifying(held: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(sid, grp): sets and the groups that may hold a partner of another component, which is not larger than the set.

    ``held`` has sid, n, h, place: a set's shingles in the order of how few sets have them; ``labels`` has sid, component,
    grp. Of two sets of at least ``percent`` the smaller has, among the first n - ceil(2 p n / (100 + p)) + 1 shingles, one that
    is among the first m - ceil(p m / 100) + 1 of the larger. So the matrix needs only the former of each member, with the
    smallest size and the most that can follow; what is in all sets of a family comes too late to be in it, unless its
    sets are alike, and then they are one component: rows meet by shingle only between different components.
    """
    held = held.join(labels, "sid")
    probe = held.where(f"place <= n - ({percent} * n + 99) div 100 + 1")
    index = held.where(f"place <= n - ({2 * percent} * n + {99 + percent}) div {100 + percent} + 1")
    matrix = index.groupBy("h", "component", "grp").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.col("n") - F.col("place")).alias("after")
    )
    meet = probe.select("h", "component").distinct().join(index.select("h", F.col("component").alias("other")).distinct(), "h").where("component <> other")
    rows = probe.join(meet, ["h", "component"]).select("h", "other", "sid", "n", "place")
    return (
        rows.join(matrix.withColumnRenamed("component", "other"), ["h", "other"])
        .where(f"least <= n AND 100 * most >= {percent} * n")
        .where(f"{100 + percent} * (1 + least(n - place, after)) >= {percent} * (n + greatest(least, ({percent} * n + 99) div 100))")
        .select("sid", "grp").distinct()
    )


def similar_documents(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id (the smallest doc_id linked, itself included).

    All links are found, none by chance:
    1. A set of n shingles can only have a partner if at most n - ceil(percent n / 100) of them are its own: those of a fixed
       quarter of all hashes are counted for every document, then all of the few sets left. Equal sets are one.
    2. Sets in the order of min-hash keys are cut into groups of at most ``MEMBERS`` neighbours. The set of a bucket whose
       shingles are the most common is held against the groups of the bucket's members: copies with changes meet as stars.
    3. Each set that is left with sets of other components is looked up in the matrix of shingles and groups
       (``qualifying``), and held against the groups found (``opened``).

    Null, empty and wordless texts have no shingles and are linked with nothing. Rows that share a doc_id are one document
    with several texts; a row without doc_id is linked with nothing and has no component_id. Repeated rows are copies. An
    empty table gives no rows; other columns are ignored; a very long text is a group of its own.
    """
    arrow.prepare(docs)
    allowed = f"n - ({percent} * n + 99) div 100"
    seen = materialize(sampled(docs, size), "set-samples")
    named = seen.where("doc_id IS NOT NULL AND n > 0")
    classes = named.groupBy("set_id").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.min("key").alias("key"))
    same = named.select("set_id", "doc_id").join(classes, "set_id").where("doc_id <> rep").selectExpr("rep AS a", "doc_id AS b").distinct()
    own = (
        named.select("key", F.explode("sample").alias("h")).groupBy("h").agg(F.min("key").alias("key"), F.max("key").alias("other"))
        .where("key = other").groupBy("key").agg(F.count(F.lit(1)).alias("own"))
    )
    able = classes.join(own, "key", "left").where(f"coalesce(own, 0) <= {allowed}").select("set_id", "rep")
    able = materialize(able, "able")
    texts = docs.select("doc_id", "text").join(able.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = whole_sets(texts, size).join(able, "set_id").dropDuplicates(["set_id"])
    sets = materialize(sets.select(F.monotonically_increasing_id().alias("sid"), "rep", "n", "shingles", "buckets"), "sets")
    rows = materialize(exploded(sets), "set-rows")
    known = rows.join(rows.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "h")
    left = known.groupBy("sid", "n").agg(F.count(F.lit(1)).alias("known"), F.sum("df").alias("weight")).where(f"n - known <= {allowed}")
    left = materialize(left.select("sid", "known", "weight"), "left")
    order = Window.partitionBy("sid").orderBy("df", "h")
    held = known.join(left.select("sid", "known"), "sid").withColumn("place", F.col("n") - F.col("known") + F.row_number().over(order))
    held = materialize(held.where(f"place <= {allowed} + 1").select("sid", "n", "h", "place"), "prefixes")

    sets = sets.join(left.select("sid", "weight"), "sid")
    members = materialize(grouped(sets), "members")
    groups = sets.join(members, "sid").groupBy("grp").agg(F.collect_list(F.struct("sid", "shingles")).alias("members"))
    groups = materialize(groups, "groups")
    bucket = sets.select("sid", "n", "weight", F.explode("buckets").alias("bucket")).join(members, "sid")
    centre = bucket.groupBy("bucket").agg(F.max(F.struct("weight", "sid")).alias("c"), F.count(F.lit(1)).alias("sets")).where("sets > 1")
    stars = bucket.select("bucket", "grp").join(centre.select("bucket", "c.sid"), "bucket").select("sid", "grp").distinct()
    back = bucket.select("bucket", "sid").join(centre.select("bucket", F.col("c.sid").alias("centre")), "bucket").where("sid <> centre")
    back = back.join(members.withColumnRenamed("sid", "centre"), "centre").select("sid", "grp").distinct()
    links = materialize(opened(stars.unionByName(back).distinct(), sets, groups, percent).distinct(), "links")
    labels = members.join(components(links).withColumnRenamed("id", "sid"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    pairs = materialize(qualifying(held, materialize(labels, "labels"), percent), "qualifying")
    links = links.unionByName(opened(pairs, sets, groups, percent))
    reps = sets.select("sid", "rep")
    links = links.join(reps.withColumnRenamed("rep", "x"), links.a == reps.sid).drop("sid").join(reps.withColumnRenamed("rep", "y"), F.col("b") == reps.sid)
    found = components(links.select(F.col("x").alias("a"), F.col("y").alias("b")).unionByName(same))
    return seen.select("doc_id", F.col("n").alias("n_shingles")).join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )
