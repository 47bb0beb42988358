"""Proportional stratified interleaving: shards of equal row counts that all have the mixture of the whole."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.ranks import ranked, stratum, unit
from fareloom.session import materialize


def assign_shards(docs: DataFrame, shards: int = 8, by: str = "source", seed: int = 17) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard, position, fraction.

    Rows of a stratum are shuffled by a seeded hash of doc_id and ranked; the i-th of n gets the fraction
    (i + u) / n, u being a fixed phase of the stratum, so each stratum is spread evenly over [0, 1) and small strata
    do not pile up at one place. Rows sorted by fraction are cut into ``shards`` runs whose lengths differ by one
    at most (law ``rows``): of each stratum every shard gets its share, to within one row. ``slot`` counts
    from 0 within the shard.

    ``size`` is the UTF-8 bytes of the text plus one; a null text has size 1 and the checksum of nothing. Rows
    with a null source are a stratum; a null doc_id is a value like others. Repeated rows get places of their own.
    An empty table gives no rows. Only doc_id, text and the stratum column are read.
    """
    text = F.coalesce("text", F.lit(""))
    thin = materialize(
        docs.select(
            "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
            stratum(by).alias("stratum"),
        ).withColumn("unit", unit(F.lit(str(seed)), "doc_id")),
        "sized",
    )
    spread = ranked(thin, "stratum", "unit", ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", "stratum",
        ((F.col("group_rank") + unit(F.lit("phase"), "stratum")) / F.col("group_rows")).alias("fraction"),
        F.lit("").alias("everything"),
    )
    spread = materialize(spread, "spread")
    placed = ranked(spread, "everything", "fraction", ["stratum", "doc_id", "text_crc32", "size"]).withColumn(
        "shard", F.expr(f"int(({shards} * (group_rank + 1) - 1) div group_rows)")
    )
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        F.expr(f"group_rank - (shard * group_rows) div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.col("group_rank").alias("position"), "fraction",
    )
