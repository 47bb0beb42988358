"""Benchmark passages in documents: fingerprints of item-sized windows, Hamming blocks, exact check. DataFrame functions only."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.llm.exprs import let
from fareloom.session import materialize

SIZE = 5
#: Words of 64 bits in a fingerprint, and bits of a block.
WORDS, BLOCK_BITS = 4, 16
#: Bits of 256 in which the fingerprints of similar windows may differ. At a similarity of 0.8 about 39 differ, with a deviation of
#: 5.7, and 48 with one of 6.2 for the smallest sets (four of five shingles); more than 88 with a chance below 1e-9. Of
#: windows that have nothing in common 128 differ, with a deviation of 8: fewer than one pair in a million is within the radius.
RADIUS = 88
#: Item shingles that are broadcast at most; beyond that they are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def _shingled(rows: DataFrame, *keys: str) -> DataFrame:
    """``keys``, number of words, and ``sh``: hashes of each five words in a row; of all words if there are fewer."""
    words = (
        "filter(split(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
        " '[\\\\x20\\\\x09-\\\\x0D]+'), x -> x <> '')"
    )
    five = ", ".join(f"w[i + {k}]" for k in range(SIZE))
    shingles = let(
        "w", words,
        f"named_struct('n', size(w), 'sh', CASE WHEN size(w) >= {SIZE} THEN transform(sequence(0, size(w) - {SIZE}), i -> xxhash64({five}))"
        " WHEN size(w) > 0 THEN array(xxhash64(concat_ws(' ', w))) ELSE cast(array() AS array<bigint>) END)",
    )
    return rows.select(*keys, F.expr(shingles).alias("s")).select(*keys, "s.n", "s.sh")


def _fingerprints(counts: DataFrame, *keys: str) -> DataFrame:
    """SimHash of shingle counts (keys, h, c), a row for each word of 64 bits: a bit is set if the shingles that have it
    weigh more than the others. Each word takes its bits from a hash of its own of the shingle."""
    each = counts.select(*keys, "c", F.explode(F.array(*[F.lit(k) for k in range(WORDS)])).alias("word"), "h").withColumn("h", F.xxhash64("h", "word"))
    bits = [F.sum(F.col("c") * F.shiftright("h", b).bitwiseAND(1)).alias(f"b{b}") for b in range(64)]
    summed = each.groupBy(*keys, "word").agg(F.sum("c").alias("whole"), *bits)
    set_bits = [F.when(2 * F.col(f"b{b}") > F.col("whole"), F.shiftleft(F.lit(1).cast("bigint"), b)).otherwise(F.lit(0).cast("bigint")) for b in range(64)]
    return summed.select(*keys, "word", reduce(lambda a, b: a.bitwiseOR(b), set_bits).alias("fp"))


def within(pairs: DataFrame, ours: DataFrame, theirs: DataFrame, radius: int) -> DataFrame:
    """The pairs (content, item) whose fingerprints (content or item, word, fp) differ in ``radius`` bits at most.

    Fingerprints are cut into blocks. Two within the radius differ, in some block, in no more than their share of it:
    pairs are found by such a block, so none is lost, and the whole radius then holds for what is kept.
    """
    apart = F.col("fp").bitwiseXOR(F.col("item_fp"))
    blocks = [F.bit_count(F.shiftrightunsigned(apart, at).bitwiseAND((1 << BLOCK_BITS) - 1)) for at in range(0, 64, BLOCK_BITS)]
    share = radius // (WORDS * 64 // BLOCK_BITS)
    return (
        pairs.join(ours, "content").join(theirs.withColumnRenamed("fp", "item_fp"), ["item", "word"])
        .groupBy(*pairs.columns).agg(F.min(F.least(*blocks)).alias("nearest"), F.sum(F.bit_count(apart)).alias("apart"))
        .where((F.col("nearest") <= share) & (F.col("apart") <= radius)).drop("nearest", "apart")
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = 80, radius: int = RADIUS) -> DataFrame:
    """Matches (doc_id, text_key, item_id, similarity, start_word, n_words): the best window of a document for an item.

    The words of both sides are lower-cased (A-Z) and parted at white space; a window has as many words as the
    item, or all words of a shorter document. The similarity is the weighted Jaccard of five-word shingles, each
    weighing as often as it occurs; pairs of ``percent`` or more are returned, once for each doc_id, text and item,
    with the first of the best windows.

    1. Places in documents that hold a shingle of an item. Where a window of m shingles has fewer such places than
       the similarity needs, it cannot match, and moving a window's start on to the next such place loses none of
       them; so only windows that start there, or end the document, and hold enough are looked at.
    2. Equal windows, which copies have, fold into one. Each gets a SimHash of its weighted shingles.
    3. A window and the item it was cut for are found by a block of their fingerprints in which few bits differ
       (``within``); all within the radius are, and none beyond it is kept.
    4. The exact similarity decides.

    An empty table on either side gives no rows; a very long text is one row of hashes, eight bytes a word.
    Items of fewer than five words are one shingle, and match only a document of just these words. Null, empty and
    wordless texts match nothing. A null doc_id or item_id is a value like others. Repeated rows are
    reported once. Extra columns are not read. Item shingles are broadcast if they were counted to be few.
    """
    items = _shingled(benchmark.select("item_id", "text").distinct(), "item_id", "text").select(
        "item_id", F.xxhash64("item_id", "text").alias("item"), F.size("sh").alias("m"), F.col("n").alias("item_words"), "sh"
    )
    items = materialize(items, "items").where("m > 0")
    counts = items.select("item", "m", F.explode("sh").alias("h")).groupBy("item", "m", "h").agg(F.count(F.lit(1)).alias("c"))
    counts = materialize(counts, "item-shingles")
    small = F.broadcast if counts.count() <= BROADCAST_ROWS else lambda df: df

    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("text_key"))
    held = _shingled(keyed, "doc_id", "text_key")
    # a window of v shingles and an item of m: 100 * common >= percent * (v + m - common)
    need = f"(({percent} * (least(m, size) + m) + 99 + {percent}) div (100 + {percent}))"
    places = (
        held.select("doc_id", "text_key", F.size("sh").alias("size"), F.posexplode_outer("sh").alias("p", "h"))
        .join(small(counts.select("item", "m", "h")), "h")
        .groupBy("doc_id", "text_key", "size", "item", "m").agg(F.sort_array(F.collect_set("p")).alias("ps"))
        .withColumn("need", F.expr(need)).withColumn("last", F.expr("greatest(size - m, 0)"))
    )
    starts = places.selectExpr(
        "doc_id", "text_key", "item", "least(m, size) AS v", "m",
        "explode(array_distinct(concat("
        " filter(transform(ps, (p, i) -> if(get(ps, i + need - 1) - p < m AND p <= last, p, null)), p -> p IS NOT NULL),"
        " if(size(filter(ps, p -> p >= last)) >= need, array(last), array())))) AS start",
    )
    windows = materialize(starts.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "v", "m", "item")).alias("windows")), "windows")

    cut = (
        _shingled(
            keyed.join(windows.select("text_key").distinct(), "text_key", "left_semi").dropDuplicates(["doc_id", "text_key"]), "doc_id", "text_key"
        )
        .join(windows.withColumnRenamed("doc_id", "same_id"), "text_key").where("doc_id <=> same_id")
        .select("doc_id", "text_key", "sh", F.explode("windows").alias("x"))
        .select("doc_id", "text_key", "x.start", "x.v", "x.m", "x.item", F.expr("slice(sh, x.start + 1, x.v)").alias("sh"))
        .withColumn("content", F.xxhash64("sh", "m"))
    )
    cut = materialize(cut, "window-shingles")
    found = (
        cut.dropDuplicates(["content"]).select("content", "m", "v", F.explode("sh").alias("h"))
        .groupBy("content", "m", "v", "h").agg(F.count(F.lit(1)).alias("c"))
    )
    found = materialize(found, "contents")
    pairs = materialize(cut.select("content", "m", "v", "item").distinct(), "window-items")
    near = within(pairs, _fingerprints(found, "content"), _fingerprints(counts, "item"), radius)
    alike = (
        near.join(found.select("content", "h", "c"), "content").join(counts.select("item", "h", F.col("c").alias("item_c")), ["item", "h"])
        .groupBy("content", "m", "v", "item").agg(F.sum(F.least("c", "item_c")).alias("common"))
        .where(f"100 * common >= {percent} * (v + m - common)")
        .select("content", "item", F.expr("common / (v + m - common)").alias("similarity"))
    )
    return (
        cut.select("doc_id", "text_key", "start", "v", "content", "item").join(alike, ["content", "item"])
        .groupBy("doc_id", "text_key", "item").agg(F.max(F.struct("similarity", (-F.col("start")).alias("minus"), "v")).alias("best"))
        .join(items.select("item", "item_id", "item_words", "m"), "item")
        .select(
            "doc_id", "text_key", "item_id", "best.similarity", (-F.col("best.minus")).cast("bigint").alias("start_word"),
            F.expr("bigint(if(item_words < 5, item_words, best.v + 4))").alias("n_words"),
        )
    )
