"""Quality rules whose cutoffs come from labelled documents with a bound on false rejections. DataFrame functions only."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.exprs import let
from fareloom.session import materialize

WHITE = r"\\x20\\x09-\\x0D"
TRIM = "concat(' ', char(9), char(10), char(11), char(12), char(13))"
#: Rule name and the ratio that it bounds from above.
RULES = {
    "symbols": "n_symbols / word_chars",
    "repeated_words": "n_repeat_words / n_words",
    "repeated_lines": "n_dup_lines / n_full_lines",
    "capitals": "n_capitals / word_chars",
    "exclamations": "n_exclamations / n_words",
}
#: Cutoffs that are tried for every rule, from lenient to strict.
CUTOFFS = (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05, 0.02)


def features(docs: DataFrame, by: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, stratum, the counts that the rules use, and text_key, the same for equal texts.

    Repeated three-word windows are found by sorting, per text, the windows by hash, then words, then place: equal
    ones become neighbours, in n log n steps for texts of any length, and unlike ones of one hash stay apart.
    """
    text = docs.select(
        "doc_id", F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit("")).alias("stratum"),
        F.coalesce("text", F.lit("")).alias("t"),
    )
    window = "struct(xxhash64(w[i], w[i + 1], w[i + 2]) AS h, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c, i AS place)"
    windows = f"sort_array(if(size(w) < 3, array(), transform(sequence(0, size(w) - 3), i -> {window})))"
    equal = _neighbours("s", "if(x.h = y.h AND x.a = y.a AND x.b = y.b AND x.c = y.c, array(bigint(x.place), bigint(y.place)), null)")
    places = f"sort_array(array_distinct(flatten(filter({equal}, p -> p IS NOT NULL))))"
    covered = f"if(size(q) = 0, 0L, aggregate({_neighbours('q', 'least(3L, y - x)')}, 3L, (a, v) -> a + v))"
    repeated = let("s", windows, let("q", places, covered))
    lines = let("l", f"filter(split(t, '\\n'), l -> btrim(l, {TRIM}) <> '')", "named_struct('full', size(l), 'dup', size(l) - size(array_distinct(l)))")
    return text.select(
        "doc_id", "stratum",
        F.expr(let("w", f"filter(split(t, '[{WHITE}]+'), w -> w <> '')", f"named_struct('n', size(w), 'r', {repeated})")).alias("w"),
        F.expr(lines).alias("l"),
        F.expr(f"bigint(char_length(translate(t, {TRIM}, '')))").alias("word_chars"),
        F.md5("t").alias("text_key"), _count("#*$%&|<>", "n_symbols"), _count("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "n_capitals"), _count("!", "n_exclamations"),
    ).selectExpr(
        "doc_id", "stratum", "bigint(w.n) AS n_words", "word_chars", "n_symbols", "bigint(l.dup) AS n_dup_lines",
        "w.r AS n_repeat_words", "l.full AS n_full_lines", "n_capitals", "n_exclamations", "text_key",
    )


def _neighbours(array: str, body: str) -> str:
    """``body`` for each element x and its successor y."""
    n = f"greatest(size({array}) - 1, 0)"
    return f"zip_with(slice({array}, 1, {n}), slice({array}, 2, {n}), (x, y) -> {body})"


def _count(characters: str, name: str) -> Column:
    return F.expr(f"bigint(char_length(t) - char_length(translate(t, '{characters}', '')))").alias(name)


def _ratio(rule: str) -> str:
    """The ratio of a rule, null for a text that has nothing to divide by (an error under ANSI otherwise)."""
    return "try_divide({}, {})".format(*RULES[rule].split(" / "))


def _log_gamma(x: Column) -> Column:
    """Stirling's series eight places further on, to the precision of doubles for x >= 1."""
    z, product = x + 8, x
    for k in range(1, 8):
        product = product * (x + k)
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7) + 1 / (1188 * z**9)
    return (z - 0.5) * F.log(z) - z + 0.9189385332046727 + series - F.log(product)


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) for n trials of probability ``rate`` where k < n * rate, else 1: the exact test that the true rate
    of something seen k times in n is below ``rate``. The terms are added from the largest down; those left
    out are below 1e-30 of it."""
    k, n = k.cast("double"), n.cast("double")
    top = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * F.log(F.lit(rate)) + (n - k) * F.log1p(F.lit(-rate))
    terms = F.least(k, 64 + 12 * F.sqrt(n)).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(acc, j):
        term = acc["term"] * (k - j + 1) * (1 - rate) / ((n - k + j) * rate)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    total = F.aggregate(F.when(terms > 0, F.sequence(F.lit(1), terms)).otherwise(F.array().cast("array<int>")), start, step, lambda acc: acc["sum"])
    return F.when(k < n * rate, F.least(F.lit(1.0), F.exp(top) * total)).otherwise(F.lit(1.0))


def base_failed(n_words: str = "n_words", n_repeat_words: str = "n_repeat_words") -> Column:
    return (F.col(n_words) < 50) | (100 * F.col(n_repeat_words) > 50 * F.col(n_words))


def cutoffs(counted: DataFrame, labels: DataFrame, risk: float = 0.05, confidence: float = 0.95, price: int = 20) -> DataFrame:
    """(stratum, rule, cutoff, n_good, good_rejected, bad_rejected, p_value) for each rule that is used in a stratum.

    Among documents labelled good (quality 1) that pass the base rules, a rule may reject a share of at most
    ``risk`` / number of rules. A cutoff is safe if the exact binomial probability of as few rejections, were the
    share larger, is at most (1 - confidence) / (strata * rules). Rejections only grow from lenient to strict, so
    cutoffs are tested in that order and the error is not spent again on each. Then, with the given
    confidence, in all strata at once, all rules together reject at most ``risk`` of the good documents. Of
    the safe cutoffs the one with the greatest bad - price * good rejections is used, the most lenient of equals, and none if
    that is not above 0. A stratum with too few labels to prove anything has no rule. Null labels count for nothing.
    The bound is one on independent trials: a document has one label, the worst it was given, and equal texts of a
    stratum are one trial, again with the worst label.
    """
    ratios_of = F.array(*[F.expr(f"coalesce({_ratio(r)}, 0D)") for r in RULES])  # equal texts have equal ones
    ratios = F.map_from_arrays(F.array(*[F.lit(r) for r in RULES]), F.col("r"))
    rows = (
        counted.where(~base_failed())
        .join(labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality")), "doc_id")
        .groupBy("stratum", "text_key").agg(F.min("quality").alias("quality"), F.min(ratios_of).alias("r"))
        .select("stratum", "quality", F.explode(ratios).alias("rule", "ratio"))
    )
    tried = F.array(*[F.lit(c) for c in CUTOFFS])
    level = F.size(F.filter(tried, lambda c: F.col("ratio") > c)).alias("level")
    # the ratio is above the cutoffs of the last `level` places
    levels = rows.groupBy("stratum", "rule", level).agg(F.expr("count_if(quality = 1) AS good"), F.expr("count_if(quality = 0) AS bad"))
    whole = levels.groupBy("stratum", "rule").agg(F.sum("good").alias("n_good"), F.collect_list(F.struct("level", "good", "bad")).alias("levels"))
    strata = F.broadcast(whole.agg(F.countDistinct("stratum").alias("strata")))
    tests = whole.crossJoin(strata).select("*", F.posexplode(tried).alias("place", "cutoff")).select(
        "stratum", "rule", "n_good", "strata", "place", "cutoff",
        *[F.expr(f"aggregate(levels, 0L, (a, x) -> a + if(x.level >= {len(CUTOFFS)} - place, x.{c}, 0L))").alias(f"{c}_rejected") for c in ("good", "bad")],
    )
    safe = tests.withColumn("p_value", binomial_tail(F.col("good_rejected"), F.col("n_good"), risk / len(RULES))).where(
        F.col("p_value") <= F.lit(1 - confidence) / (F.col("strata") * len(RULES))
    )
    worth = (F.col("bad_rejected") - price * F.col("good_rejected")).alias("worth")
    pick = F.max(F.struct(worth, F.col("cutoff").alias("c"), "n_good", "good_rejected", "bad_rejected", "p_value")).alias("m")
    return safe.groupBy("stratum", "rule").agg(pick).where("m.worth > 0").select(
        "stratum", "rule", F.col("m.c").alias("cutoff"), "m.n_good", "m.good_rejected", "m.bad_rejected", "m.p_value"
    )


def quality(docs: DataFrame, labels: DataFrame, by: str = "lang", **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, the base counts, base_failed, kept and the names of the rules that reject.

    Words are runs of other than space and 0x09 to 0x0D. Null, empty and wordless texts have counts of 0
    and fail the base rules. A null ``by`` value is a stratum of its own. Without labels only the base rules hold.
    Several labels of a document and equal texts are one trial (``cutoffs``); repeated rows are judged alike. An empty
    table gives no rows; a very long text is one row with an entry a word. Only doc_id, text, ``by``
    and the labels' doc_id and quality are read. Counts are written once; texts are read once and never shuffled.
    """
    counted = materialize(features(docs, by), "features")
    used = cutoffs(counted, labels, **options).groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cut")
    )
    broken = F.array(*[F.expr(f"if(coalesce({_ratio(r)} > cut['{r}'], false), '{r}', null)") for r in RULES])
    return (
        counted.join(used, "stratum", "left").withColumn("base_failed", base_failed())
        .withColumn("broken", F.array_compact(broken))
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept"), F.array_join("broken", ",").alias("broken_rules"),
        )
    )
