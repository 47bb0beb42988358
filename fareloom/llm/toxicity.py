"""Toxicity by positive-unlabelled learning: confirmed toxic texts, unlabelled texts, and the share of toxic ones."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts that the classifiers are fitted on at most: confirmed toxic ones, unlabelled ones for each classifier, classifiers.
POSITIVES, UNLABELLED, MEMBERS = 3000, 4000, 4
#: A feature must occur in so many confirmed toxic texts, and so many standard deviations more often than in unlabelled ones.
MIN_TEXTS, DEVIATIONS = 4, 4
#: Letters of word beginnings that are features beside whole words, as compounds share them.
BEGINNINGS = (4, 5)


def words(text: str | None) -> set[str]:
    """The distinct lower-case letter runs of a whole text, and their beginnings with a hyphen."""
    found = set(re.findall(r"[^\W\d_]+", (text or "").lower()))
    return found.union(*({f"{w[:n]}-" for w in found if len(w) > n} for n in BEGINNINGS))


def risk(g: np.ndarray, positive: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """The non-negative risk of scores ``g`` under logistic loss, and its gradient by ``g``.

    Unlabelled texts count as negative, and what toxic ones among them add is taken off again by the prior and the
    confirmed ones. Where that makes the negative part less than nothing, the fit has begun to learn the
    unlabelled texts by heart: the gradient then leads that part back up.
    """
    p = 1 / (1 + np.exp(-np.clip(g, -60, 60)))
    n_p, n_u = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    loss_as_positive, loss_as_negative = np.logaddexp(0, -g), np.logaddexp(0, g)
    toxic = prior * loss_as_positive[positive].sum() / n_p
    clean = loss_as_negative[~positive].sum() / n_u - prior * loss_as_negative[positive].sum() / n_p
    of_clean = np.where(positive, -prior * p / n_p, p / n_u)
    if clean < 0:
        return toxic, -of_clean
    return toxic + clean, np.where(positive, prior * (p - 1) / n_p, 0) + of_clean


def fit(texts: list[str | None], positive: np.ndarray, prior: float, steps: int = 500, rate: float = 0.1, decay: float = 0.05) -> tuple[list[str], np.ndarray, float]:
    """Words, weights and bias of a linear classifier of word presence with the least non-negative risk.

    The square of the weights is held down by ``decay`` for each confirmed text, so that few texts say little.
    """
    sets = [words(t) for t in texts]
    n_p, n_u = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    seen = Counter(w for s, y in zip(sets, positive, strict=True) if y for w in s)
    usual = Counter(w for s, y in zip(sets, positive, strict=True) if not y for w in s if seen[w] >= MIN_TEXTS)

    def telling(word):
        share = (usual[word] + 1) / (n_u + 2)
        return seen[word] / n_p - share >= DEVIATIONS * (share * (1 - share) / n_p) ** 0.5

    vocabulary = sorted(w for w, n in seen.items() if n >= MIN_TEXTS and telling(w))
    index = {w: i for i, w in enumerate(vocabulary)}
    held = [[index[w] for w in sorted(s) if w in index] for s in sets]
    row = np.repeat(np.arange(len(held)), [len(h) for h in held])
    column = np.array([i for h in held for i in h], np.int64)
    theta = np.zeros(len(vocabulary) + 1)
    theta[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        g = np.bincount(row, theta[column], len(held)) + theta[-1]
        by_g = risk(g, positive, prior)[1]
        slope = np.append(np.bincount(column, by_g[row], len(vocabulary)), by_g.sum())
        slope[:-1] += decay / n_p * theta[:-1]
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        theta -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return vocabulary, theta[:-1], float(theta[-1])


def _unit(salt: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), "doc_id"), F.lit(1 << 40)) / float(1 << 40)


def train(texts: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED, members: int = MEMBERS) -> dict:
    """Model from (doc_id, text) and labels (doc_id, toxic): each classifier has the same toxic and other unlabelled texts.

    Both samples are taken by a hash of doc_id with the chance that gives the stated numbers on average, or all if
    there are fewer. Labels of 0 serve for the prior alone. Without a toxic label all weights are empty.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = texts.where("doc_id IS NOT NULL").select("doc_id", "text")
    n_rows = rows.count()
    n_known, n_toxic = known.join(rows.select("doc_id").distinct(), "doc_id").agg(F.count("toxic"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    prior = min(0.9, (n_toxic + 0.5) / (n_known + 1))
    if not n_toxic:
        return {"weights": {}, "bias": float(np.log(prior / (1 - prior)))}
    toxic = rows.where(_unit("toxic") < positives / n_toxic).join(known.where("toxic = 1").select("doc_id"), "doc_id", "left_semi")
    toxic = toxic.select("text", F.lit(True).alias("positive"), F.explode(F.array(*[F.lit(m) for m in range(members)])).alias("member"))
    other = rows.where(_unit("any") < members * unlabelled / n_rows)
    other = other.select("text", F.lit(False).alias("positive"), F.floor(_unit("member") * members).cast("int").alias("member"))

    def run(table):
        vocabulary, weights, bias = fit(table.column("text").to_pylist(), table.column("positive").to_numpy(), prior)
        return pa.table({"words": pa.array([vocabulary], pa.list_(pa.string())), "weights": pa.array([weights], pa.list_(pa.float64())), "bias": [bias]})

    found = toxic.unionByName(other).groupBy("member").applyInArrow(run, "words array<string>, weights array<double>, bias double").collect()
    total = Counter()
    for r in found:
        total.update(dict(zip(r["words"], np.array(r["weights"]) / len(found), strict=True)))
    return {"weights": dict(total), "bias": sum(r["bias"] for r in found) / len(found)}


def scored(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score): the mean classifier's probability that a whole text is toxic."""
    weights, bias = model["weights"], model["bias"]

    def run(batches):
        known = weights.keys()
        for batch in batches:
            g = np.array([bias + sum(weights[w] for w in sorted(words(t.as_py()) & known)) for t in batch.column("text")])
            score = 1 / (1 + np.exp(-np.clip(g, -60, 60)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, score double")


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 if score >= 0.5).

    Learns from rows whose crc32(doc_id as text) mod ``folds`` is not 0, texts and toxic labels alone. A null or
    empty text has no words: it scores as the bias does. A null doc_id is neither held out nor learned from. Null
    labels count for nothing; a document with several labels is toxic if one of them says so. Extra columns are not read.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    model = train(docs.where(fold != 0), labels.where(fold != 0))
    return scored(docs, model).select(
        "doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )
