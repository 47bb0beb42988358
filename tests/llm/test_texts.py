"""Near-duplicates, benchmark passages, repeated passages, quality rules, language and toxicity against plain Python."""

import hashlib
import math
import random
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from fareloom.llm import decontaminate, language, near_dup, rules, suffixes, toxicity
from fareloom.llm.decontaminate import contaminated
from fareloom.llm.graph import components

sys.path.insert(0, str(Path(__file__).parent))
import plain  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, bucket string, component bigint, h bigint, n bigint, w string"


def sentence(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(3)
    base = sentence(rng, 120)
    words = base.split()
    out = [(1, None), (2, ""), (None, base), (3, " \n\t"), (4, "Three short words"), (5, "three SHORT\nwords"), (6, "***")]
    out += [(7, base), (7, base), (9, base.upper()), (8, sentence(rng, 30)), (8, sentence(rng, 40) + "\n" + sentence(rng, 3))]
    for i in range(20, 60):  # near copies of one text, of which many are alike with the text but not with each other
        changed = list(words)
        for _ in range(rng.randint(1, 4)):
            changed[rng.randrange(len(changed))] = sentence(rng, 1)
        out.append((i, " ".join(changed)))
    return [*out, (70, sentence(rng, 30_000)), (71, "a b c " * 5000), (72, "x" * 300), (73, "y" + "x" * 300)]


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    return spark.createDataFrame([(i, t, None, "s", "b", 1, 2, 3, "w") for i, t in odd_rows], SCHEMA)


@pytest.fixture(params=["docs", "odd"])
def both(request, rows, odd_rows):
    return request.getfixturevalue(request.param), rows if request.param == "docs" else odd_rows


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(0, 300)] + [(500, 400), (400, 700), (900, 900), (1000, 2)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**dict.fromkeys([*range(301), 1000], 0), **dict.fromkeys([400, 500, 700], 400)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates(both, percent):
    df, rows = both
    got = Counter(map(tuple, near_dup.near_duplicates(df, percent=percent).collect()))
    assert got == Counter(plain.near_duplicates(rows, percent))


def test_members_whom_no_star_settles(spark):
    """a and b are alike; all the others share much with both, but too little."""
    rng = random.Random(5)
    base = sentence(rng, 200).split()
    rows = []
    for i in range(60):
        own = list(base)
        for k in rng.sample(range(0, 200, 6), 9):
            own[k] = sentence(rng, 1) + str(i)
        rows.append((i, " ".join(own)))
    rows += [(100 + i, rows[i][1] + " end") for i in (7, 31)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = Counter(map(tuple, near_dup.near_duplicates(df).collect()))
    assert got == Counter(plain.near_duplicates(rows, 85))


def test_a_family_just_below_the_limit_has_no_candidates(spark, monkeypatch):
    """Any two texts are 80 to 85 % alike, each by changes of its own: no pair of them may be listed."""
    counts = {}
    confirmed = near_dup.confirmed

    def counted(pairs, *rest):
        counts.setdefault(members, []).append(pairs.count())
        return confirmed(pairs, *rest)

    monkeypatch.setattr(near_dup, "confirmed", counted)
    for members in (100, 200):
        rng = random.Random(1)
        base = sentence(rng, 400).split()
        rows = []
        for k in range(members):
            text = list(base)
            for at in rng.sample(range(50), 7):
                text[8 * at] = f"own{k}x{at}"
            rows.append((k, " ".join(text)))
        got = {r.component_id for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
        assert len(got) == members
    stars, rest = zip(counts[100], counts[200], strict=True)
    assert stars[1] <= 2.5 * stars[0] and rest[1] <= 2.5 * rest[0] + 10


def test_one_row_of_each_component_stays(odd, odd_rows):
    kept = near_dup.one_of_each(odd, percent=80)
    assert kept.columns == odd.columns
    texts = {}
    for i, t in odd_rows:
        if i is not None:
            texts.setdefault(i, set()).add(t)
    keyed = {}  # the first text of an id has the id, others come after all
    for i, ts in texts.items():
        for k, t in enumerate(sorted(ts, key=lambda t: (t is not None, t or ""))):
            keyed[i if k == 0 else 10**6 * k + i] = (i, t)
    want = Counter(keyed[key] for key, _, _, ok in plain.near_duplicates([(key, t) for key, (_, t) in keyed.items()], 80) if ok)
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert Counter(x for x in got.elements() if x[0] is not None) == want
    assert sum(i is None for i, _ in got.elements()) == 1


def test_unlike_texts_of_one_id_stay(spark):
    rng = random.Random(8)
    a, b = sentence(rng, 40), sentence(rng, 40)
    df = spark.createDataFrame([(1, a), (1, b), (1, b), (2, b + " end")], "doc_id bigint, text string")
    assert Counter((r.doc_id, r.text) for r in near_dup.one_of_each(df, percent=80).collect()) in (Counter([(1, a), (2, b + " end")]), Counter([(1, b), (1, a)]))


def test_fingerprints_find_all_similar_windows_and_few_others(spark):
    """Pairs of 0.8 at the least, down to five shingles, are within the radius; of unrelated ones fewer than one in a hundred."""
    rng = random.Random(11)
    sides, alike = {"item": [], "content": []}, set()
    for i in range(60):
        n = rng.choice([5, 10, 20, 40, 80])
        mine = [rng.getrandbits(62) for _ in range(n)]
        sides["item"] += [(i, h, 1) for h in mine]
        for k in range(8):  # as many go as a similarity of 0.8 allows, or as many are replaced
            gone = n - -(-4 * n // 5) if k % 2 else n - -(-8 * n // 9)
            theirs = mine[gone:] + ([] if k % 2 else [rng.getrandbits(62) for _ in range(gone)])
            both = len(set(mine) & set(theirs))
            assert 10 * both >= 8 * (len(mine) + len(theirs) - both)
            sides["content"] += [(8 * i + k, h, 1) for h in theirs]
            alike.add((8 * i + k, i))
    ours, theirs = (decontaminate._fingerprints(spark.createDataFrame(sides[k], f"{k} bigint, h bigint, c bigint"), k) for k in ("content", "item"))
    pairs = spark.createDataFrame([(c, i) for c in range(480) for i in range(60)], "content bigint, item bigint")
    got = {(r.content, r.item) for r in decontaminate.within(pairs, ours, theirs, decontaminate.RADIUS).collect()}
    assert alike <= got and len(got - alike) < 0.01 * (480 * 60 - len(alike))


def test_benchmark_passages(spark, docs, rows):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): r.similarity for r in contaminated(docs, bench).collect()}
    assert got == plain.leaks(rows, [(r.item_id, r.text) for r in bench.collect()], 80)


def test_odd_benchmark_passages(spark, odd, odd_rows):
    rng = random.Random(9)
    items = [(1, None), (2, ""), (3, "short words"), (4, "Three short  words"), (5, "a b c " * 9), (None, sentence(rng, 12)), (7, sentence(rng, 40)), (8, odd_rows[-4][1][5000:5400])]
    long = items[6][1].split()
    near = [*long[:20], "other", *long[20:]]
    more = [(200, "Start. " + items[5][1].upper() + " end"), (201, " ".join(near)), (202, " ".join(long[3:])), (203, "x " + " ".join(long[:36])), (200, "Start. " + items[5][1].upper() + " end")]
    df = odd.unionByName(spark.createDataFrame([(i, t, None, "s", "b", 1, 2, 3, "w") for i, t in more], SCHEMA))
    bench = spark.createDataFrame([(i, t, 1) for i, t in [*items, items[6]]], "item_id bigint, text string, m int")
    found = contaminated(df, bench).collect()
    assert {(r.doc_id, r.item_id): r.similarity for r in found} == plain.leaks([*odd_rows, *more], items, 80)
    assert len({(r.doc_id, r.item_id, r.text_key) for r in found}) == len(found)
    assert contaminated(df, bench.limit(0)).collect() == [] == contaminated(df.limit(0), bench).collect()


@pytest.mark.parametrize("group_bytes", [20_000, 8 << 20])
def test_repeated_passages(both, group_bytes):
    df, rows = both
    got = Counter((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in suffixes.repeated_passages(df, 50, group_bytes).collect())
    want = Counter()
    for i, t, spans in plain.passages(rows, 50):
        kept = b"".join(t[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(t)], strict=True))
        want[i, len(t), tuple(spans), kept] += 1
    assert got == want


def test_passage_query_digests(spark, rows):
    got = Counter(map(tuple, entry.queries()["op4_difference_cover_dedup"](spark, SF).collect()))
    want = Counter()
    for i, t, spans in plain.passages(rows, 50):
        kept = bytes(c for p, c in enumerate(t) if not any(a <= p < b for a, b in spans))
        want[i, len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()] += 1
    assert got == want


def test_blocks_sort_like_suffixes():
    rng = np.random.default_rng(2)
    for alphabet in (1, 2, 26):
        lengths = rng.integers(50, 120, 40)
        text = rng.integers(97, 97 + alphabet, lengths.sum()).astype(np.uint8)
        text[: lengths[:3].sum()] = 97
        end = np.repeat(np.cumsum(lengths), lengths)
        starts = np.concatenate([np.arange(e - n, e - 49) for e, n in zip(np.cumsum(lengths), lengths, strict=True)])
        got = suffixes.sort_block(text, end, starts, suffixes.cover_ranks(text, end))
        key = lambda p: text[p : end[p]].tobytes()
        assert sorted(got) == sorted(starts) and [key(p) for p in got] == sorted(key(p) for p in starts)


def test_unlike_windows_with_nearly_one_hash_are_no_repeats(spark):
    # the last 45 bits of their hashes are equal, which is all that was kept beside a place among 2 ** 18 windows or more
    odd = [w for k in (29289, 6203776, 1454181, 13372586) for w in (f"a{k}", "b", "c", f"z{k}")]
    text = " ".join([*odd, *[f"w{i}" for i in range(270_000)]])
    df = spark.createDataFrame([(1, text, "en"), (2, text + " a1 b c w1 w2 w3 a1 b c", "en")], "doc_id bigint, text string, lang string")
    got = {r.doc_id: (r.n_words, r.n_repeat_words) for r in rules.features(df).collect()}
    assert got == {1: (270_016, 0), 2: (270_025, 12)}  # "a1 b c" and "w1 w2 w3", twice each


def test_counts_of_the_rules(both):
    df, rows = both
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rules.features(df).collect())
    assert got == Counter((i, *plain.counts(t)) for i, t in rows)


def test_binomial_tail_is_exact(spark):
    cases = [(k, n) for n in (1, 7, 60, 900, 20_000) for k in sorted({0, 1, n // 50, n // 25, n})]
    df = spark.createDataFrame(cases, "k bigint, n bigint").select("k", "n", rules.binomial_tail(F.col("k"), F.col("n"), 0.05).alias("p"))
    for r in df.collect():
        logs = [math.lgamma(r.n + 1) - math.lgamma(j + 1) - math.lgamma(r.n - j + 1) + j * math.log(0.05) + (r.n - j) * math.log(0.95) for j in range(r.k + 1)]
        want = min(1.0, sum(map(math.exp, logs))) if r.k < 0.05 * r.n else 1.0
        assert math.isclose(r.p, want, rel_tol=1e-8, abs_tol=1e-300), r


def test_cutoffs_are_proved_for_each_stratum(spark):
    """Symbols mark bad documents in both strata; only the large one has the labels to prove a cutoff."""
    text = "concat_ws(' ', transform(sequence(1, 60), i -> concat('word', i, if(quality = 0, '##', ''), id)))"
    df = spark.range(1500).selectExpr("id", "if(id % 10 = 0, 0, 1) AS quality", "if(id < 1400, 'x', 'y') AS lang").selectExpr("id AS doc_id", "lang", "quality", f"{text} AS text")
    labels = df.select("doc_id", "quality")
    got = {r.doc_id: (r.kept, r.broken_rules) for r in rules.quality(df, labels).collect()}
    assert all(got[i] == ((False, "symbols") if i % 10 == 0 else (True, "")) for i in range(1400))
    assert all(got[i] == (True, "") for i in range(1400, 1500))
    used = rules.cutoffs(rules.features(df), labels).collect()
    assert [(r.stratum, r.rule, r.n_good, r.good_rejected) for r in used] == [("=x", "symbols", 1260, 0)] and used[0].p_value <= 0.05 / 10
    again = labels.unionByName(labels).unionByName(labels)  # the same labels again, and copies of texts, prove nothing more
    assert [tuple(r) for r in rules.cutoffs(rules.features(df), again).collect()] == [tuple(r) for r in used]
    copies = df.unionByName(df.withColumn("doc_id", F.col("doc_id") + 10_000))
    both = labels.unionByName(labels.withColumn("doc_id", F.col("doc_id") + 10_000))
    assert [tuple(r) for r in rules.cutoffs(rules.features(copies), both).collect()] == [tuple(r) for r in used]
    worse = labels.unionByName(spark.createDataFrame([(i, 0) for i in range(400, 500)], "doc_id bigint, quality int"))
    assert [r.n_good for r in rules.cutoffs(rules.features(df), worse).collect() if r.rule == "symbols"] == [1260 - 90]
    assert {r.kept for r in rules.quality(df, labels.limit(0)).collect()} == {True}
    assert rules.quality(df.limit(0), labels).collect() == []


def test_texts_without_words_where_a_rule_is_in_use(spark):
    """Their ratios divide by nothing; they fail the base rules and break no other."""
    text = "concat_ws(' ', transform(sequence(1, 60), i -> concat('word', i, if(id % 10 = 0, '##', ''), id)))"
    df = spark.range(600).selectExpr("id AS doc_id", "'x' AS lang", f"{text} AS text")
    labels = df.selectExpr("doc_id", "if(doc_id % 10 = 0, 0, 1) AS quality")
    wordless = spark.createDataFrame([(2000, "x", ""), (2001, "x", None), (2002, "x", " \n\t")], "doc_id bigint, lang string, text string")
    got = {r.doc_id: (r.n_words, r.base_failed, r.kept, r.broken_rules) for r in rules.quality(df.unionByName(wordless), labels).collect()}
    assert got[0][3] == "symbols" and [got[i] for i in (2000, 2001, 2002)] == [(0, True, False, "")] * 3


def test_ngrams():
    texts = ["Ab, c", None, "", "12 !", "É" * 3 + "x1y"]
    hashes, where, has = language.grams(texts, (2, 3))
    want = []
    for i, t in enumerate(texts):
        for w in "".join(c if c.isalpha() else " " for c in (t or "").lower()).split():
            want += [(i, n) for n in (2, 3) for _ in range(len(w) + 2 - n + 1)]
    assert Counter(where.tolist()) == Counter(i for i, _ in want)
    assert has.tolist() == [True, False, False, False, True]
    again = language.grams([" ab", "c"], (2, 3))[0]
    assert set(again.tolist()) <= set(hashes.tolist())


def test_masks_ask_all_languages_at_once():
    rng = np.random.default_rng(4)
    entries = [np.unique(rng.integers(0, 1 << 63, 200).astype(np.uint64)) for _ in range(70)]
    masks = language.Masks(entries)
    probe = np.concatenate(entries)
    total, found = masks.counts(probe, np.repeat(np.arange(70), [len(e) for e in entries]), 70)
    assert all(abs(found[i, i] - total[i]) < 1 for i in range(70))
    assert max(found[i, j] for i in range(70) for j in range(70) if i != j) < 5


def test_languages(spark, docs, odd):
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = language.identify(docs).collect()
    assert len(got) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    model = language.train(docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1))
    strange = {(r.doc_id, r.lang_pred, r.score) for r in language.predicted(odd.where("doc_id < 7"), model).collect()}
    assert {x for x in strange if x[0] in (1, 2, 3, 6)} == {(i, "und", 0.0) for i in (1, 2, 3, 6)}
    assert {r.lang_pred for r in language.identify(odd).collect()} == {"und"}  # nothing to learn from
    kept = language.accepted(odd.where("doc_id < 7"), model)
    assert kept.columns == odd.columns and language.accepted(odd, language.train(odd)).collect() == []


def test_risk_and_its_gradient():
    rng = np.random.default_rng(6)
    positive = np.arange(60) < 20
    for scale in (0.5, 5):
        g = np.where(positive, scale, 0) + rng.normal(size=60)
        value, slope = toxicity.risk(g, positive, 0.3)
        clean = np.logaddexp(0, g[~positive]).mean() - 0.3 * np.logaddexp(0, g[positive]).mean()
        toxic = 0.3 * np.logaddexp(0, -g[positive]).mean()
        assert math.isclose(value, toxic + max(0, clean))
        for i in (0, 40):
            step = np.zeros(60)
            step[i] = 1e-6
            if clean >= 0:
                assert math.isclose((toxicity.risk(g + step, positive, 0.3)[0] - value) / 1e-6, slope[i], abs_tol=1e-4)


def test_toxicity_learns_from_positives_and_unlabelled_texts(spark):
    rng = random.Random(8)
    rows = []
    for i in range(1500):
        w = sentence(rng, 60).split()
        bad = i % 8 == 0
        if bad:
            for _ in range(3):
                w.insert(rng.randrange(60), rng.choice(["zzidiot", "zzscum", "qqmor" + sentence(rng, 1)]))
        rows.append((i, " ".join(w), int(bad) if i % 3 else None))
    rows += [(5000, None, None), (5001, "", None), (5002, "*", None), (None, "zzidiot zzscum", 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    got = toxicity.toxicity(df, df.select("doc_id", "toxic").where("toxic IS NOT NULL")).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 5000]
    assert sum(r.predicted == (r.doc_id % 8 == 0) for r in held) >= 0.98 * len(held)
    assert {r.predicted for r in got if r.doc_id in (5000, 5001, 5002)} == {0}
    none = toxicity.toxicity(df, df.select("doc_id", "toxic").limit(0)).collect()
    assert len(none) == len(rows) and {r.predicted for r in none} <= {0, 1}
    assert toxicity.toxicity(df.limit(0), df.select("doc_id", "toxic")).collect() == []
