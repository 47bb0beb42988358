"""Similar documents by groups against the count of what all pairs share."""

import random
import sys
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as entry
from fareloom.llm import set_join
from tools.check_oracles import compare, connect

sys.path.insert(0, str(Path(__file__).parent))
import plain  # noqa: E402

SF = "/root/testdata/sf0.001"
KIND = "doc_id bigint, text string, n bigint, h string, sid int, grp bigint, component string"


def words(rng, n):
    return ["".join(rng.choices("abcdefghij", k=rng.randint(2, 6))) for _ in range(n)]


def changed(rng, base, times):
    out = list(base)
    for _ in range(times):
        out[rng.randrange(len(out))] = words(rng, 1)[0]
    return " ".join(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "h", 2, 3, "c") for i, t in rows], KIND)


def expected(rows):
    return Counter((i, n, c) for i, n, c, _ in plain.near_duplicates(rows, 85, 4))


def families(rng):
    rows = []
    for base, times, members in ((words(rng, 150), 2, 60), (words(rng, 200), 5, 50), (words(rng, 120), 1, 40), (words(rng, 20), 1, 30)):
        rows += [(len(rows) + k, changed(rng, base, rng.randint(0, times))) for k in range(members)]
    rows += [(500 + k, " ".join(words(rng, rng.randint(1, 80)))) for k in range(60)]
    passage = " ".join(words(rng, 50))
    return rows + [(600 + k, " ".join(words(rng, 40)) + " " + passage) for k in range(60)]


@pytest.mark.parametrize("members", [3, 64])
def test_families_of_copies(spark, monkeypatch, members):
    monkeypatch.setattr(set_join, "MEMBERS", members)
    rows = families(random.Random(members))
    assert Counter(map(tuple, set_join.similar_documents(frame(spark, rows).repartition(5)).collect())) == expected(rows)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(set_join, "SHINGLES", 700)
    rng = random.Random(4)
    base = words(rng, 90)
    rows = [(1, None), (2, ""), (None, " ".join(base)), (3, " \n\t"), (4, "Three short words"), (5, "three SHORT\nwords"), (6, "short words three")]
    rows += [(7, " ".join(base)), (7, " ".join(base)), (9, " ".join(base).upper()), (8, " ".join(words(rng, 30))), (8, changed(rng, base, 1))]
    rows += [(20 + k, changed(rng, base, 3)) for k in range(30)] + [(70, " ".join(words(rng, 20_000))), (71, "a b c " * 5000), (72, "a b c a"), (73, "x" * 300)]
    assert Counter(map(tuple, set_join.similar_documents(frame(spark, rows)).collect())) == expected(rows)


def test_empty_table(spark):
    assert set_join.similar_documents(frame(spark, [(1, "a")]).limit(0)).collect() == []


def test_the_query_equals_its_twin_and_the_count(spark):
    name = "op13_token_group_join"
    got = entry.queries()[name](spark, SF)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert Counter(map(tuple, got.collect())) == expected(rows)
    assert compare(got, connect(SF), entry.oracle_sql()[name]) is None


def test_a_family_just_below_the_limit_qualifies_nothing(spark, monkeypatch):
    """Each text has changes of its own, so that any two are 83 to 85 % alike: work must not grow with all pairs."""
    counts = {}
    opened = set_join.opened

    def counted(pairs, *rest):
        counts.setdefault(members, []).append(pairs.count())
        return opened(pairs, *rest)

    monkeypatch.setattr(set_join, "opened", counted)
    monkeypatch.setattr(set_join, "MEMBERS", 8)
    for members in (100, 200):
        rng = random.Random(1)
        base = words(rng, 400)
        rows = []
        for k in range(members):
            text = list(base)
            for at in rng.sample(range(50), 9):
                text[8 * at] = f"own{k}x{at}"
            rows.append((k, " ".join(text)))
        got = {r.component_id for r in set_join.similar_documents(frame(spark, rows)).collect()}
        assert len(got) == members
    assert counts[200][1] <= 2 * counts[100][1] + 10
