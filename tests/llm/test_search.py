"""Ranked search against a plain scoring of every document."""

import math
import random
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

import __spark_entry__ as entry
from fareloom.llm import search
from tools.check_oracles import compare, connect

sys.path.insert(0, str(Path(__file__).parent))
import plain  # noqa: E402

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(plain.LOWER))


def expected(docs, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    total, df = sum(c.total() for _, c in held), Counter(t for _, c in held for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    n, out = len(held), []
    for item, ts in wanted.items():
        weights = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in ts if df[t]}
        found = []
        for i, c in held:
            m = 10 + 90 * c.total() * n // total
            score = sum(w * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t, w in weights.items() if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k])]
    return out


def pairs(df, name):
    return [(r[name], r.text) for r in df.collect()]


def test_the_query_equals_scoring_all_documents(spark):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    got = entry.queries()["op12_document_tree_search"](spark, SF).collect()
    assert Counter(map(tuple, got)) == Counter(expected(pairs(docs, "doc_id"), pairs(items, "item_id")))


def test_the_query_equals_its_twin(spark):
    name = "op12_document_tree_search"
    assert compare(entry.queries()[name](spark, SF), connect(SF), entry.oracle_sql()[name]) is None


@pytest.mark.parametrize("entries", [40, 1 << 19])
def test_ties_copies_and_odd_rows(spark, monkeypatch, entries):
    monkeypatch.setattr(search, "TREE_ENTRIES", entries)
    monkeypatch.setattr(search, "ITEM_TERMS", 9)
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choices("abcdefghij", weights=range(1, 11), k=rng.randint(1, 12)))) for i in range(300)]
    docs += [(1000 - i, "Straße 9x naïve a-b_c") for i in range(40)] + [(5, "a b c"), (5, "a b c"), (None, "a b c"), (None, "a b c")]
    docs += [(2000, None), (2001, ""), (2002, "?! --"), (2003, "z " * 50_000 + "a"), (2004, "É é STRASSE Straße")]
    items = [(1, "a b c"), (2, "STRASSE straße 9X"), (3, None), (4, ""), (5, "unseen"), (6, "a a a"), (6, "j\nz"), (None, "d e"), (7, "a b c")]
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in docs], "doc_id bigint, text string, score int, item_id string").repartition(3)
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")
    got = search.ranked_search(df, asked, k=7).collect()
    assert Counter(map(tuple, got)) == Counter(expected(docs, items, 7))


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a")], "doc_id bigint, text string"), spark.createDataFrame([("q", "a")], "item_id string, text string")
    assert [(r.item_id, r.rank, r.doc_id) for r in search.ranked_search(docs, items).collect()] == [("q", 1, 1)]
    assert search.ranked_search(docs.limit(0), items).collect() == []
    assert search.ranked_search(docs, items.limit(0)).collect() == []


def test_subtrees_are_left_out(monkeypatch):
    rng = np.random.default_rng(2)
    n = 2000
    lists = [np.unique(rng.integers(0, 60, 20)) for _ in range(n)]
    at = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    tree = search.Tree(list(range(n)), np.full(n, 100), at, np.concatenate(lists), rng.integers(1, 4, at[-1]).astype(np.int32), 5)
    entered = []
    monkeypatch.setattr(tree, "nodes", type("Seen", (list,), {"__getitem__": lambda self, i: entered.append(i) or list.__getitem__(self, i)})(tree.nodes))
    weights, best = np.zeros(60, np.int64), []
    weights[[0, 1, 59]] = 10, 20, 9000
    tree.search(weights, best, 5)
    assert len(best) == 5 and len(entered) < len(tree.nodes) / 2
