"""Sharding, mixing, lines and token files against plain Python over the small table and over odd rows."""

import hashlib
import struct
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from fareloom.llm import huffman, mixing
from fareloom.llm.lines import dedup_lines
from fareloom.llm.mixing import by_deadline, in_mixed_order, mixing_table
from fareloom.llm.shards import assign_shards
from fareloom.llm.token_files import read_token_files, token_table, write_token_files
from fareloom.session import new_path

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, slot string, row string, position string, stratum string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    long_text = "Lorem ipsum dolor. " * 20_000
    rows = [(1, None, None, None), (2, "", "en", "a"), (None, "One\n two ", "en", "a"), (3, " \n\t\n", None, None)]
    rows += [(4, "One\r\ntwo\n\nONE", "en", "a")] * 2 + [(5, long_text, "de", "b"), (4, "another text", "en", "a")]
    rows += [(i, f"one\nrow {i}\n  Same line\t\ncafé  x 's", "fr", "c") for i in range(10, 30)]
    return spark.createDataFrame([(*r, 1, "s", "r", "p", "t") for r in rows], SCHEMA)


def plain_lines(rows, least=10):
    strip = " \t\n\x0b\x0c\r"
    lower = {c: c + 32 for c in range(65, 91)}
    split = [(i, (t or "").split("\n")) for i, t in rows]
    seen = Counter(k for _, ls in split for k in {x.strip(strip).translate(lower) for x in ls})
    for i, ls in split:
        kept = [x for x in ls if not (k := x.strip(strip).translate(lower)) or seen[k] < least]
        yield i, len(ls), len(ls) - len(kept), "\n".join(kept)


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_lines(which, request):
    df = request.getfixturevalue(which)
    got = Counter(map(tuple, dedup_lines(df).collect()))
    assert got == Counter(plain_lines([(r.doc_id, r.text) for r in df.collect()]))


def test_rows_of_one_doc_id_count_as_one_document(spark):
    rows = [(1, f"mine\nshared\nrow {i}") for i in range(10)] + [(i, "shared\nalone") for i in range(2, 10)] + [(None, "nobody")] * 10
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.kept_text for r in dedup_lines(df).collect()} == {*(t for _, t in rows[:18]), ""}  # 9 documents share a line
    got = {r.kept_text for r in dedup_lines(df.unionByName(spark.createDataFrame([(10, "shared\n")], df.schema))).collect()}
    assert got == {*(f"mine\nrow {i}" for i in range(10)), "alone", ""}


def test_line_query_digests_the_kept_text(spark, docs):
    got = {r.doc_id: r.kept_sha256 for r in entry.queries()["op6_line_dedup"](spark, SF).collect()}
    rows = plain_lines([(r.doc_id, r.text) for r in docs.collect()])
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for i, _, _, t in rows}


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_shards(which, request):
    df = request.getfixturevalue(which)
    rows, got = df.collect(), assign_shards(df).collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    shards = defaultdict(list)
    for r in got:
        shards[r.shard].append(r.slot)
    sizes = [len(shards[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}


def test_shards_have_the_mixture(spark):
    df = spark.range(8000).selectExpr("id AS doc_id", "'x' AS text", "if(id % 3 = 0, 'hot', concat('s', id % 37)) AS source")
    source = {r.doc_id: r.source for r in df.collect()}
    seen, whole = defaultdict(Counter), Counter(source.values())
    for r in assign_shards(df).collect():
        seen[r.shard][source[r.doc_id]] += 1
    for s in range(8):
        assert all(abs(seen[s][k] - n / 8) <= 2 for k, n in whole.items())


def plain_mixture(blocks, weights):
    """Slot by slot with fractions: the fluid shares first, then always the earliest deadline of what is released."""
    share, left, served = [Fraction(0)] * len(blocks), {s for s in range(len(blocks)) if blocks[s]}, Fraction(0)
    bounds = [[] for _ in blocks]  # when each whole block has been served
    while left:
        whole = sum(weights[s] for s in left)
        step = min((blocks[s] - share[s]) * whole / weights[s] for s in left)
        for s in left:
            for k in range(len(bounds[s]) + 1, blocks[s] + 1):
                at = (k - share[s]) * whole / weights[s]
                if at > step:
                    break
                bounds[s].append(served + at)
            share[s] += step * weights[s] / whole
        served += step
        left = {s for s in left if share[s] < blocks[s]}
    done, out = [0] * len(blocks), []
    for t in range(sum(blocks)):
        able = []
        for s, n in enumerate(blocks):
            if done[s] < n:
                begun = bounds[s][done[s] - 1] if done[s] else Fraction(0)
                if begun.__floor__() <= t:
                    able.append((bounds[s][done[s]].__ceil__(), s))
        s = min(able)[1]
        out.append((s, done[s]))
        done[s] += 1
    return out


def test_the_query_equals_a_slot_by_slot_simulation(spark, docs):
    got = entry.queries()["op5_pfair_mixing"](spark, SF).collect()
    n = Counter(r.source for r in docs.collect())
    names = sorted(n, key=lambda s: (s is not None, s or ""))
    want = plain_mixture([-(-n[s] // 32) for s in names], [Fraction(n[s] ** 0.5) for s in names])
    assert {(r.slot, r.source, r.block) for r in got} == {(t, names[s], b) for t, (s, b) in enumerate(want)}
    assert sorted(r.position for r in got) == list(range(len(got)))
    assert all(r.release <= r.slot < r.deadline for r in got)
    assert sorted((r.slot, r.position) for r in got) == sorted((r.slot, r.position) for r in sorted(got, key=lambda r: r.position))


@pytest.mark.parametrize("weights", [[1e80, 1.0, 1e-80], [5e-324, 1.0, 3.0], [1e308, 1e308, 1e-308], [0.1, 0.2, 0.7]])
def test_order_for_weights_far_apart(weights):
    blocks = [30, 17, 25]
    got = list(by_deadline(blocks, weights))
    assert [(s, b) for s, b, _, _ in got] == plain_mixture(blocks, [Fraction(w) for w in weights])


def test_weights_have_to_be_finite(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id bigint, source string")
    for bad in (float("inf"), float("nan")):
        with pytest.raises(ValueError):
            mixing_table(df, weights={"a": bad})


def test_blocks_grow_so_that_they_stay_few(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_BLOCKS", 20)
    df = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'a', 'b') AS source")
    got = sorted(mixing_table(df).collect(), key=lambda r: r.position)
    assert max(r.slot for r in got) < 22 and [r.position for r in got] == list(range(3000))


def test_columns_of_any_type_and_empty_tables_are_mixed(spark):
    df = spark.sql("SELECT id AS doc_id, concat('t', id) AS text, 's' AS source, map(id, 'x') AS m, array(map(1, 2)) AS stratum FROM range(50)")
    assert sorted(r.doc_id for r in in_mixed_order(df).collect()) == list(range(50))
    assert in_mixed_order(df.limit(0)).collect() == [] and mixing_table(df.limit(0)).collect() == []


def test_the_share_stays_within_a_block_of_the_exact_weight(spark):
    weights = {"a": 0.751, "b": 0.2485, "c": 0.0005}  # 384.5, 127.2 and 0.3 of 512 slots
    df = spark.range(21_010).selectExpr("id AS doc_id", "if(id < 16000, 'a', if(id < 21000, 'b', 'c')) AS source")
    got = sorted(mixing_table(df, weights=weights, block=1).collect(), key=lambda r: r.slot)
    assert [r.slot for r in got] == [r.position for r in got] == list(range(21_010))
    exact = {s: Fraction(w) for s, w in weights.items()}
    done, whole = Counter(), sum(exact.values())
    for r in got[:20_000]:  # about 40 frames, in which no source is used up
        done[r.source] += 1
        assert all(abs(done[s] - (r.slot + 1) * w / whole) < 1 for s, w in exact.items())
    assert all(r.release <= r.slot < r.deadline for r in got)


def test_shares_follow_the_weights_when_sources_are_used_up():
    blocks, weights = [3000, 500, 40, 7, 9], [2.0, 3.0**0.5, 1.0, 0.0, 0.0]
    order = list(by_deadline(blocks, weights))
    assert Counter((s, b) for s, b, _, _ in order) == Counter((s, b) for s, n in enumerate(blocks) for b in range(n))
    assert {s for s, *_ in order[:3540]} == {0, 1, 2} and all(r <= t < d for t, (_, _, r, d) in enumerate(order))
    done, share, left = Counter(), [0.0] * 5, {0, 1, 2}
    for s, *_ in order[:3540]:
        done[s] += 1
        time = 1.0  # of a slot, served to the sources in use in proportion to their weights
        while time > 1e-9 and left:
            whole = sum(weights[x] for x in left)
            step = min(time, *[(blocks[x] - share[x]) * whole / weights[x] for x in left])
            share = [share[x] + step * weights[x] / whole if x in left else share[x] for x in range(5)]
            left, time = {x for x in left if blocks[x] - share[x] > 1e-9}, time - step
        assert all(abs(done[x] - share[x]) < 1 + 1e-6 for x in range(3))


def test_a_thousand_sources_are_mixed(spark):
    df = spark.range(6000).selectExpr("id AS doc_id", "if(id % 2 = 0, 'hot', concat('web', id % 1999)) AS source")
    n = Counter(r.source for r in df.collect())
    got = sorted(mixing_table(df, power=0.5, block=2).collect(), key=lambda r: r.position)
    assert len(n) > 1000 and Counter(r.source for r in got) == n and [r.position for r in got] == list(range(6000))
    names = sorted(n)
    want = list(by_deadline([-(-n[s] // 2) for s in names], [n[s] ** 0.5 for s in names]))
    assert {(r.slot, r.source, r.block) for r in got} == {(t, names[s], b) for t, (s, b, _, _) in enumerate(want)}
    assert all(r.release <= r.slot < r.deadline for r in got)


def test_uneven_weights_lose_nothing(spark, odd):
    got = in_mixed_order(odd, weights={"a": 5, "b": 0, None: 1}, block=3)
    assert got.columns == odd.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, odd.collect()))
    places = sorted((r.slot, r.source) for r in mixing_table(odd, weights={"a": 5, "b": 0, None: 1}, block=3).collect())
    last = max(t for t, s in places if s in ("a", None))
    assert min(t for t, s in places if s in ("b", "c")) > last  # sources without weight come last


def plain_tokens(rows, order):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start = 0
    for i, text in sorted(rows, key=order):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        yield i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        start += len(ids)


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_token_files(which, request):
    df = request.getfixturevalue(which)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = token_table(df, public_tokenizers.path("byte_bpe_50k.json")).collect()
    order = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())
    assert Counter(map(tuple, got)) == Counter(plain_tokens(rows, order))


def test_odd_white_space_and_special_strings(spark):
    texts = ["a  b\n\n c 's", " x", "x ", "\n\ny", "café  z", "\tq w\t", "<|endoftext|> it's 12 a1 !? ,.", "a <|endoftext|> b", "x<|endoftext|>\ny <|endoftext|><|endoftext|>  z<|endoftext|>", "　x  y", "\0 \x1c \x85 a"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = token_table(df, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert Counter(map(tuple, got)) == Counter(plain_tokens(list(enumerate(texts)), lambda r: r[0]))


def test_token_files_hold_ids_and_survive_an_empty_table(spark, docs):
    path = new_path(spark, "files")
    write_token_files(docs.limit(0), path, public_tokenizers.path("byte_bpe_50k.json"))
    assert read_token_files(spark, path).collect() == []


def test_code_lengths_are_least_under_the_limit():
    import heapq

    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(20):
        counts = (rng.pareto(0.8, rng.integers(1, 300)) * 10).astype(np.int64)
        lengths = huffman.code_lengths(counts, 30)
        heap = [int(c) for c in counts if c]
        total = heap[0] if len(heap) == 1 else 0
        heapq.heapify(heap)
        while len(heap) > 1:
            both = heapq.heappop(heap) + heapq.heappop(heap)
            total += both
            heapq.heappush(heap, both)
        assert (counts * lengths).sum() == total
        short = huffman.code_lengths(counts, 9)
        assert short.max(initial=0) <= 9 and (2.0 ** -short[short > 0]).sum() <= 1
        ids = rng.choice(np.flatnonzero(counts), 1000) if counts.any() else np.empty(0, np.int64)
        data, at = huffman.pack(ids, huffman.canonical(short), short, 64)
        if len(ids):
            assert (huffman.Decoder(short).unpack(data, len(ids), at, 64) == ids).all()
