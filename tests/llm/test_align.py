"""Alignment of two tokenizers against the libraries' own encoding of whole texts and plain loops."""

import hashlib
import sys
from collections import Counter
from pathlib import Path

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import __spark_entry__ as entry
from fareloom.llm import align

sys.path.insert(0, str(Path(__file__).parent))
import plain  # noqa: E402

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "a", "\n", " a b", "a  b   c ", "Hello world, it's 12 a1!? ,.", "<|endoftext|> x<|endoftext|>", "<s> </s><unk><0x0A>",
    "one\r\ntwo\n\n three\t\tfour", "café naïve 北京 日本語 é́", "😀😀 👩‍👩‍👧 ​ x", "already ▁ marked", "▁", "nul \0 here\x1c\x85 a", "　wide　 space",
    "aaaa" * 40, "x" * 5000, "ab cd " * 3000, "the end of the end", "the end of the end", "ﬁ ½ ① Å",
]


@pytest.fixture(scope="module")
def sides():
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    pieces = SentencePieceProcessor(model_file=B)

    def a(text):
        return [(i, bytes(byte[c] for c in tokenizer.id_to_token(i))) for i in tokenizer.encode(" " + text, add_special_tokens=False).ids]

    def b(text):
        found = [(i, pieces.id_to_piece(i)) for i in pieces.encode(text)]
        return [(i, bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()) for i, p in found]

    return a, b


def expected(rows, sides):
    found = [(i, *plain.alignment(t, *sides)) for i, t in rows]
    counts = Counter(pair for *_, links in found for pair in set(links))
    highest = {}
    for (a, _), n in counts.items():
        highest[a] = max(n, highest.get(a, 0))
    for i, a, b, groups, links in found:
        best = sum(counts[x] == highest[x[0]] for x in links)
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        yield i, len(a), len(b), len(groups.split(";")) if groups else 0, len(links), best, sum(counts[x] for x in links), digest


def test_the_query_equals_plain_loops(spark, sides):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = entry.queries()["op11_dictionary_alignment"](spark, SF).collect()
    assert Counter(map(tuple, got)) == Counter(expected(rows, sides))


def test_odd_texts(spark, sides, monkeypatch):
    monkeypatch.setattr(align, "ROW_PAIRS", 300)
    monkeypatch.setattr(align, "WINDOW_BYTES", 37)
    rows = [*enumerate(ODD), (None, "no id"), (3, "the end"), (3, "the end")]
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], "doc_id bigint, text string, a string, n bigint, seq int")
    got = align.link_counts(df.repartition(3), A, B).collect()
    assert Counter(map(tuple, got)) == Counter(expected(rows, sides))
    lists = align.aligned_groups(df, A, B).collect()
    for r, (i, t) in zip(lists, rows, strict=True):
        a, b, groups, _ = plain.alignment(t, *sides)
        assert (r.doc_id, r.a_ids, r.b_ids) == (i, a, b)
        sizes = [tuple(len(side.split(",")) for side in g.split("|")) for g in groups.split(";")] if groups else []
        assert list(zip(r.a_sizes, r.b_sizes, strict=True)) == sizes


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert align.link_counts(df, A, B).collect() == [] and align.aligned_groups(df, A, B).collect() == []
