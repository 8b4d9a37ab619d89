"""Encoding and decoding against the library that the vocabulary file belongs to."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ordermill.llm import byte_pairs, queries

PATH = public_tokenizers.path(byte_pairs.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    with open(PATH, encoding="utf-8") as file:
        return byte_pairs.Codec(file.read())


def listed(ids: bytes) -> list[int]:
    return np.frombuffer(ids, "<u4").tolist()


ODD = [
    "", " ", "  ", "   b", "a 　 x   y\n\n z", "x\x1cy \x1f z\x85 q", "<|endoftext|> a<|endoftext|><|endoftext|>",
    "'s't I'll we're 'LL", "a" * 1000, "漢字かな交じり文の長い文字列です。" * 30, "हिन्दी में", "\U0001f600\U0001f601 é", "<|endof",
    "thequickbrownfox" * 2000, " " * 5000 + "x", "word " * 3000, "�\u0000­",
]


def test_odd_texts(codec, library):
    draw = random.Random(3)
    alphabet = " \t\n  　abcXYZ019'.,!<|>é漢\x1c\x00\x7f­"
    texts = ODD + ["".join(draw.choice(alphabet) for _ in range(draw.randint(1, 60))) for _ in range(3000)]
    got = list(codec.encode([x.encode() for x in texts]))
    for text, ids, want in zip(texts, got, library.encode_batch(texts, add_special_tokens=False)):
        assert listed(ids) == want.ids, text[:80]
        assert codec.decode(ids) == library.decode(want.ids, skip_special_tokens=False) == text


def test_slices_and_small_memory_change_nothing(codec, library, monkeypatch):
    with open(PATH, encoding="utf-8") as file:
        small = byte_pairs.Codec(file.read(), remembered=50)
    monkeypatch.setattr(byte_pairs, "GROUP", 300)
    assert [listed(x) for x in small.encode([x.encode() for x in ODD])] == [x.ids for x in library.encode_batch(ODD, add_special_tokens=False)]
    long = " \n x".join(ODD)
    ids = next(iter(small.encode([long.encode()])))
    assert listed(ids) == library.encode(long, add_special_tokens=False).ids and small.decode(ids) == long


def test_decoding_ids_of_any_kind(codec, library):
    draw = random.Random(5)
    for size in (0, 1, 7, 500):
        ids = [draw.randrange(50257) for _ in range(size)]
        assert codec.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)
    assert codec.decode(np.array([31373, 4_000_000_000, 995], "<u4").tobytes()) == "hello world"


def test_other_kinds_of_vocabulary_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file, pytest.raises(ValueError, match="byte-level"):
        byte_pairs.Codec(file.read())


def want_rows(library, rows):
    out = []
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        out.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out, key=str)


def test_query_on_tables(spark, sf_dir, library):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, queries.op11_byte_pairs(spark, sf_dir).collect()), key=str) == want_rows(library, rows)


def test_edges(edge, edge_rows, library):
    found = byte_pairs.decode(byte_pairs.encode(edge)).collect()
    assert sorted(((r.doc_id, listed(r.ids), r.text) for r in found), key=str) == sorted(
        ((r[0], library.encode(r[1] or "", add_special_tokens=False).ids, r[1] or "") for r in edge_rows), key=str
    )
    assert byte_pairs.decode(byte_pairs.encode(edge.limit(0))).count() == 0
    assert [r.text for r in byte_pairs.decode(edge.selectExpr("CAST(NULL AS binary) ids").limit(1)).collect()] == [""]


def test_one_pass_round_trip_is_encode_then_decode(edge):
    apart = byte_pairs.decode(byte_pairs.encode(edge), text_col="decoded").select("doc_id", "ids", "decoded", "n_tokens")
    whole = byte_pairs.encode_and_decode(edge)
    assert sorted(map(str, apart.collect())) == sorted(map(str, whole.collect()))
