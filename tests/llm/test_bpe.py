from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kerbside.llm import bpe as m
from tests.llm.cases import awkward, prose, rows, with_clashes

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return m.Vocabulary(PATH)


def test_every_code_point_as_the_library(library, vocabulary):
    """Each character after a letter, before one, after a blank, and doubled: words are cut where the library cuts them."""
    encode = m.encoder(vocabulary).encode
    texts = []
    for start in range(0, 0x110000, 64):
        some = [chr(c) for c in range(start, start + 64) if not 0xD800 <= c < 0xE000]
        texts += ["".join(f"a{c}b {c}{c} 1{c}" for c in some)]
    for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert list(encode(text)) == found.ids, ascii(text[:40])


def test_random_texts_as_the_library(library, vocabulary):
    r = random.Random(5)
    parts = ["the", " the", "'s", "'LL", "  ", "\t\n", "<|endoftext|>", "<|endof", "été", "12", "３", "…", " ", "​", "\x00", "\x85", "\x1c", "中文", "😀", "é", "ab", "aaa", " x", "."]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(60))) for _ in range(600)]
    texts += ["".join(r.choice("abeinrst") for _ in range(3_000)), "a" * 5_000, "ab" * 3_000, " " * 500, "<|endoftext|>" * 40]
    encode = m.encoder(vocabulary).encode
    for text in texts:
        found = library.encode(text, add_special_tokens=False).ids
        assert list(encode(text)) == found
        assert m.decode(found, vocabulary.strings) == library.decode(found, skip_special_tokens=False) == text


def test_pieces_and_memory_do_not_show(library, vocabulary, monkeypatch):
    monkeypatch.setattr(m, "PIECE", 16)
    monkeypatch.setattr(m, "REMEMBERED", 5)
    monkeypatch.setattr(m, "LONGEST_REMEMBERED", 4)
    encode = m.Encoder(vocabulary).encode
    for text in (prose(1, 300), " a  b   c " * 50, "x" * 400 + "  y", "don't  \n\n 12 ," * 30, " \x1c a\u3000 b\x85 c"):
        assert list(encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_broken_bytes_decode_as_the_library(library, vocabulary):
    r = random.Random(2)
    for _ in range(300):
        ids = [r.randrange(50_257) for _ in range(r.randrange(12))]
        assert m.decode(ids, vocabulary.strings) == library.decode(ids, skip_special_tokens=False)


def test_round_trip_of_awkward_rows(spark, library):
    df = rows(spark, awkward())
    texts = [(r["doc_id"], r["text"] or "") for r in df.collect()]
    got = m.bpe_decode(m.bpe_encode(with_clashes(df), PATH), PATH).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    expected = sorted(((i, t, library.encode(t, add_special_tokens=False).ids) for i, t in texts), key=key)
    assert sorted(((r["doc_id"], r["decoded"], r["ids"]) for r in got), key=key) == expected
    assert m.bpe_encode(rows(spark, []), PATH).collect() == []


def test_null_and_unknown_ids(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [64, None, 10**6, 65])], "doc_id long, ids array<int>")
    assert [r["decoded"] for r in m.bpe_decode(df, PATH).orderBy("doc_id").collect()] == ["", "", "ab"]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="plain byte-level"):
        m.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_query_digests(spark, library):
    from kerbside.llm.queries import op13_bpe_round_trip

    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op13_bpe_round_trip(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
