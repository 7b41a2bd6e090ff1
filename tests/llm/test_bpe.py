"""Byte-pair encoding against the library, on the documents and on odd texts."""

import hashlib
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vigil.llm import bpe

SMALL = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "\n\t", "<|startoftext|>", "a<|endoftext|>b<|startoftext|><|endoftext|>", "<|startoftext|", "<|STARTOFTEXT|>",
    "ΑΣ ΣΑΣ Σ", "İstanbul Ǆ ß ŉ", "x́é ǻ", "Ᲊbc Ɤx", "''s !'s 's't don't've 'S 'RE", "!\x1c' \x1d\x1ea b\x0bc\x85d\xa0f",
    "ab\x00c\x1f'1²½Ⅷ", "a" * 1000, "ab" * 700 + "!", "漢字" * 300, "😀" * 200 + "x", "aaa aaaa aaaaa", "qz" * 100 + "e" * 70,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_path())


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe._read(None))


def split(encoder, texts):
    flat, counts = encoder.encode(texts)
    return [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]


def expected(library, texts):
    return [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_odd_texts(library, encoder):
    assert split(encoder, ODD) == expected(library, ODD)


def test_random_texts(library, encoder):
    r = random.Random(5)
    kinds = [lambda: chr(r.randrange(32, 127)), lambda: chr(r.randrange(128, 0xD800)), lambda: chr(r.randrange(0xE000, 0x110000)), lambda: r.choice("etaoins' \n")]
    texts = ["".join(r.choice(kinds)() for _ in range(r.randrange(1, 200))) for _ in range(300)]
    texts += ["".join(r.choices("etaoinshr", k=r.randrange(50, 3000))) for _ in range(40)]
    assert split(encoder, texts) == expected(library, texts)


def test_bounds_change_nothing(library, monkeypatch):
    """Pieces, lists of words and kept words of tiny bounds give the same ids."""
    for name, value in (("PIECE", 7), ("CACHED_WORDS", 3), ("LONG", 4)):
        monkeypatch.setattr(bpe, name, value)
    texts = [t for t in ODD if t] + ["é " * 50, "漢字" * 40 + " été"]
    assert split(bpe.Encoder(bpe._read(None)), texts) == expected(library, texts)


def test_one_merge_a_round_gives_the_same(library):
    encoder = bpe.Encoder(bpe._read(None))
    encoder.vocabulary.ordered = False
    texts = ["banana bandana", "aaaaaaa", "international characterisation"]
    assert split(encoder, texts) == expected(library, texts)


def test_query(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for i, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want[i] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    found = bpe.op13_bpe(spark, SMALL)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in found.schema] == ["doc_id bigint", "n_tokens bigint", "ids_sha256 string", "decoded_sha256 string"]
    assert {r[0]: tuple(r[1:]) for r in found.collect()} == want


def test_frames(spark, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (1, "again"), (1, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("x")).withColumn("__text", F.lit(1))
    encoded = bpe.encode(df)
    want = sorted(((i, e) for (i, _), e in zip(rows, expected(library, [t for _, t in rows]), strict=True)), key=repr)
    assert sorted(((r[0], list(r[1])) for r in encoded.collect()), key=repr) == want
    decoded = bpe.decode(encoded)
    assert sorted((tuple(r) for r in decoded.collect()), key=repr) == sorted(((i, library.decode(e, skip_special_tokens=False)) for i, e in want), key=repr)
    assert bpe.encode(df.limit(0)).count() == bpe.encode_and_decode(df.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, None), (2, [None, -1, 10**6, 3])], "doc_id long, ids array<int>")
    assert sorted(tuple(r) for r in bpe.decode(odd).collect()) == [(1, None), (2, "$")]


def test_bytes_that_are_no_text(spark, library):
    df = spark.sql("SELECT 1 AS doc_id, CAST(X'61FF62' AS STRING) AS text")
    assert list(bpe.encode(df).first()["ids"]) == library.encode("a�b", add_special_tokens=False).ids
