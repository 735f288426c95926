"""Byte-level BPE against the tokenizer library, and round trips."""

import hashlib

import numpy as np
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from spanroute.llm import byte_bpe as B
from spanroute.llm.queries import op1_byte_bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = B.load_ranks(PATH)
REAL = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER, DECODER = B.Encoder(RANKS, PATTERN), B.Decoder(RANKS)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(), st.text("aehilnorst é日👍'", max_size=80), st.text(" \n\tx", max_size=30)))
def test_encoding_and_round_trip(text):
    got = np.frombuffer(ENCODER.encode(text), "<u4")
    assert got.tolist() == REAL.encode_ordinary(text)
    assert DECODER.decode(got) == text.encode()


def test_long_texts_and_slices(monkeypatch):
    text = "lorem ipsum  'll dolor\n\n sit   amet, " * 200
    want = REAL.encode_ordinary(text)
    monkeypatch.setattr(B, "SLICE", 50), monkeypatch.setattr(B, "PIECES", 10), monkeypatch.setattr(B, "MOVES", 10), monkeypatch.setattr(B, "PAIRS", 10)
    assert np.frombuffer(B.Encoder(RANKS, PATTERN).encode(text), "<u4").tolist() == want
    assert len(ENCODER.encode("ab" * 200_000)) > 0


def test_tokens_come_after_bounded_lookahead():
    """Reading on, the transducer never holds back more bytes than a few of the longest tokens."""
    machine, read, out = B.Transducer(RANKS), 0, 0

    def counted():
        nonlocal read
        for b in b"interoperability" * 400 + b"a" * 3_000:
            read += 1
            yield b

    for token in machine.stream(counted()):
        out += len(machine.bytes_of[token])
        assert read - out <= 6 * machine.longest
    assert out == read


@given(st.lists(st.integers(0, 50_255), max_size=60))
def test_streaming_decode(ids):
    """Any ids: the bytes are whole at the end, and no part ends within a code point that is whole."""
    parts = list(DECODER.stream(iter(ids)))
    data = b"".join(DECODER.bytes_of[i] for i in ids)
    assert b"".join(parts) == data
    try:
        data.decode()
    except UnicodeDecodeError:
        return
    for p in parts:
        p.decode()


def test_query(spark, sf_small):
    rows = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for r in rows:
        ids = REAL.encode_ordinary(r.text)
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()))
    assert sorted(map(tuple, op1_byte_bpe(spark, sf_small).collect())) == sorted(want)


def test_nulls_names_and_empty(spark):
    docs = spark.createDataFrame([(1, None, b"x"), (1, "", b"x"), (None, "hello", None)], "doc_id long, text string, ids binary")
    got = B.decode(B.encode(docs, PATH, PATTERN), PATH).select("doc_id", F.length("ids"), F.decode("decoded", "UTF-8")).collect()
    assert sorted(map(tuple, got), key=str) == [(1, 0, ""), (1, 0, ""), (None, 4 * len(REAL.encode("hello")), "hello")]
    assert B.encode(docs.limit(0), PATH, PATTERN).count() == 0


def test_every_code_point():
    """All characters, in runs and between letters, are cut as the library cuts them."""
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(every), 4096):
        text = "".join(every[at : at + 4096])
        assert "".join(ENCODER.pieces(text)) == text
    for at in range(0, len(every), 256):
        text = "a".join(every[at : at + 256])
        assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == REAL.encode_ordinary(text)
