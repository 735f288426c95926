"""Token counts against the tokenizers library."""

import json

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from spanroute.llm import token_counts as T
from spanroute.llm.queries import op12_token_counts
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")
REAL = Tokenizer.from_file(PATH)
VOCABULARY = T.load_vocabulary(PATH)
COUNTER = T.Counter(VOCABULARY)


def real(text, tokenizer=REAL):
    return len(tokenizer.encode(text, add_special_tokens=False).ids)


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.text(), st.text("aehilnorst é日👍'", max_size=80), st.text(" \n\tx 　", max_size=30), st.text("<|endofx> a", max_size=40), st.text("=-_#*/\\ ", max_size=200)))
def test_counts(text):
    assert COUNTER.count(text) == real(text)


def test_special_strings_inside():
    for text in ("<|endoftext|>", "a<|endoftext|>b", " <|endoftext|> <|endoftext|><|endoftext|>", "<|endoftext|", "it<|endoftext|>'s"):
        assert COUNTER.count(text) == real(text)


def test_proofs():
    """A string of the vocabulary is taken for one token exactly where the library gives one."""
    for token in VOCABULARY.ranks:
        try:
            text = token.decode()
        except UnicodeDecodeError:
            continue
        if len(list(COUNTER.pieces(text))) == 1:
            assert (text in VOCABULARY.alone) == (real(text) == 1)


def test_only_listed_pairs_merge(tmp_path):
    """Merges that spell a token in another way, and tokens that other merges keep from forming."""
    letters = {b: c for c, b in T.byte_letters().items()}
    merges = [["a", "b"], ["b", "c"], ["c", "d"], ["a", "bc"], ["bc", "d"], ["ab", "cd"], ["cd", "a"], ["b", "cda"], ["d", "d"], ["dd", "dd"], ["x", "dd"]]
    vocab = {letters[b]: b for b in range(256)}
    for a, b in merges:
        vocab[a + b] = len(vocab)
    file = {"version": "1.0", "added_tokens": [], "normalizer": None, "post_processor": None, "decoder": None, "truncation": None, "padding": None,
            "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True},
            "model": {"type": "BPE", "vocab": vocab, "merges": merges, "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False}}
    (tmp_path / "own.json").write_text(json.dumps(file))
    own, known = Tokenizer.from_file(str(tmp_path / "own.json")), T.load_vocabulary(str(tmp_path / "own.json"))
    assert "abc" not in known.alone and "bcda" not in known.alone and "abcd" in known.alone
    counted = T.Counter(known)
    import itertools

    for n in range(1, 8):
        for word in map("".join, itertools.product("abcd", repeat=n)):
            assert counted.count(word) == real(word, own), word
    file["model"]["ignore_merges"] = True
    (tmp_path / "other.json").write_text(json.dumps(file))
    with pytest.raises(ValueError):
        T.load_vocabulary(str(tmp_path / "other.json"))
    file["model"]["ignore_merges"], file["model"]["merges"] = False, [*merges, ["ab", "c"]]
    (tmp_path / "twice.json").write_text(json.dumps(file))
    with pytest.raises(ValueError):
        T.load_vocabulary(str(tmp_path / "twice.json"))


def test_every_code_point():
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(every), 256):
        text = "a".join(every[at : at + 256])
        assert COUNTER.count(text) == real(text)


def test_long_texts_slices_and_bounds(monkeypatch):
    text = "lorem ipsum  'll dolor\n\n sit   amet, Straße ɮxqz " * 300
    want = real(text)
    monkeypatch.setattr(T, "REST", 3), monkeypatch.setattr(T, "SLICE", 50)
    monkeypatch.setattr("spanroute.llm.byte_bpe.SLICE", 50)
    own = T.Counter(VOCABULARY)
    assert own.count(text) == want and len(own) <= len(VOCABULARY.alone) + 3
    for long in ("ab" * 50_000, "a" * 100_000, "=" * 70_001, "a1" * 40_000, "日本" * 20_000):
        assert own.count(long) == real(long)
    assert len(own) <= len(VOCABULARY.alone) + 3


def test_query_nulls_and_names(spark, sf_small):
    rows = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r.doc_id, len(r.text.encode()), n := real(r.text), n > 1024) for r in rows)
    got = op12_token_counts(spark, sf_small)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, got.collect())) == want
    odd = spark.createDataFrame([(1, None, 5), (1, "", 5), (None, "héllo", 5), (2, "x " * 3, 5), (2, "x " * 3, 5)], "doc_id long, text string, N_BYTES int")
    got = T.count_tokens(odd, PATH, 3)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, 0, 0, False), (1, 0, 0, False), (None, 6, real("héllo"), False), (2, 6, 4, True), (2, 6, 4, True)], key=str)
    assert T.count_tokens(odd.limit(0), PATH, 3).count() == 0
