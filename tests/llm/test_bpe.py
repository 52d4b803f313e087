import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from firmlens.llm import bpe as B

from .brute import edge_docs

PATH = B.tokenizer_path()
LIBRARY = Tokenizer.from_file(PATH)
PIECES = ["ab", "the", "é", "日本", "123", "  ", "\n", "'s", "!", "<|endoftext|>", "\t", "!!'", " ", "x" * 30, "　", "ß", "🙂", "'ll", "‍"]


def test_pattern():
    assert B.PATTERN == public_tokenizers.PATTERN


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=40).map("".join) | st.text(max_size=60), st.sampled_from([10, 4096]))
def test_equals_the_library(text, long):
    kept, B.LONG = B.LONG, long
    try:
        got = B.codec(PATH).encode(text)
    finally:
        B.LONG = kept
    assert got == LIBRARY.encode(text, add_special_tokens=False).ids
    assert B.codec(PATH).decode(got) == LIBRARY.decode(got, skip_special_tokens=False)


@pytest.mark.parametrize("letters", ["abcdefghij", "thereionestin", "aab", "日本語文字化", "1234567890", "é!#$%"])
def test_tree_equals_one_piece(letters):
    r, c = random.Random(letters), B.codec(PATH)
    for _ in range(60):
        data = "".join(r.choice(letters) for _ in range(r.randint(1, 2000))).encode()
        assert c.encode_unsplit(data, r.choice([3, 8, 64])) == c._piece(data)


def test_decoding_any_ids():
    r = random.Random(1)
    for _ in range(200):
        ids = [r.randrange(50257) for _ in range(60)]
        assert B.codec(PATH).decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)
    assert B.codec(PATH).decode([10**6]) == ""


def test_edges_and_long_unsplit_text(spark):
    r = random.Random(2)
    long = "".join(r.choice("abcdefghijkl") for _ in range(60_000))
    docs = edge_docs(spark).unionByName(edge_docs(spark, [(50, f"x {long} y {' ' * 9000}z", "en"), (51, "a<|endoftext|>b", "en")]))
    ids = B.encode_texts(docs, PATH)
    assert ids.count() == docs.count()
    back = B.decode_ids(ids, PATH).select("doc.doc.text", "doc.n_tokens", "doc.ids", "decoded").collect()
    for row in back:
        want = LIBRARY.encode(row.text or "", add_special_tokens=False).ids
        assert np.frombuffer(row.ids, dtype="<u4").tolist() == want and row.n_tokens == len(want) and row.decoded == (row.text or "")
    assert B.encode_texts(docs.limit(0), PATH).count() == 0


def test_every_piece_longer_than_a_leaf_is_a_tree(monkeypatch):
    c, seen = B.codec(B.tokenizer_path()), []
    whole = B.Codec.encode_unsplit
    monkeypatch.setattr(B.Codec, "encode_unsplit", lambda self, data: seen.append(len(data)) or whole(self, data))
    for piece in ("a" * 1025, "\U0001f642" * 257, "1" * 4095, "\n" * 1026, "!" * 2000):
        seen.clear()
        text = f"some words {piece} and more"
        assert c.encode(text) == c.bpe.encode_ordinary(text)
        assert len(seen) == 1 and seen[0] > B.LEAF, (piece[:3], seen)
    seen.clear()
    c.encode("some words " + "a" * 1000 + " and more")
    assert not seen


def test_cheap_test_misses_no_long_run():
    """``_may_run`` may say yes for nothing, but never no where the pattern of long runs fits."""
    import random

    from firmlens.llm import bpe

    r, n = random.Random(2), bpe.LONG
    parts = ["x", "é", "日", "!", " ", "\t", "\n", "\x1c", "\x1f", "\x85", "\xa0", " ", "x" * n, " " * n, "!" * (n - 1), "\x1c!" * n, " \n" * (n // 2)]
    hits = 0
    for _ in range(3000):
        text = "".join(r.choice(parts) * r.randint(1, 3) for _ in range(r.randint(0, 30)))
        found = bpe._long_run(n).search(text) is not None
        hits += found
        assert bpe._may_run(text) or not found
    assert 100 < hits < 2900
    assert not bpe._may_run("plain words of a text. " * 100)


def test_text_is_split_without_looking_ahead(monkeypatch):
    """The library's split with the whole pattern, which looks ahead, isn't used; runs of white space are cut as it cuts them."""
    c, r = B.Codec(PATH), random.Random(4)
    white = [chr(k) for k in range(0x3001) if chr(k).isspace()] + ["​", "﻿", "᠎"]
    parts = ["a", "the", "é", "日", "1", "!", "'s", "'", " ", " ", "  ", "\r\n", *white]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(5000)] + [f"a{x * 3}b {x} {x}c{x}" for x in white]
    monkeypatch.setattr(c, "bpe", None)
    for text in texts:
        assert c.encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids, repr(text)
