"""Very long words and texts against plain versions."""

import random

import numpy as np
import pytest


@pytest.fixture(scope="module")
def bpe():
    import public_tokenizers as P
    import tiktoken

    from tidelog.llm.byte_bpe import Codec
    codec = Codec(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    return codec, tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


@pytest.mark.parametrize("long, block, threes", [(2, 3, 3), (3, 5, 4), (16, 16, 9)])
def test_blocks_and_steps_equal_tiktoken(bpe, monkeypatch, long, block, threes):
    from tidelog.llm import byte_bpe
    codec, plain = bpe
    for name, value in (("LONG", long), ("BLOCK", block), ("BLOCK_OF_THREES", threes)):
        monkeypatch.setattr(byte_bpe, name, value)
    r = random.Random(long)
    words = ["the", "tion", "a", "aa", "哈", "哈哈", "é", "=-", "ab", "😀", "---", "===", "00"]
    pieces = [("".join(r.choices(words, k=r.randrange(1, 5))) * r.randrange(1, 60))[:r.randrange(1, 200)].encode()
              for _ in range(40)]
    want = [plain._core_bpe.encode_single_piece(b) for b in pieces]
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in codec._blockwise(pieces)] == want
    assert [codec._stepwise(b) for b in pieces] == want


def test_long_words_equal_tiktoken(bpe):
    codec, plain = bpe
    r = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = ["".join(r.choices(letters, k=50_000)),
             "".join(chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(60_000)),
             " ".join("".join(r.choices(letters, k=150)) for _ in range(13_000)),
             "哈" * 5001, "abc" * 5000 + "ab", "=+-" * 3000, "-" * 5000]
    for t, (ids, raw) in zip(texts, codec.encode_decode(texts), strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == plain.encode(t, disallowed_special=())
        assert raw == t.encode()
    codec.encode([""])
    assert all(len(w) <= 64 for w in codec.words)    # long ones are forgotten


def _plain_counts(text):
    """Letter n-grams of one to three letters by their definition."""
    import re

    from tidelog.llm.language_id import DIMS, _mix
    s = "".join(c if c.isalpha() else " " for c in text.lower())
    s = [ord(c) for c in " " + re.sub(" +", " ", s).removeprefix(" ") + " "]
    mix = lambda h: int(_mix(np.array([h % 2 ** 64], dtype=np.uint64))[0])
    n = np.zeros(DIMS)
    pair = lambda a, b: a * 0x1F3D5B79 + b
    for i, c in enumerate(s):
        if 0 < i < len(s) - 1:
            n[mix(c)] += 1
        if i > 0:
            n[mix(pair(s[i - 1], c))] += 1
        if i > 1:
            n[mix(pair(s[i - 2], s[i - 1]) * 0x2545F491 + c)] += 1
    return n


@pytest.mark.parametrize("size", [1, 2, 7, 100_000])
def test_features_by_slices_equal_their_definition(monkeypatch, size):
    from tidelog.llm import language_id
    monkeypatch.setattr(language_id, "SLICE", size)
    r = random.Random(size)
    for _ in range(200):
        t = "".join(r.choices("aBcé哈 .-1Σß\n", k=r.randrange(0, 40)))
        got = language_id.features(t)
        if not any(c.isalpha() for c in t):
            assert got is None
            continue
        x = np.log1p(_plain_counts(t)).astype(np.float32)
        assert np.allclose(got, x / np.linalg.norm(x))
