import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from envstats.llm import bpe

from .conftest import LONG

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def tokens():
    return bpe.load_ranks(PATH)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def test_ids_equal_the_library(tokens, reference):
    rnd = random.Random(1)
    texts = ["", " ", "a" * 3000, "é" * 70, "你好" * 90, "x y \x1c z", "'s 've ²½٣", " " * 90 + "\n\n",
             LONG, "".join(chr(rnd.randrange(32, 0x3000)) for _ in range(2000)), "<|endoftext|>"]
    texts += ["".join(rnd.choice("abcdef the in'é1 ") for _ in range(rnd.randrange(200)))
              for _ in range(200)]
    enc = bpe.Encoder(tokens, public_tokenizers.PATTERN)
    for t, ids in zip(texts, enc.encode_batch(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(t)
        assert enc.decode(ids) == t.encode()


def test_long_and_short_trees_agree(tokens):
    enc = bpe.Encoder(tokens, public_tokenizers.PATTERN)
    words = [w.encode() for w in "tokenization internationalization thththth eeeeeeee".split()]
    for w, ids in zip(words, enc._merge_short(words, 32)):
        assert np.frombuffer(ids, "<u4").tolist() == enc._merge_long(w)


def test_missing_byte_is_an_error(tokens):
    with pytest.raises(ValueError):
        bpe.Encoder([t for t in tokens if t != b"a"], public_tokenizers.PATTERN)


def test_odd_rows(odd, empty, tokens, reference):
    out = bpe.digests(bpe.encode(odd, tokens, public_tokenizers.PATTERN)).collect()
    assert len(out) == odd.count()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].n_tokens == by[2][0].n_tokens == 0
    assert by[5][0] == by[5][1] and by[5][0].ids_sha256 == by[6][0].ids_sha256
    assert 2**62 + 1 in by and len(by[None]) == 2
    assert by[4][0].n_tokens == len(reference.encode_ordinary(LONG))
    assert bpe.digests(bpe.encode(empty, tokens, public_tokenizers.PATTERN)).count() == 0
