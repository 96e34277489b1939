import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wattloom.llm import kernels as K
from wattloom.llm.tokens import Encoder


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab C\n\té\u00a0\x00Z9-", max_size=12)), max_size=8))
def test_words_are_those_of_each_text(texts):
    column = pa.array(texts, pa.string())
    for table, lower, split in ((K.NOT_SPACE, False, lambda t: t.encode().split()), (K.NOT_SPACE, True, lambda t: t.encode().lower().split())):
        got = []
        for i, j, buf, offs in K.text_blocks(column, max_bytes=7):
            w = K.Words(buf, offs, table, lower)
            got += [[buf_word for buf_word in w.text(a, b).split(b" ") if buf_word] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
        assert got == [split(t or "") for t in texts]


def test_equal_words_have_equal_hashes_wherever_they_stand():
    column = pa.array(["x alpha y", "alpha", None, "beta alpha"])
    _, _, buf, offs = next(K.text_blocks(column))
    w = K.Words(buf, offs)
    assert w.hash[1] == w.hash[3] == w.hash[5]
    assert len(set(w.hash.tolist())) == 4


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=40), st.integers(1, 9))
def test_window_minima(values, w):
    h = np.array(values, dtype=np.uint64) + np.uint64(1)
    n = max(0, len(h) - w + 1)
    valid = np.arange(n) % 3 != 1
    want = {i for j in range(n) if valid[j] for i in range(j, j + w) if h[i] == h[j : j + w].min()}
    assert set(K.window_minima(h, w, valid).tolist()) == want


def test_lookup():
    keys = np.array([5, 9, 2**63 + 1], dtype=np.uint64)
    at, i = K.Lookup(keys).find(np.array([9, 1, 2**63 + 1, 5], dtype=np.uint64))
    assert at.tolist() == [0, 2, 3] and i.tolist() == [1, 2, 0]
    assert len(K.Lookup(np.zeros(0, np.uint64)).find(keys)[0]) == 0


HARD = ["", " ", "\n\n", "a\n\nB", "a \n b", " a", "a  b", "don't 's 've 'S", "x's.y", "a'b ' c", "(word) [x] {y}", "é, ́x", "Σας ΣΑΣ. ΣΑΣ", "é.à è,É", "a\tb\r\nc", "1234 5,6", "...!!??", "a\x1cb", "中文 字,符", "foo<|endoftext|>bar", "a.\nB", "a.\n\nB", "a\n", "ß×÷ x", "trail  ", "x,́y", "''a", ".'s", "İstanbul İ.", "ﬁ ﬂ ½ ²", "a b"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cached_ids_are_the_library_s(name):
    encoder = Encoder.of(public_tokenizers.path(name))
    random.seed(3)
    alphabet = list("aé ZÉ.,'\n\t 1ß(") + ["  ", "\u00a0", "\u2003", "́", "中", "'s", "<|endoftext|>"]
    texts = HARD + ["".join(random.choices(alphabet, k=random.randrange(25))) for _ in range(1500)]
    want = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # the second time from the cache
        got = []
        for _, _, ids, counts in encoder.column(pa.array([*texts, None])):
            ends = np.cumsum(counts)
            got += [ids[e - n : e].tolist() for e, n in zip(ends, counts, strict=True)]
        assert got == [*want, []]
