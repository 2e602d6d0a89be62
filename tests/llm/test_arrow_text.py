import numpy as np
import pytest

from listenlab.llm import arrow_text as A
from listenlab.llm import bpe_words

from .cases import _MIRROR, _PARITY


def hashes(words, seed=0):
    raw = [w.encode() for w in words]
    buf = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(w) for w in raw])
    return A.span_hashes(buf, ends - [len(w) for w in raw], ends, seed)


def test_equal_spans_alone_share_a_hash():
    words = ["", "a", "a\0", "\0", "\0\0", "ab", "ba", _PARITY, _MIRROR, _PARITY[:16], _MIRROR[:16], _PARITY[:32], _MIRROR[:32]]
    words += ["x" * n for n in range(2, 80)] + ["é" * n for n in range(1, 40)] + [f"word{i}" for i in range(2000)]
    for seed in (0, 1):
        got = hashes(words + words, seed)
        assert (got[:len(words)] == got[len(words):]).all() and len(set(got.tolist())) == len(words)
        shifted = hashes(["pad", *words], seed)  # wherever they stand
        assert (shifted[1:] == got[:len(words)]).all()
    assert not (hashes(words) == hashes(words, 1)).any()


def test_words_of_one_hash_keep_their_own_ids(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    monkeypatch.setattr(bpe_words, "span_hashes", lambda b, s, e, seed=0: A.span_hashes(b, s, e, 1) if seed else (e - s).astype(np.uint64))
    text = "words of equal length share hash here, even these ones. " * 3
    buf = np.frombuffer(text.encode(), np.uint8)
    ids, offs = bpe_words.WordIds(path).of_chunk(buf, np.array([0, len(buf)]))
    assert ids.tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [3, 20])
def test_grams_of_words_in_other_orders_differ(n):
    words = np.array([5, 9], np.uint64)[[i.bit_count() % 2 for i in range(256)]]
    got = A.gram_hashes(words, n)
    grams = {tuple(words[i:i + n].tolist()) for i in range(256 - n + 1)}
    assert len(set(got.tolist())) == len(grams)
