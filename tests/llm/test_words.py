"""Shingles hashed in the bytes of many texts at once, against words split one by one."""

from __future__ import annotations

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from tripweave.llm import common


def plain(text, size):
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


def odd_texts():
    rng = random.Random(3)
    alphabet = "aAbZéİ中\U0001f600\x00\x1c  " + " \t\n\r\x0b\x0c" * 2
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += [None, "", " ", "a", "ab", "ab\x00", "ab\x00\x00", "\x00", "x" * 63, "x" * 64, "x" * 65, "x" * 66, "X" * 65]
    texts += ["y" * n for n in range(1, 30)] + [" ".join("z" * n for n in range(1, 90))]
    return texts


@pytest.mark.parametrize("at_once", [1, 50, 1 << 21])
@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_same_words_have_the_same_hash_and_others_another(at_once, kind, monkeypatch):
    monkeypatch.setattr(common, "BYTES_AT_ONCE", at_once)
    texts = odd_texts()
    for array, want in ((pa.array(texts, kind), texts), (pa.array(texts, kind)[7:-5], texts[7:-5]), (pa.array([], kind), [])):
        got = list(common.text_shingles(array, 3))
        assert [len(g) for g in got] == [len(plain(t, 3)) for t in want]
        known = {}
        for hashes, shingles in zip(got, (plain(t, 3) for t in want)):
            for h, s in zip(hashes.tolist(), shingles):
                assert known.setdefault(s, h) == h
        assert len(set(known.values())) == len(known)


def test_hashing_takes_no_object_for_each_word():
    """Of words that seldom repeat, the way by single words takes several times as long."""
    rng = np.random.default_rng(1)
    texts = pa.array([" ".join(f"w{n}" for n in rng.integers(0, 10**6, 400)) for _ in range(1000)])

    def seconds(call):
        begun = time.process_time()
        call()
        return time.process_time() - begun

    fast = min(seconds(lambda: list(common.text_shingles(texts, 5))) for _ in range(3))
    assert 2 * fast < seconds(lambda: list(common.shingled(texts, 5, common.WordHashes())))
