import random

import pyarrow as pa
import pytest

from carelattice.llm import words as w
from tests.llm import brute


@pytest.mark.parametrize("segment", [16, 50, 1 << 17])
def test_words_and_hashes(monkeypatch, segment):
    monkeypatch.setattr(w, "SEGMENT", segment)
    pick = random.Random(segment)
    texts = ["".join(pick.choice("aB c\n\té\x1f") for _ in range(pick.choice([0, 3, 20, 200]))) for _ in range(200)]
    texts += [None, "", " ", "x" * 300]
    found = w.words(pa.array(texts))
    at, hashes = 0, {}
    for text, n in zip(texts, found.count):
        want = brute.words(text)
        assert [found.text(at + k).decode() for k in range(n)] == want
        for k, word in enumerate(want):
            assert hashes.setdefault(word, found.hash[at + k]) == found.hash[at + k]
        at += n
    assert len(set(map(int, hashes.values()))) == len(hashes)


def test_grams_stay_in_their_document():
    found = w.words(pa.array(["a b c d", "b c", None, "a b c"]))
    hashed, at = w.grams(found, 3)
    assert [found.text(i) for i in at] == [b"a", b"b", b"a"] and hashed[0] == hashed[2] != hashed[1]
    skipped, at = w.grams(found, 2, skip=1)
    assert len(skipped) == 3 and skipped[0] == skipped[2]


def test_slices_of_a_column_and_large_strings():
    column = pa.array(["a b", "c", "d e f"])
    assert list(w.words(column.slice(1)).count) == [1, 3]
    assert list(w.words(column.cast(pa.large_string())).hash) == list(w.words(column).hash)


def test_lower_case_is_ascii_only():
    found = w.words(pa.array(["ABCZ Éé[@`{"]), lower=True)
    assert found.text(0) == b"abcz" and found.text(1).decode() == "Éé[@`{"
