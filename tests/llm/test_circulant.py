"""Near copies by circulant MinHash against all pairs."""

import random

import numpy as np
import pytest

from carelattice.llm import circulant
from carelattice.llm.circulant import band_keys, permuted, signatures
from tests.llm import brute
from tests.llm.conftest import SCHEMA


def rows_of(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in circulant.near_copies(df).collect())


def wanted(rows):
    least = brute.near_components(rows, 2)
    return sorted((str(rows[i][0]), len(brute.shingles(rows[i][1], 2)), str(least[i]), rows[i][0] == least[i]) for i in least)


def variants(pick, n, words=80, changes=6):
    base = [f"w{i}" for i in range(words)]
    rows = []
    for i in range(n):
        text = list(base)
        for _ in range(pick.randint(0, changes)):
            text[pick.randrange(words)] = f"x{pick.randrange(9999)}"
        rows.append((i, " ".join(text[:pick.randint(1, words)] if pick.random() < 0.2 else text)))
    return rows


def test_components_equal_all_pairs(frame, documents):
    got = rows_of(frame)
    assert got == wanted(documents) and sum(not r[3] for r in got) > 5


@pytest.mark.parametrize("rounds", [3, 1])
def test_large_group_of_near_copies(spark, monkeypatch, rounds):
    monkeypatch.setattr(circulant, "ROUNDS", rounds)
    rows = variants(random.Random(rounds), 260) + [(1000 + i, t.upper()) for i, t in variants(random.Random(9), 40)]
    assert rows_of(spark.createDataFrame(rows, SCHEMA).repartition(3)) == wanted(rows)


def test_short_null_and_repeated(spark):
    rows = [(3, "One"), (2, "one "), (4, "two"), (5, None), (5, None), (6, " "), (None, "a b c d"), (9, "a b c d"), (None, "only null ids"), (None, "only null ids")]
    assert rows_of(spark.createDataFrame(rows, SCHEMA)) == sorted([
        ("3", 1, "2", False), ("2", 1, "2", True), ("4", 1, "4", True), ("5", 0, "5", True), ("5", 0, "5", True), ("6", 0, "6", True),
        ("None", 3, "9", False), ("9", 3, "9", True), ("None", 2, "None", True), ("None", 2, "None", True)])


def test_permutations_have_no_collision():
    x = np.arange(1 << 20, dtype=np.uint32)
    assert len(np.unique(permuted(x, 0x85EBCA6B, 0xC2B2AE35))) == len(x) == len(np.unique(permuted(x, 0x7FEB352D, 0x846CA68B)))


def test_signature_is_the_circulant_minimum():
    pick = np.random.default_rng(1)
    sets = [pick.integers(0, 2**63, k).astype(np.uint64) for k in (3, 0, 50, 7)]
    border = np.cumsum([0, *map(len, sets)])
    got = signatures(np.concatenate(sets), border, 5)
    for i, s in enumerate(sets):
        place = permuted((s >> np.uint64(32)).astype(np.uint32), 0x85EBCA6B, 0xC2B2AE35)
        for k in range(5):
            assert got[i, k] == (min(permuted(place + np.uint32(k), 0x7FEB352D, 0x846CA68B)) if len(s) else 2**32 - 1)


def test_agreement_estimates_similarity():
    pick = np.random.default_rng(3)
    both, one, two = (pick.integers(0, 2**63, k).astype(np.uint64) for k in (800, 100, 100))
    border = np.array([0, 900, 1800])
    sign = signatures(np.concatenate([both, one, both, two]), border, 240)
    assert abs((sign[0] == sign[1]).mean() - 0.8) < 0.1
    assert (band_keys(sign, 40, 6)[0] == band_keys(sign, 40, 6)[1]).sum() >= 3


def test_empty_and_clashing(empty, clashing):
    assert circulant.near_copies(empty).count() == 0
    assert rows_of(clashing) == [("1", 8, "1", True)]
