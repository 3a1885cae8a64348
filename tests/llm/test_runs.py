"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from carelattice.llm import queries, runs
from tests.llm import brute
from tests.llm.conftest import SCHEMA, SF


def all_runs(word, length=24, exponent=3):
    """Every maximal stretch for every period, by the smallest period of each stretch."""
    found = {}
    for q in range(1, len(word) // exponent + 1):
        i = 0
        while i + q < len(word):
            start = i
            while i + q < len(word) and word[i] == word[i + q]:
                i += 1
            if i - start + q >= max(length, exponent * q):
                found.setdefault((start, i - start + q), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(word, found):
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(word) if k not in gone)


@pytest.mark.parametrize("length,exponent", [(24, 3), (9, 3), (6, 2), (2, 2)])
def test_runs_of_random_words(length, exponent):
    pick = random.Random(length)
    for _ in range(400):
        n, letters, p = pick.randint(0, 90), pick.randint(1, 3), pick.randint(1, 30)
        word = [pick.randrange(letters) for _ in range(n)]
        if pick.random() < 0.6:
            at = pick.randrange(n + 1)
            word = [word[i] if i < at else word[at + (i - at) % p] for i in range(n)]
            for _ in range(pick.randint(0, 2) * (n > 0)):
                word[pick.randrange(n)] = pick.randrange(letters)
        assert runs.find_runs(np.array(word, np.uint64), length, exponent) == all_runs(word, length, exponent)


def test_smallest_common_prefix():
    assert runs.least_lcp(24, 3) == 16 and runs.least_lcp(2, 2) == 1


def test_positions_keep_order():
    pick = random.Random(2)
    numbers = pick.sample(range(20_000), 900)
    held, plain = runs.Positions(numbers[0]), [numbers[0]]
    for x in numbers[1:]:
        before, after = max((y for y in plain if y < x), default=-1), min((y for y in plain if y > x), default=-1)
        assert held.add(x) == (before, after)
        plain.append(x)
    assert list(held) == sorted(numbers) and held.size == 900


EXTRA = [(9100, "a b c " * 400), (9101, "x " * 50_000), (9102, "p q " * 11 + "p"), (9103, "p q " * 12), (9104, ("one two three four " * 9 + "five ") * 5),
         (9105, "u v " * 20 + "w " * 30 + "u v w " * 12), (9106, " \t".join(["ab"] * 24)), (9107, "ab " * 23)]


def test_detected_runs_and_text(frame, documents, spark):
    rows = documents + EXTRA
    got = runs.detect(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    want = []
    for i, text in rows:
        word = brute.words(text)
        found = all_runs(word) if len(word) < 3000 or len(set(word)) < 4 and len(word) < 60_000 and i != 9101 else None
        found = [(0, 50_000, 1)] if i == 9101 else found
        if found is None:  # too long for brute force: words of 9006 never repeat within 3,000
            found = runs.find_runs(np.array([zlib.crc32(w.encode()) for w in word], np.uint64))
        want.append((str(i), len(word), [list(map(int, r)) for r in found], collapsed(word, found)))
    have = [(str(r.doc_id), r.n_words, [[x.start, x.length, x.period] for x in r.runs], bytes(r.collapsed).decode()) for r in got]
    assert sorted(have) == sorted(want) and sum(bool(w[2]) for w in want) > 5


def changed(doc_id, text):
    word = brute.words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and word:
        g, n = h // 10, len(word)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        word = [word[i] if i < a else word[a + (i - a) % p] for i in range(n)]
    return word


def test_query_equals_its_contract(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: r for r in queries.op11_lcp_kruskal_runs(spark, SF).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        word = changed(i, text)
        if len(word) > 4000:
            continue
        found = all_runs(word)
        top = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        r = got[i]
        assert r.n_runs == len(found)
        assert (r.start, r.length, r.period) == (top or (None,) * 3)
        assert r.exponent_milli == (1000 * top[1] // top[2] if top else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(word, found).encode()).hexdigest()
    assert sum(r.n_runs > 0 for r in got.values()) > 10


def test_planted_texts(frame, documents):
    got = sorted((str(r.doc_id), brute.words(r.text)) for r in queries.planted(frame).collect())
    assert got == sorted((str(i), changed(i, t)) for i, t in documents)


def test_empty_and_clashing(empty, clashing, spark):
    assert runs.detect(empty).count() == 0
    row = runs.detect(clashing).first()
    assert row.n_words == 9 and row.runs == [] and bytes(row.collapsed).startswith(b"a clashing")
    blank = runs.detect(spark.createDataFrame([(1, None), (1, None), (None, " ")], SCHEMA)).collect()
    assert [(r.n_words, r.runs, bytes(r.collapsed)) for r in blank] == [(0, [], b"")] * 3
