"""N-gram Jaccard join, components and substring dedup against brute force."""

import hashlib
import random

import pytest

from carelattice.llm import jaccard, substrings
from carelattice.llm.components import components
from tests.llm import brute
from tests.llm.conftest import SCHEMA


def component_rows(df):
    return sorted(((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.jaccard_components(df).collect()))


def wanted(rows):
    least = brute.near_components(rows)
    return sorted((str(rows[i][0]), len(brute.shingles(rows[i][1])), str(least[i])) for i in least)


def near_copies(pick, n):
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        words = list(base)
        for _ in range(pick.randint(0, 3)):
            words[pick.randrange(60)] = f"x{pick.randrange(9999)}"
        rows.append((i, " ".join(words[:pick.randint(2, 60)] if pick.random() < 0.3 else words)))
    return rows


def test_components_equal_brute_force(frame, documents):
    assert component_rows(frame) == wanted(documents)


@pytest.mark.parametrize("heavy", [64, 6])
def test_large_group_of_near_copies(spark, monkeypatch, heavy):
    monkeypatch.setattr(jaccard, "HEAVY", heavy)
    rows = near_copies(random.Random(heavy), 250)
    assert component_rows(spark.createDataFrame(rows, SCHEMA).repartition(3)) == wanted(rows)


@pytest.mark.parametrize("light", [2, 64])
def test_groups_that_share_a_passage(spark, monkeypatch, light):
    """Buckets of many components: listed at once, or by the rounds of the classes of large buckets."""
    monkeypatch.setattr(jaccard, "LIGHT", light)
    pick = random.Random(light)
    shared, rows = [f"s{i}" for i in range(40)], []
    for group in range(40):
        own = [f"g{group}w{i}" for i in range(pick.randint(4, 30))]
        for _ in range(pick.randint(1, 4)):
            words = [*own[:len(own) - pick.randint(0, 2)], *shared]
            words[pick.randrange(len(words))] = f"x{pick.randrange(9999)}"
            rows.append((len(rows), " ".join(words)))
    assert component_rows(spark.createDataFrame(rows, SCHEMA).repartition(3)) == wanted(rows)


def test_keep_one(spark):
    rows = near_copies(random.Random(3), 80) + [(90, ""), (90, ""), (91, None), (None, "a b c d e f g"), (None, "a b c d e f g"), (5, "a b c d e f g")]
    kept = jaccard.keep_one(spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], SCHEMA + ", n int").repartition(2))
    least = brute.near_components(rows)
    assert kept.columns == ["doc_id", "text", "n"]
    got = sorted(str(r.doc_id) for r in kept.collect())
    assert got == sorted([str(x) for x in {least[i] for i in least if rows[i][1]}] + ["90", "90", "91"])


def test_empty_and_clashing(empty, clashing):
    assert jaccard.jaccard_components(empty).count() == 0
    assert component_rows(clashing) == [("1", 5, "1")]
    assert substrings.dedup(empty).count() == 0
    assert substrings.dedup(clashing).first().n_words == 9


def test_components_of_links(spark):
    pick = random.Random(8)
    links = [(pick.randrange(300), pick.randrange(300)) for _ in range(160)] + [(k, k + 1) for k in range(1000, 1060)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def removed(df, **options):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substrings.dedup(df, **options).collect())


def kept_words(rows, window=35):
    found = brute.repeated_words([t for _, t in rows], window)
    return sorted((str(i), n, n - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()) for (i, _), (n, kept) in zip(rows, found))


def test_repeated_windows_equal_brute_force(frame, documents):
    want = kept_words(documents)
    assert removed(frame) == want and sum(w[2] for w in want) > 1000


@pytest.mark.parametrize("hot", [2000, 10])
def test_hot_passage_is_split(spark, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT_ROWS", hot)
    pick = random.Random(hot)
    passage = " ".join(map(str, range(50)))
    text = lambda: " ".join(str(pick.random()) for _ in range(pick.randint(0, 40)))
    rows = [(i, " ".join(pick.choice("abc") for _ in range(pick.randint(0, 60))) + f" {passage} " * (i % 3 > 0) + text()) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert removed(df) == kept_words(rows)
    assert removed(df, window=10, m=3) == kept_words(rows, 10)


def test_text_of_kept_words(spark):
    row = substrings.dedup(spark.createDataFrame([(1, "a\tb  c")], SCHEMA), with_text=True).first()
    assert row.kept == "a b c" and row.n_removed == 0
