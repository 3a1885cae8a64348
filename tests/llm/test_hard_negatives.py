"""Hard negatives against all pairs, and against DuckDB's SQL."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from carelattice.llm import hard_negatives, queries
from tests.llm.conftest import SF

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def anchor():
    return F.col("vec_id") % 100 == 0


def plain(rows, k=5, far=10):
    used = []
    for i, v, label in rows:
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v):
            used.append((i, [math.floor(256 * x) for x in v], label))
    out = []
    anchors = {}
    for i, v, label in used:
        if i % 100 == 0:
            anchors[i] = min(anchors.get(i, (label, v)), (label, v))
    for a, (own, q) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, label) for i, v, label in used if i != a)
        for s, p, _ in [x for x in scored if x[2] == own][:k]:
            fits = [x for x in scored if x[2] != own and 30 * -s <= 100 * -x[0] <= 90 * -s][:far]
            out += [(a, p, r + 1, x[1], -s, -x[0]) for r, x in enumerate(fits)]
    return sorted(out)


def mined(df, **options):
    return sorted(tuple(r) for r in hard_negatives.mine(df, anchor(), **options).collect())


def float32(x):
    return float(np.float32(x))


def cloud(pick, n, dim, spread, labels=10):
    centre = [[pick.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = pick.choice(centre)
        size = pick.choice([0.1, 1, 3])
        rows.append((i, [float32(size * (x + pick.gauss(0, spread))) for x in c], pick.randrange(labels)))
    return rows


@pytest.mark.parametrize("spread,head,piece", [(0.1, 100, 70), (1.0, 300, 10_000), (0.3, 10_000, 500), (0.05, 30, 30)])
def test_equal_to_all_pairs(spark, monkeypatch, spread, head, piece):
    monkeypatch.setattr(hard_negatives, "HEAD", head)
    monkeypatch.setattr(hard_negatives, "PIECE", piece)
    monkeypatch.setattr(hard_negatives, "BLOCK", 4)
    monkeypatch.setattr(hard_negatives, "SLAB", 16)
    rows = cloud(random.Random(head), 1500, 6, spread, 4)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = plain(rows)
    assert mined(df, clusters=3) == want and len(want) > 100


def test_lists_are_left_early(spark, monkeypatch):
    """In clear clusters, what comes after the head is mostly never made."""
    monkeypatch.setattr(hard_negatives, "HEAD", 200)
    made = []
    whole = hard_negatives.Lists.stretch

    def seen(self, low, high):
        at = np.arange(hard_negatives.BINS)
        made.append(int((self.count * ((at >= low[:, None]) & (at < high[:, None]))).sum()))
        return whole(self, low, high)

    monkeypatch.setattr(hard_negatives.Lists, "stretch", seen)
    rows = cloud(random.Random(5), 3000, 12, 0.05, 3)
    assert mined(spark.createDataFrame(rows, SCHEMA).repartition(2), clusters=6) == plain(rows)
    assert made[1] < 6 * 3000 / 2


def edges():
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (100, [0.0, 0.0], 1), (200, [-1.0, 0.25], 2), (300, [1.0, 2.0, 3.0], 1), (400, [], 3),
            (None, [1.0, 1.0], 1), (1, None, 1), (2, [1.0, None], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 2), (5, [1.0, 1.0], None), (500, [1.0, 1.0], 9)]
    rows += [(10 + k, [0.5 * (k % 3), 0.25 * (k % 5)], k % 3) for k in range(60)] + [(11, [0.5, 0.25], 1)] * 20
    return rows


def test_edges(spark):
    rows = edges()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("cluster", F.lit("x")).withColumn("V", F.lit(1)).withColumn("low", F.lit(1))
    want = plain(rows)
    assert mined(df) == want and want


def test_equal_vectors_and_no_rows(spark):
    rows = [(i, [0.5, 0.5], i % 2) for i in range(300)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == plain(rows) == []  # all scores are equal: no one lies below 90 %
    assert hard_negatives.mine(spark.createDataFrame([], SCHEMA), anchor()).count() == 0
    assert hard_negatives.mine(spark.createDataFrame([(7, [1.0], 1)], SCHEMA), anchor()).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**19 + i % 7), float(i % 11) * 2**15], i % 3) for i in range(220)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == plain(rows)


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{SF}/embeddings.parquet')")
    got = queries.op12_maximus_negatives(spark, SF)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = sorted(con.execute(hard_negatives.ORACLE).fetchall())
    assert sorted(tuple(r) for r in got.collect()) == want and want
