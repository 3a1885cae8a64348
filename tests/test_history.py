"""Stored profiles, and documents in chunks."""

import datetime
import math
import statistics

import pytest
from pyspark.sql import functions as F

from carelattice.operators import documents, history, quality

DAY = datetime.date
ROWS = [("NY", i, 1e9 + (i * 37 % 101) / 8, None if i % 10 == 0 else "x" if i % 3 else "", float("nan") if i == 5 else None) for i in range(200)]
ROWS += [("MA", 1000 + i, 1e9 + i, "y", None) for i in range(3)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, "state string, n long, amount double, note string, odd double")


def test_parts_merge_to_the_profile_of_the_whole(table):
    whole = {r.column_name: r for r in history.merged(history.sketch(table)).collect()}
    parts = {r.column_name: r for r in history.merged(history.sketch(table, F.col("state"))).collect()}
    assert set(whole) == set(parts) == set(table.columns)
    amounts = sorted(r[2] for r in ROWS)
    for got in (whole, parts):
        n, amount, note, odd = (got[c] for c in ("n", "amount", "note", "odd"))
        assert (n.row_count, n.distinct_count, n.min_value, n.max_value) == (203, 203, "0", "1002")
        assert (note.null_count, note.empty_count, note.distinct_count) == (20, sum(r[3] == "" for r in ROWS), 3)
        assert math.isclose(amount.mean, statistics.fmean(amounts), rel_tol=1e-12)
        assert math.isclose(amount.std, statistics.stdev(amounts), rel_tol=1e-6)  # 1e9 apart from zero, spread of a few
        assert [amount.q25, amount.q50, amount.q75] == [amounts[math.ceil(q * 203) - 1] for q in (0.25, 0.5, 0.75)]
        assert (odd.mean, odd.std, odd.q50, note.mean) == (None, None, None, None)


def test_small_sketches_stay_within_their_error(spark):
    rows = spark.range(50_000).select((F.col("id") * 7919 % 50_000).alias("v"))
    (got,) = history.merged(history.sketch(rows, F.col("v") % 7, lg=12, k=200)).collect()
    assert abs(got.distinct_count - 50_000) < 0.05 * 50_000
    assert all(abs(got[f"q{q}"] / 500 - q) < 2.5 for q in (25, 50, 75))


def test_empty_table_has_columns_with_zero_counts(table):
    rows = history.merged(history.sketch(table.limit(0))).collect()
    assert len(rows) == 5 and all((r.row_count, r.null_count, r.distinct_count, r.mean) == (0, 0, 0, None) for r in rows)
    assert history.merged(history.sketch(table.limit(0), F.col("state"))).count() == 0


def test_a_replayed_day_replaces_itself(spark, table, tmp_path):
    path = str(tmp_path / "history")
    for day, n in ((1, 10), (2, 999), (2, 15), (4, 203)):
        history.store(history.sketch(table.orderBy("n").limit(n), F.col("state")), path, "t", DAY(2024, 1, day))
    history.store(history.sketch(table.limit(5)), path, "other", DAY(2024, 1, 4))
    rows = history.volume_history(history.read(spark, path, "t")).orderBy("day").collect()
    assert [(r.day.day, r.row_count, r.previous_rows) for r in rows] == [(1, 10, None), (2, 15, 10), (4, 203, 15)]
    assert rows[0].change is None and rows[1].change == 0.5
    days = history.merged(history.read(spark, path, "t", DAY(2024, 1, 2)), ["day"]).filter("column_name = 'n'").collect()
    assert {(r.day.day, r.row_count) for r in days} == {(2, 15), (4, 203)}
    plan = history.read(spark, path, "t", DAY(2024, 1, 2))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(table_name" in plan


def test_newest_value_and_distinct_counts(table):
    stored = history.sketch(table).withColumns({"table_name": F.lit("t"), "day": F.lit(DAY(2024, 1, 1))})
    assert history.newest(stored, "n").first().newest == "1002"
    assert {r.column_name: r.distinct_count for r in history.distinct_counts(table).collect()} == {
        "state": 2, "n": 203, "amount": len({r[2] for r in ROWS}), "note": 3, "odd": 1}


def test_volume_without_an_earlier_day_checks_the_bounds_only(table):
    passed = lambda previous: quality.volume(table, "t", previous).first().passed
    assert passed(None) and passed(F.lit(None).cast("long")) and passed(200) and passed(F.lit(200)) and not passed(F.lit(100))


def joined(chunks):
    out = {}
    for r in sorted(chunks.collect(), key=lambda r: (r.doc_id, r.chunk)):
        out[r.doc_id] = out.get(r.doc_id, "") + r.text
    return out


BLOCKS = "doc_id long, page_number long, line_number long, text string, x0 double, y0 double, x1 double, y1 double"


@pytest.fixture(scope="module")
def small(spark):
    rows = [(d, p, n, f"line {d}.{p}.{n}" * (1 + n % 3), 0.0, 0.0, 1.0, 1.0) for d in (1, 2, 3) for p in (1, 2, 5) for n in range(d * 2)]
    return spark.createDataFrame([*rows, (4, 1, 1, "", 0.0, 0.0, 1.0, 1.0)], BLOCKS)


@pytest.mark.parametrize("limit", [1, 30, 100_000])
def test_chunks_make_up_the_context(small, limit):
    whole = {r.doc_id: r.context for r in documents.document_context(documents.pages_from_blocks(small), "doc_id").collect()}
    chunks = documents.context_chunks(small, limit=limit)
    assert joined(chunks) == whole
    if limit == 100_000:
        assert chunks.count() == 4
    longest = chunks.select(F.max(F.length("text")).alias("n")).first().n
    assert longest < limit + 60


def test_chunks_when_every_document_is_hot(small, every_key_hot):
    whole = {r.doc_id: r.context for r in documents.document_context(documents.pages_from_blocks(small), "doc_id").collect()}
    assert joined(documents.context_chunks(small, limit=40)) == whole


def test_a_document_of_a_million_blocks(spark):
    spark.conf.set("carelattice.hot.rows", "100000")
    try:
        blocks = spark.range(1_000_000).select(
            F.lit(7).alias("doc_id"), F.floor(F.col("id") / 1000).alias("page_number"), F.col("id").alias("line_number"), F.lit("0123456789").alias("text"))
        sizes = documents.context_chunks(blocks, limit=100_000).select("chunk", F.length("text").alias("n")).collect()
    finally:
        spark.conf.unset("carelattice.hot.rows")
    assert max(r.n for r in sizes) < 100_050 and len(sizes) == max(r.chunk for r in sizes) >= 110
    pages = sum(len(f"## Page {p}\n") + 1 for p in range(1000)) + 999
    assert sum(r.n for r in sizes) == 1_000_000 * 10 + 999_000 + pages + len(f"# Document: 7\nPages: 1000 | Chars: {10_999_000}\n\n")
