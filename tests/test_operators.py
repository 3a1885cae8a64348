"""Operators on small literal tables, invariants and brute-force comparisons."""

import datetime
import io
import random
from contextlib import redirect_stdout

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from carelattice.functions import columns as c
from carelattice.operators import aggregates, anomaly, documents, joins, quality, skew, windows
from carelattice.plans import playbook, staging

day = datetime.date


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first().v


@pytest.mark.parametrize("text, category", [
    ("Type 2 diabetes mellitus", "endocrine"), ("Essential hypertension", "circulatory"),
    ("COPD exacerbation", "respiratory"), ("Asthma", "respiratory"), ("Major depressive disorder", "mental"),
    ("Fracture of femur", "other"), (None, None), ("", None),
])
def test_concept_category(spark, text, category):
    assert one(spark, c.concept_category(F.lit(text).cast("string"))) == category


@pytest.mark.parametrize("spo2, hr, sbp, rr, flag", [
    (85, 72, 120, 16, True), (98, 150, 120, 16, True), (98, 72, None, None, False), (None, None, 89, None, True),
    (None, None, None, 7, True), (None, None, None, None, False),
])
def test_critical_vitals(spark, spo2, hr, sbp, rr, flag):
    values = [F.lit(v).cast("double") for v in (spo2, hr, sbp, rr)]
    assert one(spark, c.critical_vitals(*values)) is flag


def test_abnormal_flag(spark):
    flags = [one(spark, c.abnormal_flag(F.lit(v), F.lit(10.0), F.lit(20.0))) for v in (7.9, 8.0, 10.0, 20.5, 26.5)]
    assert flags == ["LL", "L", None, "H", "HH"]


def test_ages_differ_by_method(spark):
    born, at = F.lit("1990-12-31").cast("date"), F.lit("2024-01-01").cast("date")
    assert one(spark, c.age(born, at, "boundary")) == 34
    assert one(spark, c.age(born, at, "completed")) == 33
    assert one(spark, c.age(born, at, "tenths")) == 33.0
    leap, before = F.lit("1980-02-29").cast("date"), F.lit("2001-02-28").cast("date")
    assert one(spark, c.age(leap, before, "completed")) == 20


def test_buckets_keep_null(spark):
    ages = spark.createDataFrame([(None,), (17,), (18,), (25,), (26,), (65,), (66,)], "a int")
    got = [r.b for r in ages.select(c.roster_age_bucket(F.col("a")).alias("b")).collect()]
    assert got == [None, "Minor", "Young Adult", "Young Adult", "Adult", "Pre-Senior", "Senior"]
    assert one(spark, c.roster_age_bucket(F.lit(None).cast("int"), legacy=True)) == "Senior"


def test_pad_zip(spark):
    assert one(spark, c.pad_zip(F.lit(" 2134 "))) == "02134"
    assert one(spark, c.pad_zip(F.lit("46802-1234"))) == "46802-1234"
    assert one(spark, c.pad_zip(F.lit("46802-1234"), zip4=False)) == "46802"


def test_confidence_and_top_contributions(spark):
    assert one(spark, c.confidence(F.lit(0.5))) == 0.0
    assert one(spark, c.confidence(F.lit(0.9))) == pytest.approx(0.8)
    weights = F.create_map(*[F.lit(x) for x in ("a", 0.1, "b", -0.5, "c", 0.333333)])
    assert one(spark, c.top_contributions(weights, 2)) == {"b": -0.5, "c": 0.3333}


def test_exact_mean_rounds_half_up(spark):
    assert one(spark, c.exact_mean(F.lit("1227375.45").cast("decimal(18,6)"), F.lit(6), 2)) == 204562.58


def test_prefix_join_keeps_rows(spark):
    codes = spark.createDataFrame([("D50.9",), ("D10",), ("H25.1",), ("999",), (None,)], "code string")
    prefixes = spark.createDataFrame([("D", "neo"), ("D5", "blood"), ("H2", "ear")], "p string, label string")
    longest = joins.prefix_join(codes, "code", prefixes, "p", [1, 2])
    assert {tuple(r) for r in longest.collect()} == {
        ("D50.9", "blood"), ("D10", "neo"), ("H25.1", "ear"), ("999", None), (None, None)}
    every = joins.prefix_join(codes, "code", prefixes, "p", [1, 2], mode="all")
    assert every.count() == 6


def test_plans_have_no_nested_loops(spark):
    codes = spark.range(10).select(F.col("id").cast("string").alias("code"), F.current_date().alias("d"))
    prefixes = spark.createDataFrame([("1", "x")], "p string, label string")
    frames = [
        joins.prefix_join(codes, "code", prefixes, "p", [1]),
        joins.interval_join(codes, codes.select("code", F.col("d").alias("e")), ["code"], "d", "e", 90),
    ]
    for df in frames:
        out = io.StringIO()
        with redirect_stdout(out):
            df.explain()
        assert "CartesianProduct" not in out.getvalue() and "NestedLoop" not in out.getvalue()


intervals = st.lists(
    st.tuples(st.integers(0, 2), st.integers(0, 60), st.integers(0, 20)), min_size=1, max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(intervals)
def test_covered_days_equals_brute_force(spark, rows):
    base = day(2020, 1, 1)
    table = [(k, base + datetime.timedelta(s), base + datetime.timedelta(s + n)) for k, s, n in rows]
    got = windows.covered_days(spark.createDataFrame(table, "k int, s date, e date"), ["k"], "s", "e")
    want = {}
    for k, s, n in rows:
        want.setdefault(k, set()).update(range(s, s + n))
    assert {r.k: r.covered_days for r in got.collect()} == {k: len(v) for k, v in want.items() if v}


def test_spans_never_overlap_and_open_end(spark):
    rows = [("m", "P", 1, day(2020, 1, 1), day(2020, 1, 31)), ("m", "P", 2, day(2020, 2, 1), day(2020, 2, 10)),
            ("m", "P", 3, day(2020, 3, 1), None), ("m", "P", 4, day(2020, 5, 1), day(2020, 5, 2))]
    table = spark.createDataFrame(rows, "mem_id string, plan_type string, n int, effective_date date, termination_date date")
    got = playbook.enrollment_spans(table, F.lit("2020-06-01").cast("date")).orderBy("span_start").collect()
    assert [(r.span_start, r.span_end, r.coverage_segments, r.status) for r in got] == [
        (day(2020, 1, 1), day(2020, 2, 10), 2, "Terminated"), (day(2020, 3, 1), None, 2, "Active")]


def test_hot_key_is_found_and_others_are_not(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    spark.conf.set("carelattice.hot.rows", "900")
    try:
        found = [r.hot_key for r in skew.hot_keys(rows, ["k"]).collect()]
    finally:
        spark.conf.unset("carelattice.hot.rows")
    want = spark.range(1).select(F.xxhash64(F.lit(0).cast("long"))).first()[0]
    assert found == [want]
    assert skew.hot_keys(rows, ["k"]) is None
    ordinary, heavy = skew.split(rows, ["k"], spark.createDataFrame([(want,)], "hot_key long"))
    assert heavy.count() == 6667 and ordinary.count() == 20_000 - 6667


def test_a_key_whose_rows_share_one_day_is_split(spark, every_key_hot):
    rows = spark.range(5000).select(F.lit("p").alias("k"), F.lit("2024-01-01").cast("date").alias("d"), "id")
    sliced = skew.ranges(rows, ["k"], [F.col("d"), F.col("id")], 4)
    assert sliced.select("_slice").distinct().count() > 1
    got = skew.ordered_columns(rows, ["k"], [F.col("d"), F.col("id")], running={"n": skew.Running("rows")},
                               framed={"back": lambda w: F.lag("id").over(w)}, before=1)
    assert all(r.n == r.id + 1 and r.back == (r.id - 1 if r.id else None) for r in got.collect())


def test_ordinal_numbers_floods_of_copies(spark, every_key_hot):
    rows = spark.range(1000).select(F.lit("p").alias("k"), (F.col("id") % 2).alias("x"))
    got = skew.ordinal(rows, ["k"], "n", hot=skew.hot_keys(rows, ["k"]))
    assert sorted(r.n for r in got.collect()) == list(range(1, 1001))


def test_running_over_whole_table_has_no_single_task_over_rows(spark):
    rows = spark.range(500).select("id", (F.col("id") % 7).alias("v"))
    got = skew.sliced_running(rows, [], [F.col("id")],
                              {"s": skew.Running("sum", F.col("v")), "m": skew.Running("max", F.col("v"), False)}, "n")
    table = got.orderBy("id").toPandas()
    want = pd.Series([i % 7 for i in range(500)])
    assert (table.s == want.cumsum()).all() and (table.n == 500).all()
    assert table.m[1:].astype(int).tolist() == want.cummax()[:-1].tolist() and pd.isna(table.m[0])


@pytest.mark.parametrize("n, repeat", [(1, 1), (2, 1), (7, 1), (1000, 1), (3000, 3), (5000, 5000)])
def test_exact_quantiles_equal_numpy(spark, n, repeat):
    rng = random.Random(n)
    values = [round(rng.lognormvariate(3, 1), 2) for _ in range(n // repeat)] * repeat
    qs = [0.0, 0.25, 0.5, 0.95, 1.0]
    got = aggregates.exact_quantiles(spark.createDataFrame([(v,) for v in values], "v double"), "v", qs, levels=n % 3).first()
    assert list(got) == pytest.approx(np.quantile(values, qs).tolist())


def test_quantiles_of_odd_values(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(v,) for v in (None, -inf, -1e300, -5.0, -0.0, 0.0, 1e-300, 2.0, 1e300, inf, nan)]
    df = spark.createDataFrame(rows, "v double").repartition(3)
    got = aggregates.exact_quantiles(df, "v", [k / 9 for k in range(10)]).first()
    want = sorted((v for (v,) in rows if v is not None and v == v)) + [nan]
    assert [repr(abs(x)) for x in got] == [repr(abs(x)) for x in want]
    assert list(aggregates.exact_quantiles(df.where("v > 1e308"), "v", [0.5]).where("false").collect()) == []
    assert aggregates.exact_quantiles(df.where("false"), "v", [0.5]).first().q0 is None


def test_quantiles_run_nothing_while_planned(spark):
    group = "quantile-jobs"
    spark.sparkContext.setJobGroup(group, group)
    plan = aggregates.exact_quantiles(spark.range(5000).selectExpr("cast(id * id as double) v"), "v", [0.05, 0.25, 0.5, 0.75, 0.95])
    tracker = spark.sparkContext.statusTracker()
    assert not tracker.getJobIdsForGroup(group)
    assert plan.first().q2 == pytest.approx(np.quantile(np.arange(5000.0) ** 2, 0.5))
    assert len(tracker.getJobIdsForGroup(group)) <= 20
    spark.sparkContext.setJobGroup("", "")


@pytest.mark.parametrize("k", [1, 3, 10, 500])
def test_ranks_within_segments_of_many_ties(spark, k):
    rng = random.Random(k)
    rows = [(i, "p", rng.choice("ab"), 1 + i % 3, 0, 0, rng.choice([None, *range(20)]), 0.0, 0.0) for i in range(400)]
    schema = "provider_npi int, provider_name string, specialty string, tier int, total_claims int, unique_members int, total_paid int, cost_per_member double, avg_paid_per_claim double"
    got = playbook.provider_ranking(spark.createDataFrame(rows, schema), k).toPandas()
    table = pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])
    for name in ("specialty", "tier"):
        table[f"cost_rank_in_{name}"] = table.groupby(name).total_paid.rank(method="min", ascending=False, na_option="bottom").astype(int)
    want = table[(table.cost_rank_in_specialty <= k) | (table.cost_rank_in_tier <= k)]
    columns = ["provider_npi", "cost_rank_in_specialty", "cost_rank_in_tier"]
    assert sorted(map(tuple, got[columns].to_numpy().tolist())) == sorted(map(tuple, want[columns].to_numpy().tolist()))


@pytest.mark.parametrize("cell, few, named", [(7.0, 10_000, False), (50.0, 0, False), (13.0, 10_000, True), (1e6, 0, False)])
def test_overlaps_by_grid_cells(spark, monkeypatch, cell, few, named):
    monkeypatch.setattr(documents, "FEW_REGIONS", few)
    rng = random.Random(int(cell))
    num = lambda: float(rng.randint(-30, 60))
    blocks = [(rng.randint(1, 3), rng.randint(1, 2), i, f"t{i}", x := num(), y := num(), x + rng.randint(0, 40), y + rng.randint(0, 40)) for i in range(120)]
    regions = [(f"r{i}", rng.randint(1, 2), num(), num(), float(rng.randint(-5, 50)), float(rng.randint(0, 50)), rng.randint(1, 3)) for i in range(25)]
    b = spark.createDataFrame([*blocks, (1, 1, 500, "none", None, 0.0, 1.0, 1.0)], "doc_id int, page_number int, line_number int, text string, x0 double, y0 double, x1 double, y1 double")
    r = spark.createDataFrame(regions, "region string, page_number int, x double, y double, width double, height double, doc_id int")
    got = documents.region_hits(b, r if named else r.drop("doc_id"), cell=cell).select("line_number", "region").collect()
    want = [(i, n) for d, p, i, _, x0, y0, x1, y1 in blocks for n, q, x, y, w, h, e in regions
            if p == q and (not named or d == e) and x0 < x + w and x1 > x and y0 < y + h and y1 > y]
    assert sorted(map(tuple, got)) == sorted(want) and want


def test_isolation_forest_finds_planted_members(spark):
    rng = random.Random(5)
    rows = [(f"m{i}", rng.gauss(100, 5), i % 5 + 10, rng.gauss(10, 1), rng.gauss(2, 0.2)) for i in range(600)]
    rows += [(f"odd{i}", 900.0 + i, 90, 80.0, 30.0) for i in range(6)]
    df = spark.createDataFrame(rows, "mem_id string, total_paid double, claim_count int, avg_paid double, std_paid double")
    scored = anomaly.isolation_forest(df, "mem_id", trees=30, contamination=0.05).toPandas()
    assert len(scored) == 606 and scored.anomaly_label.sum() <= 31
    assert scored[scored.mem_id.str.startswith("odd")].anomaly_label.all()
    again = anomaly.isolation_forest(df, "mem_id", trees=30, contamination=0.05).toPandas()
    assert scored.sort_values("mem_id").anomaly_score.tolist() == pytest.approx(again.sort_values("mem_id").anomaly_score.tolist())


def test_contract_examples(spark):
    rows = [
        ("MEM000001", "1985-03-15", "46825", "2025-01-01", "Active", "Self", "PPO", "Gold"),
        ("MEM000072", "1985-03-15", "4603", "2025-01-01", "Active", "Self", "PPO", "Gold"),
        ("MEM000109", "1995-07-22", "46825", "2025-01-01", "Active", "Child", "PPO", "Gold"),
        ("MEM000041", "1985-03-15", "46825", "2025-01-01", "2024-01-01", "Self", "PPO", "Gold"),
        ("MEM000041", "1985-03-15", "46825", "2025-01-01", "Active", "Self", "PPO", "Gold"),
    ]
    names = "mem_id dob zip_code effective_date termination_date covered_relation plan_type metal_level".split()
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)).withColumns(
        {"email": F.lit("a@b.c"), "phone": F.lit("1")})
    result = quality.contract_quality(df, "e", F.lit("2026-03-25").cast("date")).collect()
    failed = {r.check_id: r.failed_rows for r in result if r.failed_rows}
    assert failed == {
        "matches_zip_code": 1, "child_under_26": 1, "child_under_26_at_start": 1,
        "termination_after_effective": 1, "unique_mem_id": 1}


def test_eligibility_flags_on_planted_rows(spark):
    rows = [(f"M{i}", "1980-01-01", "e", "p", "46802", "Active", "Self") for i in range(20)]
    rows += [("M0", "1980-01-01", "e", "p", "46802", "Active", "Self"), ("N1", "", "e", "p", "2134", "Active", "Self"),
             ("N2", "1990-01-01", None, "", "46802", "2020-01-01", "Child")]
    names = "mem_id dob email phone zip_code termination_date covered_relation".split()
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], ", ".join(f"{n} string" for n in names) + ", row int")
    at = F.lit("2026-03-25").cast("date")
    flags = staging.issue_flags(df, at).agg(*[F.sum(x).alias(x) for x in staging.ISSUES]).first().asDict()
    assert flags == {"zip_lost_zeros": 1, "duplicate_id": 2, "child_overage": 1, "missing_dob": 1,
                     "missing_email": 1, "missing_phone": 1, "missing_zip": 0}
    assert staging.clean_roster(df, at, [F.col("row")]).count() == 20
    report = staging.cleaning_report(df, at, [F.col("row")]).first()
    assert (report.input_rows, report.distinct_members, report.active_rows, report.clean_rows) == (23, 22, 22, 20)


def test_quality_null_handling(spark):
    df = spark.createDataFrame([("a",), (None,), ("z",)], "v string")
    lax = quality.evaluate(df, "t", [quality.accepted_values("v", ["a"])]).first()
    strict = quality.evaluate(df, "t", [quality.accepted_values("v", ["a"], nulls_pass=False)]).first()
    assert (lax.failed_rows, strict.failed_rows) == (1, 2)
    empty = quality.freshness(df.limit(0).withColumn("ts", F.current_timestamp()), "t", "ts", F.lit("2024-01-01").cast("date")).first()
    assert empty.passed and empty.severity == "warning"


def test_claim_form_fields(spark):
    text = ("Member ID: MEM000042\nCPT Code: 99214\nBilled Amount: $285.00\nAllowed Amount: $210.00\n"
            "Insurance Paid: $168.00\nPatient Responsibility: $42.00\nDate of Service: 2026-03-10\nnote")
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    row = documents.typed_claim(docs).first()
    assert (row.member_id, row.cpt_code, row.service_date, row.claim_id) == ("MEM000042", "99214", day(2026, 3, 10), None)
    assert [float(x) for x in (row.billed_amount, row.allowed_amount, row.paid_amount, row.patient_amount)] == [285, 210, 168, 42]
    assert documents.extract_key_values(docs).count() == 7
    assert one(spark, documents.typed_lab_row(F.lit("118 mg/dL"))) == (118.0, "mg/dL")


def test_omop_placeholders_are_typed(spark):
    from suite import warehouse

    sf = "/root/testdata/sf0.001"
    for name, build in (("omop_person", warehouse.person), ("omop_visit", warehouse.visit), ("omop_drug", warehouse.drug),
                        ("omop_condition", warehouse.condition), ("omop_measurement", warehouse.measurement)):
        types = dict(build(spark, sf).dtypes)
        assert set(warehouse.NULLS[name]) <= set(types) and "void" not in types.values()


def test_warehouse_build_agrees_with_its_own_tests(spark):
    from carelattice.plans.warehouse import build
    from suite.views import AS_OF, load

    names = ["eligibility", "patients", "encounters", "conditions", "medications", "observations"]
    raw = dict(zip(names, load(spark, "/root/testdata/sf0.001", *names)))
    models = build(raw, c.as_of_date(AS_OF))
    result = quality.model_tests(models).filter("not passed").collect()
    # the planted faults: repeated member ids, unreadable birth dates, unknown states and ages
    assert {(r.table_name, r.check_id) for r in result} <= {
        ("stg_members", "unique_member_id"), ("stg_members", "not_null_date_of_birth"),
        ("stg_members", "accepted_values_state"), ("member_roster", "accepted_values_age_bucket")}
    assert {"omop_drug", "condition_drug_pairs"} <= set(models)


def test_null_keys_are_kept_and_counted_as_equal(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), ("m", 3)], "mem_id string, x int")
    assert windows.duplicates(rows, ["mem_id"]).count() == 2
    flags = {r.x: r.is_unique for r in windows.unique_over(rows, ["mem_id"]).collect()}
    assert flags == {1: False, 2: False, 3: True}
    raw = rows.withColumns({c: F.lit(None).cast("string") for c in ("dob", "email", "phone", "zip_code", "covered_relation")})
    issues = staging.issue_flags(raw, F.lit("2024-01-01").cast("date"))
    assert {r.x: r.duplicate_id for r in issues.collect()} == {1: 1, 2: 1, 3: 0}


def test_a_member_with_two_plans_costs_once(spark):
    plans = "mem_id string, row_key int, dob string, plan_type string, metal_level string, effective_date string, termination_date string"
    members = spark.createDataFrame([
        ("a", 1, "1950-01-01", "HMO", "Gold", "2020-01-01", None), ("a", 2, "1950-01-01", "PPO", "Gold", "2020-03-15", None),
    ], plans).withColumns({c: F.col(c).cast("date") for c in ("dob", "effective_date", "termination_date")})
    claims = spark.sql("""select 'a' as mem_id, cast(d as date) as claim_date, cast(10 as decimal(12,2)) as paid_amount,
        cast(10 as decimal(12,2)) as allowed_amount, cast(1 as decimal(12,2)) as member_copay
        from values ('2019-12-01'), ('2020-02-01'), ('2020-03-01') v(d)""")
    got = sorted((str(r.claim_month), r.plan_type, r.member_count) for r in playbook.pmpm_in_force(members, claims).collect())
    assert got == [("2019-12-01", None, 1), ("2020-02-01", "HMO", 1), ("2020-03-01", "PPO", 1)]
    assert [r.row_key for r in playbook.one_per_member(members, F.lit("2020-02-01").cast("date")).collect()] == [1]


def test_model_tests_build_a_model_once(spark):
    built = spark.sparkContext.accumulator(0)

    def through(batches):
        for batch in batches:
            built.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([(1, 8507, 1950), (1, 5, None), (2, 8532, 1960)], "person_id long, gender_concept_id int, year_of_birth int")
    person = rows.mapInArrow(through, rows.schema)
    result = {row.check_id: (row.failed_rows, row.total_rows) for row in quality.model_tests({"omop_person": person}).collect()}
    assert built.value == 3
    assert result["unique_person_id"] == (1, 3)
    assert {failed for check, (failed, _) in result.items() if check != "unique_person_id"} == {0, 1}
