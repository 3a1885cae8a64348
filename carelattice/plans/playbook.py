"""Claims analytics: spans, running costs, risk scores, cost per member and month, provider
ranking and readmissions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from carelattice.functions import columns as c
from carelattice.operators.skew import Running, ordered_columns
from carelattice.operators.windows import change_from_previous, join_nullsafe, merge_intervals, top_k_per_group
from carelattice.session import materialise

MONEY = "decimal(28,6)"


def enrollment_spans(segments: DataFrame, as_of: Column, gap_days: int = 0) -> DataFrame:
    """Continuous enrolment per member and plan."""
    spans = merge_intervals(segments, ["mem_id", "plan_type"], "effective_date", "termination_date", gap_days)
    return spans.select(
        "mem_id", "plan_type", "span_start", "span_end",
        F.col("segments").alias("coverage_segments"),
        F.datediff(F.coalesce("span_end", as_of), "span_start").alias("days_enrolled"),
        F.when(F.col("span_end") < as_of, "Terminated").otherwise("Active").alias("status"),
    )


def claim_running(claims: DataFrame, since: Column | None = None, hot: DataFrame | None = None
                  ) -> DataFrame:
    """Cumulative, rolling 4-claim and average paid amount per member, most recent claim = 1."""
    rows = claims if since is None else claims.filter(F.col("claim_date") >= since)
    rows = rows.select(
        "mem_id", "claim_id", "provider_npi", "claim_date", "service_type", "allowed_amount",
        "paid_amount", "member_copay",
    )
    paid = F.col("paid_amount")
    done = ordered_columns(
        rows, ["mem_id"], [F.col("claim_date"), F.col("claim_id")],
        running={"cumulative_paid": Running("sum", paid), "_row": Running("rows")},
        framed={"rolling_4_claim_paid": lambda w: F.sum(paid).over(w.rowsBetween(-3, 0))},
        before=3, group_rows="_rows", hot=hot,
    )
    return done.withColumns({
        "cumulative_paid": F.col("cumulative_paid").cast(MONEY),
        "rolling_4_claim_paid": F.col("rolling_4_claim_paid").cast(MONEY),
        "avg_paid_to_date": c.exact_mean(F.col("cumulative_paid"), F.col("_row"), 4),
        "claim_seq": F.col("_rows") - F.col("_row") + 1,
    }).drop("_row", "_rows")


def one_per_member(members: DataFrame, as_of: Column) -> DataFrame:
    """One row a member: the plan in force on the day, else any other; the latest start, the highest ``row_key``."""
    ends = F.coalesce("termination_date", F.lit("9999-12-31").cast("date"))
    in_force = F.coalesce((F.col("effective_date") <= as_of) & (ends >= as_of), F.lit(False))
    rank = F.struct(in_force.alias("f"), F.col("effective_date").alias("s"), F.col("row_key").alias("r"))
    best = members.groupBy("mem_id").agg(F.max_by(F.struct(*[x for x in members.columns if x != "mem_id"]), rank).alias("m"))
    return best.select("mem_id", "m.*")


def hcc_risk(
    members: DataFrame, claims: DataFrame, diagnoses: DataFrame, hcc: DataFrame, as_of: Column,
    months: int = 12, top: int = 100,
) -> DataFrame:
    """Risk score per member: weights of the distinct codes of the last months times an age
    factor. The member-code pairs are made distinct map-side before anything is joined."""
    since = F.add_months(F.trunc(as_of, "month"), -months)
    window = claims.filter(F.col("claim_date") >= since).select("claim_id", "mem_id")
    weights = hcc.select("icd10_code", "hcc_code", F.col("hcc_weight").cast("decimal(10,4)").alias("w"))
    per_member = (
        window.join(diagnoses.select("claim_id", "icd10_code"), "claim_id")
        .select("mem_id", "icd10_code").distinct()
        .join(weights, "icd10_code")
        .groupBy("mem_id")
        .agg(F.sum("w").alias("total_hcc_weight"), F.countDistinct("hcc_code").alias("active_hcc_count"))
    )
    years = F.months_between(as_of, F.col("dob")) / 12
    factor = F.when(years < 45, F.lit("1.0")).when(years < 65, F.lit("1.4")).otherwise(F.lit("2.0"))
    scored = (
        members.select("mem_id", "dob").join(per_member, "mem_id")
        .withColumn("demographic_factor", factor.cast("decimal(3,1)"))
        .withColumn("risk_score", F.round(F.col("total_hcc_weight") * F.col("demographic_factor"), 2)
                    .cast("double"))
    )
    return (
        scored.select(
            "mem_id", "dob", F.col("total_hcc_weight").cast("double").alias("total_hcc_weight"),
            "active_hcc_count", F.col("demographic_factor").cast("double").alias("demographic_factor"),
            "risk_score", c.bucket(F.col("risk_score"), *c.HCC_CATEGORY).alias("risk_category"),
        )
        .orderBy(F.desc("risk_score"), "mem_id")
        .limit(top)
    )


def pmpm(members: DataFrame, claims: DataFrame, since: Column | None = None) -> DataFrame:
    """Cost per member and month by plan and metal level with the month-over-month change.

    Claims shrink to one row per member and month before the join, so a member with very
    many claims is a handful of rows and members per cell are counted without a distinct.
    """
    rows = claims if since is None else claims.filter(F.col("claim_date") >= since)
    plans = members.select("mem_id", "plan_type", "metal_level").distinct()
    return _priced(_monthly(rows).join(plans, "mem_id"))


def pmpm_in_force(members: DataFrame, claims: DataFrame, since: Column | None = None) -> DataFrame:
    """``pmpm`` with one plan for each member and claim month: the one in force in that month, of several the
    latest start, the highest ``row_key``. Costs of months without any are kept under a null plan."""
    rows = claims if since is None else claims.filter(F.col("claim_date") >= since)
    monthly = _monthly(rows)
    plans = members.select(F.col("mem_id").alias("_m"), "row_key", "effective_date", "termination_date", "plan_type", "metal_level")
    ends = F.coalesce("termination_date", F.lit("9999-12-31").cast("date"))
    fits = (F.col("mem_id") == F.col("_m")) & (F.col("effective_date") <= F.last_day("claim_month")) & (ends >= F.col("claim_month"))
    best = monthly.join(plans, fits, "left").groupBy(*monthly.columns).agg(
        F.max(F.struct("effective_date", "row_key", "plan_type", "metal_level")).alias("_p"))
    return _priced(best.select(*monthly.columns, "_p.plan_type", "_p.metal_level"))


def _monthly(rows: DataFrame) -> DataFrame:
    return rows.groupBy("mem_id", F.trunc("claim_date", "month").alias("claim_month")).agg(
        F.sum("paid_amount").alias("paid"), F.sum("allowed_amount").alias("allowed"),
        F.sum("member_copay").alias("copay"),
    )


def _priced(planned: DataFrame) -> DataFrame:
    cells = planned.groupBy("claim_month", "plan_type", "metal_level").agg(
        F.count(F.lit(1)).alias("member_count"),
        F.sum("paid").alias("paid"), F.sum("allowed").alias("allowed"), F.sum("copay").alias("copay"),
    )
    priced = cells.select(
        "claim_month", "plan_type", "metal_level", "member_count",
        F.col("paid").cast(MONEY).alias("total_paid"),
        F.col("allowed").cast(MONEY).alias("total_allowed"),
        F.col("copay").cast(MONEY).alias("total_copay"),
        c.exact_mean(F.col("paid"), F.col("member_count"), 2).alias("pmpm_paid"),
        c.exact_mean(F.col("allowed"), F.col("member_count"), 2).alias("pmpm_allowed"),
    )
    return change_from_previous(
        priced, ["plan_type", "metal_level"], "claim_month", "pmpm_paid", "prev_month_pmpm", "mom_change_pct"
    )


def pmpm_by_enrolment(member_months: DataFrame, claims: DataFrame) -> DataFrame:
    """The same cost over all enrolled members of the month, with or without a claim."""
    monthly = claims.groupBy(
        F.col("mem_id").alias("member_id"), F.trunc("claim_date", "month").alias("coverage_month")
    ).agg(F.sum("paid_amount").alias("paid"))
    enrolled = member_months.select("member_id", "coverage_month", "plan_type", "metal_level").distinct()
    cells = enrolled.join(monthly, ["member_id", "coverage_month"], "left").groupBy(
        "coverage_month", "plan_type", "metal_level"
    ).agg(F.count(F.lit(1)).alias("member_months"), F.sum("paid").alias("paid"))
    return cells.select(
        "coverage_month", "plan_type", "metal_level", "member_months",
        c.exact_mean(F.coalesce(F.col("paid"), F.lit(0)), F.col("member_months"), 2)
        .alias("pmpm_paid"),
    )


def provider_metrics(claims: DataFrame, providers: DataFrame, since: Column | None = None) -> DataFrame:
    """Claims, members and costs per provider. Claims are reduced to (provider, member) first,
    which also counts members without a distinct; providers join the reduced rows. ``claim_id``
    identifies a claim row."""
    rows = claims if since is None else claims.filter(F.col("claim_date") >= since)
    per_member = rows.groupBy("provider_npi", "mem_id").agg(
        F.count("claim_id").alias("claims"), F.count(F.lit(1)).alias("n"),
        *[F.sum(f"{c}").alias(c) for c in ("paid_amount", "allowed_amount", "member_copay")],
    )
    reduced = per_member.groupBy("provider_npi").agg(
        F.sum("claims").alias("total_claims"), F.count("mem_id").alias("unique_members"),
        F.sum("n").alias("_rows"), F.sum("paid_amount").alias("paid"),
        F.sum("allowed_amount").alias("allowed"), F.sum("member_copay").alias("copay"),
    )
    joined = providers.select("provider_npi", "provider_name", "specialty", "tier").join(reduced, "provider_npi")
    return joined.select(
        "provider_npi", "provider_name", "specialty", "tier", "total_claims", "unique_members",
        F.col("paid").cast(MONEY).alias("total_paid"),
        F.col("allowed").cast(MONEY).alias("total_allowed"),
        F.col("copay").cast(MONEY).alias("total_copay"),
        c.exact_mean(F.col("paid"), F.col("_rows"), 4).alias("avg_paid_per_claim"),
        c.exact_mean(F.col("allowed"), F.col("_rows"), 4).alias("avg_allowed_per_claim"),
        c.exact_mean(F.col("allowed"), F.col("unique_members"), 2).alias("cost_per_member"),
    )


def near_top_values(rows: DataFrame, segment: str, value: str, k: int) -> DataFrame:
    """(segment, _limit): the k-th largest different value of each segment (null if it has fewer). Spark cuts each
    task's values to k a segment before the shuffle, so a segment of any size sends only these."""
    values = rows.where(F.col(value).isNotNull()).select(segment, value).distinct()
    top = top_k_per_group(values, [segment], [F.col(value).desc()], k)
    least = top.groupBy(segment).agg(F.when(F.count(F.lit(1)) == k, F.min(value)).alias("_limit"))
    return join_nullsafe(rows.select(segment).distinct(), least, [segment], "left")


def rank_among(some: DataFrame, rows: DataFrame, segment: str, value: str, name: str) -> DataFrame:
    """``some`` of the rows with their rank by descending value (ties share the better one) among all rows of their
    segment. The rows are counted between the wanted values, which needs no order within a segment: a row is one
    count in one of these ranges, combined before the shuffle."""
    cuts = some.groupBy(segment).agg(F.array_sort(F.collect_set(value)).alias("_cuts"))  # of the few chosen rows
    beaten = F.size(F.filter("_cuts", lambda c: c < F.col(value)))
    placed = join_nullsafe(rows.select(segment, value), cuts, [segment]).groupBy(segment, beaten.alias("_beats")).agg(
        F.count(F.lit(1)).alias("_n"), F.count(value).alias("_known"))
    counts = placed.groupBy(segment).agg(F.collect_list(F.struct("_beats", "_n")).alias("_counts"), F.sum("_known").alias("_known"))
    joined = join_nullsafe(join_nullsafe(some, cuts, [segment]), counts, [segment])
    above = F.aggregate(F.filter("_counts", lambda c: c["_beats"] >= F.array_position("_cuts", F.col(value))), F.lit(0).cast("long"),
                        lambda total, c: total + c["_n"])
    rank = F.when(F.col(value).isNull(), F.col("_known") + 1).otherwise(above + 1).cast("int")
    return joined.withColumn(name, rank).drop("_cuts", "_counts", "_known")


def provider_ranking(metrics: DataFrame, k: int = 10) -> DataFrame:
    """Cost ranks within specialty and tier, review flag, ranks up to k. The metrics, one row a provider, are read
    several times and so written once."""
    metrics = materialise(metrics, "providers")
    near = [near_top_values(metrics, segment, "total_paid", k) for segment in ("specialty", "tier")]
    chosen = [join_nullsafe(metrics, limit, [segment]).where("total_paid >= _limit or _limit is null").select("provider_npi")
              for segment, limit in zip(("specialty", "tier"), near)]
    ranked = metrics.join(chosen[0].union(chosen[1]).distinct(), "provider_npi", "left_semi")
    for segment in ("specialty", "tier"):
        ranked = rank_among(ranked, metrics, segment, "total_paid", f"cost_rank_in_{segment}")
    flag = (
        F.when(F.col("cost_rank_in_specialty") <= 3, "High-Cost Specialty")
        .when(F.col("tier") == 3, "Out-of-Network")
        .when(F.col("cost_rank_in_tier") <= 5, "High-Cost Tier")
        .otherwise("Normal")
    )
    near_top = (F.col("cost_rank_in_specialty") <= k) | (F.col("cost_rank_in_tier") <= k)
    return ranked.filter(near_top).select(
        "provider_npi", "provider_name", "specialty", "tier", "total_claims", "unique_members",
        F.round("total_paid", 2).alias("total_paid"), "cost_per_member", "avg_paid_per_claim",
        "cost_rank_in_specialty", "cost_rank_in_tier", flag.alias("flag"),
    )


def stays_with_next(claims: DataFrame, since: Column | None = None, hot: DataFrame | None = None
                    ) -> DataFrame:
    """Inpatient stays with the member's next admission date and diagnosis."""
    rows = claims.filter(F.col("claim_type") == "inpatient")
    if since is not None:
        rows = rows.filter(F.col("admit_date") >= since)
    rows = rows.select(
        "claim_id", "mem_id", "provider_npi", "admit_date", "discharge_date", "primary_diagnosis",
        "paid_amount",
    )
    return ordered_columns(
        rows, ["mem_id"], [F.col("admit_date"), F.col("claim_id")],
        framed={
            "next_admit_date": lambda w: F.lead("admit_date").over(w),
            "next_primary_diagnosis": lambda w: F.lead("primary_diagnosis").over(w),
        },
        after=1, hot=hot,
    )


def readmissions(
    claims: DataFrame, providers: DataFrame, days: int = 30, min_cases: int = 10, top: int = 25,
    since: Column | None = None, exclude_negative: bool = False, hot: DataFrame | None = None,
    known_providers_only: bool = True,
) -> DataFrame:
    """Readmission rate and cost per facility, small cells suppressed, worst first.

    By default a stay of an unknown provider is no next stay either (``known_providers_only``).
    Stays shrink to one row per provider before the facility join.
    """
    gap = F.datediff("next_admit_date", "discharge_date")
    again = F.coalesce(gap <= days, F.lit(False))
    if exclude_negative:
        again = again & (gap >= 0)
    if known_providers_only:
        claims = claims.join(providers.select("provider_npi"), "provider_npi", "left_semi")
    stays = stays_with_next(claims, since, hot).withColumn("again", again)
    reduced = stays.groupBy("provider_npi").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("again").cast("int")).alias("r"),
        F.sum("paid_amount").alias("paid"),
        F.sum(F.when(F.col("again"), F.col("paid_amount"))).alias("paid_again"),
    )
    facility = providers.select("provider_npi", "facility_name", "facility_state")
    cells = facility.join(reduced, "provider_npi").groupBy("facility_name", "facility_state").agg(
        F.sum("n").alias("total_discharges"), F.sum("r").alias("readmissions"),
        F.sum("paid").alias("paid"), F.sum("paid_again").alias("paid_again"),
    )
    return (
        cells.filter(F.col("total_discharges") >= min_cases)
        .select(
            "facility_name", "facility_state", "total_discharges", "readmissions",
            F.round(F.col("readmissions") * 100.0 / F.col("total_discharges"), 2)
            .cast("double").alias("readmission_rate_pct"),
            c.exact_mean(F.col("paid"), F.col("total_discharges"), 2).alias("avg_admission_cost"),
            c.exact_mean(F.col("paid_again"), F.col("readmissions"), 2)
            .alias("avg_readmission_cost"),
        )
        .orderBy(F.desc("readmission_rate_pct"), "facility_name", "facility_state")
        .limit(top)
    )
