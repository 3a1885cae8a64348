"""Scalar building blocks. Everything is a built-in expression and stays in generated code."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_of_date(value: date | str) -> Column:
    return F.lit(str(value)).cast("date")


def surrogate_id(*parts: Column | str, sep: str = "|") -> Column:
    """Stable positive 60-bit id of the joined parts; a NULL part counts as an empty marker."""
    text = [F.coalesce(column(p).cast("string"), F.lit("")) for p in parts]
    digest = F.sha2(F.concat_ws(sep, *text), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def age(born: Column | str, as_of: Column, method: str = "completed") -> Column:
    """Age in years: ``boundary`` counts new years passed, ``completed`` counts birthdays
    passed, ``tenths`` is days/365.25 to one decimal, ``rounded`` the same to a whole year
    (half to even), ``months`` is months/12 unrounded."""
    born = column(born)
    days = F.datediff(as_of, born)
    match method:
        case "boundary":
            return F.year(as_of) - F.year(born)
        case "completed":
            before_birthday = (F.month(as_of) * 100 + F.dayofmonth(as_of)) < (F.month(born) * 100 + F.dayofmonth(born))
            return F.year(as_of) - F.year(born) - before_birthday.cast("int")
        case "tenths":
            return F.round(days / 365.25, 1)
        case "rounded":
            return F.bround(days / 365.25).cast("int")
        case "months":
            return F.months_between(as_of, born) / 12
    raise ValueError(f"unknown age method {method}")


def bucket(value: Column, cuts: Sequence, labels: Sequence[str], closed: str = "left") -> Column:
    """Label by thresholds. ``left``: value < cut; ``right``: value <= cut. NULL stays NULL."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("one more label than cuts is needed")
    out = None
    for cut, label in zip(cuts, labels):
        below = value < cut if closed == "left" else value <= cut
        out = F.when(below, label) if out is None else out.when(below, label)
    return out.when(value.isNotNull(), labels[-1])


# Cut points and labels.
ROSTER_AGE = ((18, 26, 41, 56, 66), ("Minor", "Young Adult", "Adult", "Middle", "Pre-Senior", "Senior"))
PREVALENCE_AGE = ((18, 30, 45, 60, 75), ("0-17", "18-29", "30-44", "45-59", "60-74", "75+"))
TREATMENT_LAG = ((0, 7, 30, 90), ("same_day", "within_week", "within_month", "within_quarter", "after_quarter"))
RISK_BAND = ((0.10, 0.30), ("low", "medium", "high"))
HCC_CATEGORY = ((1.0, 2.0, 3.0), ("Low", "Moderate", "High", "Very High"))
RISK_TIER = ((0, 1, 2), ("Normal", "Monitor", "Elevated", "Critical"))


def roster_age_bucket(years: Column, legacy: bool = False) -> Column:
    """With ``legacy`` an unknown age falls into the last bucket, as an ELSE branch would."""
    found = bucket(years, *ROSTER_AGE)
    return F.coalesce(found, F.lit(ROSTER_AGE[1][-1])) if legacy else found


def classify_text(text: Column | str, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """First matching pattern wins; NULL text stays NULL."""
    low = F.lower(column(text))
    out = F.when(low.isNull(), F.lit(None).cast("string"))
    for pattern, label in rules:
        out = out.when(low.rlike(pattern), label)
    return out.otherwise(default)


# Measurement text -> category, first match wins.
MEASUREMENT_RULES = [
    ("blood pressure|systolic|diastolic", "vitals_bp"),
    ("heart rate|pulse", "vitals_hr"),
    ("temperature|temp", "vitals_temp"),
    ("bmi|weight|height", "vitals_body"),
    ("glucose|hba1c|cholesterol|triglyceride|a1c", "lab_metabolic"),
    ("creatinine|egfr|bun|urea", "lab_renal"),
    ("hemoglobin|hct|wbc|plt|rbc", "lab_hematology"),
    ("tsh|t3|t4|insulin|cortisol", "lab_endocrine"),
]

# Concept name -> condition category, first match wins.
CONCEPT_NAME_RULES = [
    ("diabetes|endocr", "endocrine"),
    ("hypertens|heart|stroke|circulat", "circulatory"),
    ("copd|asthma|respirat", "respiratory"),
    ("liver|ibd|digest", "digestive"),
    ("renal|kidney|genitour", "genitourinary"),
    ("rheumat|lupus|musculo", "musculoskeletal"),
    ("cancer|neopl|tumor", "neoplasms"),
    ("depress|schizo|mental|anxi", "mental"),
]


def concept_category(name: Column | str) -> Column:
    name = F.nullif(column(name), F.lit(""))
    return classify_text(name, CONCEPT_NAME_RULES, "other")


def json_field(payload: Column | str, path: str, type_name: str = "string") -> Column:
    return F.get_json_object(column(payload), path).try_cast(type_name)


def critical_vitals(spo2: Column, heart_rate: Column, systolic: Column, respiration: Column) -> Column:
    """Early-warning flag; a missing reading never triggers it."""
    tests = [
        spo2 < 90,
        (heart_rate < 40) | (heart_rate > 140),
        systolic < 90,
        (respiration < 8) | (respiration > 30),
    ]
    flag = F.lit(False)
    for test in tests:
        flag = flag | F.coalesce(test, F.lit(False))
    return flag


def critical_lab(flag: Column) -> Column:
    return F.coalesce(flag.isin("LL", "HH", "AA"), F.lit(False))


def abnormal_flag(value: Column, low: Column, high: Column) -> Column:
    return (
        F.when(value < low * 0.8, "LL")
        .when(value < low, "L")
        .when(value > high * 1.3, "HH")
        .when(value > high, "H")
    )


def device_metric(metrics: Column | str, key: str, type_name: str = "double") -> Column:
    """One typed reading out of a map of mixed readings; a reading of another type is NULL."""
    return column(metrics)[key].try_cast(type_name)


def pulse_pressure(systolic: Column, diastolic: Column) -> Column:
    return systolic - diastolic


def confidence(score: Column) -> Column:
    """0 for a score of one half, 1 for a certain score."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.abs(score - 0.5) * 2))


def top_contributions(contributions: Column, k: int = 5) -> Column:
    """The k entries of a map that are largest in magnitude, rounded to 4 decimals."""
    entries = F.transform(
        F.map_entries(contributions),
        lambda e: F.struct((-F.abs(e["value"])).alias("rank"), e["key"].alias("key"), e["value"].alias("value")),
    )
    best = F.slice(F.array_sort(entries), 1, k)
    return F.map_from_entries(
        F.transform(best, lambda e: F.struct(e["key"], F.round(e["value"], 4)))
    )


def pad_zip(value: Column | str, zip4: bool = True) -> Column:
    """Give a ZIP its lost leading zeros. With ``zip4`` a longer code is left whole."""
    text = F.trim(column(value).cast("string"))
    padded = F.lpad(text, 5, "0")
    return F.when(F.length(text) < 5, padded).otherwise(text) if zip4 else padded


def missing(value: Column | str) -> Column:
    value = column(value)
    return value.isNull() | (F.trim(value.cast("string")) == "")


def ratio(numerator: Column, denominator: Column) -> Column:
    return numerator / F.nullif(denominator, F.lit(0))


def exact_mean(total: Column, n: Column, places: int) -> Column:
    """Mean of a decimal total rounded half up, divided in decimal arithmetic so that ties do
    not depend on how a double happens to be stored."""
    mean = total.cast("decimal(28,6)") / F.nullif(n, F.lit(0)).cast("decimal(18,0)")
    return F.round(mean, places).cast("double")
