"""The batch build: raw tables to staging, OMOP tables and marts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame

from carelattice.plans import marts, omop, staging
from carelattice.session import materialise


def build(raw: Mapping[str, DataFrame], as_of: Column) -> dict[str, DataFrame]:
    """All models from eligibility, patients, encounters, conditions, medications and
    observations. Tables that several models read are written once; the rest stay lazy."""
    members = staging.stg_members(raw["eligibility"])
    condition = materialise(omop.omop_condition(raw["conditions"]), "omop_condition")
    drug = materialise(omop.omop_drug(raw["medications"]), "omop_drug")
    return {
        "stg_members": members,
        "member_months": materialise(staging.member_months(members, as_of), "member_months"),
        "member_roster": staging.member_roster(members, as_of),
        "omop_person": omop.omop_person(raw["patients"]),
        "omop_visit": omop.omop_visit(raw["encounters"]),
        "omop_condition": condition,
        "omop_drug": drug,
        "omop_measurement": omop.omop_measurement(raw["observations"]),
        "medication_adherence": marts.medication_adherence(drug),
        "condition_drug_pairs": marts.condition_drug_pairs(condition, drug),
    }
