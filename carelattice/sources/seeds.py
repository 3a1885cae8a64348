"""Reference tables of fixed size. Every table here is a constant of this file, so the
broadcast of one never grows with the data."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

# ICD-10 prefix -> condition category.
ICD10_PREFIX_CATEGORY = """
A,infectious_disease
B,infectious_disease
C,neoplasms
D,neoplasms
D5,blood_disease
D6,blood_disease
D7,blood_disease
E,endocrine
F,mental_health
G,nervous_system
H0,eye_disorder
H1,eye_disorder
H2,ear_disorder
H3,ear_disorder
H4,ear_disorder
H5,ear_disorder
I,circulatory
J,respiratory
K,digestive
L,skin
M,musculoskeletal
N,genitourinary
O,pregnancy
P,perinatal
Q,congenital
R,symptoms_signs
S,injury
T,injury
V,external_cause
W,external_cause
X,external_cause
Y,external_cause
Z,health_services
"""

# ICD-10 code, description, HCC code, HCC weight, category.
ICD10_HCC = """
E11.9,Type 2 diabetes mellitus without complications,E11,1.0,Endocrine
I10,Essential (primary) hypertension,I10,0.97,Cardiovascular
J44.1,Chronic obstructive pulmonary disease,J44,0.72,Pulmonary
J44.0,Chronic obstructive pulmonary disease with acute lower respiratory infection,J44,0.72,Pulmonary
J45.909,Unspecified asthma uncomplicated,J45,0.49,Pulmonary
K21.0,Gastro-esophageal reflux disease with esophagitis,K21,0.31,Gastrointestinal
K21.9,Gastro-esophageal reflux disease without esophagitis,K21,0.31,Gastrointestinal
M54.5,Low back pain,M54,0.40,Musculoskeletal
F41.9,Anxiety disorder unspecified,F41,0.40,Mental Health
F32.9,Major depressive disorder single episode unspecified,F32,0.55,Mental Health
N18.3,Chronic kidney disease stage 3,N18,0.69,Renal
N18.4,Chronic kidney disease stage 4,N18,0.69,Renal
I50.9,Heart failure unspecified,I50,1.20,Cardiovascular
I25.10,Atherosclerotic heart disease of native coronary artery,I25,1.00,Cardiovascular
C50.911,Malignant neoplasm of unspecified site of right female breast,C50,2.50,Oncology
"""

# ICD-10 code, standard concept, source concept.
ICD10_CONCEPT = """
E11.9,319844,44828250
I10,4027541,320128
J44.1,255848,257867
M54.5,3946111,4029483
F32.9,3520530,3520530
R51,4039357,4039357
K21.0,4000961,4000961
E78.5,4013720,4013720
I25.10,4052490,4052490
Z23,4302132,4302132
J45.909,259153,256675
N18.3,192623,192623
R73.03,3004418,3004418
"""

# Concept maps of the second patient and visit mapping.
GENDER_CONCEPT = {"M": 8507, "F": 8532}
RACE_CONCEPT = {"white": 8527, "black": 8516, "asian": 8515, "native": 8657, "other": 8522}
ETHNICITY_CONCEPT = {"nonhispanic": 38035, "hispanic": 38036}
VISIT_CLASS_CONCEPT = {
    "encounter": 44814707,
    "emergency": 9203,
    "inpatient": 9201,
    "outpatient": 9202,
    "ambulatory": 44814707,
    "wellcare": 44814708,
    "telehealth": 508142,
    "urgentcare": 9203,
}
# Visit class -> visit concept of the first mapping.
OMOP_VISIT_CONCEPT = {
    "INPATIENT": 9201,
    "OUTPATIENT": 9202,
    "EMERGENCY": 9203,
    "AMBULATORY": 9202,
    "WELLNESS": 9202,
}

US_STATES = (
    "AL AK AZ AR CA CO CT DE FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ "
    "NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY"
).split()
PLAN_TYPES = ["HMO", "PPO", "EPO", "HDHP", "POS"]
METAL_LEVELS = ["Bronze", "Silver", "Gold", "Platinum"]
RELATIONS = ["Self", "Spouse", "Child", "Domestic Partner"]


def _rows(text: str) -> list[list[str]]:
    return [line.split(",") for line in text.strip().splitlines()]


def prefix_categories() -> list[tuple[str, str]]:
    return [(prefix, category) for prefix, category in _rows(ICD10_PREFIX_CATEGORY)]


def hcc_rows() -> list[tuple[str, str, str, float, str]]:
    return [(c, d, h, float(w), g) for c, d, h, w, g in _rows(ICD10_HCC)]


def concept_rows() -> list[tuple[str, int, int]]:
    return [(c, int(a), int(b)) for c, a, b in _rows(ICD10_CONCEPT)]


def seed(spark: SparkSession, name: str) -> DataFrame:
    """``icd10_to_ccs``, ``icd10_codes``, ``icd10_concepts`` or one of the class maps. Built as
    a local relation, so Spark knows the size and broadcasts it by its own rule."""
    maps = {
        "gender": GENDER_CONCEPT,
        "race": RACE_CONCEPT,
        "ethnicity": ETHNICITY_CONCEPT,
        "visit_class": VISIT_CLASS_CONCEPT,
    }
    if name == "icd10_to_ccs":
        rows, schema = prefix_categories(), "icd10_prefix string, ccs_category string"
    elif name == "icd10_codes":
        rows = hcc_rows()
        schema = "icd10_code string, description string, hcc_code string, hcc_weight double, category string"
    elif name == "icd10_concepts":
        rows, schema = concept_rows(), "icd10_code string, concept_id long, source_concept_id long"
    else:
        rows, schema = list(maps[name].items()), "source string, concept_id int"
    names = [column.split()[0] for column in schema.split(", ")]
    return spark.createDataFrame(pd.DataFrame(rows, columns=names), schema)
