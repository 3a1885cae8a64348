"""Safe Harbor de-identification as column rewrites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DateType, StringType, StructType, TimestampNTZType, TimestampType

from carelattice.functions.columns import age

# Default salts, column groups.
SALT = "deid-2026-06"
DROPPED = "phone fax email ssn health_plan_number account_number cert_number license_number url".split()
NAMES = ("name", "first_name", "last_name", "full_name")
ZIPS = ("zip", "zip_code", "postal_code")
STREETS = ("address_1", "address_2", "street")
CONTACTS = ("phone", "fax", "email")
IDENTIFIERS = ("mrn", "ssn", "health_plan_number", "account_number", "cert_number", "license_number", "device_id")
ADDRESSES = ("ip", "ip_address", "src_ip", "dst_ip")
FREE_TEXT = ("location", "geocoordinates", "free_text", "notes")
IPV4 = r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$"


def pseudonym(value: Column, salt: str | Column = SALT) -> Column:
    """Surrogate that is equal for equal values under one salt. Pass the salt as a column (a
    scalar subquery) to keep it out of the plan."""
    salt = F.lit(salt) if isinstance(salt, str) else salt
    digest = F.sha2(F.concat(salt, F.lit("::"), value.cast("string")), 256)
    return F.concat(F.lit("DH_"), F.substring(digest, 1, 16))


def redact_zip(value: Column, mode: str = "safe") -> Column:
    """``safe`` keeps three digits. ``parity`` keeps two and masks three, and keeps a ZIP+4
    suffix. A code shorter than five becomes 00000."""
    if mode == "parity":
        suffix = F.when(value.contains("-"), F.concat(F.lit("-"), F.regexp_extract(value, "-(.*)$", 1)))
        kept = F.concat(F.substring(value, 1, 2), F.lit("***"), F.coalesce(suffix, F.lit("")))
    else:
        kept = F.substring(value, 1, 3)
    return F.when(value.isNull() | (value == ""), None).when(F.length(value) < 5, "00000").otherwise(kept)


def generalize_age(born: Column, as_of: Column) -> Column:
    return F.least(age(born.try_cast("date"), as_of, "rounded"), F.lit(90))


def date_to_year(value: Column) -> Column:
    return F.year(value.try_cast("timestamp"))


def zero_last_octet(value: Column) -> Column:
    return F.when(value.rlike(IPV4), F.regexp_replace(value, r"\.[0-9]+$", ".0")).otherwise(value)


def _null_like(df: DataFrame, name: str) -> Column:
    return F.lit(None).cast(df.schema[name].dataType).alias(name)


def deidentify_person(df: DataFrame, as_of: Column, salt: str | None = None) -> DataFrame:
    """Names and record numbers hashed, birth date and contacts removed, year of birth capped
    at the year ninety years before ``as_of``."""
    changes: dict[str, Column] = {}
    for name in df.columns:
        if name == "name":
            changes[name] = pseudonym(F.col(name), salt or "person-name")
        elif name == "mrn":
            masked = pseudonym(F.col(name), salt or "mrn")
            changes[name] = F.when(F.coalesce(F.col(name), F.lit("")) != "", masked).otherwise(F.col(name))
        elif name == "birth_datetime" or name in DROPPED:
            changes[name] = _null_like(df, name)
        elif name == "year_of_birth":
            changes[name] = F.greatest(F.col(name), F.year(as_of) - 90)
    return df.withColumns(changes)


def deidentify_visit(df: DataFrame) -> DataFrame:
    """Visit times become years; the surrogate visit id stays."""
    out = df
    for name in ("visit_start_datetime", "visit_end_datetime"):
        if name in df.columns:
            out = out.withColumn(name.replace("_datetime", "_year"), date_to_year(F.col(name)))
            out = out.withColumn(name, _null_like(df, name))
    return out


def deidentify_events(df: DataFrame) -> DataFrame:
    """Device and patient ids hashed, free text and places removed, readings kept. Stateless,
    so it works on a stream."""
    changes: dict[str, Column] = {}
    for name, salt in (("device_id", "iot-device"), ("patient_id", "iot-patient")):
        if name in df.columns:
            changes[name] = F.when(F.col(name) != "", pseudonym(F.col(name), salt)).otherwise(F.col(name))
    for name in FREE_TEXT:
        if name in df.columns:
            changes[name] = _null_like(df, name)
    return df.withColumns(changes)


def deidentify(df: DataFrame, salt: str = SALT, zip_mode: str = "safe") -> DataFrame:
    """Any table by column name, into structs and arrays of structs."""

    def rewrite(value: Column, name: str, kind: DataType) -> Column:
        low = name.lower()
        if isinstance(kind, StructType):
            parts = [rewrite(value[f.name], f.name, f.dataType).alias(f.name) for f in kind.fields]
            return F.when(value.isNotNull(), F.struct(*parts))
        if isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType):
            return F.transform(value, lambda v: rewrite(v, name, kind.elementType))
        if low in NAMES:
            return pseudonym(value, f"{salt}-name")
        if low in ZIPS:
            return redact_zip(value.cast("string"), zip_mode)
        if low in STREETS or low in CONTACTS:
            return F.lit(None).cast(kind)
        if low in IDENTIFIERS:
            return pseudonym(value, f"{salt}-{low}")
        if low.endswith(("_datetime", "_date")):
            if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
                return F.year(value)
            return date_to_year(value) if isinstance(kind, StringType) else F.lit(None).cast("int")
        if low in ADDRESSES and isinstance(kind, StringType):
            return zero_last_octet(value)
        return value

    return df.select(*[rewrite(F.col(f.name), f.name, f.dataType).alias(f.name) for f in df.schema.fields])
