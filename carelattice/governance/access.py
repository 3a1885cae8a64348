"""Role policies, batch access decisions, governed reads, access auditing."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelattice.functions.columns import surrogate_id
from carelattice.governance.phi import REGISTRY, is_envelope
from carelattice.sources.tables import AppendCounter

# Role | actions | purposes | field patterns.
POLICIES = """
admin | read write export deidentify key_rotation | * | all
clinician | read | clinical_care quality_improvement research_consented | person.* visit.* condition.* drug.* measurement.* vitals.*
data_scientist | read deidentify | model_training model_evaluation research_export | omcdm_*
analyst | read | clinical_care research_export quality_improvement billing | mart_* omcdm_*
service | read write | * | all
model | read | clinical_care model_inference | person.* visit.* measurement.* vitals.*
viewer | read | clinical_care | mart_*
"""


def pattern_regex(pattern: str) -> str:
    """Glob to an anchored regex; the dot of ``person.*`` is required."""
    if pattern == "all":
        return "^.*$"
    return "^" + re.escape(pattern).replace(r"\*", ".*") + "$"


def policy_rows() -> list[tuple[str, list[str], list[str], list[str]]]:
    out = []
    for line in POLICIES.strip().splitlines():
        role, actions, purposes, fields = (part.split() for part in line.split("|"))
        out.append((role[0], actions, purposes, [pattern_regex(p) for p in fields]))
    return out


def policies(spark: SparkSession) -> DataFrame:
    schema = "role string, actions array<string>, purposes array<string>, patterns array<string>"
    return spark.createDataFrame(policy_rows(), schema)


def evaluate_access(requests: DataFrame) -> DataFrame:
    """Adds allow, reason (a code), fields_asked and filtered_fields to rows with role, action,
    purpose and fields (array). The first failing rule decides; an unknown role is denied."""
    known = F.broadcast(policies(requests.sparkSession))  # one row per role, fixed
    rows = requests.join(known, "role", "left")
    permitted = F.filter(
        "fields", lambda f: F.exists("patterns", lambda p: F.regexp_like(f, p))
    )
    anything = F.array_contains("purposes", "*")
    asked = F.coalesce(F.size("fields"), F.lit(0))
    open_request = asked <= 0
    rules = [
        (F.col("actions").isNull(), False, "role_unknown"),
        (~F.array_contains("actions", F.col("action")), False, "action_denied"),
        (~(anything | F.array_contains("purposes", F.col("purpose"))), False, "purpose_denied"),
        (open_request, True, "no_fields_named"),
        (F.size("_permitted") == 0, False, "fields_denied"),
    ]
    allow, reason = None, None
    for test, verdict, code in rules:
        test = F.coalesce(test, F.lit(True))
        allow = F.when(test, verdict) if allow is None else allow.when(test, verdict)
        reason = F.when(test, code) if reason is None else reason.when(test, code)
    decided = rows.withColumn("_permitted", permitted).withColumns({
        "allow": allow.otherwise(True), "reason": reason.otherwise("fields_granted"),
    })
    seen = F.when(F.col("allow") & ~open_request, F.col("_permitted")).otherwise(F.array().cast("array<string>"))
    return decided.withColumn("filtered_fields", seen).select(
        *requests.columns, "allow", "reason", asked.alias("fields_asked"), "filtered_fields"
    )


def allowed_fields(role: str, action: str, purpose: str, fields: Sequence[str]) -> list[str]:
    """The same decision for one request on the driver, over a handful of column names."""
    policy = {r: rest for r, *rest in policy_rows()}.get(role)
    if policy is None:
        return []
    actions, purposes, patterns = policy
    if action not in actions or not ("*" in purposes or purpose in purposes):
        return []
    return [f for f in fields if any(re.match(p, f) for p in patterns)]


def governed_read(
    df: DataFrame, table: str, actor_id: str, role: str, purpose: str, *, at: Column,
    audit_path: str | None = None, mask: bool = False, sink: AppendCounter | None = None,
) -> DataFrame:
    """Only the columns the role may read for the purpose; the rest dropped, or NULL with
    ``mask``. Writes one audit row."""
    paths = [f"{table}.{c}" for c in df.columns]
    visible = {p.split(".", 1)[1] for p in allowed_fields(role, "read", purpose, paths)}
    if audit_path:
        row = audit_event(
            df.sparkSession, actor_id=actor_id, action="read", resource_type="table", resource_id=table,
            fields=[f"{table}.{c}" for c in df.columns if c in visible], purpose=purpose,
            outcome="success" if visible else "denied", at=at,
        )
        (sink or AppendCounter()).append(row, audit_path)
    if not visible:
        raise PermissionError(f"role '{role}' may not read {table} for '{purpose}'")
    if mask:
        return df.select(*[
            F.col(c) if c in visible else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in df.columns
        ])
    return df.select(*[c for c in df.columns if c in visible])


# ---- audit ---------------------------------------------------------------------------------

AUDIT_COLUMNS = [
    "audit_id", "timestamp", "actor_id", "actor_type", "action", "resource_type", "resource_id",
    "fields", "purpose", "outcome", "context",
]


def audit_event(
    spark: SparkSession, *, actor_id: str, action: str, resource_type: str, resource_id: str = "",
    fields: Sequence[str] = (), purpose: str = "", outcome: str = "success",
    actor_type: str = "service", at: Column, context: dict[str, str] | None = None,
) -> DataFrame:
    """One audit row. The id is derived from the content, so a retried append is recognisable."""
    entries = [F.lit(x) for pair in (context or {}).items() for x in pair]
    names = F.array(*[F.lit(f) for f in fields]) if fields else F.array().cast("array<string>")
    columns = {
        "timestamp": at.cast("timestamp"), "actor_id": F.lit(actor_id), "actor_type": F.lit(actor_type),
        "action": F.lit(action), "resource_type": F.lit(resource_type), "resource_id": F.lit(resource_id),
        "fields": names, "purpose": F.lit(purpose), "outcome": F.lit(outcome),
        "context": F.create_map(*entries) if entries else F.create_map().cast("map<string,string>"),
    }
    row = spark.range(1).select(*[v.alias(k) for k, v in columns.items()])
    key = surrogate_id("timestamp", "actor_id", "action", "resource_id", F.array_join("fields", ","))
    return row.withColumn("audit_id", key.cast("string")).select(*AUDIT_COLUMNS)


def audit_csv(audit: DataFrame) -> DataFrame:
    """Export form: fields as comma text, context as JSON."""
    return audit.withColumns({"fields": F.array_join("fields", ","), "context": F.to_json("context")})


def audit_query(audit: DataFrame, *, actor_id: str | None = None, resource_id: str | None = None,
                since: Column | None = None, limit: int = 100, ts: str = "timestamp") -> DataFrame:
    rows = audit
    if actor_id:
        rows = rows.filter(F.col("actor_id") == actor_id)
    if resource_id:
        rows = rows.filter(F.col("resource_id") == resource_id)
    if since is not None:
        rows = rows.filter(F.col(ts) >= since)
    return rows.orderBy(F.col(ts).desc(), "audit_id").limit(limit)


def audit_rollup(audit: DataFrame, since: Column, ts: str = "timestamp") -> DataFrame:
    """Accesses per resource, actor and field since a moment. Equal rows collapse before the
    fields are spread out."""
    rows = audit.filter(F.col(ts) >= since).groupBy("resource_id", "actor_id", "action", "outcome", "fields").agg(
        F.count(F.lit(1)).alias("n"), F.max(ts).alias("last")
    )
    spread = rows.withColumn("field", F.explode_outer("fields"))
    return spread.groupBy("resource_id", "actor_id", "field").agg(
        F.sum("n").alias("accesses"),
        F.sum(F.when(F.col("outcome") == "denied", F.col("n")).otherwise(0)).alias("denied"),
        F.max("last").alias("last_access"),
    )


# Field names that count as protected wherever they occur.
PHI_NAMES = ["patient_id", "encounter_id", "device_id", "person_id", "mrn", "ssn", "birth_datetime", "phone", "email"]


def phi_fields_present(value: Column) -> Column:
    """Paths of the encrypted protected fields in a JSON message, at any depth: one step a level, and no
    message has more levels than braces."""
    kind = "array<struct<path:string,name:string,value:string>>"

    def fields_of(text: Column, prefix: Column) -> Column:
        entries = F.coalesce(
            F.map_entries(F.from_json(text, "map<string,string>")), F.array().cast("array<struct<key:string,value:string>>"))
        return F.transform(entries, lambda e: F.struct(
            F.concat(prefix, e["key"]).alias("path"), e["key"].alias("name"), e["value"].alias("value")))

    def deeper(found: Column, _: Column) -> Column:
        objects = F.filter(F.element_at(found, -1), lambda e: e["value"].startswith("{") & ~is_envelope(e["value"]))
        below = F.flatten(F.transform(objects, lambda e: fields_of(e["value"], F.concat(e["path"], F.lit("."))))).cast(kind)
        return F.concat(found, F.array(below))

    top = fields_of(value, F.lit("")).cast(kind)
    braces = F.length(value) - F.length(F.replace(value, F.lit("{"), F.lit("")))
    levels = F.sequence(F.lit(1), F.greatest(F.coalesce(braces, F.lit(1)), F.lit(1)))
    every = F.aggregate(levels, F.array(top), deeper, F.flatten)
    protected = F.filter(
        every, lambda f: (f["path"].isin(list(REGISTRY)) | f["name"].isin(PHI_NAMES)) & is_envelope(f["value"]))
    return F.transform(protected, lambda f: f["path"])


def phi_access_audit(messages: DataFrame, actor_id: str, purpose: str = "clinical_care") -> DataFrame:
    """One audit row per message that carries encrypted protected fields."""
    # The one-element explode keeps the filter above the search: pushed down, it would search, and make the message, again.
    fields = F.explode(F.array(phi_fields_present(F.col("value").cast("string"))))
    found = messages.withColumn("fields", fields).filter(F.size("fields") > 0)
    context = F.create_map(
        F.lit("partition"), F.col("partition").cast("string"), F.lit("offset"), F.col("offset").cast("string"),
        F.lit("key"), F.col("key"),
    )
    return found.select(
        surrogate_id(F.lit(actor_id), "topic", "partition", "offset").cast("string").alias("audit_id"),
        "timestamp", F.lit(actor_id).alias("actor_id"), F.lit("service").alias("actor_type"),
        F.lit("read").alias("action"), F.lit("topic").alias("resource_type"), F.col("topic").alias("resource_id"),
        "fields", F.lit(purpose).alias("purpose"), F.lit("success").alias("outcome"), context.alias("context"),
    )
