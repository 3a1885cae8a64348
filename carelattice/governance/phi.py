"""Column encryption of protected fields by registry.

Keys reach executors as one-row tables read through scalar subqueries, so no key is ever a
literal in a plan. Envelopes are JSON: v, kid, iv, ct (ct ends with the 16-byte tag), and
deterministic where it applies. Additional authenticated data is never stored: it is the
registry path, known to whoever may decrypt.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NumericType, StringType, StructType

from carelattice.operators.quality import Check, evaluate

ENVELOPE_VERSION = 1
IV_BYTES = 12
ENVELOPE = "v int, kid string, iv string, ct string, deterministic boolean"

# Path, category, encryption mode, removable under Safe Harbor.
PHI_FIELDS = """
person.person_id identifier deterministic yes
person.mrn identifier deterministic yes
person.birth_datetime date random yes
person.year_of_birth date none yes
person.gender_concept_id other none yes
person.race_concept_id other none yes
location.address_1 geographic random yes
location.city geographic none no
location.state geographic none yes
location.zip geographic deterministic yes
person.phone contact random yes
person.email contact random yes
visit.admit_time date random no
visit.discharge_time date random no
iot.device_id device_id deterministic yes
iot.firmware_version device_id none yes
event.patient_id identifier deterministic yes
event.encounter_id identifier deterministic yes
event.device_id device_id deterministic yes
event.mrn identifier deterministic yes
provider.npi identifier deterministic yes
provider.name name random yes
"""


@dataclass(frozen=True)
class PhiField:
    path: str
    category: str
    mode: str
    safe_harbor: bool


def registry() -> dict[str, PhiField]:
    out = {}
    for line in PHI_FIELDS.strip().splitlines():
        path, category, mode, safe = line.split()
        out[path] = PhiField(path, category, mode, safe == "yes")
    return out


REGISTRY = registry()


def fields_under(prefix: str) -> list[PhiField]:
    return [f for path, f in REGISTRY.items() if path.startswith(prefix)]


class Keyring:
    """AES-256 keys by id, held in a one-row table. ``current`` encrypts."""

    def __init__(self, spark: SparkSession, keys: Mapping[str, bytes | str], current: str):
        if current not in keys:
            raise KeyError(current)
        raw = {kid: base64.b64decode(k) if isinstance(k, str) else bytes(k) for kid, k in keys.items()}
        if not all(re.fullmatch(r"[A-Za-z0-9_.-]+", kid) for kid in raw):
            raise ValueError("key ids may hold letters, digits, _ . -")
        if any(len(k) != 32 for k in raw.values()):
            raise ValueError("keys must have 32 bytes")
        self.ids = list(raw)
        self.current = current
        names = ", ".join(f"k{i} binary" for i in range(len(raw)))
        row = pd.DataFrame([list(raw.values())], columns=[f"k{i}" for i in range(len(raw))])
        self._table = spark.createDataFrame(row, names)  # a local relation: read without a job

    def key(self, kid: str | None = None) -> Column:
        place = self.ids.index(kid or self.current)
        return self._table.select(f"k{place}").scalar()

    def by_id(self, kid: Column) -> Column:
        """The key for a column of key ids; NULL for an unknown id."""
        out = F.lit(None).cast("binary")
        for known in self.ids:
            out = F.when(kid == known, self.key(known)).otherwise(out)
        return out


def _binary(text: Column) -> Column:
    return text.cast("binary")


def _sealed(encrypted: Column, kid: str, deterministic: bool) -> Column:
    """Envelope text of iv||ciphertext||tag. Twelve IV bytes are exactly sixteen base64
    characters, so the text is cut there: the value is encrypted once, and iv and ciphertext
    always belong together."""
    head = f'{{"v":{ENVELOPE_VERSION},"kid":"{kid}","iv":"$1","ct":"'
    tail = '","deterministic":true}' if deterministic else '"}'
    text = F.translate(F.base64(encrypted), "\r\n", "")  # base64 comes in lines of 76 characters
    return F.concat(F.regexp_replace(text, "^(.{16})", head), F.lit(tail))


def encrypt_value(value: Column, keys: Keyring, *, deterministic: bool = False, aad: str | None = None) -> Column:
    """Envelope of a scalar as text; NULL and '' pass through.

    Deterministic: the IV is the first 12 bytes of SHA-256(key || text), so equal values give
    equal, joinable envelopes."""
    text = value.cast("string")
    key = keys.key()
    iv = F.substring(F.unhex(F.sha2(F.concat(key, _binary(text)), 256)), 1, IV_BYTES) if deterministic else F.lit("").cast("binary")
    extra = F.lit((aad or "").encode()) if aad else F.lit("").cast("binary")
    encrypted = F.aes_encrypt(_binary(text), key, F.lit("GCM"), F.lit("DEFAULT"), iv, extra)
    return F.when(text.isNull() | (text == ""), text).otherwise(
        _sealed(encrypted, keys.current, deterministic)
    )


def envelope(value: Column) -> Column:
    return F.from_json(F.when(value.startswith("{"), value), ENVELOPE)


def is_envelope(value: Column) -> Column:
    good = lambda p: (p["v"] == ENVELOPE_VERSION) & p["kid"].isNotNull() & p["ct"].isNotNull()
    return F.coalesce(F.exists(F.array(envelope(value)), good), F.lit(False))  # parsed once for all three


def decrypt_value(value: Column, keys: Keyring, aad: str | None = None) -> Column:
    """Text of an envelope; NULL when the key id is unknown or the value was altered.
    Anything that is not an envelope passes through."""
    parsed = envelope(value)
    body = F.concat(F.unbase64(parsed["iv"]), F.unbase64(parsed["ct"]))
    extra = F.lit((aad or "").encode()) if aad else F.lit("").cast("binary")
    opened = F.try_aes_decrypt(body, keys.by_id(parsed["kid"]), F.lit("GCM"), F.lit("DEFAULT"), extra)
    return F.when(is_envelope(value), opened.cast("string")).otherwise(value)


def _aad(field: PhiField, bind_path: bool) -> str | None:
    """Random fields are bound to their path. Deterministic ones are not, so that the same
    identifier is joinable across tables, unless ``bind_path`` asks for it."""
    return field.path if field.mode == "random" or bind_path else None


def _rewrite(df: DataFrame, prefix: str, change: Callable[[Column, PhiField, DataType], Column]) -> DataFrame:
    """Apply ``change`` to every scalar under the registry, inside structs too."""

    def walk(value: Column, path: str, kind: DataType) -> Column:
        if isinstance(kind, StructType):
            parts = [walk(value[f.name], f"{path}.{f.name}", f.dataType).alias(f.name) for f in kind.fields]
            return F.when(value.isNotNull(), F.struct(*parts))
        field = REGISTRY.get(path)
        if field is None or field.mode == "none":
            return value
        return change(value, field, kind)

    return df.select(*[walk(F.col(f.name), f"{prefix}.{f.name}", f.dataType).alias(f.name) for f in df.schema.fields])


def _scalar(kind: DataType) -> bool:
    return isinstance(kind, (StringType, NumericType)) or kind.typeName() in ("date", "timestamp", "timestamp_ntz")


def encrypt_phi(df: DataFrame, prefix: str, keys: Keyring, *, bind_path: bool = False) -> DataFrame:
    """Replace the protected columns by envelopes. Envelopes already there stay as they are."""

    def change(value: Column, field: PhiField, kind: DataType) -> Column:
        if not _scalar(kind):
            return value
        sealed = encrypt_value(value, keys, deterministic=field.mode == "deterministic", aad=_aad(field, bind_path))
        if isinstance(kind, StringType):
            return F.when(is_envelope(value), value).otherwise(sealed)
        return sealed

    return _rewrite(df, prefix, change)


def decrypt_phi(df: DataFrame, prefix: str, keys: Keyring, *, bind_path: bool = False) -> DataFrame:
    def change(value: Column, field: PhiField, kind: DataType) -> Column:
        return decrypt_value(value, keys, _aad(field, bind_path)) if isinstance(kind, StringType) else value

    return _rewrite(df, prefix, change)


def decrypt_failures(df: DataFrame, prefix: str, keys: Keyring, *, bind_path: bool = False) -> DataFrame:
    """Envelopes per protected column that no known key opens."""
    checks = [
        Check("undecryptable", name, is_envelope(F.col(name)) & decrypt_value(F.col(name), keys, _aad(f, bind_path)).isNull())
        for name, f in _protected(df, prefix)
    ]
    return evaluate(df, prefix, checks)


def rotate_keys(df: DataFrame, prefix: str, keys: Keyring, old: str, *, bind_path: bool = False) -> DataFrame:
    """Re-encrypt envelopes of key ``old`` under the current key. Running it twice changes
    nothing more; other envelopes and plain values stay."""

    def change(value: Column, field: PhiField, kind: DataType) -> Column:
        if not isinstance(kind, StringType):
            return value
        aad = _aad(field, bind_path)
        renewed = encrypt_value(decrypt_value(value, keys, aad), keys, deterministic=field.mode == "deterministic", aad=aad)
        due = is_envelope(value) & (envelope(value)["kid"] == old)
        return F.when(due, F.coalesce(renewed, value)).otherwise(value)

    return _rewrite(df, prefix, change)


def _protected(df: DataFrame, prefix: str) -> list[tuple[str, PhiField]]:
    found = [(name, REGISTRY.get(f"{prefix}.{name}")) for name in df.columns]
    return [(name, f) for name, f in found if f is not None and f.mode != "none"]


def leak_check(df: DataFrame, prefix: str) -> DataFrame:
    """Plain values left in protected columns, as data-quality rows."""
    checks = []
    for name, _ in _protected(df, prefix):
        text = F.col(name).cast("string")
        checks.append(Check("no_plain_phi", name, text.isNotNull() & (text != "") & ~is_envelope(text), "fatal"))
    return evaluate(df, prefix, checks)
