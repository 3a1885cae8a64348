"""Personal data: base patterns, and more spans by weak supervision.

Base kinds are found by their rules (leftmost, not overlapping, failing matches dropped). Other
candidates are the pieces between blanks and quotes that hold a digit or an @. Labelers (shape,
entropy and context rules; there is no gazetteer) vote on each candidate: personal (1), not (-1), or no opinion (0).
Expectation-maximisation over all candidates of the corpus estimates each labeler's reliability (votes
independent given the class); the posteriors train a logistic span classifier, which decides on
every candidate that overlaps no base span. Spark counts (votes, features) per batch and sums
them, so the driver receives at most one row per combination of votes (3**7) and feature levels.

Defined results: null and empty texts have no spans; positions are code points, end exclusive;
without candidates no classifier is trained and no span added; a repeated row counts as often as it
occurs; clashing columns are replaced. Texts are read whole; only those that hold a digit or an @
are searched.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from carelattice.llm.frames import append

BASE = ("email", "ip", "card", "phone")
ADDED = ("secret", "number", "handle")
LABELERS = ("base", "token", "digits", "named", "assigned", "harmless", "random")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_PIECE = re.compile(r"[^\s\"'<>|,;()=]+")
_TOKEN = re.compile(r"(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])[A-Za-z0-9_+/-]{20,}")
_NAMED = re.compile(r"(?i)\b(token|key|secret|password|passwd|pwd|api|auth|ssn|passport|phone|tel|mail|email|card|account|iban|login|user)\b[^\n]{0,12}$")
_HARMLESS = re.compile(r"(?i)\b(version|license|chapter|page|section|figure|table|vol|no|part|line|step)\b\.?\s*$")


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def _luhn(number: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(number)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of [A-Za-z0-9._%+-]+@ and a domain, found from each @ (a match holds just one)."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """All base spans, by kind as listed, then by start."""
    found = [("email", *span) for span in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        number = _digits(m[0])
        if 16 <= len(number) <= 19 and _luhn(number):
            found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int, bool]]:
    """Base spans, and pieces with a digit or an @ that overlap none."""
    taken = sorted({(a, z) for _, a, z in base})
    out, at = [(a, z, True) for a, z in taken], 0
    for m in _PIECE.finditer(text):
        if not any(c.isdigit() or c == "@" for c in m[0]):
            continue
        a, z = m.span()
        while z > a and text[z - 1] in ".!?:*$%&#":
            z -= 1
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        near = taken[max(at - 8, 0):at + 8]
        if z > a and not any(s < z and a < e for s, e in near):
            out.append((a, z, False))
    return out


def votes_and_features(text: str, a: int, z: int, is_base: bool) -> tuple[tuple[int, ...], tuple[float, ...]]:
    piece, before = text[a:z], text[max(0, a - 32):a]
    size, digits = z - a, sum(c.isdigit() for c in piece)
    counts = Counter(piece[:256])
    shown = min(size, 256)
    entropy = -sum(n / shown * math.log2(n / shown) for n in counts.values())
    named = bool(_NAMED.search(before))
    assigned = bool(re.search(r"[=:]\s*[\"']?$", before))
    harmless = bool(_HARMLESS.search(before)) or text[z:z + 1] == "%"
    votes = (
        int(is_base),
        int(bool(_TOKEN.fullmatch(piece))),
        1 if digits >= 7 and digits * 10 >= size * 6 else -1 if digits <= 4 and "@" not in piece else 0,
        int(named),
        int(assigned),
        -1 if harmless else 0,
        1 if entropy >= 2.5 and size >= 16 else -1 if size <= 4 else 0,
    )
    features = (
        1.0, round(min(math.log2(size + 1), 8)) / 4, round(digits / size, 1), round(min(entropy, 5)) / 3,
        float(named), float(assigned), float(harmless), float("@" in piece), float(digits >= 7),
    )
    return votes, features


def _searchable(column: pa.Array) -> np.ndarray:
    found = pc.fill_null(pc.match_substring_regex(column, "[0-9@]"), False)
    return np.flatnonzero(found.to_numpy(zero_copy_only=False))


def pattern_counts(docs: DataFrame, text_col: str = "text") -> list[tuple[tuple[int, ...], tuple[float, ...], int]]:
    """Votes and features of all candidates of the corpus with their counts."""

    def run(batches):
        for batch in batches:
            column, seen = batch.column(0), Counter()
            for i in _searchable(column):
                text = column[int(i)].as_py()
                for a, z, own in candidates(text, base_spans(text)):
                    seen[votes_and_features(text, a, z, own)] += 1
            rows = list(seen.items())
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0][0] for r in rows], pa.list_(pa.int32())),
                pa.array([r[0][1] for r in rows], pa.list_(pa.float64())),
                pa.array([r[1] for r in rows], pa.int64())], names=["votes", "features", "n"])

    counted = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "votes array<int>, features array<double>, n bigint")
    rows = counted.groupBy("votes", "features").agg(F.sum("n").alias("n")).collect()
    return sorted((tuple(r.votes), tuple(r.features), r.n) for r in rows)


def expectation_maximisation(votes: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of the personal class for each row, and P(vote | class) as (class, labeler, vote + 1).

    Starts from the votes' majority; one pseudo-count a vote keeps all probabilities positive.
    """
    posterior = np.clip(0.5 + 0.45 * np.sign(votes.sum(1)), 0.05, 0.95)
    reliability = np.zeros((2, votes.shape[1], 3))
    for _ in range(rounds):
        for c, share in enumerate((1 - posterior, posterior)):
            for v in (-1, 0, 1):
                reliability[c, :, v + 1] = 1 + (weight * share) @ (votes == v)
        reliability /= reliability.sum(2, keepdims=True)
        prior = (1 + weight @ posterior) / (2 + weight.sum())
        score = np.log(prior / (1 - prior))
        lift = np.log(reliability[1] / reliability[0])
        for v in (-1, 0, 1):
            score = score + (votes == v) @ lift[:, v + 1]
        posterior = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    return posterior, reliability


def logistic(features: np.ndarray, target: np.ndarray, weight: np.ndarray, ridge: float = 0.02, rounds: int = 25) -> np.ndarray:
    """Weights of a ridge logistic regression on soft targets, by Newton's method."""
    w = np.zeros(features.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        gradient = features.T @ (weight * (p - target)) + ridge * w
        curve = (features * (weight * p * (1 - p) + 1e-9)[:, None]).T @ features + ridge * np.eye(len(w))
        w = w - np.linalg.solve(curve, gradient)
    return w


def train(docs: DataFrame, text_col: str = "text") -> np.ndarray | None:
    """Weights of the span classifier, or None if the corpus holds no candidate."""
    rows = pattern_counts(docs, text_col)
    if not rows:
        return None
    votes, features, n = (np.array([r[k] for r in rows], float) for k in range(3))
    posterior, _ = expectation_maximisation(votes, n)
    return logistic(features, posterior, n)


def find_spans(text: str, model: np.ndarray | None) -> tuple[list, list]:
    """Base spans, and the spans that the classifier adds (by kind, then start)."""
    base = base_spans(text)
    if model is None:
        return base, []
    added = []
    for a, z, own in candidates(text, base):
        if not own and float(np.dot(votes_and_features(text, a, z, own)[1], model)) >= 0:
            piece = text[a:z]
            kind = "handle" if "@" in piece else "secret" if any(c.isalpha() for c in piece) else "number"
            added.append((kind, a, z))
    return base, sorted(added, key=lambda s: (ADDED.index(s[0]), s[1]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{z}" for kind, a, z in spans)


SPAN = "kind string, start int, end int"


def detect(docs: DataFrame, model: np.ndarray | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``added``: arrays of (kind, start, end)."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    as_rows = lambda spans: [{"kind": k, "start": a, "end": z} for k, a, z in spans]

    def run(column: pa.Array) -> dict:
        base, added = [[]] * len(column), [[]] * len(column)
        for i in _searchable(column):
            found = find_spans(column[int(i)].as_py(), model)
            base[i], added[i] = as_rows(found[0]), as_rows(found[1])
        return {"base": pa.array(base, kind), "added": pa.array(added, kind)}

    return append(docs, text_col, f"base array<struct<{SPAN.replace(' ', ':').replace(',:', ',')}>>, added array<struct<{SPAN.replace(' ', ':').replace(',:', ',')}>>", run)


def digests(docs: DataFrame, model: np.ndarray | None, text_col: str = "text") -> DataFrame:
    """``docs`` (without the text) with counts per base kind, a digest of the base spans, and all spans as text."""

    def run(column: pa.Array) -> dict:
        n = len(column)
        counts = {k: np.zeros(n, np.int64) for k in BASE}
        empty = hashlib.sha256(b"").hexdigest()
        digest, spans = [empty] * n, [""] * n
        for i in _searchable(column):
            base, added = find_spans(column[int(i)].as_py(), model)
            for kind, _, _ in base:
                counts[kind][i] += 1
            digest[i], spans[i] = hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + added)
        return {**{f"n_{k}": v for k, v in counts.items()}, "base_sha256": digest, "spans": spans}

    fields = ", ".join(f"n_{k} bigint" for k in BASE) + ", base_sha256 string, spans string"
    return append(docs, text_col, fields, run)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with each span replaced by its kind; of overlapping spans the union gets the first one's kind."""
    out, at = [], 0
    for kind, a, z in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, z)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, model: np.ndarray | None, text_col: str = "text") -> DataFrame:
    """``docs`` with all spans in the text masked (a null text stays null); other columns as they are."""

    def run(column: pa.Array) -> dict:
        texts = column.to_pylist()
        for i in _searchable(column):
            base, added = find_spans(texts[i], model)
            texts[i] = masked(texts[i], base + added)
        return {text_col: pa.array(texts, pa.string())}

    return append(docs, text_col, f"`{text_col}` string", run).select([F.col(f"`{c}`") for c in docs.columns])
