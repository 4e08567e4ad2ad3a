"""Classification of personal data and masking."""

from __future__ import annotations

import logging
import os
import re
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.hashing import hmac_sha256
from tidemark.functions.names import snake_case

log = logging.getLogger(__name__)

LEVELS = ("none", "internal", "pii", "sensitive_pii")
SAMPLE_ROWS, MATCH_SHARE = 1000, 0.5
HASH_DIGITS, KEPT_DIGITS = 32, 4

#: What a column's name says, first match wins: (pattern, sensitivity, masking, label).
NAME_RULES = (
    (r"(ssn|social_security|passport|national_id|tax_id|cpf|cnpj|aadhaar|pan_number)", "sensitive_pii", "hash", "a number given by the state"),
    (r"(date_of_birth|birth_date|dob)", "sensitive_pii", "redact", "when somebody was born"),
    (r"(document|identity)", "sensitive_pii", "hash", "papers that identify somebody"),
    (r"(email|e_mail)", "pii", "hash", "an address for mail"),
    (r"(phone|mobile|msisdn|telephone)", "pii", "partial", "a number to call"),
    (r"(full_name|first_name|last_name|surname|_name$|^name$)", "pii", "hash", "what somebody is called"),
    (r"(street|address_line|addr_line|house_no)", "pii", "hash", "where somebody lives"),
    (r"(latitude|longitude|geo_lat|geo_lon)", "pii", "redact", "a point on the map"),
    (r"(ip_address|device_id|user_agent)", "pii", "hash", "a machine somebody uses"),
    (r"(zip|postcode|postal_code)", "internal", "none", "a delivery district"),
    (r"(city|state|province|region|country)", "internal", "none", "a town or region"),
)
#: What a column's values say, most specific first.
VALUE_RULES = (
    (r"^\d{3}\.\d{3}\.\d{3}-\d{2}$", "sensitive_pii", "hash", "a number given by the state"),
    (r"^[^@\s]+@[^@\s]+\.[A-Za-z]{2,}$", "pii", "hash", "an address for mail"),
    (r"^\+?\d[\d\s().-]{7,}\d$", "pii", "partial", "a number to call"),
)


@dataclass(frozen=True)
class Proposal:
    column: str
    sensitivity: str
    masking: str
    evidence: str


def by_name(column: str) -> Proposal | None:
    name = snake_case(column)
    return next((Proposal(column, s, m, f"its name suggests {label}") for p, s, m, label in NAME_RULES if re.search(p, name)), None)


def unicode_pattern(pattern: str) -> str:
    """A pattern with Unicode classes and a ``$`` that allows a final line break, as a Unicode-aware matcher has it."""
    return "(?U)" + pattern


def value_shares(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: for each string column ``{column}__{i}``, the share of the sampled non-empty values that match value rule i.

    The sample is the first SAMPLE_ROWS rows: a scan of names and values proposes, people decide.
    """
    texts = columns or [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and not f.name.startswith("_")]
    sample = df.select(*(F.col(f"`{c}`") for c in texts)).limit(SAMPLE_ROWS)
    share = lambda c, p: F.avg(F.when(F.col(f"`{c}`") != "", F.col(f"`{c}`").rlike(unicode_pattern(p)).cast("int")))
    return sample.agg(*(share(c, p[0]).alias(f"{c}__{i}") for c in texts for i, p in enumerate(VALUE_RULES)))


def demoted(df: DataFrame, p: Proposal) -> Proposal:
    """Only strings can be hashed or cut; other columns are redacted instead."""
    if p.masking in ("hash", "partial") and not isinstance(df.schema[p.column].dataType, T.StringType):
        return replace(p, masking="redact")
    return p


def scan(df: DataFrame) -> list[Proposal]:
    """What names and then values say; values may only raise a column's sensitivity, equal ones add evidence."""
    names = [c for c in df.columns if not c.startswith("_")]
    texts = [c for c in names if isinstance(df.schema[c].dataType, T.StringType)]
    shares = value_shares(df.select(*(F.col(f"`{c}`") for c in names)), texts).first().asDict() if texts else {}
    out = []
    for c in names:
        found = by_name(c)
        for i, (_, s, m, label) in enumerate(VALUE_RULES):
            share = shares.get(f"{c}__{i}")
            if share is None or share < MATCH_SHARE:
                continue
            text = f"{share:.0%} of its values look like {label}"
            have = LEVELS.index(found.sensitivity) if found else 0
            if LEVELS.index(s) > have:
                found = Proposal(c, s, m, text)
            elif found and LEVELS.index(s) == have:
                found = replace(found, evidence=f"{found.evidence}; {text}")
            break
        if found:
            out.append(demoted(df, found))
    return out


def masked(df: DataFrame, column: str, strategy: str, key: bytes) -> Column:
    c, kind = F.col(f"`{column}`"), df.schema[column].dataType
    if strategy == "none":
        return c
    if strategy == "redact":
        return F.lit(None).cast(kind)
    if not isinstance(kind, T.StringType):
        raise TypeError(f"{column} is {kind.simpleString()}; only strings can be masked by {strategy}")
    if strategy == "hash":
        return F.substring(hmac_sha256(c, key), 1, HASH_DIGITS)
    if strategy == "partial":
        hidden = F.greatest(F.length(c) - KEPT_DIGITS, F.lit(0))
        return F.when(F.length(c) <= KEPT_DIGITS, F.repeat(F.lit("*"), F.length(c))).otherwise(F.concat(F.repeat(F.lit("*"), hidden), F.right(c, F.lit(KEPT_DIGITS))))
    raise ValueError(f"unknown masking strategy {strategy}")


def apply_masks(df: DataFrame, policies: dict[str, str], key: bytes) -> tuple[DataFrame, list[str]]:
    """policies: column -> strategy, by raw or conformed name. Returns the masked columns' names too."""
    wanted = {snake_case(c): s for c, s in policies.items() if s != "none"}
    hit = [c for c in df.columns if snake_case(c) in wanted]
    return df.withColumns({c: masked(df, c, wanted[snake_case(c)], key) for c in hit}), hit


DEV_KEY = b"development-only-masking-key"


def masking_key(secret: str | None, environment: str) -> bytes:
    """The key a secret names, from the process environment; development falls back to a public one with a warning."""
    found = os.environ.get(secret) if secret else None
    if found:
        return found.encode()
    if environment != "development":
        raise KeyError(f"no masking key: secret {secret!r} isn't set")
    log.warning("masking with the public development key")
    return DEV_KEY
