"""RAW -> MART cleaning (C1-C8) of purchases and customers.

The rule list (duplicates, NULL check, empty-value check, date check,
case normalisation) is fixed; which columns each rule covers, how a document is
flattened to a RAW row and how a RAW row becomes a mart row is one ``Cleaning``
per table (ASSUMPTION, as no column list exists for it). All of it works on
batch and streaming input; only ``clean`` (which drops duplicates) is batch.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.functions import time as T
from shoplens.functions.text import is_blank, strip
from shoplens.operators.dedup import keep_max

REJECT_ORDER = ("null", "blank", "bad_date", "future", "birth_after_registration")


@dataclass(frozen=True)
class Cleaning:
    key: tuple[str, ...]
    required: tuple[str, ...]          # C2: must not be NULL
    required_text: tuple[str, ...]     # C3: must not be empty after strip
    timestamp: str                     # C4: must parse and be <= as_of
    case_columns: tuple[str, ...]      # C5: lower(strip(.))
    flatten: tuple[str, ...]           # document -> RAW row
    mart: tuple[str, ...]              # RAW row -> mart row; {ts} is the parsed timestamp
    latest: str                        # mart column that decides between copies
    birth_date: str | None = None      # C4: must parse and lie before the timestamp, if given
    timestamp_format: str = field(default=T.ISO_Z_FORMAT)


PURCHASE_RULES = Cleaning(
    key=("purchase_id",),
    required=("purchase_id", "customer_id", "store_id", "purchase_datetime", "total_amount"),
    required_text=("purchase_id", "customer_id", "store_id", "payment_method", "purchase_datetime"),
    timestamp="purchase_datetime",
    case_columns=("payment_method",),
    flatten=("CAST(purchase_id AS STRING) AS purchase_id", "customer.customer_id AS customer_id",
             "store.store_id AS store_id", "CAST(purchase_datetime AS STRING) AS purchase_datetime",
             "CAST(total_amount AS DOUBLE) AS total_amount", "CAST(payment_method AS STRING) AS payment_method",
             "is_delivery"),
    mart=("CAST(purchase_id AS STRING) AS purchase_id", "CAST(customer_id AS STRING) AS customer_id",
          "CAST(store_id AS STRING) AS store_id", "{ts} AS purchase_datetime",
          "CAST(total_amount AS DOUBLE) AS total_amount", "CAST(payment_method AS STRING) AS payment_method",
          "coalesce(CAST(is_delivery AS INT), 0) AS is_delivery"),
    latest="purchase_datetime",
)

CUSTOMER_RULES = Cleaning(
    key=("customer_id",),
    required=("customer_id", "registration_date"),
    required_text=("customer_id", "registration_date"),
    timestamp="registration_date",
    case_columns=("gender", "preferred_language"),
    flatten=("CAST(customer_id AS STRING) AS customer_id", "CAST(registration_date AS STRING) AS registration_date",
             "CAST(birth_date AS STRING) AS birth_date", "CAST(gender AS STRING) AS gender",
             "CAST(preferences.preferred_language AS STRING) AS preferred_language", "is_loyalty_member"),
    mart=("CAST(customer_id AS STRING) AS customer_id", "{ts} AS registration_dt",
          "coalesce(CAST(is_loyalty_member AS INT), 0) AS is_loyalty_member"),
    latest="registration_dt",
    birth_date="birth_date",
)


def _any(cols) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | c
    return out


def null_violation(rules: Cleaning) -> Column:
    return _any(F.col(c).isNull() for c in rules.required)


def blank_violation(rules: Cleaning) -> Column:
    return _any(F.coalesce(is_blank(F.col(c)), F.lit(False)) for c in rules.required_text)


def parsed_ts(rules: Cleaning) -> Column:
    return F.try_to_timestamp(F.col(rules.timestamp), F.lit(rules.timestamp_format))


def date_violation(rules: Cleaning) -> Column:
    bad = parsed_ts(rules).isNull()
    if rules.birth_date:
        bad = bad | (F.col(rules.birth_date).isNotNull() & T.parse_date(F.col(rules.birth_date)).isNull())
    return bad


def future_violation(rules: Cleaning, as_of) -> Column:
    return F.coalesce(parsed_ts(rules) > T.as_of_col(as_of), F.lit(False))


def birth_violation(rules: Cleaning) -> Column:
    if not rules.birth_date:
        return F.lit(False)
    return F.coalesce(T.parse_date(F.col(rules.birth_date)) >= F.to_date(parsed_ts(rules)), F.lit(False))


def reject_reason(rules: Cleaning, as_of) -> Column:
    """First failing check, in the order of REJECT_ORDER."""
    checks = (null_violation(rules), blank_violation(rules), date_violation(rules), future_violation(rules, as_of),
              birth_violation(rules))
    return F.coalesce(*[F.when(check, F.lit(name)) for check, name in zip(checks, REJECT_ORDER)])


def check_null(df: DataFrame, rules: Cleaning = PURCHASE_RULES) -> DataFrame:
    """Rows with a NULL required column."""
    return df.where(null_violation(rules))


def check_blank(df: DataFrame, rules: Cleaning = PURCHASE_RULES) -> DataFrame:
    """Rows with an empty (after strip) required text column."""
    return df.where(blank_violation(rules))


def check_dates(df: DataFrame, as_of, rules: Cleaning = PURCHASE_RULES) -> DataFrame:
    """C4: rows whose dates do not parse, lie after ``as_of`` or contradict each other."""
    return df.where(date_violation(rules) | future_violation(rules, as_of) | birth_violation(rules))


def normalize_case(df: DataFrame, rules: Cleaning = PURCHASE_RULES) -> DataFrame:
    """lower(strip(c)) on code-like columns; names and hashes untouched."""
    return df.withColumns({c: F.lower(strip(F.col(c))) for c in rules.case_columns})


def flatten(docs: DataFrame, rules: Cleaning = PURCHASE_RULES) -> DataFrame:
    """Documents -> RAW rows (dates kept as text) for the checks. A struct or
    field that the documents lack is NULL."""
    have = set(docs.columns)
    missing = {c: F.lit(None).cast(t) for c, t in (
        ("birth_date", "string"), ("gender", "string"), ("preferences", "struct<preferred_language: string>"))
        if rules is CUSTOMER_RULES and c not in have}
    return docs.withColumns(missing).selectExpr(*rules.flatten)


def to_mart(raw: DataFrame, rules: Cleaning = PURCHASE_RULES) -> DataFrame:
    """RAW rows in mart columns and types."""
    ts = f"try_to_timestamp({rules.timestamp}, \"{rules.timestamp_format}\")"
    return normalize_case(raw, rules).selectExpr(*[x.format(ts=ts) for x in rules.mart])


def with_reasons(raw: DataFrame, as_of, rules: Cleaning = PURCHASE_RULES) -> DataFrame:
    return raw.withColumn("reject_reason", reject_reason(rules, as_of))


def accepted(raw: DataFrame, as_of, rules: Cleaning = PURCHASE_RULES) -> DataFrame:
    """C2-C5 without dedup: valid rows in mart types."""
    return to_mart(raw.where(reject_reason(rules, as_of).isNull()), rules)


def rejected(raw: DataFrame, as_of, rules: Cleaning = PURCHASE_RULES) -> DataFrame:
    """RAW rows that fail a check, with the first failing check."""
    return with_reasons(raw, as_of, rules).where(F.col("reject_reason").isNotNull())


def deduplicated(mart: DataFrame, rules: Cleaning = PURCHASE_RULES) -> DataFrame:
    """The latest copy per key (keys are required, hence not NULL)."""
    return keep_max(mart, rules.key, [rules.latest], keep_null_keys=False)


def clean(raw: DataFrame, as_of, rules: Cleaning = PURCHASE_RULES) -> tuple[DataFrame, DataFrame]:
    """(mart, rejects). Checks -> case -> dedup (latest per key).

    Accepted rows before dedup plus rejects equal the input.
    """
    return deduplicated(accepted(raw, as_of, rules), rules), rejected(raw, as_of, rules)


def customers_mart(docs: DataFrame) -> DataFrame:
    """Customer documents -> mart columns (rename, parse, bool -> int)."""
    return to_mart(flatten(docs, CUSTOMER_RULES), CUSTOMER_RULES)


def purchases_mart(docs: DataFrame) -> DataFrame:
    """Purchase documents -> mart columns (nested ids to top level)."""
    return to_mart(flatten(docs, PURCHASE_RULES), PURCHASE_RULES)
