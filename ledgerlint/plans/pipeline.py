"""The cleaning job as one lazy plan.

    raw -> drop null keys + keep one row per key (one partial aggregate)
        -> id filter -> full-name rebuild (dictionary join)
        -> every column cleaner in one projection -> typed columns

``clean_all`` runs nothing by itself (it lowers the session's limit for generated methods).  Its three branches (rows, name tokens,
name dictionaries) share the shuffle of the one-row-per-key aggregate, and the
rows stay partitioned by the key until the name join, so they shuffle once.

Steps whose input columns are missing are skipped (and listed by
``plan_steps``) instead of failing the job.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from weakref import WeakKeyDictionary

from pyspark import SparkContext

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators.names import full_name_from_dedup
from ..operators.quality import checkpoint
from ..operators.relational import dedup_by_key, drop_columns, drop_empty_rows, id_filter, typed_cast
from ..schema import CLEAN_COLUMNS, CLEAN_SCHEMA, DROPPED_COLUMNS, KEY_COLUMNS
from ..session import limit_generated_methods
from .materialize import Intermediates
from ..sources.target import load_if_new

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Options:
    """Observed behavior by default; each flag switches to the intended one."""

    dedup_keys: tuple[str, ...] = ("customer_id",)
    tiebreak: str | None = "src_row"
    null_token: str | None = "NULL"
    keep_sign: bool = False
    intended_account_type: bool = False
    intended_payment: bool = False
    zip_empty_as_null: bool = False
    # Clean is_flagged with the same word list as is_fraud instead of a plain cast.
    clean_is_flagged: bool = False
    drop_empty_rows: bool = False
    as_of: Column | None = None


# (output column, input columns, expression builder)
Step = tuple[str, tuple[str, ...], Callable[[Options], Column]]


def _steps(o: Options) -> list[Step]:
    col = F.col
    flag = (lambda _: C.clean_bool_words(col("is_flagged"))) if o.clean_is_flagged else (lambda _: C.cast_bool(col("is_flagged")))
    return [
        ("gender", ("gender",), lambda o: C.clean_gender(col("gender"), o.null_token)),
        ("first_name", ("first_name",), lambda o: C.clean_name(col("first_name"), o.null_token)),
        ("last_name", ("last_name",), lambda o: C.clean_name(col("last_name"), o.null_token)),
        ("dob", ("dob",), lambda o: C.clean_date(col("dob"))),
        ("email", ("email",), lambda o: C.clean_email(col("email"))),
        ("phone", ("phone",), lambda o: C.clean_phone(col("phone"))),
        ("state", ("state",), lambda o: C.clean_state(col("state"))),
        ("address", ("address",), lambda o: C.clean_address(col("address"))),
        ("city", ("city",), lambda o: C.clean_city(col("city"))),
        ("zip_code", ("zip_code",), lambda o: C.clean_zip(col("zip_code"), o.zip_empty_as_null)),
        ("credit_score", ("credit_score",), lambda o: C.clean_credit_score(col("credit_score"))),
        ("annual_income", ("annual_income",), lambda o: C.clean_amount(col("annual_income"), o.keep_sign)),
        ("employment_status", ("employment_status",), lambda o: C.clean_employment(col("employment_status"))),
        ("account_open_date", ("account_open_date",), lambda o: C.clean_date(col("account_open_date"))),
        ("account_type", ("account_type",), lambda o: C.clean_account_type(col("account_type"), o.intended_account_type)),
        ("account_balance", ("account_balance",), lambda o: C.clean_balance(col("account_balance"), o.keep_sign)),
        ("transaction_date", ("transaction_date",), lambda o: C.clean_date(col("transaction_date"))),
        ("transaction_amount", ("transaction_amount",), lambda o: C.clean_amount(col("transaction_amount"), o.keep_sign)),
        ("transaction_type", ("transaction_type",), lambda o: C.clean_transaction_type(col("transaction_type"))),
        ("customer_id", ("customer_id",), lambda o: C.clean_id(col("customer_id"))),
        ("transaction_id", ("transaction_id",), lambda o: C.clean_id(col("transaction_id"))),
        ("legacy_id", ("legacy_id",), lambda o: C.clean_id(col("legacy_id"))),
        ("merchant_name", ("merchant_name",), lambda o: C.clean_merchant(col("merchant_name"))),
        ("merchant_category", ("merchant_category",), lambda o: C.clean_category(col("merchant_category"))),
        ("payment_method", ("payment_method",), lambda o: C.clean_payment(col("payment_method"), o.intended_payment)),
        ("card_last_four", ("card_last_four",), lambda o: C.clean_card_last_four(col("card_last_four"))),
        ("card_type", ("card_type",), lambda o: C.clean_card_type(col("card_type"))),
        ("is_fraud", ("is_fraud",), lambda o: C.clean_bool_words(col("is_fraud"))),
        ("is_flagged", ("is_flagged",), flag),
        ("risk_score", ("risk_score",), lambda o: C.clean_amount(col("risk_score"), o.keep_sign)),
        ("notes", ("notes",), lambda o: C.clean_text(col("notes"))),
        ("internal_comments", ("internal_comments",), lambda o: C.clean_text(col("internal_comments"))),
    ]


def _derived_steps(o: Options) -> list[Step]:
    """Cleaners that read an already-cleaned column; applied in a second projection
    so the expensive cleaned value is computed once and referenced, not re-derived."""
    return [("age", ("age", "dob"), lambda o: C.clean_age(F.col("age"), F.col("dob"), o.as_of))]


ID_COLUMNS = ("customer_id", "transaction_id")
NAME_COLUMNS = ("full_name", "first_name", "last_name")


def plan_steps(columns: Sequence[str], options: Options = Options()) -> tuple[list[str], list[str]]:
    """(applied, skipped) steps for an input with ``columns``: dedup, id_filter and the cleaned columns."""
    have = set(columns)
    needs = [("dedup", options.dedup_keys), ("id_filter", ID_COLUMNS), ("full_name", NAME_COLUMNS)]
    needs += [(out, inputs) for out, inputs, _ in _steps(options) + _derived_steps(options)]
    applied = [step for step, inputs in needs if have.issuperset(inputs)]
    return applied, [step for step, inputs in needs if not have.issuperset(inputs)]


# Cleaner expressions name only their input columns, so the same Column
# objects serve every DataFrame of a SparkContext.  Building them costs a few
# thousand py4j calls (literal maps, higher-order functions), so they are
# built once per context and options, and go with the context.
_EXPRESSIONS: WeakKeyDictionary = WeakKeyDictionary()


def _expr(out: str, build: Callable[[Options], Column], options: Options) -> Column:
    sc = SparkContext._active_spark_context
    if sc is None or options.as_of is not None:
        return build(options)
    known = _EXPRESSIONS.setdefault(sc, {})
    if (out, options) not in known:
        known[out, options] = build(options)
    return known[out, options]


def clean_columns(df: DataFrame, options: Options = Options()) -> DataFrame:
    """Apply every column cleaner whose inputs exist: one projection for the
    independent cleaners, a second for those reading a cleaned column (age)."""
    have = set(df.columns)
    for steps in (_steps(options), _derived_steps(options)):
        exprs = {}
        for out, needs, build in steps:
            if all(n in have for n in needs):
                exprs[out] = _expr(out, build, options)
            else:
                log.warning("skipping cleaner for %s: missing %s", out, [n for n in needs if n not in have])
        df = df.withColumns(exprs)
    return df


def deduplicate(raw: DataFrame, options: Options = Options()) -> DataFrame:
    """One row per key; skipped if any of the key columns is missing (fewer would merge unlike rows)."""
    missing = [k for k in options.dedup_keys if k not in raw.columns]
    if missing or not options.dedup_keys:
        log.warning("skipping the one-row-per-key step: missing %s", missing)
        return raw
    return dedup_by_key(raw, options.dedup_keys, options.tiebreak)


def clean_untyped(raw: DataFrame, options: Options = Options()) -> DataFrame:
    """Everything up to (not including) the final typing."""
    applied, skipped = plan_steps(raw.columns, options)
    dedup = deduplicate(raw, options)
    if "id_filter" in applied:
        kept = id_filter(dedup, ID_COLUMNS)
    else:
        log.warning("skipping the id filter: missing %s", [c for c in ID_COLUMNS if c not in raw.columns])
        kept = dedup
    if "full_name" in applied:
        kept = full_name_from_dedup(kept, dedup, options.dedup_keys if "dedup" in applied else None)
    else:
        log.warning("skipping the rebuild of full_name: missing %s", [c for c in NAME_COLUMNS if c not in raw.columns])
    kept = drop_columns(kept, DROPPED_COLUMNS)
    cleaned = clean_columns(kept, options)
    if options.drop_empty_rows:
        cleaned = drop_empty_rows(cleaned, keys=[*KEY_COLUMNS, "src_row"])
    return cleaned


def clean_all(raw: DataFrame, options: Options = Options()) -> DataFrame:
    """Raw text table -> typed clean table in the target's column order."""
    limit_generated_methods(raw.sparkSession)
    return typed_cast(clean_untyped(raw, options), CLEAN_COLUMNS)


def run_job(raw: DataFrame, target: str, location: str | None = None, options: Options = Options()) -> int:
    """The whole job: clean, stop if nothing is left, load rows not yet stored.

    The clean table is written once to the shared folder
    (``spark.checkpoint.dir``); the mid-pipeline check and the load both read
    that copy, so the raw input is processed once and a lost executor does not
    send the load back to the raw files.  The copy is deleted at the end.
    Rows count as stored by the key that the job keeps one row of (ids if it
    has none).  Returns the number of rows appended.
    """
    with Intermediates(raw.sparkSession) as written:
        clean = written.write(clean_all(raw, options), "clean")
        report = checkpoint(clean).collect()  # raises on an empty result
        for r in report:
            (log.warning if r["status"] == "warning" else log.info)("null share of %s: %.2f%%", r["column"], r["null_pct"] or 0.0)
        keys = options.dedup_keys if "dedup" in plan_steps(raw.columns, options)[0] else ID_COLUMNS
        return load_if_new(clean, target, CLEAN_SCHEMA, location, keys=keys)
