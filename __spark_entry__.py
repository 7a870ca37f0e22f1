"""

``entry(spark)`` runs the flagship query (the whole cleaning job) on
over the whole dirty fixture derived from ``orders x customer x nation`` of the
given scale factor; ``oracle_sql()`` has the DuckDB SQL for each key.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerlint import Options, clean_all, run_job  # noqa: E402
from ledgerlint.functions import columns as C  # noqa: E402
from ledgerlint.operators import quality as Q  # noqa: E402
from ledgerlint.operators import relational as R  # noqa: E402
from ledgerlint.operators.names import full_name_from_dedup  # noqa: E402
from ledgerlint.schema import CLEAN_COLUMNS, CLEAN_SCHEMA, DISTRIBUTION_COLUMNS, NUMERIC_COLUMNS, RAW_SCHEMA  # noqa: E402
from ledgerlint.session import fresh_path  # noqa: E402
from ledgerlint.sources import target as K  # noqa: E402
from ledgerlint.sources.fixture import dirty_transactions  # noqa: E402
from ledgerlint.sources.raw import read_csv_by_header, read_raw_csv, write_raw_csv  # noqa: E402

# The text operators and the corpus pipeline are optional; nothing else needs them.
try:
    import corpus_pipeline
    from ledgerlint.llm import queries as text_queries
except ImportError as e:
    if not (e.name or "").startswith(("ledgerlint.llm", "corpus_pipeline")):
        raise
    corpus_pipeline = text_queries = None

SF_SMOKE = "/root/testdata/sf0.001"

INTENDED = Options(
    null_token=None,
    keep_sign=True,
    intended_account_type=True,
    intended_payment=True,
    zip_empty_as_null=True,
    clean_is_flagged=True,
)

Query = Callable[[SparkSession, str], DataFrame]


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_transactions(spark, sf_dir)


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_all(_raw(spark, sf_dir))


def _written_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table stored in the shared folder, for queries that evaluate it several times."""
    path = fresh_path(spark, "clean")
    clean = _clean(spark, sf_dir)
    clean.write.parquet(path)
    return spark.read.schema(clean.schema).parquet(path)


def _on_raw(*cols: Callable[[], object]) -> Query:
    """A query applying cleaners to every raw row; expressions are built lazily."""
    return lambda spark, d: _raw(spark, d).select("src_row", *[c() for c in cols])


def _round_stats(df: DataFrame) -> DataFrame:
    return df.withColumn("mean", F.round("mean", 6)).withColumn("stddev", F.round("stddev", 6))


# --- sources and sinks ----------------------------------------------------------
def q_csv_scan(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "csv_scan")
    write_raw_csv(_raw(spark, d), path)
    schema = T.StructType([T.StructField("src_row", T.LongType())] + RAW_SCHEMA.fields)
    return read_raw_csv(spark, path, schema=schema)


def q_csv_by_header(spark: SparkSession, d: str) -> DataFrame:
    """All rows from files of two layouts: columns in another order, and two columns missing beside an unknown one."""
    path, raw = fresh_path(spark, "csv_by_header"), _raw(spark, d)
    write_raw_csv(raw.filter("src_row % 2 = 0").select(*reversed(raw.columns)), f"{path}/a")
    write_raw_csv(raw.filter("src_row % 2 = 1").drop("notes", "city").withColumn("unknown", F.lit("x")), f"{path}/b")
    schema = T.StructType([T.StructField("src_row", T.LongType())] + RAW_SCHEMA.fields)
    return read_csv_by_header(spark, [f"{path}/a", f"{path}/b"], schema)


def _fresh_target(spark: SparkSession, stem: str) -> tuple[str, str]:
    loc = fresh_path(spark, stem)
    name = "t_" + loc.rsplit("-", 1)[-1]
    return name, loc


def q_table_exists(spark: SparkSession, d: str) -> DataFrame:
    name, loc = _fresh_target(spark, "target")
    before = K.table_exists(spark, name)
    K.load_if_new(_clean(spark, d), name, CLEAN_SCHEMA, loc)
    after = K.table_exists(spark, name)
    return spark.table(name).agg(
        F.lit(before).alias("existed_before"), F.lit(after).alias("exists_after"), F.count(F.lit(1)).alias("rows")
    )


def q_align_append(spark: SparkSession, d: str) -> DataFrame:
    name, loc = _fresh_target(spark, "target")
    K.create_target(spark, name, CLEAN_SCHEMA, loc)
    clean = _clean(spark, d)
    # columns shuffled and one missing: the append matches by name and fills the gap with nulls
    incoming = clean.select(*reversed([c for c in clean.columns if c != "notes"]))
    K.align_append(incoming, name)
    return spark.table(name)


def q_append_count(spark: SparkSession, d: str) -> DataFrame:
    name, loc = _fresh_target(spark, "target")
    K.create_target(spark, name, CLEAN_SCHEMA, loc)
    n = K.align_append(_clean(spark, d), name)
    return spark.table(name).agg(F.count(F.lit(1)).alias("rows"), F.lit(int(n)).cast("long").alias("appended"))


def q_load_if_new(spark: SparkSession, d: str) -> DataFrame:
    name, loc = _fresh_target(spark, "target")
    clean = _written_clean(spark, d)
    K.load_if_new(clean, name, CLEAN_SCHEMA, loc)
    again = K.load_if_new(clean, name, CLEAN_SCHEMA, loc)
    return spark.table(name).withColumn("second_load_appended", F.lit(int(again)))


def q_data_exists(spark: SparkSession, d: str) -> DataFrame:
    name, loc = _fresh_target(spark, "target")
    K.load_if_new(_clean(spark, d), name, CLEAN_SCHEMA, loc)
    incoming = R.id_filter(R.drop_null_key(_raw(spark, d))).select("customer_id", "transaction_id")
    return K.data_exists(incoming, spark.table(name), keys=("customer_id", "transaction_id"))


# --- relational -----------------------------------------------------------------
def q_dedup(spark: SparkSession, d: str) -> DataFrame:
    return R.dedup_by_key(_raw(spark, d), ["customer_id"], "src_row")


def q_id_filter(spark: SparkSession, d: str) -> DataFrame:
    return R.id_filter(q_dedup(spark, d))


RAW_KEYS = ["transaction_id", "customer_id", "legacy_id", "src_row"]


def q_drop_empty_rows(spark: SparkSession, d: str) -> DataFrame:
    # Every 43rd row is emptied of all but its ids.
    raw = _raw(spark, d)
    emptied = raw.select(*[c if c in RAW_KEYS else F.when(F.col("src_row") % 43 != 0, F.col(c)).alias(c) for c in raw.columns])
    return R.drop_empty_rows(emptied, keys=RAW_KEYS)


RAW_TYPES = [
    ("src_row", T.LongType()), ("customer_id", T.StringType()), ("transaction_amount", T.DoubleType()), ("age", T.IntegerType()),
    ("credit_score", T.IntegerType()), ("account_balance", T.DoubleType()), ("annual_income", T.DoubleType()), ("risk_score", T.DoubleType()),
    ("card_last_four", T.StringType()), ("card_type", T.StringType()), ("is_fraud", T.BooleanType()), ("is_flagged", T.BooleanType()), ("merchant_name", T.StringType()),
]


def _typed_raw(spark: SparkSession, d: str) -> DataFrame:
    """Raw text typed without cleaning: invalid and out-of-range values reach the casts and the rules."""
    return R.typed_cast(_raw(spark, d), RAW_TYPES)


def q_typed_cast(spark: SparkSession, d: str) -> DataFrame:
    # Decimal text in integer columns is left out: engines round it differently.
    return _typed_raw(spark, d).drop("age", "credit_score")


def q_edge_cases_raw(spark: SparkSession, d: str) -> DataFrame:
    return Q.edge_cases(_typed_raw(spark, d), 100, order_by=("src_row",)).select("src_row", "reasons")


def q_dedup_no_tiebreak(spark: SparkSession, d: str) -> DataFrame:
    return R.dedup_by_key(_raw(spark, d).drop("src_row"), ["customer_id"], None)


def q_load_replay(spark: SparkSession, d: str) -> DataFrame:
    """The whole job twice over the same rows in other partitions, without a row number."""
    name, loc = _fresh_target(spark, "target")
    raw = _raw(spark, d).drop("src_row")
    # As many parts as any shuffle has, by two columns: no part grows with one frequent value.
    run_job(raw.repartition("first_name", "transaction_id"), name, loc)
    again = run_job(raw.repartition("transaction_id", "customer_id"), name, loc)
    return spark.table(name).withColumn("second_load_appended", F.lit(int(again)))


def q_create_target(spark: SparkSession, d: str) -> DataFrame:
    """The created table's columns as the catalog has them, and how many rows of the clean table it then takes."""
    name, loc = _fresh_target(spark, "target")
    K.create_target(spark, name, CLEAN_SCHEMA, loc)
    columns = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(spark.table(name).schema.fields)]
    K.align_append(_clean(spark, d), name, target_schema=CLEAN_SCHEMA)
    rows = spark.table(name).agg(F.count(F.lit(1)).alias("rows"))
    return spark.createDataFrame(columns, "position int, column string, type string").crossJoin(F.broadcast(rows))


def q_data_exists_all_columns(spark: SparkSession, d: str) -> DataFrame:
    name, loc = _fresh_target(spark, "target")
    clean = _written_clean(spark, d)
    K.load_if_new(clean, name, CLEAN_SCHEMA, loc)
    incoming = clean.select("customer_id", "transaction_id", "gender", "state", "age")
    return K.data_exists(incoming, spark.table(name), keys=None)


def q_load_batch_skip_whole(spark: SparkSession, d: str) -> DataFrame:
    """The whole clean table is loaded; a batch of new rows that has one stored row is skipped as a whole."""
    name, loc = _fresh_target(spark, "target")
    clean = _written_clean(spark, d)
    K.load_if_new(clean, name, CLEAN_SCHEMA, loc, batch_skip=True)
    stored = clean.select(F.min("customer_id")).scalar()
    new = F.when(col("customer_id") == stored, col("customer_id")).otherwise(F.concat(F.lit("new-"), "customer_id"))
    again = K.load_if_new(clean.withColumn("customer_id", new), name, CLEAN_SCHEMA, loc, batch_skip=True)
    return spark.table(name).withColumn("second_load_appended", F.lit(int(again)))


def q_load_once(spark: SparkSession, d: str) -> DataFrame:
    """A load that died between its write and its ledger entry, the same load again, and the same rows in other partitions."""
    name, loc = _fresh_target(spark, "target")
    clean = _written_clean(spark, d)
    nothing = K.load_once(clean.limit(0), name, CLEAN_SCHEMA, loc)
    K._write_load(K.aligned(clean, CLEAN_SCHEMA).withColumn(K.LOAD_ID, F.lit("died")), name)
    first = K.load_once(clean, name, CLEAN_SCHEMA, loc)
    again = K.load_once(clean.repartition(5, "state"), name, CLEAN_SCHEMA, loc)
    return K.loaded(spark, name).withColumns({"appended": F.lit(int(nothing + first)).cast("long"), "second_load_appended": F.lit(int(again))})


def _signed_zeros(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("l_linenumber")
    return _table(spark, d, "lineitem").select(
        F.when(n == 1, F.lit(-0.0)).when(n == 2, F.lit(0.0)).when(n == 3, F.col("l_tax")).alias("signed"),
        F.when(n == 1, "").when(n == 2, "  ").when(n == 3, F.col("l_shipmode" if "l_shipmode" in _table(spark, d, "lineitem").columns else "l_returnflag")).alias("blank"),
        F.when(n > 9, n).alias("empty"),
    )


def q_name_dictionary(spark: SparkSession, d: str) -> DataFrame:
    dedup = q_dedup(spark, d)
    first = R.name_dictionary(dedup, "first_name").select(F.lit("first").alias("kind"), "name")
    last = R.name_dictionary(dedup, "last_name").select(F.lit("last").alias("kind"), "name")
    return first.unionByName(last)


def q_sample(spark: SparkSession, d: str) -> DataFrame:
    return Q.sample_validation(_clean(spark, d), sample_size=100, key="customer_id")


def q_describe(spark: SparkSession, d: str) -> DataFrame:
    return _round_stats(R.describe_numeric(_clean(spark, d), NUMERIC_COLUMNS))


def q_value_distribution(spark: SparkSession, d: str) -> DataFrame:
    return Q.value_distribution(_raw(spark, d), _clean(spark, d), DISTRIBUTION_COLUMNS, 10)


# --- cleaners over every raw row ----------------------------------------------------
def q_clean_full_name(spark: SparkSession, d: str) -> DataFrame:
    raw = _raw(spark, d)
    dedup = R.dedup_by_key(raw, ["customer_id"], "src_row")
    return full_name_from_dedup(raw.select("src_row", "full_name"), dedup, "src_row")


col = F.col


def q_clean_age(spark: SparkSession, d: str) -> DataFrame:
    with_dob = _raw(spark, d).withColumn("dob", C.clean_date(col("dob")))
    return with_dob.select("src_row", C.clean_age(col("age"), col("dob")).alias("age"))


# --- quality ------------------------------------------------------------------------
def q_before_after(spark: SparkSession, d: str) -> DataFrame:
    return Q.before_after_counts(_raw(spark, d), _clean(spark, d))


def q_stat_compare(spark: SparkSession, d: str) -> DataFrame:
    return _round_stats(Q.stat_compare(_raw(spark, d), _clean(spark, d), NUMERIC_COLUMNS))


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


LINEITEM_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def queries() -> dict[str, Query]:
    found = _cleaning_queries()
    if text_queries is not None:
        found |= text_queries.queries() | {"pipeline": corpus_pipeline.run}
    return found


def _cleaning_queries() -> dict[str, Query]:
    return {
        # sources and sinks
        "csv_scan": q_csv_scan,
        "csv_by_header": q_csv_by_header,
        "table_exists": q_table_exists,
        "data_exists": q_data_exists,
        "align_append": q_align_append,
        "append_count": q_append_count,
        "load_if_new": q_load_if_new,
        "create_target": q_create_target,
        "data_exists_all_columns": q_data_exists_all_columns,
        "load_batch_skip_whole": q_load_batch_skip_whole,
        "load_once": q_load_once,
        "load_replay": q_load_replay,
        # relational
        "drop_null_key": lambda s, d: R.drop_null_key(_raw(s, d)),
        "dedup_by_key": q_dedup,
        "dedup_no_tiebreak": q_dedup_no_tiebreak,
        "id_filter": q_id_filter,
        "drop_columns": lambda s, d: R.drop_columns(_raw(s, d)),
        "drop_empty_rows": q_drop_empty_rows,
        "typed_cast": q_typed_cast,
        "name_dictionary": q_name_dictionary,
        "hash_sample": lambda s, d: R.hash_sample(_table(s, d, "lineitem"), 0.1, F.concat_ws("-", "l_orderkey", "l_linenumber")).select("l_orderkey", "l_linenumber"),
        "describe_numeric": q_describe,
        "value_distribution": q_value_distribution,
        # column cleaners, applied to every raw row
        "clean_ids": _on_raw(
            lambda: C.clean_id(col("customer_id")).alias("customer_id"),
            lambda: C.clean_id(col("transaction_id")).alias("transaction_id"),
            lambda: C.clean_id(col("legacy_id")).alias("legacy_id"),
        ),
        "clean_gender": _on_raw(lambda: C.clean_gender(col("gender")).alias("gender")),
        "clean_names": _on_raw(lambda: C.clean_name(col("first_name")).alias("first_name"), lambda: C.clean_name(col("last_name")).alias("last_name")),
        "clean_full_name": q_clean_full_name,
        "clean_dates": _on_raw(
            lambda: C.clean_date(col("dob")).alias("dob"),
            lambda: C.clean_date(col("account_open_date")).alias("account_open_date"),
            lambda: C.clean_date(col("transaction_date")).alias("transaction_date"),
        ),
        "clean_age": q_clean_age,
        "clean_email": _on_raw(lambda: C.clean_email(col("email")).alias("email")),
        "clean_phone": _on_raw(lambda: C.clean_phone(col("phone")).alias("phone")),
        "clean_state": _on_raw(lambda: C.clean_state(col("state")).alias("state")),
        "clean_address_city": _on_raw(lambda: C.clean_address(col("address")).alias("address"), lambda: C.clean_city(col("city")).alias("city")),
        "clean_zip": _on_raw(lambda: C.clean_zip(col("zip_code")).alias("zip_code")),
        "clean_credit_score": _on_raw(lambda: C.clean_credit_score(col("credit_score")).alias("credit_score")),
        "clean_balance": _on_raw(lambda: C.clean_balance(col("account_balance")).alias("account_balance")),
        "clean_amounts": _on_raw(
            lambda: C.clean_amount(col("annual_income")).alias("annual_income"),
            lambda: C.clean_amount(col("transaction_amount")).alias("transaction_amount"),
            lambda: C.clean_amount(col("risk_score")).alias("risk_score"),
        ),
        "clean_account_type": _on_raw(lambda: C.clean_account_type(col("account_type")).alias("account_type")),
        "clean_employment": _on_raw(lambda: C.clean_employment(col("employment_status")).alias("employment_status")),
        "clean_txn_type": _on_raw(lambda: C.clean_transaction_type(col("transaction_type")).alias("transaction_type")),
        "clean_merchant": _on_raw(lambda: C.clean_merchant(col("merchant_name")).alias("merchant_name")),
        "clean_category": _on_raw(lambda: C.clean_category(col("merchant_category")).alias("merchant_category")),
        "clean_payment": _on_raw(lambda: C.clean_payment(col("payment_method")).alias("payment_method")),
        "clean_card_last_four": _on_raw(lambda: C.clean_card_last_four(col("card_last_four")).alias("card_last_four")),
        "clean_card_type": _on_raw(lambda: C.clean_card_type(col("card_type")).alias("card_type")),
        "clean_booleans": _on_raw(lambda: C.clean_bool_words(col("is_fraud")).alias("is_fraud"), lambda: C.cast_bool(col("is_flagged")).alias("is_flagged")),
        "clean_text": _on_raw(lambda: C.clean_text(col("notes")).alias("notes"), lambda: C.clean_text(col("internal_comments")).alias("internal_comments")),
        # the whole job
        "clean_all": _clean,
        "clean_all_intended": lambda s, d: clean_all(_raw(s, d), INTENDED),
        "clean_all_by_transaction": lambda s, d: clean_all(_raw(s, d), Options(dedup_keys=("transaction_id",))),
        # quality reports on the clean table
        "null_profile": lambda s, d: Q.null_profile(_clean(s, d)),
        "null_columns": lambda s, d: Q.null_profile(_clean(s, d), nonzero_only=True),
        "before_after_counts": q_before_after,
        "quality_metrics": lambda s, d: Q.quality_metrics(_clean(s, d)),
        "quality_metrics_intended": lambda s, d: Q.quality_metrics(_clean(s, d), intended=True),
        "quality_flags": lambda s, d: Q.quality_flags(Q.quality_metrics(_clean(s, d))),
        "business_rules": lambda s, d: Q.business_rules(_clean(s, d)),
        "business_rules_intended": lambda s, d: Q.business_rules(clean_all(_raw(s, d), INTENDED)),
        "business_rules_raw": lambda s, d: Q.business_rules(_typed_raw(s, d)),
        "edge_cases_raw": q_edge_cases_raw,
        "quality_metrics_signed": lambda s, d: Q.quality_metrics(_signed_zeros(s, d)),
        "rule_summary": lambda s, d: Q.rule_summary(Q.business_rules(_clean(s, d))),
        "stat_compare": q_stat_compare,
        "edge_cases": lambda s, d: Q.edge_cases(_clean(s, d), 100),
        "high_value": lambda s, d: Q.high_value(_clean(s, d)),
        "high_risk": lambda s, d: Q.high_risk(_clean(s, d)),
        "checkpoint": lambda s, d: Q.checkpoint(_clean(s, d)),
        "sample_validation": q_sample,
        "sample_exact": lambda s, d: Q.sample_exact(_clean(s, d), 100),
        # the reports are schema-generic: plain tables
        "null_profile_lineitem": lambda s, d: Q.null_profile(_table(s, d, "lineitem")),
        "quality_metrics_lineitem": lambda s, d: Q.quality_metrics(_table(s, d, "lineitem")),
        "quality_metrics_orders": lambda s, d: Q.quality_metrics(_table(s, d, "orders")),
        "quality_metrics_customer": lambda s, d: Q.quality_metrics(_table(s, d, "customer")),
        "describe_numeric_lineitem": lambda s, d: _round_stats(R.describe_numeric(_table(s, d, "lineitem"), LINEITEM_NUMERIC)),
        "top_values_lineitem": lambda s, d: R.top_values(_table(s, d, "lineitem"), ["l_returnflag", "l_linestatus"], 10),
    }


def oracle_sql() -> dict[str, str]:
    from oracle_sql import oracle

    found = oracle()
    if text_queries is not None:
        found |= text_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the whole cleaning job on sf0.001."""
    return _clean(spark, SF_SMOKE)
