"""K1-K7: loading the clean table into a target table without duplicates.

``load_if_new`` skips rows whose key is stored.  ``load_once`` skips whole
batches that were loaded before, by a ledger, and survives a crash at any point.

The target is a catalog table stored as parquet at a given location (JDBC is
an option of ``align_append``).  Existence and duplicate checks are
distributed joins against the target, never driver-side row loops.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.digest import digest, named
from ..operators.relational import dedup_by_key

LOAD_ID = "load_id"


# K1 --------------------------------------------------------------------------
def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


# K2 --------------------------------------------------------------------------
def create_target(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    location: str | None = None,
    bucket_by: Sequence[str] = (),
    num_buckets: int | None = None,
) -> None:
    """Create the (empty) target table if it does not exist.

    ``bucket_by`` (usually the load keys) buckets the stored files by hash of
    those columns, so the duplicate check of every later load reads the
    target already partitioned by key and shuffles only the incoming batch.
    """
    if table_exists(spark, name):
        return
    if not bucket_by:
        kwargs = {"path": location} if location else {}
        spark.catalog.createTable(name, source="parquet", schema=schema, **kwargs)
        return
    n = num_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = ", ".join(f"`{k}`" for k in bucket_by)
    quoted = location.replace("\\", "\\\\").replace("'", "\\'") if location else None
    loc = f" LOCATION '{quoted}'" if quoted else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet CLUSTERED BY ({keys}) INTO {n} BUCKETS{loc}")


def buckets_of(spark: SparkSession, name: str) -> tuple[int, list[str]]:
    """Number of buckets and bucket columns of a table; (0, []) if it has none."""
    info = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    columns = [c.strip().strip("`") for c in info.get("Bucket Columns", "").strip("[]").split(",") if c.strip()]
    return (int(info["Num Buckets"]), columns) if columns else (0, [])


def _match_condition(df: DataFrame, target: DataFrame, cols: Sequence[str], null_safe: bool) -> Column:
    return reduce(lambda a, b: a & b, [df[_quoted(c)].eqNullSafe(target[_quoted(c)]) if null_safe else df[_quoted(c)] == target[_quoted(c)] for c in cols])


# K3 --------------------------------------------------------------------------
def data_exists(
    df: DataFrame,
    target: DataFrame,
    keys: Sequence[str] | None = ("customer_id", "transaction_id"),
    null_safe: bool = False,
) -> DataFrame:
    """One row: data_exists (any incoming row already stored), matched_rows.

    ``keys=None`` compares every incoming column; with ``null_safe=False`` a
    row holding a null then never matches, as with SQL ``=``.  The whole batch
    is probed.  More than two columns are compared by 128-bit digests first, so
    that two numbers a row are shuffled and not the row; only rows whose digest
    is stored are then compared column by column.  That first comparison runs when this is called.
    """
    cols = list(keys) if keys else [c for c in df.columns if c in target.columns]
    incoming, stored = df.select(*map(named, cols)), target.select(*map(named, cols))
    alike = [c for c in cols if incoming.schema[c].dataType == stored.schema[c].dataType]  # other types are coerced by the comparison
    if len(cols) > 2 and alike:
        incoming, stored = _same_digest(incoming, stored, alike)
        found = [F.coalesce(_match_condition(incoming, stored, [c], null_safe), F.lit(False)) for c in cols]  # as tests of pairs, not keys: no null filters reach the batch's plan
        match = (incoming["_h1"] == stored["_h1"]) & (incoming["_h2"] == stored["_h2"]) & reduce(lambda a, b: a & b, found)
    else:
        match = _match_condition(incoming, stored, cols, null_safe)
    hits = incoming.join(stored, match, "left_semi")
    return hits.agg(F.count(F.lit(1)).alias("matched_rows")).select(
        (F.col("matched_rows") > 0).alias("data_exists"), "matched_rows"
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


COMMON_DIGESTS = 100_000  # digests that are broadcast


def _same_digest(incoming: DataFrame, stored: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides' rows whose digest of ``cols`` stands on both sides, with the digest as two more columns.

    The digests in common are found by a join of digests alone.  They are usually
    few (none at all, if the batch is new), and then broadcast, so no row is
    shuffled to find its digest; more than ``COMMON_DIGESTS`` are joined.
    """
    keyed = [df.withColumns(dict(zip(("_h1", "_h2"), digest(df, cols)))) for df in (incoming, stored)]
    common = keyed[0].select("_h1", "_h2").distinct().join(keyed[1].select("_h1", "_h2"), ["_h1", "_h2"], "left_semi")
    few = common.limit(COMMON_DIGESTS + 1).collect()
    if len(few) <= COMMON_DIGESTS:
        common = F.broadcast(incoming.sparkSession.createDataFrame(few, "_h1 long, _h2 long"))
    left, right = (df.join(common, ["_h1", "_h2"], "left_semi") for df in keyed)
    return left, right


# K4 / K5 / K6 ----------------------------------------------------------------
class Appended(int):
    """Number of rows appended; ``cast_losses`` has the columns whose type some values did not fit, with how many."""

    cast_losses: dict[str, int]


def _value(df: DataFrame, field: T.StructField) -> Column:
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType)
    return named(field.name).try_cast(field.dataType)


def aligned(df: DataFrame, target_schema: T.StructType) -> DataFrame:
    """``df`` in the target's column order; target columns it lacks become typed nulls.

    A null in a column that the schema declares not nullable raises when the rows are evaluated.
    """
    return df.select(*_aligned_columns(df, target_schema))


def _aligned_columns(df: DataFrame, target_schema: T.StructType) -> list[Column]:
    out = []
    for f in target_schema.fields:
        value = _value(df, f)
        if not f.nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"null in {f.name}, which must not be null")).cast(f.dataType))
        out.append(value.alias(f.name))
    return out


def align_append(
    df: DataFrame,
    name: str,
    jdbc: dict[str, str] | None = None,
    target_schema: T.StructType | None = None,
    num_partitions: int | None = None,
) -> Appended:
    """Append ``df`` to the target by column name; returns the rows written.

    The row count and the values lost to typing are observed during the write
    (no second pass).  ``target_schema`` gives the column order and which
    columns must not be null (a stored table keeps only names and types);
    ``jdbc`` (url, dbtable, user, password, driver, ...) writes through JDBC
    and needs it.  Rows for a bucketed table are dealt to its buckets first, so
    a load adds at most one file to each.  ``num_partitions`` caps the number of
    concurrent writers otherwise (useful for databases).
    """
    spark = df.sparkSession
    schema = target_schema if target_schema is not None else spark.table(name).schema
    typed = [f for f in schema.fields if f.name in df.columns and df.schema[f.name].dataType != f.dataType]
    lost = {f"_lost_{i}": named(f.name).isNotNull() & _value(df, f).isNull() for i, f in enumerate(typed)}
    rows = df.select(*_aligned_columns(df, schema), *[c.alias(k) for k, c in lost.items()])
    n_buckets, bucket_columns = (0, []) if jdbc is not None else buckets_of(spark, name)
    if n_buckets:
        rows = rows.repartition(n_buckets, *bucket_columns)
    elif num_partitions:
        rows = rows.repartition(num_partitions)
    # Observed last: an empty shuffle below may be planned away, and with it what it observed.
    obs = Observation("append")
    out = rows.observe(obs, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(k)).alias(k) for k in lost]).drop(*lost)
    if jdbc is not None:
        out.write.format("jdbc").options(**jdbc).mode("append").save()
    else:
        out.write.mode("append").insertInto(name)
    seen = obs.get
    result = Appended(seen.get("rows", 0))
    result.cast_losses = {f.name: seen[f"_lost_{i}"] for i, f in enumerate(typed) if seen.get(f"_lost_{i}")}
    return result


# K7 --------------------------------------------------------------------------
def load_if_new(
    df: DataFrame,
    name: str,
    schema: T.StructType,
    location: str | None = None,
    keys: Sequence[str] = ("customer_id", "transaction_id"),
    batch_skip: bool = False,
    bucketed: bool = True,
    num_buckets: int | None = None,
) -> Appended:
    """Create the target if missing, then append one row for each key that is not stored.

    Idempotent per key: loading the same rows again writes nothing, however
    they are partitioned, and of rows that share a key within the batch the
    smallest is stored.  ``batch_skip=True`` keeps the all-or-nothing behavior
    instead: if any incoming row is already stored, nothing is written.  A new
    target is bucketed by ``keys`` (``bucketed=False`` for a plain table), so the
    anti-join below never re-shuffles what is already stored.  A null in a
    column that ``schema`` declares not nullable raises.  ``df`` is evaluated once if
    ``schema`` lets no key be null; ``batch_skip`` evaluates its keys once more, before the rows.
    """
    spark = df.sparkSession
    create_target(spark, name, schema, location, bucket_by=keys if bucketed else (), num_buckets=num_buckets)
    stored = spark.table(name)
    if batch_skip:
        if data_exists(df, stored, keys).first()["data_exists"]:
            return align_append(df.limit(0), name, target_schema=schema)
        return align_append(df, name, target_schema=schema)
    required = {f.name for f in schema.fields if not f.nullable}
    if required.issuperset(keys):
        one = dedup_by_key(df, keys, tiebreak=None, null_keys=True)  # rows without a key go on, to raise: one of them does
    else:
        unkeyed = df.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])) if required.intersection(keys) else df.limit(0)
        one = dedup_by_key(df, keys, tiebreak=None).unionByName(unkeyed)
    return align_append(one.join(stored.select(*keys), list(keys), "left_anti"), name, target_schema=schema)


# K7 with a ledger ---------------------------------------------------------------
def batch_fingerprint(df: DataFrame) -> str:
    """A name for the rows of a batch in any order and partitioning: their number and the sums of their 128-bit digests."""
    h1, h2 = digest(df, df.columns)
    total = lambda h: F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)")
    n, a, b = df.agg(F.count(F.lit(1)), total(h1), total(h2)).first()
    return f"{n}-{int(a) % (1 << 64):016x}{int(b) % (1 << 64):016x}"


def _ledger(name: str) -> str:
    return f"{name}_loads"


def loaded(spark: SparkSession, name: str, but: str | None = None) -> DataFrame:
    """The rows of all completed loads of a table that ``load_once`` fills, but those of the batch with the fingerprint ``but``.

    A load that died before its ledger entry is not among them, and of loads
    of one batch by several writers (each of them complete) one counts.
    """
    entries = spark.table(_ledger(name)).filter(~F.col("fingerprint").eqNullSafe(but)).groupBy("fingerprint").agg(F.min(LOAD_ID).alias(LOAD_ID)).select(LOAD_ID)
    return spark.table(name).join(entries, LOAD_ID, "left_semi").drop(LOAD_ID)


def load_once(
    df: DataFrame,
    name: str,
    schema: T.StructType,
    location: str | None = None,
    keys: Sequence[str] | None = ("customer_id", "transaction_id"),
) -> Appended:
    """Append a batch exactly once, whatever dies on the way and however often it is offered.

    The table is partitioned by load: each attempt writes under an id of its
    own, and its rows count (see :func:`loaded`) once the ledger has that id, one
    small row written last.  An attempt that died leaves rows that no reader
    sees; the next one writes them anew.  A batch that the ledger has, known by
    the fingerprint of its rows in any order, writes nothing.  With ``keys``, rows whose key
    an earlier load has are left out, and one row of each key is stored; rows with a null key
    are left out.  ``keys=None`` appends all rows, repeated ones too.  A null in a
    column that ``schema`` declares not nullable raises.  Two batches
    with common keys must not be loaded at the same time; the same batch may be.
    """
    spark = df.sparkSession
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    at = lambda folder: f" LOCATION '{folder}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {LOAD_ID} string) USING parquet PARTITIONED BY ({LOAD_ID}){at(location)}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_ledger(name)} (fingerprint string, {LOAD_ID} string, rows bigint) USING parquet{at(f'{location}_loads')}")
    # Typed, but not yet tested for nulls: a test that raises must not move below the batch's own filters.
    batch = df.select(*[_value(df, f).alias(f.name) for f in schema.fields])
    fingerprint = batch_fingerprint(batch)
    if not spark.table(_ledger(name)).filter(F.col("fingerprint") == fingerprint).isEmpty():
        return Appended(0)
    if keys:
        # Another writer may complete this very batch meanwhile: its rows are no reason to leave out ours.
        batch = dedup_by_key(batch, keys, tiebreak=None).join(loaded(spark, name, but=fingerprint).select(*map(named, keys)), list(keys), "left_anti").select(*map(named, batch.columns))
    load_id, obs = uuid.uuid4().hex, Observation("load")
    _write_load(aligned(batch, schema).observe(obs, F.count(F.lit(1)).alias("rows")).withColumn(LOAD_ID, F.lit(load_id)), name)
    n = obs.get.get("rows", 0)
    _complete_load(spark, name, fingerprint, load_id, n)
    return Appended(n)


def _write_load(rows: DataFrame, name: str) -> None:
    rows.write.mode("append").insertInto(name)
    rows.sparkSession.catalog.refreshTable(name)


def _complete_load(spark: SparkSession, name: str, fingerprint: str, load_id: str, n: int) -> None:
    entry = spark.createDataFrame([(fingerprint, load_id, n)], f"fingerprint string, {LOAD_ID} string, rows bigint")
    entry.coalesce(1).write.mode("append").insertInto(_ledger(name))
