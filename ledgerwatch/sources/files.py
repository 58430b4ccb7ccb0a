"""File sources and sinks: CSV and JSON with declared schemas, source
fallback, append / overwrite ingest with a write log, saved tables, the
versioned feature store, the newest batch, and synthetic transactions."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions.scalars import padded_id
from . import versions as V

WRITE_LOG_SCHEMA = T.StructType([
    T.StructField("version", T.LongType()), T.StructField("written_at", T.TimestampType()),
    T.StructField("operation", T.StringType()), T.StructField("path", T.StringType()),
    T.StructField("rows", T.LongType()),
])


# Full microsecond precision both ways (the default format drops digits).
CSV_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("timestampNTZFormat", CSV_TS_FORMAT) \
        .option("timestampFormat", CSV_TS_FORMAT).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a declared schema (timestamps parsed)."""
    return spark.read.schema(schema).option("header", True).option("timestampNTZFormat", CSV_TS_FORMAT) \
        .option("timestampFormat", CSV_TS_FORMAT).csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with a declared schema."""
    return spark.read.schema(schema).json(path)


def resolve_source(spark: SparkSession, candidates: list[tuple[str, str]], schema: T.StructType) -> DataFrame:
    """S3: the first candidate (format, path) that exists, in order — e.g. a
    saved table (format ``table``, its name for the path), else CSV, else
    Parquet; an error when none does. A candidate that exists but can't be
    read raises its own error."""
    for fmt, path in candidates:
        if fmt == "table":
            if spark.catalog.tableExists(path):
                return spark.table(path)
            continue
        try:
            reader = spark.read.schema(schema)
            df = reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)
            df.limit(0).collect()  # resolves the path now, reads no rows
            return df
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"no source found among {[p for _, p in candidates]}")


def logged_write(df: DataFrame, path: str, mode: str, log_path: str, partition_by: list[str] | None = None) -> int:
    """Write ``df`` and append one row (version, time,
    operation, rows) to the write log. Rows are counted by an Observation
    during the write itself — no second scan. An entry is a file named by its
    version that is only created if it doesn't exist; of two writers one gets
    the version and the other the next."""
    spark = df.sparkSession
    obs = Observation("write")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    rows = int(obs.get["rows"])
    entry = {"timestamp": datetime.now(timezone.utc).isoformat(), "operation": "WRITE" if mode == "overwrite" else "APPEND", "path": path, "rows": rows}
    while True:
        known = V.versions(spark, log_path)
        version = known[-1] + 1 if known else 0
        if V.create_once(spark, f"{log_path}/{V.MARKS}/{version}.json", json.dumps(entry)):
            return rows


def save_as_table(df: DataFrame, name: str, path: str) -> None:
    """Save ``df`` in ``path`` as the table ``name`` of the session's
    catalog, replacing one of that name."""
    df.write.mode("overwrite").option("path", path).saveAsTable(name)


def write_history(spark: SparkSession, log_path: str, n: int = 5) -> DataFrame:
    """S10 + K7: the newest ``n`` writes; only their entries are read."""
    notes = [(v, V.note(spark, log_path, v)) for v in reversed(V.versions(spark, log_path)[-n:])] if n > 0 else []
    return spark.createDataFrame([(v, datetime.fromisoformat(e["timestamp"]), e["operation"], e["path"], e["rows"]) for v, e in notes], WRITE_LOG_SCHEMA)


# Column types that hold every value of two others without loss. Parquet files
# of the narrower type are read as the wider one.
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The one of two column types that holds both without loss; None if
    neither does."""
    if a == b:
        return a
    for narrow, wide in ((a, b), (b, a)):
        if isinstance(narrow, WHOLE) and isinstance(wide, WHOLE) and WHOLE.index(type(narrow)) < WHOLE.index(type(wide)):
            return wide
        if isinstance(wide, T.DoubleType) and isinstance(narrow, (T.FloatType, *WHOLE[:3])):
            return wide
        if isinstance(wide, T.TimestampNTZType) and isinstance(narrow, T.DateType):
            return wide
        if isinstance(wide, T.DecimalType) and isinstance(narrow, T.DecimalType) and wide.scale >= narrow.scale \
                and wide.precision - wide.scale >= narrow.precision - narrow.scale:
            return wide
    return None


def merged_schema(table: T.StructType, rows: T.StructType) -> T.StructType:
    """The schema of ``table`` with what ``rows`` bring: new columns at the
    end, types widened, all nullable. Raises ValueError where two types of a
    column have no common wider one."""
    fields = {f.name: f.dataType for f in table.fields}
    for f in rows.fields:
        wide = wider_type(fields.get(f.name, f.dataType), f.dataType)
        if wide is None:
            raise ValueError(f"column {f.name}: {f.dataType.simpleString()} can't be merged with {fields[f.name].simpleString()}")
        fields[f.name] = wide
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


def _schema_notes(path: str) -> str:
    return f"{path}/_schema"


def feature_store_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The published schema of the feature table; None before the first write."""
    found = V.latest(spark, _schema_notes(path))
    return T.StructType.fromJson(found[1]["schema"]) if found else None


def write_features(df: DataFrame, path: str, log_path: str) -> int:
    """Append rows of one or more feature versions to the table, which is
    partitioned by version and whose schema grows with its writers. The merged
    schema is published first and the rows are written after it, so whoever
    sees the rows knows their columns; of two writers that change it at once
    the second merges with the first one's. Rows that don't fit raise
    ValueError before anything is written. Returns the rows written."""
    spark = df.sparkSession
    while True:
        found = V.latest(spark, _schema_notes(path))
        number, old = (found[0] + 1, T.StructType.fromJson(found[1]["schema"])) if found else (0, T.StructType([]))
        new = merged_schema(old, df.schema)
        if new == old or V.create_once(spark, f"{_schema_notes(path)}/{V.MARKS}/{number}.json", json.dumps({"schema": new.jsonValue()})):
            return logged_write(df, path, "append", log_path, partition_by=["feature_version"])


def read_feature_store(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """The partitioned feature table in its published schema: columns that
    a version lacks are null, types are widened, and no file footer is read to
    find that out. A version filter prunes partitions at the scan. A table
    without a published schema has its files' schemas merged."""
    schema = feature_store_schema(spark, path)
    df = (spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)).parquet(path)
    return df.where(F.col("feature_version") == version) if version else df


BATCH_DATE = "batch_date"


def write_dated(df: DataFrame, path: str, ts: str = "transaction_timestamp", mode: str = "append") -> None:
    """Land rows in a raw zone partitioned by their business date."""
    df.withColumn(BATCH_DATE, F.to_date(ts)).write.mode(mode).partitionBy(BATCH_DATE).parquet(path)


def latest_batch(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest business date of a raw zone that
    ``write_dated`` filled. The date is found among the folders' names; the
    scan reads that partition only. Rows without a date are in no batch;
    raises FileNotFoundError where there is no dated one."""
    dates = [name.split("=", 1)[1] for name, _ in V.children(spark, path) if name.startswith(f"{BATCH_DATE}=") and name[-1].isdigit()]
    if not dates:
        raise FileNotFoundError(f"no dated batch under {path}")
    return spark.read.parquet(path).where(F.col(BATCH_DATE) == F.lit(max(dates)).cast("date"))


def newest_arrival(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The batch that arrived last: of the files and folders directly
    under ``path`` the one modified last (of several, the last by name), and
    no other is opened. Names beginning with ``_`` or ``.`` don't count;
    raises FileNotFoundError where nothing has arrived."""
    arrived = [(at, name) for name, at in V.children(spark, path) if name[0] not in "._"]
    if not arrived:
        raise FileNotFoundError(f"no batch under {path}")
    return spark.read.schema(schema).parquet(f"{path}/{max(arrived)[1]}")


def synthetic_transactions(ids: DataFrame, id_col: str = "id", customers: int = 500, step_minutes: int = 5,
                           start: str = "2024-01-01 00:00:00", seed: int = 42, fraud_pct: int = 3) -> DataFrame:
    """Deterministic synthetic transactions from an id column:
    sequential ids, ``id % customers`` customers, fixed-step timestamps and
    hash-driven columns (repeatable for a seed, not NumPy's stream)."""
    i = F.col(id_col)
    h = F.pmod(F.xxhash64(i, F.lit(seed)), F.lit((1 << 62) - 57))
    return ids.select(
        i.alias("row_id"),
        padded_id("C", i % customers, 5).alias("customer_id"),
        padded_id("TX-", i, 7).alias("transaction_id"),
        (F.lit(start).cast("timestamp_ntz") + F.make_dt_interval((i * step_minutes / F.lit(1440)).cast("int"), F.lit(0), (i * step_minutes % 1440).cast("int"), F.lit(0))).alias("transaction_timestamp"),
        padded_id("M", F.lit(1) + h % 199, 4).alias("merchant_id"),
        (h % 100 < fraud_pct).cast("int").alias("is_fraud"),
    )
