"""What the pipeline reads: one specification per table, and one loader for all formats."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fields(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


TEXT, INT = T.StringType(), T.IntegerType()


@dataclass(frozen=True)
class TableSpec:
    """Columns to read, their new names, and the schema for formats that carry none."""

    columns: list[str]
    schema: T.StructType
    aliases: dict[str, str] = field(default_factory=dict)


# --- Fixed values: columns of the input tables ------------------------------------------

_FEEDBACK_EVENT = TableSpec(
    columns=[
        "id.userId", "id.accountId", "id.transactionId", "id.localDate", "id.pendingType",
        "time", "fact.category",
    ],
    schema=_fields(
        id=_fields(
            userId=TEXT, accountId=TEXT, transactionId=TEXT, localDate=T.DateType(),
            pendingType=INT,
        ),
        time=T.TimestampType(),
        fact=_fields(category=TEXT),
    ),
    aliases={
        "userId": "user_id", "accountId": "account_id", "transactionId": "transaction_id",
        "localDate": "date", "pendingType": "pending", "time": "feedback_time",
    },
)


def _flat(**types: T.DataType) -> TableSpec:
    return TableSpec(columns=list(types), schema=_fields(**types))


TABLES: dict[str, TableSpec] = {
    "users": _flat(user_id_hashed=TEXT, country_code=TEXT),
    "test_users": _flat(user_id_hashed=TEXT),
    "accounts": _flat(
        user_id_hashed=TEXT, account_id_hashed=TEXT, deleted=TEXT, site_id=TEXT
    ),
    "transactions": _flat(
        user_id=TEXT, account_id=TEXT, transaction_id=TEXT, date=T.DateType(), pending=INT,
        description=TEXT, internal_transaction=TEXT, transaction_type=TEXT,
        amount=T.DecimalType(18, 2), cycle_id=TEXT, user_id_hashed=TEXT,
        account_id_hashed=TEXT, transaction_id_hashed=TEXT, month=INT, year=INT,
    ),
    "transaction_cycles": _flat(user_id_hashed=TEXT, cycle_id=TEXT, model_base_period=TEXT),
    "historical_categories_feedback": _flat(
        user_id=TEXT, account_id=TEXT, transaction_id=TEXT, date=T.DateType(), pending=INT,
        feedback_time=T.TimestampType(), category=TEXT,
    ),
    "historical_labels_feedback": _flat(
        user_id_hashed=TEXT, account_id_hashed=TEXT, transaction_id_hashed=TEXT,
        date=T.DateType(), pending=INT, feedback_time=T.TimestampType(),
        transaction_label=TEXT,
    ),
    "user_single_feedback_created_categories": _FEEDBACK_EVENT,
    "user_multiple_feedback_created_categories": _FEEDBACK_EVENT,
    "user_multiple_feedback_applied_categories": _FEEDBACK_EVENT,
    "user_feedback_labels": TableSpec(
        columns=[
            "entity__userId_hashed", "entity__accountId_hashed",
            "entity__transactionId_hashed", "creationTime", "entity__label", "year", "month",
        ],
        schema=_fields(
            entity__userId_hashed=TEXT, entity__accountId_hashed=TEXT,
            entity__transactionId_hashed=TEXT, creationTime=T.TimestampType(),
            entity__label=TEXT, year=INT, month=INT,
        ),
        aliases={
            "entity__userId_hashed": "user_id_hashed",
            "entity__accountId_hashed": "account_id_hashed",
            "entity__transactionId_hashed": "transaction_id_hashed",
            "creationTime": "feedback_time",
            "entity__label": "transaction_label",
        },
    ),
}

# What the training-set job reads; the other two tables are only declared.
TRAINING_SET_TABLES = [
    name for name in TABLES if name not in ("transaction_cycles", "user_feedback_labels")
]


@dataclass(frozen=True)
class Source:
    """Where a table lies. Without a format it is guessed from the suffix of the path."""

    path: str | list[str]
    file_format: str | None = None
    options: dict[str, str] = field(default_factory=dict)


def strict_cast(value: Column, kind: T.DataType, name: str, date_format: str | None = None) -> Column:
    """Cast, but raise on a value that has no counterpart instead of making it null."""
    if date_format and isinstance(kind, T.DateType):
        found = F.try_to_date(value, date_format)
    elif date_format and isinstance(kind, T.TimestampType):
        found = F.try_to_timestamp(value, F.lit(date_format))
    else:
        found = value.try_cast(kind)
    text = F.concat(F.lit(f"{name}: not a {kind.simpleString()}: "), value.cast("string"))
    return F.when(value.isNull() | found.isNotNull(), found).otherwise(F.raise_error(text).cast(kind))


def _type_of(schema: T.StructType, path: str) -> T.DataType | None:
    """The type of a column or nested field, or None if the schema doesn't have it."""
    kind: T.DataType = schema
    for name in path.split("."):
        if not isinstance(kind, T.StructType) or name not in kind.names:
            return None
        kind = kind[name].dataType
    return kind


def select_columns(
    df: DataFrame, spec: TableSpec, formats: dict[type, str] | None = None
) -> DataFrame:
    """Project to the table's columns by name, in order, with declared types and new names."""
    missing = [c for c in spec.columns if _type_of(df.schema, c) is None]
    if missing:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    chosen = []
    for path in spec.columns:
        declared, name = _type_of(spec.schema, path), path.split(".")[-1]
        value = F.col(path)
        if declared is not None and declared != _type_of(df.schema, path):
            value = strict_cast(value, declared, path, (formats or {}).get(type(declared)))
        chosen.append(value.alias(name))
    return df.select(*chosen).withColumnsRenamed(spec.aliases)


def load_table(
    spark: SparkSession,
    spec: TableSpec | str,
    path: str | list[str],
    file_format: str | None = None,
    **options: str,
) -> DataFrame:
    """Read a file, glob or partitioned folder. Only the wanted columns are read.

    Columns are found by name in every format; one that is missing is an error, others are left
    out. CSV with a header is read as text and cast to the declared types, parquet and ORC where
    their types differ; a value that can't be cast fails the job. JSON gets the declared schema
    and fails on records that don't fit it. Without a header (``header="false"``) CSV columns are
    taken by position. Folders like ``year=2020`` become partition columns.
    """
    if isinstance(spec, str):
        spec = TABLES[spec]
    kind = file_format or guess_format(path)
    reader = spark.read.format(kind).options(**options)
    formats = {}
    if kind == "csv":
        formats = {
            t: options[o]
            for t, o in ((T.DateType, "dateFormat"), (T.TimestampType, "timestampFormat"))
            if o in options
        }
        if options.get("header", "true").lower() == "true":
            # Files whose header differs from the first one are refused.
            reader = reader.option("header", "true").option("enforceSchema", "false")
        else:
            reader = reader.schema(T.StructType([T.StructField(c, TEXT) for c in spec.columns]))
    if kind == "json":
        reader = reader.schema(spec.schema).option("mode", options.get("mode", "FAILFAST"))
    return select_columns(reader.load(path), spec, formats)


def guess_format(path: str | list[str]) -> str:
    first = path if isinstance(path, str) else path[0]
    for kind in ("csv", "json", "orc"):
        if first.rstrip("/").endswith(f".{kind}"):
            return kind
    return "parquet"


def load_tables(
    spark: SparkSession, paths: dict[str, str | list[str] | Source]
) -> dict[str, DataFrame]:
    """All tables of the training-set job, by name; a ``Source`` names format and options."""
    sources = {
        name: at if isinstance(at, Source) else Source(at)
        for name, at in paths.items()
        if name in TRAINING_SET_TABLES
    }
    if absent := [name for name in TRAINING_SET_TABLES if name not in sources]:
        raise KeyError(f"no path for {', '.join(absent)}")
    return {
        name: load_table(
            spark, name, sources[name].path, sources[name].file_format, **sources[name].options
        )
        for name in TRAINING_SET_TABLES
    }
