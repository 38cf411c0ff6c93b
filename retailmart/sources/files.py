"""CSV in, typed staging, parquet and views out."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from tempfile import mkdtemp
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str, header: bool, date_format: str
) -> DataFrame:
    """The lines of CSV files by ``schema``, with the text of those that do not fit it."""
    return (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
        .option("header", header)
        .option("enforceSchema", not header)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("dateFormat", date_format)
        .csv(path)
    )


def csv_ingest(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType,
    *,
    sep: str = ",",
    header: bool = True,
    date_format: str = "yyyy-MM-dd",
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): rows that fit ``schema``, and the text of the lines that do not.

    Large files are split between tasks. Rows may end in LF or CRLF; empty fields
    are NULL. Every line is parsed in full whatever columns are used later. A header
    that does not name the schema's columns in their order raises when rows are read.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    read = _csv(spark, path, schema, sep, header, date_format)
    # Always true, but reads every column: Spark converts only the columns a query
    # needs and would take a line for good whose other fields are broken.
    every = F.xxhash64(*[f.name for f in schema.fields])
    parsed = F.length(every.cast("string")) > 0
    good = read.filter(F.col(CORRUPT).isNull() & parsed).drop(CORRUPT)
    rejects = read.filter(F.col(CORRUPT).isNotNull() & parsed).select(
        F.col(CORRUPT).alias("line")
    )
    return good, rejects


class Ingested(NamedTuple):
    """Rows that fit the schema, and the other lines with their place and what is wrong with them."""

    rows: DataFrame
    rejects: DataFrame


def csv_ingest_traced(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType,
    *,
    sep: str = ",",
    header: bool = True,
    date_format: str = "yyyy-MM-dd",
    store: str | None = None,
) -> Ingested:
    """``csv_ingest`` from one parse, with rejects that can be traced: line, file, block_start, reason.

    The parsed lines are written once, to ``store`` or a scratch folder, and both frames read them there. ``block_start``
    is the byte at which the part of the file begins in which the line stands. ``reason`` names the columns that do not
    convert with their values, or says that the number of fields is wrong.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    read = _csv(spark, path, schema, sep, header, date_format)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block_start"))
    parsed = read.select(
        F.struct(*[f.name for f in schema.fields]).alias("row"),
        F.col(CORRUPT).alias("line"),
        F.when(F.col(CORRUPT).isNotNull(), place).alias("place"),
    )
    store = store or scratch_path(spark, "ingested")
    parsed.write.parquet(store)
    back = spark.read.schema(parsed.schema).parquet(store)

    texts = ", ".join(f"`{name}` string" for name in [*schema.names, CORRUPT])
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    bad = back.filter(F.col("line").isNotNull()).select("line", "place.*", F.from_csv("line", texts, options).alias("_t"))

    def converted(f: T.StructField) -> Column:
        value = F.col(f"_t.{f.name}")
        return F.try_to_date(value, date_format) if isinstance(f.dataType, T.DateType) else value.try_cast(f.dataType)

    wrong = [
        F.when(F.col(f"_t.{f.name}").isNotNull() & converted(f).isNull(), F.concat(F.lit(f"{f.name}: "), F.col(f"_t.{f.name}")))
        for f in schema.fields
    ]
    named = F.concat_ws("; ", *wrong)
    reason = F.when(F.col(f"_t.{CORRUPT}").isNotNull(), "number of fields").when(named != "", named).otherwise("not readable")
    return Ingested(
        back.filter(F.col("line").isNull()).select("row.*"), bad.select("line", "file", "block_start", reason.alias("reason"))
    )


def type_staging(
    df: DataFrame, rules: Mapping[str, str | Callable[[Column], Column]]
) -> DataFrame:
    """Convert staged columns in one projection.

    A rule is a type name (a failed conversion gives NULL) or a function on the
    column, such as ``parse_dmy_date``. Other columns pass through.
    """

    def typed(name: str) -> Column:
        rule = rules.get(name)
        if rule is None:
            return F.col(name)
        value = F.col(name).try_cast(rule) if isinstance(rule, str) else rule(F.col(name))
        return value.alias(name)

    return df.select(*[typed(c) for c in df.columns])


class Staged(NamedTuple):
    """Rows whose values all converted, the others as they were staged, and how many values each column lost."""

    typed: DataFrame
    rejects: DataFrame
    lost: dict[str, int]

    def counts(self) -> DataFrame:
        """``lost`` as (column_name, lost_values)."""
        spark = self.typed.sparkSession
        return spark.createDataFrame(list(self.lost.items()), "column_name string, lost_values bigint")


class ConversionError(ValueError):
    """Values that do not convert, where none may be lost."""


def _free(prefix: str, columns: Sequence[str]) -> str:
    """``prefix``, made longer until no column begins with it."""
    while any(c.lower().startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def with_losses(
    df: DataFrame, rules: Mapping[str, str | Callable[[Column], Column]], mark: str = "_staging_"
) -> DataFrame:
    """``type_staging`` with the columns of ``rules`` as they were, named with ``mark`` in front, and ``mark`` itself: the
    names of the columns that lost a value. Conversions stand in the plan once."""
    ruled = [c for c in df.columns if c in rules]
    both = type_staging(df.select("*", *[F.col(c).alias(mark + c) for c in ruled]), rules)
    lost = [F.when(F.col(mark + c).isNotNull() & F.col(c).isNull(), F.lit(c)) for c in ruled]
    return both.withColumn(mark, F.filter(F.array(*lost), lambda x: x.isNotNull()))


def staged_types(
    df: DataFrame,
    rules: Mapping[str, str | Callable[[Column], Column]],
    path: str | None = None,
    failed: str = "failed_columns",
    strict: bool = False,
) -> Staged:
    """``type_staging`` that loses no value unseen: typed rows, rejects, and the values lost per column.

    A value is lost when it is not NULL and its conversion is. ``df`` is read once: its rows are written to ``path`` (a
    new scratch folder if not given) with their typed values, and those that lost a value also as they were staged; the
    counts are observed on the way. Both frames read what was written, so they agree with the counts, and row groups
    without rejects are skipped when rejects are read. ``rejects`` holds the staged columns and ``failed``, the names of
    those that did not convert, in the order of ``df``. ``strict`` raises ``ConversionError`` instead of returning
    rejects, as a plain conversion would stop. An empty frame gives empty frames and counts of 0.
    """
    unknown = [c for c in rules if c not in df.columns]
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    ruled = [c for c in df.columns if c in rules]
    mark = _free("_staging_", df.columns)
    rejected = f"{mark}_rejected"
    marked = with_losses(df, rules, mark).withColumn(rejected, F.size(mark) > 0)
    seen = Observation()
    counts = [F.count_if(F.array_contains(mark, c)).alias(f"c{i}") for i, c in enumerate(ruled)]
    watched = marked.observe(seen, F.count("*").alias("rows"), *counts)
    raw = [F.when(F.col(rejected), F.col(mark + c)).alias(mark + c) for c in ruled]
    written = watched.select(rejected, mark, *df.columns, *raw)
    path = path or scratch_path(df.sparkSession, "staged")
    written.write.parquet(path)
    found = {c: int(seen.get[f"c{i}"]) for i, c in enumerate(ruled)}
    if strict and any(found.values()):
        raise ConversionError(f"values that do not convert: { {c: n for c, n in found.items() if n} }")
    back = df.sparkSession.read.schema(written.schema).parquet(path)
    staged = [F.col(mark + c).alias(c) if c in rules else F.col(c) for c in df.columns]
    return Staged(
        back.filter(~F.col(rejected)).select(*df.columns),
        back.filter(F.col(rejected)).select(*staged, F.col(mark).alias(failed)),
        found,
    )


#: Mode of ``write_table`` by which a load can be run again.
REPLACE_PARTITIONS = "replace_partitions"


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
    name: str | None = None,
) -> str:
    """Write parquet. Partitioned tables are rebalanced by partition value first.

    The rebalance lets Spark split a large partition value over several tasks and
    put small ones together, which gives files of sound size on skewed dates.

    ``mode="replace_partitions"`` makes a load repeatable: the partitions found in ``df`` (NULL is one) are put in place
    of those that ``path`` holds, all others stay, and new ones are added. The new files become visible when the job
    commits; a load that failed on the way is run again. A partition without rows in ``df`` is left as it was.

    ``bucket_by`` deals the rows into ``buckets`` by a hash of these columns, sorted in each. Spark knows about buckets
    through its catalog, so the table gets a ``name`` there; joins and groupings by these columns then need no shuffle
    between tables of as many buckets.
    """
    together = [*partition_by, *bucket_by]
    if together:
        df = df.hint("rebalance", *[F.col(c) for c in together])
    writer = df.write
    if mode == REPLACE_PARTITIONS:
        if not partition_by:
            raise ValueError(f"{REPLACE_PARTITIONS} needs partition_by")
        writer, mode = writer.option("partitionOverwriteMode", "dynamic"), "overwrite"
    writer = writer.mode(mode).partitionBy(*partition_by)
    if not bucket_by:
        writer.parquet(path)
        return path
    if not name or buckets < 1:
        raise ValueError("a bucketed table needs a name and a number of buckets")
    writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by).saveAsTable(name, format="parquet", path=path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to a scratch folder and read back: later steps neither repeat nor change it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Give SQL users the frames by name."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def add_unknown_member(dim: DataFrame, key: str, values: Mapping[str, object]) -> DataFrame:
    """Add one row that stands for "none", unless the key is already there.

    Columns not in ``values`` are NULL.
    """
    member = dim.sparkSession.range(1).select(
        *[
            F.lit(values.get(f.name)).cast(f.dataType).alias(f.name)
            for f in dim.schema.fields
        ]
    )
    present = dim.filter(F.col(key) == F.lit(values[key])).agg(F.count("*")).scalar()
    return dim.unionByName(member.filter(present == 0))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared folder that the session names.

    Only a local session without ``spark.checkpoint.dir`` gets a machine-local one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = mkdtemp(prefix="retailmart-")
    return f"{base.rstrip('/')}/retailmart-{name}-{uuid.uuid4().hex}"
