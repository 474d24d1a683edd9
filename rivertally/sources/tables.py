"""Scans, lookups, exports, staging and guarded appends."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable, Mapping
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivertally import fixed_values as fixed
from rivertally import schemas
from rivertally.operators.joins import union_all
from rivertally.session import durable

log = logging.getLogger(__name__)


# ----- reading ----------------------------------------------------------------------
def union_like(tables: Mapping[str, DataFrame], kind: str) -> DataFrame | None:
    """All landed tables whose name contains ``kind``, as one; None (and a message) if there are none."""
    frames = [df for name, df in tables.items() if kind in name]
    if not frames:
        log.info("no %s data present", kind)
        return None
    return union_all(*frames)


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def scan(spark: SparkSession, path: str, study: str | None = None, year: int | None = None) -> DataFrame:
    """A stored table, restricted to a study and a year (a partition column)."""
    df = spark.read.parquet(path).drop("batch")
    if study is not None:
        df = df.where(F.col("StudyCode") == study)
    if year is not None:
        df = df.where(F.col("Year") == year)
    return df


def read_lookup_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, nullValue="NA", quote='"', escape='"')


def read_report_csvs(spark: SparkSession, folder: str, tables: Mapping[str, T.StructType] = schemas.REPORT_TABLES) -> dict[str, DataFrame]:
    """Report extracts by table name, with study and year taken from the file names."""
    found = {}
    for name, schema in tables.items():
        reader = spark.read.schema(schema).option("recursiveFileLookup", "true")
        try:
            df = reader.csv(f"{folder}/*_ar-{name}.csv", header=True, nullValue="NA", quote='"', escape='"')
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                continue
            raise
        path = F.col("_metadata.file_path")
        found[name] = df.select(
            "*",
            F.regexp_extract(path, fixed.REPORT_FILE, 1).alias("file_study"),
            F.regexp_extract(path, fixed.REPORT_FILE, 2).cast("long").alias("file_year"),
        )
    return found


# ----- writing ------------------------------------------------------------------------
def write_product(df: DataFrame, path: str) -> None:
    """CSV with a header and NA for missing values."""
    df.write.mode("overwrite").csv(path, header=True, nullValue="NA", quote='"', escape='"')


def write_split(df: DataFrame, key: str, folder: str) -> None:
    """A table per value of ``key``, all in one write; rows without a value are a table too."""
    df.hint("rebalance", key).write.mode("overwrite").partitionBy(key).parquet(folder)


def read_split(spark: SparkSession, folder: str, key: str, value: object) -> DataFrame:
    """One of the tables of ``write_split``; None names that of the missing values. Only its folder is read."""
    return spark.read.parquet(folder).where(F.col(key).eqNullSafe(F.lit(value)))


def write_dim(df: DataFrame, path: str) -> None:
    """Rewrite a dimension; the new rows may have been read from the same place."""
    durable(df).write.mode("overwrite").parquet(path)


def stage(tables: Mapping[str, DataFrame | None], root: str) -> list[str]:
    """Append each table that has rows to its folder below ``root``; returns the names written.

    A table is worked out and written once, into a hidden folder of the root; its files are then put beside those that the table has already.
    """
    written = []
    for name, df in tables.items():
        if df is None:
            continue
        spark, folder = df.sparkSession, f"{root}/_incoming/{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(folder)
        if not spark.read.schema(df.schema).parquet(folder).isEmpty():
            _put_files(spark, folder, f"{root}/{name}")
            written.append(name)
        _place(spark, folder)[0].delete(_place(spark, folder)[1], True)
    return written


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _put_files(spark: SparkSession, folder: str, to: str) -> None:
    """Rename the data files of a written table into another folder; their names hold an identifier of the write."""
    files, place = _place(spark, folder)
    target = _place(spark, to)[1]
    files.mkdirs(target)
    for status in files.listStatus(place):
        name = status.getPath().getName()
        if not name.startswith(("_", ".")) and not files.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(target, name)):
            raise FileExistsError(f"{to}/{name} can't be written")


def read_staged(spark: SparkSession, root: str, names: Iterable[str]) -> dict[str, DataFrame]:
    found = {name: read_if_present(spark, f"{root}/{name}") for name in names}
    return {name: df for name, df in found.items() if df is not None}


def next_upload(stored: DataFrame | None) -> int:
    """One more than the largest stored batch number; 1 for an empty store."""
    if stored is None:
        return 1
    return (stored.agg(F.max("upload_id")).first()[0] or 0) + 1


def stamp_upload(df: DataFrame, stored: DataFrame | None) -> DataFrame:
    return df.withColumn("upload_id", F.lit(next_upload(stored)).cast("long"))


# ----- run metadata -----------------------------------------------------------------------
def meta_row(spark: SparkSession, study: str, year: int, first_name: str, last_name: str, agency: str, data_type: str) -> DataFrame:
    row = (study, year, first_name, last_name, agency, data_type, datetime.now(timezone.utc))
    schema = schemas.struct(
        """
        project_code string
        year long
        principal_fname string
        principal_lname string
        agency string
        data_type string
        date_created_index timestamp
        """
    )
    return spark.createDataFrame([row], schema)


# ----- conforming ---------------------------------------------------------------------------
def _shaped(value: Column, have: T.DataType, want: T.DataType) -> Column:
    if isinstance(want, T.ArrayType):
        inner_have = have.elementType if isinstance(have, T.ArrayType) else T.NullType()
        made = F.transform(value, lambda x: _shaped(x, inner_have, want.elementType)) if isinstance(have, T.ArrayType) else F.lit(None).cast(want)
        return F.coalesce(made, F.array().cast(want))
    if isinstance(want, T.StructType):
        present = {f.name: f.dataType for f in have.fields} if isinstance(have, T.StructType) else {}
        return F.struct(
            *[
                (_shaped(value[f.name], present[f.name], f.dataType) if f.name in present else _shaped(F.lit(None), T.NullType(), f.dataType)).alias(f.name)
                for f in want.fields
            ]
        )
    return value.try_cast(want)


def conform(df: DataFrame, schema: T.StructType, keep: Iterable[str] = ()) -> DataFrame:
    """Cast and reorder to a fact schema: extras drop, absent columns are null, arrays never null.

    A null in a required column stays; ``validation.failed_constraints`` tells of it.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        if field.name in present:
            made = _shaped(F.col(field.name), present[field.name], field.dataType)
        else:
            made = _shaped(F.lit(None), T.NullType(), field.dataType)
        columns.append(made.alias(field.name))
    return df.select(*columns, *keep)
