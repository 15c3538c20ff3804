"""Readers and sinks.

Inputs are read with an explicit schema (CSV extracts as the original tool
writes them, or Parquet).  A CSV line that does not fit the schema ends the run
(``read_csv_input``), or goes to a quarantine table (``read_csv_checked``).

Outputs are written by Spark's writers; one-row reports go out as JSON.  The
schema of every report is stored beside it, so CSV and JSON are read back with
the types that were written.  With a run day, a report is a table partitioned by
``run_day`` of which a run replaces its own day only.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from . import schemas

# Tokens read as missing in CSV extracts.  The literal ``none`` (a decline
# reason) stays a value.
CSV_NULL = ""
BAD_LINE = "_bad_line"
RUN_DAY = "run_day"
SCHEMAS = "_schemas"
# CSV reports: an empty text is not a missing one.
REPORT_CSV = {"header": True, "nullValue": "\\N"}


def _csv_reader(spark: SparkSession, schema: T.StructType, mode: str):
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", mode)
        .option("nullValue", CSV_NULL)
        .option("dateFormat", "yyyy-MM-dd")
    )


def read_csv_input(spark: SparkSession, path: str, table: str) -> DataFrame:
    return _csv_reader(spark, schemas.INPUTS[table], "FAILFAST").csv(path)


@dataclass
class Checked:
    """An input of which malformed lines were set apart."""

    table: str
    rows: DataFrame
    quarantine: DataFrame


def read_csv_checked(spark: SparkSession, path: str, table: str, write=materialize) -> Checked:
    """A CSV extract as typed rows, and its malformed lines (too few or too many
    fields, a value of another type) as a table (table, path, line).

    The extract is parsed once, whole, into a written table that both read:
    what counts as malformed then does not depend on the columns a reader
    asks for."""
    schema = T.StructType([*schemas.INPUTS[table].fields, T.StructField(BAD_LINE, T.StringType())])
    parsed = _csv_reader(spark, schema, "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE).csv(path)
    parsed = write(parsed.withColumn("_path", F.input_file_name()), f"csv-{table}")
    bad = F.col(BAD_LINE).isNotNull()
    return Checked(
        table,
        parsed.where(~bad).select(*schemas.INPUTS[table].names),
        parsed.where(bad).select(F.lit(table).alias("table"), F.col("_path").alias("path"), F.col(BAD_LINE).alias("line")),
    )


def read_parquet_input(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_inputs(spark: SparkSession, directory: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """The six input tables from ``directory/<table>.<fmt>``."""
    out = {}
    for table in schemas.INPUTS:
        path = f"{directory.rstrip('/')}/{table}.{fmt}"
        out[table] = read_csv_input(spark, path, table) if fmt == "csv" else read_parquet_input(spark, path)
    return out


def read_inputs_checked(spark: SparkSession, directory: str, write=materialize) -> dict[str, Checked]:
    """The six CSV extracts of a folder, malformed lines set apart."""
    return {t: read_csv_checked(spark, f"{directory.rstrip('/')}/{t}.csv", t, write) for t in schemas.INPUTS}


def quarantined(inputs: dict[str, Checked]) -> DataFrame:
    """The malformed lines of all inputs."""
    return reduce(DataFrame.unionByName, [c.quarantine for c in inputs.values()])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "json":
        writer.json(path)
    else:
        writer.parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """A small report (already limited / one row): one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def _options(io, kind: str):
    return io.options(**REPORT_CSV) if kind == "csv" else io


def put_report(df: DataFrame, out_dir: str, name: str, fmt: str = "parquet", run_day: dt.date | None = None, one_row: bool = False) -> None:
    """Write a report to ``out_dir/name`` and its schema beside it.  With a run
    day, only that day of the report is replaced (dynamic partition overwrite);
    a day whose report has no rows is removed."""
    path = f"{out_dir.rstrip('/')}/{name}"
    put_text(df.sparkSession, schema_path(out_dir, name), df.schema.json())
    if run_day is None:
        if one_row:
            write_report(df, path)
        else:
            _options(df.write.mode("overwrite"), fmt).format(fmt).save(path)
        return
    day = (df.coalesce(1) if one_row else df).withColumn(RUN_DAY, F.lit(run_day))
    if day.isEmpty():
        drop_path(df.sparkSession, f"{path}/{RUN_DAY}={run_day.isoformat()}")
        return
    writer = day.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN_DAY)
    kind = "json" if one_row else fmt
    _options(writer, kind).format(kind).save(path)


def get_report(spark: SparkSession, out_dir: str, name: str, fmt: str = "parquet", run_day: dt.date | None = None, one_row: bool = False) -> DataFrame:
    """A report read back by its stored schema; with a run day, that day."""
    schema = T.StructType.fromJson(json.loads(get_text(spark, schema_path(out_dir, name))))
    kind = "json" if one_row else fmt
    path = f"{out_dir.rstrip('/')}/{name}"
    if run_day is not None:
        if not path_exists(spark, path):
            return spark.createDataFrame([], schema)
        schema = T.StructType([*schema.fields, T.StructField(RUN_DAY, T.DateType())])
    df = _options(spark.read.schema(schema), kind).format(kind).load(path)
    return df if run_day is None else df.where(F.col(RUN_DAY) == F.lit(run_day)).drop(RUN_DAY)


def read_outputs(spark: SparkSession, out_dir: str, names: list[str], one_row: set[str],
                 fmt: str = "parquet", run_day: dt.date | None = None) -> dict[str, DataFrame]:
    """Reports written by a batch run, read back for the read-side views."""
    return {n: get_report(spark, out_dir, n, fmt, run_day, n in one_row) for n in names}


# -- small files by the cluster's own file system ------------------------------
def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def schema_path(out_dir: str, name: str) -> str:
    return f"{out_dir.rstrip('/')}/{SCHEMAS}/{name}.json"


def put_text(spark: SparkSession, path: str, text: str) -> None:
    files, p = _file_system(spark, path)
    out = files.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def get_text(spark: SparkSession, path: str) -> str:
    files, p = _file_system(spark, path)
    source = files.open(p)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    source.close()
    return text


def path_exists(spark: SparkSession, path: str) -> bool:
    files, p = _file_system(spark, path)
    return files.exists(p)


def drop_path(spark: SparkSession, path: str) -> None:
    files, p = _file_system(spark, path)
    files.delete(p, True)
