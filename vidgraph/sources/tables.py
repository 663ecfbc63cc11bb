"""CSV / Parquet / any-format readers and writers for the catalogue and outputs.

* CSV follows the converter's dialect: header line, ``"`` doubles inner quotes
  (Spark's default escape is a backslash, which would not read such files
  back), blanks at the ends of a field are kept.  '' and null both come back
  as null.
* Tables default to Parquet; ``format``/``options`` pass through to any
  installed data source (e.g. a graph-store connector).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vidgraph.sources.files import with_rank

_CSV_READ = {"header": "true", "escape": '"', "mode": "PERMISSIVE"}
_CSV_WRITE = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "lineSep": "\n",
}


ROW_ORDER = ["_rank", "_block", "_pos"]


def csv_columns(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The header's column names."""
    return spark.read.options(**_CSV_READ).csv(path).columns


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType, with_order: bool = False) -> DataFrame:
    """The columns of ``schema`` (never inferred) of a header CSV, found by name.

    The header's order doesn't matter, further columns are skipped, a missing
    column is an error, and so is a file of a folder whose header differs from
    the first one's.  ``with_order`` adds ``ROW_ORDER``: the rows' place, files in the
    natural order of their names.
    """
    header = csv_columns(spark, path)
    missing = [c for c in schema.fieldNames() if c not in header]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in the CSV header of {path}")
    kinds = {f.name: f.dataType for f in schema.fields}
    full = StructType([StructField(c, kinds.get(c, StringType())) for c in header])
    df = spark.read.schema(full).options(**_CSV_READ, enforceSchema="false").csv(path)
    order = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
             F.monotonically_increasing_id().alias("_pos")] if with_order else []
    rows = df.select(*[F.col(f"`{c}`") for c in schema.fieldNames()], *order)
    return with_rank(rows, "_file", df.inputFiles(), "_rank").drop("_file") if with_order else rows


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> None:
    """Header CSV; ``single_file`` only for small results (one task writes it)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).options(**_CSV_WRITE).csv(path)


def read_table(spark: SparkSession, path: str | None = None, *, schema: StructType | None = None,
               format: str = "parquet", options: dict | None = None) -> DataFrame:
    reader = spark.read.format(format).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()


def write_table(df: DataFrame, path: str | None = None, *, mode: str = "overwrite",
                format: str = "parquet", options: dict | None = None) -> None:
    writer = df.write.mode(mode).format(format).options(**(options or {}))
    if path is None:
        writer.save()
    else:
        writer.save(path)
