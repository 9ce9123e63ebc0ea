"""Files in: place lists, metadata, raw reviews, dimensions, GeoJSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from voxspark import schemas as S
from voxspark.functions import parsers as P
from voxspark.operators.relational import cast_columns, union_all

# Writers double the quotes inside a quoted field and texts contain newlines.
_CSV = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}


def _stem(column: str = "_metadata.file_name"):
    return F.regexp_replace(F.col(column), r"\.[^.]*$", "")


def read_place_input(spark: SparkSession, path: str, pending_only: bool = True) -> DataFrame:
    """Place list with whatever of the known columns the file has, in any order.

    Files may begin with an empty line; only the open entries (done = 0) are
    kept unless asked otherwise.
    """
    raw = spark.read.options(**_CSV).csv(path)
    known = [
        (F.col(f.name).try_cast(f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in S.PLACE_INPUT.fields
    ]
    extra = [c for c in raw.columns if c not in S.PLACE_INPUT.names]
    places = raw.select(*known, *extra)
    return places.where(F.col("done") == 0) if pending_only else places


def raw_reviews(df: DataFrame, na_values: Sequence[str] = ()) -> DataFrame:
    """Type raw review rows: repeated header lines out, empty texts to NULL."""
    rows = df.where(F.col(S.REVIEW_FIELDS[0]).isNull() | (F.col(S.REVIEW_FIELDS[0]) != S.REVIEW_FIELDS[0]))
    rows = rows.withColumns({c: P.blank_to_null(c, tuple(na_values)) for c in S.REVIEW_FIELDS})
    return cast_columns(rows, S.REVIEW_TYPES)


def read_reviews(spark: SparkSession, path: str, na_values: Sequence[str] = ()) -> DataFrame:
    """All review files of a folder: 18 fixed fields, no header, tagged with the file stem."""
    options = {**_CSV, "header": "false", "pathGlobFilter": "*.csv"}
    rows = spark.read.schema(S.RAW_REVIEW).options(**options).csv(path)
    return raw_reviews(rows.select("*", _stem().alias("file_name")), na_values)


def read_reviews_with_header(spark: SparkSession, path: str, na_values: Sequence[str] = ()) -> DataFrame:
    """Review files that carry a header line of the same fields."""
    options = {**_CSV, "pathGlobFilter": "*.csv", "enforceSchema": "true"}
    rows = spark.read.schema(S.RAW_REVIEW).options(**options).csv(path)
    return raw_reviews(rows.select("*", _stem().alias("file_name")), na_values)


def read_place_meta(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One JSON object per file, or with ``lines`` one per line, tagged with the file stem; -1 reviews means unknown.

    A file per place costs some milliseconds each way, for the writer, the
    listing and the reader; many places belong in lines.
    """
    rows = (
        spark.read.schema(S.PLACE_META)
        .option("multiLine", not lines)
        .option("pathGlobFilter", "*.json")
        .json(path)
    )
    return rows.select("*", _stem().alias("file_name")).withColumnRenamed(
        "retrieval_date", "retrieval_date_metadata"
    ).withColumn("n_reviews", F.nullif(F.col("n_reviews"), F.lit(-1).cast("bigint")))


def read_union(spark: SparkSession, paths: Sequence[str], fmt: str = "csv", **options) -> DataFrame:
    """Union by name of exports whose columns may differ."""
    options = {**(_CSV if fmt == "csv" else {}), **options}
    return union_all([spark.read.format(fmt).options(**options).load(p) for p in paths])


def read_dim(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Small CSV table with a header."""
    return spark.read.schema(schema).options(**_CSV).csv(path)


def read_geojson_properties(spark: SparkSession, path: str) -> DataFrame:
    """The properties of every feature as a table."""
    rows = spark.read.option("multiLine", True).json(path)
    return rows.select(F.explode("features").alias("f")).select("f.properties.*")


def read_named_texts(spark: SparkSession, path: str) -> DataFrame:
    """(name, text) rows written by ``write_named_texts``."""
    return spark.read.schema("name STRING, text STRING").json(path)
