"""Scans: text lines and CSV tables with a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed schemas of the reference inputs. The scanner profile is always read
# with a schema: inference turns "2000-12" into a timestamp and changes the
# column type from file to file.
SCANNER_SCHEMA = T.StructType(
    [
        T.StructField("numports", T.IntegerType(), True),
        T.StructField("ports_scanned_str", T.StringType(), True),
        T.StructField("mirai", T.BooleanType(), True),
    ]
)

DIAGNOSIS_FEATURES = [
    "clump_thickness",
    "unif_cell_size",
    "unif_cell_shape",
    "marg_adhesion",
    "single_epith_cell_size",
    "bare_nuclei",
    "bland_chrom",
    "norm_nucleoli",
    "mitoses",
]

DIAGNOSIS_SCHEMA = T.StructType(
    [T.StructField("id", T.IntegerType(), True)]
    + [T.StructField(name, T.IntegerType(), True) for name in DIAGNOSIS_FEATURES]
    + [T.StructField("class", T.StringType(), True)]
)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value`` (string)."""
    return spark.read.text(path)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    header: bool = True,
    extra_columns_as_string: bool = False,
) -> DataFrame:
    """CSV scan with an explicit schema, PERMISSIVE mode.

    Cells that do not parse as the declared type become null (the diagnosis
    table marks missing values with "?"). ``header`` is an argument because
    the flag drops the first line whether or not it is a header.

    With ``extra_columns_as_string`` the header is read first and every column
    not named in ``schema`` is kept as a string, so whole-row outputs carry
    them untouched.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)  # noqa: SLF001 - public DDL parser
    if extra_columns_as_string and header:
        names = spark.read.option("header", True).csv(path).columns
        known = {f.name: f for f in schema.fields}
        schema = T.StructType(
            [known.get(n, T.StructField(n, T.StringType(), True)) for n in names]
        )
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def missing_causes(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True, marker: str = "?") -> DataFrame:
    """(column, cause, n): why cells of the columns that are not strings read as null.

    One scan of the cells as strings, each cast to its column's type: ``empty``,
    ``marker`` (the sign for a missing value), ``overflow`` (a whole number beyond the type) or
    ``unparseable``; ``absent`` are the cells without a value of lines that have another
    number of cells than the schema (the corrupt-record column tells them). White
    space round a whole number makes it unparseable, as for the typed scan.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)  # noqa: SLF001 - public DDL parser
    plain = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField("_corrupt_record", T.StringType())])
    cells = spark.read.schema(plain).option("header", header).option("mode", "PERMISSIVE").option("columnPruning", False).csv(path)

    def cause(field: T.StructField):
        cell = F.trim(F.col(f"`{field.name}`"))
        whole = isinstance(field.dataType, T.IntegralType)
        why = (
            F.when(cell.isNull() & F.col("_corrupt_record").isNotNull(), "absent").when(cell.isNull() | (cell == ""), "empty").when(cell == marker, "marker")
            .when(cell.try_cast(field.dataType).isNotNull() & ~(F.lit(whole) & (cell != F.col(f"`{field.name}`"))), None)
            .when(F.lit(whole) & F.col(f"`{field.name}`").rlike(r"^[+-]?[0-9]+$"), "overflow").otherwise("unparseable")
        )
        return F.struct(F.lit(field.name).alias("column"), why.alias("cause"))

    typed = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    found = cells.select(F.inline(F.array(*map(cause, typed)))).where("cause IS NOT NULL")
    return found.groupBy("column", "cause").agg(F.count(F.lit(1)).alias("n"))


def read_scanner_profile(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, SCANNER_SCHEMA, header=True, extra_columns_as_string=True)


def read_diagnosis(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    return read_table(spark, path, DIAGNOSIS_SCHEMA, header=header)
