"""Typed scans (S1), CSV staging (S2/S6), catalog reads (S3), the table sink
(S4/S5) and read-back / schema description (S7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

L, S, TS = T.LongType(), T.StringType(), T.TimestampType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw source schemas (column names and types fixed by the source system).
SOURCE_SCHEMAS = {
    "internet": _schema(("CUST_NUM", L), ("EVT_DT", TS), ("WEBSITE_TYPE", S), ("DURATION", L)),
    "tv": _schema(("CUST_NUM", L), ("EVT_DT", TS), ("TV_PROGRAM", S), ("DURATION", L)),
    "mobile": _schema(("CUST_NUM", L), ("EVT_DT", TS), ("OUT_OF_BUNDLE", L)),
    "journeys": _schema(("CUST_NUM", L), ("EVT_DT", TS), ("CONTACT_TYPE", S), ("NB_CONTACTS", L)),
    "socio_demo": _schema(("CUST_NUM", L), ("EVT_DT", TS), ("CUST_AGE", L), ("NB_MOBILE_SUBS", L),
                          ("NB_DAYS_INTERNET_LINE", L), ("NB_DAYS_TV_LINE", L)),
    "requests": _schema(("CUST_NUM", L), ("EVT_DT", TS), ("EVENT_TYPE", S)),
}

# Customer staging layout (declared DDL of the load; VARCHAR(n) becomes string).
CUSTOMER_SCHEMA = T.StructType([
    T.StructField("cust_num", L, True), T.StructField("first_name", S, True),
    T.StructField("country", S, True), T.StructField("city", S, True),
    T.StructField("birth_date", T.DateType(), True)])


# The staging table of the customer load, with the longest text of each column, and the
# columns that the load names (all but phone_type).
STAGING_COLUMNS = [("customer_id", S, 10), ("first_name", S, 20), ("last_name", S, 20), ("gender", T.BooleanType(), None),
                   ("nationality", S, 20), ("birth_date", T.DateType(), None), ("street_address", S, 50), ("city", S, 50), ("postal_code", S, 10),
                   ("country", S, 20), ("phone_number", S, 20), ("phone_type", T.BooleanType(), None), ("email_address", S, 50)]
LOAD_LIST = [name for name, _, _ in STAGING_COLUMNS if name != "phone_type"]


def scan_typed(spark: SparkSession, source: str, root: str, schema: T.StructType | None = None,
               timestamp_ntz: bool = False,
               pattern: str = "{root}/{source}/*/{source}.parquet") -> DataFrame:
    """``<root>/<source>/*/<source>.parquet`` with a fixed schema.

    One folder per landing day; the glob is expanded by the file index on the
    driver, the files are read by the executors. Passing the schema skips
    footer inference across thousands of files.
    """
    schema = schema or SOURCE_SCHEMAS[source]
    if timestamp_ntz:
        schema = T.StructType([T.StructField(f.name, T.TimestampNTZType() if f.dataType == TS
                                             else f.dataType, f.nullable) for f in schema.fields])
    return spark.read.schema(schema).parquet(pattern.format(root=root.rstrip("/"), source=source))


def load_csv(spark: SparkSession, path: str, schema: T.StructType = CUSTOMER_SCHEMA,
             header: bool = True) -> DataFrame:
    """Bulk-load a CSV file with a declared column list into a typed
    staging frame. The staging frame is a temp view, so there is nothing to drop."""
    return (spark.read.schema(schema).option("header", str(header).lower())
            .option("mode", "FAILFAST").csv(path))


def load_staging(spark: SparkSession, path: str, load_list: list[str] = LOAD_LIST, columns: list[tuple] = STAGING_COLUMNS,
                 header: bool = False) -> tuple[DataFrame, DataFrame]:
    """Bulk-load CSV files into a declared staging layout by a column list.

    The files' columns are those of ``load_list``, in its order; staging columns that it leaves out are absent
    from the staged frame, so that an upsert keeps their values (H10). Returns the rows that fit the
    declaration, and the others as (row: the line or its fields, reason): a line of too few or too many
    fields, a text longer than its column, a value that is no date or no boolean, or no ``customer_id``."""
    kinds = {name: (kind, most) for name, kind, most in columns}
    if unknown := [c for c in load_list if c not in kinds]:
        raise ValueError(f"no such staging column: {', '.join(unknown)}")
    layout = T.StructType([T.StructField(c, S) for c in load_list] + [T.StructField("_line", S)])
    raw = (spark.read.schema(layout).option("header", str(header).lower()).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_line").csv(path))   # all columns are text: a line is marked only by its number of fields
    checks = [F.when(F.col("_line").isNotNull(), F.lit(f"not {len(load_list)} fields"))]
    if "customer_id" in load_list:
        checks.append(F.when(F.col("customer_id").isNull(), F.lit("no customer_id")))
    typed = []
    for c in load_list:
        kind, most = kinds[c]
        if kind == S:
            typed.append(F.col(c))
            checks.append(F.when(F.char_length(F.col(c)) > most, F.lit(f"{c} longer than {most}")))
        else:
            value = F.expr(f"try_cast(trim(`{c}`) as {kind.simpleString()})")
            typed.append(value.alias(c))
            checks.append(F.when(F.col(c).isNotNull() & value.isNull(), F.lit(f"{c} is no {kind.simpleString()}")))
    marked = raw.withColumn("_reasons", F.array_compact(F.array(*checks)))
    good = marked.where(F.size("_reasons") == 0).select(*typed)
    bad = marked.where(F.size("_reasons") > 0).select(F.coalesce("_line", F.to_json(F.struct(*load_list))).alias("row"), F.array_join("_reasons", "; ").alias("reason"))
    return good, bad


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def save_table(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet",
               partition_by: list[str] | None = None) -> DataFrame:
    """Replace a catalog table with the frame (drop-if-exists + create in one
    overwrite) and return the table read back; ``commits.replace_table`` replaces a table
    in one step for its readers. ``fmt='delta'`` works where the
    Delta jar is installed; the default is Parquet."""
    spark = df.sparkSession
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return spark.table(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """S3."""
    return spark.table(name)


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    """Column name, type and nullability of a table (``DESCRIBE``)."""
    return spark.sql(f"DESCRIBE TABLE {name}")
