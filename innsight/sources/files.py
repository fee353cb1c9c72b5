"""File sources and sinks (SRC1-SRC3, SRC6-SRC8, SRC12).

Raw rental files are CSV with quoted free text; they are read with an
explicit schema (no inference pass over the data) by the names in their
header, multi-line records and ``"`` as escape.  Landing reads compressed
``*.csv.gz`` natively and writes Parquet, the format of every later layer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixtures as FX


def raw_schema(df: DataFrame) -> T.StructType:
    """The explicit schema of a raw frame (used to write and re-read CSV)."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])


def read_csv(spark: SparkSession, path: str, schema: T.StructType, columns: list[str] | None = None,
             date_columns: list[str] | None = None, multi_line: bool = True, corrupt: str | None = None) -> DataFrame:
    """SRC1 / SRC2: CSV scan.  Columns are taken by the name in the header,
    whatever their order; a column of ``schema`` that the files lack is null,
    one they have beyond it is left out, and files whose headers differ raise.
    Values that do not fit their type are null.  ``corrupt`` names a column
    for the text of malformed rows.  Without ``multi_line`` large files can be
    split; it is needed only where quoted text holds line breaks."""
    reader = lambda: (spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
                      .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    header = reader().option("inferSchema", False).csv(path).columns
    text = T.StructType([T.StructField(c, T.StringType()) for c in header] + ([T.StructField(corrupt, T.StringType())] if corrupt else []))
    raw = reader().schema(text).option("mode", "PERMISSIVE").option("enforceSchema", bool(corrupt))
    raw = (raw.option("columnNameOfCorruptRecord", corrupt) if corrupt else raw).csv(path)
    typed = [(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in header else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
    df = raw.select(*typed, *([F.col(corrupt)] if corrupt else []))
    if columns:
        df = df.select(*columns, *([corrupt] if corrupt else []))
    for c in date_columns or []:
        df = df.withColumn(c, F.col(c).try_cast("date"))
    return df


def read_text_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A CSV scan of text columns named by the header."""
    return (spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"').option("inferSchema", False)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


#: Types and the kinds of values that each holds; a column takes the first that holds all its values.
_HOLDS = {"int": ["int"], "bigint": ["int", "bigint"], "double": ["int", "bigint", "double"],
          "date": ["date"], "timestamp": ["date", "timestamp"], "boolean": ["boolean"]}
_KINDS = ["int", "bigint", "double", "date", "timestamp", "boolean", "string"]
_BIT = {k: 1 << i for i, k in enumerate(_KINDS)}
_WHOLE = "^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_MOMENT = "^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}|$)"


def _kind(v: Column) -> Column:
    """The bit of a value's kind, its narrowest type.  What a value begins
    with rules out most patterns: figures, signs and points sort before a
    colon, words after it, and a day has a dash in the fifth place."""
    bit = {k: F.lit(b) for k, b in _BIT.items()}
    whole = F.when(v.try_cast("int").isNotNull(), bit["int"]).when(v.try_cast("bigint").isNotNull(), bit["bigint"]).otherwise(bit["double"])
    moment = (F.when((F.length(v) < len("2025-01-01 00:00")) & v.try_cast("date").isNotNull(), bit["date"])
              .when(v.try_cast("timestamp").isNotNull(), bit["timestamp"]).otherwise(bit["string"]))
    figures = (F.when((F.substring(v, 5, 1) == "-") & v.rlike(_MOMENT), moment).when(v.rlike(_WHOLE), whole)
               .when(v.rlike(_NUMBER) | (v == "-Infinity"), bit["double"]).otherwise(bit["string"]))
    words = F.when(v.isin("NaN", "Infinity"), bit["double"]).when(F.lower(v).isin("true", "false"), bit["boolean"]).otherwise(bit["string"])
    return F.when(v < ":", figures).otherwise(words)


def inferred_types(df: DataFrame) -> DataFrame:
    """SRC1: ``(position, column_name, data_type)`` of the text columns of
    ``df``, from one aggregate over all rows: a column's type is the narrowest
    that holds every value that is neither null nor empty (int, bigint,
    double; date, timestamp; boolean), else string.  The outcomes are the
    kinds of values met, so neither the order of the rows nor their partitions
    matter, and a bad value in the last row is seen like one in the first.
    The rows are taken apart into values first, so that one short expression
    meets them all, however many columns there are.  A column without a
    value is a string, as are integers mixed with dates.  Integers beyond a
    bigint are doubles (the reader's own inference makes them decimals)."""
    if not df.columns:
        return df.sparkSession.createDataFrame([], "position int, column_name string, data_type string")
    names = df.columns
    rows = df.select(F.array(*[F.col(f"`{c}`") for c in names]).alias("row"))
    # and a row without values, so that a table without rows has its columns
    rows = rows.union(df.sparkSession.range(1).select(F.array_repeat(F.lit(None).cast("string"), len(names))))
    values = rows.select(F.posexplode("row").alias("position", "v"))
    met = values.groupBy("position").agg(F.coalesce(F.bit_or(F.when(F.col("v") != "", _kind(F.col("v")))), F.lit(0)).alias("met"))
    narrowest = F.when(F.col("met") == 0, "string")
    for t, kinds in _HOLDS.items():
        narrowest = narrowest.when(F.col("met").bitwiseAND(F.lit(sum(b for k, b in _BIT.items() if k not in kinds))) == 0, t)
    return met.select("position", F.element_at(F.array(*map(F.lit, names)), F.col("position") + 1).alias("column_name"),
                      narrowest.otherwise("string").alias("data_type"))


def read_inferred_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """SRC1: a CSV scan with the types of ``inferred_types`` (as many rows
    reach the driver as there are columns)."""
    text = read_text_csv(spark, path, multi_line)
    types = inferred_types(text).orderBy("position").collect()
    return text.select(*[F.nullif(F.col(f"`{r['column_name']}`"), F.lit("")).try_cast(r["data_type"]).alias(r["column_name"]) if r["data_type"] != "string"
                         else F.col(f"`{r['column_name']}`") for r in types])


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    w = (df.write.mode("overwrite").option("header", True).option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def land_sources(spark: SparkSession, config: list[tuple[str, str]], schema: T.StructType,
                 root: str) -> tuple[DataFrame, list[tuple[str, str]]]:
    """SRC3: land each configured (city, path) of ``*.csv.gz`` files as Parquet
    under ``root``; what is landed already is not read again.  A source that
    is missing or corrupt is reported and skipped, the others go on.  Returns
    (union of the landed sources with their city, [(city, error)])."""
    frames, failures = [], []
    jvm = spark.sparkContext._jvm
    fs_of = lambda p: p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for i, (city, path) in enumerate(config):
        landed = f"{root}/source={i}"
        done = jvm.org.apache.hadoop.fs.Path(f"{landed}/_SUCCESS")
        try:
            if not fs_of(done).exists(done):
                read_csv(spark, path, schema).write.mode("overwrite").parquet(landed)
            frames.append(spark.read.schema(schema).parquet(landed).withColumn("city", F.lit(city)))
        except Exception as e:  # noqa: BLE001 -- one source's failure is its own
            failures.append((city, f"{type(e).__name__}: {e}"))
    out = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("city", T.StringType())]))
    for f in frames:
        out = out.unionByName(f)
    return out, failures


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in FX.RAW_BUILDERS.items()}
