"""Readers and writers: CSV or Parquet in, Parquet (or CSV) out."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from functools import partial, reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayside.config import WEATHER_RULES_CHECKING
from wayside.functions.temporal import parse_timestamp, repaired_text
from wayside.functions.text import categorize_text
from wayside.operators.aggregates import sort_output
from wayside.operators.cleaning import with_timestamps
from wayside.operators.star import Star
from wayside.session import materialize
from wayside.sources.publish import Publication, parent
from wayside.sources.records import csv_records, file_headers

# Declared types of the raw columns. Other columns stay text.
RAW_TYPES: dict[str, T.DataType] = {
    "ID": T.StringType(),
    "Severity": T.ByteType(),
    "City": T.StringType(),
    "State": T.StringType(),
    "Start_Lat": T.DoubleType(),
    "Start_Lng": T.DoubleType(),
    "End_Lat": T.DoubleType(),
    "End_Lng": T.DoubleType(),
    "Temperature(F)": T.DoubleType(),
    "Visibility(mi)": T.DoubleType(),
    "Precipitation(in)": T.DoubleType(),
    "Amenity": T.BooleanType(),
    "Crossing": T.BooleanType(),
    "Junction": T.BooleanType(),
    "Railway": T.BooleanType(),
    "Station": T.BooleanType(),
    "Stop": T.BooleanType(),
    "Traffic_Signal": T.BooleanType(),
    # numbers that the exploratory operators use
    "Distance(mi)": T.DoubleType(),
    "Humidity(%)": T.DoubleType(),
    "Pressure(in)": T.DoubleType(),
    "Wind_Chill(F)": T.DoubleType(),
    "Wind_Speed(mph)": T.DoubleType(),
    "row_seq": T.LongType(),
}

# Texts that a CSV of this kind uses for a missing value.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


def _missing_to_null(df: DataFrame) -> DataFrame:
    fixes = {}
    for f in df.schema:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(f"`{f.name}`")
            fixes[f.name] = F.when(~F.isnan(c), c)
    return df.withColumns(fixes) if fixes else df


#: Files of one header that are listed by name, at most.
LISTED = 1000
#: Column of the records that the CSV reader could not take as they are.
BAD_RECORD = "_bad_record"


def _names(header: str) -> list[str]:
    return next(csv.reader([header.removeprefix("\ufeff").rstrip("\r")]), [])


def _schema(header: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in (*_names(header), BAD_RECORD)])


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{c.replace('`', '``')}` string" for c in schema.names)


def _plain_path(uri: str) -> str:
    """A file's path as a reader takes it: not encoded, and without patterns."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


def _unbroken(spark: SparkSession, path: str, files: DataFrame, headers: Sequence[tuple[str, int]]) -> DataFrame:
    """The records of all files, a line each, by the header of their file.

    Files with the most frequent header are read together by their path; those of any other
    are listed if they are few.
    """
    parts = []
    for k, (header, n) in enumerate(headers):
        others = [h for h, _ in headers if h != header]
        reader = spark.read.options(**CSV_OPTIONS, columnNameOfCorruptRecord=BAD_RECORD, recursiveFileLookup=True)
        reader, name = reader.schema(_schema(header)), F.col("_metadata.file_path")
        if not others:
            parts.append(reader.csv(path))
        elif k and n <= LISTED:
            names = files.where(F.col("header") == header).select("file").collect()
            parts.append(reader.csv([_plain_path(r.file) for r in names]))
        elif sum(m for _, m in headers[1:]) <= LISTED:
            left_out = files.where(F.col("header").isin(others)).select("file").collect()
            parts.append(reader.csv(path).where(~name.isin([r.file for r in left_out])))
        else:
            mine = files.where(F.col("header") == header).select(F.col("file").alias("__file"))
            placed = reader.csv(path).withColumn("__path", name)
            parts.append(placed.join(mine, F.col("__path") == F.col("__file"), "left_semi").drop("__path"))
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), parts)


def _broken(spark: SparkSession, path: str, files: DataFrame, headers: Sequence[tuple[str, int]]) -> DataFrame:
    """The records of all files, whose quoted fields may hold line breaks; read once."""
    records = csv_records(spark, path)
    schemas = {header: _schema(header) for header, _ in headers}
    columns = list(dict.fromkeys(c for schema in schemas.values() for c in schema.names))
    options = {k: str(CSV_OPTIONS[k]) for k in ("quote", "escape")} | {"columnNameOfCorruptRecord": BAD_RECORD}

    def fields(header: str) -> Column:
        parsed = F.from_csv("record", _ddl(schemas[header]), options)
        have = schemas[header].names
        cells = [parsed[c].alias(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns]
        return F.struct(*cells)

    if len(headers) == 1:
        return records.select(fields(headers[0][0]).alias("r")).select("r.*")
    named = records.join(files.withColumnRenamed("file", "__file"), F.col("file") == F.col("__file"))
    cells = [F.when(F.col("header") == h, fields(h)) for h, _ in headers]
    return named.select(F.coalesce(*cells).alias("r")).select("r.*")


def read_incidents(
    spark: SparkSession, path: str, fmt: str = "csv", multi_line: bool = False, keep_bad: bool = False
) -> DataFrame:
    """The raw incident table with its two time columns parsed.

    For CSV each file's own header gives its column order; a column that a file lacks is
    null in its rows. The headers are found by a Spark job over the files' first splits.
    Declared columns get their type, without a pass over the data to infer it. NaN and, in
    a CSV, the texts that stand for a missing value become null, and damaged time texts are
    repaired as far as possible. ``multi_line`` allows line breaks inside quotes; a file is
    still read by as many tasks as it has splits (see ``records``). With ``keep_bad`` the
    column ``_bad_record`` holds the text of every record that does not fit its header or
    types (see ``bad_records``), else null.
    """
    try:
        if fmt == "csv":
            files = materialize(file_headers(spark, path))
            counted = files.groupBy("header").agg(F.count(F.lit(1)).alias("n"))
            headers = [tuple(r) for r in counted.orderBy(F.col("n").desc(), "header").collect()]
            if not headers:
                raise FileNotFoundError(path)
            raw = _typed((_broken if multi_line else _unbroken)(spark, path, files, headers))
        else:
            raw = spark.read.format(fmt).load(path)
            if keep_bad:
                raw = raw.withColumn(BAD_RECORD, F.lit(None).cast("string"))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from e
        raise
    found = _missing_to_null(with_timestamps(raw))
    return found if keep_bad else found.drop(BAD_RECORD)


def _typed(texts: DataFrame) -> DataFrame:
    """Declared columns in their types; a value that does not fit makes its record bad."""
    names = [c for c in texts.columns if c != BAD_RECORD]
    times = ("Start_Time", "End_Time")
    checked = [c for c in names if c in times or not isinstance(RAW_TYPES.get(c, T.StringType()), T.StringType)]
    known = {c: F.when(~F.col(f"`{c}`").isin(*MISSING_TEXTS), F.col(f"`{c}`")) for c in names}
    longer = max(map(len, names), default=0) + 1  # than any name of the table
    held = {c: str(i).rjust(longer, "_") for i, c in enumerate(checked)}
    # step by step, so that no text is looked at or parsed once more for the record's sake
    known_texts = texts.select(*[v.alias(held.get(c, c)) for c, v in known.items()], BAD_RECORD)
    out = {c: F.col(f"`{c}`") for c in names}
    for c, name in held.items():
        text = F.col(name)
        if c in times:
            out[c] = F.coalesce(parse_timestamp(text), parse_timestamp(repaired_text(text)))
        else:
            out[c] = text.try_cast(RAW_TYPES[c])
    typed = known_texts.select(*[v.alias(c) for c, v in out.items()], *held.values(), BAD_RECORD)
    misfit = {c: F.col(name).isNotNull() & F.col(f"`{c}`").isNull() for c, name in held.items()}
    which = F.array(*[F.when(odd, F.concat(F.lit(f"{c}="), F.col(held[c]))) for c, odd in misfit.items()])
    # a function on arrays keeps the long message out of the compiled loop, which the JVM
    # does not compile beyond 8,000 bytes
    message = F.array_join(F.filter(which, lambda w: w.isNotNull()), ", ")
    wrong = F.when(reduce(Column.__or__, misfit.values(), F.lit(False)), message)
    return typed.select(*[F.col(f"`{c}`") for c in names], F.coalesce(F.col(BAD_RECORD), wrong).alias(BAD_RECORD))


def bad_records(df: DataFrame) -> DataFrame:
    """One row: rows, and records that were not read as they are. ``df`` was read with ``keep_bad``.

    A record is bad if its number of fields is not its header's, or a value does not have
    the declared type; a text that stands for a missing value is not bad.
    """
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(BAD_RECORD).alias("n_bad"), F.min(BAD_RECORD).alias("example")
    )


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> None:
    """Write one output table; an older one stays until the new one is complete."""
    with Publication(df.sparkSession, parent(path)) as new:
        new.write(df, path, fmt, CSV_OPTIONS if fmt == "csv" else None, partition_by)


def clustered(df: DataFrame, by: str = "Start_Time", tie: str = "ID") -> DataFrame:
    """The rows dealt out and sorted by ranges of a column, as they should be written.

    A later filter on a range of it then skips most files and row groups. Equal values are
    parted by a second column, so a frequent one does not end in one task.
    """
    keys = [by, tie] if tie in df.columns else [by]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_small(name: str, df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a dimension or aggregate in its output order."""
    write_table(sort_output(name, df), path, fmt)


def star_paths(root: str) -> dict[str, str]:
    root = root.rstrip("/")
    return {
        "dim_time": f"{root}/dimensions/dim_time",
        "dim_location": f"{root}/dimensions/dim_location",
        "dim_weather": f"{root}/dimensions/dim_weather",
        "accident_detail": f"{root}/fact/accident_detail",
    }


def write_star(star: Star, root: str, fmt: str = "parquet", partition_fact: bool = False) -> None:
    """The four tables, which replace older ones together; the fact optionally in one folder per year."""
    paths, options = star_paths(root), CSV_OPTIONS if fmt == "csv" else None
    with Publication(star.accident_detail.sparkSession, root) as new:
        for name, df in star.tables().items():
            by = ["part_year"] if partition_fact and name == "accident_detail" else []
            rows = df.withColumn("part_year", F.year("full_date")) if by else sort_output(name, df)
            new.write(rows, paths[name], fmt, options, by)


def write_bucketed_star(star: Star, root: str, prefix: str, buckets: int) -> None:
    """The four tables as tables of the session's catalogue, ``<prefix>_<name>``, below ``root``.

    Fact and locations are stored in as many buckets by ``Location_id``, each sorted, so that
    joins on plain equality move no row of the fact (``orphans``, which lets a null match a
    null, still does). A bucket is read by one task: meant for keys none of which holds a
    large share of the rows; AQE splits such a key only in a join that shuffles.
    """
    for name, df in star.tables().items():
        writer = sort_output(name, df).write
        if name in ("accident_detail", "dim_location"):
            # dealt out as the buckets are, so that each is one file
            rows = df.repartition(buckets, "Location_id")
            writer = rows.write.bucketBy(buckets, "Location_id").sortBy("Location_id")
        path = star_paths(root)[name]
        writer.mode("overwrite").format("parquet").option("path", path).saveAsTable(f"{prefix}_{name}")


def read_bucketed_star(spark: SparkSession, prefix: str) -> Star:
    return star_of({name: spark.table(f"{prefix}_{name}") for name in star_paths("")})


def read_star(spark: SparkSession, root: str) -> Star:
    return star_of({name: read_table(spark, path) for name, path in star_paths(root).items()})


def star_of(tables: dict[str, DataFrame]) -> Star:
    """A star of stored tables by name."""
    tables = dict(tables)
    tables["accident_detail"] = tables["accident_detail"].drop("part_year").withColumn(
        "full_date", F.to_date("full_date")
    )
    tables["dim_time"] = tables["dim_time"].withColumn("Date", F.to_date("Date"))
    return Star(**tables)


def read_cleaned(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The cleaned table; the weather category is derived only if it is absent."""
    df = read_table(spark, path, fmt)
    if "Weather_Category" in df.columns:
        return df
    return df.withColumn(
        "Weather_Category", categorize_text("Weather_Condition", WEATHER_RULES_CHECKING)
    )
