"""Readers for the landing zone: wide CSV, JSON documents of parallel arrays,
Parquet raw tables and typed seeds; plus early column/row scoping."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmix import schemas
from gridmix.constants import OWID_COLUMNS, WEATHER_FIELDS
from gridmix.functions.calendar import as_date, days_before
from gridmix.operators.sets import union_frames

log = logging.getLogger(__name__)


def project_available(df: DataFrame, cols: list) -> tuple[DataFrame, list]:
    """Keep the wanted columns that exist; return the frame and the missing names."""
    available = [c for c in cols if c in df.columns]
    missing = [c for c in cols if c not in df.columns]
    if missing:
        log.warning("columns not found in source: %s", missing)
    return df.select(*available), missing


def scope_filter(df: DataFrame, key: str, keys: list, year_col: str | None = None,
                 lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Rows whose ``key`` is in ``keys`` and whose ``year_col`` lies in [lo, hi].

    Both predicates are plain comparisons, so Parquet scans get them pushed down.
    """
    cond = F.col(key).isin(list(keys))
    if year_col is not None:
        cond = cond & F.col(year_col).between(lo, hi)
    return df.filter(cond)


def recent_days(df: DataFrame, date_col: str, n: int, as_of=None) -> DataFrame:
    """Development sample: rows of the last ``n`` days before ``as_of`` (default today)."""
    anchor = F.current_date() if as_of is None else as_date(as_of)
    return df.filter(F.col(date_col) >= days_before(anchor, n))


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the columns present in ``df`` to the declared types (bad values -> NULL)."""
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c)
                       for c in df.columns])


def bad_values(df: DataFrame, schema: T.StructType) -> Column:
    """Number of a row's fields whose text is no value of the declared type."""
    types = {f.name: f.dataType for f in schema.fields}
    bad = [(F.col(c).isNotNull() & F.col(c).try_cast(types[c]).isNull()).cast("int")
           for c in df.columns if c in types]
    return reduce(lambda x, y: x + y, bad, F.lit(0))


#: A rejected record: where it is from, why it was rejected, its first field, and the record as it stands.
REJECTS = ["source", "file", "reason", "key", "record"]


def read_owid(spark: SparkSession, path: str, columns: list | None = None,
              bad_col: str | None = None) -> tuple[DataFrame, list]:
    """Wide CSV with header -> the wanted columns that exist, typed; plus missing names.

    ``path`` is a file or a folder of files. Columns are found by name in each
    file, whatever their order there: files with the same header are read
    together, and a column that a file lacks is NULL in its rows. Missing are the
    names that no file has. The rows are read as text columns (no inference pass
    over the data) and only the wanted columns are parsed thanks to CSV column
    pruning. ``bad_col`` names a column that counts, for each row, the fields that
    became NULL for their text.
    """
    frames = [spark.read.option("header", True).option("inferSchema", False).csv(files)
              for files in files_by_header(spark, path).values()]
    return _named(frames, columns or OWID_COLUMNS, bad_col)


def split_owid(spark: SparkSession, path: str, columns: list | None = None,
               bad_col: str | None = None) -> tuple[DataFrame, list, DataFrame]:
    """As ``read_owid``, without the records that have more or fewer fields than their file's header;
    those are returned last (REJECTS). Each record is in one of the two."""
    good, rejected = [], []
    for header, files in files_by_header(spark, path).items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, _RECORD)])
        # All columns are parsed: with pruned ones a record of too few fields would go unnoticed.
        raw = (spark.read.schema(schema).option("header", True).option("columnPruning", False)
               .option("columnNameOfCorruptRecord", _RECORD).csv(files))
        good.append(raw.filter(F.col(_RECORD).isNull()).drop(_RECORD))
        rejected.append(raw.filter(F.col(_RECORD).isNotNull()).select(
            F.lit("owid_energy").alias("source"), F.col("_metadata.file_path").alias("file"),
            F.lit(f"not the {len(header)} fields of the header").alias("reason"),
            F.col(f"`{header[0]}`").alias("key"), F.col(_RECORD).alias("record")))
    rows, missing = _named(good, columns or OWID_COLUMNS, bad_col)
    return rows, missing, union_frames(*rejected)


_RECORD = "_record"


def _named(frames: list, wanted: list, bad_col: str | None) -> tuple[DataFrame, list]:
    """The wanted columns of several frames of text, by name, typed and together; plus the names none has."""
    available = [c for c in wanted if any(c in raw.columns for raw in frames)]
    missing = [c for c in wanted if c not in available]
    if missing:
        log.warning("columns not found in source: %s", missing)
    typed = []
    for raw in frames:
        own = raw.select(*[F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in available])
        if bad_col is not None:
            own = own.withColumn(bad_col, bad_values(own, schemas.OWID_RAW))
        typed.append(_typed(own, schemas.OWID_RAW))
    return union_frames(*typed), missing


def files_by_header(spark: SparkSession, path: str) -> dict[tuple, list]:
    """The CSV files at ``path`` by their header, its names in the file's order.

    Reads the first line of each file, one small job a file (a landing folder
    holds one file a delivery).
    """
    out: dict[tuple, list] = {}
    for file in sorted(spark.read.text(path).inputFiles()):
        header = tuple(spark.read.option("header", True).option("inferSchema", False).csv(file).columns)
        out.setdefault(header, []).append(file)
    return out


def zip_arrays_to_rows(df: DataFrame, arrays_col: str, fields: list, time_field: str = "time",
                       out_time: str = "date", keep: list | None = None) -> DataFrame:
    """One row per array position from a struct of parallel arrays.

    ``arrays_zip`` pairs element i of every array (shorter arrays pad with NULL)
    and ``inline`` turns the zipped structs into rows, all inside one task per
    document; ``keep`` columns are repeated on every row.
    """
    keep = keep or []
    names = [time_field] + list(fields)
    # Without an array of times there are no rows; any other array that is missing is one of NULLs.
    arrays = [F.col(f"{arrays_col}.{n}") for n in names]
    zipped = F.arrays_zip(arrays[0], *[F.coalesce(a, F.array()) for a in arrays[1:]])
    exploded = df.select(*keep, F.inline(zipped))
    # Rename positionally: the zipped struct's field names depend on the inputs.
    zcols = exploded.columns[len(keep):]
    return exploded.select(*keep, *[F.col(z).alias(out_time if i == 0 else names[i])
                                    for i, z in enumerate(zcols)])


def read_weather_json(spark: SparkSession, path: str, country: str | None = None,
                      country_pattern: str | None = None, of_path: bool = False) -> DataFrame:
    """JSON documents of parallel daily arrays -> raw weather rows.

    The country code is either a constant (one document per call, as the API
    returns it) or extracted from each file's name with ``country_pattern``
    (first regex group; of its whole path with ``of_path``), which lets one read
    cover a whole landing folder.
    """
    docs = spark.read.schema(schemas.WEATHER_JSON).option("multiLine", True).json(path)
    if country is not None:
        docs = docs.withColumn("country_code", F.lit(country))
    elif country_pattern is not None:
        docs = docs.withColumn("country_code",
                               F.regexp_extract(F.col("_metadata.file_path" if of_path else "_metadata.file_name"),
                                                country_pattern, 1))
    else:
        raise ValueError("give country or country_pattern")
    rows = zip_arrays_to_rows(docs, "daily", WEATHER_FIELDS, "time", "date", keep=["country_code"])
    return rows.select("country_code", "date", *WEATHER_FIELDS)


def split_weather_json(spark: SparkSession, path: str, country_pattern: str) -> tuple[DataFrame, DataFrame]:
    """Raw weather rows of a landing folder, and the documents that give none (REJECTS): unreadable ones, those
    without a country in their file name, without days, or with arrays of unequal length, whose values could
    not be told to days."""
    schema = T.StructType([*schemas.WEATHER_JSON.fields, T.StructField(_RECORD, T.StringType())])
    docs = spark.read.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", _RECORD).json(path)
    arrays = [F.col(f"daily.{c}") for c in ("time", *WEATHER_FIELDS)]
    lengths = F.array_compact(F.array(*[F.size(F.when(a.isNotNull(), a)) for a in arrays]))
    code = F.regexp_extract(F.col("_metadata.file_name"), country_pattern, 1)
    reason = (F.when(F.col(_RECORD).isNotNull(), F.lit("no readable document"))
              .when(F.col("daily.time").isNull(), F.lit("no array of days"))
              .when(F.array_min(lengths) != F.array_max(lengths),
                    F.concat(F.lit("arrays of "), F.array_min(lengths), F.lit(" to "), F.array_max(lengths), F.lit(" values")))
              .when(code == "", F.lit("no country in the file name")))
    judged = docs.select("daily", _RECORD, code.alias("country_code"), F.col("_metadata.file_path").alias("file"), reason.alias("reason"))
    rows = zip_arrays_to_rows(judged.filter(F.col("reason").isNull()), "daily", WEATHER_FIELDS, "time", "date", keep=["country_code"])
    rejected = judged.filter(F.col("reason").isNotNull()).select(
        F.lit("weather_daily").alias("source"), "file", "reason", F.col("country_code").alias("key"),
        F.coalesce(_RECORD, F.to_json("daily")).alias("record"))
    return rows.select("country_code", "date", *WEATHER_FIELDS), rejected


def read_generation(spark: SparkSession, path: str) -> DataFrame:
    """Raw hourly generation (Parquet) with the declared schema."""
    return spark.read.schema(schemas.GENERATION_RAW).parquet(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Seed CSV with header and declared column types; empty field -> NULL."""
    return (spark.read.schema(schema).option("header", True)
            .option("enforceSchema", False).option("mode", "FAILFAST").csv(path))
