"""Readers. Schemas are given, never inferred; columns of text files are found by name.

Files of one source may list their columns in different orders, or have more or fewer:
``headers.py`` finds each file's header, and rows of all files are read in one scan.

Spark reads neither zip archives nor spreadsheets: portal downloads are landed unpacked or
gzipped, workbooks as CSV. Uncompressed CSV splits; a gzip file is one task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seepline import schemas, vocab
from seepline.sources.headers import Headers, read_headers

#: the line of a row whose number of fields differs from that of the widest header
_RAW = "_raw_line"
#: a text that no field holds
_NOTHING = "\x00"

TABLES = {"Station": schemas.STATION, "Activity": schemas.ACTIVITY, "Result": schemas.RESULT}


def _options(source: dict, kind: str) -> dict:
    """Connection options of one table: those for all tables, then its own."""
    shared = {k: v for k, v in source.items() if k not in TABLES}
    return shared | source.get(kind, {})


def checked(df: DataFrame, kind: str) -> DataFrame:
    """``df`` with the columns that the table's schema names cast to their types; a column
    whose type cannot become the named one, such as a struct for a number, stops the read."""
    known = {f.name: f.dataType for f in TABLES[kind].fields} if isinstance(TABLES[kind], T.StructType) else {}
    wrong = [
        f"{f.name}: {f.dataType.simpleString()}"
        for f in df.schema.fields
        if f.name in known and isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) != isinstance(known[f.name], (T.StructType, T.ArrayType, T.MapType))
    ]
    if wrong:
        raise TypeError(f"{kind} has columns that do not fit its schema: {', '.join(wrong)}")
    return df.withColumns({f.name: F.col(f.name).try_cast(known[f.name]) for f in df.schema.fields if f.name in known and f.dataType != known[f.name]})


def read_base_tables(
    spark: SparkSession,
    source: str | dict,
    names: dict[str, str] | None = None,
    fields: dict[str, list[str]] | None = None,
    where: dict[str, str] | None = None,
    kinds: Iterable[str] = ("Station", "Activity", "Result"),
) -> dict[str, DataFrame]:
    """The station, activity and result tables, or those of ``kinds``.

    ``source`` is a folder of parquet tables or the options of a JDBC connection. Under a
    table's kind it may hold options of that table alone, above all ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions``, with which the database is read in
    parallel. ``names`` maps table kinds to stored names. Columns and conditions are part of
    the plan, so both kinds of scan read no more than they need.
    """
    out = {}
    for kind in kinds:
        stored = (names or {}).get(kind, kind)
        if isinstance(source, dict):
            df = spark.read.format("jdbc").options(**_options(source, kind)).option("dbtable", stored).load()
        else:
            df = spark.read.parquet(f"{source.rstrip('/')}/{stored}")
        df = checked(df, kind)
        if where and kind in where:
            df = df.where(where[kind])
        if fields and kind in fields:
            df = df.select(*fields[kind])
        out[kind] = df
    return out


def _by_place(spark: SparkSession, paths, sep: str, extra: list[T.StructField], **options) -> tuple[DataFrame, Headers, list[str]]:
    """Rows of all files in one scan, their fields by place, with the number of their header
    and the path and name of their file."""
    headers = read_headers(spark, paths, sep)
    places = [f"_{i}" for i in range(max(1, headers.width))]
    schema = T.StructType([*(T.StructField(p, T.StringType()) for p in places), *extra])
    rows = spark.read.schema(schema).options(sep=sep, header=True, **options).csv(paths)
    rows = rows.withColumns({"_path": F.col("_metadata.file_path"), "_name": F.col("_metadata.file_name")})
    return headers.of_row(rows, "_path"), headers, places


def _named(rows: DataFrame, headers: Headers, places: list[str], columns: list[str], types: dict[str, T.DataType], more: dict[str, Column]) -> DataFrame:
    if not headers.names:
        schema = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in [*columns, *more]])
        return rows.sparkSession.createDataFrame([], schema)
    picked = [headers.column(c, places).try_cast(types.get(c, T.StringType())).alias(c) for c in columns]
    return rows.select(*picked, *[v.alias(k) for k, v in more.items()])


def read_lab_tsv(
    spark: SparkSession,
    paths: str | list[str],
    columns: list[str],
    exclude: Iterable[str] = (),
    drop_bad: bool = True,
) -> DataFrame:
    """Tab-delimited laboratory files, each row with its file.

    Files named in ``exclude`` (without extension) are left out. A row with fewer fields than
    its header ends in NULLs; one with more fields is dropped, or else stops the read.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _RAW, "columnPruning": False}  # all columns: whether a row fits
    rows, headers, places = _by_place(spark, paths, "\t", [T.StructField(_RAW, T.StringType())], **options)
    raw, width = F.col(_RAW), headers.pick([F.lit(len(names)) for names in headers.names]) if headers.names else F.lit(0)
    counted = F.length(F.regexp_replace(raw, '"[^"]*"', "")) - F.length(F.regexp_replace(raw, '"[^"]*"|\t', "")) + 1
    # a line is given for each row that has not as many fields as there are places; the last
    # condition never holds: a scan must read a column besides that line
    fits = (F.when(raw.isNull(), len(places)).otherwise(counted) <= width) | (F.col(places[0]) == _NOTHING)
    file = F.regexp_replace("_name", r"\.[^.]*$", "")
    names = list(exclude)
    if names:
        rows = rows.where(~file.isin(names))
    if drop_bad:
        rows = rows.where(fits)
    else:
        stop = F.raise_error(F.concat(F.lit("malformed row, more fields than headers, in "), file))
        file = F.when(fits, file).otherwise(stop.cast("string"))
    return _named(rows, headers, places, columns, {}, {"source_file": file})


def _csv(
    spark: SparkSession, path, columns: list[str], numbers: Iterable[str], multiline: bool = False
) -> DataFrame:
    """CSV with doubled quotes. Files split into many tasks unless ``multiline`` says that
    quoted fields hold line breaks; then each file is one task."""
    types = {c: T.DoubleType() for c in numbers}
    rows, headers, places = _by_place(spark, path, ",", [], escape='"', multiLine=multiline)
    return _named(rows, headers, places, columns, types, {})


def read_portal_results(
    spark: SparkSession, path, columns: list[str] | None = None, multiline: bool = False
) -> DataFrame:
    """A portal results extract: texts, except for four depths. Values stay text here, as
    they may carry marks; cleaning turns them into numbers."""
    return _csv(spark, path, columns or vocab.PORTAL_RESULT_COLUMNS, vocab.PORTAL_RESULT_NUMBERS, multiline)


def read_portal_stations(spark: SparkSession, path, columns: list[str] | None = None) -> DataFrame:
    if columns is None:
        columns = list(vocab.STATION_HEADERS_PORTAL) + vocab.PORTAL_STATION_UNUSED
    return _csv(spark, path, columns, vocab.PORTAL_STATION_NUMBERS)


def read_lab_sheet(spark: SparkSession, path, columns: list[str]) -> DataFrame:
    """A worksheet landed as CSV; sampling and analysis times become timestamps."""
    df = _csv(spark, path, columns, ["ReportLimit"])
    times = {c: F.col(c).try_cast("timestamp_ntz") for c in ("Sampled", "Analyzed") if c in columns}
    return df.withColumns(times)


def read_characteristic_domain(spark: SparkSession, path, columns: list[str]) -> DataFrame:
    """Characteristic names with group and registry numbers; one row per name, the greatest."""
    from seepline.operators.reshape import one_per_key

    listed = _csv(spark, path, columns, ()).select(*vocab.DOMAIN_COLUMNS)
    return one_per_key(listed, ["REGISTRY_NAME"], last=True)


def flatten_features(df: DataFrame, json_col: str, attributes: str | T.StructType) -> DataFrame:
    """Rows of ``features[].attributes`` in a JSON answer; ``attributes`` is their schema."""
    inner = attributes if isinstance(attributes, str) else attributes.simpleString()[7:-1]
    schema = f"features ARRAY<STRUCT<attributes: STRUCT<{inner}>>>"
    parsed = df.select(F.from_json(F.col(json_col), schema).alias("_answer"))
    return parsed.select(F.explode("_answer.features").alias("_feature")).select("_feature.attributes.*")


def read_features(spark: SparkSession, paths: str | list[str], attributes: str | T.StructType) -> DataFrame:
    """Rows of ``features[].attributes`` in JSON answers of any size, read from their files.

    The files are cut before each element while they are read, so that an answer is never one
    row: a large one is many splits, and a task holds one element at a time. A text equal to
    ``"attributes"`` among an element's values would end that element early; it stops the read.
    """
    inner = attributes if isinstance(attributes, str) else attributes.simpleString()[7:-1]
    rows = spark.read.option("lineSep", '"attributes"').text(paths)
    element = F.col("value").rlike(r"^\s*:\s*\{")
    # what stands before a file's first element, of which an answer without elements is all
    head = F.col("value").rlike("^[\\s\ufeff]*[{\\[]")
    stop = F.raise_error(F.lit('a value equal to "attributes" in an answer')).cast("string")
    text = F.when(element, F.regexp_replace("value", r"^\s*:\s*", "")).when(~head, stop)
    # whatever follows the first object is not parsed
    return rows.select(text.alias("_text")).where("_text IS NOT NULL").select(F.from_json("_text", inner).alias("_row")).select("_row.*")
