"""Headers, column order and constant columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seepline import schemas, vocab
from seepline.functions import values


def quoted(name: str):
    """A column whose name may hold dots, slashes or blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


def rename_station(df: DataFrame, side: str = "portal") -> DataFrame:
    headers = {"portal": vocab.STATION_HEADERS_PORTAL, "local": vocab.STATION_HEADERS_LOCAL}[side]
    return df.withColumnsRenamed(headers)


def rename_activity(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(vocab.ACTIVITY_HEADERS)


def rename_result(df: DataFrame, side: str = "portal") -> DataFrame:
    headers = {"portal": vocab.RESULT_HEADERS_PORTAL, "local": vocab.RESULT_HEADERS_LOCAL}[side]
    return df.withColumnsRenamed(headers)


def rename_epa_lab(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(vocab.EPA_HEADERS)


def rename_state_lab(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(vocab.STATE_HEADERS)


def harmonize_lab_headers(new: DataFrame, old: DataFrame) -> DataFrame:
    """Stack newer and older state laboratory files under one set of headers."""
    return (
        new.withColumnsRenamed(vocab.STATE_NEW_HEADERS)
        .unionByName(old.withColumnsRenamed(vocab.STATE_OLD_HEADERS), allowMissingColumns=True)
        .drop(*vocab.STATE_OLD_UNUSED)
    )


def drop_if_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Leave out the named columns, as far as present. Case counts: the portal column
    ``SampleTime`` goes, the canonical ``sampletime`` stays."""
    unwanted = set(names)
    return df.select(*[quoted(c) for c in df.columns if c not in unwanted])


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns without any value. One pass counts all columns and returns one row."""
    filled = df.agg(*[F.count(quoted(c)).alias(c) for c in df.columns]).first()
    return df.select(*[quoted(c) for c in df.columns if filled[c] > 0])


def project_fields(df: DataFrame, kind: str) -> DataFrame:
    return df.select(*schemas.FIELDS[kind])


def move_front(df: DataFrame, names: list[str], position: int = 1) -> DataFrame:
    """Move each of ``names`` in turn to ``position``, so the last of them ends up first there."""
    order = list(df.columns)
    for name in names:
        order.insert(position, order.pop(order.index(name)))
    return df.select(*[quoted(c) for c in order])


def add_upload_constants(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in vocab.UPLOAD_CONSTANTS.items()})


def none_to_null(df: DataFrame) -> DataFrame:
    """The text 'None' in any text column becomes NULL."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(quoted(c), F.lit("None")) for c in text})


def stamp_audit(df: DataFrame, user: str, when: str) -> DataFrame:
    """Who created and last edited the rows, and when (``yyyy-MM-dd HH:mm:ss``)."""
    moment = F.lit(when).cast("timestamp_ntz")
    return df.withColumns(
        {
            "created_user": F.lit(user),
            "last_edited_user": F.lit(user),
            "created_date": moment,
            "last_edited_date": moment,
        }
    )


def add_unique_id(
    df: DataFrame,
    location: str = "monitoringlocationid",
    activity: str = "activityid",
    characteristic: str = "characteristicname",
) -> DataFrame:
    return df.withColumn("uniqueid", values.unique_id(F.col(location), F.col(activity), F.col(characteristic)))
