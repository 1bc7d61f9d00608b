"""Dedupe, pivot, unpivot, stacking and sorting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seepline import vocab
from seepline.functions import species, values


def _ordering(names: list[str], nulls_last: bool = True) -> Column:
    """A struct that compares like the sorted rows, NULL after (or before) every value."""
    marks = {n: F.col(n).isNull() if nulls_last else F.col(n).isNotNull() for n in names}
    return F.struct(*[x for n in names for x in (marks[n].alias(f"_n_{n}"), F.col(n))])


def one_per_key(df: DataFrame, keys: list[str], last: bool = False) -> DataFrame:
    """The first (or last) row of each key in the order of all other columns. A value wins
    over NULL either way.

    An aggregate, not a window: each task keeps one row per key before the shuffle, so a
    key that holds a large share of the rows costs no more than any other.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    pick = F.max if last else F.min
    return (
        df.groupBy(*keys)
        .agg(pick(_ordering(rest, nulls_last=not last)).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
    )


def dedupe_unique_id(df: DataFrame) -> DataFrame:
    return one_per_key(df, ["uniqueid"])


def dedupe_stations(df: DataFrame) -> DataFrame:
    """One row per station id after the legacy prefix is taken off."""
    return one_per_key(df.withColumn("locationid", values.strip_wqx(F.col("locationid"))), ["locationid"])


def distinct_projects(df: DataFrame) -> DataFrame:
    return df.select("projectid").distinct()


#: names of symbols that a pivot takes as columns; a row marks those it holds in one long
NAMES_AT_ONCE = 60


def pivot_samples(results: DataFrame, chems: str | list[str] = "piper") -> DataFrame:
    """One row per sample, one column per symbol.

    Rows with a detection condition are left out. Of several rows for one symbol the
    first counts, in order of location, date and the remaining columns.

    A first pass finds the names in the table, as a laboratory reports the same few again and
    again. With them as columns, all rows of a sample, place and date become one before the
    shuffle, in a hash map of plain numbers: nothing is sorted and one narrow row is moved.
    Names beyond ``NAMES_AT_ONCE`` go the way of :func:`_first_rows`, which takes any.
    """
    rows = results.where(F.col("sampleid").isNotNull() & F.col("resultdetectioncondition").isNull())
    rows = rows.withColumn("symbol", species.param_abbrev(F.col("characteristicname")))
    found = rows.where(F.col("symbol") != "").select("characteristicname", "symbol").distinct().limit(NAMES_AT_ONCE + 1).collect()
    wide = _first_rows(rows) if len(found) > NAMES_AT_ONCE else _first_values(rows, dict(found))
    required = vocab.PIPER_REQUIRED if chems == "piper" else list(chems)
    return wide.dropna(how="any", subset=required) if required else wide


def _first_values(rows: DataFrame, symbols: dict[str, str]) -> DataFrame:
    """The pivot of rows with these names, each of which stands for a symbol.

    A sample has one place and date but for mistakes. Where it has more, the window takes each
    symbol from the first that holds it, even if its value there is NULL.
    """
    names = sorted(symbols, key=lambda n: n.encode())
    bits = {n: 1 << i for i, n in enumerate(names)}
    bit = F.coalesce(values.lookup(F.col("characteristicname"), bits), F.lit(0)) if bits else F.lit(0)
    place = ["monitoringlocationid", "sampledate"]
    placed = rows.groupBy("sampleid", *place).agg(
        F.bit_or(bit.cast("long")).alias("_held"),
        *[F.min(F.when(F.col("characteristicname") == n, F.col("resultvalue"))).alias(f"_v{i}") for i, n in enumerate(names)],
    )

    def holds(some: list[str]) -> Column:
        return F.col("_held").bitwiseAND(F.lit(sum(bits[n] for n in some)).cast("long")) != 0

    along = W.partitionBy("sampleid").orderBy(*[F.col(p).asc_nulls_last() for p in place])
    whole = along.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    none = F.lit(None).cast(rows.schema["resultvalue"].dataType)
    firsts = {}
    for symbol in dict.fromkeys(symbols.values()):
        mine = [n for n in names if symbols[n] == symbol]
        value = none
        for n in reversed(mine):
            value = F.when(holds([n]), F.col(f"_v{names.index(n)}")).otherwise(value)
        firsts[symbol] = F.first(F.when(holds(mine), F.struct(value.alias("value"))), ignorenulls=True).over(whole)
    first = placed.select("sampleid", *place, F.row_number().over(along).alias("_row"), *[c.alias(f"_s_{s}") for s, c in firsts.items()])
    return first.where("_row = 1").select(
        "sampledate", "monitoringlocationid", "sampleid",
        *[(F.col(f"_s_{s}.value") if s in firsts else none).alias(s) for s in vocab.SYMBOLS],
    )


def _first_rows(rows: DataFrame) -> DataFrame:
    """The pivot of rows with any number of names. The first aggregation leaves at most one row
    per sample and symbol, so the second shuffle moves no more than 46 rows of a sample."""
    order = ["monitoringlocationid", "sampledate", "characteristicname", "resultvalue"]
    first = rows.groupBy("sampleid", "symbol").agg(F.min(_ordering(order)).alias("_row"))
    # the place and date of a sample are those of its first row over all symbols
    wide = first.groupBy("sampleid").agg(
        F.min("_row").alias("_first"),
        *[F.max(F.when(F.col("symbol") == s, F.col("_row.resultvalue"))).alias(s) for s in vocab.SYMBOLS],
    )
    return wide.select(
        F.col("_first.sampledate").alias("sampledate"),
        F.col("_first.monitoringlocationid").alias("monitoringlocationid"),
        F.col("sampleid"),
        *vocab.SYMBOLS,
    )


def unpivot_field(activities: DataFrame, ids: list[str] | None = None) -> DataFrame:
    """Field readings, one row each, with name, unit and the field activity id."""
    readings = list(vocab.FIELD_READINGS)
    ids = ids or ["activityid"]
    names = {k: v[0] for k, v in vocab.FIELD_READINGS.items()}
    units = {k: v[1] for k, v in vocab.FIELD_READINGS.items()}
    return (
        activities.unpivot(ids, readings, "reading", "resultvalue")
        .where(F.col("resultvalue").isNotNull())
        .withColumns(
            {
                "activityid": values.field_activity_id(F.col("activityid")),
                "characteristicname": values.lookup(F.col("reading"), names),
                "resultunit": values.lookup(F.col("reading"), units),
            }
        )
        .drop("reading")
    )


def append_tables(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def _sorted(df: DataFrame, lead: list[str]) -> DataFrame:
    """Global order; the other columns settle ties, which also lets the range partitioner
    divide a location that holds a large share of the rows."""
    rest = [c for c in df.columns if c not in lead]
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in lead + rest])


def sort_results(df: DataFrame) -> DataFrame:
    return _sorted(df, ["monitoringlocationid", "sampledate"])


def sort_stations(df: DataFrame) -> DataFrame:
    return _sorted(df, ["locationid"])
