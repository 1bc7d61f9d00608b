"""Joins, membership and lookups.

A side is broadcast only when its size is below ``spark.sql.autoBroadcastJoinThreshold``, by
statistics or by adaptive execution; beyond that the join is shuffled, and adaptive execution
splits hot keys on the row side.
Where a join only asks whether a key occurs, the asked side is reduced to its distinct
keys before the shuffle, so a key that is hot there arrives as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seepline import schemas, vocab
from seepline.functions import places, values
from seepline.operators import projection
from seepline.operators.reshape import one_per_key

#: station rules in one projection
RULES_AT_ONCE = 22


def _pick(df: DataFrame, names: list[str]) -> list[Column]:
    """Columns in the given order; a column the table lacks is NULL of its type."""
    have = set(df.columns)
    return [
        df[n] if n in have else F.lit(None).cast(schemas.field_type(n)).alias(n) for n in names
    ]


def result_activity(results: DataFrame, activities: DataFrame) -> DataFrame:
    """Every result with its activity, the upload constants and the activity type."""
    joined = results.join(activities, results["activityid"] == activities["activityid"], "left").select(
        *_pick(results, schemas.JOINED_RESULT_FIELDS),
        *_pick(activities, schemas.JOINED_ACTIVITY_FIELDS),
    )
    return projection.add_upload_constants(joined).withColumn(
        "activitytype", values.activity_type(F.col("activityid"))
    )


def result_activity_view(results: DataFrame, activities: DataFrame) -> DataFrame:
    """Results that have an activity, the activity's columns first."""
    return results.join(activities, results["activityid"] == activities["activityid"], "inner").select(
        *_pick(activities, schemas.VIEW_ACTIVITY_FIELDS), *_pick(results, schemas.VIEW_RESULT_FIELDS)
    )


# --- local against published -------------------------------------------------


def _keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).alias("_key")).where(F.col("_key").isNotNull()).distinct()


def flag_inwqx(local: DataFrame, published: DataFrame, key: str) -> DataFrame:
    """1 where the key is published, else 0."""
    known = _keys(published, key)
    return (
        local.join(known, local[key] == known["_key"], "left")
        .withColumn("inwqx", F.col("_key").isNotNull().cast("int"))
        .drop("_key")
    )


def apply_inwqx(table: DataFrame, published: DataFrame, key: str) -> DataFrame:
    """Set the flag of published rows, leave it elsewhere."""
    known = _keys(published, key)
    return (
        table.join(known, table[key] == known["_key"], "left")
        .withColumn("inwqx", F.when(F.col("_key").isNotNull(), 1).otherwise(F.col("inwqx")))
        .drop("_key")
    )


def to_upload(local: DataFrame, published: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not published; a row without key stays."""
    known = _keys(published, key)
    return local.join(known, local[key] == known["_key"], "left_anti")


def published_results(df: DataFrame) -> DataFrame:
    """Portal results with the organisation prefix taken off each compared key."""
    return projection.add_unique_id(
        df.withColumns(
            {
                c: values.strip_org_prefix(F.col(c))
                for c in ("activityid", "monitoringlocationid")
                if c in df.columns
            }
        )
    )


def new_activities(lab: DataFrame, activities: DataFrame) -> DataFrame:
    """One row for each activity the database lacks.

    The laboratory rows are reduced to one per activity before the join, so an activity
    with many results is one row there.
    """
    distinct = one_per_key(lab.select(*_pick(lab, schemas.FIELDS["Activity"])), ["activityid"])
    return to_upload(distinct, activities, "activityid")


def new_results(lab: DataFrame, results: DataFrame) -> DataFrame:
    """Rows whose activity has no results in the database yet."""
    fresh = to_upload(lab, results, "activityid")
    return fresh.select(*_pick(fresh, schemas.FIELDS["Result"]))


def senders_only(rows: DataFrame, stations: DataFrame, location: str = "monitoringlocationid") -> DataFrame:
    senders = _keys(stations.where(F.col("send").cast("string") == "1"), "locationid")
    return rows.join(senders, rows[location] == senders["_key"], "left_semi")


def cross_select(
    selected: DataFrame,
    target: DataFrame,
    selected_key: str = "monitoringlocationid",
    target_key: str = "monitoringlocationid",
) -> DataFrame:
    """Rows of ``target`` at the locations of ``selected``; repeated rows stay."""
    chosen = _keys(selected, selected_key)
    return target.join(chosen, target[target_key] == chosen["_key"], "left_semi")


# --- dimension tables --------------------------------------------------------


def attach(
    rows: DataFrame, dimension: DataFrame, row_key: str, dim_key: str, columns: dict[str, str], order: str | None = None
) -> DataFrame:
    """Left join one row per key of ``dimension``; ``columns`` maps its names to new ones.

    When a key repeats in the dimension, the last row by ``order`` counts, or without such a
    column the greatest, where a value is greater than NULL.
    """
    listed = [F.col(order).alias("_order")] if order else []
    dim = dimension.select(
        F.col(dim_key).alias("_key"), *listed, *[F.col(c).alias(f"_{c}") for c in columns]
    ).where(F.col("_key").isNotNull())
    dim = one_per_key(dim, ["_key"], last=True).drop("_order")
    return (
        rows.join(dim, rows[row_key] == dim["_key"], "left")
        .withColumns({new: F.col(f"_{old}") for old, new in columns.items()})
        .drop("_key", *[f"_{c}" for c in columns])
    )


def characteristic_group(rows: DataFrame, domain: DataFrame, name: str = "characteristicname") -> DataFrame:
    return attach(
        rows, domain, name, "REGISTRY_NAME", {"CHARACTERISTIC_GROUP_TYPE": "characteristicgroup"}
    )


def missing_characteristics(rows: DataFrame, domain: DataFrame, name: str = "characteristicname") -> DataFrame:
    """Distinct names the domain list does not hold."""
    names = rows.select(name).distinct()
    listed = _keys(domain, "REGISTRY_NAME")
    return names.join(listed, names[name] == listed["_key"], "left_anti")


def sample_station_lookup(lab: DataFrame, matches: DataFrame) -> DataFrame:
    """Station of each sample number, from a list whose ids were read as numbers.

    The list has no order of its own: when a sample repeats, its greatest station counts.
    """
    listed = matches.select(
        F.col("Sample Number"), values.station_id_text(F.col("Station ID")).alias("station")
    )
    return attach(lab, listed, "Sample Number", "Sample Number", {"station": "Station ID"})


def match_stations(
    lab: DataFrame, description: str = "Sample Description", column: str = "Station ID", corrected: bool = False
) -> DataFrame:
    """Station of each row by the ordered description rules.

    All results of a sample share its description, so the patterns run once per distinct
    description, over a pass that reads no other column, and the answers are joined back.
    """
    answers = match_stations_by_row(_keys(lab, f"`{description}`"), "_key", "_station", corrected)
    return (
        lab.join(answers, lab[f"`{description}`"] == answers["_key"], "left")
        .withColumn(column, F.col("_station"))
        .drop("_key", "_station")
    )


def match_stations_by_row(rows: DataFrame, description: str, column: str, corrected: bool = False, rules=None) -> DataFrame:
    """As ``match_stations``, on every row by itself and without a join.

    A first step finds what the rules ask of a description before they look at it; the rules
    follow in several steps, the last ones first, so that each is a method that gets compiled.
    """
    text, found = F.col(f"`{description}`"), F.col("_found")
    rules = vocab.STATION_RULES if rules is None else rules
    shortest = min((len(station) for _, station in rules), default=0)
    numbered = text.rlike(f"[0-9]{{{shortest}}}") if all(station.isdigit() for _, station in rules) else F.lit(True)
    rows = rows.withColumns({"_capitals": F.upper(text), "_numbered": numbered, "_found": F.lit(None).cast("string")})
    for end in range(len(rules), 0, -RULES_AT_ONCE):
        some = rules[max(0, end - RULES_AT_ONCE) : end]
        hit = places.match_station_rules(text, some, corrected, F.col("_capitals"), F.col("_numbered"))
        rows = rows.withColumn("_found", F.when(found.isNotNull(), found).otherwise(hit))
    return rows.withColumn(column, found).drop("_capitals", "_numbered", "_found")


def project_code(rows: DataFrame, stations: DataFrame, location: str = "monitoringlocationid") -> DataFrame:
    """Project of the network a station belongs to; NULL without a match."""
    coded = stations.select(
        "locationid", values.lookup(F.col("qwnetworkname"), vocab.PROJECT_CODES).alias("code")
    )
    return attach(rows, coded, location, "locationid", {"code": "projectid"})


def substance_lookup(rows: DataFrame, substances: DataFrame, name: str = "characteristicname") -> DataFrame:
    return attach(
        rows,
        substances.withColumn("_name", F.col("epaname")),
        name,
        "_name",
        {c: c for c in ("epaname", "molecularweight", "molecularformula", "currentcasnumber")},
    )


def county_lookup(counties: DataFrame, state: str | int) -> DataFrame:
    """Names and codes of the counties of one state, by name."""
    number = vocab.STATE_FIPS.get(state, state)
    return (
        counties.where(F.col("state") == f"{int(number):02d}")
        .select("name", "county")
        .orderBy("name", "county")
    )


def organization_lookup(organizations: DataFrame) -> DataFrame:
    return organizations.select("desc", "value").orderBy("desc", "value")
