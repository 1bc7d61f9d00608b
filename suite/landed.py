"""Tables that are landed, updated by key and read back in part."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seepline.operators import joins, reshape
from seepline.plans import publish
from seepline.plans.censored import CensoredStore
from seepline.session import fresh_path
from seepline.sources import buckets, keyed, landing, readers
from suite import censored, exchange, frames, relations, shapes, tables  # noqa: F401  whose SQL is used again
from suite.base import ORACLES, query

c = F.col


def same_rows(key: str, plain: str):
    """Register a query that gives the rows of another one in another way."""

    def register(fn):
        query(key)(fn)
        ORACLES[key] = ORACLES[plain]
        return fn

    return register


def _table(t, rows, key, **more):
    table = keyed.KeyedTable(t.spark, fresh_path(t.spark, "keyed"), key, rows.schema, **more)
    table.create(rows)
    return table


@same_rows("apply_inwqx_table", "apply_inwqx")
def _(t):
    """The flags set in a stored table: the parts with published keys are written anew."""
    table = _table(t, frames.local_results(t).withColumn("inwqx", c("resultline") % 2), "uniqueid")
    publish.mark_published(table, joins.published_results(t.published))
    return table.read()


@query(
    "merge_activities",
    """SELECT coalesce(a.activityid, n.activityid) AS activityid, coalesce(a.monitoringlocationid, n.monitoringlocationid) AS monitoringlocationid,
    coalesce(a.activitystartdate, n.activitystartdate) AS activitystartdate, CASE WHEN n.activityid IS NULL THEN a.conduct_uscm ELSE n.conduct_uscm END AS conduct_uscm
    FROM (SELECT * FROM wq_activities WHERE activitystartdate < DATE '1997-01-01') a
    FULL JOIN (SELECT activityid, monitoringlocationid, activitystartdate, conduct_uscm + 1 AS conduct_uscm FROM wq_activities WHERE activitystartdate >= DATE '1996-06-01') n
    ON a.activityid = n.activityid""",
)
def _(t):
    """A delivery that corrects the last months and adds later ones, merged by key."""
    rows = t.activities.select("activityid", "monitoringlocationid", "activitystartdate", "conduct_uscm")
    thousand = F.regexp_extract("activityid", "([0-9]+)", 1)
    table = _table(
        t, rows.where("activitystartdate < DATE '1997-01-01'"), "activityid",
        part=lambda key: F.regexp_extract(key, "([0-9]+)", 1).cast("long") % 50,
    )
    late = rows.where("activitystartdate >= DATE '1996-06-01'").withColumn("conduct_uscm", c("conduct_uscm") + 1)
    # the same delivery in two halves, one after the other
    for half in (0, 1):
        table.merge(late.where(thousand.cast("long") % 2 == half), ["conduct_uscm"], insert=True)
    return table.read()


@same_rows("portal_dates_landed", "portal_dates")
def _(t):
    path = fresh_path(t.spark, "by-date")
    landing.land_by_date(t.activities, path)
    return landing.landed_dates(t.spark, path, "1997-03-01", "1998-06-30").select(*t.activities.columns)


@same_rows("portal_radius_landed", "portal_radius")
def _(t):
    path = fresh_path(t.spark, "by-place")
    landing.land_by_place(t.sites, path)
    return landing.landed_radius(t.spark, path, 150, "km", 39.5, -112.0).select(*t.sites.columns)


@same_rows("portal_bbox_landed", "portal_bbox")
def _(t):
    path = fresh_path(t.spark, "by-place")
    landing.land_by_place(t.sites, path)
    return landing.landed_bbox(t.spark, path, -113.5, 38.0, -111.0, 40.5).select(*t.sites.columns)


@same_rows("pivot_samples_bucketed", "pivot_samples")
def _(t):
    path = fresh_path(t.spark, "samples")
    table = f"samples_{path.rsplit('-', 1)[1]}"
    return reshape.pivot_samples(buckets.land_samples(shapes.long_majors(t), table, path, buckets=8))


@same_rows("read_features", "flatten_features")
def _(t):
    """Answers landed as files, one for each task that writes them, and read element by element."""
    feature = F.struct(F.struct("activityid", "monitoringlocationid", "temperature_c", "conduct_uscm").alias("attributes"))
    path = fresh_path(t.spark, "answers")

    def answers(batches):
        first = True
        for batch in batches:
            lines = batch.column(0).to_pylist()
            lead = '{"displayFieldName": "", "features": [' if first else ""
            yield pa.RecordBatch.from_pydict({"value": [(lead if i == 0 else "") + line + "," for i, line in enumerate(lines)]})
            first = False
        if not first:
            yield pa.RecordBatch.from_pydict({"value": ['{"geometry": null}]}']})

    t.activities.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value")).mapInArrow(answers, "value string").write.text(path)
    return readers.read_features(t.spark, path, "activityid STRING, monitoringlocationid STRING, temperature_c DOUBLE, conduct_uscm DOUBLE")


@same_rows("ros_impute_deliveries", "ros_impute")
def _(t):
    """The measurements in two deliveries: the second changes the groups it has rows of."""
    keys = T.StructType([t.censored.schema[k] for k in censored.KEYS])
    store = CensoredStore(t.spark, fresh_path(t.spark, "censored"), keys, parts=4)
    store.create()
    first = F.pmod(F.xxhash64("result", "censorship"), F.lit(3)) > 0
    store.add(t.censored.where(first), "first")
    store.add(t.censored.where(~first), "second")
    return censored._round(store.read(), "final")
