"""Canonical tables: field order and types."""

from __future__ import annotations

from pyspark.sql import types as T

from seepline import vocab

_S, _D, _L, _I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
_DATE, _TS = T.DateType(), T.TimestampNTZType()

_DOUBLES = {
    "latitude", "longitude", "verticalmeasure", "welldepth", "resultvalue",
    "detecquantlimitmeasure", "temperature_c", "conduct_uscm", "ph",
}
_DATES = {"activitystartdate", "analysisstartdate"}
_TIMES = {"created_date", "last_edited_date"}
_INTS = {"inwqx", "send"}

# Field order of the three base tables and of the upload table
FIELDS = {
    "Result": [
        "activityid", "monitoringlocationid", "resultanalyticalmethodcontext",
        "resultanalyticalmethodid", "resultsamplefraction", "resultvalue",
        "detecquantlimitmeasure", "resultdetecquantlimitunit", "resultunit",
        "analysisstartdate", "resultdetecquantlimittype", "resultdetectioncondition",
        "characteristicname", "methodspeciation", "characteristicgroup", "inwqx",
        "created_user", "last_edited_user", "created_date", "last_edited_date", "resultid",
    ],
    "Station": [
        "locationid", "locationname", "locationtype", "huc8", "huc12", "triballandind",
        "triballandname", "latitude", "longitude", "horizontalcollectionmethod",
        "horizontalcoordrefsystem", "state", "county", "verticalmeasure", "verticalunit",
        "verticalcoordrefsystem", "verticalcollectionmethod", "altlocationid",
        "altlocationcontext", "welltype", "welldepth", "welldepthmeasureunit", "aquifername",
    ],
    "Activity": [
        "activityid", "projectid", "monitoringlocationid", "activitystartdate",
        "activitystarttime", "notes", "personnel", "created_user", "created_date",
        "last_edited_user", "last_edited_date",
    ],
    "Result-Activity": [
        "activityid", "activitymedia", "activitystartdate", "activitystarttime",
        "activitytimezone", "activitytype", "analysisstartdate", "characteristicname",
        "laboratoryname", "methodspeciation", "monitoringlocationid", "projectid",
        "resultanalyticalmethodcontext", "resultanalyticalmethodid",
        "resultdetectioncondition", "detecquantlimitmeasure", "resultdetecquantlimittype",
        "resultdetecquantlimitunit", "resultsamplefraction", "resultstatusid", "resultunit",
        "resultvaluetype", "sampcollectionequip", "sampcollectmethod",
    ],
    # the upload that carries the measured value and its qualifier as well
    "Upload": [
        "activityid", "activitymedia", "activitystartdate", "activitystarttime",
        "activitytimezone", "activitytype", "analysisstartdate", "characteristicname",
        "laboratoryname", "methodspeciation", "monitoringlocationid", "projectid",
        "resultanalyticalmethodcontext", "resultanalyticalmethodid",
        "resultdetectioncondition", "detecquantlimitmeasure", "resultdetecquantlimittype",
        "resultdetecquantlimitunit", "resultqualifier", "resultsamplefraction",
        "resultstatusid", "resultunit", "resultvalue", "resultvaluetype",
        "sampcollectionequip", "sampcollectmethod",
    ],
}
# Columns of the joined result and activity tables
JOINED_RESULT_FIELDS = [
    "objectid", "monitoringlocationid", "activityid", "characteristicgroup",
    "characteristicname", "resultvalue", "resultunit", "resultqualifier",
    "detecquantlimitmeasure", "resultdetecquantlimitunit", "resultdetecquantlimittype",
    "resultanalyticalmethodid", "resultanalyticalmethodcontext", "resultsamplefraction",
    "methodspeciation", "resultdetectioncondition", "laboratoryname", "analysisstartdate",
    "inwqx", "created_user", "created_date", "last_edited_user", "last_edited_date",
    "resultid",
]
JOINED_ACTIVITY_FIELDS = ["activitystartdate", "activitystarttime", "projectid", "personnel"]
VIEW_RESULT_FIELDS = [
    "resultdetectioncondition", "characteristicname", "methodspeciation",
    "resultsamplefraction", "resultvalue", "resultunit", "resultqualifier",
    "resultstatusid", "resultvaluetype", "resultanalyticalmethodid",
    "resultanalyticalmethodcontext", "laboratoryname", "analysisstartdate",
    "resultdetecquantlimittype", "detecquantlimitmeasure", "resultdetecquantlimitunit",
]
VIEW_ACTIVITY_FIELDS = [
    "activityid", "activitystartdate", "activitystarttime", "projectid",
    "monitoringlocationid",
]


def field_type(name: str) -> T.DataType:
    if name in _DOUBLES:
        return _D
    if name in _DATES:
        return _DATE
    if name in _TIMES:
        return _TS
    if name in _INTS:
        return _I
    return _L if name == "objectid" else _S


def struct(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, field_type(n)) for n in names])


STATION = struct(FIELDS["Station"] + ["send", "usgs_id", "win", "wrnum", "inwqx"])
ACTIVITY = struct(FIELDS["Activity"] + ["temperature_c", "conduct_uscm", "ph"])
RESULT = struct(JOINED_RESULT_FIELDS)
PORTAL_RESULTS = T.StructType(
    [T.StructField(n, _D if n in vocab.PORTAL_RESULT_NUMBERS else _S) for n in vocab.PORTAL_RESULT_COLUMNS]
)
