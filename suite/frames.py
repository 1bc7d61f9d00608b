"""Derived inputs under the headers the source files carry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PORTAL_RESULT_HEADERS = {
    "org": "OrganizationIdentifier", "act": "ActivityIdentifier", "act_date": "ActivityStartDate",
    "act_time": "ActivityStartTime/Time", "loc": "MonitoringLocationIdentifier", "chr": "CharacteristicName",
    "val": "ResultMeasureValue", "unit": "ResultMeasure/MeasureUnitCode", "cond": "ResultDetectionConditionText",
    "lim": "DetectionQuantitationLimitMeasure/MeasureValue", "provider": "ProviderName", "qual": "MeasureQualifierCode",
}
PORTAL_STATION_HEADERS = {
    "loc": "MonitoringLocationIdentifier", "name": "MonitoringLocationName", "typ": "MonitoringLocationTypeName",
    "huc": "HUCEightDigitCode", "lat": "LatitudeMeasure", "lon": "LongitudeMeasure",
    "elev": "VerticalMeasure/MeasureValue", "aquifer": "AquiferName", "country": "CountryCode", "provider": "ProviderName",
}
STATE_LAB_HEADERS = {
    "sample_number": "Sample Number", "sample_date": "Sample Date", "sample_time": "Sample Time",
    "description": "Sample Description", "collector": "Collector", "agency": "Method Agency", "method": "Method ID",
    "matrix": "Matrix Description", "val": "Result Value", "low_limit": "Lower Report Limit",
    "detect_limit": "Method Detect Limit", "units": "Units", "analysis_date": "Analysis Date",
    "param": "Param Description", "problem": "Problem Identifier", "code": "Result Code",
}
EPA_LAB_HEADERS = {
    "laboratory": "Laboratory", "lab_number": "LabNumber", "sample_name": "SampleName", "method": "Method",
    "analyte": "Analyte", "report_limit": "ReportLimit", "val": "Result", "qual": "AnalyteQual",
    "class": "AnalysisClass", "units": "Units", "sampled": "Sampled", "analyzed": "Analyzed", "batch": "Batch",
}


def headed(df: DataFrame, headers: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(k).alias(v) for k, v in headers.items()])


def portal_results(t) -> DataFrame:
    return headed(t.portal, PORTAL_RESULT_HEADERS)


def portal_stations(t) -> DataFrame:
    return headed(t.portal_stations, PORTAL_STATION_HEADERS)


def state_lab(t) -> DataFrame:
    return headed(t.state_lab, STATE_LAB_HEADERS)


def epa_lab(t) -> DataFrame:
    return headed(t.epa_lab, EPA_LAB_HEADERS)


def matches(t) -> DataFrame:
    return headed(t.matches, {"sample_number": "Sample Number", "station_id": "Station ID"})


def domain(t) -> DataFrame:
    return t.domain.toDF(*[c.upper() for c in t.domain.columns])


def local_results(t) -> DataFrame:
    from seepline.operators.projection import add_unique_id

    return add_unique_id(t.results)
