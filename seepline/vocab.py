"""Fixed values of the data exchange: header maps, code lists, station rules, constants.

Everything in this module is a value that results depend on, not logic. The tables are
small (the largest has 91 entries), so the operators turn them into literal map
expressions or ``CASE`` chains; none of them becomes a join.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Portal header -> canonical column
# ---------------------------------------------------------------------------
STATION_HEADERS_LOCAL = {
    "MonitoringLocationIdentifier": "locationid",
    "MonitoringLocationName": "locationname",
    "MonitoringLocationTypeName": "locationtype",
    "HUCEightDigitCode": "huc8",
    "LatitudeMeasure": "latitude",
    "LongitudeMeasure": "longitude",
    "HorizontalCollectionMethodName": "horizontalcollectionmethod",
    "HorizontalCoordinateReferenceSystemDatumName": "horizontalcoordrefsystem",
    "VerticalMeasure/MeasureValue": "verticalmeasure",
    "VerticalMeasure/MeasureUnitCode": "verticalunit",
    "VerticalCollectionMethodName": "verticalcollectionmethod",
    "VerticalCoordinateReferenceSystemDatumName": "verticalcoordrefsystem",
    "StateCode": "state",
    "CountyCode": "county",
}
STATION_HEADERS_PORTAL = {
    **STATION_HEADERS_LOCAL,
    "AquiferName": "aquifername",
    "WellDepthMeasure/MeasureValue": "welldepth",
    "WellDepthMeasure/MeasureUnitCode": "welldepthmeasureunit",
}
ACTIVITY_HEADERS = {
    "ActivityIdentifier": "activityid",
    "ProjectIdentifier": "projectid",
    "MonitoringLocationIdentifier": "monitoringlocationid",
    "ActivityStartDate": "activitystartdate",
    "ActivityStartTime/Time": "activitystarttime",
}
RESULT_HEADERS_LOCAL = {
    "ActivityIdentifier": "activityid",
    "MonitoringLocationIdentifier": "monitoringlocationid",
    "ResultDetectionConditionText": "resultdetectioncondition",
    "CharacteristicName": "characteristicname",
    "ResultSampleFractionText": "resultsamplefraction",
    "ResultMeasureValue": "resultvalue",
    "ResultMeasure/MeasureUnitCode": "resultunit",
    "MeasureQualifierCode": "resultqualifier",
    "ResultAnalyticalMethod/MethodIdentifierContext": "resultanalyticalmethodcontext",
    "ResultAnalyticalMethod/MethodName": "resultanalyticalmethodid",
    "LaboratoryName": "laboratoryname",
    "AnalysisStartDate": "analysisstartdate",
    "DetectionQuantitationLimitTypeName": "resultdetecquantlimittype",
    "DetectionQuantitationLimitMeasure/MeasureValue": "detecquantlimitmeasure",
    "DetectionQuantitationLimitMeasure/MeasureUnitCode": "resultdetecquantlimitunit",
}
# On the portal side the activity id becomes the sample id, with its date and time.
RESULT_HEADERS_PORTAL = {
    **RESULT_HEADERS_LOCAL,
    "ActivityStartDate": "sampledate",
    "ActivityIdentifier": "sampleid",
    "ActivityStartTime/Time": "sampletime",
}

# EPA laboratory sheet header -> canonical column
EPA_HEADERS = {
    "Laboratory": "laboratoryname",
    "LabNumber": "activityid",
    "SampleName": "monitoringlocationid",
    "Method": "resultanalyticalmethodid",
    "Analyte": "characteristicname",
    "Result": "resultvalue",
    "AnalyteQual": "resultqualifier",
    "AnalysisClass": "resultsamplefraction",
    "ReportLimit": "detecquantlimitmeasure",
    "Units": "resultunit",
}
EPA_UNUSED = [
    "Batch", "Analysis", "Analyst", "CASNumber", "Elevation", "LabQual", "Client",
    "ClientMatrix", "Dilution", "SpkAmt", "UpperLimit", "Recovery", "Surrogate",
    "LowerLimit", "Latitude", "Longitude", "SampleID", "ProjectNumber", "Sampled",
    "Analyzed", "PrepMethod", "Prepped", "Project",
]

# State laboratory header -> canonical column
STATE_HEADERS = {
    "Sample Number": "activityid",
    "Station ID": "monitoringlocationid",
    "Sample Date": "activitystartdate",
    "Sample Time": "activitystarttime",
    "Sample Description": "notes",
    "Collector": "personnel",
    "Method Agency": "resultanalyticalmethodcontext",
    "Method ID": "resultanalyticalmethodid",
    "Matrix Description": "resultsamplefraction",
    "Result Value": "resultvalue",
    "Lower Report Limit": "detecquantlimitmeasure",
    "Method Detect Limit": "resultdetecquantlimitunit",
    "Units": "resultunit",
    "Analysis Date": "analysisstartdate",
}
STATE_UNUSED = [
    "Trip ID", "Agency Bill Code", "Test Comment", "Result Comment",
    "Sample Report Limit", "Chain of Custody", "Cost Code", "Test Number", "CAS Number",
    "Project Name", "Sample Received Date", "Method Description", "Param Description",
    "Dilution Factor", "Batch Number", "Replicate Number", "Sample Detect Limit",
    "Problem Identifier", "Result Code", "Sample Type", "Project Comment",
    "Sample Comment",
]
# Newer state laboratory files -> common header
STATE_NEW_HEADERS = {
    "Collected By": "Collector",
    "Analyte CAS Number": "CAS Number",
    "Method Number": "Method ID",
    "Method Reported Name": "Param Description",
    "Entry Qualifier": "Problem Identifier",
    "Result Flags": "Result Code",
    "Result Entry": "Result Value",
    "Sample Detection Limit": "Sample Detect Limit",
    "Date Analyzed": "Analysis Date",
    "Method Detection Limit": "Method Detect Limit",
    "Project Comments": "Project Comment",
    "Sample Comments": "Sample Comment",
    "Test Comments": "Test Comment",
    "Result Comments": "Result Comment",
    "Sample Reporting Limit": "Sample Report Limit",
    "Result Dilution Factor": "Dilution Factor",
    "Date Recieved": "Sample Received Date",
    "Specimen Source": "Matrix Description",
    "Customer Internal Code": "Cost Code",
    "Collecting Agency": "Agency Bill Code",
    "Result Units": "Units",
}
# Older state laboratory files -> common header
STATE_OLD_HEADERS = {
    "Sample#Number": "Sample Number",
    "Sample#Date": "Date Collected",
    "Sample#Time": "Time Collected",
    "Analysis#Date": "Analysis Date",
    "CAS#Number": "CAS Number",
    "Agency#Bill#Code": "Agency Bill Code",
    "Batch#Number": "Batch Number",
    "Comment#Text": "Result Comment",
    "Chain#of#Custody#Ind.": "Chain of Custody",
    "Cost#Code": "Cost Code",
    "Dilution#Factor": "Dilution Factor",
    "Lower#Report#Limit": "Lower Report Limit",
    "Matrix#Description": "Matrix Description",
    "Method#Agency": "Method Agency",
    "Method#Description": "Method Description",
    "Method#Detect#Limit": "Method Detect Limit",
    "Param#Description": "Param Description",
    "Problem#Identifier": "Problem Identifier",
    "Method#ID": "Method ID",
    "Sample#Comment": "Sample Comment",
    "Sample#Description": "Sample Description",
    "Result#Value": "Result Value",
    "Sample#Recieved#Date": "Sample Received Date",
    "Replicate#Number": "Replicate Number",
    "Result#Code": "Result#Code",
    "Station#ID": "Station ID",
    "Sample#Type": "Sample Type",
    "Trip#ID": "Trip ID",
}
STATE_OLD_UNUSED = [
    "%#Confidence#Limit", "Confidence#Limit", "Comment#Number", "Comment#Number.1",
    "Comment#Text.1", "Lab#Code", "Preparation#Date", "Source#Code", "Billing#Code",
    "Matrix#Number", "Upper#Quant#Limit", "Result#Code", "Method#Number",
    "Param#Number",
]

# Portal columns that cleaning leaves out
PORTAL_RESULT_UNUSED = [
    "ActivityBottomDepthHeightMeasure/MeasureUnitCode",
    "ActivityBottomDepthHeightMeasure/MeasureValue",
    "ActivityConductingOrganizationText",
    "ActivityEndDate", "ActivityEndTime/Time", "ActivityEndTime/TimeZoneCode",
    "ActivityMediaName", "ActivityStartTime/TimeZoneCode",
    "ActivityTopDepthHeightMeasure/MeasureUnitCode",
    "ActivityTopDepthHeightMeasure/MeasureValue",
    "HydrologicCondition", "HydrologicEvent", "PrecisionValue", "PreparationStartDate",
    "ProviderName", "ResultDepthAltitudeReferencePointText",
    "ResultDepthHeightMeasure/MeasureUnitCode", "ResultDepthHeightMeasure/MeasureValue",
    "ResultParticleSizeBasisText", "ResultTemperatureBasisText", "ResultTimeBasisText",
    "ResultValueTypeName", "ResultWeightBasisText", "SampleAquifer",
    "SampleTissueAnatomyName", "StatisticalBaseCode", "SubjectTaxonomicName",
    "SampleTime",
]
PORTAL_STATION_UNUSED = [
    "ContributingDrainageAreaMeasure/MeasureUnitCode",
    "ContributingDrainageAreaMeasure/MeasureValue",
    "DrainageAreaMeasure/MeasureUnitCode", "DrainageAreaMeasure/MeasureValue",
    "CountryCode", "ProviderName", "SourceMapScaleNumeric",
]

# ---------------------------------------------------------------------------
# labels
# ---------------------------------------------------------------------------
UPLOAD_CONSTANTS = {
    "activitymedia": "Water",
    "activitytimezone": "MDT",
    "sampcollectionequip": "Water Bottle",
    "sampcollectmethod": "GRAB",
    "resultvaluetype": "Actual",
    "resultstatusid": "Final",
}
EPA_UNITS = {"ug/L": "ug/l", "NONE": "None", "UMHOS-CM": "uS/cm", "mg/L": "mg/l"}
STATE_UNITS = {"MG-L": "mg/l", "UG-L": "ug/l", "NONE": "None", "UMHOS-CM": "uS/cm"}
STATION_TYPES = {
    "River/Stream": "Stream",
    "Stream: Canal": "Stream",
    "Well: Test hole not completed as a well": "Well",
}
MARKER_ICONS = {
    "Spring": "star-empty", "Well": "heart-empty", "Stream": "tint", "Land": "globe",
}
MILES_PER_UNIT = {"mi": 1.0, "km": 0.621371, "m": 0.000621371, "ft": 0.000189394}
EARTH_RADIUS_MILES = 3958.7613
FIELD_READINGS = {
    "temperature_c": ("Temperature, water", "deg C"),
    "conduct_uscm": ("Specific conductance", "uS/cm"),
    "ph": ("pH", "None"),
}
PROJECT_CODES = {
    "Arches Monitoring Wells": "UAMW",
    "Bryce": "UBCW",
    "Castle Valley": "CAVW",
    "GSL Chem": "GSLCHEM",
    "Juab Valley": "UJVW",
    "Mills/Mona Wetlands": "MMWET",
    "Monroe Septic": "UMSW",
    "Ogden Valley": "UOVW",
    "Round Valley": "URVH",
    "Snake Valley": "USVW",
    "Snake Valley Wetlands": "SVWET",
    "Tule Valley Wetlands": "TVWET",
    "UGS-NGWMN": "UNGWMN",
    "WRI - Grouse Creek": "UWRIG",
    "WRI - Montezuma": "UWRIM",
    "WRI - Tintic Valley": "UWRIT",
}
# Two-digit state numbers of the county search
STATE_FIPS = {
    "Alabama": 1, "Alaska": 2, "Arizona": 4, "Arkansas": 5, "California": 6,
    "Colorado": 8, "Connecticut": 9, "Delaware": 10, "Florida": 12, "Georgia": 13,
    "Hawaii": 15, "Idaho": 16, "Illinois": 17, "Indiana": 18, "Iowa": 19, "Kansas": 20,
    "Kentucky": 21, "Louisiana": 22, "Maine": 23, "Maryland": 24, "Massachusetts": 25,
    "Michigan": 26, "Minnesota": 27, "Mississippi": 28, "Missouri": 29, "Montana": 30,
    "Nebraska": 31, "Nevada": 32, "New Hampshire": 33, "New Jersey": 34,
    "New Mexico": 35, "New York": 36, "North Carolina": 37, "North Dakota": 38,
    "Ohio": 39, "Oklahoma": 40, "Oregon": 41, "Pennsylvania": 42, "Rhode Island": 44,
    "South Carolina": 45, "South Dakota": 46, "Tennessee": 47, "Texas": 48, "Utah": 49,
    "Vermont": 50, "Virginia": 51, "Washington": 53, "West Virginia": 54,
    "Wisconsin": 55, "Wyoming": 56, "American Samoa": 60, "Guam": 66,
    "Northern Mariana Islands": 69, "Puerto Rico": 72, "Virgin Islands": 78,
}

# ---------------------------------------------------------------------------
# Chemical names
# ---------------------------------------------------------------------------
EPA_SPECIES = {
    "Ammonia as N": ("Ammonia", "as N"),
    "Sulfate as SO4": ("Sulfate", "as SO4"),
    "Nitrate as N": ("Nitrate", "as N"),
    "Nitrite as N": ("Nitrite", "as N"),
    "Orthophosphate as P": ("Orthophosphate", "as P"),
}
# State laboratory abbreviation -> name
STATE_ABBREVIATIONS = {
    "Fe": "Iron", "Mn": "Manganese", "Ca": "Calcium", "Mg": "Magnesium",
    "Na": "Sodium", "K": "Potassium", "HCO3": "Bicarbonate", "CO3": "Carbonate",
    "SO4": "Sulfate", "Cl": "Chloride", "F": "Floride",
    "NO3-N": "Nitrate as Nitrogen", "NO3": "Nitrate", "B": "Boron",
    "TDS": "Total dissolved solids",
    "Total Dissolved Solids": "Total dissolved solids",
    "Hardness": "Total hardness", "hard": "Total hardness",
    "Total Suspended Solids": "Total suspended solids",
    "Cond": "Conductivity", "pH": "pH", "Cu": "Copper", "Pb": "Lead", "Zn": "Zinc",
    "Li": "Lithium", "Sr": "Strontium", "Br": "Bromide", "I": "Iodine",
    "PO4": "Phosphate", "SiO2": "Silica", "Hg": "Mercury",
    "NO3+NO2-N": "Nitrate + Nitrite as Nitrogen",
    "As": "Arsenic", "Cd": "Cadmium", "Ag": "Silver", "Alk": "Alkalinity, total",
    "P": "Phosphorous", "Ba": "Barium", "DO": "Dissolved oxygen", "Q": "Discharge",
    "Temp": "Temperature", "Hard_CaCO3": "Hardness as Calcium Carbonate",
    "DTW": "Depth to water", "O18": "Oxygen-18", "18O": "Oxygen-18",
    "D": "Deuterium", "d2H": "Deuterium", "C14": "Carbon-14",
    "C14err": "Carbon-14 error", "Trit_err": "Tritium error",
    "Meas_Alk": "Alkalinity, total", "Turb": "Turbidity",
    "TSS": "Total suspended solids", "C13": "Carbon-13", "Tritium": "Tritium",
    "S": "Sulfur", "density": "density", "Cr": "Chromium", "Se": "Selenium",
    "temp": "Temperature", "NO2": "Nitrite", "O18err": "Oxygen-18 error",
    "d2Herr": "Deuterium error", "NaK": "Sodium + Potassium", "Al": "Aluminum",
    "Be": "Beryllium", "Co": "Cobalt", "Mo": "Molydenum", "Ni": "Nickel",
    "V": "Vanadium", "SAR": "Sodium absorption ratio", "Hard": "Total hardness",
    "Free Carbon Dioxide": "Carbon dioxide", "CO2": "Carbon dioxide",
}
# Portal characteristic -> symbol of the wide sample table
PARAMETER_SYMBOLS = {
    "Alkalinity": "Alk",
    "Alkalinity, Carbonate as CaCO3": "Alk",
    "Alkalinity, total": "Alk",
    "Arsenic": "As",
    "Calcium": "Ca",
    "Chloride": "Cl",
    "Carbon dioxide": "CO2",
    "Carbonate": "CO3",
    "Carbonate (CO3)": "CO3",
    "Specific conductance": "Cond",
    "Conductivity": "Cond",
    "Copper": "Cu",
    "Depth": "Depth",
    "Dissolved oxygen (DO)": "DO",
    "Iron": "Fe",
    "Hardness, Ca, Mg": "Hard",
    "Total hardness -- SDWA NPDWR": "Hard",
    "Bicarbonate": "HCO3",
    "Potassium": "K",
    "Magnesium": "Mg",
    "Kjeldahl nitrogen": "N",
    "Nitrogen, mixed forms (NH3), (NH4), organic, (NO2) and (NO3)": "N",
    "Inorganic nitrogen (nitrate and nitrite)": "N",
    "Nitrogen": "N",
    "Sodium": "Na",
    "Sodium plus potassium": "NaK",
    "Ammonia-nitrogen": "NH3_N",
    "Ammonia-nitrogen as N": "N",
    "Nitrite": "NO2",
    "Nitrate": "NO3",
    "Nitrate as N": "N",
    "pH, lab": "pH",
    "pH": "pH",
    "Phosphate-phosphorus": "PO4",
    "Orthophosphate": "PO4",
    "Phosphate": "PO4",
    "Stream flow, instantaneous": "Q",
    "Flow": "Q",
    "Flow rate, instantaneous": "Q",
    "Silica": "Si",
    "Sulfate": "SO4",
    "Sulfate as SO4": "SO4",
    "Boron": "B",
    "Barium": "Ba",
    "Cadmium": "Cd",
    "Bromine": "Br",
    "Lithium": "Li",
    "Manganese": "Mn",
    "Nickel": "Ni",
    "Selenium": "Se",
    "Strontium": "Sr",
    "Silver": "Ag",
    "Total dissolved solids": "TDS",
    "Temperature, water": "Temp",
    "Total Organic Carbon": "TOC",
    "delta Dueterium": "d2H",
    "delta Oxygen 18": "d18O",
    "delta Carbon 13 from Bicarbonate": "d13CHCO3",
    "delta Oxygen 18 from Bicarbonate": "d18OHCO3",
    "Total suspended solids": "TSS",
    "Turbidity": "Turb",
}
SYMBOLS = list(dict.fromkeys(PARAMETER_SYMBOLS.values()))
PIPER_REQUIRED = ["SO4", "Cl", "Ca", "HCO3", "pH"]

# Nutrient conversion factors (reported form -> ion)
SPECIES_FACTORS = {"NO3-N": 4.427, "NO2-N": 3.285, "NH4": 1.288, "SO4-S": 2.996, "PO4-P": 3.066}

# mg/L -> meq/L
MEQ_FACTORS = {
    "Ca": 0.04990269, "Mg": 0.082287595, "Na": 0.043497608, "K": 0.02557656,
    "Cl": 0.028206596, "NaK": 0.043497608, "HCO3": 0.016388838, "CO3": 0.033328223,
    "SO4": 0.020833333, "NO2": 0.021736513, "NO3": 0.016129032,
}
ION_COLUMNS = ["Na", "K", "NaK", "Ca", "Mg", "Cl", "HCO3", "CO3", "SO4"]
ANIONS = ["Cl", "HCO3", "CO3", "SO4"]
CATIONS = ["Na", "K", "Ca", "Mg", "NaK"]
# order in which the largest ion is sought; the first wins a tie
CATION_SEARCH = ["Ca", "Mg", "Na", "K", "NaK"]
ANION_SEARCH = ["Cl", "SO4", "HCO3", "CO3"]
# Piper diagram, gram per mole and charge
PIPER_IONS = ["Ca", "Mg", "Na", "K", "HCO3", "CO3", "Cl", "SO4"]
PIPER_GMOL = {
    "Ca": 40.078, "Mg": 24.305, "Na": 22.989768, "K": 39.0983, "HCO3": 61.01714,
    "CO3": 60.0092, "Cl": 35.4527, "SO4": 96.0636,
}
PIPER_CHARGE = {
    "Ca": 2.0, "Mg": 2.0, "Na": 1.0, "K": 1.0, "HCO3": 1.0, "CO3": 2.0, "Cl": 1.0, "SO4": 2.0,
}
PIPER_OFFSET = 0.05
# Stiff polygon heights and water type colours
STIFF_HEIGHTS = [3, 2, 1, 1, 2, 3, 3]
STIFF_COLORS = {1: "r", 2: "b", 3: "c", 4: "g", 5: "m"}

# ---------------------------------------------------------------------------
# Portal results file, in file order
# ---------------------------------------------------------------------------
PORTAL_RESULT_COLUMNS = [
    "OrganizationIdentifier", "OrganizationFormalName", "ActivityIdentifier",
    "ActivityTypeCode", "ActivityMediaName", "ActivityMediaSubdivisionName",
    "ActivityStartDate", "ActivityStartTime/Time", "ActivityStartTime/TimeZoneCode",
    "ActivityEndDate", "ActivityEndTime/Time", "ActivityEndTime/TimeZoneCode",
    "ActivityDepthHeightMeasure/MeasureValue",
    "ActivityDepthHeightMeasure/MeasureUnitCode",
    "ActivityDepthAltitudeReferencePointText",
    "ActivityTopDepthHeightMeasure/MeasureValue",
    "ActivityTopDepthHeightMeasure/MeasureUnitCode",
    "ActivityBottomDepthHeightMeasure/MeasureValue",
    "ActivityBottomDepthHeightMeasure/MeasureUnitCode",
    "ProjectIdentifier", "ActivityConductingOrganizationText",
    "MonitoringLocationIdentifier", "ActivityCommentText", "SampleAquifer",
    "HydrologicCondition", "HydrologicEvent",
    "SampleCollectionMethod/MethodIdentifier",
    "SampleCollectionMethod/MethodIdentifierContext",
    "SampleCollectionMethod/MethodName", "SampleCollectionEquipmentName",
    "ResultDetectionConditionText", "CharacteristicName", "ResultSampleFractionText",
    "ResultMeasureValue", "ResultMeasure/MeasureUnitCode", "MeasureQualifierCode",
    "ResultStatusIdentifier", "StatisticalBaseCode", "ResultValueTypeName",
    "ResultWeightBasisText", "ResultTimeBasisText", "ResultTemperatureBasisText",
    "ResultParticleSizeBasisText", "PrecisionValue", "ResultCommentText", "USGSPCode",
    "ResultDepthHeightMeasure/MeasureValue",
    "ResultDepthHeightMeasure/MeasureUnitCode",
    "ResultDepthAltitudeReferencePointText", "SubjectTaxonomicName",
    "SampleTissueAnatomyName", "ResultAnalyticalMethod/MethodIdentifier",
    "ResultAnalyticalMethod/MethodIdentifierContext",
    "ResultAnalyticalMethod/MethodName", "MethodDescriptionText", "LaboratoryName",
    "AnalysisStartDate", "ResultLaboratoryCommentText",
    "DetectionQuantitationLimitTypeName",
    "DetectionQuantitationLimitMeasure/MeasureValue",
    "DetectionQuantitationLimitMeasure/MeasureUnitCode", "PreparationStartDate",
    "ProviderName",
]
PORTAL_RESULT_NUMBERS = [
    "ActivityDepthHeightMeasure/MeasureValue",
    "ActivityTopDepthHeightMeasure/MeasureValue",
    "ActivityBottomDepthHeightMeasure/MeasureValue",
    "ResultDepthHeightMeasure/MeasureValue",
]
PORTAL_STATION_NUMBERS = [
    "LatitudeMeasure", "LongitudeMeasure", "VerticalMeasure/MeasureValue",
    "WellDepthMeasure/MeasureValue",
]
DOMAIN_COLUMNS = [
    "PK_ISN", "REGISTRY_NAME", "CHARACTERISTIC_GROUP_TYPE", "SRS_ID", "CAS_NUMBER",
]

# ---------------------------------------------------------------------------
# Ordered station rules (case-insensitive pattern, station id).
# Later rules override earlier ones. Rule 67.*?3499| ends in an empty alternative.
# ---------------------------------------------------------------------------
STATION_RULES = [
    ("SPRINGVILLE", "401043111361801"),
    ("(C-19-.*?4)31ada-.*?1", "390714112200401"),
    ("AM.*?FK|FORK.*?WELL|wl", "402105111472601"),
    ("Cedar.*?V.*?Fur", "401656112020301"),
    ("FAIRFIELD", "401539112045501"),
    ("clover.*?sp", "402050112330201"),
    ("Pecan", "370858113220301"),
    ("delle.*?sp", "403328112442201"),
    ("sp.*?timpie|timpie.*?sp", "404425112384801"),
    ("sp.*?simpson|simpson.*?sp", "400204112465801"),
    ("sp.*?antelope|antelope.*?sp", "382238113205301"),
    ("sp.*?willow.*?!piez|willow.*?sp.*?!piez|404975112573501", "404975112573501"),
    ("PLACER|OPEN.*?LAND", "383709109230701"),
    ("BAILEY|KEELER", "383832109243901"),
    ("STUCKI", "383922109253801"),
    ("Jenks|ADELE|CREEKSIDE", "383854109242901"),
    ("PORCUPINE", "383453109200601"),
    ("LOOP.*?ROAD", "383746109214001"),
    ("GOLF.*?MOAB|MOAB.*?GOLF|383210109285801", "383210109285801"),
    ("COURTHOUSE.*?WASH", "384113109391001"),
    ("PRICE.*?GOLF", "393841110514801"),
    ("NEPHI.*?WELL", "394313111504701"),
    ("WL.*?FLOWING|FLOWING.*?WL|FLOWING.*?WELL", "3959531115425101"),
    ("SP.*?GOSHEN.*?WARM|GOSHEN.*?WARM.*?SP|395717111512301", "395717111512301"),
    ("WL.*?ELEMEN|ELEMEN.*?WL|ELEMEN.*?WELL", "404724111562501"),
    ("GRATEFUL", "404508112522401"),
    ("RHONDA|EASY.*?ST", "383040109281201"),
    ("LRP1A|LOWER.*?R.*?CKY.*?PASS.*?PIEZ", "413308113492701"),
    ("WLP1C|WILLOW.*?SP.*?PIEZOMETER.*?1C", "413435113475901"),
    ("WLP1B|WILLOW.*?SP.*?PIEZOMETER.*?1B", "413435113475801"),
    ("BRYCE|BC26W.*?RICH", "374159112121001"),
    ("BRYCE.*?BC13W.*?POE", "374124112135501"),
    ("BRYCE.*?BC22W.*?RUBY.*?3", "374138112103102"),
    ("BRYCE.*?BC21W.*?RUBY.*?2", "374138112103101"),
    ("BRYCE.*?BC15S.*?LOWER.*?BERRY", "374410112133001"),
    ("BRYCE.*?BC27W.*?AIRPORT", "374236112092501"),
    ("BRYCE.*?BC40W.*?ELK", "374232112100501"),
    ("BRYCE.*?BC44W.*?NPS.*?1", "373755112124301"),
    ("BRYCE.*?BC17S.*?UPPER.*?BERRY", "374548112142201"),
    ("BRYCE.*?BC25W.*?UDOT", "374156112112401"),
    ("BRYCE.*?BC51W.*?BRISTLE.*?CONE", "374646112063201"),
    ("BRYCE.*?BC11S.*?NPS.*?4", "373801112124701"),
    ("BRYCE.*?BC2S.*?TROPIC.*?1", "373639112152101"),
    ("BRYCE.*?BC4S.*?TROPIC.*?2", "373629112151801"),
    ("BRYCE.*?BC12W USFS", "374017112130801"),
    ("BRYCE.*?BC53S.*?WATER", "373534112151101"),
    ("BRYCE.*?BC6S.*?DRIPPING.*?VAT", "374500112023001"),
    ("BRYCE.*?BC48W.*?SITLA", "374438112080601"),
    ("HAMMOND", "391159111543401"),
    ("NINE.*?MILE", "391020111421301"),
    ("OLSEN", "392335111354601"),
    ("WL.*?T34.*?190605", "394809112161101"),
    ("SP.*?MUD2.*?190605", "394800112160201"),
    ("WL.*?T2.*?190605", "395215112140501"),
    ("SP.*?MUD1.*?190605", "395214112140301"),
    ("WL.*?T53.*?190605", "395059112120501"),
    ("ST.*?T15.*?190605", "395051112120101"),
    ("ST.*?T8.*?190605", "395126112124501"),
    ("BC35S.*?BRYCE|MOSSY.*?CAVE", "373949112065401"),
    ("BC28W.*?BRYCE.*?1", "374750112043401"),
    ("BC30W.*?BRYCE.*?LANDFILL.*?3", "374759112040101"),
    ("BC29W.*?BRYCE.*?LANDFILL.*?2", "374801112042101"),
    ("BC31S.*?BRYCE.*?TOM.*?BEST", "374855112054701"),
    ("BC19W.*?BRYCE.*?KINGS.*?CG", "373647112154301"),
    ("TRI.*?R.*?NCH", "395718112234301"),
    ("SP.*?HUNGTINGTON|HUNTING.*?", "392025110565901"),
    ("IRR.*?WELL.*?GROUSE|GROUSE.*?IRR.*?WELL", "413332113545101"),
    ("IRR.*?WELL.*?13", "415657112514101"),
    ("IRR.*?WELL.*?5", "415906112485001"),
    ("67.*?3499|", "390714112200401"),
    ("FLOWELL.*?WELL|WL.*?FLOWELL", "385822112265201"),
    ("BLACK.*?SPRING", "384610112495201"),
    ("ASHELY.*?GORGE", "403429109370601"),
    ("WHITEROCKS.*?SP|SP.*?WHITEROCKS", "402906109572401"),
    ("SG21C", "395312113244803"),
    ("MUD.*?1", "395214112140301"),
    ("MUD.*?2", "395214112140301"),
    ("T8", "395132112124901"),
    ("T15", "395051112120101"),
    ("T53", "395059112120501"),
    ("T34", "394809112161101"),
    ("T2", "395215112140501"),
    ("KGSP.*?!PIEZ|KEG.*?SPR.*?!PIEZ", "413507113472401"),
    ("NORTH.*?BEDKE.*?SPR", "413810113493901"),
    ("BC7W.*?RUBY.*?4", "374116112083901"),
    ("BC51W.*?BRYCE|BRISTLE.*?CONE", "374646112063201"),
    ("AGI3C", "385630114020202"),
]
# Exact sample description -> station id
STATION_NAMES = {
    "SPRINGVILLE FISH": "401043111361801",
    "NGWMN-AM. FK. PRIVATE WELL": "402105111472601",
    "NGWMN-CEDAR V FUR FARM": "401656112020301",
    "NGWMN-FAIRFIELD WELL": "401539112045501",
    "NGWMN-CLOVER SPRINGS": "402050112330201",
    "NGWMN-DELLE SPRINGS": "403328112442201",
    "NGWMN-BIG TIMPIE SPRING": "404425112384801",
    "NGWMN-SP-SIMPSON-19": "400204112465801",
    "NGWMN-SP-ANTELOPE-19": "382238113205301",
    "NGWMN-SP-WILLOW-19": "404975112573501",
    "WL01 CASTLE VALLEY OPEN LANDS PLACER": "383709109230701",
    "WL02 CASTLE VALLEY BAILEY": "383832109243901",
    "WL03 CASTLE VALLEY STUCKI": "383922109253801",
    "WL04 CASTLE VALLEY JENKS CASTLE": "383854109242901",
    "WL05 CASTLE VALLEY PORCUPINE": "383453109200601",
    "WL06 CASTLE VALLEY LOOP ROAD": "383746109214001",
    "WL1 NGWMN GOLF COURSE MOAB": "383210109285801",
    "SP3 NGWMN COURTHOUSE WASH": "384113109391001",
    "SP04 NGWMN PRICE GOLF": "393841110514801",
    "NGWMN-WL-NEPHIWELL2019": "394313111504701",
    "NGWMN-WL-FLOWING1-2019": "3959531115425101",
    "NGWMN-SP-GOSHENWARM-2019": "395717111512301",
    "NGWMN-WL-ELEMENTARYWELL-2019": "404724111562501",
    "NGWMN-WL-GRATEFULTOMATO-2019": "404508112522401",
    "WL02 NGWMN RHONDA EASY ST": "383040109281201",
    "LRP1A LOWER ROCKY PASS SPRING PIEZOMETER": "413308113492701",
    "WLP1C WILLOW SPRING CANYON PIEZOMETER 1C": "413435113475901",
    "WLP1B WILLOW SPRING CANYON PIEZOMETER 1B": "413435113475801",
    "BRYCE CANYON BC26W RICH": "374159112121001",
    "BRYCE CANYON BC13W POE": "374124112135501",
    "BRYCE CANYON BC22W RUBY 3": "374138112103102",
    "BRYCE CANYON BC21W RUBY 2": "374138112103101",
    "BRYCE CANYON BC15S LOWER BERRY": "374410112133001",
    "BRYCE CANYON BC27W AIRPORT": "374236112092501",
    "BRYCE CANYON BC40W ELK": "374232112100501",
    "BRYCE CANYON BC44W NPS 1": "373755112124301",
    "BRYCE CANYON BC17S UPPER BERRY": "374548112142201",
    "BRYCE CANYON BC25W UDOT": "374156112112401",
    "BRYCE CANYON BC51W BRISTLE CONE": "374646112063201",
    "BRYCE CANYON BC11S NPS 4": "373801112124701",
    "BRYCE CANYON BC2S TROPIC 1": "373639112152101",
    "BRYCE CANYON BC4S TROPIC 2": "373629112151801",
    "BRYCE CANYON BC12W USFS": "374017112130801",
    "BRYCE CANYON BC53S WATER STOP": "373534112151101",
    "BRYCE CANYON BC6S DRIPPING VAT": "374500112023001",
    "BRYCE CANYON BC48W SITLA": "374438112080601",
    "NGWMN WL 01 HAMMOND": "391159111543401",
    "NGWMN SP 02 NINE MILE": "391020111421301",
    "NGWMN WL 03 OLSEN": "392335111354601",
    "WL-T34-190605": "394809112161101",
    "SP-MUD2-190605": "394800112160201",
    "WL-T2-190605": "395215112140501",
    "SP-MUD1-190605": "395214112140301",
    "WL-T53-190605": "395059112120501",
    "ST-T15-190605": "395051112120101",
    "ST-T8-190605": "395126112124501",
    "BC35S BRYCE MOSSY CAVE": "373949112065401",
    "BC28W BRYCE CANYON LANDFILL 1": "374750112043401",
    "BC30W BRYCE CANYON LANDFILL 3": "374759112040101",
    "BC29W BRYCE LANDFILL 2": "374801112042101",
    "BC31S BRYCE CANYON TOM BEST SPG": "374855112054701",
    "BC19W BRYCE CANYON KINGS CG": "373647112154301",
    "NGWMN-TRIANGLE RANCH SPRING": "395718112234301",
    "NGWMN SP HUNGTINGTON": "392025110565901",
    "NGWMN IRRIGATION WELL GROUSE CREEK": "413332113545101",
    "NGWMN IRRIGATION WELL 13": "415657112514101",
    "NGWMN IRRIGATION WELL #5": "415906112485001",
    "NGWMN - WL-67-3499-2019": "390714112200401",
    "NGWMN - WL-FLOWELL WELL-2019": "385822112265201",
    "NGWMN - SP-BLACKSPRING-2019": "384610112495201",
    "NGWMN - WL-ASHELY GORGE-2019": "403429109370601",
    "NGWMN - SP-WHITEROCKS-2019": "402906109572401",
    "SG21C UGMN SG21C": "395312113244803",
    "MUD 1": "395214112140301",
    "MUD 2": "395214112140301",
    "T8": "395132112124901",
    "T15": "395051112120101",
    "T53": "395059112120501",
    "T34": "394809112161101",
    "T2": "395215112140501",
    "KGSP UWR4 KEG SPRING": "413507113472401",
    "NNBS UWR4 NORTH NORTH BEDKE SPRING": "413810113493901",
    "BC7W BRYCE CANYON RUBY 4": "374116112083901",
    "BC51W BRYCE CANYON BRISTLE CONE": "374646112063201",
    "AGI3C NGWMN WL-AGI3C-2019": "385630114020202",
    "01W CASTLE VALLEY OPEN LANDS PLACER": "383709109230701",
    "02W CASTLE VALLEY KEELER BAILEY": "383832109243901",
    "03W CASTLE VALLEY STUCKI": "383922109253801",
    "04W CASTLE VALLEY LOOP ROAD": "383746109214001",
    "05W CASTLE VALLEY PORCUPINE": "383453109200601",
    "06W CASTLE VALLEY ADELE CREEKSIDE": "384124109393101",
}
