"""Fixed values of the record formats this package reads and writes.

Everything here is a constant of the data contract (names, word lists, limits and
text formats), kept in one place and in natural order.  Nothing here is logic.
"""

from pyspark.sql import types as T

# --- fixed values: reporting period, inclusive -------------------------------
START_YEAR = 2024
END_YEAR = 2025

# --- fixed values: the target record, in output order -------------------------
TARGET_FIELDS = {
    "PRJ_NAME": "string",
    "AGENCY": "string",
    "AGENCY_C": "string",
    "YEAR_COMP": "int",
    "DATE_COMP": "timestamp",
    "FUND_SOURCE": "string",
    "FUND_TYPE": "string",
    "PARTNERS": "string",
    "LANDOWNER": "string",
    "MGT_TYPE": "string",
    "ACTIVITY": "string",
    "TREE_COUNT": "int",
    "SPECIES": "string",
    "PRJ_OBJECT": "string",
    "ACRES_GIS": "double",
    "ACRES_MGT": "double",
    "NOTES": "string",
    "ORGFILE": "string",
    "UPDATED": "date",
    "MODIFY_BY": "string",
    "SourceOID": "bigint",
}

# --- fixed values: the merged record (19 fields), in output order -------------
MERGED_FIELDS = {
    "PRJ_NAME": "string",
    "AGENCY": "string",
    "AGENCY_C": "string",
    "FUND_SOURCE": "string",
    "FUND_TYPE": "string",
    "PARTNERS": "string",
    "LANDOWNER": "string",
    "MGT_TYPE": "string",
    "ACTIVITY": "string",
    "TREE_COUNT": "int",
    "SPECIES": "string",
    "PRJ_OBJECT": "string",
    "YEAR_COMP": "int",
    "ACRES_GIS": "double",
    "ACRES_MGT": "double",
    "NOTES": "string",
    "ORGFILE": "string",
    "UPDATED": "date",
    "MODIFY_BY": "string",
}

# --- fixed values: the older target record ------------------------------------
OLDER_FIELDS = {
    "PRJ_NAME": "string",
    "AGENCY": "string",
    "AGENCY_C": "string",
    "FUNDING": "string",
    "LANDOWNER": "string",
    "MGT_TYPE": "string",
    "RXFIRE_MGT": "string",
    "CANOPY_MGT": "string",
    "SURF_MGT": "string",
    "REFOREST": "string",
    "TREE_COUNT": "int",
    "SPECIES": "string",
    "PRJ_OBJECT": "string",
    "YEAR_COMP": "int",
    "ACRES_GIS": "double",
    "ACRES_MGT": "double",
    "NOTES": "string",
    "ORGFILE": "string",
    "UPDATED": "date",
    "MODIFY_BY": "string",
    "SourceOID": "bigint",
}

# --- fixed values: columns kept beside the target while a flow runs -----------
ACTIVITY_LAYER_FIELDS = [
    "NEPA_DOC_NAME", "TREATMENT_NAME", "ACTIVITY", "METHOD", "EQUIPMENT",
    "DATE_COMPLETED", "DATE_AWARDED", "FUND_CODE", "NBR_UNITS_ACCOMPLISHED", "fileNmDate",
]
SERVICE_LAYER_FIELDS = [
    "ID", "Name", "Type", "Category", "SubType", "Class", "Agency", "Department", "State",
    "CalculatedArea", "InitiationDate", "CompletionDate", "Notes", "Status",
    "FundingSource", "FundingSourceProgram", "FundingAgency",
]
SYSTEM_FIELDS = ["oid", "geom", "srid"]

# --- fixed values: activity -> (activity, management type) --------------------
ACTIVITY_MAP = {
    "Broadcast Burn": ("Broadcast Burn", "Prescribed Fire"),
    "Pile Burn": ("Pile Burn", "Prescribed Fire"),
    "Manual": ("Manual", "Mechanical and Hand"),
    "Mechanical": ("Mechanical", "Mechanical and Hand"),
    "Mastication": ("Mastication", "Mechanical and Hand"),
    "Chemical": ("Chemical", "Mechanical and Hand"),
    "Removal": ("Removal", "Mechanical and Hand"),
    "Lop and Scatter": ("Lop and Scatter", "Mechanical and Hand"),
    "Pile Fuels": ("Pile Fuels", "Mechanical and Hand"),
    "Mulching": ("Mulching", "Mechanical and Hand"),
    "Plant Trees": ("Plant Trees", "Reforestation"),
    "Seed": ("Seed", "Reforestation"),
}

# --- fixed values: activity -> (column of the older record, older type) -------
OLDER_ACTIVITY_COLUMNS = {
    "Broadcast Burn": ("RXFIRE_MGT", "FIRE"),
    "Pile Burn": ("RXFIRE_MGT", "FIRE"),
    "Manual": ("CANOPY_MGT", "CANOPY"),
    "Mechanical": ("CANOPY_MGT", "CANOPY"),
    "Mastication": ("CANOPY_MGT", "CANOPY"),
    "Chemical": ("CANOPY_MGT", "CANOPY"),
    "Removal": ("SURF_MGT", "SURFACE"),
    "Lop and Scatter": ("SURF_MGT", "SURFACE"),
    "Pile Fuels": ("SURF_MGT", "SURFACE"),
    "Mulching": ("SURF_MGT", "SURFACE"),
    "Plant Trees": ("REFOREST", "REFOREST"),
    "Seed": ("REFOREST", "REFOREST"),
}

# --- fixed values: words in a management type, tested in order ----------------
MGT_TYPE_WORDS = [
    ("canopy", "Mechanical and Hand Equipment"),
    ("surface", "Mechanical and Hand Equipment"),
    ("reforest", "Reforestation"),
    ("rxfire", "Prescribed Fire"),
    ("prescribed", "Prescribed Fire"),
    ("fire", "Prescribed Fire"),
]

# --- fixed values: columns that carry the activity before a merge -------------
SINGLE_CHOICE_COLUMNS = ["CANOPY_MGT", "SURF_MGT", "RXFIRE_MGT", "REFOR_MGT"]
MERGE_RENAMES = {"FIRE_MGT": "RXFIRE_MGT", "REFOREST": "REFOR_MGT"}

# --- fixed values: agency stamps; a leading "=" names a source column ---------
AGENCY_CONSTANTS = {
    "blm": {
        "AGENCY": "Bureau of Land Management",
        "AGENCY_C": "BLM",
        "ORGFILE": "vtrt_cmplt_poly",
        "FUND_TYPE": "Federal",
    },
    "ifpers": {
        "AGENCY_C": "=FundingAgency",
        "ORGFILE": "IFPRS_Open_Data/Polygon Actions",
        "FUND_TYPE": "Federal",
    },
    "usfs": {
        "AGENCY": "US Forest Service",
        "AGENCY_C": "USFS",
        "ORGFILE": "=fileNmDate",
        "FUND_TYPE": "Federal",
    },
    "csfs": {
        "AGENCY": "Colorado State Forest Service",
        "AGENCY_C": "CSFS",
    },
}

# --- fixed values: target column <- source column -----------------------------
AGENCY_FIELD_MAPS = {
    "blm": {"PRJ_NAME": "TRTMNT_NM", "PRJ_OBJECT": "TRTMNT_COMMENTS"},
    "usfs": {"PRJ_OBJECT": "ACTIVITY", "FUND_SOURCE": "funding_update"},
    "ifpers": {"PRJ_NAME": "Name", "PRJ_OBJECT": "Notes", "FUND_SOURCE": "FundingSource"},
}

# --- fixed values: labels with a meaning of their own -------------------------
SKIP, EXCLUDE, DELETE, UNCLASSIFIED = "SKIP", "EXCLUDE", "DELETE", "UNCLASSIFIED"
REVIEW_LABELS = ["UNCLASSIFIED", "TREE CHECK", "PLANT CHECK"]
ROUTES = ["deleted", "review", "classified"]
SWEEP_METHODS = ["Mechanical", "Removal"]

# --- fixed values: null-like words, per place ----------------------------------
KEY_NULL_WORDS = ["nan", "none", "null"]
LIST_NULL_WORDS = ["NONE", "UNKNOWN"]
NOT_A_LABEL = ["", "None", "DELETE", "UNCLASSIFIED", "Null"]
CSV_NULL_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
PLACEHOLDER_DOC_NAMES = [
    "DEFAULT FOR NOT REQUIRED",
    "CE without DM",
    "DECISION NOTICE AND FINDING OF NO SIGNIFICANT IMPACT",
    "NEPA Pending",
]

# --- fixed values: acreage and shape limits -----------------------------------
SQ_M_PER_ACRE = 4046.8564224
CLAMP_ACRES_PER_SQ_M = 0.000247105
SLIVER_FLOOR_ACRES = 0.01
SLIVER_CHECK_ACRES = 0.05
SLIVER_COMPACTNESS = 0.025
TARGET_SRID = 26913

# --- fixed values: file label of the older record, with its completion year -----
OLDER_FILE_LABEL = "GEOTRACKS_%s_Completed_ForestManagementTreatment"

# --- fixed values: text widths --------------------------------------------------

# --- fixed values: keyword rules, tested in this order --------------------------
KEYWORD_RULES = [
    (r"\bhand(?:\s*|-)?(?:thin(?:ning)?|cut(?:ting)?)\b", "Manual"),
    (r"manual", "Manual"),
    (r"(?:^|[\s_])pile\s*(?:rx|burn(?:ing)?)\b", "Pile Burn"),
    (r"\bpil(?:e|es|ed|ing)\b", "Pile Fuels"),
    (r"thin(?:ning)? (?:without|with no) remov\w*", "Mechanical"),
    (r"\bthin(?:ning)?\b", "Mechanical"),
    (r"feller buncher", "Mechanical"),
    (r"mechanical", "Mechanical"),
    (r"remov\w*", "Removal"),
    (r"salvage", "Removal"),
    (r"\b(?:broadcast\s*(?:burn|rx)|prescribed(?:\s*(?:fire|burn|rx))?|control\s*burn|rx\s*(?:burn|fire))\b",
     "Broadcast Burn"),
    (r"masticat(?:e|ion)", "Mastication"),
    (r"hydro\w*", "Mastication"),
    (r"fecon|bull hog", "Mastication"),
    (r"rollerchop\w*", "Mastication"),
    (r"mow(?:ing)?", "Mastication"),
    (r"\bmx\b", "Mastication"),
    (r"\bslash(?:ing)?\b", "Mastication"),
    (r"biomass removal", "Removal"),
    (r"\bchip\w*\b", "Mulching"),
    (r"crushing", "Mulching"),
    (r"\blop\b(?:\s+\w+)*\s+scatter\b", "Lop and Scatter"),
    (r"wildfire|fire use|resource benefit", "DELETE"),
    (r"\bcheat\s*grass\b", "DELETE"),
    (r"invasives", "DELETE"),
    (r"(?:^|[\s_])weeds?\b", "DELETE"),
    (r"(?:^|[\s_])seeding?\b", "DELETE"),
    (r"herb", "DELETE"),
    (r"biological", "DELETE"),
    (r"\b(?:oak|russian olive|tamarisk|salt cedar|cottonwood)\b", "TREE CHECK"),
    (r"planting", "PLANT CHECK"),
]

# Polygon column: parts -> rings -> vertices; ring 0 is the shell (counter-clockwise),
# the others are holes (clockwise), and the closing vertex is not stored.
VERTEX = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
GEOM = T.ArrayType(T.ArrayType(T.ArrayType(VERTEX)))

# What every standardized activity layer has, with its types: the contract of their merge.
GEOM_TYPE = "array<array<array<struct<x:double,y:double>>>>"
ACTIVITY_CONTRACT = {
    "oid": "bigint", "NEPA_DOC_NAME": "string", "TREATMENT_NAME": "string", "ACTIVITY": "string", "METHOD": "string",
    "EQUIPMENT": "string", "DATE_COMPLETED": "date", "DATE_AWARDED": "date", "FUND_CODE": "string",
    "NBR_UNITS_ACCOMPLISHED": "double", "fileNmDate": "string", "layer": "string", "geom": GEOM_TYPE,
}
