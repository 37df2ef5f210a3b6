"""Default column names and the default ticket grouping."""

# Names that stored tables and tickets carry.
TABLE_NAME_COL = "DBTableName"
HASH_COL = "NestedDataHash"
TASK_GROUP_COL = "tar_group"

VALID_FROM_COL = "ValidFromVersion"
VALID_TO_COL = "ValidToVersion"

COUNTRY_COL = "Country"
YEAR_COL = "Year"

MATNAME_COL = "matname"
MATVAL_COL = "matval"
ROWNAME_COL = "rowname"
COLNAME_COL = "colname"
ROWTYPE_COL = "rowtype"
COLTYPE_COL = "coltype"
ROW_INDEX_COL = "i"
COL_INDEX_COL = "j"
VALUE_COL = "value"

# Dimensions that hold matrix indices, and the table of row and column types.
INDEX_TABLE = "Index"
INDEX_TABLES_BY_TYPE = ("Industry", "Product", "Other")
RCTYPE_TABLE = "matnameRCType"

KEY_SUFFIX = "ID"

SCHEMA_TABLE_COLS = (
    "Table",
    "Colname",
    "IsPK",
    "ColDataType",
    "FKTable",
    "FKColname",
)

USUAL_GROUP_COLS = (
    "Dataset",
    "DBTableName",
    "Country",
    "Method",
    "Year",
    "LastStage",
    "EnergyType",
    "IncludesNEU",
    "tar_group",
)
