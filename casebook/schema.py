"""Raw journal schema and the column names used across the package."""

from pyspark.sql import types as T

# Raw journal, one row per entry. ZENTRUM_ID is second on purpose (first-row site tests look there).
RAW_SCHEMA = T.StructType(
    [
        T.StructField("PATIENT_HASH", T.StringType()),
        T.StructField("ZENTRUM_ID", T.StringType()),
        T.StructField("PATIENT_ID", T.LongType()),
        T.StructField("PAT_GEBDATUM", T.StringType()),
        T.StructField("PAT_GESCHLECHT", T.StringType()),
        T.StructField("DATUM", T.StringType()),
        T.StructField("TYP", T.StringType()),
        T.StructField("TYP_EXT", T.StringType()),
        T.StructField("TEXT", T.StringType()),
        T.StructField("ICD10", T.StringType()),
        T.StructField("SICHERHEIT", T.StringType()),
    ]
)
RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]

PATIENT = "PATIENT_HASH"
SITE = "ZENTRUM_ID"
# Content hash of the raw row, added at read time: the tie-break for every order-dependent step.
ENTRY_ID = "entry_id"

FLAG_COLUMNS = ["is_E75_22", "is_E78_01", "is_E78_3", "is_E71_3"]
