"""Raw load from delimited files.

Per source file: which columns are read as text (ids that would lose their
leading zeros as numbers) and which text ids are stripped and zero-padded.
The types of all other columns are inferred from the whole file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources import scan_csv
from .etl import PAD_RULES
from .staging import CBSA_COLUMN

# Per raw table, the columns kept as text.
TEXT_COLUMNS = {
    "medicare_inpatient": ["Rndrng_Prvdr_CCN", "Rndrng_Prvdr_State_FIPS", "Rndrng_Prvdr_Zip5"],
    "cost_report": ["Provider CCN", "Zip Code", "Medicare CBSA Number"],
    "hospital_general_info": ["Facility ID", "ZIP Code"],
    "census_acs": [CBSA_COLUMN],
    "zip_cbsa_crosswalk": ["geoid", "cbsa"],
}
# Surrogate keys hash the text form of a DRG code and the seed maps that
# form, so it must not depend on whether a file's codes look like numbers.
KEY_COLUMNS = {"medicare_inpatient": ["DRG_Cd"]}


def load_raw_csv(spark: SparkSession, paths: dict[str, str], multiline=(),
                 types: dict[str, dict[str, str]] | None = None) -> dict[str, DataFrame]:
    """Scan each raw file (or folder of files) with its config.

    Ids stay text and are padded as the loaders do; NA tokens become NULL;
    every other column gets the type that all its values allow. ``types``
    (table -> column -> Spark type) declares columns instead. ``multiline``
    names the tables whose fields may hold line breaks.
    """
    out = {}
    for table, path in paths.items():
        out[table] = scan_csv(spark, path, types=(types or {}).get(table, {}),
                              str_columns=TEXT_COLUMNS.get(table, []) + KEY_COLUMNS.get(table, []),
                              pad_columns=PAD_RULES.get(table, {}), multiline=table in multiline, infer=True)
    return out
