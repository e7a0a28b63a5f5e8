"""Processed (cleaned) files: Parquet, and CSV with list columns as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobgrain.functions.text import decode_list, first_filled

# Both spellings of the place keys occur in processed files.
PLACE_TEXT = (
    "STRUCT<country_code: STRING, subdivision_code: STRING, city: STRING, "
    "country: STRING, state: STRING>"
)
NAME_TEXT = "STRUCT<name: STRING>"

CSV_COLUMNS = {
    "companies": [
        "company_id", "company_name", "description", "publication_date", "size",
        "locations", "industries",
    ],
    "jobs": [
        "job_id", "company_id", "job_name", "level", "publication_date", "locations",
        "categories",
    ],
    "salaries": [
        "adz_job_id", "company_name", "adz_job_name", "adz_category", "publication_date",
        "locations", "salary_min", "salary_max", "salary_is_predicted", "categories",
        "level",
    ],
}

CSV_TYPES = {
    "company_id": "bigint",
    "job_id": "bigint",
    "adz_job_id": "bigint",
    "publication_date": "timestamp",
    "salary_min": "double",
    "salary_max": "double",
    "salary_is_predicted": "int",
}


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; list columns become JSON text."""
    out = [
        (F.to_json(f.name).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name))
        for f in df.schema.fields
    ]
    df.select(*out).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_csv(
    spark: SparkSession, path: str, dataset: str, line_breaks: bool = True
) -> DataFrame:
    """Processed CSV as a cleaned table with native lists. A file whose cells may
    hold line breaks is read by one task; without them (`line_breaks=False`, true
    of what `write_csv` writes from cleaned tables) files are split."""
    columns = CSV_COLUMNS[dataset]
    text = (
        spark.read.schema(", ".join(f"{c} STRING" for c in columns))
        .option("header", True)
        .option("multiLine", line_breaks)
        .option("escape", '"')
        .csv(path)
    )
    out = []
    for c in columns:
        if c == "locations":
            out.append(unify_places(decode_list(F.col(c), PLACE_TEXT)).alias(c))
        elif c == "industries":
            out.append(decode_list(F.col(c), NAME_TEXT).alias(c))
        else:
            out.append(F.col(c).cast(CSV_TYPES.get(c, "string")).alias(c))
    return text.select(*out)


def unify_places(places):
    """Places with one set of keys, whichever spelling the text had."""
    return F.transform(
        places,
        lambda x: F.struct(
            first_filled(x["country_code"], x["country"]).alias("country_code"),
            first_filled(x["subdivision_code"], x["state"]).alias("subdivision_code"),
            x["city"].alias("city"),
        ),
    )
