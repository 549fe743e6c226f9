"""Complaint tables: CSV scan, column roles, canonical columns, filters and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from narrata.functions.text import is_blank
from narrata.sources import csv_scan

# Column names that can fill each role, in order of preference.
TEXT_COLUMNS = ("Consumer Complaint", "Consumer complaint narrative", "complaint_what_happened", "complaint_text", "text")
CATEGORY_COLUMNS = ("Product", "product", "category")
ID_COLUMNS = ("Complaint ID", "complaint_id", "id")
ROLES = {"text": TEXT_COLUMNS, "category": CATEGORY_COLUMNS, "id": ID_COLUMNS}

# Columns of the published CSV export.
CSV_COLUMNS = (
    "Complaint ID", "Date received", "Product", "Sub-product", "Issue", "Sub-issue", "Consumer Complaint",
    "Company Public Response", "Company", "State", "ZIP code", "Tags", "Consumer consent provided?", "Submitted via",
    "Date Sent to Company", "Company Response to Consumer", "Timely response?", "Consumer disputed?", "Unnamed: 18",
)
CSV_SCHEMA = StructType([StructField(c, StringType()) for c in CSV_COLUMNS])


def resolve_columns(columns) -> dict[str, str]:
    """Column per role; text and category are required. Names match case by case."""
    names = set(columns.columns if isinstance(columns, DataFrame) else columns)
    found = {}
    for role, candidates in ROLES.items():
        hit = next((c for c in candidates if c in names), None)
        if hit is not None:
            found[role] = hit
        elif role != "id":
            raise ValueError(f"Missing required {role} column. Looked for {list(candidates)}, found {sorted(names)}")
    return found


def validate_columns(df: DataFrame) -> dict[str, str]:
    if df.isEmpty():
        raise ValueError("Cannot validate columns: the table is empty (0 rows).")
    return resolve_columns(df)


def standardize(df: DataFrame) -> DataFrame:
    """Add text, category and complaint_id beside the original columns."""
    roles = resolve_columns(df)
    target = {"text": "text", "category": "category", "id": "complaint_id"}
    present = {c.lower() for c in df.columns}
    # names are matched without case, so a role that already has its canonical name is left alone
    new = {target[r]: F.col(f"`{c}`") for r, c in roles.items() if c != target[r] and
           (target[r].lower() not in present or target[r] in df.columns)}
    return df.withColumns(new) if new else df


def drop_invalid(df: DataFrame, text: str = "text", category: str = "category") -> DataFrame:
    return df.filter(~is_blank(F.col(f"`{text}`")) & F.col(f"`{category}`").isNotNull())


def load_csv(spark: SparkSession, path: str, nrows: int | None = None, invalid_rows: bool = True,
             canonical: bool = True, schema: StructType | None = None, header_schema: bool = False, splittable: bool = False) -> DataFrame:
    """Scan complaint CSV files. All columns are strings and nothing is inferred from the data.

    ``header_schema`` takes the column names from the header for files with another layout. ``splittable`` reads each file
    in several tasks (``csv_scan``), for files that are too large for one. A missing path or a table without rows raises.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    if not header_schema:
        reader = reader.schema(schema or CSV_SCHEMA).option("enforceSchema", False)
    try:
        df = csv_scan.scan(spark, path, None if header_schema else schema or CSV_SCHEMA) if splittable else reader.csv(path)
    except Exception as err:
        if "PATH_NOT_FOUND" in str(err):
            raise FileNotFoundError(f"Dataset not found: {path}") from err
        raise
    if nrows is not None:
        df = df.limit(nrows)
    if df.isEmpty():
        raise ValueError(f"Dataset at {path} contains 0 rows.")
    if not invalid_rows:
        roles = resolve_columns(df)
        df = drop_invalid(df, roles["text"], roles["category"])
    return standardize(df) if canonical else df


def drop_junk_columns(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("Unnamed:") or c.startswith("_c")])


def filter_records(df: DataFrame, product: str | None = None, term: str | None = None,
                   category: str = "category", text: str = "text") -> DataFrame:
    """Rows of one product that contain a term, whatever its case."""
    if product and product.strip():
        df = df.filter(F.col(category) == product.strip())
    if term and term.strip():
        df = df.filter(F.contains(F.lower(text), F.lit(term.strip().lower())))
    return df


def record_count(df: DataFrame) -> int:
    return df.count()


def preview(df: DataFrame, id: str, n: int = 10) -> DataFrame:
    return df.orderBy(id).limit(n)


def by_id(df: DataFrame, id: str, value) -> DataFrame:
    return df.filter(F.col(id) == value)


def load(spark: SparkSession, source: str, path: str, **options) -> DataFrame:
    """``csv`` files or landed JSON ``pages``."""
    from narrata.sources.pages import load_pages

    readers = {"csv": load_csv, "pages": load_pages}
    name = str(source).strip().lower()
    if name not in readers:
        raise ValueError(f"Unsupported source '{source}'. Choose one of {sorted(readers)}.")
    return readers[name](spark, path, **options)


def save(df: DataFrame, path: str, format: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Write a result table as parquet, csv or json."""
    if format not in ("parquet", "csv", "json"):
        raise ValueError(f"Unsupported format '{format}'.")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if format == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
    writer.format(format).save(path)
