"""Landed JSON search pages (``hits.hits[]._source``) in the canonical schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from narrata.functions.text import strip
from narrata.sources.tables import filter_records

# Field and column names of the records.
HIT = ("struct<_index: string, _id: string, _source: struct<complaint_id: string, product: string, sub_product: string, "
       "issue: string, company: string, state: string, date_received: string, complaint_what_happened: string, "
       "has_narrative: boolean>>")
PAGE_SCHEMA = f"hits struct<hits: array<{HIT}>>"

COLUMNS = ("complaint_id", "category", "text", "Complaint ID", "Product", "Consumer Complaint",
           "issue", "sub_product", "company", "date_received", "state")


def _given(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def normalize_hit(hit: str = "hit") -> dict[str, Column]:
    """Canonical columns of one hit; an empty id or product counts as missing."""
    source = F.col(f"{hit}._source")
    id = F.coalesce(_given(source["complaint_id"]), F.col(f"{hit}._id"), F.lit(""))
    product = F.coalesce(_given(source["product"]), F.lit("Unspecified"))
    text = F.coalesce(strip(source["complaint_what_happened"]), F.lit(""))
    return {
        "complaint_id": id, "category": product, "text": text,
        "Complaint ID": id, "Product": product, "Consumer Complaint": text,
        **{c: source[c] for c in ("issue", "sub_product", "company", "date_received", "state")},
    }


def hits_of(pages: DataFrame, order: list[str]) -> DataFrame:
    """One row per hit with its place (``order`` columns of the page, then ``pos``)."""
    rows = pages.select(*order, F.posexplode("hits.hits").alias("pos", "hit"))
    return rows.select(*order, "pos", *[c.alias(n) for n, c in normalize_hit().items()])


def collect(pages: DataFrame, order: list[str], max_records: int | None = None, drop_empty: bool = False,
            product: str | None = None, term: str | None = None) -> DataFrame:
    """All hits in page order, or the first ``max_records``; texts without content go before the cap counts."""
    if max_records is not None and max_records <= 0:
        raise ValueError(f"The number of records asked for is {max_records}; it has to be above 0.")
    rows = filter_records(hits_of(pages, order), product, term)
    if drop_empty:
        rows = rows.filter("text <> ''")
    if max_records is not None:
        rows = rows.orderBy(*order, "pos").limit(max_records)
    return rows.select(*[F.col(f"`{c}`") for c in COLUMNS])


def load_pages(spark: SparkSession, path: str, **options) -> DataFrame:
    """Read landed page files; the file name gives the page order."""
    raw = spark.read.schema(PAGE_SCHEMA).option("multiLine", True).json(path)
    pages = raw.select("hits", F.col("_metadata.file_path").alias("page"))
    return collect(pages, ["page"], **options)
