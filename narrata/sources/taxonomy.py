"""Label taxonomies as tables."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONFIG = Path(__file__).resolve().parents[2] / "config"

ENTRY = "struct<normalized_category: string, evidence_type: string, evidence_description: string, cfpb_source: string>"
SCHEMA = f"taxonomy_id string, mapping map<string, {ENTRY}>"

# Product labels and their conservative groups (11 groups from 18 labels).
CONSERVATIVE = {
    "Credit reporting": "Credit Reporting & Repair",
    "Credit reporting, credit repair services, or other personal consumer reports": "Credit Reporting & Repair",
    "Credit card": "Credit Card & Prepaid",
    "Credit card or prepaid card": "Credit Card & Prepaid",
    "Prepaid card": "Credit Card & Prepaid",
    "Bank account or service": "Banking Accounts",
    "Checking or savings account": "Banking Accounts",
    "Money transfers": "Money Transfer & Services",
    "Money transfer, virtual currency, or money service": "Money Transfer & Services",
    "Virtual currency": "Money Transfer & Services",
    "Payday loan": "Consumer & Small Dollar Loans",
    "Payday loan, title loan, or personal loan": "Consumer & Small Dollar Loans",
    "Consumer Loan": "Consumer Loan",
    "Vehicle loan or lease": "Vehicle Finance",
    "Mortgage": "Mortgage",
    "Student loan": "Student Loan",
    "Debt collection": "Debt Collection",
    "Other financial service": "Other Financial Service",
}
# The broad taxonomy (10 groups) differs in one label.
BROAD = {**CONSERVATIVE, "Consumer Loan": "Consumer & Small Dollar Loans"}


def taxonomy_entries(spark: SparkSession, path: str) -> DataFrame:
    """``(category, normalized_category, evidence_type, source, rationale)`` from a taxonomy JSON document; absent ones are null."""
    doc = spark.read.schema(SCHEMA).option("multiLine", True).json(path)
    return doc.select(F.explode("mapping").alias("category", "entry")).select(
        "category", "entry.normalized_category", "entry.evidence_type", F.col("entry.cfpb_source").alias("source"),
        F.col("entry.evidence_description").alias("rationale"))


def load_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """``(category, normalized_category, evidence_type)`` from a taxonomy JSON document."""
    return taxonomy_entries(spark, path).select("category", "normalized_category", "evidence_type")


def mapping_table(spark: SparkSession, mapping: dict[str, str]) -> DataFrame:
    return spark.createDataFrame(sorted(mapping.items()), "category string, normalized_category string")


def read_entries(name: str) -> dict[str, dict[str, str]]:
    """Label -> entry of a packaged taxonomy."""
    return json.loads((CONFIG / f"{name}.json").read_text(encoding="utf-8"))["mapping"]


def read_config(name: str) -> dict[str, str]:
    """Label -> group of a packaged taxonomy."""
    return {k: v["normalized_category"] for k, v in read_entries(name).items()}
