"""Row policy and column tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def row_policy(df: DataFrame, principal: str, privileged: frozenset[str], column: str = "risk_segment", hidden: str = "high") -> DataFrame:
    """All rows for privileged principals; others see neither hidden nor NULL segments."""
    return df if principal in privileged else df.filter(F.col(column) != hidden)


#: The classification of governed columns, by table.
TAGS = {
    "fct_transaction_health": {
        "customer_id": {"pii": "true", "classification": "identifier"},
        "model_distress_score": {"data_class": "model-output", "model": "fraud_classifier"},
        "risk_score": {"data_class": "derived-heuristic"},
        "risk_segment": {"data_class": "sensitive"},
    },
    "dim_customers_snapshot": {
        "customer_id": {"pii": "true", "classification": "identifier"},
        "home_country": {"pii": "true", "classification": "location"},
        "account_open_date": {"pii": "true", "classification": "account-metadata"},
    },
}


def session_policy(spark: SparkSession, principals: tuple[str, ...], hidden: str = "high") -> str:
    """Registers the row filter as a SQL function of the segment, for the session's user; returns its name. A NULL segment is
    visible to `principals` alone."""
    listed = ", ".join(f"'{p}'" for p in principals) or "NULL"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION visible_segment(segment STRING) RETURNS BOOLEAN RETURN coalesce(current_user() IN ({listed}), false) OR segment <> '{hidden}'")
    return "visible_segment"


def tagged(df: DataFrame, tags: dict[str, dict[str, str]]) -> DataFrame:
    """Tags as column metadata, which Parquet keeps."""
    for name, own in tags.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, **own})
    return df


def layout(df: DataFrame, key: str, files: int) -> DataFrame:
    """Rows clustered by key for file skipping; the rows themselves don't change."""
    return df.repartitionByRange(files, key).sortWithinPartitions(key)
