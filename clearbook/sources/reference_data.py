"""Reference data kept as JSON: currency providers, the participant registry, parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Currencies of the hub and the names of their monetary zones.
CURRENCIES = ["EUR", "XOF", "MAD", "UGX", "ZMW", "RWF", "GHS", "XTS", "XXX"]
ZONE_NAMES = {
    "EUR": "Euro",
    "XOF": "CFA Franc BCEAO",
    "MAD": "Moroccan Dirham",
    "UGX": "Uganda Shilling",
    "ZMW": "Zambian Kwacha",
    "RWF": "Rwanda Franc",
    "GHS": "Ghana Cedi",
    "XTS": "Testing currency",
    "XXX": "No currency",
}
# Fixed value: seconds an exchange rate stays usable after its expiry.
RATE_FREEZE_SECONDS = 30

REGISTRY_SCHEMA = """
    currencies ARRAY<STRUCT<currencyId: STRING>>,
    monetaryZones ARRAY<STRUCT<monetaryZoneId: STRING, name: STRING>>,
    vdfsps ARRAY<STRUCT<dfspId: STRING, description: STRING, currencyId: STRING>>,
    dfsps ARRAY<STRUCT<dfspId: STRING, description: STRING, currencyId: STRING>>
"""


def read_currency_providers(spark: SparkSession, path: str) -> DataFrame:
    """``[{"currency": ..., "dfsp": ...}]``: the virtual participant of each currency."""
    return spark.read.schema("currency STRING, dfsp STRING").json(path, multiLine=True)


def read_parameters(spark: SparkSession, path: str) -> DataFrame:
    """``[{"id": ..., "value": ..., "description": ...}]``: business parameters."""
    return spark.read.schema("id STRING, value STRING, description STRING").json(path, multiLine=True)


def read_registry(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Registry documents, each with the four lists of ``REGISTRY_SCHEMA``."""
    return spark.read.schema(REGISTRY_SCHEMA).json(path, multiLine=multi_line)


def registry_list(documents: DataFrame, name: str) -> DataFrame:
    """One list of the registry documents as rows."""
    return documents.select(F.inline(name))


def standard_currency_providers(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{c}', 'DFSP{c}')" for c in CURRENCIES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(currency, dfsp)")
