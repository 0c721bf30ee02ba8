"""Projections that tolerate older files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainlake.schema import LEGACY


def compatible(df: DataFrame, required: list[str]) -> DataFrame:
    """The required columns in order. Missing provenance gets its legacy stand-in; anything else missing raises ValueError."""

    def column(name: str) -> Column:
        if name in df.columns:
            return F.col(name)
        if name not in LEGACY:
            raise ValueError(f"column {name!r} is required and missing; there are {', '.join(df.columns)}")
        kind, value = LEGACY[name]
        return (F.lit(value) if kind == "literal" else F.col(value)).alias(name)

    return df.select(*[column(n) for n in required])


def payload_field(df: DataFrame, name: str, kind: T.DataType) -> Column:
    """payload.name cast to kind, or a null if this file's payload has no such field; read by nested column pruning."""
    payload = df.schema["payload"].dataType if "payload" in df.columns else T.StructType()
    found = F.col("payload").getField(name) if name in payload.fieldNames() else F.lit(None)
    return found.cast(kind).alias(name)


def event_id() -> Column:
    """chain-transaction-log; null if a part is."""
    return F.concat(F.col("chain"), F.lit("-"), F.col("transaction_hash"), F.lit("-"), F.col("log_index").cast("string"))
