"""Surrogate keys, code decoding and NULL-propagating concatenation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Key text of the published surrogate-key macro (dbt_utils
# 1.0.0) and the labels of the payment-type decoding macro.
# ---------------------------------------------------------------------------
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"
PAYMENT_TYPE_LABELS = {
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}


def key_text(c: Column, dtype: T.DataType) -> Column:
    """Text form of one key part. Timestamps are written as the warehouse
    prints a UTC timestamp (``2022-12-31 23:00:00+00``), so the key does not
    depend on Spark's own cast format."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("+00"))
    return c.cast("string")


def surrogate_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """md5 over the parts joined by ``-``; NULL parts get a fixed token."""
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = [
        F.coalesce(key_text(F.col(c), types[c]), F.lit(SURROGATE_NULL)) for c in columns
    ]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


def decode_codes(c: Column | str, labels: Mapping = PAYMENT_TYPE_LABELS) -> Column:
    """Simple CASE: known code -> label, anything else -> NULL."""
    c = F.col(c) if isinstance(c, str) else c
    items = list(labels.items())
    expr = F.when(c == F.lit(items[0][0]), F.lit(items[0][1]))
    for code, label in items[1:]:
        expr = expr.when(c == F.lit(code), F.lit(label))
    return expr


def concat_nullable(*parts: Column, sep: str = ",") -> Column:
    """``a || sep || b``: NULL when any part is NULL (unlike concat_ws)."""
    cols: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(sep))
        cols.append(p)
    return F.concat(*cols)
