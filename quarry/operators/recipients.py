"""Recipient normalisation.

``recipients`` / ``cc`` / ``bcc`` hold JSON arrays whose elements are objects
``{"email", "name"}`` or bare strings.  One row per element and column:
objects give their fields, strings give ``email``, anything else (number,
null, nested array) still gives a row with both NULL.  A cell that is NULL,
not JSON, or not an array gives no rows.  One generator over the three
columns - one scan, no union of three scans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.jsonpath import array_elements

RECIPIENT_COLUMNS = ("recipients", "cc", "bcc")


def normalize_recipients(df: DataFrame, id_col: str = "id",
                         columns: Sequence[str] = RECIPIENT_COLUMNS) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    tagged = F.array(*[
        F.struct(F.lit(c).alias("recipient_type"), F.col(c).cast("string").alias("j"))
        for c in present
    ])
    per_col = df.select(F.col(id_col).cast("string").alias("email_id"),
                        F.inline(tagged))
    elems = per_col.select("email_id", "recipient_type",
                           F.explode(array_elements(F.col("j"))).alias("e"))
    kind = F.schema_of_variant(F.col("e"))
    is_obj = kind.startswith("OBJECT")
    email = (F.when(is_obj, F.try_variant_get(F.col("e"), "$.email", "string"))
             .when(kind == "STRING", F.try_variant_get(F.col("e"), "$", "string")))
    name = F.when(is_obj, F.try_variant_get(F.col("e"), "$.name", "string"))
    return elems.select("email_id", "recipient_type", email.alias("email"), name.alias("name"))
