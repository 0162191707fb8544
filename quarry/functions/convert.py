"""Schema-adaptive column conversion (P1-P8) as Column expressions.

The loader of the reference converts each cell in Python; here every converter
is a ``Column -> Column`` function chosen by the *source* data type, so a whole
mapping is one ``select`` that Catalyst compiles (no Python per row).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Converter = Callable[[Column, T.DataType], Column]

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def _is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, _NUMERIC)


def _is_nested(dt: T.DataType) -> bool:
    return isinstance(dt, (T.ArrayType, T.StructType, T.MapType))


def safe_str(c: Column, dt: T.DataType) -> Column:
    """NULL stays NULL, else the text form (booleans as ``True``/``False``).
    Numbers are written out in digits below 1e16 (12345678.9), as Python does,
    and in exponent form from there on."""
    if isinstance(dt, T.BooleanType):
        return F.when(c, F.lit("True")).when(~c, F.lit("False"))
    if _is_nested(dt):
        return F.to_json(c, {"ignoreNullFields": "false"})
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        digits = F.regexp_replace(c.cast("string").try_cast("decimal(38,18)").cast("string"), r"(\.\d+?)0+$", "$1")
        return F.when((F.abs(c) >= 1e7) & (F.abs(c) < 1e16), digits).otherwise(c.cast("string"))
    return c.cast("string")


def _try_int(c: Column) -> Column:
    return c.try_cast("int")


def safe_int(c: Column, dt: T.DataType) -> Column:
    """Integer or NULL; numbers truncate (12.7 -> 12), text must be an
    integer literal ('12.7' -> NULL)."""
    if isinstance(dt, T.StringType):
        return _try_int(F.trim(c))
    if isinstance(dt, T.BooleanType):
        return c.cast("int")
    if _is_numeric(dt):
        # truncation toward zero, NULL outside the int range
        return _try_int(c)
    return _try_int(c.cast("string"))


def safe_bool(c: Column, dt: T.DataType) -> Column:
    """Booleans pass; otherwise truthiness (``'false'`` -> TRUE, ``''``/0 -> FALSE)."""
    if isinstance(dt, T.BooleanType):
        return c
    if _is_numeric(dt):
        return c != 0
    if isinstance(dt, T.StringType):
        return c != ""
    if isinstance(dt, (T.ArrayType, T.MapType)):
        # explicit NULL guard: size(NULL) is -1 when ANSI mode is off
        return F.when(c.isNotNull(), F.size(c) > 0)
    return c.isNotNull()


def safe_timestamp(c: Column, dt: T.DataType) -> Column:
    """P5: timestamps pass; text is parsed, unparseable -> NULL (the reference
    aborts the load; :func:`rejected_rows` lists such rows instead)."""
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return c.cast("timestamp")
    if isinstance(dt, T.DateType):
        return c.cast("timestamp")
    return F.try_to_timestamp(c.cast("string"))


def safe_json(c: Column, dt: T.DataType) -> Column:
    """Compact JSON text.  Nested values serialise; text that parses is
    re-serialised; other text becomes a JSON string; any other scalar becomes
    the JSON string of its text (5 -> ``"5"``, true -> ``"True"``).
    Repeated keys keep the last value when ``spark.sql.variant.allowDuplicateKeys``
    is true (set by :func:`quarry.session.get_session`); otherwise such text
    is kept as a JSON string."""
    if _is_nested(dt):
        return F.to_json(c, {"ignoreNullFields": "false"})
    if isinstance(dt, T.StringType):
        return F.to_json(F.coalesce(F.try_parse_json(c), c.cast("variant")))
    return F.to_json(safe_str(c, dt).cast("variant"))


def raw_json(df: DataFrame) -> Column:
    """The whole record as JSON, NULL fields kept."""
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})


def truthy_coalesce(df: DataFrame, candidates: Sequence[str]) -> Column:
    """First *truthy* candidate column (``''`` and 0 fall through like
    NULL); the last candidate is returned as is, NULL when it is absent."""
    types = {f.name: f.dataType for f in df.schema.fields}
    parts: list[Column] = []
    for i, name in enumerate(candidates):
        last = i == len(candidates) - 1
        if name not in types:
            if last:
                parts.append(F.lit(None))
            continue
        c, dt = F.col(name), types[name]
        if last:
            parts.append(c)
        elif isinstance(dt, T.StringType):
            parts.append(F.nullif(c, F.lit("")))
        elif _is_numeric(dt):
            parts.append(F.nullif(c, F.lit(0)))
        elif isinstance(dt, T.BooleanType):
            parts.append(F.when(c, c))
        else:
            parts.append(c)
    if len(parts) == 1:
        return parts[0]
    # mixed candidate types resolve to string, as the reference stringifies
    types_seen = {types[n].simpleString() for n in candidates if n in types}
    if len(types_seen) > 1:
        parts = [p.cast("string") for p in parts]
    return F.coalesce(*parts)


CONVERTERS: dict[str, Converter] = {
    "str": safe_str,
    "int": safe_int,
    "bool": safe_bool,
    "timestamp": safe_timestamp,
    "json": safe_json,
}

TARGET_TYPES = {
    "str": "string",
    "int": "int",
    "bool": "boolean",
    "timestamp": "timestamp",
    "json": "string",
}


def adaptive_select(df: DataFrame, column_map: dict[str, tuple[str, str]],
                    with_raw_json: bool = False, extra: Sequence[Column] = ()) -> DataFrame:
    """One ``select`` from a ``{target: (source, converter)}`` mapping.

    Source columns are discovered from the DataFrame schema (the parquet
    footer); mapped columns that do not exist become typed NULLs, unmapped
    source columns survive only inside ``raw_json``.  ``extra`` columns (of
    the source, such as file metadata) are added as they are.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cols: list[Column] = []
    for target, (source, conv) in column_map.items():
        if source in types:
            cols.append(CONVERTERS[conv](F.col(source), types[source]).cast(TARGET_TYPES[conv]).alias(target))
        else:
            cols.append(F.lit(None).cast(TARGET_TYPES[conv]).alias(target))
    if with_raw_json:
        cols.append(raw_json(df).alias("raw_json"))
    return df.select(*cols, *extra)


def rejected_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows whose text timestamp does not parse (the reference would abort)."""
    return df.filter(F.col(column).isNotNull() & F.try_to_timestamp(F.col(column).cast("string")).isNull())
