"""Entity queries: key lookups, composite filters, name search, parent/child
assembly and the documented joins (F1-F3, J1-J4, A4, A10, T3, T4, T9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_keys(df: DataFrame, key_col: str, keys: Sequence | DataFrame) -> DataFrame:
    """rows whose key is in ``keys``.

    A literal key list becomes an ``IN`` filter that reaches the parquet scan
    (row-group skipping).  A key DataFrame is semi-joined; the planner picks
    the join from the sizes it meets at run time.
    """
    if not isinstance(keys, DataFrame):
        return df.filter(F.col(key_col).isin(list(keys)))
    k = keys.select(F.col(keys.columns[0]).alias("_k")).distinct()
    return df.join(k, F.col(key_col) == F.col("_k"), "left_semi")


def filter_composite(df: DataFrame, **equals) -> DataFrame:
    """all ``column == value`` conditions (pushed to the scan)."""
    cond: Column = F.lit(True)
    for c, v in equals.items():
        cond = cond & (F.col(c) == F.lit(v))
    return df.filter(cond)


def ilike_any(df: DataFrame, columns: Sequence[str], text: str) -> Column:
    """F3 predicate: ``c ILIKE '%text%'`` for any column.  ``%``/``_`` in the
    input act as wildcards, as in the reference; a backslash stands for
    itself."""
    pattern = "%" + text.replace("\\", "\\\\") + "%"
    cond: Column = F.lit(False)
    for c in columns:
        cond = cond | F.coalesce(F.col(c).ilike(pattern), F.lit(False))
    return cond


def ilike_search(df: DataFrame, id_col: str, columns: Sequence[str], text: str,
                 limit: int = 20, offset: int = 0) -> DataFrame:
    """F3 + T3: matching rows, ordered by id (the reference leaves order
    undefined), then offset/limit."""
    out = df.filter(ilike_any(df, columns, text)).orderBy(F.col(id_col).asc_nulls_last())
    if offset:
        out = out.offset(offset)
    return out.limit(limit)


def left_join_metadata(children: DataFrame, parents: DataFrame, child_key: str,
                       parent_key: str) -> DataFrame:
    """Every child row, parent columns when a parent exists.  The planner
    (AQE) picks broadcast only from runtime sizes."""
    return children.join(parents, children[child_key] == parents[parent_key], "left")


def ordered_text_agg(children: DataFrame, key: str, order_cols: Sequence[str],
                     text_col: str, sep: str = "\n") -> DataFrame:
    """A4: ``string_agg(text, sep ORDER BY order_cols)`` per key, NULLs last in
    the ordering, NULL texts skipped.  One document's pages form one value:
    the group is one entity, bounded by that entity's size."""
    entries = F.struct(
        *[F.col(c).isNull().alias(f"_n{i}") for i, c in enumerate(order_cols)],
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)],
        F.col(text_col).alias("_t"),
    )
    # sort key: (is_null, value) per column gives NULLS LAST
    ordered = F.sort_array(F.collect_list(_reorder(entries, len(order_cols))))
    return children.groupBy(key).agg(
        F.array_join(F.transform(ordered, lambda e: e["_t"]), sep).alias("full_text"),
        F.count(F.lit(1)).alias("n_parts"),
    )


def _reorder(entries: Column, n: int) -> Column:
    fields = []
    for i in range(n):
        fields.append(entries[f"_n{i}"].alias(f"a{i}"))
        fields.append(entries[f"_o{i}"].alias(f"b{i}"))
    fields.append(entries["_t"].alias("_t"))
    return F.struct(*fields)


def assemble_children(parents: DataFrame, children: DataFrame, parent_key: str,
                      child_key: str, order_cols: Sequence[str],
                      child_cols: Sequence[str], out_col: str = "children") -> DataFrame:
    """J4 + T4: each parent with the array of its children ordered by
    ``order_cols`` (NULLS LAST); no children -> empty array; children without
    a parent are dropped.

    Children are aggregated per key *before* the join, so the join meets one
    row per parent.  Meant for a set of parents (a lookup result) or for
    bounded families; the flat alternative is :func:`children_rows`.
    """
    # one struct per child: (is-null flag, value) per ordering column - NULLS
    # LAST under sort_array - then the remaining child columns; every column
    # travels once
    fields = []
    for i, c in enumerate(order_cols):
        fields.append(F.col(c).isNull().alias(f"_n{i}"))
        fields.append(F.col(c).alias(c))
    fields += [F.col(c).alias(c) for c in child_cols if c not in order_cols]
    grouped = children.groupBy(F.col(child_key).alias("_pk")).agg(
        F.sort_array(F.collect_list(F.struct(*fields))).alias("_kids")
    )
    payload_type = children.select(F.struct(*[F.col(c) for c in child_cols])).schema[0].dataType.simpleString()
    joined = parents.join(grouped, parents[parent_key] == grouped["_pk"], "left")
    return joined.withColumn(
        out_col,
        F.coalesce(F.transform(F.col("_kids"), lambda e: F.struct(*[e[c].alias(c) for c in child_cols])),
                   F.array().cast(f"array<{payload_type}>")),
    ).drop("_pk", "_kids")


def children_rows(parents: DataFrame, children: DataFrame, parent_key: str,
                  child_key: str, order_cols: Sequence[str]) -> DataFrame:
    """Flat form of J4: parent columns repeated per child, sorted within
    partitions by (parent key, order) - streams, no per-parent array."""
    joined = parents.join(children, parents[parent_key] == children[child_key], "inner")
    return joined.sortWithinPartitions(parent_key, *[F.col(c).asc_nulls_last() for c in order_cols])
