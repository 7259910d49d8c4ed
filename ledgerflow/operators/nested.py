"""Nested data.

Flattening walks the *schema* on the driver (no data) and emits one ``select``. Ordered lists are
made in chunks of consecutive items, numbered by ``grouped_row_index`` (which splits a hot group
over several tasks); what a chunk becomes (CSV lines, JSON) is made for each chunk, and
``one_document`` puts a group's chunks together at the end.
"""

from __future__ import annotations

import re
from collections import OrderedDict
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.scalar import base64_text, csv_field
from ledgerflow.operators.ordinal import grouped_row_index


def flatten_one_level(df: DataFrame) -> DataFrame:
    """Struct fields move to the top level (the struct's own name vanishes); a list of
    structs contributes the fields of its first element only (an empty list gives nulls); one
    level only. On a name clash the later value wins but the name keeps its first position."""
    out: OrderedDict[str, Column] = OrderedDict()
    for field in df.schema.fields:
        dt = field.dataType
        c = F.col(f"`{field.name}`")
        if isinstance(dt, T.StructType):
            for sub in dt.fields:
                out[sub.name] = c[sub.name]
        elif isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.StructType):
            first = F.get(c, 0)
            for sub in dt.elementType.fields:
                out[sub.name] = first[sub.name]
        else:
            out[field.name] = c
    return df.select(*[col.alias(name) for name, col in out.items()])


def explode_children(df: DataFrame, parent_key: str, children: str,
                     rename: Mapping[str, str] | None = None) -> DataFrame:
    """One row per child with the parent key in front; parents without children (null or
    empty list) vanish; a child field named like the key overrides the parent's key."""
    child_fields = [f.name for f in df.schema[children].dataType.elementType.fields]
    lead = [] if parent_key in child_fields else [F.col(parent_key)]
    out = df.select(*lead, F.inline(F.col(children)))
    if rename:
        out = out.withColumnsRenamed({k: v for k, v in rename.items() if k in out.columns})
    return out


def ordered_chunks(df: DataFrame, group: Sequence[str], order: Sequence[str], items: Sequence[str | Column],
                   name: str = "items", chunk_items: int = 1000) -> DataFrame:
    """Rows -> ``(group..., chunk, name ARRAY<STRUCT<items>>)``: each group's items in ``order``
    (null order values last), in chunks of ``chunk_items``, so that a group of any size is spread over
    many rows. Chunks of a group in the order of ``chunk`` are the whole list. Rows tied in ``order``
    are placed by their items."""
    item_cols = [F.col(c) if isinstance(c, str) else c for c in items]
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    slim = df.select(*[F.col(g) for g in group], F.struct(*item_cols).alias("_item"),
                     *[e for i, c in enumerate(order_cols) for e in (c.isNull().alias(f"_null{i}"), c.alias(f"_o{i}"))],
                     F.to_json(F.struct(*item_cols)).alias("_tie"))
    keys = [k for i in range(len(order_cols)) for k in (f"_null{i}", f"_o{i}")]
    numbered = grouped_row_index(slim, group, keys, start=0, name="_rn", ties=["_tie"])
    numbered = numbered.withColumn("chunk", F.floor(F.col("_rn") / F.lit(chunk_items)).cast("bigint"))
    agg = numbered.groupBy(*group, "chunk").agg(F.array_sort(F.collect_list(F.struct(F.col("_rn"), F.col("_item")))).alias("_l"))
    return agg.select(*group, "chunk", F.transform("_l", lambda x: x["_item"]).alias(name))


def one_document(chunks: DataFrame, group: Sequence[str], text: Column, count: Column, head: str = "", tail: str = "",
                 sep: str = "") -> DataFrame:
    """``(group..., n_items, document)``: the texts of a group's chunks, in order, as one document.
    The document itself is one value (a message, a file), so it must fit a row; all that makes it is
    done chunk by chunk."""
    parts = chunks.select(*group, "chunk", text.alias("_text"), count.cast("bigint").alias("_n"))
    whole = parts.groupBy(*group).agg(F.sum("_n").alias("n_items"), F.array_sort(F.collect_list(F.struct("chunk", "_text"))).alias("_l"))
    body = F.array_join(F.transform("_l", lambda x: x["_text"]), sep)
    return whole.select(*group, "n_items", F.concat(F.lit(head), body, F.lit(tail)).alias("document"))


def ordered_document(df: DataFrame, group: Sequence[str], order: Sequence[str], line: Column, head: str = "", tail: str = "",
                     sep: str = "") -> DataFrame:
    """T2 + N6: ``(group..., n_items, document)``: each group's lines in ``order`` (null order values
    last, ties by the line) as one document. Lines are dealt to ranges of (group, order), so that a
    group of any size, equal rows included, is sorted and joined by many tasks; only its pieces of
    text meet at the end, in the one value that the document is."""
    flags = [e for i, c in enumerate(order) for e in (F.col(c).isNull().alias(f"_null{i}"), F.col(c).alias(f"_o{i}"))]
    keys = [f"_{k}{i}" for i in range(len(order)) for k in ("null", "o")]
    slim = df.select(*group, *flags, line.alias("_line"), F.monotonically_increasing_id().alias("_n"))
    ranged = slim.repartitionByRange(*group, *keys, "_line", "_n").withColumn("_range", F.spark_partition_id())
    pieces = ranged.groupBy(*group, "_range").agg(F.array_sort(F.collect_list(F.struct(*keys, "_line"))).alias("_l"))
    pieces = pieces.select(*group, F.size("_l").cast("bigint").alias("_n"), F.struct("_range", F.array_join(F.transform("_l", lambda x: x["_line"]), sep).alias("_text")).alias("_piece"))
    whole = pieces.groupBy(*group).agg(F.sum("_n").alias("n_items"), F.array_sort(F.collect_list("_piece")).alias("_l"))
    body = F.array_join(F.transform("_l", lambda x: x["_text"]), sep)
    return whole.select(*group, "n_items", F.concat(F.lit(head), body, F.lit(tail)).alias("document"))


def union_of_keys(records: DataFrame, column: str = "value") -> DataFrame:
    """JSON objects (text) with differing keys -> one column for each key that occurs in any of
    them, by name; a record without the key has null there.

    Types come from all records: one aggregate merges the records' schemas, in the tasks first, into
    one. Whole numbers are bigint, other numbers double; a key whose values differ in kind, or are
    lists or objects, is text (JSON); one that is always null is text. A record that isn't an object
    is an error; null and ``null`` give a row of nulls."""
    variant = records.select(F.parse_json(F.col(column)).alias("v"))
    kind = F.schema_of_variant("v")
    wrong = F.col("v").isNotNull() & ~kind.startswith("OBJECT") & (kind != "VOID")
    variant = variant.select(F.when(wrong, F.raise_error(F.concat(F.lit("not an object: "), kind)).cast("variant")).otherwise(F.col("v")).alias("v"))
    merged = variant.agg(F.schema_of_variant_agg("v").alias("s")).first()["s"]
    # the names of objects' fields are quoted where they need it
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], merged)
    schema = T._parse_datatype_string(ddl)
    fields = sorted(schema.fields, key=lambda f: f.name) if isinstance(schema, T.StructType) else []

    def of(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.DecimalType):
            kind = "bigint" if f.dataType.scale == 0 and f.dataType.precision <= 18 else "double"
        else:
            kind = f.dataType.simpleString() if isinstance(f.dataType, (T.LongType, T.DoubleType, T.BooleanType)) else "string"
        if '"' in f.name:  # a path can't hold it
            value = F.try_element_at(F.variant_get("v", "$", "map<string,variant>"), F.lit(f.name))
            return F.variant_get(value, "$", kind).alias(f.name)
        return F.variant_get("v", f'$["{f.name}"]', kind).alias(f.name)

    return variant.select(*[of(f) for f in fields])


def as_objects(arr: str | Column, field: str) -> Column:
    """List of scalars -> list of one-field objects."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.transform(a, lambda e: F.struct(e.alias(field)))


def join_text(arr: str | Column, sep: str = ",") -> Column:
    """List of strings -> one string."""
    return F.array_join(F.col(arr) if isinstance(arr, str) else arr, sep)


def list_size(arr: str | Column) -> Column:
    """Size of a list; a null list is an error, as ``len(None)`` is."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.when(a.isNull(), F.raise_error(F.lit("list is null"))).otherwise(F.size(a))


def csv_row(fields: Sequence[str | Column]) -> Column:
    """A row as one CSV line, with its line break."""
    return F.concat(F.concat_ws(",", *[csv_field(F.col(f) if isinstance(f, str) else f) for f in fields]), F.lit("\n"))


def csv_lines(arr: str | Column, fields: Sequence[str]) -> Column:
    """One CSV line, with its line break, per list item in list order."""
    a = F.col(arr) if isinstance(arr, str) else arr
    lines = F.transform(a, lambda x: F.concat(F.concat_ws(",", *[csv_field(x[f]) for f in fields]), F.lit("\n")))
    return F.array_join(lines, "")


def csv_base64(document: str | Column) -> Column:
    """N6 + F16: a CSV document, UTF-8, base64 on one line."""
    return base64_text(F.col(document) if isinstance(document, str) else document)
