"""JSONL record checks as column expressions over Spark's VARIANT type.

A line is routed to one of three outcomes, as Python's ``json.loads`` plus
a fingerprint over ``messages`` would route it:

* ``MALFORMED_JSON`` -- the line is not exactly one JSON value.
* ``STRUCTURAL_INVALID`` -- the value is not an object, or ``messages`` is
  present but not something whose items are all objects (an array of
  objects; ``[]``, ``{}`` and ``""`` count as empty).
* valid -- with a fingerprint of the message roles and contents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MALFORMED_JSON = "MALFORMED_JSON"
STRUCTURAL_INVALID = "STRUCTURAL_INVALID"
DUPLICATE = "DUPLICATE"
VALID = "VALID"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_strict(line: Column | str) -> Column:
    """VARIANT of a line that is exactly one JSON value, else NULL.

    ``try_parse_json`` alone ignores trailing text ("{..} x"). Wrapping the
    line as ``{"v": line}`` and as ``[line]`` and requiring both to parse
    rejects trailing text and lists of values; the value is read back from
    the object wrapper. NaN/Infinity are rejected (Python accepts them).
    Duplicate keys keep the last one when
    ``spark.sql.variant.allowDuplicateKeys`` is true, as Python does.
    """
    line = _col(line)
    wrapped = F.try_parse_json(F.concat(F.lit('{"v":'), line, F.lit("}")))
    listed = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]")))
    return F.when(listed.isNotNull(), F.try_variant_get(wrapped, "$.v", "variant"))


def _type(v: Column) -> Column:
    return F.schema_of_variant(v)


def _messages_parts(value: Column) -> tuple[Column, Column, Column]:
    """(messages sub-value, its type string, its items as array<variant>)."""
    m = F.try_variant_get(value, "$.messages", "variant")
    return m, _type(m), F.try_variant_get(m, "$", "array<variant>")


def _status(line: Column, value: Column, m: Column, mt: Column, items: Column) -> Column:
    """MALFORMED_JSON / STRUCTURAL_INVALID / VALID from the parsed parts.

    ``line`` is the stripped line; its first character tells whether the
    root is an object without walking the value. ``messages`` may be
    missing, an array of objects, or an empty object or string.
    """
    all_objects = F.forall(items, lambda x: x.isNotNull() & _type(x).startswith("OBJECT<"))
    ok = (
        F.when(~line.startswith("{"), F.lit(False))
        .when(m.isNull(), F.lit(True))
        .when(mt.startswith("ARRAY<"), F.coalesce(all_objects, F.lit(False)))
        .when(mt == "OBJECT<>", F.lit(True))
        .when(mt == "STRING", F.try_variant_get(m, "$", "string") == "")
        .otherwise(F.lit(False))
    )
    return F.when(value.isNull(), F.lit(MALFORMED_JSON)).when(~ok, F.lit(STRUCTURAL_INVALID)).otherwise(F.lit(VALID))


def _field_text(item: Column, field: str) -> Column:
    """Python ``str()`` of ``item.get(field)`` for strings, None and booleans.

    Other types print as compact JSON (Python would print its repr).
    """
    v = F.try_variant_get(item, f"$.{field}", "variant")
    t = _type(v)
    return (
        F.when(v.isNull() | (t == "VOID"), F.lit("None"))
        .when(t == "STRING", F.try_variant_get(v, "$", "string"))
        .when(t == "BOOLEAN", F.when(F.try_variant_get(v, "$", "boolean"), F.lit("True")).otherwise(F.lit("False")))
        .otherwise(F.to_json(v))
    )


def fingerprint(value: Column) -> Column:
    """``role:content||`` over the messages, concatenated ('' when absent)."""
    return _fingerprint_items(_messages_parts(value)[2])


def fingerprint_of(messages: Column | str, role: str = "role", content: str = "content") -> Column:
    """Fingerprint of a typed ``ARRAY<STRUCT<role, content>>`` column."""
    parts = F.transform(
        _col(messages),
        lambda m: F.concat(
            F.coalesce(m[role].cast("string"), F.lit("None")),
            F.lit(":"),
            F.coalesce(m[content].cast("string"), F.lit("None")),
            F.lit("||"),
        ),
    )
    return F.coalesce(F.array_join(parts, ""), F.lit(""))


def fingerprint_key(fp: Column | str) -> Column:
    """Fixed-size shuffle key for a fingerprint string (SHA-256, 64 hex)."""
    return F.sha2(_col(fp), 256)


def route(line: Column | str) -> tuple[Column, Column, Column]:
    """(status, value, fingerprint) for a stripped, non-blank line, as
    column expressions (see :func:`route_lines` for the staged form).

    status is MALFORMED_JSON, STRUCTURAL_INVALID or VALID (duplicates are
    decided later, across rows).
    """
    line = _col(line)
    value = parse_strict(line)
    m, mt, items = _messages_parts(value)
    status = _status(line, value, m, mt, items)
    fp = F.when(status == VALID, _fingerprint_items(items))
    return status, value, fp


def route_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """Add ``status`` and ``fp`` to a frame of stripped, non-blank lines.

    Same result as :func:`route`, staged so that each parse and each
    extraction of ``messages`` is computed once per row: a staged column
    that is not cheap and is used several times is kept as its own
    projection by Catalyst instead of being inlined into every use.
    """
    v, m = F.col("_dp_v"), F.col("_dp_m")
    staged = df.withColumn("_dp_v", parse_strict(line))
    staged = staged.withColumn("_dp_m", F.try_variant_get(v, "$.messages", "variant"))
    staged = staged.withColumn("_dp_mt", _type(m)).withColumn("_dp_items", F.try_variant_get(m, "$", "array<variant>"))
    mt, items = F.col("_dp_mt"), F.col("_dp_items")
    staged = staged.withColumn("status", _status(F.col(line), v, m, mt, items))
    fp = F.when(F.col("status") == VALID, _fingerprint_items(items))
    return staged.withColumn("fp", fp).drop("_dp_v", "_dp_m", "_dp_mt", "_dp_items")


def _fingerprint_items(items: Column) -> Column:
    parts = F.transform(
        items,
        lambda x: F.concat(_field_text(x, "role"), F.lit(":"), _field_text(x, "content"), F.lit("||")),
    )
    return F.coalesce(F.array_join(parts, ""), F.lit(""))
