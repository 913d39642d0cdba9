"""JSON text to rows and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def parse_typed(messages: DataFrame, schema: T.StructType, value: str = "value",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """One typed row per message: a missing number is 0, a missing text null.

    ``keep`` names columns of the message itself to carry along.
    """
    parsed = messages.select(*keep, F.from_json(value, schema).alias("_row"))
    out: list[Column] = [F.col(c) for c in keep]
    for f in schema.fields:
        c = F.col(f"_row.{f.name}")
        if isinstance(f.dataType, T.NumericType):
            c = F.coalesce(c, F.lit(0).cast(f.dataType))
        out.append(c.alias(f.name))
    return parsed.select(*out)


def field(value: Column, path: str, kind: str = "string") -> Column:
    """One field of a JSON text whose schema is not known; null when absent."""
    got = F.get_json_object(value, f"$.{path}")
    return got if kind == "string" else got.try_cast(kind)


def has_object(value: Column, name: str) -> Column:
    """True when the top-level field is there and not JSON null; ``{}`` counts."""
    return F.get_json_object(value, f"$.{name}").isNotNull()


def as_json(*cols: str | Column) -> Column:
    """The columns as one JSON object; null fields are left out."""
    return F.to_json(F.struct(*(cols or ("*",))))
