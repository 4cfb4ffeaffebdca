"""Build nested structs of a fixed schema from a few given fields (rest typed nulls)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed_null(dtype: T.DataType) -> Column:
    return F.lit(None).cast(dtype)


def build_struct(schema: T.StructType, **values) -> Column:
    """``struct`` with every field of ``schema`` in order; missing fields are typed nulls.

    Given values that are themselves structs of a sub-schema are cast to the declared
    field type so the result always has exactly ``schema``.
    """
    unknown = set(values) - set(schema.fieldNames())
    if unknown:
        raise ValueError(f"unknown fields {sorted(unknown)} for {schema.simpleString()[:80]}")
    cols = []
    for f in schema.fields:
        v = values.get(f.name)
        if v is None:
            cols.append(typed_null(f.dataType).alias(f.name))
        else:
            if not isinstance(v, Column):
                v = F.lit(v)
            cols.append(v.cast(f.dataType).alias(f.name))
    return F.struct(*cols)
