"""Record shapes and the canonical form every operator works on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as t

_TURN = t.ArrayType(t.StructType([t.StructField("from", t.StringType()), t.StructField("value", t.StringType())]))
_MESSAGE = t.ArrayType(t.StructType([t.StructField("role", t.StringType()), t.StructField("content", t.StringType())]))

_STRINGS = (
    "id conversation_id uuid system system_prompt instruction input output prompt answer response completion ground_truth question user_prompt text content passage "
    "response_chosen response_rejected chosen rejected chosen_prompt rejected_prompt lang _source_paragraph"
).split()

#: Every field that some record shape has.
SUPERSET = t.StructType(
    [t.StructField(n, t.StringType()) for n in _STRINGS]
    + [t.StructField("conversations", _TURN), t.StructField("messages", _MESSAGE), t.StructField("history", t.ArrayType(t.ArrayType(t.StringType())))]
    + [t.StructField("deita_score", t.DoubleType()), t.StructField("rw_score", t.DoubleType())]
)


def field(df: DataFrame, name: str) -> Column:
    """A column, or a typed null where the frame has none."""
    if name in df.columns:
        return F.col(name)
    kind = SUPERSET[name].dataType if name in SUPERSET.names else t.StringType()
    return F.lit(None).cast(kind)


def either(*columns: Column) -> Column:
    """The first column that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def values_of(turns: Column, role: str) -> Column:
    return F.transform(F.filter(turns, lambda m: m["from"] == role), lambda m: F.coalesce(m["value"], F.lit("")))


def first_value(turns: Column, role: str) -> Column:
    return F.coalesce(F.get(values_of(turns, role), F.lit(0)), F.lit(""))
