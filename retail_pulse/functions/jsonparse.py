"""JSON string -> typed rows, with a quarantine for what does not parse.

A malformed message must not fail the micro-batch: rows whose JSON does not
parse (or whose numeric fields do not cast) are split off into a quarantine
DataFrame with the raw value and a reason, and the good rows go on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CORRUPT = "_corrupt_record"


def parse_json_column(df: DataFrame, schema: T.StructType, casts: dict[str, str] | None = None,
                      value_col: str = "value", keep: list[str] | None = None, required: list[str] | None = None,
                      checks: dict[str, Column] | None = None) -> DataFrame:
    """Parse ``value_col`` with an all-STRING ``schema`` and ``try_cast`` typed fields.

    Adds ``_parse_ok`` (JSON object parsed and every declared cast succeeded
    where text was present) and ``_reject_reason``. ``keep`` lists input
    columns carried through (e.g. a Kafka offset or a batch id). ``required``
    fields must not be NULL (reason ``missing_<field>``); ``checks`` maps further reasons to conditions on
    the typed fields that must hold (NULL counts as not holding).

    The parsed row leaves through ``inline(array(struct(..)))`` (a Generate):
    Catalyst cannot push a filter on generated columns below it, so a later
    ``where(_parse_ok)`` does not copy ``from_json`` into the filter and the
    parser runs once per message instead of once per reference.
    """
    casts = casts or {}
    keep = keep or []
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(value_col), with_corrupt,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    out = df.select(*keep, F.col(value_col).alias("_raw"), parsed.alias("_r"))
    cols = []
    bad_cast = F.lit(False)
    for f in schema.fields:
        raw = F.col(f"_r.{f.name}")
        if f.name in casts:
            typed = raw.try_cast(casts[f.name])
            bad_cast = bad_cast | (raw.isNotNull() & typed.isNull())
            cols.append(typed.alias(f.name))
        else:
            cols.append(raw.alias(f.name))
    not_json = F.col("_r").isNull() | F.col(f"_r.{_CORRUPT}").isNotNull()
    reason = F.when(not_json, F.lit("malformed_json")).when(bad_cast, F.lit("bad_number"))
    row = F.struct(*[F.col(k) for k in keep], F.col("_raw"), *cols, reason.alias("_reject_reason"))
    out = out.select(F.inline(F.array(row)))
    more = F.col("_reject_reason")
    for name in required or []:
        more = F.coalesce(more, F.when(F.col(name).isNull(), F.lit(f"missing_{name}")))
    for name, holds in (checks or {}).items():
        more = F.coalesce(more, F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)))
    return out.withColumn("_reject_reason", more).withColumn("_parse_ok", F.col("_reject_reason").isNull())


def split_quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without bookkeeping columns, quarantine rows ``_raw``/``_reject_reason``)."""
    good = parsed.where(F.col("_parse_ok")).drop("_raw", "_reject_reason", "_parse_ok")
    bad = parsed.where(~F.col("_parse_ok")).select("_raw", "_reject_reason")
    return good, bad


def parse_records(df: DataFrame, schema: T.StructType, casts: dict[str, str] | None = None,
                  value_col: str = "value", keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Convenience: ``parse_json_column`` then ``split_quarantine``."""
    return split_quarantine(parse_json_column(df, schema, casts, value_col, keep))


def to_json_messages(df: DataFrame, cols: list[str] | None = None, value_col: str = "value") -> DataFrame:
    """One JSON message per row (``value`` column), NULL fields omitted."""
    cols = cols or df.columns
    return df.select(F.to_json(F.struct(*[F.col(c) for c in cols])).alias(value_col))
