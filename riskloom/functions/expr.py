"""Column expressions and schema helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FRACTIONAL = (T.FloatType, T.DoubleType)
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)

# Output column -> (numerator, denominator).
DOMAIN_RATIOS = {
    "CREDIT_INCOME_PERCENT": ("AMT_CREDIT", "AMT_INCOME_TOTAL"),
    "ANNUITY_INCOME_PERCENT": ("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
    "CREDIT_TERM": ("AMT_ANNUITY", "AMT_CREDIT"),
    "DAYS_EMPLOYED_PERCENT": ("DAYS_EMPLOYED", "DAYS_BIRTH"),
}


def normalise_missing(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL on every fractional column, so NULL is the only missing value."""
    out = []
    for field in df.schema.fields:
        c = F.col(_quoted(field.name))
        if isinstance(field.dataType, _FRACTIONAL):
            c = F.when(~F.isnan(c), c).alias(field.name)
        out.append(c)
    return df.select(*out)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(_quoted(name))


def ratio(num: Column, den: Column, on_zero: str = "null") -> Column:
    """``num / den``. A zero denominator gives NULL, or +-inf / NaN with ``on_zero='inf'``."""
    num, den = num.cast("double"), den.cast("double")
    safe = F.try_divide(num, den)
    if on_zero == "null":
        return safe
    if on_zero != "inf":
        raise ValueError("on_zero must be 'null' or 'inf'")
    overflow = (
        F.when(num > 0, F.lit(float("inf"))).when(num < 0, F.lit(float("-inf"))).when(num == 0, F.lit(float("nan")))
    )
    return F.when(den == 0, overflow).otherwise(safe)


def add_ratios(
    df: DataFrame, ratios: Mapping[str, tuple[str, str]] = DOMAIN_RATIOS, on_zero: str = "null"
) -> DataFrame:
    """Add one ratio column per entry; the input columns are kept."""
    return df.withColumns({out: ratio(col(num), col(den), on_zero) for out, (num, den) in ratios.items()})


def drop_existing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the listed columns; absent ones are ignored."""
    return df.drop(*[n for n in names if n in df.columns])


def columns_of_kind(df: DataFrame, kind: str = "numeric") -> list[str]:
    """Column names by type: ``numeric`` (any number), ``strict`` (long/double) or ``categorical``."""
    if kind == "numeric":
        wanted: tuple = _NUMERIC
    elif kind == "strict":
        wanted = (T.LongType, T.DoubleType)
    elif kind == "categorical":
        wanted = (T.StringType,)
    else:
        raise ValueError(f"unknown kind {kind!r}")
    return [f.name for f in df.schema.fields if isinstance(f.dataType, wanted)]


def align_common(left: DataFrame, right: DataFrame, drop: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Both frames on their shared columns, in the left frame's order."""
    names = [c for c in left.columns if c in set(right.columns) and c not in set(drop)]
    return left.select(*map(col, names)), right.select(*map(col, names))


def drop_missing(df: DataFrame, column: str) -> DataFrame:
    return df.where(col(column).isNotNull())


def decide(probability: Column, threshold: float | Column) -> Column:
    """1 at or above the threshold, else 0; a missing probability reaches none."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.coalesce(probability >= limit, F.lit(False)).cast("int")


def decision_label(probability: Column, threshold: float | Column) -> Column:
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.when(probability >= limit, "REJECTED").otherwise("ACCEPTED")


def drift_status(p_value: Column, alpha: float = 0.05) -> Column:
    """Missing or NaN is inconclusive; NaN is tested first because it sorts above any number."""
    return (
        F.when(p_value.isNull() | F.isnan(p_value), "inconclusive")
        .when(p_value < alpha, "drift")
        .otherwise("no_drift")
    )


def feature_label(name: Column, value: Column) -> Column:
    """Readable label of a preprocessed feature (``num__x``, ``ind__x_origin``, ``cat__x_level``)."""
    is_on = F.abs(value - F.lit(1.0)) < 1e-3
    bare = F.regexp_replace(name, r"^(cat__|num__|ind__)", "")
    cut = F.length(bare) - F.length(F.substring_index(bare, "_", -1))
    split = F.when(cut > 0, F.concat(F.substring(bare, F.lit(1), cut - 1), F.lit(": "), F.substring_index(bare, "_", -1)))
    number = F.concat(F.format_string("%.2f", value.cast("double")), F.lit(" | "), bare)
    return (
        F.when(
            name.startswith("cat__"),
            F.when(is_on, F.concat(F.lit("YES | "), F.coalesce(split, bare))).otherwise(F.concat(F.lit("NO | "), bare)),
        )
        .when(
            name.startswith("ind__"),
            F.concat(
                F.when(is_on, "PRESENT").otherwise("MISSING"), F.lit(" | "), F.regexp_replace(bare, "_origin", "")
            ),
        )
        .otherwise(number)
    )


def unpivot_numeric(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form ``(keep..., feature, value double)``; a generator inside the scan stage, no shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), col(c).cast("double").alias("value")) for c in columns])
    return df.select(*map(col, keep), F.inline(pairs))


def top_n(df: DataFrame, by: str, n: int, tie: str) -> DataFrame:
    """The ``n`` largest rows by ``by``; ties are broken by name so the result is stable."""
    return df.orderBy(F.col(by).desc_nulls_last(), F.col(tie)).limit(n)
