"""Entity lookup, JSON records and what-if scenarios, as batch jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.expr import add_ratios, col
from riskloom.functions.session import small_table


def lookup_entities(requests: DataFrame, first: DataFrame, second: DataFrame, id_col: str) -> DataFrame:
    """One row per requested id: the row of ``first`` if any, else of ``second``, as a whole row.

    ``found_in`` is 'train', 'test' or NULL. Columns missing on one side are NULL there. The requested
    ids are counted first; few are broadcast, so the tables are only scanned. The preference is
    decided per id on the rows that match a request, so only those are shuffled.
    """
    names = list(dict.fromkeys([c for c in [*first.columns, *second.columns] if c != id_col]))

    def shaped(df: DataFrame, source: str, rank: int) -> DataFrame:
        kept = [col(c) if c in df.columns else F.lit(None).alias(c) for c in names]
        return df.select(col(id_col), *kept, F.lit(source).alias("found_in"), F.lit(rank).alias("_rank"))

    both = shaped(first, "train", 0).unionByName(shaped(second, "test", 1))
    wanted = small_table(requests.select(col(id_col)).distinct())
    hits = both.join(wanted, id_col, "left_semi")
    whole_row = F.struct("_rank", "found_in", *map(col, names))
    best = hits.groupBy(id_col).agg(F.min_by(whole_row, F.col("_rank")).alias("r"))
    return wanted.join(best, id_col, "left").select(
        id_col, *[F.col("r").getField(c).alias(c) for c in names], F.col("r").getField("found_in").alias("found_in")
    )


def to_json_records(df: DataFrame, id_col: str) -> DataFrame:
    """``(id, record)`` with every column kept; missing values become JSON null."""
    return df.select(col(id_col), F.to_json(F.struct(*map(col, df.columns)), {"ignoreNullFields": "false"}).alias("record"))


def build_scenarios(
    overrides: DataFrame,
    template: DataFrame,
    base: DataFrame | None = None,
    base_id: str | None = None,
    with_ratios: bool = True,
    ratios: dict | None = None,
) -> DataFrame:
    """Wide what-if rows from ``(scenario_id, feature, value string)`` overrides.

    Only columns of ``template``'s schema are used; unknown features are ignored and unspecified
    ones are NULL, or the value of the scenario's ``base`` row when a base is given (its
    ``base_id`` column holds the scenario id).
    """
    fields = {f.name: f.dataType for f in template.schema.fields}
    known = [c for c in fields if c != "scenario_id"]
    wide = overrides.groupBy("scenario_id").agg(
        *[
            F.max(F.when(F.col("feature") == c, F.col("value"))).try_cast(fields[c]).alias(c)
            for c in known
        ],
        F.collect_set(F.when(F.col("feature").isin(known), F.col("feature"))).alias("_given"),
    )
    if base is not None:
        kept = base.select(col(base_id).alias("scenario_id"), *[col(c).alias(f"_b_{c}") for c in known if c in base.columns])
        wide = wide.join(kept, "scenario_id", "left")
        wide = wide.select(
            "scenario_id",
            *[
                F.when(F.array_contains("_given", c), col(c)).otherwise(col(f"_b_{c}")).alias(c)
                if c in base.columns
                else col(c)
                for c in known
            ],
        )
    else:
        wide = wide.drop("_given")
    if not with_ratios:
        return wide
    return add_ratios(wide, ratios) if ratios else add_ratios(wide)


def form_overrides(forms: DataFrame) -> DataFrame:
    """Overrides of the short application form.

    ``forms`` is ``(scenario_id, feature, value string)`` with helper fields ``AGE_YEARS`` and
    ``EMPLOYED_YEARS``. They become negative day counts; the constants below are added.
    """
    # Constants the form sends with every request.
    constants = {
        "SK_ID_CURR": "999999",
        "CNT_CHILDREN": "0",
        "NAME_CONTRACT_TYPE": "Cash loans",
        "FLAG_OWN_CAR": "N",
        "FLAG_OWN_REALTY": "Y",
    }
    years = {"AGE_YEARS": "DAYS_BIRTH", "EMPLOYED_YEARS": "DAYS_EMPLOYED"}
    renamed = F.col("feature")
    for helper, out in years.items():
        renamed = F.when(F.col("feature") == helper, out).otherwise(renamed)
    is_years = F.col("feature").isin(list(years))
    number = F.col("value").try_cast("double")
    days = F.when(number != 0, (-F.abs(number * 365.25)).cast("string"))
    # A helper field wins over a directly given day count; constants win over anything given.
    given = forms.where(~F.col("feature").isin([*constants, *years.values()]))
    given = given.select(
        "scenario_id", renamed.alias("feature"), F.when(is_years, days).otherwise(F.col("value")).alias("value")
    )
    extra = forms.select("scenario_id").distinct().select(
        "scenario_id",
        F.inline(F.array(*[F.struct(F.lit(k).alias("feature"), F.lit(v).alias("value")) for k, v in constants.items()])),
    )
    return given.unionByName(extra)


def select_ids(df: DataFrame, id_col: str, ids: Sequence) -> DataFrame:
    """Rows of a short id list; the predicate is pushed down to the Parquet scan."""
    return df.where(col(id_col).isin(list(ids)))
