"""Flatten raw readings and apply the data-quality rules.

Order matters (``clean_readings``): invalid values go first, so a sentinel
can never win a dedup key over a good reading; the outlier flag is set
before dedup; dates are parsed after dedup, because the dedup key is the
raw timestamp string.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airloom.functions.timestamps import parse_utc
from airloom.functions.values import is_below_floor, is_sentinel, is_valid_value
from airloom.options import FlattenOptions, QualityRules
from airloom.schema import CURATED_COLUMNS

DEDUP_KEYS = ("location_id", "parameter", "date_utc")

# JSON texts that Python treats as false (the source falls back on them).
_FALSY_JSON = ("", "0", "0.0", "false", "[]", "{}", "null")


def _is_object(text: Column) -> Column:
    return F.coalesce(F.trim(text).startswith("{"), F.lit(False))


def _is_truthy(text: Column) -> Column:
    # Untrimmed: a whitespace-only string is a non-empty (true) value. A JSON
    # string "0" and the number 0 read alike as text; both count as false.
    return text.isNotNull() & ~text.isin(*_FALSY_JSON)


def _utc_of(text: Column) -> Column:
    return F.when(_is_object(text), F.get_json_object(text, "$.utc"))


def flat_columns(
    record_col: str = "record", opts: FlattenOptions = FlattenOptions(), raw_col: str | None = None
):
    """The flat-reading columns of a raw reading struct, as named Columns.

    ``raw_col`` is the record's VARIANT, which tells a missing key from an
    explicit null.
    """
    r = F.col(record_col)
    meta = r["location_meta"]
    if opts.profile == "canonical":
        location_id = r["locationsId"]
        dt = r["datetime"]
        date_utc = F.when(_is_object(dt), F.get_json_object(dt, "$.utc")).when(
            _is_truthy(dt), r["date_utc"]
        )
        unit = F.lit(opts.unit).cast("string")
    else:
        if raw_col is None:
            # Struct reading cannot tell a missing key from an explicit null, so
            # the fallback id is used whenever locationsId is null.
            location_id = F.coalesce(r["locationsId"], r["locationId"])
        else:
            key = F.try_variant_get(F.col(raw_col), "$.locationsId", "variant")
            location_id = F.when(key.isNotNull(), r["locationsId"]).otherwise(r["locationId"])
        source = F.when(_is_truthy(r["datetime"]), r["datetime"]).when(
            _is_truthy(r["date"]), r["date"]
        )
        date_utc = _utc_of(source)
        unit = r["unit"]
    return [
        location_id.alias("location_id"),
        meta["name"].alias("location_name"),
        meta["city"].alias("city"),
        meta["country"].alias("country"),
        F.lit(opts.parameter).alias("parameter"),
        r["value"].alias("value"),
        unit.alias("unit"),
        date_utc.alias("date_utc"),
    ]


def flatten_readings(
    df: DataFrame,
    record_col: str = "record",
    opts: FlattenOptions = FlattenOptions(),
    raw_col: str | None = None,
) -> DataFrame:
    """Flatten a column of raw reading structs (``schema.RAW_READING``).

    Every other column of ``df`` (file, position, partition date, ...) is
    kept. A null or missing ``location_meta`` gives null name/city/country.
    With ``raw_col`` (the record's VARIANT, consumed as well) the ``deployed``
    id falls back only where the key is missing, not where it is null.
    """
    others = [F.col(c) for c in df.columns if c not in (record_col, raw_col)]
    return df.select(*others, *flat_columns(record_col, opts, raw_col))


def drop_sentinels(df: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Drop readings equal to a sentinel. Null and NaN are not sentinels."""
    return df.where(~F.coalesce(is_sentinel("value", rules), F.lit(False)))


def drop_below_floor(df: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Keep ``value >= min_valid``; null and NaN fail the test and are dropped."""
    return df.where(~is_below_floor("value", rules))


def drop_invalid(df: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Sentinel and floor rules together."""
    return df.where(is_valid_value("value", rules))


def flag_outliers(df: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Add ``is_extreme_outlier = value > max_plausible``; rows are kept."""
    return df.withColumn(
        "is_extreme_outlier", F.col("value") > F.lit(float(rules.max_plausible))
    )


def dedup_first(
    df: DataFrame, keys: Sequence[str], order_cols: Sequence[str | Column]
) -> DataFrame:
    """Keep the first row of each key in input order; null keys are equal.

    ``order_cols`` carry the input order (landed file, position in file).
    ``row_number() == 1`` is planned with a partial ``WindowGroupLimit``
    before the shuffle, so a key repeated many times (a hot station) sends
    at most one row per map task through the exchange.
    """
    if not order_cols:
        raise ValueError("keep-first dedup needs the columns that give input order")
    w = Window.partitionBy(*keys).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def parse_dates(df: DataFrame, col: str = "date_utc") -> DataFrame:
    """Parse the raw timestamp string per row and drop rows that do not parse."""
    return df.withColumn(col, parse_utc(col)).where(F.col(col).isNotNull())


def _scope_cols(df: DataFrame, rules: QualityRules, partition_cols: Sequence[str] | None):
    if partition_cols is not None:
        return list(partition_cols)
    if rules.dedup_scope == "partition" and "date" in df.columns:
        return ["date"]
    return []


def _order(df: DataFrame, scope: list[str], order_cols: Sequence[str | Column]):
    """Input order; across dates (global scope) the earlier landing day first."""
    if "date" in df.columns and "date" not in scope:
        return ["date", *order_cols]
    return list(order_cols)


def _dedup_keys(rules: QualityRules) -> list[str | Column]:
    if rules.dedup_key == "instant":
        return ["location_id", "parameter", parse_utc("date_utc")]
    return list(DEDUP_KEYS)


def clean_readings(
    flat: DataFrame,
    rules: QualityRules = QualityRules(),
    order_cols: Sequence[str | Column] = ("_file", "_pos"),
    partition_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Flat readings -> curated rows (``schema.CURATED`` + partition columns).

    ``partition_cols`` default to ``["date"]`` when the frame carries the raw
    partition date and ``rules.dedup_scope == "partition"``, so one job can
    curate many dates with the per-date semantics of a per-date run.
    """
    scope = _scope_cols(flat, rules, partition_cols)
    valid = flag_outliers(drop_invalid(flat, rules), rules)
    first = dedup_first(valid, [*scope, *_dedup_keys(rules)], _order(flat, scope, order_cols))
    parsed = parse_dates(first)
    # The landing date is kept whatever the dedup scope: the curated table is
    # partitioned by it (with global scope, the kept copy's landing date).
    keep = scope + (["date"] if "date" in flat.columns and "date" not in scope else [])
    return parsed.select(*CURATED_COLUMNS, *keep)


def cleaning_summary(
    flat: DataFrame,
    rules: QualityRules = QualityRules(),
    order_cols: Sequence[str | Column] = ("_file", "_pos"),
    partition_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Counts of every cleaning outcome as ``(measure, n)`` rows.

    Both counting conventions are present: ``invalid`` (sentinel or floor,
    one figure) and ``below_floor`` / ``sentinel`` with the floor tested
    first (so -1 counts as floor); ``flagged_kept`` is counted after dedup
    and date parsing, ``flagged_before_dedup`` before them. ``bad_date`` is
    the count the source log leaves out.

    One pass: valid rows are grouped by their dedup key, the others by their
    outcome alone (each task pre-aggregates both); the groups then hold all
    that the counts need.
    """
    scope = _scope_cols(flat, rules, partition_cols)
    below = is_below_floor("value", rules)
    sentinel = F.coalesce(is_sentinel("value", rules), F.lit(False))
    flagged = F.coalesce(F.col("value") > F.lit(float(rules.max_plausible)), F.lit(False))
    outcome = F.when(below, "below_floor").when(sentinel, "sentinel").otherwise("valid")
    keys = [F.col(k) if isinstance(k, str) else k for k in [*scope, *_dedup_keys(rules)]]
    order = [F.col(o) if isinstance(o, str) else o for o in _order(flat, scope, order_cols)]
    valid = F.col("_outcome") == "valid"
    rows = flat.select(
        outcome.alias("_outcome"),
        *(F.when(~below & ~sentinel, k).alias(f"_k{i}") for i, k in enumerate(keys)),
        flagged.alias("_flagged"),
        parse_utc("date_utc").isNotNull().alias("_parsed"),
        F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order))).alias("_order"),
    )
    groups = rows.groupBy("_outcome", *(f"_k{i}" for i in range(len(keys)))).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("_flagged").alias("nf"),
        # of the row that keep-first keeps; for the others it is not used
        F.min_by(F.struct("_flagged", "_parsed"), "_order").alias("first"),
    )
    ok = valid & F.col("first._parsed")

    def rows_of(condition: Column, n: str = "n") -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(n))), F.lit(0))

    measures = {
        "rows_in": rows_of(F.lit(True)),
        "below_floor": rows_of(F.col("_outcome") == "below_floor"),
        "sentinel": rows_of(F.col("_outcome") == "sentinel"),
        "invalid": rows_of(~valid),
        "flagged_before_dedup": rows_of(valid, "nf"),
        "duplicates": rows_of(valid) - F.count_if(valid),
        "bad_date": F.count_if(valid & ~F.col("first._parsed")),
        "rows_remaining": F.count_if(ok),
        "flagged_kept": F.count_if(ok & F.col("first._flagged")),
    }
    counts = groups.agg(*(c.cast("bigint").alias(n) for n, c in measures.items()))
    pairs = ", ".join(f"'{n}', {n}" for n in measures)
    return counts.selectExpr(f"stack({len(measures)}, {pairs}) AS (measure, n)")
