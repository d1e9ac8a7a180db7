"""Statistics of a typed panel: overviews, trends, changes, correlations, linear fits.

Every operator is one aggregation with partial sums (or two of them), so a group that holds most
of the rows is reduced before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmill.functions.numeric import complete, corr3, mean_dec, round_dec, single_value
from panelmill.functions.text import blank_to_null
from panelmill.operators.profile import distinct_count
from panelmill.operators.validate import sum_counts


def baseline(df: DataFrame, id_column: str, text_keys: dict[str, str], null_counts: dict[str, str]) -> DataFrame:
    """Rows, distinct ids, distinct trimmed text keys, NULL counts in one row.

    ``text_keys`` and ``null_counts`` map output names to columns.
    """
    names = ["raw_row_count", "unique_raw_ids", *text_keys, *null_counts]
    frames = [distinct_count(df, [id_column], "unique_raw_ids", "raw_row_count")]
    frames += [distinct_count(df, [blank_to_null(c)], name) for name, c in text_keys.items()]
    if null_counts:
        frames.append(df.agg(*[F.count_if(F.col(c).isNull()).alias(name) for name, c in null_counts.items()]))
    return sum_counts(*frames).select(*names)


def overview(df: DataFrame, key: str, period: str, indicators: list[str]) -> DataFrame:
    """Record, entity and period counts with the share of complete records."""
    flag = complete(indicators)
    rows = F.count("*")
    return df.agg(
        rows.alias("total_records"),
        F.count_distinct(key).alias("entities"),
        F.min(period).alias("first_year"),
        F.max(period).alias("last_year"),
        F.count_if(flag).alias("complete_records"),
        F.count_if(~flag).alias("incomplete_records"),
        F.round(
            F.count_if(flag).cast("decimal(38,10)") * 100 / F.nullif(rows, F.lit(0)), 2
        ).alias("completeness_pct"),
    )


def group_means(
    df: DataFrame, keys: list[str], means: dict[str, Column], count_name: str | None = None
) -> DataFrame:
    """Rows and prepared means per group."""
    aggregates = [m.alias(name) for name, m in means.items()]
    if count_name:
        aggregates.insert(0, F.count("*").alias(count_name))
    return df.groupBy(*keys).agg(*aggregates)


def trend(df: DataFrame, period: str, columns: list[str], millions: list[str] = ()) -> DataFrame:
    """Per period: record count, two-digit means, and means in millions for large measures."""
    means = {f"avg_{c}": mean_dec(c, 2) for c in columns}
    means |= {f"avg_{c}_millions": mean_dec(c, 2, divisor=1_000_000) for c in millions}
    return group_means(df, [period], means, "records").orderBy(period)


def compare_groups(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """Per group means, highest first mean on top (NULL first, as in a plain descending order)."""
    means = {f"avg_{c}": mean_dec(c, 2) for c in columns}
    out = group_means(df, [group], means, "records")
    return out.orderBy(F.desc_nulls_first(f"avg_{columns[0]}"), group)


def correlations(df: DataFrame, y: str, xs: dict[str, str]) -> DataFrame:
    """One row: correlation of ``y`` with every x, pairs with NULL dropped one by one."""
    return df.agg(*[corr3(y, x).alias(name) for name, x in xs.items()])


def paired_correlation(df: DataFrame, x: str, y: str, by: list[str] = ()) -> DataFrame:
    """Number of complete pairs and their correlation, over all rows or per group."""
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    aggregates = [F.count("*").alias("paired_observations"), corr3(x, y).alias("correlation")]
    return pairs.groupBy(*by).agg(*aggregates) if by else pairs.agg(*aggregates)


def endpoint_change(
    df: DataFrame, key: str, period: str, start: int, end: int, columns: list[str], carry: list[str] = ()
) -> DataFrame:
    """``end`` minus ``start`` value per entity that has both, for a unique (key, period).

    One pass with one shuffle instead of a self join: the two periods are filtered at the scan and
    every entity has at most two rows left.  ``carry`` columns come from the start record.
    """
    at = {p: F.col(period) == p for p in (start, end)}

    def pick(c: str, p: int) -> Column:
        return F.max(F.when(at[p], F.col(c)))

    both = df.where(F.col(period).isin(start, end)).groupBy(key).agg(
        F.count_if(at[start]).alias("_starts"),
        F.count_if(at[end]).alias("_ends"),
        *[pick(c, start).alias(c) for c in carry],
        *[pick(c, start).alias(f"{c}_start") for c in columns],
        *[pick(c, end).alias(f"{c}_end") for c in columns],
    )
    return both.where("_starts > 0 AND _ends > 0").select(
        key,
        *carry,
        *[f"{c}_start" for c in columns],
        *[f"{c}_end" for c in columns],
        *[(F.col(f"{c}_end") - F.col(f"{c}_start")).alias(f"{c}_change") for c in columns],
    )


def change_correlations(changes: DataFrame, y: str, xs: dict[str, str]) -> DataFrame:
    """Correlations between changes; ``changes`` as given by :func:`endpoint_change`."""
    return correlations(changes, f"{y}_change", {name: f"{x}_change" for name, x in xs.items()})


def top_abs_change(changes: DataFrame, column: str, key: str, k: int = 10) -> DataFrame:
    """The k largest absolute changes; NULL changes come first, ties go by key."""
    return changes.orderBy(F.abs(F.col(column)).desc_nulls_first(), F.col(key)).limit(k)


def avg_change(
    df: DataFrame,
    key: str,
    period: str,
    start: int,
    end: int,
    measure: str,
    members: DataFrame | None = None,
) -> DataFrame:
    """Mean at ``end`` minus mean at ``start`` per entity, for the listed members only."""
    if members is not None:
        df = df.join(members.select(key).distinct(), key, "left_semi")

    def at(p: int) -> Column:
        return mean_dec(F.when(F.col(period) == p, F.col(measure)), 10)

    return (
        df.groupBy(key)
        .agg(F.round(at(end) - at(start), 4).alias(f"{measure}_change"))
        .orderBy(F.desc_nulls_last(f"{measure}_change"), key)
    )


def scatter(
    df: DataFrame,
    period: str,
    at: int,
    keys: list[str],
    x: str,
    y: str,
    require_x: bool = False,
) -> DataFrame:
    """Mean x and y per key in one period; rows without a period stay in.

    ``require_x`` drops groups whose mean x is NULL.
    """
    rows = df.where((F.col(period) == at) | F.col(period).isNull())
    out = group_means(rows, keys, {f"avg_{x}": mean_dec(x, 4), f"avg_{y}": mean_dec(y, 4)})
    return out.where(F.col(f"avg_{x}").isNotNull()) if require_x else out


def linear_fit(df: DataFrame, x: str, y: str, by: list[str] = ()) -> DataFrame:
    """Least-squares line y = intercept + slope * x with r squared; pooled, or one per group.

    Groups whose x is constant have no line: slope, intercept and r squared are NULL.
    """
    xd, yd = F.col(x).cast("double"), F.col(y).cast("double")
    varies = F.regr_sxx(yd, xd) > 0
    fit = [
        F.regr_count(yd, xd).alias("pairs"),
        F.when(varies, round_dec(F.regr_slope(yd, xd), 6)).alias("slope"),
        F.when(varies, round_dec(F.regr_intercept(yd, xd), 6)).alias("intercept"),
        F.when(varies, round_dec(F.regr_r2(yd, xd), 6)).alias("r_squared"),
    ]
    return df.groupBy(*by).agg(*fit) if by else df.agg(*fit)


def profile_matrix(df: DataFrame, group: str, columns: list[str], period: str, at: int) -> DataFrame:
    """(group, measure, mean) at one period; rows without a period are left out."""
    wide = group_means(
        df.where(F.col(period) == at), [group], {c: mean_dec(c, 4) for c in columns}
    )
    return wide.unpivot([group], columns, "measure", "average")


def series(
    df: DataFrame, period: str, group: str, measure: str, key: str, members: DataFrame | None = None
) -> DataFrame:
    """Mean of a measure by (period, group), restricted to listed members."""
    if members is not None:
        df = df.join(members.select(key).distinct(), key, "left_semi")
    return group_means(df, [period, group], {f"avg_{measure}": mean_dec(measure, 4)}).orderBy(period, group)


def rank_list(df: DataFrame, key: str, measure: str) -> DataFrame:
    """Entities by mean of a measure, highest first."""
    out = group_means(df, [key], {f"avg_{measure}": mean_dec(measure, 4)})
    return out.orderBy(F.desc_nulls_last(f"avg_{measure}"), key)


def sum_by(df: DataFrame, key: str, columns: list[str], attribute: str) -> DataFrame:
    """Sums per key, with the attribute if it is the same on all rows, else a marker."""
    return df.groupBy(key).agg(
        single_value(attribute).alias(attribute), *[F.sum(c).alias(f"sum_{c}") for c in columns]
    )


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, null rate in percent, one digit); one pass over all columns."""
    rate = {
        c: F.round(
            F.count_if(F.col(c).isNull()).cast("decimal(38,10)") * 100 / F.nullif(F.count("*"), F.lit(0)), 1
        )
        for c in columns
    }
    return df.agg(*[r.alias(c) for c, r in rate.items()]).unpivot([], columns, "column_name", "null_pct")


def all_pass(df: DataFrame, condition: Column) -> DataFrame:
    """Whether the condition holds on every row; FALSE for no rows or an unknown result."""
    return df.agg(F.coalesce(F.bool_and(F.coalesce(condition, F.lit(False))), F.lit(False)).alias("all_passed"))

