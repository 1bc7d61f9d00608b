"""Regression on order statistics for left-censored measurements, many groups at once.

Helsel, D. R. (2005), Nondetects and Data Analysis; Helsel and Cohn (1988), Water
Resources Research 24, 1997-2004; Filliben (1975), Technometrics 17, 111-117.

Measurements repeat a lot, so the first step tallies equal ones: (keys, value, censored,
count). Only the tally is shuffled and ordered. With j the last threshold at or below a
value, A_j and C_j count the uncensored and censored measurements of threshold j,
B_j = sum(C_k, k <= j) + sum(A_k, k < j) and 1 - PE_j = prod(B_k / (A_k + B_k), k >= j).
All of these are totals or running totals of the tally; no row is compared with another.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seepline.functions.normal import normal_quantile
from seepline.operators.ranking import SEGMENT, join_on, order_groups, repeat_rows
from seepline.session import checkpointed

_SALT_ROWS = 1_000_000

TRANSFORMS: dict[str, tuple[Callable[[Column], Column], Callable[[Column], Column]]] = {
    "log": (F.ln, F.exp),
    "log10": (F.log10, lambda c: F.pow(F.lit(10.0), c)),
    "none": (lambda c: c, lambda c: c),
}


def _count_if(condition: Column, n: Column) -> Column:
    return F.when(condition, n).otherwise(F.lit(0).cast("long"))


def _measured(result: str, censored: str) -> Column:
    """A row without value or flag is no measurement."""
    value = F.col(result).cast("double")
    return value.isNotNull() & ~F.isnan(value) & F.col(censored).isNotNull()


def ros_valid(
    df: DataFrame,
    keys: list[str],
    censored: str = "censorship",
    max_fraction: float = 0.8,
    min_uncensored: int = 2,
    result: str = "result",
) -> DataFrame:
    """Per group with a measurement: enough uncensored values, not too many censored ones,
    and both. The same rows count as in the imputation."""
    n, cens = F.count(F.lit(1)), F.count_if(F.col(censored))
    enough, few = (n - cens) >= min_uncensored, (cens / n) <= F.lit(max_fraction)
    return df.where(_measured(result, censored)).groupBy(*keys).agg(
        enough.alias("enough_uncensored"), few.alias("not_too_many_censored"), (enough & few).alias("valid")
    )


@dataclass(frozen=True)
class _Tally:
    """Tallied measurements with the group totals each step needs, written once."""

    rows: DataFrame
    keys: list[str]
    result: str
    censored: str
    observations: int

    def expand(self, df: DataFrame, index: str) -> DataFrame:
        return repeat_rows(df, "_n", index, self.observations, self.keys + ["_v", "_c"])

    def named(self, df: DataFrame, *columns) -> DataFrame:
        return df.select(
            *self.keys, F.col("_v").alias(self.result), F.col("_c").alias(self.censored), *columns
        )


def tally(df: DataFrame, keys: list[str], result: str = "result", censored: str = "censorship") -> DataFrame:
    """Equal measurements of a group counted: ``keys``, ``_v`` (value), ``_c`` (censored), ``_n``.

    Tallies add up: the sum of ``_n`` over the tallies of parts of a table is the tally of all.
    """
    value = F.col(result).cast("double")
    return (
        df.where(_measured(result, censored))
        .groupBy(*keys, value.alias("_v"), F.col(censored).alias("_c"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def _tally(df: DataFrame, keys: list[str], result: str, censored: str) -> _Tally:
    """Tally and order the measurements."""
    return _ordered(tally(df, keys, result, censored), keys, result, censored)


def _ordered(counted: DataFrame, keys: list[str], result: str, censored: str) -> _Tally:
    rows, groups = order_groups(counted, keys, "_v")
    c, n, v = F.col("_c"), F.col("_n"), F.col("_v")
    rows = groups.add(
        rows,
        [v.asc(), c.desc()],
        totals={
            "n_obs": ("sum", n),
            "n_cens": ("sum", _count_if(c, n)),
            "max_unc": ("max", F.when(~c, v)),
            "min_all": ("min", v),
            "min_cens": ("min", F.when(c, v)),
        },
        running={
            "_ordinal": ("sum", F.lit(1).cast("long")),
            "_limits": ("sum", F.when(c, 1).otherwise(0).cast("long")),
            "_cens_upto": ("sum", _count_if(c, n)),
            "_unc_upto": ("sum", _count_if(~c, n)),
        },
    )
    lowest_is_value = F.coalesce((F.col("min_all") < F.col("min_cens")).cast("long"), F.lit(0))
    rows = rows.withColumn(
        "det_limit_index",
        F.when(F.col("n_cens") == 0, 0).otherwise(F.col("_limits") + lowest_is_value - 1).cast("long"),
    )
    rows = checkpointed(rows.drop(SEGMENT))
    observations = rows.agg(F.sum("_n")).first()[0] or 0
    return _Tally(rows, keys, result, censored, observations)


def _kept() -> Column:
    """Not a censored value above every uncensored one."""
    return ~F.col("_c") | (F.col("_v") <= F.col("max_unc"))


def _valid(max_fraction: float, min_uncensored: int) -> Column:
    n, cens = F.col("n_obs"), F.col("n_cens")
    return (n - cens >= min_uncensored) & (cens / n <= F.lit(max_fraction))


def _cohn(t: _Tally) -> DataFrame:
    """One row per group and threshold, with the totals before it."""
    c, n = F.col("_c"), F.col("_n")
    limits = (
        t.rows.where(F.col("n_cens") > 0)
        .groupBy(*t.keys, "det_limit_index")
        .agg(
            F.min("_v").alias("lower_dl"),
            F.sum(_count_if(~c, n)).alias("nuncen_above"),
            F.sum(_count_if(c, n)).alias("ncen_equal"),
            F.min("_ordinal").alias("_first"),
            F.max("_ordinal").alias("_last"),
        )
    )
    limits, groups = order_groups(limits, t.keys, "lower_dl")
    limits = groups.add(
        limits,
        [F.col("lower_dl").asc()],
        running={"_a": ("sum", F.col("nuncen_above")), "_c_sum": ("sum", F.col("ncen_equal"))},
    )
    limits = limits.withColumn("_a_before", F.col("_a") - F.col("nuncen_above")).withColumn(
        "nobs_below", F.col("_c_sum") + F.col("_a_before")
    )
    below = F.col("nobs_below") / (F.col("nuncen_above") + F.col("nobs_below"))
    limits = groups.add(
        limits, [F.col("lower_dl").desc()], running={"_q": ("product", below)}, descending=True
    ).withColumn("prob_exceedance", F.lit(1.0) - F.col("_q"))
    following = limits.select(
        *t.keys,
        (F.col("det_limit_index") - 1).alias("det_limit_index"),
        F.col("lower_dl").alias("_upper"),
        F.col("prob_exceedance").alias("_pe"),
    )
    limits = join_on(limits, following, t.keys + ["det_limit_index"])
    return limits.select(
        *t.keys, "det_limit_index", "lower_dl",
        F.coalesce(F.col("_upper"), F.lit(float("inf"))).alias("upper_dl"),
        "nuncen_above", "nobs_below", "ncen_equal", "prob_exceedance",
        F.coalesce(F.col("_pe"), F.lit(0.0)).alias("pe_next"),
        "_a_before", (F.col("_c_sum") - F.col("ncen_equal")).alias("_c_before"), "_first", "_last",
    )


def cohn_numbers(
    df: DataFrame, keys: list[str], result: str = "result", censored: str = "censorship"
) -> DataFrame:
    """Cohn numbers of each threshold, and a closing row with exceedance 0 per group."""
    table = _cohn(_tally(df, keys, result, censored))
    shown = [
        "lower_dl", "upper_dl", "nuncen_above", "nobs_below", "ncen_equal", "prob_exceedance",
    ]
    types = dict(table.dtypes)
    row = F.struct(F.col("det_limit_index"), *shown)
    closing = F.struct(
        (F.col("det_limit_index") + 1).alias("det_limit_index"),
        *[F.lit(None).cast(types[c]).alias(c) for c in shown[:-1]],
        F.lit(0.0).alias("prob_exceedance"),
    )
    last = F.col("upper_dl") == F.lit(float("inf"))
    return table.select(*keys, F.inline(F.when(last, F.array(row, closing)).otherwise(F.array(row))))


def _with_limits(t: _Tally, rows: DataFrame) -> DataFrame:
    """Tally rows with the Cohn numbers of their threshold.

    The rows of one threshold may be many; they are joined in slices of the group's order,
    and a threshold is repeated for just the slices it spans.
    """
    slices = F.sequence(F.floor(F.col("_first") / _SALT_ROWS), F.floor(F.col("_last") / _SALT_ROWS))
    limits = _cohn(t).withColumn("_slice", F.explode(slices)).drop("_first", "_last", "lower_dl")
    return join_on(
        rows.withColumn("_slice", F.floor(F.col("_ordinal") / _SALT_ROWS)),
        limits,
        t.keys + ["det_limit_index", "_slice"],
        "inner",
    ).drop("_slice")


def _ranked(t: _Tally, rows: DataFrame) -> DataFrame:
    """One row per measurement: rank within (threshold, flag) and plotting position. The
    ranked tally is written once; whatever is written out from it reads those rows."""
    c = F.col("_c")
    joined = checkpointed(_with_limits(t, rows)).withColumn(
        "_before",
        F.when(c, F.col("_cens_upto") - F.col("_c_before")).otherwise(F.col("_unc_upto") - F.col("_a_before"))
        - F.col("_n"),
    )
    pe = F.col("prob_exceedance")
    return (
        t.expand(joined, "_i")
        .withColumn("rank", F.col("_before") + F.col("_i"))
        .withColumn(
            "plot_pos",
            F.when(c, (1 - pe) * F.col("rank") / (F.col("ncen_equal") + 1)).otherwise(
                (1 - pe) + (pe - F.col("pe_next")) * F.col("rank") / (F.col("nuncen_above") + 1)
            ),
        )
    )


def det_limit_index(
    df: DataFrame, keys: list[str], result: str = "result", censored: str = "censorship"
) -> DataFrame:
    """Index of the last threshold at or below each value."""
    t = _tally(df, keys, result, censored)
    return t.named(t.expand(t.rows, "_i"), "det_limit_index")


def ros_sort(
    df: DataFrame, keys: list[str], result: str = "result", censored: str = "censorship"
) -> DataFrame:
    """Place of each kept measurement: censored ones first, each part by value."""
    t = _tally(df, keys, result, censored)
    c, n = F.col("_c"), F.col("_n")
    kept = t.rows.groupBy(*t.keys).agg(F.sum(_count_if(c & _kept(), n)).alias("_kept_cens"))
    rows = join_on(t.rows, kept, t.keys).where(_kept())
    start = F.when(c, F.col("_cens_upto")).otherwise(F.col("_kept_cens") + F.col("_unc_upto")) - n
    return t.named(t.expand(rows, "_i"), (start + F.col("_i")).alias("position"))


def ros_rank(
    df: DataFrame, keys: list[str], result: str = "result", censored: str = "censorship"
) -> DataFrame:
    """1..n within threshold and flag, for groups that have censored values."""
    t = _tally(df, keys, result, censored)
    return t.named(_ranked(t, t.rows.where(_kept())), "det_limit_index", "rank")


def ros_plot_pos(
    df: DataFrame, keys: list[str], result: str = "result", censored: str = "censorship"
) -> DataFrame:
    """Plotting positions before the censored ones are put in order."""
    t = _tally(df, keys, result, censored)
    return t.named(_ranked(t, t.rows.where(_kept())), "det_limit_index", "rank", "plot_pos")


def _in_order(t: _Tally, censored_rows: DataFrame) -> DataFrame:
    """Give the group's censored positions, in ascending order, to its censored values.

    Both sides are numbered and joined on the number, which no group can overload. Each has a
    row for every censored measurement, written out from far fewer tallied ones; the planner
    sees the size of the tally, so the join says by itself that neither side is small.
    """
    numbered = censored_rows.select(*t.keys, "_v", "_c", (F.col("_c_before") + F.col("rank")).alias("_place"), "plot_pos")
    positions = numbered.select(*t.keys, F.col("plot_pos"))
    positions, groups = order_groups(positions, t.keys, "plot_pos")
    positions = groups.add(
        positions, [F.col("plot_pos").asc()], running={"_place": ("sum", F.lit(1).cast("long"))}
    ).select(*t.keys, "_place", "plot_pos")
    return join_on(numbered.drop("plot_pos"), positions.hint("merge"), t.keys + ["_place"], "inner")


def ros_sort_nd(
    df: DataFrame, keys: list[str], result: str = "result", censored: str = "censorship"
) -> DataFrame:
    """Plotting positions with the censored ones ascending along the censored values."""
    t = _tally(df, keys, result, censored)
    ranked = _ranked(t, t.rows.where(_kept()))
    ordered = _in_order(t, ranked.where(F.col("_c")))
    return t.named(ranked.where(~F.col("_c")), "plot_pos").unionByName(t.named(ordered, "plot_pos"))


def norm_plot_pos(df: DataFrame, keys: list[str], result: str = "result") -> DataFrame:
    """Filliben medians of the ordered values of each group."""
    flag = "_uncensored"
    t = _tally(df.withColumn(flag, F.lit(False)), keys, result, flag)
    n, i = F.col("n_obs"), F.col("_unc_upto") - F.col("_n") + F.col("_i")
    top = F.pow(F.lit(0.5), F.lit(1.0) / n)
    position = F.when(i == n, top).when(i == 1, 1 - top).otherwise((i - 0.3175) / (n + 0.365))
    return t.named(t.expand(t.rows, "_i"), position.alias("plot_pos")).drop(flag)


def _transforms(transform):
    return TRANSFORMS[transform] if isinstance(transform, str) else transform


def _fit(t: _Tally, uncensored_rows: DataFrame, forward) -> DataFrame:
    """Least squares of the transformed value on z, per group. A value the transform does
    not take leaves the group without a fit."""
    points = normal_quantile(
        uncensored_rows.select(*t.keys, "n_cens", "plot_pos", forward(F.col("_v")).alias("_y")), "plot_pos", "zprelim"
    )
    complete = F.count(F.lit(1)) == F.count("_y")
    return points.groupBy(*t.keys).agg(
        F.when(complete, F.regr_slope("_y", "zprelim")).alias("_slope"),
        F.when(complete, F.regr_intercept("_y", "zprelim")).alias("_intercept"),
        F.max("n_cens").alias("_n_cens"),
    )


def _estimated(t: _Tally, ranked: DataFrame, transform) -> DataFrame:
    """Censored measurements with position, z and the value read off the fitted line."""
    forward, back = _transforms(transform)
    censored = _in_order(t, ranked.where(F.col("_c")))
    # one row per slice of censored places, so that a large group meets many copies of its fit
    fit = _fit(t, ranked.where(~F.col("_c")), forward).withColumn(
        "_slice",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("_n_cens") / _SALT_ROWS))),
    )
    joined = join_on(
        censored.withColumn("_slice", F.floor(F.col("_place") / _SALT_ROWS)), fit, t.keys + ["_slice"]
    )
    return normal_quantile(joined, "plot_pos", "zprelim").withColumn(
        "estimated", back(F.col("_slope") * F.col("zprelim") + F.col("_intercept"))
    )


def ros_estimate(
    df: DataFrame,
    keys: list[str],
    result: str = "result",
    censored: str = "censorship",
    transform="log",
    max_fraction: float = 0.8,
    min_uncensored: int = 2,
) -> DataFrame:
    """Positions, z and estimates of the groups that have censored values and are valid."""
    t = _tally(df, keys, result, censored)
    usable = (F.col("n_cens") > 0) & _valid(max_fraction, min_uncensored)
    ranked = _ranked(t, t.rows.where(usable & _kept()))
    modelled = _estimated(t, ranked, transform)
    seen = normal_quantile(ranked.where(~F.col("_c")), "plot_pos", "zprelim").withColumn(
        "estimated", F.lit(None).cast("double")
    )
    columns = ("plot_pos", "zprelim", "estimated")
    return t.named(seen, *columns, F.col("_v").alias("final")).unionByName(
        t.named(modelled, *columns, F.col("estimated").alias("final"))
    )


def ros_impute(
    df: DataFrame,
    result: str,
    censored: str,
    keys: list[str],
    substitution: float = 0.5,
    floor: float | None = None,
    transform="log",
    max_fraction: float = 0.8,
    min_uncensored: int = 2,
) -> DataFrame:
    """Every kept measurement with its final value.

    Groups without censored values keep them; valid groups get estimates for censored
    values (and lose censored values above all uncensored ones); in the others a censored
    value becomes a fraction of its limit. ``floor`` lifts results of the valid groups.
    """
    return impute_tally(tally(df, keys, result, censored), result, censored, keys, substitution, floor, transform, max_fraction, min_uncensored)


def impute_tally(
    counted: DataFrame,
    result: str,
    censored: str,
    keys: list[str],
    substitution: float = 0.5,
    floor: float | None = None,
    transform="log",
    max_fraction: float = 0.8,
    min_uncensored: int = 2,
) -> DataFrame:
    """As ``ros_impute``, from measurements that are tallied already."""
    t = _ordered(counted, keys, result, censored)
    modelled = (F.col("n_cens") > 0) & _valid(max_fraction, min_uncensored)

    def lifted(c: Column) -> Column:
        return F.coalesce(F.greatest(c, F.lit(float(floor))), F.lit(float(floor))) if floor else c

    v, c = F.col("_v"), F.col("_c")
    plain = t.expand(t.rows.where(~modelled | ~c), "_i")
    final = F.when(modelled, lifted(v)).when(c, v * F.lit(substitution)).otherwise(v)
    ranked = _ranked(t, t.rows.where(modelled & _kept()))
    return t.named(plain, final.alias("final")).unionByName(
        t.named(_estimated(t, ranked, transform), lifted(F.col("estimated")).alias("final"))
    )
