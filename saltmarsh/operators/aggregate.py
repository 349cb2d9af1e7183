"""Group aggregations, customer roll-up and scores built from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import months_between_instants
from ..session import durable
from .stats import PERCENTILE_BUFFER_BYTES, one_row, quantile_table, quantiles


def value_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *by)


def compare_nulls(df: DataFrame, a: str, b: str) -> DataFrame:
    """Percent of rows with only ``a``, only ``b`` and both filled in."""
    has_a, has_b = F.col(a).isNotNull(), F.col(b).isNotNull()
    pct = lambda cond: F.round(F.avg(cond.cast("double")) * 100, 5)
    return df.agg(pct(has_a & ~has_b).alias("only_a"), pct(has_b & ~has_a).alias("only_b"),
                  pct(has_a & has_b).alias("both"))


def equal_width_bin(df: DataFrame, column: str, bins: int) -> Column:
    """1-based bin number over [min, max], right-closed, the minimum in bin 1."""
    s = one_row(df, lo=F.min(column), hi=F.max(column))
    width = (s["hi"] - s["lo"]) / bins
    raw = F.ceil((F.col(column) - s["lo"]) / width)
    return F.when(F.col(column).isNull(), F.lit(None)).when(width == 0, F.lit(1)).otherwise(
        F.least(F.greatest(raw, F.lit(1)), F.lit(bins))).cast("int")


def frequency_table(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins (empty ones too) with count, frequency, cumulative frequency."""
    binned = df.select(equal_width_bin(df, column, bins).alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))
    every = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    table = every.join(binned.where("bin is not null"), "bin", "left").fillna(0, ["n"])
    total = df.agg(F.count("*").alias("t")).scalar()
    table = table.withColumn("freq", F.col("n") / total)  # one row per bin from here on
    return table.withColumn("cum_freq", F.sum("freq").over(Window.orderBy("bin")))


def crosstab_with_margins(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts by both keys with row, column and grand totals (``'All'``) in long form."""
    cubed = df.cube(a, b).agg(F.count("*").alias("n"), F.grouping(a).alias("_ga"), F.grouping(b).alias("_gb"))
    return cubed.select(
        F.when(F.col("_ga") == 1, "All").otherwise(F.col(a)).alias(a),
        F.when(F.col("_gb") == 1, "All").otherwise(F.col(b)).alias(b), "n")


def chi2_contributions(df: DataFrame, a: str, b: str) -> DataFrame:
    """Observed, expected and share of chi-square per cell; absent cells count as 0.

    The row totals carry the whole list of column totals, so absent cells appear without a
    product of the two tables. The contingency table is small: one row per category pair.
    """
    cells = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count("*").alias("obs"))
    cols = cells.groupBy(b).agg(F.sum("obs").alias("ct")).agg(F.collect_list(F.struct(b, "ct")).alias("l")).scalar()
    grid = (cells.groupBy(a).agg(F.sum("obs").alias("rt"))
            .select(a, "rt", F.explode(cols).alias("c")).select(a, "rt", F.col(f"c.{b}").alias(b), "c.ct"))
    total = cells.agg(F.sum("obs").alias("t")).scalar()
    full = grid.join(cells, [a, b], "left").fillna(0, ["obs"])
    expected = F.col("rt") * F.col("ct") / total
    full = full.withColumn("expected", expected).withColumn(
        "part", F.pow(F.col("obs") - F.col("expected"), 2) / F.col("expected"))
    chi2 = full.agg(F.sum("part").alias("x")).scalar()
    return full.select(a, b, "obs", "expected", (F.col("part") / F.nullif(chi2, F.lit(0.0))).alias("share"))


def boxplot_stats(df: DataFrame, by: str, value: str) -> DataFrame:
    """Quartiles, IQR and whiskers (extreme values inside 1.5 IQR) per group."""
    q = quantiles(df, value, [0.25, 0.5, 0.75], by=[by]).select(
        by, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo, hi = F.col("q1") - 1.5 * F.col("iqr"), F.col("q3") + 1.5 * F.col("iqr")
    # value counts first: the join then never moves one row per input row of a hot group
    vals = df.groupBy(by, value).agg(F.count("*").alias("_c")).join(q, by)
    inside = F.when(F.col(value).between(lo, hi), F.col(value))
    return vals.groupBy(by).agg(*[F.first(c).alias(c) for c in ("q1", "median", "q3", "iqr")],
                                F.min(inside).alias("whisker_low"), F.max(inside).alias("whisker_high"))


def mode_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """Most frequent value per key; the smallest value wins a tie."""
    counts = df.groupBy(key, value).agg(F.count("*").alias("n"))
    rank = F.struct(-F.col("n"), F.col(value))
    return counts.groupBy(key).agg(F.min_by(value, rank).alias("mode"), F.max("n").alias("n"))


def inconsistent_keys(df: DataFrame, key: str, attribute: str) -> DataFrame:
    """Keys that occur with more than one attribute value."""
    return df.groupBy(key).agg(F.countDistinct(attribute).alias("n_values")).where("n_values > 1")


def repeated_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key occurs more than once. Only key digests are counted and shuffled."""
    digest = F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in keys]), 256)
    keyed = df.withColumn("_d", digest)
    repeated = keyed.groupBy("_d").agg(F.count("*").alias("_n")).where("_n > 1").select("_d")
    return keyed.join(repeated, "_d", "left_semi").drop("_d")


def utility_score(df: DataFrame, day: Column, weight: Column, resp: Column, action: Column) -> DataFrame:
    """Trading utility: daily sums, annualised ratio ``t`` capped to [0, 6], times the total."""
    daily = df.groupBy(day.alias("_day")).agg(F.sum(weight * resp * action).alias("_p"))
    s = daily.agg(F.sum("_p").alias("p"), F.sum(F.col("_p") * F.col("_p")).alias("pp"), F.count("*").alias("d"))
    t = F.when(F.col("pp") == 0, F.lit(0.0)).otherwise(F.col("p") / F.sqrt("pp") * F.sqrt(250 / F.col("d")))
    capped = F.least(F.greatest(t, F.lit(0.0)), F.lit(6.0))
    return s.select("d", "p", t.alias("t"), (capped * F.col("p") + F.lit(0.0)).alias("u"))


def customer_rollup(
    lines: DataFrame,
    *,
    customer: str,
    when: str,
    amount: str,
    quantity: str,
    cancelled: Column,
    top_product: Column,
    generic_product: Column | None = None,
    presence: dict[str, Column] | None = None,
    digits: int = 4,
    last: Column | None = None,
) -> DataFrame:
    """One row per customer from invoice lines, in a single partially aggregated shuffle.

    Flags come from all lines but the generic ones; sums and dates only from lines that are
    not cancelled; customers with cancelled lines only are left out. ``months_active`` counts
    from the first order to ``last`` (the last date of the whole input if not given), at least 1. Amounts are summed as
    decimals with ``digits`` places, so a sum does not depend on the order of the rows and may be
    compared with its own quartiles.
    """
    no = F.lit(False)
    bad = F.coalesce(cancelled, no)
    known = ~F.coalesce(generic_product, no) if generic_product is not None else F.lit(True)
    good = known & ~bad
    exact = lambda c: F.sum(F.when(good, F.col(c).cast(f"decimal(18,{digits})"))).cast("double")
    bits = {n: F.max(F.when(good & c, 1).otherwise(0)).alias(n) for n, c in (presence or {}).items()}
    # stored, because the last date of the input is a second look at it
    rolled = durable(lines.groupBy(customer).agg(
        F.max(when).alias("_last"), F.count_if(good).alias("_lines"), F.min(F.when(good, F.col(when))).alias("_first"),
        F.max((known & bad).cast("int")).alias("has_ever_cancelled"),
        F.max((known & F.coalesce(top_product, no)).cast("int")).alias("bought_top_product"),
        exact(amount).alias("_amount"), exact(quantity).alias("_quantity"), *bits.values()))
    last = rolled.agg(F.max("_last").alias("m")).scalar() if last is None else last
    out = rolled.where(F.col(customer).isNotNull() & (F.col("_lines") > 0)).withColumn(
        "months_active", months_between_instants(F.col("_first"), last))
    return out.select(
        customer, "has_ever_cancelled", "bought_top_product", "months_active",
        (F.col("_amount") / F.col("months_active")).alias("price_per_month"),
        (F.col("_quantity") / F.col("months_active")).alias("quantity_per_month"), *bits)


def quartile_code(x: Column, q: Sequence[Column], codes: Sequence[int]) -> Column:
    return (F.when(x <= q[0], codes[0]).when(x <= q[1], codes[1]).when(x <= q[2], codes[2]).otherwise(codes[3]))


def rfm_score(rolled: DataFrame) -> DataFrame:
    """Adds r/f/m quartile codes and their sum; low is good. ``rolled`` is read twice, so it should be
    cheap to read, as the stored result of ``customer_rollup`` is."""
    columns = ["months_active", "quantity_per_month", "price_per_month"]
    # the plan's estimate knows joins, not the stored rows, so the rows are counted
    small = rolled.count() * 8 * len(columns) <= PERCENTILE_BUFFER_BYTES
    q = quantile_table(rolled, columns, [0.25, 0.5, 0.75], max_buffer=None if not small else 1 << 62)
    out = (rolled
           .withColumn("r", quartile_code(F.col("months_active"), q["months_active"], (1, 2, 3, 4)))
           .withColumn("f", quartile_code(F.col("quantity_per_month"), q["quantity_per_month"], (4, 3, 2, 1)))
           .withColumn("m", quartile_code(F.col("price_per_month"), q["price_per_month"], (4, 3, 2, 1))))
    return out.withColumn("rfm_score", F.col("r") + F.col("f") + F.col("m"))


def score_distance_matrix(df: DataFrame, score: str) -> DataFrame:
    """Absolute distance between all distinct values of a small integer score, with pair counts.

    Rows that share a score share their distances, so the matrix is over values, not rows.
    """
    counts = df.where(F.col(score).isNotNull()).groupBy(score).agg(F.count("*").alias("n"))
    every = counts.agg(F.collect_list(F.struct(F.col(score).alias("v"), "n")).alias("l")).scalar()
    return counts.select(F.col(score).alias("a"), F.col("n").alias("n_a"), F.explode(every).alias("o")).select(
        "a", F.col("o.v").alias("b"), F.abs(F.col("a") - F.col("o.v")).alias("distance"),
        (F.col("n_a") * F.col("o.n")).alias("n_pairs"))
