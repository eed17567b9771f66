"""Market statistics (E1-E20): aggregates, quantiles, top-k, correlations, histograms.

Rules followed throughout:
* several statistics of one frame are fused into one ``agg`` (one scan, one partial/final
  aggregate) and then unpivoted;
* small derived frames joined back are one-row aggregates or ``limit(k)`` results, so their
  ``broadcast`` has a proven size bound;
* no window without ``partitionBy`` runs over data that grows with the input; global ranks
  go through ``ranked_values``, whose rows are dealt by range first.
* numpy rounds half-to-even on the scaled value, so rounding is ``rint(x * 10^d) / 10^d``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kvadrat.session import checkpointed
from kvadrat import schema as S


def round_even(c: Column | str, digits: int) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    scale = float(10**digits)
    return F.rint(x * scale) / scale


def _unpivot_rows(wide: DataFrame, names: list[str], fields: list[str]) -> DataFrame:
    """Turn a one-row frame with columns ``<name>__<field>`` into one row per name."""
    structs = [
        F.struct(F.lit(n).alias("column_name"), *[F.col(f"{n}__{f}").alias(f) for f in fields]) for n in names
    ]
    return wide.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def _quantile(c: str, q: float | list[float], approx: bool = True) -> Column:
    """Approximate quantile aggregate (bounded memory per group); exact quantiles go
    through ``exact_quantiles``."""
    return F.percentile_approx(F.col(c), q, 10000)


# ---------------------------------------------------------------------------
# Column profiles
# ---------------------------------------------------------------------------


def missing_table(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing count and percentage (2 dp) per column, in one pass."""
    columns = columns or [c for c in df.columns if not c.startswith("_")]
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in columns:
        miss = F.col(c).isNull()
        if dict(df.dtypes)[c] in ("double", "float"):
            miss = miss | F.isnan(F.col(c))
        aggs.append(F.count_if(miss).alias(f"{c}__missing_count"))
    wide = df.agg(*aggs)
    long = _unpivot_rows(wide.drop("_n"), columns, ["missing_count"]).crossJoin(F.broadcast(wide.select("_n")))
    return long.select(
        "column_name",
        F.col("missing_count").cast("bigint").alias("missing_count"),
        # pandas: isna().mean() * 100, i.e. (count / n) * 100
        round_even(F.try_divide(F.col("missing_count").cast("double"), F.col("_n")) * 100.0, 2).alias("missing_pct"),
    )


DESCRIBE_PERCENTILES = [0.01, 0.05, 0.5, 0.95, 0.99]


def quantile_columns(
    df: DataFrame, columns: list[str], qs: list[float], approx: bool = False, name: str = "column_name"
) -> DataFrame:
    """(column_name, q0..) for several columns: exact (distributed) or approximate."""
    if approx:
        aggs = [F.percentile_approx(F.col(c).cast("double"), qs, 10000).alias(c) for c in columns]
        wide = df.agg(*aggs)
        items = [F.struct(F.lit(c).alias(name), *[F.col(c)[i].alias(f"q{i}") for i in range(len(qs))]) for c in columns]
        return wide.select(F.explode(F.array(*items)).alias("_r")).select("_r.*")
    return exact_quantiles(stacked(df, columns, name), "value", qs, [name]).drop("n")


def describe(
    df: DataFrame,
    columns: list[str] | None = None,
    percentiles: list[float] | None = None,
    digits: int = 2,
    approx: bool = False,
) -> DataFrame:
    """E2 (and M22): count, mean, sample std, min, percentiles, max per column, rounded.

    Moments are one aggregate; percentiles come from ``quantile_columns`` (one grouped
    pass over the stacked columns); both sides have one row per column."""
    columns = columns or S.NUMERIC_RAW_COLUMNS
    percentiles = percentiles or DESCRIBE_PERCENTILES
    names = [f"p{round(p * 100):d}" for p in percentiles]
    aggs = []
    for c in columns:
        aggs += [
            F.count(c).alias(f"{c}__count"),
            F.avg(c).alias(f"{c}__mean"),
            F.stddev_samp(c).alias(f"{c}__std"),
            F.min(c).alias(f"{c}__min"),
            F.max(c).alias(f"{c}__max"),
        ]
    long = _unpivot_rows(df.agg(*aggs), columns, ["count", "mean", "std", "min", "max"])
    qt = quantile_columns(df, columns, percentiles, approx)
    qt = qt.select("column_name", *[F.col(f"q{i}").alias(n) for i, n in enumerate(names)])
    joined = long.join(F.broadcast(qt), "column_name", "left")
    fields = ["mean", "std", "min", *names, "max"]
    return joined.select(
        "column_name",
        F.col("count").cast("bigint").alias("count"),
        *[round_even(F.col(f).cast("double"), digits).alias(f) for f in fields],
    )


def numeric_ranges(df: DataFrame, columns: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Min, median, max of each numeric column (nulls skipped)."""
    columns = columns or ["area_m2", "rooms", "year_built", "price_eur"]
    aggs = []
    for c in columns:
        aggs += [F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max")]
    long = _unpivot_rows(df.agg(*aggs), columns, ["min", "max"])
    med = quantile_columns(df, columns, [0.5], approx).select("column_name", F.col("q0").alias("median"))
    return long.join(F.broadcast(med), "column_name", "left").select("column_name", "min", "median", "max")


def shape_summary(df: DataFrame) -> DataFrame:
    """Row count, column count and each column's name and type, one row per column."""
    cols = [c for c in df.columns if not c.startswith("_")]
    types = dict(df.dtypes)
    each = F.explode(F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type")) for i, c in enumerate(cols, 1)]))
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))  # one row
    return n.select(each.alias("c"), "n_rows", F.lit(len(cols)).alias("n_columns")).select("c.*", "n_rows", "n_columns")


def first_rows(df: DataFrame, n: int = 5, order_col: str = "_ord") -> DataFrame:
    """The first ``n`` rows, by their position: a bounded top-k."""
    return df.orderBy(F.col(order_col).asc_nulls_first()).limit(n)


# ---------------------------------------------------------------------------
# Clipping and histograms
# ---------------------------------------------------------------------------


def clip_upper(
    df: DataFrame,
    column: str,
    q: float,
    ref: DataFrame | None = None,
    approx: bool = False,
    bound: DataFrame | None = None,
) -> DataFrame:
    """Values of ``column`` clipped at the ``q`` quantile of ``ref`` (default: df).

    The bound is a one-row frame (``_upper``), broadcast to every task; nulls stay null.
    Pass ``bound`` to reuse one computed for several frames."""
    ref = df if ref is None else ref
    if bound is not None:
        pass
    elif approx:
        bound = ref.agg(_quantile(column, q, True).cast("double").alias("_upper"))
    else:
        bound = exact_quantiles(ref, column, [q]).select(F.col("q0").alias("_upper"))
    out = df.crossJoin(F.broadcast(bound))
    clipped = F.when(F.col(column).isNull(), None).otherwise(F.least(F.col(column), F.col("_upper")))
    return out.withColumn(f"{column}_clipped", clipped).drop("_upper")


def histogram(df: DataFrame, column: str, bins: int = 45, group_cols: list[str] | None = None) -> DataFrame:
    """Equal-width bins over the observed [min, max], last bin closed on the right. A column
    ``_n`` counts as the copies of its row.

    Range is a one-row aggregate per group (broadcast when ungrouped); counts are a
    partial/final hash aggregate on (group, bin)."""
    group_cols = group_cols or []
    x = F.col(column)
    data = df.filter(x.isNotNull())
    rng = data.groupBy(*group_cols).agg(F.min(x).alias("_lo0"), F.max(x).alias("_hi0"))
    rng = rng.select(
        *group_cols,
        F.when(F.col("_lo0") == F.col("_hi0"), F.col("_lo0") - 0.5).otherwise(F.col("_lo0")).alias("_lo"),
        F.when(F.col("_lo0") == F.col("_hi0"), F.col("_hi0") + 0.5).otherwise(F.col("_hi0")).alias("_hi"),
    )
    joined = data.crossJoin(F.broadcast(rng)) if not group_cols else data.join(rng, group_cols)
    lo, hi = F.col("_lo"), F.col("_hi")
    step = (hi - lo) / bins

    def edge(i: Column) -> Column:  # numpy.linspace(lo, hi, bins + 1)[i]
        return F.when(i == bins, hi).otherwise(i * step + lo)

    # numpy.histogram: index from (x - lo) / (hi - lo) * bins, then corrected against the edges
    raw = F.least(F.floor((x - lo) / (hi - lo) * F.lit(float(bins))), F.lit(bins - 1)).cast("int")
    down = F.when(x < edge(raw), raw - 1).otherwise(raw)
    b = F.when((x >= edge(down + 1)) & (down != bins - 1), down + 1).otherwise(down)
    copies = F.sum("_n") if "_n" in df.columns else F.count(F.lit(1))
    counts = joined.groupBy(*group_cols, b.alias("bin"), "_lo", "_hi").agg(copies.alias("count"))
    return counts.select(
        *group_cols,
        "bin",
        edge(F.col("bin")).alias("bin_lo"),
        edge(F.col("bin") + 1).alias("bin_hi"),
        F.col("count").cast("bigint").alias("count"),
    )


# ---------------------------------------------------------------------------
# Raw against cleaned
# ---------------------------------------------------------------------------


def by_dataset(sets: DataFrame, name: str = "dataset") -> DataFrame:
    """Rows of ``cleaning.set_counts`` dealt to the datasets they belong to: the value columns, the
    dataset's name and ``_n``, the rows of it with these values."""
    values = [c for c in sets.columns if c not in ("raw", "cleaned")]
    each = F.explode(F.array(*[F.struct(F.lit(d).alias(name), F.col(d).alias("_n")) for d in ("raw", "cleaned")]))
    return sets.select(*values, each.alias("_s")).select(*values, "_s.*").filter(F.col("_n") > 0)


def repeated(df: DataFrame, n: str = "_n", portion: int = 1 << 12) -> DataFrame:
    """Each row ``n`` times, without an array longer than ``portion`` in any of them (up to its square)."""
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1, F.lit(portion).cast("bigint")))
    some = df.withColumn("_start", starts)
    size = F.least(F.lit(portion).cast("bigint"), F.col(n) - F.col("_start"))
    return some.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), size))).drop("_start", "_copy", n)


# ---------------------------------------------------------------------------
# Label counts
# ---------------------------------------------------------------------------


def set_value_counts_top(sets: DataFrame, column: str, n: int = 10, name: str = "stage") -> DataFrame:
    """E5 for both datasets: the ``n`` most frequent labels of each (ties by label)."""
    counts = sets.filter(F.col(column).isNotNull()).groupBy(column).agg(F.sum("raw").alias("raw"), F.sum("cleaned").alias("cleaned"))
    order = Window.partitionBy(name).orderBy(F.col("_n").desc(), F.col(column).asc())
    top = by_dataset(counts, name).withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= n)
    return top.select(name, column, F.col("_n").alias("n"))


def set_before_after(sets: DataFrame, column: str = "city", n: int = 10) -> DataFrame:
    """E6 from ``cleaning.set_counts``: one aggregate, no join."""
    counts = sets.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.sum("raw").cast("bigint").alias("raw_rows"), F.sum("cleaned").cast("bigint").alias("cleaned_rows"))
    counts = counts.withColumn("removed", F.col("raw_rows") - F.col("cleaned_rows"))
    return counts.orderBy(F.col("raw_rows").desc(), F.col(column).asc()).limit(n)


def value_counts_top(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """E5: the ``n`` most frequent non-null labels (ties by label)."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), F.col(column).asc()).limit(n)


def before_after_counts(raw: DataFrame, cleaned: DataFrame, column: str = "city", n: int = 10) -> DataFrame:
    """Per-label counts before and after cleaning aligned by a full outer join on the
    label (both sides are per-label aggregates), zero-filled, top ``n`` by raw count."""
    a = raw.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("raw_rows"))
    b = cleaned.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("cleaned_rows"))
    j = a.join(b, column, "full_outer").select(
        column,
        F.coalesce("raw_rows", F.lit(0)).cast("bigint").alias("raw_rows"),
        F.coalesce("cleaned_rows", F.lit(0)).cast("bigint").alias("cleaned_rows"),
    )
    j = j.withColumn("removed", F.col("raw_rows") - F.col("cleaned_rows"))
    return j.orderBy(F.col("raw_rows").desc(), F.col(column).asc()).limit(n)


def category_share(df: DataFrame, column: str = "city", n: int = 15) -> DataFrame:
    """Percentage (2 dp) and count per label, top ``n``. The total is a one-row
    aggregate broadcast to the per-label counts (no global window)."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    out = counts.crossJoin(F.broadcast(total)).select(
        column,
        round_even(F.col("n") / F.col("_total") * 100.0, 2).alias("share_pct"),  # value_counts(normalize) * 100
        F.col("n").cast("bigint").alias("n"),
    )
    return out.orderBy(F.col("n").desc(), F.col(column).asc()).limit(n)


def top_k_semi_join(df: DataFrame, ranked_from: DataFrame, column: str = "city", k: int = 8) -> DataFrame:
    """Rows of ``df`` whose label is among the ``k`` most common in ``ranked_from``.
    The top-k frame has at most k rows, so broadcasting it is bounded."""
    top = value_counts_top(ranked_from, column, k).select(column)
    return df.join(F.broadcast(top), column, "left_semi")


def box_stats(df: DataFrame, column: str, group: str = "city", approx: bool = False) -> DataFrame:
    """Per-group quartiles, 1.5 IQR whiskers (most extreme data inside the fences)
    and the number of points outside. Two aggregates on ``group`` joined on the group."""
    x = F.col(column)
    data = df.filter(x.isNotNull())
    if approx:
        q = data.groupBy(group).agg(_quantile(column, [0.25, 0.5, 0.75], True).alias("_q"))
        q = q.select(group, *[F.col("_q")[i].alias(n) for i, n in enumerate(["q1", "median", "q3"])])
    else:
        q = exact_quantiles(data, column, [0.25, 0.5, 0.75], [group])
        q = q.select(group, F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo_fence = F.col("q1") - 1.5 * F.col("iqr")
    hi_fence = F.col("q3") + 1.5 * F.col("iqr")
    inside = (x >= lo_fence) & (x <= hi_fence)
    j = data.select(group, column).join(q, group)
    agg = j.groupBy(group, "q1", "median", "q3", "iqr").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(inside, x)).alias("whisker_low"),
        F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )
    return agg.select(
        group,
        F.col("n").cast("bigint").alias("n"),
        "q1",
        "median",
        "q3",
        "iqr",
        "whisker_low",
        "whisker_high",
        F.col("n_outliers").cast("bigint").alias("n_outliers"),
    )


# ---------------------------------------------------------------------------
# Regional price summary
# ---------------------------------------------------------------------------


def region_price_summary(
    df: DataFrame,
    cities: list[str] | int = 2,
    value: str = "price_eur",
    min_count: int = 30,
    approx: bool = False,
) -> DataFrame:
    """Per (city, region) count and p5/p25/median/p75/p95 of price, rounded to
    whole euros, groups with at least ``min_count`` listings. ``cities`` names the cities,
    or is k: the k most common cities of ``df`` (a k-row frame, broadcast to a semi join).
    Groups with a missing region are left out, as a pandas group-by does."""
    if isinstance(cities, int):
        data = top_k_semi_join(df, df, "city", cities)
    else:
        data = df.filter(F.col("city").isin(*cities))
    data = data.filter(F.col("region").isNotNull())
    qs = [0.05, 0.25, 0.5, 0.75, 0.95]
    names = ["p05", "p25", "median", "p75", "p95"]
    if approx:
        g = data.groupBy("city", "region").agg(F.count(value).alias("n"), _quantile(value, qs, True).alias("_q"))
        g = g.select("city", "region", "n", *[F.col("_q")[i].alias(f"q{i}") for i in range(len(qs))])
    else:
        g = exact_quantiles(data, value, qs, ["city", "region"])
    g = g.filter(F.col("n") >= min_count)
    return g.select(
        "city",
        "region",
        F.col("n").cast("bigint").alias("listings"),
        *[round_even(F.col(f"q{i}").cast("double"), 0).alias(n) for i, n in enumerate(names)],
    )


def top_n_per_group(df: DataFrame, group: str, order: list[Column], n: int = 10) -> DataFrame:
    """First ``n`` rows of each group (row_number per group; Spark inserts a partial
    WindowGroupLimit before the shuffle, so each map task forwards at most n per group)."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


# ---------------------------------------------------------------------------
# correlation
# ---------------------------------------------------------------------------


def pearson(a: str = "area_m2", b: str = "price_eur") -> Column:
    """Pearson correlation over rows where both are present."""
    return F.corr(F.col(a), F.col(b))


def value_ranks(df: DataFrame, column: str, group_cols: list[str] | None = None) -> DataFrame:
    """Rank of every distinct value of ``column`` (per group): ``rows_below`` (0-based
    rank of its first copy), ``ties`` and ``avg_rank`` (1-based, ties averaged).
    Distributed (see ``ranked_values``): no task sees all values of a group."""
    g = list(group_cols or [])
    r = ranked_values(df, column, g)
    return r.select(
        *g,
        column,
        F.col("_first").alias("rows_below"),
        F.col("_n").alias("ties"),
        (F.col("_first") + (F.col("_n") + 1) / 2.0).alias("avg_rank"),
    )


def spearman(df: DataFrame, a: str = "area_m2", b: str = "price_eur", group_cols: list[str] | None = None) -> DataFrame:
    """Spearman correlation = Pearson over average ranks, on rows with both values,
    per group (e.g. a dataset tag, so several frames rank in one pass). A column ``_n`` counts as
    the copies of its row.

    Distinct pairs with their counts are written once; they feed the ranking of both columns
    (one pass, the column's name being a part of the group) and the joins that bring the ranks
    back on (group, value), whose skewed values AQE splits."""
    g = list(group_cols or [])
    copies = F.sum("_n") if "_n" in df.columns else F.count(F.lit(1))
    valid = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in (a, b)]
    pairs = df.filter(valid[0] & valid[1]).groupBy(*g, a, b).agg(copies.alias("_rows"))
    pairs = checkpointed(pairs)
    named = stacked(pairs.select(*g, F.col(a).cast("double"), F.col(b).cast("double"), "_rows"), [a, b], "_column", "_value", [*g, "_rows"])
    ranks = value_ranks(named.withColumnRenamed("_rows", "_n"), "_value", [*g, "_column"]).select(*g, "_column", "_value", "avg_rank")
    of = lambda c, to: ranks.filter(F.col("_column") == c).select(*g, F.col("_value").alias(c), F.col("avg_rank").alias(to))
    cast = pairs.select(*g, F.col(a).cast("double").alias(a), F.col(b).cast("double").alias(b), "_rows")
    joined = cast.join(of(a, "_ra"), [*g, a]).join(of(b, "_rb"), [*g, b])
    # Pearson over rows from sums over distinct pairs; ranks are centred first, so nothing cancels
    n, x, y, w = F.sum("_rows"), F.col("_ra"), F.col("_rb"), F.col("_rows")
    centre = joined.groupBy(*g).agg((n + 1).alias("_n1"))
    joined = joined.join(F.broadcast(centre), g) if g else joined.crossJoin(F.broadcast(centre))
    x, y = x - F.col("_n1") / 2.0, y - F.col("_n1") / 2.0
    return joined.groupBy(*g).agg(
        F.try_divide(F.sum(w * x * y), F.sqrt(F.sum(w * x * x)) * F.sqrt(F.sum(w * y * y))).alias("spearman"))


CORR_COLUMNS = ["price_eur", "area_m2", "rooms", "year_built", "floor", "total_floors", "building_age", "price_per_m2"]


def corr_matrix(df: DataFrame, columns: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Pairwise-complete Pearson matrix as (col_a, col_b, corr), one aggregate."""
    columns = columns or CORR_COLUMNS
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    cells = []
    for a, b in pairs:
        cells.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"{a}__{b}").alias("v")))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("col_a"), F.lit(a).alias("col_b"), F.col(f"{a}__{b}").alias("v")))
    long = wide.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    v = F.when(F.isnan("v"), None).otherwise(F.col("v"))
    return long.select("col_a", "col_b", round_even(v, digits).alias("corr"))


# ---------------------------------------------------------------------------
# Sampling and options
# ---------------------------------------------------------------------------


def row_hash(columns: list[str], seed: int = S.RANDOM_STATE) -> Column:
    """md5 of the seed and the listed string columns: stable across runs, engines and
    partitionings (unlike ``rand`` or ``randomSplit``)."""
    parts = [F.lit(f"{seed}")]
    for c in columns:
        parts += [F.lit("|"), F.coalesce(F.col(c), F.lit("~"))]
    return F.md5(F.concat(*parts))


SAMPLE_KEY = ["url", "title", "description", "city", "region", "street", "heating_type", "parking", "raw_floor_string"]


def seeded_sample(
    df: DataFrame,
    n: int = 3000,
    seed: int = S.RANDOM_STATE,
    key: list[str] | None = None,
    tie_break: list[str] | None = None,
) -> DataFrame:
    """``min(n, rows)`` rows chosen by smallest hash of the ``key`` text columns
    (``tie_break`` columns order rows whose key text is equal): a bounded top-k, each task
    keeps its best ``n`` and the final merge sees at most n per task."""
    key = key or SAMPLE_KEY
    order = [F.col("_h")] + [F.col(c).asc_nulls_first() for c in (tie_break or [])]
    return df.withColumn("_h", row_hash(key, seed)).orderBy(*order).limit(n).drop("_h")


def category_options(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Sorted distinct non-null labels per categorical column, long form."""
    columns = columns or ["city", "region", "heating_type", "parking"]
    stacked = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("option_set"), F.col(c).cast("string").alias("label")) for c in columns])).alias("o")
    ).select("o.*")
    return stacked.filter(F.col("label").isNotNull()).distinct()


def regions_by_city(df: DataFrame) -> DataFrame:
    """The sorted regions of every city in long form (city, pos, region): distinct pairs,
    numbered per city. No list is collected, and copies are dropped before the shuffle."""
    pairs = df.filter(F.col("city").isNotNull() & F.col("region").isNotNull()).select("city", "region").distinct()
    place = F.row_number().over(Window.partitionBy("city").orderBy("region")) - 1
    return pairs.select("city", place.alias("pos"), "region")


# ---------------------------------------------------------------------------
# Exact quantiles without a whole group in one task
# ---------------------------------------------------------------------------


def value_ranges(df: DataFrame, value: str, group_cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """Distinct (group, value) rows with ``_n`` copies, dealt by range, with their range ``_p``;
    and the ranges of each group with ``_rows`` (copies in it), ``_offset`` (copies in the ranges
    before it) and ``_size`` (copies in the group).

    Both frames read one shuffle (a reused exchange). Its number of ranges is the session's and is stated,
    so no coalescing renumbers them; ``ranked`` fails a query that would read two different ones."""
    g, v = list(group_cols), F.col(value)
    copies = F.sum("_n") if "_n" in df.columns else F.count(F.lit(1))
    valid = v.isNotNull() if dict(df.dtypes)[value] == "string" else v.isNotNull() & ~F.isnan(v.cast("double"))
    counts = df.filter(valid).groupBy(*g, value).agg(copies.alias("_n"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = counts.repartitionByRange(n, *g, value).withColumn("_p", F.spark_partition_id())
    # at most one row per group and range that holds some of it
    totals = ranged.groupBy(*g, "_p").agg(F.sum("_n").alias("_rows"))
    whole = Window.partitionBy(*g)
    before = whole.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *g, "_p", "_rows", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"), F.sum("_rows").over(whole).alias("_size"))
    return ranged, totals


def ranked(rows: DataFrame, value: str, group_cols: list[str]) -> DataFrame:
    """Ranks ``_first`` of range rows joined with their ranges: the offset of the range and the
    copies of smaller values in it."""
    part = Window.partitionBy(*group_cols, "_p")
    before = part.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    same = F.when(F.sum("_n").over(part) == F.col("_rows"), F.col("_offset")).otherwise(
        F.raise_error(F.lit("ranges of values were dealt twice")).cast("long"))
    return rows.withColumn("_first", same + F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_offset", "_rows", "_p")


def ranked_values(df: DataFrame, value: str, group_cols: list[str] | None = None) -> DataFrame:
    """Distinct (group, value) rows with ``_n`` copies, ``_first`` (0-based rank of the
    first copy within the group) and ``_size`` (non-null rows in the group). A column ``_n`` of
    ``df`` counts as the copies of its row.

    Plan: distinct (group, value) counts (partial aggregation); these are dealt by range, so a
    group of any size lies in consecutive ranges; ranges are counted, and a running sum over the
    few counts of a group gives each range its offset, which is joined back. Running
    counts need one window per (group, range). A hot value is one row, a hot group many ranges."""
    g = list(group_cols or [])
    ranged, totals = value_ranges(df, value, g)
    return ranked(ranged.join(totals, [*g, "_p"]), value, g)


def exact_quantiles(
    df: DataFrame,
    value: str,
    qs: list[float],
    group_cols: list[str] | None = None,
) -> DataFrame:
    """Exact quantiles (numpy's linear interpolation, bit for bit) of ``value`` per group,
    as columns ``q0..q{k-1}`` plus ``n`` (non-null count).

    The ranges' offsets tell which ranges hold the order statistics that some quantile needs; only
    those ranges are ranked, and the final aggregate sees at most two values per quantile and group."""
    g = list(group_cols or [])
    v = F.col(value)
    ranged, totals = value_ranges(df, value, g)
    wanted = []
    for i, q in enumerate(qs):
        pos = F.lit(float(q)) * (F.col("_size") - 1)
        for side, r in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            wanted.append(F.struct(F.lit(i).alias("qi"), F.lit(side).alias("side"), r.cast("long").alias("rank")))
    held = F.filter(F.array(*wanted), lambda w: (w["rank"] >= F.col("_offset")) & (w["rank"] < F.col("_offset") + F.col("_rows")))
    totals = totals.withColumn("_wanted", held).filter(F.size("_wanted") > 0)
    rows = ranked(ranged.join(totals, [*g, "_p"]), value, g)
    first = F.col("_first")
    hit = F.filter("_wanted", lambda w: (w["rank"] >= first) & (w["rank"] < first + F.col("_n")))
    picked = rows.select(*g, "_size", v.cast("double").alias("_v"), F.explode(hit).alias("w"))
    per_q = picked.groupBy(*g, "_size", F.col("w.qi").alias("qi")).agg(
        F.max(F.when(F.col("w.side") == "lo", F.col("_v"))).alias("v_lo"),
        F.max(F.when(F.col("w.side") == "hi", F.col("_v"))).alias("v_hi"),
    )
    qarr = F.array(*[F.lit(float(q)) for q in qs])
    pos = F.element_at(qarr, F.col("qi") + 1) * (F.col("_size") - 1)
    # numpy's interpolation, bit for bit: lerp from the nearer end
    t = pos - F.floor(pos)
    diff = F.col("v_hi") - F.col("v_lo")
    per_q = per_q.withColumn("qv", F.when(t < 0.5, F.col("v_lo") + diff * t).otherwise(F.col("v_hi") - diff * (1 - t)))
    wide = per_q.groupBy(*g, "_size").agg(*[F.max(F.when(F.col("qi") == i, F.col("qv"))).alias(f"q{i}") for i in range(len(qs))])
    return wide.withColumnRenamed("_size", "n")


def stacked(
    df: DataFrame, columns: list[str], name: str = "column_name", value: str = "value", keep: list[str] | None = None
) -> DataFrame:
    """Long form (column_name, value) of several numeric columns, for one grouped pass; ``keep``
    columns go along."""
    items = [F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in columns]
    return df.select(*(keep or []), F.explode(F.array(*items)).alias("_s")).select(*(keep or []), "_s.*")
