"""Plan checks: the physical plans have the shape the operators were designed for."""

import pytest
from pyspark.sql import functions as F

from kvadrat import schema as S
from kvadrat.operators import cleaning as C
from kvadrat.operators import stats as E
from kvadrat.plans import frames, registry


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_shuffles_once_on_the_digest(spark, sf_dir):
    plan = _plan(C.dedup_keep_first(frames.raw(spark, sf_dir)))
    assert plan.count("hashpartitioning(_d1") == 1 and "hashpartitioning(title" not in plan
    assert "SortAggregate(key=[title" not in plan and plan.count("lineitem.parquet") == plan.count("part.parquet") == 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan and "MapInPandas" not in plan


def test_exact_duplicates_hash_fixed_width(spark, sf_dir):
    plan = _plan(C.exact_duplicates(frames.raw(spark, sf_dir)))
    assert "SortAggregate" not in plan and "HashAggregate(keys=[_d1" in plan


@pytest.mark.parametrize("name", ["c3_concat_deduped", "c4_quality_filter", "c5_cleaning_summary", "e5_value_counts_top", "e6_before_after_counts", "e13_pearson"])
def test_raw_against_cleaned_joins_the_listings_once(spark, sf_dir, name):
    assert _plan(registry.queries()[name](spark, sf_dir)).count("lineitem.parquet") == 1


def test_ranks_are_dealt_by_range_and_the_shuffle_is_shared(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 1000).cast("double").alias("v"))
    ranks = E.ranked_values(df, "v", ["g"])
    assert ranks.count() == 3000
    ranks.collect()
    plan = ranks._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    assert "rangepartitioning(g" in plan and "ReusedExchange" in plan and "percentile" not in plan
    top = {(r["g"], r["v"]): r["_first"] for r in ranks.collect()}
    want = {}
    for g in range(3):
        values = sorted(float(i * 7 % 1000) for i in range(5000) if i % 3 == g)
        want |= {(g, v): values.index(v) for v in set(values)}
    assert top == want


def test_cleaning_summary_is_one_aggregate_shuffle(spark, sf_dir):
    plan = _plan(C.cleaning_summary(frames.raw(spark, sf_dir)))
    assert plan.count("hashpartitioning(") == 1


def test_rows_are_dealt_before_listings_are_made_of_them(spark, sf_dir):
    for df in (frames.sets(spark, sf_dir, ["area_m2"]), frames.model(spark, sf_dir, deal=True)):
        plan = _plan(df)
        assert plan.count("hashpartitioning(l_orderkey") == 1 and "RoundRobinPartitioning" not in plan
        assert plan.index("_d1") < plan.index("p_partkey") < plan.index("hashpartitioning(l_orderkey")
    rows = [sorted(map(str, frames.raw(spark, sf_dir, deal).drop("_ord").collect())) for deal in (False, True)]
    assert rows[0] == rows[1]


def test_dealt_rows_are_placed_by_their_id_for_the_fits(spark, sf_dir):
    from kvadrat.plans import queries_model

    rows = queries_model._split(spark, sf_dir, deal=True)
    places = rows.select("_row").rdd.glom().map(lambda part: [r[0] for r in part]).collect()
    assert places and all(part == sorted(part) for part in places)
    old = queries_model._split(spark, sf_dir)
    assert sorted(map(str, rows.collect())) == sorted(map(str, old.collect()))


def test_scan_reads_only_needed_columns(spark, sf_dir):
    plan = _plan(frames.raw(spark, sf_dir).select("city", "price_eur"))
    scan = [line for line in plan.splitlines() if "lineitem.parquet" in line][0]
    assert "l_tax" not in scan and "l_discount" not in scan and "l_extendedprice" in scan


def test_exact_quantiles_never_use_single_task_percentile(spark, sf_dir):
    q = E.exact_quantiles(frames.cleaned(spark, sf_dir), "price_eur", [0.5], ["city"])
    plan = q._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan.replace("percentile_approx(", "")


def test_statistics_stay_jvm_side(spark, sf_dir):
    for df in [
        E.describe(frames.raw(spark, sf_dir)),
        E.corr_matrix(frames.model(spark, sf_dir)),
        E.histogram(frames.raw(spark, sf_dir), "price_eur"),
    ]:
        plan = _plan(df)
        assert "Python" not in plan


def test_small_broadcasts_only(spark, sf_dir):
    top = E.top_k_semi_join(frames.model(spark, sf_dir), frames.cleaned(spark, sf_dir), "city", 8)
    plan = _plan(top)
    assert "BroadcastHashJoin LeftSemi" in plan or "BroadcastExchange" in plan


def test_frames_are_partition_independent(spark, sf_dir):
    a = C.cleaning_summary(frames.raw(spark, sf_dir)).first()
    b = C.cleaning_summary(frames.raw(spark, sf_dir).repartition(3)).first()
    assert a == b
    cols = S.RAW_COLUMNS
    cleaned = frames.cleaned(spark, sf_dir).select(*cols)
    assert cleaned.filter(~F.col("area_m2").between(*S.AREA_RANGE)).count() == 0


@pytest.mark.parametrize("name", ["p7_options_fallback", "p7_options_all_regions"])
def test_options_clean_the_listings_once(spark, sf_dir, name, monkeypatch):
    """The regions are written once and read from there; the texts of listings are not carried."""
    from kvadrat.operators import scoring

    written = []
    monkeypatch.setattr(scoring, "checkpointed", lambda df, f=scoring.checkpointed: (written.append(_plan(df)), f(df))[1])
    plan = _plan(registry.queries()[name](spark, sf_dir))
    assert "_d1" not in plan and sum("hashpartitioning(_d1" in p for p in written) == 1
    for p in written:
        assert "p_name" not in [line for line in p.splitlines() if "Exchange hashpartitioning(_d1" in line] and "_first.title" not in p
