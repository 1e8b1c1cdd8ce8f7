"""Result tables: invariants, twins against the literal formulations, edge cases."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import raw_frame
from tillroll.operators import baskets as bk
from tillroll.operators import customers as cu
from tillroll.operators import sales as sa
from tillroll.operators.clean import clean
from tillroll.plans.registry import ANALYSES, LINE_GRAIN, RESULT_NAMES
from tillroll.sources.fixtures import brand_order_lines


def _total(df, col):
    return df.agg(F.sum(col)).first()[0]


def test_sales_totals_agree(clean_small):
    totals = [
        _total(sa.daily_sales(clean_small), "DailySalesAmount"),
        _total(sa.country_sales(clean_small), "SalesAmount"),
        _total(sa.hourly_orders(clean_small), "HourlySalesAmount"),
        _total(sa.monthly_sales_trend(clean_small), "sales"),
        _total(sa.product_seasonality(clean_small), "MonthlySalesAmount"),
        _total(sa.country_sales_growth(clean_small), "sales"),
        _total(cu.customer_frequency(clean_small), "TotalSpending"),
    ]
    assert all(math.isclose(t, totals[0], rel_tol=1e-12) for t in totals)
    qty = _total(sa.daily_sales(clean_small), "DailyTotalQuantity")
    assert qty == _total(sa.product_seasonality(clean_small), "MonthlyQuantity")


def test_new_customers_sum_to_customer_count(clean_small):
    n_customers = clean_small.select("CustomerID").distinct().count()
    assert _total(cu.first_purchase_distribution(clean_small), "NewCustomers") == n_customers


def test_first_purchase_matches_row_number_twin(clean_small):
    w = Window.partitionBy("CustomerID").orderBy("InvoiceDateTime")
    twin = (
        clean_small.withColumn("rn", F.row_number().over(w))
        .filter("rn = 1")
        .groupBy(F.date_format("InvoiceDateTime", "yyyy-MM").alias("first_month"))
        .agg(F.countDistinct("CustomerID").alias("NewCustomers"))
    )
    got = cu.first_purchase_distribution(clean_small)
    assert got.exceptAll(twin).count() == 0 and twin.exceptAll(got).count() == 0


def _lag_gap(df, ts_df):
    w = Window.partitionBy("CustomerID").orderBy("ts")
    return (
        ts_df.withColumn("prev", F.lag("ts").over(w))
        .filter(F.col("prev").isNotNull())
        .agg(F.avg(F.datediff("ts", "prev")))
        .first()[0]
    )


def test_telescoped_gap_matches_lag_twin(clean_small):
    lines = clean_small.select("CustomerID", F.col("InvoiceDateTime").alias("ts"))
    want = _lag_gap(clean_small, lines)
    got = cu.repurchase_gap_lines(clean_small).first().value
    assert got == pytest.approx(want, rel=1e-12)
    orders = clean_small.groupBy("CustomerID", "InvoiceNo").agg(F.min("InvoiceDateTime").alias("ts"))
    want_o = _lag_gap(clean_small, orders)
    got_o = cu.repurchase_gap_orders(clean_small).first().value
    assert got_o == pytest.approx(want_o, rel=1e-12)


def test_rfm_quartiles_match_window_ntile_twin(clean_small):
    got = cu.rfm_segments(clean_small)
    scores = cu.rfm_scores(clean_small)
    twin = (
        scores.withColumn("R", F.ntile(4).over(Window.orderBy(F.col("RecencyDays").asc(), "CustomerID")))
        .withColumn("Fq", F.ntile(4).over(Window.orderBy(F.col("Frequency").desc(), "CustomerID")))
        .withColumn("M", F.ntile(4).over(Window.orderBy(F.col("Monetary").desc(), "CustomerID")))
    )
    joined = got.join(twin.select("CustomerID", "R", "Fq", "M"), "CustomerID")
    assert joined.count() == 142
    bad = joined.filter((F.col("R_q") != F.col("R")) | (F.col("F_q") != F.col("Fq")) | (F.col("M_q") != F.col("M")))
    assert bad.count() == 0


def test_rfm_segment_rules(clean_small):
    rows = cu.rfm_segments(clean_small).collect()
    for r in rows:
        if r.R_q <= 2 and r.F_q <= 2 and r.M_q <= 2:
            assert r.RFM_Segment == "HIGH_VALUE"
        elif r.R_q <= 2 and r.F_q <= 2:
            assert r.RFM_Segment == "HIGH_POTENTIAL"
        elif r.R_q >= 3 and r.F_q <= 2:
            assert r.RFM_Segment == "WIN_BACK"
        elif r.F_q >= 3 and r.M_q <= 2:
            assert r.RFM_Segment == "REGULAR"
        else:
            assert r.RFM_Segment == "CHURN_RISK"


def test_rfm_reference_labels(clean_small):
    labels = {r.RFM_Segment for r in cu.rfm_segments(clean_small, labels=cu.SEGMENT_LABELS_ZH).collect()}
    assert labels <= set(cu.SEGMENT_LABELS_ZH.values())


def _lines(spark, rows):
    return clean(raw_frame(spark, rows))


def test_rfm_fewer_customers_than_buckets(spark):
    df = _lines(spark, [
        ("1", "A", "x", 2, "2011-01-01 10:00:00", 1.0, "a", "UK"),
        ("2", "A", "x", 1, "2011-02-01 10:00:00", 5.0, "b", "UK"),
        ("3", "A", "x", 1, "2011-02-03 10:00:00", 5.0, "b", "UK"),
    ])
    rows = {r.CustomerID: r for r in cu.rfm_segments(df).collect()}
    assert (rows["b"].RecencyDays, rows["b"].Frequency, rows["b"].R_q) == (0, 2, 1)
    assert (rows["a"].RecencyDays, rows["a"].R_q, rows["a"].F_q, rows["a"].M_q) == (33, 2, 2, 2)


def test_growth_uses_previous_present_period_and_null_on_zero(spark):
    df = _lines(spark, [
        ("1", "A", "x", 1, "2011-01-05 10:00:00", 10.0, "a", "UK"),
        ("2", "A", "x", 1, "2011-03-05 10:00:00", 15.0, "a", "UK"),  # February absent
        ("3", "A", "x", 1, "2012-03-05 10:00:00", 30.0, "a", "UK"),
        ("4", "A", "x", 1, "2011-03-05 10:00:00", 10.0, "b", "FR"),
    ])
    mom = {r.ym: r.mom_pct for r in sa.monthly_sales_trend(df).collect()}
    assert mom["2011-01"] is None and mom["2011-03"] == pytest.approx(150.0)
    assert mom["2012-03"] == pytest.approx(20.0)
    yoy = {(r.Country, r.yr): (r.prev_sales, r.yoy_pct) for r in sa.country_sales_growth(df).collect()}
    assert yoy[("UK", 2012)] == (25.0, pytest.approx(20.0))
    assert yoy[("FR", 2011)] == (None, None)


def test_growth_pct_zero_previous(spark):
    from tillroll.functions.columns import growth_pct

    df = spark.createDataFrame([(5.0, 0.0), (5.0, None), (6.0, 4.0)], "c double, p double")
    got = [r.g for r in df.select(growth_pct("c", "p").alias("g")).collect()]
    assert got == [None, None, 50.0]


def test_top20_splits_code_by_description(spark):
    df = _lines(spark, [
        ("1", "22197", "POPCORN HOLDER", 5, "2011-01-05 10:00:00", 1.0, "a", "UK"),
        ("2", "22197", "SMALL POPCORN HOLDER", 7, "2011-01-05 10:00:00", 1.0, "a", "UK"),
    ])
    got = [(r.StockCode, r.Description, r.TotalSalesQuantity) for r in sa.top_products(df).collect()]
    assert got == [("22197", "SMALL POPCORN HOLDER", 7), ("22197", "POPCORN HOLDER", 5)]


def test_customer_frequency_average_is_per_line(spark):
    df = _lines(spark, [
        ("1", "A", "x", 1, "2011-01-05 10:00:00", 10.0, "a", "UK"),
        ("1", "B", "x", 1, "2011-01-05 10:00:00", 20.0, "a", "UK"),
        ("2", "A", "x", 3, "2011-01-06 10:00:00", 10.0, "a", "UK"),
    ])
    r = cu.customer_frequency(df).first()
    assert (r.PurchaseFrequency, r.TotalSpending, r.AvgOrderSpending) == (2, 60.0, 20.0)


def test_hourly_absent_hours_absent(clean_small):
    hours = [r.InvoiceHour for r in sa.hourly_orders(clean_small).collect()]
    assert hours == [f"{h:02d}" for h in range(6, 21)]


def test_user_behavior_summary_layout(clean_small):
    rows = cu.user_behavior_summary(clean_small).collect()
    assert [r.metric for r in rows] == [
        "customer_cnt", "repeat_customers", "repurchase_rate",
        "order_value_p25", "order_value_p50", "order_value_p75",
        "avg_repurchase_gap_days",
    ]
    m = {r.metric: r.value for r in rows}
    assert m["customer_cnt"] == 142.0
    assert m["repurchase_rate"] == pytest.approx(m["repeat_customers"] / 142.0)
    assert m["order_value_p25"] <= m["order_value_p50"] <= m["order_value_p75"]


def test_approx_quantiles_within_rank_bound(clean_small):
    values = sorted(r.order_value for r in cu.order_values(clean_small).collect())
    n = len(values)
    approx = {r.metric: r.value for r in cu.order_value_quantiles_approx(clean_small).collect()}
    for name, p in zip(cu.QUANTILE_METRICS, cu.QUANTILE_PROBS):
        lo = values[max(0, math.floor(p * n - 0.05 * n) - 1)]
        hi = values[min(n - 1, math.ceil(p * n + 0.05 * n))]
        assert lo <= approx[name] <= hi


def test_empty_clean_table_analyses(spark):
    df = _lines(spark, [])
    assert sa.daily_sales(df).count() == 0
    assert cu.rfm_segments(df).count() == 0
    m = {r.metric: r.value for r in cu.user_behavior_summary(df).collect()}
    assert m["customer_cnt"] == 0.0 and m["order_value_p50"] is None
    assert bk.association_rules(df).count() == 0


def test_brand_rules_are_pairs_only(spark, sf_small):
    # The pairwise/triple SQL oracle is complete only if no larger itemset is frequent.
    lines = brand_order_lines(spark, sf_small)
    sizes = bk.frequent_itemsets(lines, 0.01, item_col="p_brand").agg(F.max("size")).first()[0]
    assert sizes <= 3


def test_stockcode_rules_empty_at_default_thresholds(clean_small):
    assert bk.association_rules(clean_small).count() == 0


def test_rules_metrics_consistent(spark, sf_small):
    rules = bk.association_rules(brand_order_lines(spark, sf_small), 0.01, 0.1, item_col="p_brand")
    for r in rules.limit(50).collect():
        assert r.confidence >= 0.1 and r.support >= 0.01 and r.lift > 0
        assert "," not in r.consequent_str


@pytest.mark.parametrize("name", sorted(set(RESULT_NAMES) - LINE_GRAIN))
def test_invoice_rollup_gives_identical_results(clean_small, name):
    from tillroll.operators.rollup import invoice_rollup

    fn = dict(ANALYSES)[name]
    direct = fn(clean_small)
    rolled = fn(invoice_rollup(clean_small))
    assert rolled.columns == direct.columns
    assert direct.exceptAll(rolled).count() == 0 and rolled.exceptAll(direct).count() == 0


def test_rollup_is_smaller_than_lines(clean_small):
    from tillroll.operators.rollup import invoice_rollup

    rolled = invoice_rollup(clean_small)
    assert rolled.count() < clean_small.count()
    assert rolled.agg(F.sum("Lines")).first()[0] == clean_small.count()


def test_single_customer(spark):
    df = _lines(spark, [
        ("1", "A", "x", 1, "2011-01-05 10:00:00", 10.0, "a", "UK"),
        ("2", "B", "y", 2, "2011-01-15 11:00:00", 5.0, "a", "UK"),
    ])
    r = cu.rfm_segments(df).first()
    assert (r.RecencyDays, r.Frequency, r.Monetary, r.R_q, r.F_q, r.M_q, r.RFM_Segment) == (
        0, 2, 20.0, 1, 1, 1, "HIGH_VALUE")
    m = {x.metric: x.value for x in cu.user_behavior_summary(df).collect()}
    assert m["customer_cnt"] == 1.0 and m["repurchase_rate"] == 1.0
    assert m["order_value_p25"] == 10.0 and m["order_value_p75"] == 10.0
    assert m["avg_repurchase_gap_days"] == 10.0


def test_frequent_itemsets_and_basket_table(spark, sf_small, clean_small):
    lines = brand_order_lines(spark, sf_small)
    sets = bk.frequent_itemsets(lines, 0.01, item_col="p_brand")
    singles = sets.filter("size = 1").count()
    assert singles > 0 and sets.filter("size = 2").count() > 0
    table = bk.basket_table(clean_small)
    assert table.filter("n_items < 2").count() == 0
    row = table.first()
    assert row.items_str.split(",") == sorted(row.items_str.split(","))


def test_country_counts_with_null_country_and_invoice(spark):
    rows = [("1", None, "a", 1.0), ("1", None, "b", 2.0), (None, "UK", "a", 3.0), ("2", "UK", None, 4.0)]
    df = spark.createDataFrame(
        [(i, co, cu_, v, 1) for i, co, cu_, v in rows],
        "InvoiceNo string, Country string, CustomerID string, TotalAmount double, Quantity long",
    )
    got = {r.Country: tuple(r)[1:] for r in sa.country_sales(df).collect()}
    assert got == {None: (1, 3.0, 2), "UK": (1, 7.0, 1)}


def test_mining_keeps_every_basket_and_only_frequent_items(spark):
    rows = [(f"b{i}", x) for i in range(10) for x in ("p", "q")] + [("b0", "rare"), ("z", "p")]
    rows += [("r", "r1"), ("r", "r2"), ("r", None)]
    df = spark.createDataFrame(rows + rows, "InvoiceNo string, StockCode string")
    blocks, total, least = bk.mining_blocks(df, 0.5, "InvoiceNo", "StockCode")
    row = blocks.first()
    assert (total, least) == (11, 6)  # the one-item basket z is gone
    assert (row.baskets, row.items, row.sizes) == (11, ["p", "q"], [10, 10])
    rules = {r.antecedent_str: r.support for r in bk.association_rules(df, 0.5, 0.2).collect()}
    assert rules == {"p": 10 / 11, "q": 10 / 11}


@pytest.mark.parametrize("analysis", [cu.rfm_scores, cu.user_behavior_summary])
def test_lines_are_read_once(spark, analysis):
    """What comes before an analysis runs once, for whatever it is read several times."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    lines = clean(raw_frame(spark, [(str(k), "a", "x", 1, "2010-12-01 08:26:00", 1.0 + k, str(k % 3), "UK") for k in range(9)]))
    lines = lines.select("CustomerID", "InvoiceNo", "InvoiceDateTime", "TotalAmount")
    assert analysis(lines.mapInArrow(count, lines.schema)).collect()
    assert seen.value == 9
