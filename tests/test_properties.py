"""Property tests: equivalent formulations agree on random subscription sets."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators import metrics, periods

AS_OF = dt.date(2024, 12, 15)
SCHEMA = ("subscription_id string, customer_id string, plan_name string, monthly_price decimal(18,2), "
          "status string, start_date date, end_date date, effective_end_date date")

day = st.dates(min_value=dt.date(2023, 1, 1), max_value=dt.date(2025, 6, 30))
sub = st.tuples(
    st.sampled_from(["starter", "growth", None]),
    st.one_of(st.none(), st.integers(0, 500).map(lambda c: Decimal(c))),
    st.sampled_from(["active", "cancelled", "paused"]),
    st.one_of(st.none(), day),
    st.one_of(st.none(), day))


def _frame(spark, rows):
    data = [(f"S{i}", "C1", plan, price, status, start, None, end)
            for i, (plan, price, status, start, end) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(sub, min_size=0, max_size=25))
def test_mrr_forms_and_churn_agree(spark, rows):
    eff = _frame(spark, rows)
    grain = periods.subscription_months(eff, AS_OF)
    a = sorted(map(tuple, metrics.mrr_by_month_plan(grain).collect()), key=str)
    b = sorted(map(tuple, metrics.mrr_running_sum(eff, AS_OF).collect()), key=str)
    assert a == b
    totals = {r.month_start: r for r in grain.groupBy("month_start")
              .agg(F.count("*").alias("n"), F.sum("monthly_price").alias("p")).collect()}
    for r in metrics.churn_base(eff, AS_OF).collect():
        assert r.month_start in totals
        prev = totals.get(dt.date(r.month_start.year - (r.month_start.month == 1),
                                  12 if r.month_start.month == 1 else r.month_start.month - 1, 1))
        assert r.active_subscriptions_start == (prev.n if prev else 0)
        assert r.mrr_start == ((prev.p or 0) if prev else 0)
    assert len(totals) == metrics.churn_base(eff, AS_OF).count()
