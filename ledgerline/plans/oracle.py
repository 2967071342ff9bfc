"""Independent DuckDB SQL formulations of every registered query.

These are the correctness oracle: written from the semantics, in plain SQL
against the raw test-data views, deliberately *not* sharing the Spark code's
tricks (months are integers and every month counts the windows open in it,
existence is ``EXISTS``, the expected check suite is spelled out).  ``sql(name)`` returns one
self-contained statement with only the CTEs it needs.
"""

from __future__ import annotations

_CURSOR = "COALESCE(TRY_CAST(NULLIF({c}, '') AS TIMESTAMP), TIMESTAMP '2024-01-01')"


def _rate_sql(num: str, den: str) -> str:
    """num / den to four places as a written division: whole ten-thousandths,
    one more when the remainder is at least half the divisor; NULL on 0."""
    n, d = f"CAST({num} AS HUGEINT) * 10000", f"CAST({den} AS HUGEINT)"
    return (f"CASE WHEN {den} <> 0 THEN CAST(({n}) // {d} + (CASE WHEN 2 * (({n}) % {d}) >= {d} THEN 1 ELSE 0 END)"
            f" AS DECIMAL(34,0)) * CAST(0.0001 AS DECIMAL(4,4)) END")


CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


# ---------------------------------------------------------------- raw layer
cte("raw_customers_base", [], """
  SELECT c.c_custkey AS k, c.c_name, n.n_name
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
cte("raw_customers_rows", ["raw_customers_base"], """
  SELECT 2 * k AS _row_id, k FROM raw_customers_base
  UNION ALL
  SELECT 2 * k + 1 AS _row_id, k FROM raw_customers_base WHERE k % 50 = 0""")
cte("raw_customers", ["raw_customers_rows"], f"""
  SELECT _row_id, customer_id, customer_name, email, country, created_at,
         {_CURSOR.format(c='created_at')} AS updated_at
  FROM (
    SELECT r._row_id, 'C' || CAST(b.k AS VARCHAR) AS customer_id, b.c_name AS customer_name,
           'c' || CAST(b.k AS VARCHAR) || '@example.com' AS email,
           CASE WHEN b.k % 37 = 0 THEN '' ELSE b.n_name END AS country,
           CASE WHEN b.k % 499 = 0 THEN '2031-01-01'
                ELSE CAST(DATE '1995-01-01' + CAST(b.k % 2000 AS INTEGER) AS VARCHAR) END AS created_at
    FROM raw_customers_rows r JOIN raw_customers_base b ON b.k = r.k)""")
cte("raw_subscriptions_base", [], """
  SELECT o_orderkey AS k,
         'S' || CAST(o_orderkey AS VARCHAR) AS subscription_id,
         CASE WHEN o_orderkey % 211 = 0 THEN 'C-orphan' ELSE 'C' || CAST(o_custkey AS VARCHAR) END AS customer_id,
         o_orderpriority AS plan_name,
         CAST(CASE WHEN o_orderkey % 97 = 0 THEN -CAST(o_totalprice AS DECIMAL(18,2))
                   ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS VARCHAR) AS monthly_price,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS start_date,
         CASE WHEN o_orderstatus <> 'F' OR o_orderkey % 83 = 0 THEN ''
              WHEN o_orderkey % 89 = 0 THEN CAST(CAST(o_orderdate AS DATE) - 10 AS VARCHAR)
              ELSE CAST(CAST(o_orderdate AS DATE) + CAST(30 + o_orderkey % 700 AS INTEGER) AS VARCHAR)
         END AS end_date,
         CASE WHEN o_orderkey % 71 = 0 THEN UPPER(st) || ' ' ELSE st END AS status
  FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'cancelled' WHEN 'P' THEN 'paused'
                                     WHEN 'O' THEN 'active' END AS st FROM orders)""")
cte("raw_subscriptions", ["raw_subscriptions_base"], f"""
  SELECT _row_id, subscription_id, customer_id, plan_name, monthly_price, start_date, end_date,
         status, {_CURSOR.format(c='start_date')} AS updated_at
  FROM (SELECT 2 * k AS _row_id, * EXCLUDE (k) FROM raw_subscriptions_base
        UNION ALL
        SELECT 2 * k + 1 AS _row_id, * EXCLUDE (k) FROM raw_subscriptions_base WHERE k % 101 = 0)""")
cte("raw_invoice_lines", [], """
  SELECT l_orderkey, l_linenumber, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS amt,
         MAX(l_returnflag) AS rf, MAX(l_linestatus) AS ls
  FROM lineitem GROUP BY l_orderkey, l_linenumber""")
cte("raw_invoices", ["raw_invoice_lines"], f"""
  SELECT *, {_CURSOR.format(c='invoice_date')} AS updated_at FROM (
    SELECT l.l_orderkey * 100 + l.l_linenumber AS _row_id,
           'I' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS invoice_id,
           CASE WHEN l.l_orderkey % 601 = 0 THEN 'S-orphan' ELSE 'S' || CAST(l.l_orderkey AS VARCHAR) END
             AS subscription_id,
           CAST(CAST(o.o_orderdate AS DATE) + CAST((l.l_linenumber - 1) * 30 AS INTEGER) AS VARCHAR) AS invoice_date,
           CASE WHEN (l.l_orderkey * 7 + l.l_linenumber) % 503 = 0 THEN ''
                ELSE CAST(CASE WHEN l.l_orderkey % 97 = 0 THEN -l.amt ELSE l.amt END AS VARCHAR) END AS amount,
           CASE WHEN l.l_orderkey % 613 = 0 THEN 'USD'
                WHEN l.rf = 'R' AND l.l_orderkey % 5 = 0 THEN 'SEK' ELSE 'EUR' END AS currency,
           CASE WHEN l.ls = 'F' THEN (CASE WHEN l.l_orderkey % 67 = 0 THEN 'PAID ' ELSE 'paid' END)
                WHEN l.rf = 'A' THEN 'failed' ELSE 'open' END AS status
    FROM raw_invoice_lines l JOIN orders o ON l.l_orderkey = o.o_orderkey)""")

# ------------------------------------------------------------ staging layer
cte("stg_customers", ["raw_customers"], """
  SELECT customer_id, customer_name, email, country, created_at FROM (
    SELECT customer_id, customer_name, email, NULLIF(country, '') AS country,
           TRY_CAST(NULLIF(created_at, '') AS DATE) AS created_at,
           ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY _row_id) AS rn
    FROM raw_customers) WHERE rn = 1""")
cte("stg_subscriptions", ["raw_subscriptions", "raw_customers"], """
  SELECT subscription_id, customer_id, plan_name, ABS(price_raw) AS monthly_price,
         COALESCE(price_raw < 0, FALSE) AS had_negative_price_defect,
         start_date, CASE WHEN end_raw < start_date THEN NULL ELSE end_raw END AS end_date,
         status,
         EXISTS (SELECT 1 FROM raw_customers c WHERE c.customer_id = s.customer_id) AS has_valid_customer,
         updated_at
  FROM (SELECT subscription_id, customer_id, plan_name,
               TRY_CAST(NULLIF(monthly_price, '') AS DECIMAL(18,2)) AS price_raw,
               TRY_CAST(NULLIF(start_date, '') AS DATE) AS start_date,
               TRY_CAST(NULLIF(end_date, '') AS DATE) AS end_raw,
               LOWER(TRIM(status)) AS status, updated_at,
               ROW_NUMBER() OVER (PARTITION BY subscription_id ORDER BY _row_id) AS rn
        FROM raw_subscriptions) s
  WHERE rn = 1""")
cte("stg_invoices", ["raw_invoices", "raw_subscriptions"], """
  SELECT invoice_id, subscription_id, TRY_CAST(NULLIF(invoice_date, '') AS DATE) AS invoice_date,
         ABS(a) AS amount, currency,
         CAST(CASE WHEN currency = 'EUR' THEN ABS(a)
                   WHEN currency = 'SEK' THEN ROUND(ABS(a) * 0.088, 2) END AS DECIMAL(18,2)) AS amount_eur,
         LOWER(TRIM(status)) AS status,
         a IS NULL AS had_missing_amount_defect,
         COALESCE(a < 0, FALSE) AS had_negative_amount_defect,
         EXISTS (SELECT 1 FROM raw_subscriptions s WHERE s.subscription_id = i.subscription_id)
           AS has_valid_subscription,
         updated_at
  FROM (SELECT *, TRY_CAST(NULLIF(amount, '') AS DECIMAL(18,2)) AS a FROM raw_invoices) i""")

# ------------------------------------------------------- intermediate layer
# Months are counted as integers (year * 12 + month - 1): a subscription is
# active in month x when opened <= x <= closed, and nothing else is needed.
AS_OF_X = 2001 * 12 + 7
_NEVER = 1 << 30


def _x(day: str) -> str:
    return f"(year({day}) * 12 + month({day}) - 1)"


# Three disjoint cases: the end is known, has to be inferred, or is still to come.
cte("effective_dates", ["stg_subscriptions", "stg_invoices"], """
  SELECT subscription_id, customer_id, plan_name, monthly_price, status, start_date, end_date,
         end_date AS effective_end_date, FALSE AS effective_end_date_is_inferred,
         had_negative_price_defect, has_valid_customer
  FROM stg_subscriptions WHERE end_date IS NOT NULL
  UNION ALL
  SELECT subscription_id, customer_id, plan_name, monthly_price, status, start_date, NULL,
         (SELECT MAX(billed.invoice_date) FROM stg_invoices billed
          WHERE billed.subscription_id = stopped.subscription_id), TRUE,
         had_negative_price_defect, has_valid_customer
  FROM stg_subscriptions stopped WHERE end_date IS NULL AND status = 'cancelled'
  UNION ALL
  SELECT subscription_id, customer_id, plan_name, monthly_price, status, start_date, NULL, NULL, FALSE,
         had_negative_price_defect, has_valid_customer
  FROM stg_subscriptions WHERE end_date IS NULL AND status IS DISTINCT FROM 'cancelled'""")
cte("active_windows", ["effective_dates"], f"""
  SELECT *, {_x('start_date')} AS opened, COALESCE({_x('effective_end_date')}, {_NEVER}) AS closed
  FROM effective_dates""")
cte("calendar", ["active_windows"], f"""
  SELECT CAST(x AS INTEGER) AS x, make_date(x // 12, x % 12 + 1, 1) AS month_start
  FROM (SELECT UNNEST(range((SELECT MIN(opened) FROM active_windows), {AS_OF_X} + 1)) AS x)""")
cte("subscription_months", ["active_windows", "calendar"], """
  SELECT subscription_id, customer_id, plan_name, monthly_price, month_start,
         CAST(last_day(month_start) + 1 AS DATE) AS month_end_exclusive
  FROM calendar, active_windows WHERE x BETWEEN opened AND closed""")
cte("mrr_by_month_plan", ["subscription_months"], """
  SELECT month_start, plan_name, CAST(SUM(monthly_price) AS DECIMAL(38,2)) AS mrr,
         COUNT(DISTINCT subscription_id) AS active_subscriptions
  FROM subscription_months GROUP BY month_start, plan_name""")
# One count per month over all windows: open in the month before, and cancelled in this one.
cte("churn_base", ["active_windows", "calendar"], f"""
  SELECT month_start,
         COUNT(subscription_id) FILTER (WHERE was_open) AS active_subscriptions_start,
         CAST(COALESCE(SUM(monthly_price) FILTER (WHERE was_open), 0) AS DECIMAL(38,2)) AS mrr_start,
         COUNT(subscription_id) FILTER (WHERE left_now) AS churned_subscriptions,
         CAST(COALESCE(SUM(monthly_price) FILTER (WHERE left_now), 0) AS DECIMAL(38,2)) AS churned_mrr
  FROM (SELECT month_start, subscription_id, monthly_price, x BETWEEN opened AND closed AS is_open,
               x - 1 BETWEEN opened AND closed AS was_open, status = 'cancelled' AND closed = x AS left_now
        FROM calendar, active_windows)
  GROUP BY month_start HAVING BOOL_OR(is_open)""")
cte("churn_rates", ["churn_base"], f"""
  SELECT month_start, active_subscriptions_start, churned_subscriptions,
         {_rate_sql('churned_subscriptions', 'active_subscriptions_start')} AS subscription_churn_rate,
         mrr_start, churned_mrr,
         {_rate_sql('(churned_mrr * 100)', '(mrr_start * 100)')} AS mrr_churn_rate
  FROM churn_base""")
cte("customer_revenue", ["stg_invoices", "stg_subscriptions"], """
  SELECT customer_id, COUNT(DISTINCT subscription_id) AS subscription_count, CAST(SUM(n) AS BIGINT) AS invoice_count,
         CAST(SUM(IF(paid_as = 'paid', eur, 0)) AS DECIMAL(38,2)) AS total_paid_eur,
         CAST(SUM(IF(paid_as = 'open', eur, 0)) AS DECIMAL(38,2)) AS total_open_eur,
         CAST(SUM(IF(paid_as = 'failed', eur, 0)) AS DECIMAL(38,2)) AS total_failed_eur
  FROM (SELECT subscription_id, status AS paid_as, COUNT(*) AS n, SUM(amount_eur) AS eur
        FROM stg_invoices GROUP BY ALL)
  JOIN (SELECT subscription_id, customer_id FROM stg_subscriptions) USING (subscription_id)
  GROUP BY customer_id""")
# The latest subscription comes first in the ordered list; one without a start is the latest of all.
_PLANS_OF = "NULLIF(array_to_string(list_sort(list_distinct(list(plan_name))), ', '), '')"
_LATEST_STATUS = "first({s}.status ORDER BY {s}.start_date DESC NULLS FIRST, {s}.subscription_id DESC NULLS FIRST)"
cte("subscription_summary", ["stg_subscriptions"], f"""
  SELECT customer_id, {_PLANS_OF} AS plan_mix, {_LATEST_STATUS.format(s='own')} AS current_subscription_status
  FROM stg_subscriptions own WHERE has_valid_customer GROUP BY customer_id""")
cte("customer_ltv", ["stg_customers", "stg_subscriptions", "stg_invoices"], f"""
  SELECT customer_id, customer_name, country, {_PLANS_OF} AS plan_mix,
         {_LATEST_STATUS.format(s='own')} AS current_subscription_status,
         COUNT(DISTINCT billed.subscription_id) AS subscription_count,
         CAST(COALESCE(SUM(amount_eur) FILTER (WHERE billed.status = 'paid'), 0) AS DECIMAL(38,2)) AS ltv,
         CAST(COALESCE(SUM(amount_eur) FILTER (WHERE billed.status = 'open'), 0) AS DECIMAL(38,2)) AS pending_revenue_eur,
         CAST(COALESCE(SUM(amount_eur) FILTER (WHERE billed.status = 'failed'), 0) AS DECIMAL(38,2)) AS failed_revenue_eur
  FROM stg_customers LEFT JOIN stg_subscriptions own USING (customer_id)
  LEFT JOIN stg_invoices billed ON billed.subscription_id = own.subscription_id
  GROUP BY customer_id, customer_name, country""")


def _order(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in CTES[n][0]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_ctes(needed: list[str], final: str) -> str:
    """``WITH <needed CTEs in dependency order> <final>``."""
    # Names that are not CTEs are the pre-registered base views.
    parts = [f"{n} AS ({CTES[n][1]}\n)" for n in _order([x for x in needed if x in CTES])]
    return ("WITH " + ",\n".join(parts) + "\n" + final) if parts else final


def select_all(name: str) -> str:
    return with_ctes([name], f"SELECT * FROM {name}")


ORACLES: dict[str, str] = {}


def register(name: str, sql: str) -> None:
    ORACLES[name] = sql


for _m in ["stg_customers", "stg_subscriptions", "stg_invoices", "effective_dates",
           "subscription_months", "mrr_by_month_plan", "churn_base", "churn_rates",
           "customer_revenue", "subscription_summary", "customer_ltv"]:
    register(_m, select_all(_m))
register("mrr_running_sum", select_all("mrr_by_month_plan"))
register("mrr_from_grain", select_all("mrr_by_month_plan"))


# ------------------------------------------------------- data-quality checks
# The expected suite, written here once more in SQL and not read from the
# library's list: a check that is wrong or missing there shows as a difference.
_STATUS = "'active', 'cancelled', 'paused'"


def _rows(model: str, where: str) -> str:
    return f"SELECT COUNT(*) FROM {model} WHERE {where}"


def _repeated(model: str, columns: str, where: str = "TRUE") -> str:
    return f"SELECT COUNT(*) FROM (SELECT {columns} FROM {model} WHERE {where} GROUP BY {columns} HAVING COUNT(*) > 1)"


def _unique(model: str, c: str) -> str:
    return _repeated(model, c, f"{c} IS NOT NULL")


def _foreign(model: str, c: str, allowed: str) -> str:
    return f"SELECT COUNT(DISTINCT {c}) FROM {model} WHERE {c} NOT IN ({allowed})"


def _homeless(model: str, c: str, parent: str) -> str:
    return f"SELECT COUNT(*) FROM {model} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM {parent} WHERE {c} IS NOT NULL)"


def _suite(entries: list[tuple]) -> str:
    """(name or None, model, kind, column, severity, SQL that counts the failures) per check."""
    selects = [f"SELECT '{name or f'{kind}_{model}_{column}'}' AS check_name, '{model}' AS model, '{kind}' AS kind, "
               f"{repr(column) if column else 'NULL'} AS column_name, '{severity}' AS severity, "
               f"CAST(({failures}) AS BIGINT) AS failures" for name, model, kind, column, severity, failures in entries]
    models = [e[1] for e in entries] + ["stg_subscriptions", "stg_customers", "raw_customers"]
    used = [m for m in dict.fromkeys(models) if m in [e[1] for e in entries] or any(m in e[5] for e in entries)]
    return with_ctes(used, "SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' "
                     "ELSE 'error' END AS status FROM (\n" + "\nUNION ALL\n".join(selects) + ")")


def _required(model: str, c: str) -> tuple:
    return None, model, "not_null", c, "error", _rows(model, f"{c} IS NULL")


def _single(model: str, c: str) -> tuple:
    return None, model, "unique", c, "error", _unique(model, c)


def _flagged(model: str, c: str, failing: str) -> tuple:
    return None, model, "flag_equals", c, "warn", _rows(model, f"COALESCE({c}, {failing}) = {failing}")


register("dq_column_checks", _suite([
    _single("stg_customers", "customer_id"),
    _required("stg_customers", "customer_id"),
    _required("stg_customers", "customer_name"),
    (None, "stg_customers", "not_future_date", "created_at", "warn",
     _rows("stg_customers", "created_at > DATE '2001-08-31'")),
    _single("stg_subscriptions", "subscription_id"),
    _required("stg_subscriptions", "subscription_id"),
    _required("stg_subscriptions", "customer_id"),
    (None, "stg_subscriptions", "relationships", "customer_id", "warn",
     _homeless("stg_subscriptions", "customer_id", "stg_customers")),
    _required("stg_subscriptions", "monthly_price"),
    _flagged("stg_subscriptions", "had_negative_price_defect", "TRUE"),
    _flagged("stg_subscriptions", "has_valid_customer", "FALSE"),
    (None, "stg_subscriptions", "accepted_values", "status", "error", _foreign("stg_subscriptions", "status", _STATUS)),
    _single("stg_invoices", "invoice_id"),
    _required("stg_invoices", "invoice_id"),
    _required("stg_invoices", "subscription_id"),
    (None, "stg_invoices", "relationships", "subscription_id", "warn",
     _homeless("stg_invoices", "subscription_id", "stg_subscriptions")),
    _flagged("stg_invoices", "had_missing_amount_defect", "TRUE"),
    _flagged("stg_invoices", "had_negative_amount_defect", "TRUE"),
    _flagged("stg_invoices", "has_valid_subscription", "FALSE"),
    (None, "stg_invoices", "accepted_values", "status", "error", _foreign("stg_invoices", "status", "'paid', 'failed', 'open'")),
    (None, "stg_invoices", "accepted_values", "currency", "error", _foreign("stg_invoices", "currency", "'EUR', 'SEK'")),
    _single("effective_dates", "subscription_id"),
    _required("effective_dates", "subscription_id"),
    _required("subscription_months", "month_start"),
    _single("customer_revenue", "customer_id"),
    _single("churn_base", "month_start"),
    _single("subscription_summary", "customer_id"),
    _required("subscription_summary", "customer_id"),
    (None, "subscription_summary", "accepted_values", "current_subscription_status", "error",
     _foreign("subscription_summary", "current_subscription_status", _STATUS)),
    _required("mrr_by_month_plan", "month_start"),
    _required("mrr_by_month_plan", "plan_name"),
    (None, "mrr_by_month_plan", "accepted_values", "plan_name", "error",
     _foreign("mrr_by_month_plan", "plan_name", "'starter', 'growth', 'scale'")),
    _required("mrr_by_month_plan", "mrr"),
    _single("customer_ltv", "customer_id"),
    _required("customer_ltv", "customer_id"),
    (None, "customer_ltv", "accepted_values", "current_subscription_status", "warn",
     _foreign("customer_ltv", "current_subscription_status", _STATUS)),
    _required("customer_ltv", "ltv"),
    _single("churn_rates", "month_start"),
    _required("churn_rates", "month_start"),
]))
register("dq_singular_checks", _suite([
    ("subscription_starts_before_it_ends", "stg_subscriptions", "expression", None, "error",
     _rows("stg_subscriptions", "start_date > end_date")),
    ("active_window_starts_before_it_ends", "effective_dates", "expression", None, "error",
     _rows("effective_dates", "start_date > effective_end_date")),
    ("billing_stops_with_the_subscription", "stg_invoices", "rows", None, "error",
     "SELECT COUNT(*) FROM stg_invoices JOIN stg_subscriptions USING (subscription_id) WHERE end_date < invoice_date"),
    ("mrr_is_zero_or_more", "mrr_by_month_plan", "expression", None, "error", _rows("mrr_by_month_plan", "mrr < 0")),
    ("ltv_is_zero_or_more", "customer_ltv", "expression", None, "error", _rows("customer_ltv", "ltv < 0")),
    ("churn_rates_are_shares", "churn_rates", "expression", None, "error",
     _rows("churn_rates", "subscription_churn_rate NOT BETWEEN 0 AND 1 OR mrr_churn_rate NOT BETWEEN 0 AND 1")),
    ("each_raw_customer_is_cleaned_once", "stg_customers", "row_count_matches", None, "error",
     "SELECT CAST((SELECT COUNT(*) FROM stg_customers) <> (SELECT COUNT(DISTINCT customer_id) FROM raw_customers) AS INTEGER)"),
    ("cancelled_windows_are_closed", "effective_dates", "expression", None, "warn",
     _rows("effective_dates", "status = 'cancelled' AND effective_end_date IS NULL")),
]))


# ---------------------------------------------------- incremental + history
cte("latest_event_per_user", [], """
  SELECT user_id, event_id, ts, event_type, value FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
  WHERE rn = 1""")
register("upsert_two_batches", select_all("latest_event_per_user"))
register("incremental_filter", with_ctes(["raw_invoices"], """
  SELECT * FROM raw_invoices
  WHERE updated_at >= (SELECT MAX(updated_at) FROM raw_invoices
                       WHERE updated_at < TIMESTAMP '1998-01-01 00:00:00')"""))
register("partitioned_upsert", with_ctes(["latest_event_per_user"], """
  SELECT *, CASE WHEN event_id % 7 <> 0 THEN CAST(ts AS DATE) END AS day FROM latest_event_per_user"""))
register("load_report", with_ctes(["raw_invoices"], """
  SELECT CAST(1 AS BIGINT) AS run, COUNT(*) AS loaded, CAST(0 AS BIGINT) AS quarantined, COUNT(*) AS table_rows
  FROM raw_invoices WHERE updated_at < TIMESTAMP '1998-01-01 00:00:00'
  UNION ALL
  SELECT 2, COUNT(*) FILTER (WHERE updated_at <= TIMESTAMP '2001-09-01 00:00:00' AND updated_at >= (
              SELECT MAX(updated_at) FROM raw_invoices WHERE updated_at < TIMESTAMP '1998-01-01 00:00:00')),
         COUNT(*) FILTER (WHERE updated_at > TIMESTAMP '2001-09-01 00:00:00'),
         COUNT(*) FILTER (WHERE updated_at <= TIMESTAMP '2001-09-01 00:00:00') FROM raw_invoices"""))
register("quarantine_rows", with_ctes(["raw_invoices"], """
  SELECT _row_id, invoice_id, updated_at FROM raw_invoices WHERE updated_at > TIMESTAMP '2001-09-01 00:00:00'"""))
register("incremental_invoices", select_all("stg_invoices"))
register("cursor_guard", with_ctes(["raw_customers", "raw_subscriptions", "raw_invoices"], "\nUNION ALL\n".join(
    f"""SELECT '{t}' AS resource, COUNT(*) AS rows_seen,
           COUNT(*) FILTER (WHERE updated_at <= TIMESTAMP '2001-09-01 00:00:00') AS rows_accepted,
           COUNT(*) FILTER (WHERE updated_at > TIMESTAMP '2001-09-01 00:00:00') AS rows_quarantined,
           MAX(updated_at) FILTER (WHERE updated_at <= TIMESTAMP '2001-09-01 00:00:00') AS watermark,
           MAX(updated_at) AS unguarded_watermark FROM raw_{t}"""
    for t in ("customers", "subscriptions", "invoices"))))
cte("event_history", [], """
  WITH runs AS (SELECT * FROM (VALUES (1, TIMESTAMP '2024-01-11'), (2, TIMESTAMP '2024-01-21'),
                                      (3, (SELECT CAST(MAX(ts) AS DATE) + 1 FROM events))) r(j, run_ts)),
  snaps AS (
    SELECT j, user_id, event_id, event_type, value, ts AS updated_at FROM (
      SELECT r.j, e.*, ROW_NUMBER() OVER (PARTITION BY r.j, e.user_id ORDER BY e.ts DESC, e.event_id DESC) AS rn
      FROM events e JOIN runs r ON e.ts < r.run_ts)
    WHERE rn = 1),
  versions AS (SELECT DISTINCT user_id, event_id, event_type, value, updated_at FROM snaps)
  SELECT *, updated_at AS valid_from,
         LEAD(updated_at) OVER (PARTITION BY user_id ORDER BY updated_at) AS valid_to
  FROM versions""")
register("scd2_history", select_all("event_history"))
register("point_in_time_state", with_ctes(["event_history"], """
  SELECT d.period_start, h.event_type, COUNT(*) AS users,
         CAST(SUM(CAST(h.value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS value_total
  FROM (SELECT CAST(UNNEST(generate_series(TIMESTAMP '2024-01-01', (SELECT CAST(CAST(MAX(ts) AS DATE) + 1 AS TIMESTAMP) FROM events), INTERVAL 1 DAY))
                    AS DATE) AS period_start) d
  JOIN event_history h
    ON h.valid_from <= CAST(d.period_start AS TIMESTAMP)
   AND (h.valid_to IS NULL OR h.valid_to > CAST(d.period_start AS TIMESTAMP))
  GROUP BY d.period_start, h.event_type"""))


# ------------------------------------------------------------ fx + helpers
register("fx_convert", with_ctes(["stg_invoices"], """
  SELECT invoice_id, currency, amount,
         CAST(CASE WHEN currency = 'EUR' THEN amount WHEN currency = 'SEK' THEN ROUND(amount * 0.088, 2) END
              AS DECIMAL(18,2)) AS amount_eur
  FROM stg_invoices"""))
cte("fx_rates", ["stg_invoices"], """
  SELECT 'SEK' AS currency, m AS valid_from,
         CAST(0.085 + 0.001 * (month(m) - 1) AS DECIMAL(18,6)) AS rate
  FROM (SELECT DISTINCT CAST(date_trunc('month', invoice_date) AS DATE) AS m FROM stg_invoices
        WHERE invoice_date IS NOT NULL)
  UNION ALL SELECT 'EUR', DATE '1990-01-01', CAST(1 AS DECIMAL(18,6))""")
register("fx_asof", with_ctes(["stg_invoices", "fx_rates"], """
  SELECT i.invoice_id, i.currency, i.invoice_date, i.amount,
         CAST(ROUND(i.amount * r.rate, 2) AS DECIMAL(18,2)) AS amount_eur
  FROM stg_invoices i ASOF LEFT JOIN fx_rates r
    ON i.currency = r.currency AND i.invoice_date >= r.valid_from"""))

_LI_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
register("dedup_latest", """
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY """
         + ", ".join(f"{c} DESC NULLS LAST" for c in _LI_ORDER) + """) AS rn
    FROM lineitem) WHERE rn = 1""")
register("orphan_keys", with_ctes(["stg_subscriptions", "stg_customers"], """
  SELECT s.subscription_id, s.customer_id FROM stg_subscriptions s
  WHERE s.customer_id IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM stg_customers c WHERE c.customer_id = s.customer_id)"""))
register("existence_flag", """
  SELECT o_orderkey, o_orderstatus,
         EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey) AS has_lineitems
  FROM orders o""")


register("dq_unique_combination", _suite([
    ("unique_combination_lineitem_l_orderkey_l_linenumber", "lineitem", "unique_combination", "l_orderkey,l_linenumber",
     "error", _repeated("lineitem", "l_orderkey, l_linenumber")),
    ("unique_combination_orders_o_custkey_o_orderdate", "orders", "unique_combination", "o_custkey,o_orderdate",
     "warn", _repeated("orders", "o_custkey, o_orderdate")),
    (None, "documents", "unique", "text", "warn", _unique("documents", "text")),
    (None, "events", "unique", "event_id", "error", _unique("events", "event_id")),
]))

_PROFILE_METRICS = {
    "null": "{c} IS NULL",
    "blank": "{c} = ''",
    "untrimmed": "{c} <> TRIM({c})",
    "not_lower": "{c} <> LOWER({c})",
    "numeric": "TRY_CAST({c} AS DECIMAL(38,6)) IS NOT NULL",
    "negative": "TRY_CAST({c} AS DECIMAL(38,6)) < 0",
    "date": "TRY_CAST({c} AS DATE) IS NOT NULL",
}


def _profile_sql() -> str:
    from ledgerline.sources.raw import RAW_COLUMNS
    parts = []
    for t, cols in RAW_COLUMNS.items():
        parts.append(f"SELECT '{t}' AS table_name, CAST(NULL AS VARCHAR) AS column_name, 'rows' AS metric, "
                     f"COUNT(*) AS value FROM raw_{t}")
        for c in cols:
            for m, pred in _PROFILE_METRICS.items():
                parts.append(f"SELECT '{t}', '{c}', '{m}', COUNT(*) FILTER (WHERE COALESCE({pred.format(c=c)}, FALSE)) "
                             f"FROM raw_{t}")
        parts.append(f"SELECT '{t}', '{cols[0]}', 'duplicate_key', CAST(({_unique(f'raw_{t}', cols[0])}) AS BIGINT)")
        parts.append(f"SELECT '{t}', NULL, 'duplicate_row', (SELECT COUNT(*) FROM raw_{t}) - "
                     f"(SELECT COUNT(*) FROM (SELECT DISTINCT {', '.join(cols)} FROM raw_{t}))")
    for t, c, allowed in (("subscriptions", "status", _STATUS), ("invoices", "status", "'paid', 'failed', 'open'"),
                          ("invoices", "currency", "'EUR', 'SEK'")):
        parts.append(f"SELECT '{t}', '{c}', 'out_of_set', COUNT(*) FROM raw_{t} WHERE {c} NOT IN ({allowed})")
    for t, c, parent in (("subscriptions", "customer_id", "customers"), ("invoices", "subscription_id", "subscriptions")):
        parts.append(f"SELECT '{t}', '{c}', 'orphan', ({_homeless(f'raw_{t}', c, f'raw_{parent}')})")
    return with_ctes(["raw_customers", "raw_subscriptions", "raw_invoices"], "\nUNION ALL\n".join(parts))


register("profile_table", _profile_sql())
register("source_freshness", with_ctes(["raw_customers", "raw_subscriptions", "raw_invoices"], "\nUNION ALL\n".join(
    f"""SELECT '{t}' AS resource, max_loaded_at, age_hours,
           CASE WHEN max_loaded_at IS NULL THEN 'error' WHEN age_hours < 0 THEN 'future'
                WHEN age_hours >= 48 THEN 'error' WHEN age_hours >= 24 THEN 'warn' ELSE 'pass' END AS status
    FROM (SELECT max_loaded_at,
                 CAST(FLOOR((epoch(TIMESTAMP '2001-09-01 00:00:00') - epoch(max_loaded_at)) / 3600) AS BIGINT)
                   AS age_hours
          FROM (SELECT MAX(updated_at) AS max_loaded_at FROM raw_{t}))"""
    for t in ("customers", "subscriptions", "invoices"))))
register("stream_sync_events", select_all("latest_event_per_user"))

cte("subscription_history", ["stg_subscriptions", "stg_invoices"], """
  WITH s AS (SELECT *, CAST(updated_at AS TIMESTAMP) AS seen FROM stg_subscriptions),
  prices AS (
    SELECT subscription_id, seen, max(price) AS price FROM (
      SELECT subscription_id, seen, monthly_price AS price FROM s
      UNION ALL
      SELECT subscription_id, CAST(invoice_date AS TIMESTAMP), amount_eur FROM stg_invoices
      WHERE amount_eur IS NOT NULL AND invoice_date IS NOT NULL)
    WHERE price IS NOT NULL GROUP BY ALL),
  moments AS (
    SELECT subscription_id, seen FROM s UNION SELECT subscription_id, CAST(end_date AS TIMESTAMP) FROM s WHERE end_date IS NOT NULL
    UNION SELECT subscription_id, CAST(invoice_date AS TIMESTAMP) FROM stg_invoices
          WHERE amount_eur IS NOT NULL AND invoice_date IS NOT NULL AND subscription_id IN (SELECT subscription_id FROM s)),
  states AS (
    SELECT m.subscription_id, m.seen,
           CASE WHEN m.seen >= s.seen THEN s.plan_name END AS plan_name,
           p.price AS monthly_price,
           CASE WHEN s.end_date IS NULL THEN CASE WHEN m.seen >= s.seen THEN s.status END
                WHEN s.seen = CAST(s.end_date AS TIMESTAMP) AND m.seen >= s.seen THEN greatest('active', s.status)
                WHEN m.seen >= CAST(s.end_date AS TIMESTAMP) AND (m.seen < s.seen OR s.seen < CAST(s.end_date AS TIMESTAMP)) THEN s.status
                WHEN m.seen >= s.seen THEN 'active' END AS status,
           CASE WHEN m.seen >= s.seen THEN s.start_date END AS start_date,
           CASE WHEN m.seen >= CAST(s.end_date AS TIMESTAMP) THEN s.end_date END AS end_date
    FROM moments m JOIN s USING (subscription_id)
    ASOF LEFT JOIN prices p ON p.subscription_id = m.subscription_id AND m.seen >= p.seen),
  changes AS (
    SELECT *, row(plan_name, monthly_price, status, start_date, end_date) AS state,
           lag(row(plan_name, monthly_price, status, start_date, end_date)) OVER w AS before, row_number() OVER w AS place
    FROM states WINDOW w AS (PARTITION BY subscription_id ORDER BY seen))
  SELECT subscription_id, plan_name, monthly_price, status, start_date, end_date, seen AS updated_at, seen AS valid_from,
         lead(seen) OVER (PARTITION BY subscription_id ORDER BY seen) AS valid_to
  FROM changes WHERE place = 1 OR state IS DISTINCT FROM before""")
register("scd2_subscriptions", select_all("subscription_history"))
cte("history_months", ["subscription_history"], """
  SELECT CAST(UNNEST(generate_series((SELECT date_trunc('month', MIN(valid_from)) FROM subscription_history),
                                     (SELECT date_trunc('month', MAX(valid_from)) FROM subscription_history),
                                     INTERVAL 1 MONTH)) AS DATE) AS month_start""")
register("point_in_time_mrr", with_ctes(["subscription_history", "history_months"], """
  SELECT m.month_start, h.plan_name, CAST(SUM(h.monthly_price) AS DECIMAL(38,2)) AS mrr,
         COUNT(h.subscription_id) AS active_subscriptions
  FROM history_months m
  JOIN subscription_history h
    ON h.valid_from <= CAST(m.month_start AS TIMESTAMP)
   AND (h.valid_to IS NULL OR h.valid_to > CAST(m.month_start AS TIMESTAMP))
   AND (h.end_date IS NULL OR h.end_date >= m.month_start)
  GROUP BY m.month_start, h.plan_name"""))
register("mrr_as_known", with_ctes(["subscription_history", "history_months"], """
  SELECT k.month_start AS known_at, m.month_start, h.plan_name, CAST(SUM(h.monthly_price) AS DECIMAL(38,2)) AS mrr,
         COUNT(h.subscription_id) AS active_subscriptions
  FROM subscription_history h
  JOIN history_months k ON h.valid_from <= CAST(k.month_start AS TIMESTAMP)
   AND (h.valid_to IS NULL OR h.valid_to > CAST(k.month_start AS TIMESTAMP))
  JOIN history_months m ON m.month_start <= k.month_start AND date_trunc('month', h.start_date) <= m.month_start
   AND (h.end_date IS NULL OR date_trunc('month', h.end_date) >= m.month_start)
  GROUP BY ALL"""))
register("quarantine_lifecycle", with_ctes(["raw_invoices"], """
  SELECT _row_id, CASE WHEN updated_at > TIMESTAMP '2001-09-01' THEN 'clamped' ELSE 'released' END AS state, updated_at,
         TIMESTAMP '1998-01-01' AS held_at,
         CASE WHEN updated_at > TIMESTAMP '1998-01-01' AND updated_at <= TIMESTAMP '2000-01-01' THEN TIMESTAMP '2000-01-01'
              ELSE TIMESTAMP '2001-09-01' END AS settled_at,
         least(updated_at, TIMESTAMP '2001-09-01') AS loaded_as
  FROM raw_invoices WHERE updated_at > TIMESTAMP '1998-01-01'"""))
register("schema_sync", """
  SELECT CAST(o_orderkey AS BIGINT) AS order_key,
         CASE WHEN o_orderkey % 3 = 1 THEN CAST(o_custkey AS BIGINT) ELSE CAST(o_custkey AS BIGINT) + 3000000000 END AS customer,
         CAST(CASE WHEN o_orderkey % 3 = 1 THEN CAST(o_totalprice AS DECIMAL(18,2))
                   ELSE CAST(o_totalprice AS DECIMAL(18,2)) + CAST(0.0001 AS DECIMAL(18,4)) END AS DECIMAL(14,4)) AS price,
         CASE WHEN o_orderkey % 3 = 1 THEN NULL ELSE o_orderpriority END AS priority
  FROM orders""")
register("mrr_incremental", select_all("mrr_by_month_plan"))
register("fx_asof_large", with_ctes(["stg_invoices"], """
  SELECT i.invoice_id, i.currency, i.invoice_date, i.amount,
         CAST(ROUND(i.amount * r.rate, 2) AS DECIMAL(18,2)) AS amount_eur
  FROM stg_invoices i ASOF LEFT JOIN (
    SELECT DISTINCT currency, invoice_date AS valid_from,
           CAST((50000 + (date_diff('day', DATE '1990-01-01', invoice_date) * 37) % 9973) * 0.000001 AS DECIMAL(18,6)) AS rate
    FROM stg_invoices WHERE date_diff('day', DATE '1990-01-01', invoice_date) % 7 < 3 AND month(invoice_date) % 4 <> 2) r
    ON i.currency = r.currency AND i.invoice_date >= r.valid_from"""))
register("missed_rows", with_ctes(["raw_invoices"], """
  SELECT _row_id, invoice_id, amount, CASE WHEN _row_id % 97 = 0 THEN 'missing' ELSE 'changed' END AS kind
  FROM raw_invoices
  WHERE (_row_id % 97 = 0 OR _row_id % 89 = 0)
    AND updated_at < (SELECT MAX(updated_at) FROM raw_invoices
                      WHERE updated_at < TIMESTAMP '1998-01-01 00:00:00' AND _row_id % 97 <> 0)"""))

cte("ltv_positions", ["customer_ltv"], """
  SELECT customer_id, customer_name, ltv,
         row_number() OVER (ORDER BY ltv DESC NULLS LAST, customer_id NULLS FIRST) AS position FROM customer_ltv""")
register("customer_ltv_ranked", select_all("ltv_positions"))
cte("mrr_positions", ["mrr_by_month_plan"], """
  SELECT *, row_number() OVER (ORDER BY month_start NULLS FIRST, plan_name NULLS FIRST) AS position FROM mrr_by_month_plan""")
register("mrr_ranked", select_all("mrr_positions"))
