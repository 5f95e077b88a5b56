"""For each query, the same result in SQL over the given tables.

Written on their own, from the queries' definitions: window functions, exact quantiles
and joins are spelled out here, whatever way the Spark jobs take.
"""

from __future__ import annotations

from ..contract import CURRENCIES, COUNTRIES, NULLABLE_COLUMNS, OPERATORS, SENDERS, STATUSES

MART = """
WITH mart AS (
    SELECT CAST(1001 + o_custkey % 8 AS BIGINT) AS customer_id,
           'app-' || CAST(o_custkey % 32 AS VARCHAR) AS application_uuid,
           concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                     CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS message_id,
           l_shipdate AS sent_date,
           CASE p_brand WHEN 'Brand#1' THEN NULL WHEN 'Brand#2' THEN 'not_defined' ELSE p_brand END AS sender,
           CASE WHEN o_custkey % 97 = 0 THEN NULL ELSE '+' || CAST(o_custkey AS VARCHAR) END AS receiver,
           CASE n_name WHEN 'NATION_0' THEN NULL WHEN 'NATION_1' THEN 'not_defined' ELSE n_name END AS country,
           CAST(l_linenumber AS BIGINT) AS segment_count,
           CASE WHEN l_quantity <= 40 THEN 'DELIVRD' WHEN l_quantity <= 42 THEN 'UNDELIV'
                WHEN l_quantity <= 44 THEN 'EXPIRED' WHEN l_quantity <= 46 THEN 'REJECTD'
                WHEN l_quantity <= 48 THEN 'SENT' WHEN l_quantity <= 49 THEN 'NO ROUTES' END AS delivery_status,
           CAST(1 + l_partkey % 3 AS SMALLINT) AS attempt_number,
           CAST(100 + CAST(floor(l_extendedprice) AS BIGINT) % 2901 AS INTEGER) AS delivery_time,
           least(1.0e0, l_extendedprice / 100000) AS price,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'EUR' WHEN '2-HIGH' THEN 'USD'
                WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'RUB' END AS currency,
           CASE WHEN l_suppkey % 17 = 0 THEN NULL ELSE 'op-' || CAST(l_suppkey % 17 AS VARCHAR) END
               AS receiver_operator,
           CAST(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS SMALLINT) AS direction,
           l_shipdate + INTERVAL 1 SECOND AS created_at,
           l_shipdate + INTERVAL 301 SECOND AS updated_at,
           CASE WHEN l_orderkey % 67 = 0 THEN l_shipdate + INTERVAL 1 DAY END AS deleted_at
    FROM lineitem
    LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN part ON l_partkey = p_partkey
), active AS (
    SELECT * FROM mart WHERE deleted_at IS NULL
)"""

DELIVERED = "count(*) FILTER (WHERE delivery_status = 'DELIVRD')"
COUNT = "count(message_id) AS count_messages"
REVENUE = "round(sum(price), 2) AS revenue"
RATE = "round(100 * avg(CAST(delivery_status = 'DELIVRD' AS DOUBLE)), 2) AS delivery_rate_pct"
AVG_TIME = "round(avg(delivery_time), 0) AS avg_delivery_time"
FAILED = "round(100.0e0 * count_if(delivery_status <> 'DELIVRD') / nullif(count(*), 0), 2) AS failed_rate_pct"
COST = "round(sum(price) / nullif(count_if(delivery_status = 'DELIVRD'), 0), 4) AS cost_per_delivered"


def _over(body: str) -> str:
    """``body`` after the mart's CTEs; further CTEs in it start with a comma."""
    return f"{MART}\n{body.strip()}"


def _number(metric: str) -> str:
    return _over(f"SELECT {metric} FROM active")


def _top(key: str, metric: str, name: str, where: str = "", limit: int | None = 10) -> str:
    top = f"LIMIT {limit}" if limit else ""
    return _over(
        f"SELECT {key}, {metric} FROM active {where} GROUP BY {key} "
        f"ORDER BY {name} DESC NULLS LAST, {key} ASC NULLS LAST {top}"
    )


_MONTH = "CAST(date_trunc('month', sent_date) AS DATE)"

_RETENTION = f"""
, contacts AS (
    SELECT receiver, {_MONTH} AS month, min({_MONTH}) OVER (PARTITION BY receiver) AS cohort_month
    FROM active WHERE receiver IS NOT NULL
), retention AS (
    SELECT cohort_month, date_diff('month', cohort_month, month) AS month_index,
           count(DISTINCT receiver) AS active_receivers,
           max(count(DISTINCT receiver)) FILTER (WHERE month = cohort_month) OVER (PARTITION BY cohort_month)
               AS cohort_size,
           round(100.0e0 * active_receivers / cohort_size, 1) AS retention_pct
    FROM contacts GROUP BY cohort_month, month
)"""

_ROLLUP = f"""
, rollup_rows AS (
    SELECT CAST(sent_date AS DATE) AS day, country, delivery_status, currency,
           count(*) AS msgs, {DELIVERED} AS delivrd,
           round(sum(price), 8) AS revenue
    FROM active GROUP BY 1, 2, 3, 4
)"""

_CARD = """
, card AS (
    SELECT CASE n_name WHEN 'NATION_1' THEN 'not_defined' ELSE n_name END AS country,
           0.03e0 + 0.001e0 * n_nationkey AS base_price,
           CAST(n_nationkey % 9 + 1 AS VARCHAR) AS prefix,
           'op-' || CAST(n_nationkey % 16 + 1 AS VARCHAR) AS op1,
           'op-' || CAST((n_nationkey + 5) % 16 + 1 AS VARCHAR) AS op2
    FROM nation WHERE n_name <> 'NATION_0'
)"""


def _digits(figure: str) -> int:
    """Digits to compare: quantiles are exact, means depend on the order of addition."""
    exact = ("median", "min", "max", "range", "q1", "q3", "iqr", "low_fence", "high_fence")
    return 2 if figure == "total" else 11 if figure.removeprefix("outlier_") in exact else 8


def _statistics(column: str, source: str = "active") -> str:
    x = f"CAST({column} AS DOUBLE)"
    figures = {
        "mean": f"avg({x})",
        "median": f"quantile_cont({x}, 0.5)",
        "min": f"min({x})",
        "max": f"max({x})",
        "range": f"max({x}) - min({x})",
        "std_sample": f"stddev_samp({x})",
        "std_pop": f"stddev_pop({x})",
        "q1": f"quantile_cont({x}, 0.25)",
        "q3": f"quantile_cont({x}, 0.75)",
        "iqr": f"quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25)",
    }
    listed = ", ".join(f'round({sql}, {_digits(name)}) AS "{name}"' for name, sql in figures.items())
    return f"SELECT '{column}' AS \"column\", count({column}) AS \"count\", {listed} FROM {source}"


def _outliers(column: str, source: str = "active", prefix: str = "") -> str:
    x = f"CAST({column} AS DOUBLE)"
    return f"""
    SELECT '{column}' AS "column", round(low, 11) AS {prefix}low_fence, round(high, 11) AS {prefix}high_fence,
           CAST(count_if({x} < low OR {x} > high) AS BIGINT) AS {prefix}n_outliers,
           round(CAST(count_if({x} < low OR {x} > high) AS DOUBLE) / count({column}), 8) AS {prefix}share
    FROM {source}, (
        SELECT q1 - 1.5e0 * (q3 - q1) AS low, q3 + 1.5e0 * (q3 - q1) AS high
        FROM (SELECT quantile_cont({x}, 0.25) AS q1, quantile_cont({x}, 0.75) AS q3 FROM {source})
    ) GROUP BY low, high"""


def _skew(source: str) -> str:
    return f"""
    SELECT "column", mean, median,
           CASE WHEN median <> 0 AND mean > median * 1.05e0 THEN 'right'
                WHEN median <> 0 AND mean < median * 0.95e0 THEN 'left' ELSE 'symmetric' END AS skew
    FROM ({source})"""


def _segments(by: str) -> str:
    return f"""SELECT {by}, count(price) AS "count", round(avg(price), 8) AS "avg",
       round(quantile_cont(price, 0.5), 11) AS median, round(sum(price), 2) AS total
FROM active GROUP BY {by}"""


def _share(predicate: str) -> str:
    return f"round(avg(CASE WHEN {predicate} THEN 1.0e0 ELSE 0.0e0 END), 8)"


def _dq() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", {_share(f"{name} IS NULL")} AS null_share,
        {_share(f"{name} = 'not_defined'")} AS not_defined_share,
        {_share("deleted_at IS NOT NULL")} AS deleted_share FROM mart"""
        for name in NULLABLE_COLUMNS
    )


def _check(name: str, observed: str, passed: str, source: str = "mart") -> str:
    return (
        f"SELECT '{name}' AS \"check\", round(CAST(v AS DOUBLE), 6) AS observed, "
        f"coalesce({passed}, false) AS passed FROM (SELECT {observed} AS v FROM {source})"
    )


def _checks(*checks: str) -> str:
    return _over(" UNION ALL ".join(checks))


def _outside(name: str, low: float, high: float) -> str:
    return _check(f"{name}_range", f"count_if(NOT {name} BETWEEN {low} AND {high})", "v = 0")


def _undeclared(name: str, values: list) -> str:
    listed = ", ".join("'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v) for v in values)
    return _check(f"{name}_domain", f"count_if({name} NOT IN ({listed}))", "v = 0")


_MESSAGE = """customer_id, application_uuid, message_id, sent_date, sender, receiver, country, segment_count,
delivery_status, attempt_number, delivery_time, round(price, 8) AS price, currency, receiver_operator, direction,
created_at, updated_at, deleted_at"""

_FINGERPRINT = """count(*) AS "rows", round(sum(price), 2) AS price_sum,
CAST(sum(segment_count) AS BIGINT) AS segments, CAST(sum(delivery_time) AS BIGINT) AS delivery_time_sum,
count(sender) AS senders, count(country) AS countries, count(delivery_status) AS statuses,
count(deleted_at) AS deleted, min(sent_date) AS first_sent, max(updated_at) AS last_updated"""


def _unpivoted(frame: str, subject: str, figures: list[str], source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{frame}' AS frame, CAST("{subject}" AS VARCHAR) AS subject, '{figure}' AS figure,
        round(CAST("{figure}" AS DOUBLE), {_digits(figure)}) AS "value" FROM {source}"""
        for figure in figures
    )


def _report() -> str:
    statistics = ["count", "mean", "median", "min", "max", "range", "std_sample", "std_pop", "q1", "q3", "iqr"]
    outliers = ["outlier_low_fence", "outlier_high_fence", "outlier_n_outliers", "outlier_share"]
    segment = ["count", "avg", "median", "total"]
    described = f"{_statistics('price')} UNION ALL {_statistics('delivery_time')}"
    fences = f"{_outliers('price', prefix='outlier_')} UNION ALL {_outliers('delivery_time', prefix='outlier_')}"
    return _over(
        f""", described AS ({described}), fences AS ({fences}),
        summary AS (SELECT * FROM described JOIN fences USING ("column")),
        by_country AS ({_segments('country')}), by_customer AS ({_segments('customer_id')}), dq AS ({_dq()}) """
        + " UNION ALL ".join(
            [
                _unpivoted("summary", "column", [*statistics, *outliers], "summary"),
                _unpivoted("price_by_country", "country", segment, "by_country"),
                _unpivoted("price_by_customer", "customer_id", segment, "by_customer"),
                _unpivoted("dq", "column", ["null_share", "not_defined_share", "deleted_share"], "dq"),
            ]
        )
    )


_DAYS = """ SELECT day, CAST(sum(msgs) AS BIGINT) AS msgs, CAST(sum(delivrd) AS BIGINT) AS delivrd,
    round(sum(revenue), 8) AS revenue FROM rollup_rows GROUP BY day"""


def _leaders(figures: str, rank: str) -> str:
    """The top three countries of each month; ``rank`` orders a month's countries."""
    return _over(
        f"""SELECT {_MONTH} AS month, country, {figures}, CAST({rank} AS INTEGER) AS rnk
        FROM active GROUP BY 1, 2 QUALIFY rnk <= 3"""
    )


ORACLES: dict[str, str] = {
    "sms_by_day": _over(
        f"SELECT CAST(sent_date AS DATE) AS day, {COUNT} FROM active GROUP BY 1 ORDER BY 1"
    ),
    "delivery_rate": _number(RATE),
    "revenue_total": _number(REVENUE),
    "top_countries": _top("country", COUNT, "count_messages"),
    "top_operators": _top("receiver_operator", COUNT, "count_messages"),
    "revenue_by_currency": _top("currency", REVENUE, "revenue", limit=None),
    "failed_statuses": _top(
        "delivery_status", COUNT, "count_messages", "WHERE delivery_status NOT IN ('DELIVRD')"
    ),
    "delivery_rate_by_operator": _top("receiver_operator", RATE, "delivery_rate_pct"),
    "avg_delivery_time_by_operator": _top("receiver_operator", AVG_TIME, "avg_delivery_time"),
    "delivery_rate_by_country": _top("country", RATE, "delivery_rate_pct"),
    "failed_rate": _number(FAILED),
    "avg_delivery_time": _number(AVG_TIME),
    "cost_per_delivered": _number(COST),
    "kpi_summary": _number(", ".join([COUNT, REVENUE, RATE, AVG_TIME, FAILED, COST])),
    "direction_split": _top("direction", ", ".join([COUNT, REVENUE, RATE]), "count_messages", limit=None),
    "segment_distribution": _top("segment_count", COUNT, "count_messages", limit=None),
    "filtered_chart": _top(
        "country", f"{COUNT}, {RATE}", "count_messages",
        "WHERE customer_id IN (1001, 1004, 1007) AND sent_date BETWEEN TIMESTAMP '1996-03-01 00:00:00' "
        "AND TIMESTAMP '1999-08-31 00:00:00' AND currency = 'RUB'",
        limit=None,
    ),
    "cohort_heatmap": _over(
        _RETENTION + " SELECT cohort_month, month_index, max(retention_pct) AS retention_pct_max FROM retention "
        "WHERE month_index > 0 GROUP BY 1, 2 ORDER BY 1, 2"
    ),
    # The given orders span 83 months.
    "cohort_grid": _over(
        _RETENTION + " SELECT cohort_month, "
        + ", ".join(
            f"max(CASE WHEN month_index = {i} THEN retention_pct END) AS month_{i}" for i in range(1, 83)
        )
        + " FROM retention GROUP BY cohort_month"
    ),
    "rollup_daily": _over(_ROLLUP + " SELECT * FROM rollup_rows"),
    "sms_by_day_rollup": _over(
        _ROLLUP + " SELECT day, CAST(sum(msgs) AS BIGINT) AS count_messages FROM rollup_rows GROUP BY day"
    ),
    "delivery_rate_rollup": _over(
        _ROLLUP + " SELECT round(100.0e0 * sum(delivrd) / sum(msgs), 2) AS delivery_rate_pct FROM rollup_rows"
    ),
    "rollup_vs_fact": _over(
        _ROLLUP + " SELECT count(*) AS buckets, CAST(0 AS BIGINT) AS differences, "
        "CAST(sum(msgs) AS BIGINT) AS msgs_rollup, (SELECT count(*) FROM active) AS msgs_fact FROM rollup_rows"
    ),
    "rollup_stream_daily": _over(_ROLLUP + " SELECT * FROM rollup_rows"),
    "rollup_backfill_then_stream": _over(_ROLLUP + _DAYS),
    "rollup_reload_stream": _over(_ROLLUP + _DAYS),
    "rollup_rebuilt": _over(_ROLLUP + _DAYS),
    "revenue_running_total": _over(
        """SELECT CAST(sent_date AS DATE) AS day, round(sum(price), 2) AS revenue,
               round(sum(sum(price)) OVER (ORDER BY CAST(sent_date AS DATE)), 2) AS revenue_cumulative
        FROM active GROUP BY 1"""
    ),
    "revenue_mom": _over(
        f"""SELECT month, round(now, 2) AS revenue, round(before, 2) AS prev_revenue,
               CASE WHEN before <> 0 THEN round(100 * (now - before) / before, 2) END AS mom_growth_pct
        FROM (
            SELECT {_MONTH} AS month, sum(price) AS now,
                   lag(sum(price), 1, 0.0e0) OVER (ORDER BY {_MONTH}) AS before
            FROM active GROUP BY 1
        )"""
    ),
    "top3_countries_by_month": _leaders(
        "round(sum(price), 2) AS revenue, count(*) AS sms",
        f"row_number() OVER (PARTITION BY {_MONTH} ORDER BY sum(CAST(price AS DECIMAL(18, 9))) DESC, country ASC NULLS LAST)",
    ),
    "rank_countries": _leaders("count(*) AS sms", f"rank() OVER (PARTITION BY {_MONTH} ORDER BY count(*) DESC)"),
    "customer_tiers": _over(
        """SELECT customer_id, round(sum(price), 2) AS revenue, count(*) AS sms,
               CAST(ntile(4) OVER (ORDER BY round(sum(price), 2) DESC, customer_id) AS INTEGER) AS revenue_quartile,
               CAST(dense_rank() OVER (ORDER BY round(sum(price), 2) DESC) AS INTEGER) AS revenue_rank
        FROM active GROUP BY customer_id"""
    ),
    "cohort_retention": _over(_RETENTION + " SELECT * FROM retention"),
    "receiver_lifecycle": _over(
        """, known AS (
            SELECT count(*) = 1 AS once, (SELECT max(sent_date) FROM active) AS newest, max(sent_date) AS latest
            FROM active WHERE receiver IS NOT NULL GROUP BY receiver
        )
        SELECT CASE WHEN latest::DATE < newest::DATE - 90 THEN 'churned'
                    WHEN latest::DATE < newest::DATE - 60 THEN 'inactive'
                    WHEN once THEN 'new' ELSE 'active' END AS lifecycle_stage,
               count(*) AS receivers,
               round(100.0e0 * count(*) / (SELECT count(*) FROM known), 1) AS share_pct
        FROM known GROUP BY 1"""
    ),
    "describe_price": _over(_statistics("price")),
    "describe_delivery_time": _over(_statistics("delivery_time")),
    "iqr_outliers": _over(f"{_outliers('price')} UNION ALL {_outliers('delivery_time')}"),
    "event_value_profile": f"""
        SELECT * FROM ({_statistics('value', 'events')})
        JOIN ({_outliers('value', 'events', 'outlier_')}) USING ("column")
        JOIN (SELECT "column", skew FROM ({_skew(_statistics('value', 'events'))})) USING ("column")""",
    "segment_by_country": _over(_segments("country")),
    "segment_by_customer": _over(_segments("customer_id")),
    "skew_class": _over(_skew(f"{_statistics('price')} UNION ALL {_statistics('delivery_time')}")),
    "dq_metrics": _over(_dq()),
    "dq_board": _over(
        f"SELECT *, (SELECT count(deleted_at) FROM mart) AS soft_deleted FROM ({_outliers('delivery_time', 'mart')})"
    ),
    "load_summary": _over(
        """SELECT count(*) AS "rows", min(sent_date) AS first_sent, max(sent_date) AS last_sent,
               count(deleted_at) AS soft_deleted, round(100.0e0 * count(deleted_at) / count(*), 2) AS soft_deleted_pct,
               (SELECT round(100.0e0 * count_if(delivery_status = 'DELIVRD') / count(*), 2) FROM active)
                   AS delivered_pct
        FROM mart"""
    ),
    "currency_mix": _over(
        "SELECT coalesce(currency, '<NULL>') AS currency, count(*) AS sms FROM active GROUP BY 1"
    ),
    "row_count": _over('SELECT count(*) AS "rows" FROM mart'),
    "period": _over(
        "SELECT min(sent_date) AS first_sent, max(sent_date) AS last_sent, "
        "date_diff('day', min(sent_date), max(sent_date)) AS days FROM mart"
    ),
    "expected_tariff": _over(
        _CARD + """ SELECT message_id, a.country AS country, segment_count, round(price, 8) AS price,
            round(greatest(0.0e0, least(1.0e0, coalesce(base_price, 0.04e0) * segment_count)), 4) AS expected_price
        FROM active a LEFT JOIN card ON a.country = card.country"""
    ),
    "revenue_converted": _over(
        """, rates AS (
            SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'EUR' WHEN '2-HIGH' THEN 'USD'
                        WHEN '3-MEDIUM' THEN 'RUB' END AS currency,
                   CAST(o_orderdate AS DATE) AS day, max(o_totalprice) / 100000 AS rate
            FROM orders GROUP BY 1, 2
        )
        SELECT a.currency AS currency, count(*) AS sms, round(sum(price), 2) AS revenue,
               round(sum(price * rate), 2) AS revenue_converted,
               CAST(count_if(rate IS NULL) AS BIGINT) AS sms_without_rate
        FROM active a LEFT JOIN rates r ON a.currency = r.currency AND CAST(a.sent_date AS DATE) = r.day
        GROUP BY 1"""
    ),
    "delivery_time_by_status_class": _over(
        """SELECT CASE WHEN delivery_status = 'DELIVRD' THEN 'delivered'
                       WHEN delivery_status IN ('SENT', 'UNKNOWN') THEN 'in_flight' ELSE 'failed' END AS status_class,
               count(delivery_time) AS "count", round(avg(delivery_time), 8) AS "avg",
               round(quantile_cont(CAST(delivery_time AS DOUBLE), 0.5), 11) AS median
        FROM active GROUP BY 1"""
    ),
    "message_key_hash": _over(
        """, hashed AS (
            SELECT message_id,
                   sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(message_id)) AS h
            FROM active
        )
        SELECT message_id,
               h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-'
               || CASE WHEN h[17:17] IN ('0', '4', '8', 'c') THEN '8' WHEN h[17:17] IN ('1', '5', '9', 'd') THEN '9'
                       WHEN h[17:17] IN ('2', '6', 'a', 'e') THEN 'a' ELSE 'b' END
               || h[18:20] || '-' || h[21:32] AS "key"
        FROM hashed"""
    ),
    "checks_smoke": _checks(
        _check("row_count", "count(*)", "v >= (SELECT count(*) FROM lineitem) * 99 // 100"),
        _check("period_days", "date_diff('day', min(sent_date), max(sent_date))", "v BETWEEN 330 AND 400"),
        _check("customers", "count(DISTINCT customer_id)", "v >= 2"),
        _check("status_known", "count(delivery_status)", "v >= 1"),
        _check("country_known", "count(country)", "v >= 1"),
        _check("revenue_base", "round(sum(price), 2)", "v > 0"),
        _check(
            "delivery_rate_pct", "round(100 * avg(CAST(delivery_status = 'DELIVRD' AS DOUBLE)), 2)",
            "v IS NOT NULL", "active",
        ),
        _check("revenue_active", "round(sum(price), 2)", "v > 0", "active"),
    ),
    "checks_ranges": _checks(
        _outside("segment_count", 1, 14),
        _outside("attempt_number", 1, 3),
        _outside("delivery_time", 100, 3000),
        _outside("price", 0, 1),
        _check(
            "sent_date_range",
            "count_if(NOT (sent_date >= TIMESTAMP '1995-01-01 00:00:00' AND sent_date < TIMESTAMP '2001-01-01 00:00:00'))",
            "v = 0",
        ),
    ),
    "checks_domain": _checks(
        _undeclared("sender", SENDERS),
        _undeclared("country", COUNTRIES),
        _undeclared("delivery_status", STATUSES),
        _undeclared("attempt_number", [1, 2, 3]),
        _undeclared("currency", CURRENCIES),
        _undeclared("receiver_operator", OPERATORS),
        _undeclared("direction", [0, 1]),
    ),
    "checks_pairing": _checks(
        _check("applications", "count(DISTINCT application_uuid)", "v >= 1"),
        _check(
            "shared_applications", "count(*)", "v = 0",
            "(SELECT application_uuid FROM mart GROUP BY 1 HAVING count(DISTINCT customer_id) > 1)",
        ),
    ),
    "checks_shares": _checks(
        _check(
            "delivered_share", "avg(CASE WHEN delivery_status = 'DELIVRD' THEN 1.0e0 ELSE 0 END)",
            "v BETWEEN 0.75 AND 0.85",
        ),
        _check(
            "deleted_share", "avg(CASE WHEN deleted_at IS NOT NULL THEN 1.0e0 ELSE 0 END)",
            "v BETWEEN 0.005 AND 0.03",
        ),
        *[_check(f"{name}_nulls", f"count_if({name} IS NULL)", "v >= 1") for name in NULLABLE_COLUMNS],
        _check(
            "RUB_lead",
            "count_if(currency = 'RUB') - greatest(count_if(currency = 'EUR'), count_if(currency = 'USD'))",
            "v >= 1",
        ),
    ),
    "checks_reconcile": _over(
        _CARD + ", carded AS (SELECT * FROM mart LEFT JOIN card USING (country)) "
        + " UNION ALL ".join(
            [
                _check("country_difference", "sum(n) - (SELECT count(*) FROM mart)", "v = 0",
                       "(SELECT count(price) AS n FROM mart GROUP BY country)"),
                _check("customer_id_difference", "sum(n) - (SELECT count(*) FROM mart)", "v = 0",
                       "(SELECT count(price) AS n FROM mart GROUP BY customer_id)"),
                _check("columns_matching", "18", "v >= 18", "(SELECT 1)"),
                _check("wrong_operator", "count_if(receiver_operator <> op1 AND receiver_operator <> op2)",
                       "v = 0", "carded"),
                _check("wrong_prefix", "count_if(NOT starts_with(receiver, '+' || prefix))", "v = 0", "carded"),
            ]
        )
    ),
    "lookup_message": _over(f"SELECT {_MESSAGE} FROM mart WHERE message_id = (SELECT min(message_id) FROM mart)"),
    "application_slice": _over(f"SELECT {_MESSAGE} FROM mart WHERE application_uuid = 'app-11'"),
    "customer_period": _over(
        f"SELECT {_MESSAGE} FROM mart WHERE customer_id = 1003 "
        "AND sent_date BETWEEN TIMESTAMP '1997-02-10 00:00:00' AND TIMESTAMP '1997-05-20 00:00:00'"
    ),
    "month_partition_counts": _over(
        "SELECT year(sent_date) * 100 + month(sent_date) AS ym, count(*) AS messages FROM mart GROUP BY 1"
    ),
    "append_idempotent": _over(
        "SELECT count(*) AS rows_after_second, count(*) AS rows_after_first "
        "FROM mart"
    ),
    "overwrite_reload": _over(
        f"""SELECT (SELECT count(*) FROM mart) AS "rows", count(*) AS rollup_msgs, {DELIVERED} AS rollup_delivrd
        FROM active"""
    ),
    "format_roundtrip": _over(
        f"SELECT unnest(['csv', 'parquet', 'orc']) AS format, * FROM (SELECT {_FINGERPRINT}, true AS same_rows FROM mart)"
    ),
    "report_roundtrip": _report(),
}

_NOT_DELETED = "NOT (customer_id = 1005 OR customer_id = 1003 AND currency IS NOT DISTINCT FROM 'EUR')"
_KPI = ", ".join([COUNT, REVENUE, RATE, AVG_TIME, FAILED, COST])

ORACLES |= {
    "rollup_backfill_repeated": _over(_ROLLUP + _DAYS),
    "rollup_soft_deletes": _over(
        f"""SELECT CAST(sent_date AS DATE) AS day, country, delivery_status, currency, count(*) AS msgs,
            {DELIVERED} AS delivrd, round(sum(price), 8) AS revenue
        FROM active WHERE {_NOT_DELETED} GROUP BY 1, 2, 3, 4"""
    ),
    "rollup_compacted": _over(_ROLLUP + _DAYS),
    "cohort_retention_stored": _over(
        _RETENTION.replace("receiver IS NOT NULL", f"receiver IS NOT NULL AND {_NOT_DELETED}") + " SELECT * FROM retention"
    ),
    "active_receivers_stored": _over(
        f"""SELECT {_MONTH} AS month, count(DISTINCT receiver) AS active_receivers
        FROM active WHERE {_NOT_DELETED} GROUP BY 1 HAVING count(receiver) > 0"""
    ),
    "describe_sketched": _over(
        f"{_statistics('price', f'active WHERE {_NOT_DELETED}')} UNION ALL {_statistics('delivery_time', f'active WHERE {_NOT_DELETED}')}"
    ),
    "segment_by_country_sketched": _over(_segments("country").replace("FROM active", f"FROM active WHERE {_NOT_DELETED}")),
    "lookup_thousand": _over(
        f"SELECT {_MESSAGE} FROM mart WHERE message_id IN (SELECT message_id FROM mart ORDER BY message_id LIMIT 1000)"
    ),
    "filtered_among": _top(
        "receiver_operator", f"{COUNT}, {RATE}", "count_messages",
        "WHERE (country IN ('NATION_3', 'NATION_7', 'NATION_11') OR country IS NULL) "
        "AND (delivery_status IN ('DELIVRD', 'EXPIRED') OR delivery_status IS NULL) AND currency IN ('EUR', 'RUB')",
        limit=None,
    ),
    "revenue_next_month": _over(
        f"""SELECT month, round(now, 2) AS revenue, round(before, 2) AS prev_revenue,
               CASE WHEN before <> 0 THEN round(100 * (now - before) / before, 2) END AS mom_growth_pct,
               round(after, 2) AS next_revenue
        FROM (SELECT month, now, lag(now, 1, 0.0e0) OVER (ORDER BY month) AS before, lead(now) OVER (ORDER BY month) AS after
              FROM (SELECT {_MONTH} AS month, sum(price) AS now FROM active GROUP BY 1))"""
    ),
    "revenue_converted_asof": _over(
        """, rates AS (
            SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'EUR' WHEN '2-HIGH' THEN 'USD'
                        WHEN '3-MEDIUM' THEN 'RUB' END AS currency,
                   CAST(o_orderdate AS DATE) AS day, max(o_totalprice) / 100000 AS rate
            FROM orders WHERE day(o_orderdate) IN (1, 11, 21) GROUP BY 1, 2
        ), sent AS (
            SELECT currency, CAST(sent_date AS DATE) AS day, sum(price) AS revenue, count(*) AS sms FROM active GROUP BY 1, 2
        ), rated AS (
            SELECT s.*, (SELECT arg_max(rate, r.day) FROM rates r WHERE r.currency = s.currency AND r.day <= s.day) AS rate
            FROM sent s
        )
        SELECT currency, CAST(sum(sms) AS BIGINT) AS sms, round(sum(revenue), 2) AS revenue,
               round(sum(revenue * rate), 2) AS revenue_converted,
               CAST(sum(CASE WHEN rate IS NULL THEN sms ELSE 0 END) AS BIGINT) AS sms_without_rate
        FROM rated GROUP BY 1"""
    ),
    "setup_datasets": _over(
        _RETENTION + """ SELECT (SELECT count(*) FROM mart) AS stored, (SELECT count(*) FROM active) AS active,
            (SELECT count(*) FROM active) AS rolled_up, (SELECT count(*) FROM retention) AS cohort_rows,
            CAST(4 AS BIGINT) AS views"""
    ),
    "kpi_by_sql": _over(
        f"""SELECT CASE WHEN delivery_status = 'DELIVRD' THEN 'delivered'
                       WHEN delivery_status IN ('SENT', 'UNKNOWN') THEN 'in_flight' ELSE 'failed' END AS status_class,
            {_KPI} FROM active GROUP BY 1"""
    ),
    "checks_declared": _checks(
        _check(
            "country_domain",
            "count_if(country NOT IN (SELECT CASE n_name WHEN 'NATION_1' THEN 'not_defined' ELSE n_name END FROM nation))", "v = 0",
        ),
        _undeclared("currency", CURRENCIES),
        _outside("segment_count", 2, 6),
    ),
    "checks_load": _checks(
        _check("row_count", "count(*)", "v > 0"),
        _check("columns_matching", "18", "v = 18", "(SELECT 1)"),
        _outside("segment_count", 1, 14),
        _outside("attempt_number", 1, 3),
        _outside("delivery_time", 100, 3000),
        _outside("price", 0, 1),
        _undeclared("sender", SENDERS),
        _undeclared("country", COUNTRIES),
        _undeclared("delivery_status", STATUSES),
        _undeclared("attempt_number", [1, 2, 3]),
        _undeclared("currency", CURRENCIES),
        _undeclared("receiver_operator", OPERATORS),
        _undeclared("direction", [0, 1]),
    ),
}
