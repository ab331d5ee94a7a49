"""The registered queries as ANSI SQL over the same tables, for an independent engine.

Written from the rules, not from the DataFrame code: DISTINCT ON instead of windows or max_by,
correlated tests instead of joins, and so on.
"""

from __future__ import annotations

from itertools import combinations

from plumbline.operators.audits import HASH_DIGITS
from plumbline.operators.scans import SECRET_PATTERNS
from plumbline.queries import (
    ALLOCATION_FACTOR,
    CALLER_PATTERNS,
    MANIFEST,
    MARKUP_PATTERNS,
    MONTH,
    MONTH_BELOW,
    WATERMARK,
    run_id,
)

D18 = "DECIMAL(18,2)"

# The columns of the given tables; * fractions, @ times, + lists of fractions.
TABLE_COLUMNS = {
    "benchmark": "item_id text",
    "conversations": "conv_id turn role text",
    "customer": "c_custkey c_name c_nationkey c_acctbal* c_mktsegment",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding+ label",
    "events": "event_id ts@ user_id event_type value* props",
    "labels": "doc_id quality toxic",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity* l_extendedprice* "
    "l_discount* l_tax* l_returnflag l_linestatus l_shipdate@",
    "nation": "n_nationkey n_name n_regionkey",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice* o_orderdate@ o_orderpriority",
    "pages": "page_id url html",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice*",
    "region": "r_regionkey r_name",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal*",
}
TABLE_COLUMNS = {table: columns.split() for table, columns in TABLE_COLUMNS.items()}


def _value_text(column: str) -> str:
    """Text form of a value: whole millionths, microseconds since 1970, plain text."""
    name, kind = column.rstrip("*@+"), column[-1]
    whole = "CAST(CAST(floor(CAST({0} AS DOUBLE) * 1000000 + 0.5) AS BIGINT) AS VARCHAR)"
    form = {
        "*": whole.format(name),
        "@": f"CAST(epoch_us({name}) AS VARCHAR)",
        "+": f"array_to_string([{whole.format('x')} FOR x IN {name}], ',')",
    }.get(kind, f"CAST({name} AS VARCHAR)")
    return f"coalesce({form}, '\\N')"


def _cte(*names: str, variant: str) -> str:
    """WITH clause of the named steps and everything they need, in order."""
    third, age, gap = {
        "broken": ("EUR", 3600, "WHERE day(d) NOT IN (20, 21)"),
        "malformed": ("USD", 45, ""),
        "repaired": ("USD", 45, ""),
    }[variant]
    order_id, region, rates = "CAST(l_orderkey AS VARCHAR)", "r_name", "days"
    rate, rated = "(SELECT rate FROM fx WHERE rate_date = order_date)", "gov"
    if variant == "malformed":
        order_id = f"CASE WHEN l_linenumber <> 1 OR l_orderkey % 50 <> 0 THEN {order_id} END"
        region = "if(c_nationkey = 7, 'ATLANTIS', r_name)"
        rates = "(SELECT d, 0 AS more FROM days UNION ALL SELECT d, 10 FROM days WHERE day(d) = 10)"
        # Two rates for a day repeat its orders.
        rate = "fx.rate"
        rated = "gov LEFT JOIN fx ON gov.currency_code = 'USD' AND rate_date = order_date"
    known = (
        "AND l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag <> 'R')"
        if variant == "repaired"
        else ""
    )
    currency = "CASE {0} % 4 WHEN 2 THEN 'USD' WHEN 3 THEN '" + third + "' ELSE 'CAD' END"
    steps = {
        "days": (
            "SELECT CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)), "
            "CAST(last_day(max(o_orderdate)) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d "
            "FROM orders",
            (),
        ),
        "cal": (
            "SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS calendar_date, "
            "strftime(d, '%Y-%m') AS year_month, CAST(day(d) AS INTEGER) AS day_of_month FROM days",
            ("days",),
        ),
        "cat": (
            "SELECT CAST(row_number() OVER (ORDER BY p_type) AS INTEGER) AS category_key, "
            "p_type AS category_code, "
            "upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS category_name "
            "FROM (SELECT DISTINCT p_type FROM part)",
            (),
        ),
        "reg": (
            "SELECT r_regionkey AS region_key, r_name AS region_code FROM region",
            (),
        ),
        "fx": (
            f"SELECT d AS rate_date, CAST(1.30 + ((dayofyear(d) * 13) % 80{' + more' if variant == 'malformed' else ''}) / 1000 "
            f"AS DECIMAL(10,6)) AS rate FROM {rates} {gap}",
            ("days",),
        ),
        "ft": (
            "SELECT DISTINCT year_month AS target_month, region_key, region_code, category_key, "
            "category_code, category_name, "
            f"CAST(10000 + 500 * region_key + 100 * category_key AS {D18}) AS target_cad "
            "FROM cal, reg, cat",
            ("cal", "reg", "cat"),
        ),
        "fo": (
            f"SELECT {order_id} AS order_id, "
            "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || "
            "l_linestatus AS event_id, l_linenumber AS event_version, "
            f"o_orderdate AS order_timestamp_utc, {region} AS region_code, p_type AS category_code, "
            f"{currency.format('c_nationkey')} AS currency_code, "
            "CAST(l_extendedprice AS DECIMAL(12,2)) AS gross_amount, "
            "c_mktsegment AS customer_segment, l_shipdate AS source_updated_at, "
            "TIMESTAMP '2001-11-04 23:30:00' AS ingested_at "
            "FROM lineitem JOIN orders ON o_orderkey = l_orderkey "
            "JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey "
            "JOIN region ON r_regionkey = n_regionkey JOIN part ON p_partkey = l_partkey "
            "WHERE l_returnflag <> 'R'",
            (),
        ),
        "fr": (
            "SELECT l_orderkey || '-' || l_linenumber AS return_id, "
            "CAST(l_orderkey AS VARCHAR) AS order_id, l_shipdate AS return_timestamp_utc, "
            "CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)),"
            " 2) AS DECIMAL(12,2)) AS return_amount, "
            f"{currency.format('s_nationkey')} AS currency_code, l_shipdate AS source_updated_at, "
            f"TIMESTAMP '2001-11-05 00:00:00' - INTERVAL {age} MINUTE AS ingested_at, "
            "l_partkey, l_suppkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey "
            f"WHERE l_returnflag = 'R' {known}",
            (),
        ),
        "lat": (
            "SELECT DISTINCT ON (order_id) *, CASE WHEN customer_segment = 'MACHINERY' "
            "THEN 'TEST_TRANSACTION' WHEN gross_amount IS NULL OR gross_amount <= 1000 "
            "THEN 'INVALID_AMOUNT' END AS quarantine_reason FROM fo ORDER BY order_id, "
            "event_version DESC, source_updated_at DESC, event_id DESC, gross_amount DESC",
            ("fo",),
        ),
        "gov": (
            "SELECT *, CAST(order_timestamp_utc AS DATE) AS order_date FROM lat "
            "WHERE quarantine_reason IS NULL",
            ("lat",),
        ),
        "ret": (
            "SELECT DISTINCT ON (return_id) * FROM fr ORDER BY return_id, "
            "source_updated_at DESC, l_partkey DESC, l_suppkey DESC, return_amount DESC, "
            "currency_code DESC",
            ("fr",),
        ),
        "rec": (
            "SELECT ret.*, CASE WHEN lat.order_id IS NULL THEN 'ORPHAN' "
            "WHEN lat.quarantine_reason IS NOT NULL THEN 'ORDER_EXCLUDED' "
            "WHEN ret.return_amount > 0 AND ret.currency_code = lat.currency_code THEN 'ACCEPTED' "
            "ELSE 'QUARANTINED' END AS reconciliation_status, "
            "CASE WHEN lat.order_id IS NOT NULL AND NOT ret.return_amount > 0 "
            "THEN 'INVALID_RETURN_AMOUNT' WHEN ret.currency_code <> lat.currency_code "
            "THEN 'RETURN_CURRENCY_MISMATCH' END AS quarantine_reason "
            "FROM ret LEFT JOIN lat USING (order_id)",
            ("ret", "lat"),
        ),
        "quar": (
            "SELECT 'orders' AS source_entity, order_id AS record_key, quarantine_reason, "
            "'azure_sql.sales.orders' AS source_system, ingested_at FROM lat "
            "WHERE quarantine_reason IS NOT NULL UNION ALL SELECT 'returns', return_id, "
            "quarantine_reason, 'sqlserver.dbo.returns', ingested_at FROM rec "
            "WHERE reconciliation_status = 'QUARANTINED'",
            ("lat", "rec"),
        ),
        "sales": (
            "SELECT order_id, event_id, order_date, region_code, category_code, currency_code, "
            "gross_amount, accepted_return_amount, return_count, fx_rate_to_cad, "
            f"CAST(round(gross_amount * fx_rate_to_cad, 2) AS {D18}) AS gross_revenue_cad, "
            f"CAST(round(accepted_return_amount * fx_rate_to_cad, 2) AS {D18}) AS returns_cad, "
            "source_updated_at FROM (SELECT gov.*, "
            "CASE WHEN currency_code = 'CAD' THEN CAST(1 AS DECIMAL(10,6)) "
            f"WHEN currency_code = 'USD' THEN {rate} "
            "END AS fx_rate_to_cad, "
            f"CAST(coalesce(a.amount, 0) AS {D18}) AS accepted_return_amount, "
            f"coalesce(a.n, 0) AS return_count FROM {rated} LEFT JOIN "
            "(SELECT order_id, sum(return_amount) AS amount, count(*) AS n FROM rec "
            "WHERE reconciliation_status = 'ACCEPTED' GROUP BY order_id) a USING (order_id))",
            ("gov", "rec", "fx"),
        ),
        "fact": (
            "SELECT order_id AS order_key, date_key, region_key, category_key, "
            "gross_revenue_cad, returns_cad, "
            f"CAST(gross_revenue_cad - returns_cad AS {D18}) AS net_revenue_cad, "
            "currency_code AS original_currency, gross_amount AS gross_amount_original_currency, "
            "fx_rate_to_cad AS applied_fx_rate, return_count, "
            f"'{run_id(variant)}' AS pipeline_run_id, "
            "'azure_sql.sales.orders' AS order_source_system, event_id AS order_source_event_id, "
            "source_updated_at AS order_source_updated_at, "
            "CASE WHEN return_count > 0 THEN 'sqlserver.dbo.returns' END AS returns_source_system, "
            "CASE WHEN currency_code = 'CAD' THEN 'none (CAD)' ELSE 'treasury.reference.fx' END "
            "AS fx_source_system, sales.region_code, sales.category_code, category_name, "
            "year_month FROM sales JOIN cal ON calendar_date = order_date "
            "JOIN reg USING (region_code) JOIN cat USING (category_code)",
            ("sales", "cal", "reg", "cat"),
        ),
        "obs": (
            "SELECT 1 AS seq, 'ORDERS_FRESHNESS' AS check_name, 'BLOCKING' AS severity, 240 AS lim,"
            " (SELECT date_diff('minute', max(ingested_at), TIMESTAMP '2001-11-05') FROM fo) AS n "
            "UNION ALL SELECT 2, 'RETURNS_FRESHNESS', 'BLOCKING', 240, (SELECT date_diff('minute', "
            "max(ingested_at), TIMESTAMP '2001-11-05') FROM fr) "
            "UNION ALL SELECT 3, 'DUPLICATE_BUSINESS_KEYS', 'BLOCKING', 0, "
            "(SELECT count(*) FROM (SELECT 1 FROM sales GROUP BY order_id HAVING count(*) > 1)) + "
            "(SELECT count(*) FROM (SELECT 1 FROM rec GROUP BY return_id HAVING count(*) > 1)) "
            "UNION ALL SELECT 4, 'MISSING_FX', 'BLOCKING', 0, (SELECT count(*) FROM sales "
            "WHERE fx_rate_to_cad IS NULL AND currency_code IN ('CAD', 'USD')) "
            "UNION ALL SELECT 5, 'ORPHAN_RETURNS', 'BLOCKING', 0, (SELECT count(*) FROM rec "
            "WHERE reconciliation_status = 'ORPHAN') "
            "UNION ALL SELECT 6, 'MISSING_REQUIRED_KEYS', 'BLOCKING', 0, (SELECT count(*) FROM lat "
            "WHERE order_id IS NULL OR region_code NOT IN (SELECT r_name FROM region) "
            "OR category_code NOT IN (SELECT p_type FROM part)) "
            "UNION ALL SELECT 7, 'UNSUPPORTED_CURRENCY', 'BLOCKING', 0, (SELECT count(*) FROM "
            "(SELECT currency_code FROM lat UNION ALL SELECT currency_code FROM rec) "
            "WHERE coalesce(currency_code, '') NOT IN ('CAD', 'USD')) "
            "UNION ALL SELECT 8, 'DUPLICATES_RESOLVED', 'WARNING', 0, "
            "(SELECT count(*) FROM fo) - (SELECT count(*) FROM lat) "
            "UNION ALL SELECT 9, 'QUARANTINED_ROWS', 'WARNING', 0, (SELECT count(*) FROM quar) "
            "UNION ALL SELECT 10, 'HIGH_RETURN_RATE', 'WARNING', 25, (SELECT coalesce(max(pct), 0)"
            " FROM (SELECT CAST(round(100 * sum(returns_cad) / nullif(sum(gross_revenue_cad), 0), "
            "0) AS INTEGER) AS pct FROM sales WHERE gross_revenue_cad IS NOT NULL "
            "GROUP BY category_code)) "
            "UNION ALL SELECT 11, 'VOLUME_ANOMALY', 'WARNING', 0, (SELECT count(*) FROM vol "
            "WHERE daily_orders > 3 * average_daily_orders)",
            ("fo", "fr", "sales", "rec", "lat", "quar", "vol"),
        ),
        "vol": (
            "SELECT category_code, order_date, daily_orders, average_daily_orders FROM "
            "(SELECT category_code, order_date, count(*) AS daily_orders FROM gov GROUP BY ALL) "
            "JOIN (SELECT category_code, count(*) * 1.0 / count(DISTINCT order_date) "
            "AS average_daily_orders FROM gov GROUP BY category_code) USING (category_code)",
            ("gov",),
        ),
        "res": (
            "SELECT seq, check_name, severity, CAST(n AS BIGINT) AS observed_value, "
            "CASE WHEN seq <= 2 THEN '<= ' || lim || ' minutes' WHEN seq = 10 "
            "THEN '<= ' || lim || ' percent' ELSE '= 0' END AS threshold, "
            "CASE WHEN n <= lim THEN 'PASS' WHEN severity = 'BLOCKING' THEN 'FAIL' ELSE 'WARN' END "
            "AS status, CASE check_name "
            + " ".join(
                f"WHEN '{name}' THEN CASE WHEN n <= lim THEN {good} ELSE {bad} END"
                for name, good, bad in _details()
            )
            + " END AS detail FROM obs",
            ("obs",),
        ),
        "hea": (
            "SELECT 'net_revenue_cad' AS data_product, "
            "CASE WHEN count(*) FILTER (WHERE status = 'FAIL') > 0 THEN 'BLOCKED' ELSE 'READY' END "
            "AS status, '1.0.0' AS data_contract_version, "
            f"'{variant}' AS scenario_mode, TIMESTAMP '2001-11-05' AS as_of_utc, "
            "max(observed_value) FILTER (WHERE seq = 1) AS orders_freshness_minutes, "
            "max(observed_value) FILTER (WHERE seq = 2) AS returns_freshness_minutes, "
            "CAST(240 AS BIGINT) AS freshness_sla_minutes, "
            "CAST(sum(observed_value) FILTER (WHERE seq IN (3, 8)) AS BIGINT) AS duplicate_count, "
            "max(observed_value) FILTER (WHERE seq = 4) AS missing_fx_count, "
            "max(observed_value) FILTER (WHERE seq = 5) AS orphan_return_count, "
            "max(observed_value) FILTER (WHERE seq = 6) AS missing_key_count, "
            "max(observed_value) FILTER (WHERE seq = 7) AS unsupported_currency_count, "
            "max(observed_value) FILTER (WHERE seq = 9) AS quarantined_rows, "
            "coalesce(string_agg(check_name || ': ' || detail, ' | ' ORDER BY seq) "
            "FILTER (WHERE status = 'FAIL'), '') AS blocking_reasons, "
            "coalesce(string_agg(check_name || ': ' || detail, ' | ' ORDER BY seq) "
            "FILTER (WHERE status = 'WARN'), '') AS warning_reasons, "
            f"'{run_id(variant)}' AS pipeline_run_id, "
            "CASE WHEN count(*) FILTER (WHERE status = 'FAIL') = 0 THEN TIMESTAMP '2001-11-05' END "
            "AS last_successful_refresh_utc, TIMESTAMP '2001-11-05' AS evaluated_at_utc FROM res",
            ("res",),
        ),
        "rawq": (
            "SELECT category_code, category_name, CAST(count(*) AS BIGINT) AS order_rows, "
            "CAST(count(*) FILTER (WHERE currency_code <> 'CAD') AS BIGINT) AS non_cad_rows, "
            f"CAST(sum(gross_amount) AS {D18}) AS revenue, target_cad, "
            "max(ingested_at) AS latest_ingested_at FROM fo JOIN cat USING (category_code) "
            "JOIN (SELECT category_code, target_cad FROM ft WHERE region_code = 'AMERICA' "
            "AND target_month = '1998-05') USING (category_code) WHERE region_code = 'AMERICA' "
            "AND strftime(order_timestamp_utc, '%Y-%m') = '1998-05' GROUP BY ALL",
            ("fo", "cat", "ft"),
        ),
        "rawf": (
            f"SELECT CAST(sum(revenue) AS {D18}) AS revenue, "
            f"CAST(sum(target_cad) AS {D18}) AS target_cad, "
            f"CAST(sum(revenue) - sum(target_cad) AS {D18}) AS variance_cad, "
            "CAST(100 * (sum(revenue) - sum(target_cad)) / nullif(sum(target_cad), 0) "
            f"AS {D18}) AS variance_pct, sum(revenue) > sum(target_cad) AS beat_target, "
            "first(category_code ORDER BY revenue - target_cad DESC, category_code) AS up_code, "
            "first(category_code ORDER BY revenue - target_cad, category_code) AS down_code, "
            "CAST(sum(order_rows) AS BIGINT) AS rows_scanned, "
            "CAST(sum(non_cad_rows) AS BIGINT) AS non_cad_rows, "
            "max(latest_ingested_at) AS latest_orders_ingested_at_utc FROM rawq",
            ("rawq",),
        ),
        "rawa": (
            "SELECT f.revenue, f.target_cad, f.variance_cad, f.variance_pct, f.beat_target, "
            "d.category_code AS driver_code, d.category_name AS driver_name, "
            f"CAST(d.revenue - d.target_cad AS {D18}) AS driver_variance_cad, f.rows_scanned, "
            "f.non_cad_rows, CASE WHEN f.non_cad_rows > 0 THEN 'CAD, USD' ELSE 'CAD' END "
            "AS currencies_summed, f.latest_orders_ingested_at_utc FROM rawf f JOIN rawq d "
            "ON d.category_code = CASE WHEN beat_target THEN up_code ELSE down_code END",
            ("rawf", "rawq"),
        ),
        "catv": (
            "SELECT category_code, category_name, net_revenue_cad, target_cad, "
            f"CAST(net_revenue_cad - target_cad AS {D18}) AS variance_cad FROM "
            "(SELECT category_code, category_name, target_cad, CAST(coalesce((SELECT "
            "sum(fact.net_revenue_cad) FROM fact WHERE fact.category_code = ft.category_code "
            f"AND region_code = 'AMERICA' AND year_month = '1998-05'), 0) AS {D18}) "
            "AS net_revenue_cad FROM ft WHERE region_code = 'AMERICA' "
            "AND target_month = '1998-05')",
            ("fact", "ft"),
        ),
        "gova": (
            f"SELECT CAST(sum(net_revenue_cad) AS {D18}) AS net_revenue_cad, "
            f"CAST(sum(gross_revenue_cad) AS {D18}) AS gross_revenue_cad, "
            f"CAST(sum(returns_cad) AS {D18}) AS returns_cad, t AS target_cad, "
            f"CAST(sum(net_revenue_cad) - t AS {D18}) AS variance_cad, "
            "CAST(100 * (sum(net_revenue_cad) - t) / nullif(t, 0) AS DECIMAL(9,2)) "
            "AS variance_pct, count(*) AS governed_orders, 'READY' AS status, "
            f"'{run_id(variant)}' AS pipeline_run_id, "
            "TIMESTAMP '2001-11-05' AS last_successful_refresh_utc, "
            "'1.0.0' AS data_contract_version FROM fact, "
            f"(SELECT CAST(sum(target_cad) AS {D18}) AS t FROM ft "
            "WHERE region_code = 'AMERICA' AND target_month = '1998-05') "
            "WHERE region_code = 'AMERICA' AND year_month = '1998-05' GROUP BY t",
            ("fact", "ft"),
        ),
        "lin": (
            "SELECT order_source_system, coalesce(returns_source_system, 'no return') "
            "AS returns_source_system, fx_source_system, count(*) AS fact_rows, "
            "min(pipeline_run_id) AS pipeline_run_id FROM fact "
            "WHERE region_code = 'AMERICA' AND year_month = '1998-05' GROUP BY ALL",
            ("fact",),
        ),
        "sysl": (
            "SELECT DISTINCT unnest([order_source_system, returns_source_system, "
            "fx_source_system]) AS source_system FROM lin",
            ("lin",),
        ),
        "govf": (
            "SELECT g.net_revenue_cad, g.gross_revenue_cad, g.returns_cad, g.target_cad, "
            "g.variance_cad, g.variance_pct, g.net_revenue_cad > g.target_cad AS beat_target, "
            "g.governed_orders, (SELECT count(*) FROM catv) AS category_count, "
            "w.category_code AS worst_code, w.category_name AS worst_name, "
            "w.variance_cad AS worst_variance_cad, "
            "(SELECT string_agg(source_system, ' | ' ORDER BY source_system) FROM sysl "
            "WHERE source_system NOT IN ('no return', 'none (CAD)')) AS source_lineage, "
            "'net_revenue_cad' AS metric_name, 'Net Revenue CAD' AS metric_display_name, "
            "'Gross order revenue converted to CAD at the transaction-date FX rate, minus "
            "accepted returns converted to CAD at the FX rate of the original order transaction "
            "date.' AS metric_definition, '1.0.0' AS metric_version, g.status, "
            "g.pipeline_run_id, g.last_successful_refresh_utc, g.data_contract_version "
            "FROM gova g LEFT JOIN (SELECT * FROM catv WHERE variance_cad < 0 "
            "ORDER BY variance_cad, category_code LIMIT 1) w ON true",
            ("gova", "catv", "sysl"),
        ),
    }
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in steps[name][1]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    body = ", ".join(f"{name} AS ({steps[name][0]})" for name in ordered)
    return f"WITH {body} "


def _phrase(one: str, many: str) -> str:
    return (
        "format('{:,}', CAST(n AS BIGINT)) || "
        f"CASE WHEN n = 1 THEN ' {one}' ELSE ' {many}' END"
    )


def _details() -> list[tuple[str, str, str]]:
    """(check, text when passed, text when breached) as SQL. Fixed values."""
    n = "format('{:,}', CAST(n AS BIGINT))"
    rate = "'the highest category return rate is ' || n || '% (warning above ' || lim || '%)'"
    feeds = []
    for check, feed in (("ORDERS_FRESHNESS", "orders"), ("RETURNS_FRESHNESS", "returns")):
        feeds.append(
            (
                check,
                f"'the {feed} extract is ' || {n} || ' minutes old (SLA ' || lim || ' minutes)'",
                f"'the {feed} feed is stale (last extract ' || {n} || ' minutes old; SLA ' || lim "
                "|| ' minutes)'",
            )
        )
    return [
        *feeds,
        (
            "DUPLICATE_BUSINESS_KEYS",
            "'no duplicate business keys after Silver processing'",
            _phrase("business key remains", "business keys remain")
            + " || ' duplicated after Silver processing'",
        ),
        (
            "MISSING_FX",
            "'every non-CAD order has a transaction-date FX rate'",
            "'currency conversion coverage is incomplete (' || "
            + _phrase("order has", "orders have")
            + " || ' no transaction-date FX rate)'",
        ),
        (
            "ORPHAN_RETURNS",
            "'every return references a known order'",
            _phrase("return references", "returns reference")
            + " || ' an unknown order (referential integrity violation)'",
        ),
        (
            "MISSING_REQUIRED_KEYS",
            "'all required keys are present and known'",
            _phrase("row has", "rows have") + " || ' missing or unknown required keys'",
        ),
        (
            "UNSUPPORTED_CURRENCY",
            "'all rows use an accepted currency (CAD, USD)'",
            _phrase("row uses", "rows use") + " || ' a currency outside CAD, USD'",
        ),
        (
            "DUPLICATES_RESOLVED",
            "'no duplicate order events detected'",
            _phrase("duplicate order event was", "duplicate order events were")
            + " || ' detected and discarded by the deduplication policy'",
        ),
        (
            "QUARANTINED_ROWS",
            "'no rows quarantined'",
            _phrase("row was", "rows were") + " || ' quarantined by contract rules'",
        ),
        ("HIGH_RETURN_RATE", rate, rate),
        (
            "VOLUME_ANOMALY",
            "'no category day exceeds 3x the average daily volume'",
            _phrase("category day exceeds", "category days exceed")
            + " || ' 3x the average daily volume'",
        ),
    ]


def _scan(table: str, key: str, text: str, patterns: dict[str, str]) -> str:
    hits = " UNION ALL ".join(
        f"SELECT {key}, line_number, '{name}' AS pattern FROM lines "
        f"WHERE regexp_matches(line, '{pattern.replace(chr(39), chr(39) * 2)}')"
        for name, pattern in patterns.items()
    )
    return (
        f"WITH lines AS (SELECT {key}, unnest(parts) AS line, "
        "CAST(generate_subscripts(parts, 1) AS BIGINT) AS line_number FROM "
        f"(SELECT {key}, regexp_split_to_array({text}, '\\r?\\n') AS parts FROM {table})) {hits}"
    )


def _cad(value: str, signed: bool = False) -> str:
    plus = "+" if signed else ""
    text = f"'CAD ' || format('{{:,.2f}}', CAST(abs({value}) AS DOUBLE))"
    return f"(CASE WHEN {value} >= 0 THEN '{plus}' WHEN {value} < 0 THEN '−' END || {text})"


def _pct(value: str) -> str:
    text = f"format('{{:.2f}}', CAST(abs({value}) AS DOUBLE)) || '%'"
    return f"(CASE WHEN {value} >= 0 THEN '+' WHEN {value} < 0 THEN '−' END || {text})"


def _refusal() -> str:
    """Refusal text from the health row and its reasons."""
    plain = (
        "list_transform(string_split({0}, ' | '), "
        "lambda r: regexp_replace(r, '^[A-Z_]+: ', ''))"
    )

    def sentence(column: str) -> str:
        parts = plain.format(column)
        return (
            f"CASE WHEN len({parts}) = 1 THEN {parts}[1] ELSE "
            f"array_to_string({parts}[:-2], ', ') || ' and ' || {parts}[-1] END"
        )

    return (
        f"'I cannot provide a reliable answer because ' || {sentence('blocking_reasons')} || "
        "'. Data product ' || data_product || ' is ' || status || '; no business figure is served "
        "until every blocking check passes.' || CASE WHEN warning_reasons = '' THEN '' ELSE "
        f"' Non-blocking findings: ' || {sentence('warning_reasons')} || '.' END"
    )


_SHARE = "CAST(round((coalesce(net, 0) - coalesce(target, 0)) / nullif(target, 0), 6) AS DECIMAL(18,6))"
_MEASURES = (
    f"CAST(gross AS {D18}) AS gross_revenue_cad, CAST(returned AS {D18}) AS returns_cad, "
    f"CAST(net AS {D18}) AS net_revenue_cad, CAST(target AS {D18}) AS revenue_target_cad, "
    f"CAST(coalesce(net, 0) - coalesce(target, 0) AS {D18}) AS variance_to_target_cad, "
    + _SHARE
    + " AS variance_to_target_pct, "
)


def _measures(
    keys: dict[str, tuple[str, str]], where: str, variant: str = "repaired", goals: str | None = None
) -> str:
    """Measures per group; ``keys`` maps shown name to (fact column, target column)."""
    sales_keys = ", ".join(f"{s} AS {k}" for k, (s, _) in keys.items())
    goal_keys = ", ".join(f"{t} AS {k}" for k, (_, t) in keys.items())
    names = ", ".join(keys) or "1"
    both = (
        "SELECT {k} gross_revenue_cad AS g, returns_cad AS r, net_revenue_cad AS n, "
        "CAST(NULL AS DECIMAL(18,2)) AS t, category_name AS c FROM fact {w} "
        "UNION ALL SELECT {q} NULL, NULL, NULL, target_cad, category_name FROM ft {v}"
    ).format(
        k=sales_keys + "," if keys else "", q=goal_keys + "," if keys else "", w=where,
        v=where if goals is None else goals,
    )
    select = "".join(f"{k}, " for k in keys)
    group = f"GROUP BY {names}" if keys else ""
    group_inner = f"GROUP BY {names}, c" if keys else "GROUP BY c"
    return (
        _cte("fact", "ft", variant=variant)
        + f", cells AS ({both}), per AS (SELECT {select} c, sum(g) AS g, sum(r) AS r, sum(n) AS n, "
        f"sum(t) AS t FROM cells {group_inner}), tot AS (SELECT {select} sum(g) AS gross, "
        "sum(r) AS returned, sum(n) AS net, sum(t) AS target, "
        "arg_max(c, (-(coalesce(n, 0) - coalesce(t, 0)), c)) FILTER "
        "(WHERE coalesce(n, 0) - coalesce(t, 0) < 0) AS worst "
        f"FROM per {group}) SELECT {select} {_MEASURES} worst AS largest_negative_category, "
        "TIMESTAMP '2001-11-05' AS latest_refresh_utc, 'READY' AS data_product_status, "
        f"true AS data_is_trusted, CAST(net AS {D18}) AS net_revenue_cad_trusted FROM tot"
    )


def _cube() -> str:
    """Every grain asked on its own. Among thousands of cells some shares end in an exact half of the last
    digit, which a division of doubles rounds either way, so the share is rounded half up in whole numbers."""
    gap, goal = "CAST(100 * (coalesce(net, 0) - coalesce(target, 0)) AS HUGEINT)", "CAST(100 * nullif(target, 0) AS HUGEINT)"
    millionths = f"(2000000 * abs({gap}) + abs({goal})) // (2 * abs({goal}))"
    exact = f"CAST(sign({gap}) * sign({goal}) * ({millionths}) AS DECIMAL(24,0)) * 0.000001::DECIMAL(7,6)"
    exact = f"CAST({exact} AS DECIMAL(18,6))"
    columns = {"region_code": ("region_code",) * 2, "year_month": ("year_month", "target_month"), "category_code": ("category_code",) * 2}
    parts = []
    for size in range(len(columns) + 1):
        for chosen in combinations(columns, size):
            rolled = "".join(f"CAST(NULL AS VARCHAR) AS {c}, " for c in columns if c not in chosen)
            one = _measures({c: columns[c] for c in chosen}, "").replace(_SHARE, exact)
            parts.append(f"SELECT '{','.join(chosen)}' AS grain, {rolled} * FROM ({one})")
    return " UNION ALL BY NAME ".join(parts)


def oracle_sql() -> dict[str, str]:
    sql = _written()
    sql["measures_cube"] = _cube()
    sql["pipeline_build_csv"] = sql["pipeline_build"]
    # The split paths must give what the plain ones give.
    for name in ("order_versions", "returns_reconciled_b"):
        sql[name.removesuffix("_b") + "_split"] = sql[name]
    # The same questions asked of a cell with categories below target.
    for name in ("largest_negative", "category_variance"):
        sql[f"{name}_below"] = sql[name].replace(f"'{MONTH}'", f"'{MONTH_BELOW}'")
    return sql


def _written() -> dict[str, str]:
    def good(*names: str) -> str:
        return _cte(*names, variant="repaired")

    def bad(*names: str) -> str:
        return _cte(*names, variant="broken")

    def odd(*names: str) -> str:
        return _cte(*names, variant="malformed")

    def lines(column: str) -> str:
        return f"array_to_string(string_split({column}, ' | '), chr(10)) AS {column}"

    conformance = (
        "SELECT 'orders' AS feed, rule, violations FROM ("
        + " UNION ALL ".join(
            f"SELECT 'required.{c}' AS rule, count(*) FILTER (WHERE {c} IS NULL) AS violations "
            "FROM fo"
            for c in (
                "order_id",
                "event_id",
                "event_version",
                "order_timestamp_utc",
                "region_code",
                "category_code",
                "currency_code",
                "gross_amount",
                "customer_segment",
                "source_updated_at",
                "ingested_at",
            )
        )
        + " UNION ALL SELECT 'reference.region_code', count(*) FILTER (WHERE region_code NOT IN "
        "(SELECT r_name FROM region)) FROM fo UNION ALL SELECT 'reference.category_code', "
        "count(*) FILTER (WHERE category_code NOT IN (SELECT p_type FROM part)) FROM fo "
        "UNION ALL SELECT 'accepted.currency_code', count(*) FILTER (WHERE currency_code NOT IN "
        "('CAD', 'USD')) FROM fo UNION ALL SELECT 'UNKNOWN_DATE', count(*) FILTER "
        "(WHERE order_date NOT IN (SELECT calendar_date FROM cal)) FROM gov)"
    )
    check = "SELECT check_name, CAST(n AS BIGINT) AS observed_value FROM obs WHERE check_name IN "
    gov_columns = (
        "order_id, event_id, event_version, order_timestamp_utc, order_date, region_code, "
        "category_code, currency_code, gross_amount, customer_segment, source_updated_at, "
        "ingested_at"
    )
    event_columns = (
        "order_id, event_id, event_version, order_timestamp_utc, region_code, category_code, "
        "currency_code, gross_amount, customer_segment, source_updated_at, ingested_at, "
        "'azure_sql.sales.orders' AS source_system, 'lineitem' AS source_file"
    )
    return_columns = (
        "return_id, order_id, return_timestamp_utc, return_amount, currency_code, "
        "source_updated_at, right(repeat('0', 20) || l_partkey, 20) || '/' || "
        "right(repeat('0', 20) || l_suppkey, 20) AS return_reason, "
        "'sqlserver.dbo.returns' AS source_system, 'lineitem' AS source_file"
    )
    fact_columns = (
        "order_key, date_key, region_key, category_key, gross_revenue_cad, returns_cad, "
        "net_revenue_cad, original_currency, gross_amount_original_currency, applied_fx_rate, "
        "return_count, pipeline_run_id, order_source_system, order_source_event_id, "
        "order_source_updated_at, returns_source_system, fx_source_system"
    )
    results = "SELECT check_name, severity, status, observed_value, threshold, detail FROM res"
    run_counts = (
        "SELECT pipeline_run_id, scenario_mode, TIMESTAMP '2001-11-05' AS started_at_utc, "
        "TIMESTAMP '2001-11-05' AS completed_at_utc, status, "
        "(SELECT count(*) FROM fo) AS bronze_order_rows, "
        "(SELECT count(*) FROM fr) AS bronze_return_rows, "
        "(SELECT count(*) FROM sales) AS silver_sales_rows, quarantined_rows, duplicate_count, "
        "missing_fx_count, orphan_return_count, "
        "greatest(orders_freshness_minutes, returns_freshness_minutes) AS freshness_minutes, "
        "data_contract_version, blocking_reasons AS failure_reasons, warning_reasons FROM hea"
    )
    figures = "net_revenue_cad, target_cad, variance_cad"
    compare_raw = (
        "SELECT 'raw' AS path, CASE WHEN beat_target THEN 'Beat target' ELSE 'Missed target' END "
        f"AS answer, {_cad('revenue')} AS figure, {_cad('variance_cad', True)} || ' (' || "
        f"{_pct('variance_pct')} || ')' AS variance, driver_name || ' (driver)' AS category, "
        "'none' AS evidence FROM rawa"
    )
    compare_good = (
        "SELECT 'governed, repaired feeds', CASE WHEN beat_target THEN 'Beat target' "
        f"ELSE 'Missed target' END, {_cad('net_revenue_cad')}, {_cad('variance_cad', True)} || "
        f"' (' || {_pct('variance_pct')} || ')', "
        "coalesce(worst_name || ' (largest negative)', 'none'), "
        "status || ' · ' || pipeline_run_id FROM govf"
    )
    verdict = "CASE WHEN beat_target THEN 'Yes. America beat' ELSE 'No. America missed' END"
    gap_text = (
        f"' against a target of ' || {_cad('target_cad')} || ', a variance of ' || "
        f"{_cad('variance_cad', True)} || ' (' || {_pct('variance_pct')} || '). '"
    )
    cells = "SELECT region_code, category_code, {0} FROM {1} GROUP BY region_code, category_code"
    net_cad = f"CAST(sum(gross_revenue_cad - returns_cad) AS {D18}) AS net_cad"
    return {
        "order_versions": good("fo")
        + "SELECT a.*, 'azure_sql.sales.orders' AS source_system, row_number() OVER (PARTITION BY order_id ORDER BY event_version DESC, "
        "source_updated_at DESC, event_id DESC, gross_amount DESC) AS version_rank, "
        "CASE WHEN customer_segment = 'MACHINERY' THEN 'TEST_TRANSACTION' "
        "WHEN gross_amount <= 1000 THEN 'INVALID_AMOUNT' END AS quarantine_reason FROM fo a",
        "orders_latest": good("gov") + f"SELECT {gov_columns} FROM gov",
        "orders_latest_maxby": good("gov") + f"SELECT {gov_columns} FROM gov",
        "returns_reconciled_b": bad("rec")
        + "SELECT return_id, order_id, return_timestamp_utc, return_amount, currency_code, "
        "source_updated_at, ingested_at, reconciliation_status, quarantine_reason FROM rec",
        "return_status_counts_b": bad("rec")
        + "SELECT reconciliation_status, quarantine_reason, count(*) AS returns FROM rec "
        "GROUP BY ALL",
        "return_status_counts": good("rec")
        + "SELECT reconciliation_status, quarantine_reason, count(*) AS returns FROM rec "
        "GROUP BY ALL",
        "quarantine_b": bad("quar")
        + f"SELECT *, '{run_id('broken')}' AS pipeline_run_id FROM quar",
        "reconciled_sales": good("sales") + "SELECT * FROM sales",
        "reconciled_sales_b": bad("sales") + "SELECT * FROM sales",
        "date_dimension": "WITH days AS (SELECT CAST(g AS DATE) AS d FROM (SELECT "
        "unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS g "
        "FROM orders)) SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, "
        "d AS calendar_date, CAST(year(d) AS INTEGER) AS calendar_year, "
        "CAST(month(d) AS INTEGER) AS month_number, CAST(day(d) AS INTEGER) AS day_of_month, "
        "strftime(d, '%Y-%m') AS year_month, monthname(d) AS month_name, dayname(d) AS day_name "
        "FROM days",
        "dimensions": good("cat")
        + "SELECT 'category' AS dimension, category_key AS key, category_code AS code, "
        "category_name AS name FROM cat UNION ALL SELECT 'region', r_regionkey, r_name, "
        "upper(substr(r_name, 1, 1)) || lower(substr(r_name, 2)) FROM region "
        "WHERE r_name NOT LIKE '% %' UNION ALL SELECT 'region', r_regionkey, r_name, "
        "upper(substr(r_name, 1, 1)) || lower(split_part(substr(r_name, 2), ' ', 1)) || ' ' || "
        "upper(substr(split_part(r_name, ' ', 2), 1, 1)) || "
        "lower(substr(split_part(r_name, ' ', 2), 2)) FROM region WHERE r_name LIKE '% %'",
        "fact_sales": good("fact") + f"SELECT {fact_columns} FROM fact",
        "fact_sales_unbroadcast": good("fact") + f"SELECT {fact_columns} FROM fact",
        "published_fact": good("fact") + f"SELECT {fact_columns} FROM fact",
        "withheld_fact_b": bad("fact") + f"SELECT {fact_columns} FROM fact WHERE false",
        "fact_targets": good("ft")
        + "SELECT CAST(replace(target_month, '-', '') || '01' AS INTEGER) AS date_key, "
        "region_key, category_key, target_month, target_cad, "
        f"'{run_id('repaired')}' AS pipeline_run_id FROM ft",
        "fx_gap_days_b": bad("gov", "fx")
        + "SELECT order_date, currency_code, count(*) AS transactions FROM gov "
        "WHERE currency_code = 'USD' AND order_date NOT IN (SELECT rate_date FROM fx) "
        "GROUP BY ALL",
        "fx_gap_ranges_b": bad("gov", "fx")
        + ", gap AS (SELECT order_date, currency_code, count(*) AS n FROM gov WHERE currency_code = 'USD' "
        "AND order_date NOT IN (SELECT rate_date FROM fx) GROUP BY ALL), "
        "heads AS (SELECT *, coalesce(lag(order_date) OVER w < order_date - 1, true) AS head FROM gap "
        "WINDOW w AS (PARTITION BY currency_code ORDER BY order_date)), "
        "runs AS (SELECT *, sum(CAST(head AS INT)) OVER (PARTITION BY currency_code ORDER BY order_date) AS run FROM heads) "
        "SELECT currency_code, min(order_date) AS first_day, max(order_date) AS last_day, count(*) AS days, "
        "CAST(sum(n) AS BIGINT) AS transactions FROM runs GROUP BY currency_code, run",
        "facts_json": good("rawa", "rawq")
        + "SELECT rawa.revenue, rawa.variance_pct, rawa.latest_orders_ingested_at_utc, driver_code, driver_variance_cad, "
        "category_code, category_name, rawq.revenue AS actual_cad, rawq.target_cad, "
        f"CAST(rawq.revenue - rawq.target_cad AS {D18}) AS variance_cad FROM rawq CROSS JOIN rawa",
        "health_report_b": bad("hea")
        + f"SELECT * REPLACE ({lines('blocking_reasons')}, {lines('warning_reasons')}) FROM hea",
        "run_list_b": bad("hea", "fo", "fr", "sales")
        + f"SELECT * REPLACE ({lines('failure_reasons')}, {lines('warning_reasons')}) FROM ({run_counts})",
        "check_freshness_b": bad("obs") + check + "('ORDERS_FRESHNESS', 'RETURNS_FRESHNESS')",
        "check_duplicate_keys": good("obs") + check + "('DUPLICATE_BUSINESS_KEYS')",
        "check_missing_fx_b": bad("obs") + check + "('MISSING_FX')",
        "check_orphans_b": bad("obs") + check + "('ORPHAN_RETURNS')",
        "check_missing_keys_b": bad("obs") + check + "('MISSING_REQUIRED_KEYS')",
        "check_currency_b": bad("obs") + check + "('UNSUPPORTED_CURRENCY')",
        "check_resolved": good("obs") + check + "('DUPLICATES_RESOLVED')",
        "check_quarantined": good("obs") + check + "('QUARANTINED_ROWS')",
        "check_return_rate": good("obs") + check + "('HIGH_RETURN_RATE')",
        "check_volume": good("obs") + check + "('VOLUME_ANOMALY')",
        "daily_volumes": good("vol")
        + "SELECT category_code, order_date, daily_orders, "
        "CAST(round(average_daily_orders, 4) AS DECIMAL(18,4)) AS average_daily_orders FROM vol",
        "quality_results": good("res") + results,
        "quality_results_b": bad("res") + results,
        "quality_strict": good("res")
        .replace("'WARNING', 25", "'WARNING', 2")
        .replace("'BLOCKING' AS severity, 240", "'BLOCKING' AS severity, 10")
        + "SELECT check_name, severity, observed_value, threshold, status, detail FROM res",
        "health": good("hea") + "SELECT * FROM hea",
        "health_b": bad("hea") + "SELECT * FROM hea",
        "contract_metadata": good("obs")
        + "SELECT check_name, severity, CAST(n AS BIGINT) AS observed_value FROM obs",
        "pipeline_build": good("hea", "fo", "fr", "sales") + run_counts,
        "pipeline_evidence_b": bad("hea", "fo", "fr", "sales") + run_counts,
        "quarantined_rows": good("quar")
        + "SELECT source_entity, record_key, quarantine_reason, source_system, "
        f"'{run_id('repaired')}' AS pipeline_run_id FROM quar",
        "raw_answer": good("rawq") + "SELECT * FROM rawq",
        "raw_facts": good("rawa") + "SELECT * FROM rawa",
        "raw_categories": good("rawq")
        + "SELECT category_code, category_name, revenue AS actual_cad, target_cad, "
        f"CAST(revenue - target_cad AS {D18}) AS variance_cad FROM rawq",
        "raw_governance": good("rawa")
        + "SELECT 'Approved metric definition' AS aspect, "
        "'none: ''revenue'' is whatever SUM(gross_amount) returns' AS note "
        "UNION ALL SELECT 'Currency handling', 'none: ' || non_cad_rows || "
        "' non-CAD rows summed as if CAD' FROM rawa "
        "UNION ALL SELECT 'Deduplication', 'none: raw landing rows read directly' "
        "UNION ALL SELECT 'Returns', 'not consulted' UNION ALL SELECT 'Freshness check', 'none' "
        "UNION ALL SELECT 'Data-product health gate', 'none' "
        "UNION ALL SELECT 'Lineage / run id', 'none'",
        "governed_answer": good("gova") + "SELECT * FROM gova",
        "governed_answer_b": bad("gova", "hea")
        + "SELECT gova.* FROM gova WHERE 'READY' = (SELECT status FROM hea)",
        "governed_facts": good("govf") + "SELECT * FROM govf",
        "category_variance": good("catv") + "SELECT * FROM catv",
        "largest_negative": good("catv")
        + "SELECT * FROM catv WHERE variance_cad < 0 ORDER BY variance_cad, category_code LIMIT 1",
        "largest_negative_by_cell": good("fact", "ft")
        + "SELECT region_code, year_month, max(category_name) AS largest_negative_category FROM "
        "(SELECT ft.region_code, ft.target_month AS year_month, ft.category_name, "
        "coalesce(f.net, 0) - ft.target_cad AS gap, min(coalesce(f.net, 0) - ft.target_cad) "
        "OVER (PARTITION BY ft.region_code, ft.target_month) AS lowest FROM ft LEFT JOIN "
        "(SELECT region_code, year_month, category_code, sum(net_revenue_cad) AS net FROM fact "
        "GROUP BY ALL) f ON f.region_code = ft.region_code AND f.year_month = ft.target_month "
        "AND f.category_code = ft.category_code) WHERE gap = lowest AND gap < 0 GROUP BY ALL",
        "source_lineage": good("lin") + "SELECT * FROM lin",
        "lineage_systems": good("sysl")
        + "SELECT source_system FROM sysl WHERE source_system NOT IN ('no return', 'none (CAD)')",
        "governed_or_refusal": good("gova")
        + "SELECT 'ANSWER' AS kind, status, pipeline_run_id, CAST(0 AS BIGINT) AS reason_count, "
        f"CAST(NULL AS VARCHAR) AS message, {figures} FROM gova",
        "governed_or_refusal_b": bad("hea")
        + "SELECT 'REFUSAL' AS kind, status, pipeline_run_id, "
        "CAST(len(string_split(blocking_reasons, ' | ')) AS BIGINT) AS reason_count, "
        f"{_refusal()} AS message, CAST(NULL AS {D18}) AS net_revenue_cad, "
        f"CAST(NULL AS {D18}) AS target_cad, CAST(NULL AS {D18}) AS variance_cad FROM hea",
        "outcome_comparison": "SELECT * FROM ("
        + bad("rawa", "hea")
        + compare_raw
        + " UNION ALL SELECT 'governed, broken feeds', 'Refused', 'withheld', 'withheld', "
        "'withheld', status || ' · ' || pipeline_run_id FROM hea) UNION ALL SELECT * FROM ("
        + good("govf")
        + compare_good
        + ")",
        "comparison_series": good("rawa", "gova")
        + "SELECT 'Naive raw revenue' AS measure, revenue AS cad FROM rawa UNION ALL "
        "SELECT 'Target', target_cad FROM rawa UNION ALL "
        "SELECT 'Governed net revenue', net_revenue_cad FROM gova",
        "run_history_latest": "SELECT user_id, event_id, ts, event_type FROM events e WHERE NOT "
        "EXISTS (SELECT 1 FROM events n WHERE n.user_id = e.user_id AND (n.ts > e.ts OR "
        "(n.ts = e.ts AND n.event_id > e.event_id)))",
        "measures_by_region_month": _measures(
            {"region_code": ("region_code",) * 2, "year_month": ("year_month", "target_month")}, ""
        ),
        "measures_one_month": _measures(
            {"region_code": ("region_code",) * 2, "category_code": ("category_code",) * 2},
            f"WHERE year_month = '{MONTH}'",
            goals=f"WHERE target_month = '{MONTH}'",
        ),
        "measures_by_category": _measures(
            {"category_code": ("category_code",) * 2}, "WHERE region_code = 'AMERICA'"
        ),
        "measures_total": _measures({}, ""),
        "measures_trusted_b": bad("hea")
        + f"SELECT CAST(NULL AS {D18}) AS gross_revenue_cad, CAST(NULL AS {D18}) AS returns_cad, "
        f"CAST(NULL AS {D18}) AS net_revenue_cad, CAST(NULL AS {D18}) AS revenue_target_cad, "
        f"CAST(NULL AS {D18}) AS variance_to_target_cad, "
        "CAST(NULL AS DECIMAL(18,6)) AS variance_to_target_pct, "
        "CAST(NULL AS VARCHAR) AS largest_negative_category, "
        "last_successful_refresh_utc AS latest_refresh_utc, status AS data_product_status, "
        f"status = 'READY' AS data_is_trusted, CAST(NULL AS {D18}) AS net_revenue_cad_trusted "
        "FROM hea",
        "narration_rows": good("rawa", "govf")
        + f"SELECT 'raw' AS path, {verdict} || ' its May 1998 revenue target: revenue was ' || "
        f"{_cad('revenue')} || {gap_text} || driver_name || ' drove the result, finishing ' || "
        f"{_cad('driver_variance_cad', True)} || ' versus its category target.' AS text, "
        "'Deterministic conference fallback — no live LLM' AS label FROM rawa "
        f"UNION ALL SELECT 'governed', {verdict} || ' its May 1998 target. ' || "
        f"metric_display_name || ' was ' || {_cad('net_revenue_cad')} || {gap_text} || "
        "coalesce(worst_name || ' was the largest negative contributor at ' || "
        f"{_cad('worst_variance_cad', True)} || ' versus its category target. ', "
        "'No category finished below its target. ') || 'Evidence: pipeline run ' || "
        "pipeline_run_id || ', refreshed 2001-11-05 00:00:00 UTC, data contract ' || "
        "data_contract_version || ', status ' || status || '.', "
        "'Deterministic conference fallback — no live LLM' FROM govf",
        "narration_refused_b": bad("hea")
        + f"SELECT 'governed' AS path, {_refusal()} AS text, 'Deterministic refusal — enforced in "
        "data-access code; no model consulted' AS label FROM hea",
        "money_text": good("fo")
        + f"SELECT region_code, category_code, {_cad('total')} AS total_text, "
        f"{_cad('usd', True)} AS usd_text, {_pct('share')} AS share_text FROM "
        "(SELECT *, CAST(100 * usd / total AS DECIMAL(9,2)) AS share FROM "
        "(SELECT region_code, category_code, sum(gross_amount) AS total, "
        "-sum(gross_amount) FILTER (WHERE currency_code = 'USD') AS usd FROM fo GROUP BY ALL))",
        "secret_scan": _scan(
            "documents", "doc_id", "text", {**SECRET_PATTERNS, **CALLER_PATTERNS}
        ),
        "pattern_scan": _scan("pages", "page_id", "html", MARKUP_PATTERNS),
        "grounded_numbers": "WITH t AS (SELECT page_id, "
        "list_transform(regexp_extract_all(url, '[0-9][0-9,]*(?:\\.[0-9]+)?'), "
        "lambda x: replace(x, ',', '')) AS used, "
        "list_transform(regexp_extract_all(html, '[0-9][0-9,]*(?:\\.[0-9]+)?'), "
        "lambda x: replace(x, ',', '')) AS given FROM pages), "
        "u AS (SELECT page_id, unnest(used) AS n, generate_subscripts(used, 1) AS i FROM t), "
        "g AS (SELECT page_id, unnest(given) AS n FROM t), allowed AS (SELECT page_id, n FROM g "
        "UNION SELECT page_id, split_part(n, '.', 1) FROM g WHERE contains(n, '.') "
        "UNION SELECT page_id, rtrim(rtrim(n, '0'), '.') FROM g WHERE contains(n, '.')), "
        "miss AS (SELECT page_id, n, min(i) AS i FROM u WHERE NOT EXISTS (SELECT 1 FROM allowed a "
        "WHERE a.page_id = u.page_id AND a.n = u.n) GROUP BY page_id, n) "
        "SELECT p.page_id, count(n) AS unknown, coalesce(string_agg(n, ' ' ORDER BY i), '') "
        "AS numbers FROM pages p LEFT JOIN miss USING (page_id) GROUP BY p.page_id",
        "table_diff": "WITH l AS (SELECT * FROM ("
        + bad("fr")
        + f"SELECT {return_columns} FROM fr)), "
        "r AS (SELECT * FROM ("
        + good("fr")
        + f"SELECT {return_columns} FROM fr)), "
        "d AS (SELECT return_id, 1 AS a, 0 AS b FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r) "
        "UNION ALL SELECT return_id, 0, 1 FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM l)) "
        "SELECT return_id, CASE WHEN sum(b) = 0 THEN 'left_only' WHEN sum(a) = 0 "
        "THEN 'right_only' ELSE 'changed' END AS difference, CAST(sum(a) AS BIGINT) AS left_rows, "
        "CAST(sum(b) AS BIGINT) AS right_rows FROM d GROUP BY return_id",
        "row_differences": "WITH l AS (SELECT * FROM ("
        + bad("fo")
        + f"SELECT {event_columns} FROM fo)), r AS (SELECT * FROM ("
        + good("fo")
        + f"SELECT {event_columns} FROM fo)) "
        "SELECT *, count(*) AS left_surplus, CAST(0 AS BIGINT) "
        "AS right_surplus FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r) GROUP BY ALL "
        "UNION ALL SELECT *, 0, count(*) FROM "
        "(SELECT * FROM r EXCEPT ALL SELECT * FROM l) GROUP BY ALL",
        "table_manifest_hash": " UNION ALL ".join(
            f"SELECT '{table}' AS table_name, count(*) AS rows, CAST(coalesce(sum(round(CAST("
            f"{MANIFEST[table]} AS DECIMAL(18,4)) * 100, 0)), 0) AS DECIMAL(38,0)) AS cents, "
            "CAST(sum(CAST('0x' || substr(md5(concat_ws(chr(31), "
            + ", ".join(_value_text(c) for c in columns)
            + f")), 1, {HASH_DIGITS}) AS BIGINT)) AS DECIMAL(38,0)) AS content_hash FROM {table}"
            for table, columns in TABLE_COLUMNS.items()
        ),
        "table_manifest": " UNION ALL ".join(
            f"SELECT '{table}' AS table_name, count(*) AS rows, CAST(sum(round(CAST({column} "
            f"AS DECIMAL(18,4)) * 100, 0)) AS DECIMAL(38,0)) AS cents FROM {table}"
            for table, column in MANIFEST.items()
        ),
        "dual_net_check": good("sales")
        + f"SELECT region_code, category_code, {net_cad}, "
        f"CAST(sum(gross_revenue_cad) - sum(returns_cad) AS {D18}) AS net_second_route_cad, "
        "true AS agree FROM sales GROUP BY region_code, category_code",
        "naive_totals": good("fo")
        + cells.format(f"CAST(sum(gross_amount) AS {D18}) AS naive_cad", "fo"),
        "batch_invariants_b": bad("fo", "fr", "gov", "rec", "sales", "fx", "ft")
        + ", v AS (SELECT 'orders_with_replays' AS check_name, count(*) > 0 AS holds, "
        "count(*) AS value FROM (SELECT 1 FROM fo GROUP BY order_id HAVING count(*) > 1) "
        "UNION ALL SELECT 'returns_age_within_sla', n <= 240, n FROM (SELECT date_diff('minute', "
        "max(ingested_at), TIMESTAMP '2001-11-05') AS n FROM fr) "
        "UNION ALL SELECT 'no_orphan_returns', count(*) = 0, count(*) FROM rec "
        "WHERE reconciliation_status = 'ORPHAN' "
        "UNION ALL SELECT 'every_date_has_a_rate', count(*) = 0, count(*) FROM gov "
        "WHERE currency_code = 'USD' AND order_date NOT IN (SELECT rate_date FROM fx)), "
        "s AS (SELECT (SELECT sum(gross_amount) FROM fo WHERE region_code = 'AMERICA' AND "
        "strftime(order_timestamp_utc, '%Y-%m') = '1998-05') AS naive, "
        "(SELECT sum(target_cad) FROM ft WHERE region_code = 'AMERICA' AND "
        "target_month = '1998-05') AS target, "
        "(SELECT sum(gross_revenue_cad - returns_cad) FROM sales WHERE region_code = 'AMERICA' "
        "AND strftime(order_date, '%Y-%m') = '1998-05') AS net) "
        f"SELECT check_name, holds, CAST(value AS {D18}) AS value FROM v UNION ALL "
        f"SELECT 'naive_above_target', naive > target, CAST(naive - target AS {D18}) FROM s "
        f"UNION ALL SELECT 'target_above_governed', target > net, CAST(target - net AS {D18}) "
        "FROM s",
        "conformance_b": bad("fo", "gov", "cal") + conformance,
        "conformance_c": odd("fo", "gov", "cal") + conformance,
        "conformance_returns_b": bad("fo", "fr")
        + "SELECT 'returns' AS feed, rule, violations FROM ("
        + " UNION ALL ".join(
            f"SELECT 'required.{name}' AS rule, count(*) FILTER (WHERE {value} IS NULL) AS violations FROM fr"
            for name, value in (
                ("return_id", "return_id"),
                ("order_id", "order_id"),
                ("return_timestamp_utc", "return_timestamp_utc"),
                ("return_amount", "return_amount"),
                ("currency_code", "currency_code"),
                ("return_reason", "coalesce(l_partkey, l_suppkey)"),
                ("source_updated_at", "source_updated_at"),
                ("ingested_at", "ingested_at"),
            )
        )
        + " UNION ALL SELECT 'accepted.currency_code', count(*) FILTER (WHERE currency_code NOT IN ('CAD', 'USD')) FROM fr "
        "UNION ALL SELECT 'reference.order_id', count(*) FROM fr WHERE NOT EXISTS "
        "(SELECT 1 FROM fo WHERE fo.order_id = fr.order_id))",
        "conformance_rates_c": odd("fx")
        + "SELECT 'fx_rates' AS feed, rule, violations FROM ("
        + " UNION ALL ".join(
            f"SELECT 'required.{c}' AS rule, CAST(0 AS BIGINT) AS violations"
            for c in ("from_currency", "to_currency", "published_at_utc", "ingested_at")
        )
        + " UNION ALL SELECT 'required.rate_date', count(*) FILTER (WHERE rate_date IS NULL) FROM fx "
        "UNION ALL SELECT 'required.rate', count(*) FILTER (WHERE rate IS NULL) FROM fx "
        "UNION ALL SELECT 'unique_key', count(*) FROM (SELECT 1 FROM fx GROUP BY rate_date HAVING count(*) > 1))",
        "unknown_order_ids_b": bad("fo", "fr")
        + "SELECT order_id, count(*) AS rows FROM fr WHERE order_id NOT IN (SELECT order_id FROM fo) GROUP BY order_id",
        "check_duplicate_keys_c": odd("obs") + check + "('DUPLICATE_BUSINESS_KEYS')",
        "check_missing_keys_c": odd("obs") + check + "('MISSING_REQUIRED_KEYS')",
        "quality_evaluated_c": odd("res")
        + "SELECT check_name, severity, observed_value, threshold, status, detail FROM res",
        "target_allocation": good("sales")
        + f", a AS ({cells.format(net_cad, 'sales')}), g AS (SELECT region_code, "
        f"CAST(round(CAST(sum(net_cad) AS {D18}) * CAST({ALLOCATION_FACTOR} AS DECIMAL(6,3)) "
        f"/ 1000, 0) * 1000 AS {D18}) AS goal, CAST(sum(net_cad) AS DOUBLE) AS total, "
        "min(category_code) AS head FROM a GROUP BY region_code), "
        "p AS (SELECT region_code, category_code, CAST(round(CAST(goal AS DOUBLE) * "
        f"CAST(net_cad AS DOUBLE) / nullif(total, 0) / 100) * 100 AS {D18}) AS part "
        "FROM a JOIN g USING (region_code) WHERE category_code <> head) "
        "SELECT region_code, category_code, part AS target_cad FROM p UNION ALL "
        f"SELECT region_code, head, CAST(goal - coalesce((SELECT sum(part) FROM p "
        f"WHERE p.region_code = g.region_code), 0) AS {D18}) FROM g",
        "feed_at_watermark": good("fr")
        + "SELECT return_id, order_id, return_amount, source_updated_at, "
        f"TIMESTAMP '{WATERMARK}' AS ingested_at FROM fr "
        f"WHERE source_updated_at <= TIMESTAMP '{WATERMARK}'",
    }
