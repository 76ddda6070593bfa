"""DuckDB SQL for every named query, written without looking at the Spark plans.

Overlaps are found by joining promotions with each other, transactions are tagged by three
joins and a union, and checks count offending rows one by one.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2001-06-30'"
DATA_START = "DATE '1997-01-01'"
DATE_FILTER = 19970101
KEYS = "OutletIdentifier, ReportingBrandName, PromotionName, PromoTrueStartDate_dt, PromoTrueEndDate_dt"
LINE = "OutletKey, ProductKey, DateKey, TransactionID"
CHECK = "check_name, passed, value"


def _as_date(key: str) -> str:
    return f"CAST(strptime(CAST({key} AS VARCHAR), '%Y%m%d') AS DATE)"


def _as_key(day: str) -> str:
    return f"CAST(strftime({day}, '%Y%m%d') AS INTEGER)"


PROMOTION = """
    'PROMO-' || yr || 'H' || half AS PromotionName, 'Save now' AS PromotionSlogan,
    'PRICE' AS PromotionType,
    CASE WHEN (yr * 10 + half) % 2 = 0 THEN 'multipack' ELSE 'buydown' END AS PromotionCategory,
    'standard' AS PromotionSubCategory,
    CAST(yr * 10000 + CASE half WHEN 1 THEN 101 ELSE 701 END AS INTEGER) AS PromotionStartDateKey,
    CAST(yr * 10000 + CASE half WHEN 1 THEN 630 ELSE 1231 END AS INTEGER) AS PromotionEndDateKey,
    CASE WHEN yr = 2001 AND half = 2 THEN 'I' ELSE 'A' END AS ActiveFlag,
    CASE yr % 3 WHEN 0 THEN 'Committed' WHEN 1 THEN 'Closed' ELSE 'Draft' END AS PromotionStatus,
    'CORE' AS TargetProductCategory, 'ALL' AS TargetGeography, 'ALL' AS TargetSegmentation"""

SPAN = f"""
    SELECT OutletIdentifier, PromotionName, ReportingBrandName,
           min(PromotionRateStartDateKey) AS PromoTrueStartDate,
           max(PromotionRateEndDateKey) AS PromoTrueEndDate,
           {_as_date('min(PromotionRateStartDateKey)')} AS PromoTrueStartDate_dt,
           {_as_date('max(PromotionRateEndDateKey)')} AS PromoTrueEndDate_dt,
           CAST(trunc(({_as_date('max(PromotionRateEndDateKey)')}
                       - {_as_date('min(PromotionRateStartDateKey)')}) / 7.0) AS INTEGER) AS DurationWeeks
    FROM {{rates}}
    GROUP BY OutletIdentifier, PromotionName, ReportingBrandName"""

ACCEPTED = f"""
    SELECT p.*, f.before_overlap, f.after_overlap,
           p.before_data_ok AND f.before_overlap = 0 AS has_before_window,
           p.after_data_ok AND f.after_overlap = 0 AS has_after_window,
           CASE WHEN p.before_data_ok AND f.before_overlap = 0 THEN p.before_candidate_start END AS before_window_start,
           CASE WHEN p.before_data_ok AND f.before_overlap = 0 THEN p.before_candidate_end END AS before_window_end,
           CASE WHEN p.after_data_ok AND f.after_overlap = 0 THEN p.after_candidate_start END AS after_window_start,
           CASE WHEN p.after_data_ok AND f.after_overlap = 0
                THEN least(p.after_candidate_end, {AS_OF}) END AS after_window_end
    FROM promos p JOIN {{flags}} f USING (OutletIdentifier, ReportingBrandName, PromotionName)"""


def _tag(period: str, first: str, last: str, condition: str) -> str:
    return f"""
    SELECT w.OutletIdentifier, w.ReportingBrandName, w.PromotionName, w.PromoTrueStartDate_dt,
           w.PromoTrueEndDate_dt, l.LoyaltyCode, l.MetricVolume, l.MetricValue, '{period}' AS period
    FROM loyalty_valid l
    JOIN windows w ON w.OutletIdentifier = l.OutletIdentifier
                  AND w.ReportingBrandName = l.ReportingBrandName
                  AND {_as_date('l.DateKey')} >= w.{first} AND {_as_date('l.DateKey')} <= w.{last}
    WHERE {condition}"""


CTES: dict[str, str] = {
    "line_amounts": """
        SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
               CAST(l_discount AS DECIMAL(4,2)) AS disc, CAST(l_tax AS DECIMAL(4,2)) AS tax
        FROM lineitem""",
    "scan": f"""
        SELECT l_suppkey AS OutletKey, l_partkey AS ProductKey, {_as_key('l_shipdate')} AS DateKey,
               l_extendedprice / l_quantity AS MetricPrice,
               CAST(l_quantity AS DECIMAL(18,2)) AS MetricVolume,
               CAST(price AS DECIMAL(18,2)) AS MetricValue,
               CASE o_custkey % 10 WHEN 0 THEN '' WHEN 1 THEN '0' WHEN 2 THEN NULL
                    ELSE CAST(o_custkey AS VARCHAR) END AS LoyaltyNumber,
               CAST(l_returnflag = 'R' AS INTEGER) AS PromotionFlag,
               CASE WHEN l_linestatus = 'F' THEN NULL ELSE o_orderpriority END AS AccountPromotionName,
               CAST(l_orderkey AS VARCHAR) AS TransactionID,
               CAST(CASE WHEN l_linenumber <= 2 THEN price * disc ELSE 0 END AS DECIMAL(18,4)) AS ManufacturerDiscountValue,
               CAST(CASE l_linenumber % 3 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE tax END AS DECIMAL(18,4)) AS ManufacturerMultipackAmount,
               CAST(tax AS DECIMAL(18,4)) AS OutletMultipackDiscountAmount,
               CAST(price * tax AS DECIMAL(18,4)) AS OutletMultipackValue,
               CAST(price * disc AS DECIMAL(18,4)) AS ManufacturerMultipackValue,
               CAST(CASE WHEN l_returnflag = 'R' THEN price * tax ELSE 0 END AS DECIMAL(18,4)) AS CouponDiscountValue
        FROM line_amounts JOIN orders ON l_orderkey = o_orderkey
        WHERE {_as_key('l_shipdate')} >= {DATE_FILTER}""",
    "scan_discounts": """
        SELECT *, CAST(SMP_discount > 0 OR coalesce(MP_discount > 0, false) OR CPN_discount > 0 AS INTEGER) AS is_promo
        FROM (SELECT *, ManufacturerDiscountValue AS SMP_discount,
                     CASE WHEN ManufacturerMultipackAmount <= 0 AND OutletMultipackDiscountAmount > 0
                          THEN OutletMultipackValue
                          WHEN ManufacturerMultipackAmount > 0 THEN ManufacturerMultipackValue
                          ELSE 0 END AS MP_discount,
                     CouponDiscountValue AS CPN_discount
              FROM scan)""",
    "outlet_all": """
        SELECT s_suppkey AS OutletKey, lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS OutletIdentifier,
               n_name AS State, CASE WHEN s_suppkey % 10 = 9 THEN NULL ELSE r_name END AS SubmitterName,
               s_nationkey AS ChainId, n_name AS ChainName,
               CASE WHEN s_suppkey % 10 = 8 THEN 'I' ELSE 'A' END AS ActiveFlag
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "outlet": "SELECT * EXCLUDE (ActiveFlag) FROM outlet_all WHERE ActiveFlag = 'A'",
    "product": """
        SELECT p_partkey AS ProductKey, p_type AS Manufacturer, CAST(p_size AS VARCHAR) AS PackSize,
               p_name AS Brand, p_brand || '-' || p_type AS BrandVariant, 'PLAIN' AS Flavour,
               'GENERAL' AS ProductGroup, 'EACH' AS UnitOfMeasure,
               CAST(1 AS DOUBLE) AS ServingUnitFactor, CAST(1 AS DOUBLE) AS PurchaseUnitFactor,
               'CORE' AS Category, 'BRAND' AS TarLevelName, 'N' AS IscompanyFlag, 'A' AS ActiveFlag,
               'MAIN' AS EVPSegmentName, p_brand AS ReportingBrandName
        FROM part WHERE p_type <> 'ECONOMY'""",
    "calendar": f"""
        SELECT DISTINCT {_as_key('l_shipdate')} AS DateKey,
               CAST(date_trunc('week', l_shipdate) AS DATE) AS WeekStartDate,
               CAST(date_trunc('week', l_shipdate) AS DATE) + 6 AS WeekEndDate,
               CAST(year(l_shipdate) AS INTEGER) AS CalendarYearNumber,
               CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS CalendarYearMonthNumber
        FROM lineitem""",
    "rates_all": f"""
        SELECT l_partkey AS ProductKey, l_suppkey AS OutletKey, {_as_key('l_shipdate')} AS DateKey,
               OutletIdentifier, {_as_key('l_shipdate')} AS PromotionRateStartDateKey,
               {_as_key("(CAST(l_shipdate AS DATE) + 7 * l_linenumber)")} AS PromotionRateEndDateKey,
               disc AS DiscountLevel, BrandVariant AS Promo_BrandVariant, ReportingBrandName,
               year(l_shipdate) AS yr, CASE WHEN month(l_shipdate) <= 6 THEN 1 ELSE 2 END AS half
        FROM line_amounts JOIN outlet ON OutletKey = l_suppkey JOIN product ON ProductKey = l_partkey
        WHERE disc >= 0.08""",
    "single_promo": f"""
        SELECT * EXCLUDE (yr, half), {PROMOTION} FROM rates_all WHERE DateKey >= {DATE_FILTER}""",
    "promo_master": f"""
        SELECT * FROM (
            SELECT CAST(0.08 AS DECIMAL(4,2)) AS DiscountLevel, {PROMOTION}
            FROM (SELECT DISTINCT yr, half FROM rates_all))
        WHERE ActiveFlag = 'A' AND PromotionStatus IN ('Committed', 'Closed')""",
    "promo_hierarchy": """
        SELECT DISTINCT DateKey, OutletKey, CAST(yr * 10 + half AS BIGINT) AS PromotionKey,
               CASE WHEN (yr * 10 + half) % 2 = 0 THEN 'multipack' ELSE 'buydown' END AS PromotionCategory,
               'standard' AS PromotionSubCategory, CAST(0.08 AS DECIMAL(4,2)) AS DiscountLevel
        FROM rates_all""",
    "enriched": """
        SELECT * FROM scan_discounts JOIN product USING (ProductKey) LEFT JOIN outlet USING (OutletKey)""",
    "loyalty_all": """
        SELECT *, CASE WHEN LoyaltyNumber IS NOT NULL AND LoyaltyNumber NOT IN ('', '0') AND SubmitterName IS NOT NULL
                       THEN SubmitterName || LoyaltyNumber END AS LoyaltyCode
        FROM enriched""",
    "loyalty_valid": "SELECT * FROM loyalty_all WHERE LoyaltyCode IS NOT NULL",
    "loyalty_promo": """
        SELECT p.ProductKey, p.OutletKey, p.DateKey AS Promo_DateKey, l.TransactionID, l.LoyaltyCode,
               p.OutletIdentifier, p.PromotionName, p.ReportingBrandName,
               p.PromotionRateStartDateKey, p.PromotionRateEndDateKey
        FROM loyalty_valid l
        JOIN single_promo p ON p.ProductKey = l.ProductKey AND p.OutletKey = l.OutletKey AND p.DateKey = l.DateKey""",
    "spans": SPAN.format(rates="single_promo"),
    "promos": f"""
        SELECT *, before_candidate_start >= {DATA_START} AS before_data_ok,
               after_candidate_start <= {AS_OF} AS after_data_ok
        FROM (SELECT *, PromoTrueStartDate_dt - promo_duration_days AS before_candidate_start,
                     PromoTrueStartDate_dt - 1 AS before_candidate_end,
                     PromoTrueEndDate_dt + 1 AS after_candidate_start,
                     PromoTrueEndDate_dt + promo_duration_days AS after_candidate_end
              FROM (SELECT *, CAST(PromoTrueEndDate_dt - PromoTrueStartDate_dt + 1 AS INTEGER) AS promo_duration_days
                    FROM spans))""",
    "flags_null": """
        SELECT m.OutletIdentifier, m.ReportingBrandName, m.PromotionName,
               max(CAST(o.PromoTrueStartDate_dt <= m.before_candidate_end
                        AND o.PromoTrueEndDate_dt >= m.before_candidate_start AS INTEGER)) AS before_overlap,
               max(CAST(o.PromoTrueStartDate_dt <= m.after_candidate_end
                        AND o.PromoTrueEndDate_dt >= m.after_candidate_start AS INTEGER)) AS after_overlap
        FROM promos m
        LEFT JOIN promos o ON o.OutletIdentifier = m.OutletIdentifier
                          AND o.ReportingBrandName = m.ReportingBrandName
                          AND o.PromotionName <> m.PromotionName
        GROUP BY m.OutletIdentifier, m.ReportingBrandName, m.PromotionName""",
    "flags_zero": """
        SELECT OutletIdentifier, ReportingBrandName, PromotionName,
               coalesce(before_overlap, 0) AS before_overlap, coalesce(after_overlap, 0) AS after_overlap
        FROM flags_null""",
    "windows": ACCEPTED.format(flags="flags_zero"),
    "windows_null": ACCEPTED.format(flags="flags_null"),
    "tagged_during": _tag("during_promo", "PromoTrueStartDate_dt", "PromoTrueEndDate_dt", "true"),
    "tagged_before": _tag("before_promo", "before_window_start", "before_window_end", "w.has_before_window"),
    "tagged_after": _tag("after_promo", "after_window_start", "after_window_end", "w.has_after_window"),
    "tagged": "SELECT * FROM tagged_during UNION ALL SELECT * FROM tagged_before UNION ALL SELECT * FROM tagged_after",
    "metrics_long": f"""
        SELECT {KEYS}, period, sum(MetricVolume) AS total_volume, sum(MetricValue) AS total_value,
               count(DISTINCT LoyaltyCode) AS total_loyalty_customers
        FROM tagged GROUP BY {KEYS}, period""",
    "metrics_wide": "SELECT "
    + KEYS
    + "".join(
        f",\n max({metric}) FILTER (WHERE period = '{period}') AS {period}_{metric}"
        for period in ("before_promo", "during_promo", "after_promo")
        for metric in ("total_volume", "total_value", "total_loyalty_customers")
    )
    + f" FROM metrics_long GROUP BY {KEYS}",
    "metrics": """
        SELECT *, CASE WHEN before_promo_total_volume > 0
                       THEN (CAST(during_promo_total_volume AS DOUBLE) / CAST(before_promo_total_volume AS DOUBLE) - 1) * 100
                  END AS volume_lift_pct,
               CASE WHEN during_promo_total_loyalty_customers > 0
                    THEN CAST(after_promo_total_loyalty_customers AS DOUBLE)
                         / CAST(during_promo_total_loyalty_customers AS DOUBLE) * 100 END AS customer_retention_rate,
               CASE WHEN during_promo_total_loyalty_customers > 0
                    THEN CAST(during_promo_total_value AS DOUBLE)
                         / CAST(during_promo_total_loyalty_customers AS DOUBLE) END AS value_per_loyal_customer_during
        FROM metrics_wide""",
}

# The windows as a run of 15 September 2000 saw them: no later rates, and that day as today.
THEN = "DATE '2000-09-15'"
_THEN_TABLES = ("single_promo", "spans", "promos", "flags_null", "flags_zero", "windows")
for _name in _THEN_TABLES:
    _sql = re.sub(rf"\b(FROM|JOIN) ({'|'.join(_THEN_TABLES)})\b", r"\1 then_\2", CTES[_name]).replace(AS_OF, THEN)
    CTES[f"then_{_name}"] = _sql + (" AND DateKey <= 20000915" if _name == "single_promo" else "")


def _past_spans(prefix: str) -> str:
    cut = f"least({{}}, {THEN})"
    parts = [
        f"SELECT {KEYS}, '{period}' AS period, {first} AS a, {cut.format(last)} AS b FROM {prefix}windows"
        f" WHERE {accepted} AND {first} <= {cut.format(last)}"
        for period, first, last, accepted in (
            ("during", "PromoTrueStartDate_dt", "PromoTrueEndDate_dt", "true"),
            ("before", "before_window_start", "before_window_end", "has_before_window"),
            ("after", "after_window_start", "after_window_end", "has_after_window"),
        )
    ]
    return " UNION ALL ".join(parts)


CTES |= {
    "past_spans": _past_spans(""),
    "then_past_spans": _past_spans("then_"),
    "repeated_reference": """
        SELECT DISTINCT OutletKey, OutletIdentifier FROM outlet_all
        UNION ALL SELECT DISTINCT OutletKey, 'Z' || OutletIdentifier FROM outlet_all WHERE OutletKey % 3 = 0""",
    "repeated_state": """
        SELECT DISTINCT OutletIdentifier, State FROM outlet_all
        UNION ALL SELECT DISTINCT OutletIdentifier, NULL FROM outlet_all WHERE OutletIdentifier LIKE '%5'""",
    "check_runs": """
        SELECT CAST(DateKey // 10000 AS VARCHAR) AS run_id, check_name, CAST(v AS DOUBLE) AS value FROM (
          SELECT DateKey, 'lines' AS check_name, count(*) OVER y AS v FROM scan WINDOW y AS (PARTITION BY DateKey // 10000)
          UNION SELECT DateKey, 'volume', sum(MetricVolume) OVER y FROM scan WINDOW y AS (PARTITION BY DateKey // 10000)
          UNION SELECT DateKey, 'largest', max(MetricValue) OVER y FROM scan WINDOW y AS (PARTITION BY DateKey // 10000))
        GROUP BY ALL""",
}


def _drift(run: str, times: int, earlier: str) -> str:
    return f"""
        SELECT 'sales' AS layer, check_name, true AS passed, value, runs, usual, low, high,
               CASE WHEN runs >= 3 THEN value < low OR value > high END AS drifted, {run} AS run
        FROM (SELECT check_name, {times} * value AS value FROM check_runs WHERE run_id = (SELECT max(run_id) FROM check_runs))
        JOIN (SELECT check_name, runs, m AS usual, least(a - 4 * (b - a), m - abs(m) * 0.5) AS low,
                     greatest(b + 4 * (b - a), m + abs(m) * 0.5) AS high
              FROM (SELECT check_name, count(*) AS runs, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.5) AS m,
                           quantile_cont(value, 0.75) AS b FROM check_runs WHERE {earlier} GROUP BY check_name)) USING (check_name)"""


def _calendar(lines: str, by: str = "") -> str:
    """Levels apart, each straight from the lines."""
    first, last = "DATE '1997-01-08'", "DATE '1998-11-20'"
    starts = {
        "week": ("CAST(date_trunc('week', day) AS DATE)", "CAST(begin + 6 AS DATE)"),
        "month": ("CAST(date_trunc('month', day) AS DATE)", "CAST(last_day(begin) AS DATE)"),
        "all": (first, last),
    }
    return " UNION ALL ".join(
        f"""SELECT {by} '{level}' AS level, greatest(begin, {first}) AS level_start, least({end}, {last}) AS level_end,
        CAST(least({end}, {last}) - greatest(begin, {first}) + 1 AS INTEGER) AS days, begin < {first} OR {end} > {last} AS partial,
        total_lines, total_volume, total_value
        FROM (SELECT {by} {begin} AS begin, count(*) AS total_lines, CAST(sum(MetricVolume) AS DOUBLE) AS total_volume,
                     CAST(sum(MetricValue) AS DOUBLE) AS total_value
              FROM (SELECT *, {_as_date('DateKey')} AS day FROM {lines} WHERE DateKey BETWEEN 19970108 AND 19981120)
              GROUP BY {by} {begin})"""
        for level, (begin, end) in starts.items()
    )


def _customers(*levels: str) -> str:
    names = ("ReportingBrandName", "State", "period")
    return " UNION ALL ".join(
        f"SELECT '{level}' AS level, "
        + ", ".join(f"{n if n in level.split(',') else 'CAST(NULL AS VARCHAR)'} AS {n}" for n in names)
        + ", count(DISTINCT LoyaltyCode) AS customers FROM tagged JOIN outlet USING (OutletIdentifier)"
        + (f" GROUP BY {', '.join(level.split(','))}" if level != "all" else "")
        for level in levels
    )


AMOUNTS = ("MetricVolume", "MetricValue")
TOTALS = tuple(
    f"{p}_total_{m}" for p in ("before_promo", "during_promo", "after_promo") for m in ("volume", "value")
)


def _doubles(*columns: str) -> str:
    inside = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)
    return f"* REPLACE ({inside})"


def _check(name: str, value: str, passed: str) -> str:
    return f"SELECT '{name}' AS check_name, {passed} AS passed, CAST({value} AS DOUBLE) AS value"


def _zero(name: str, source: str, condition: str) -> str:
    found = f"(SELECT count(*) FROM {source} WHERE {condition})"
    return _check(name, found, f"{found} = 0")


def _some(name: str, source: str) -> str:
    found = f"(SELECT count(*) FROM {source})"
    return _check(name, found, f"{found} > 0")


def _present(name: str) -> str:
    return _check(name, "0", "true")


def _repeated(name: str, source: str, key: str) -> str:
    found = f"(SELECT count(*) - count(DISTINCT {key}) FROM {source})"
    return _check(name, found, f"{found} = 0")


def _gap(name: str, source: str, output: str) -> str:
    difference = (
        f"CASE WHEN ({source}) = 0 THEN 0 ELSE abs(CAST(({output}) - ({source}) AS DOUBLE) / CAST(({source}) AS DOUBLE) * 100) END"
    )
    return _check(name, f"round({difference}, 6)", f"{difference} < 1")


def _sums() -> list[str]:
    checks = []
    periods = ("before_promo", "during_promo", "after_promo")
    for kind, column in (("volume", "MetricVolume"), ("value", "MetricValue")):
        written = " + ".join(f"coalesce(sum({p}_total_{kind}), 0)" for p in periods)
        checks.append(
            _gap(f"{kind}_reconciles", f"SELECT coalesce(sum({column}), 0) FROM tagged", f"SELECT {written} FROM metrics")
        )
    for p in periods:
        for kind, column in (("volume", "MetricVolume"), ("value", "MetricValue")):
            checks.append(
                _gap(
                    f"{p}_{kind}_reconciles",
                    f"SELECT coalesce(sum({column}), 0) FROM tagged WHERE period = '{p}'",
                    f"SELECT coalesce(sum({p}_total_{kind}), 0) FROM metrics",
                )
            )
    return checks


RATE = "(SELECT CAST((SELECT count(*) FROM loyalty_valid) AS DOUBLE) / (SELECT count(*) FROM loyalty_all) * 100)"

LONGEST_GAP = f"""(SELECT coalesce(max(date_diff('day', before, day) - 1), 0) FROM (
    SELECT day, lag(day) OVER (ORDER BY day) AS before FROM (SELECT DISTINCT {_as_date('DateKey')} AS day FROM scan)))"""

# The two sides of every place and period, full outer.
PLACE_SUMS = """
    SELECT OutletIdentifier, ReportingBrandName, period, coalesce(s.volume, 0) AS source_volume, coalesce(o.volume, 0) AS output_volume,
           coalesce(s.amount, 0) AS source_value, coalesce(o.amount, 0) AS output_value
    FROM (SELECT OutletIdentifier, ReportingBrandName, period, sum(MetricVolume) AS volume, sum(MetricValue) AS amount FROM tagged GROUP BY ALL) s
    FULL JOIN (
      SELECT OutletIdentifier, ReportingBrandName, period, sum(volume) AS volume, sum(amount) AS amount FROM (
        SELECT OutletIdentifier, ReportingBrandName, 'before_promo' AS period, before_promo_total_volume AS volume, before_promo_total_value AS amount FROM {metrics}
        UNION ALL SELECT OutletIdentifier, ReportingBrandName, 'during_promo', during_promo_total_volume, during_promo_total_value FROM {metrics}
        UNION ALL SELECT OutletIdentifier, ReportingBrandName, 'after_promo', after_promo_total_volume, after_promo_total_value FROM {metrics}
      ) GROUP BY ALL
    ) o USING (OutletIdentifier, ReportingBrandName, period)
    WHERE coalesce(s.volume, 0) <> coalesce(o.volume, 0) OR coalesce(s.amount, 0) <> coalesce(o.amount, 0)"""
ALTERED = """(SELECT * REPLACE (
    CASE WHEN OutletIdentifier <> (SELECT min(OutletIdentifier) FROM metrics_wide) THEN after_promo_total_value END AS after_promo_total_value,
    during_promo_total_volume + CASE WHEN OutletIdentifier = (SELECT max(OutletIdentifier) FROM metrics_wide) THEN 1 ELSE 0 END AS during_promo_total_volume
  ) FROM metrics_wide)"""

CHECKS: dict[str, list[str]] = {
    "source": [
        _some("scan_table_not_empty", "scan"),
        _some("outlet_table_not_empty", "outlet"),
        _some("product_table_not_empty", "product"),
        _some("promo_table_not_empty", "promo_master"),
        _zero("scan_date_filter_applied", "scan", f"DateKey < {DATE_FILTER}"),
        _zero("no_null_outlet_keys", "scan", "OutletKey IS NULL"),
        _zero("no_null_product_keys", "scan", "ProductKey IS NULL"),
        _zero("promo_status_filtered", "promo_master", "PromotionStatus NOT IN ('Committed', 'Closed')"),
        _present("scan_columns_present"),
        _present("outlet_columns_present"),
        _present("product_columns_present"),
        _present("promo_columns_present"),
        _check("date_range_covered", "(SELECT max(DateKey) FROM scan)", "(SELECT count(DateKey) > 0 FROM scan)"),
        _check("dates_without_gaps", LONGEST_GAP, f"{LONGEST_GAP} <= 7"),
        _repeated("unique_outlet_key", "outlet", "OutletKey"),
        _repeated("unique_product_key", "product", "ProductKey"),
    ],
    "discounts": [
        _zero("no_negative_smp", "scan_discounts", "SMP_discount < 0"),
        _zero("no_negative_mp", "scan_discounts", "MP_discount < 0"),
        _zero("no_negative_cpn", "scan_discounts", "CPN_discount < 0"),
        _zero("is_promo_valid", "scan_discounts", "is_promo NOT IN (0, 1) OR is_promo IS NULL"),
        _present("discount_columns_present"),
    ],
    "loyalty": [
        _zero("no_null_loyalty_codes", "loyalty_valid", "LoyaltyCode IS NULL"),
        _zero("no_empty_loyalty_codes", "loyalty_valid", "LoyaltyCode = ''"),
        _check("loyalty_derivation_rate", f"round({RATE}, 6)", f"{RATE} > 1"),
        _zero("codes_start_with_submitter", "loyalty_valid", "NOT starts_with(LoyaltyCode, SubmitterName)"),
    ],
    "windows": [
        _zero("no_negative_durations", "promos", "promo_duration_days <= 0"),
        _zero("start_before_end", "promos", "PromoTrueStartDate_dt > PromoTrueEndDate_dt"),
        _zero("before_window_correct", "promos", "before_candidate_end >= PromoTrueStartDate_dt"),
        _zero("after_window_correct", "promos", "after_candidate_start <= PromoTrueEndDate_dt"),
        _zero(
            "duration_consistent", "promos",
            "promo_duration_days IS DISTINCT FROM PromoTrueEndDate_dt - PromoTrueStartDate_dt + 1",
        ),
    ],
    "overlap": [
        _check(
            "row_count_preserved", "(SELECT count(*) FROM windows)",
            "(SELECT count(*) FROM windows) = (SELECT count(*) FROM promos)",
        ),
        _zero("before_overlap_valid", "windows", "before_overlap NOT IN (0, 1) OR before_overlap IS NULL"),
        _zero("after_overlap_valid", "windows", "after_overlap NOT IN (0, 1) OR after_overlap IS NULL"),
        _zero("null_dates_when_invalid", "windows", "NOT has_before_window AND before_window_start IS NOT NULL"),
        _zero("null_after_dates_when_invalid", "windows", "NOT has_after_window AND after_window_start IS NOT NULL"),
        _zero("before_dates_when_valid", "windows", "has_before_window AND before_window_start IS NULL"),
        _zero("after_dates_when_valid", "windows", "has_after_window AND after_window_start IS NULL"),
    ],
    "tagging": [
        _zero("valid_period_values", "tagged", "period NOT IN ('before_promo', 'during_promo', 'after_promo')"),
        _zero("no_null_periods", "tagged", "period IS NULL"),
        _zero("no_null_loyalty_codes", "tagged", "LoyaltyCode IS NULL"),
        _zero("no_negative_volumes", "tagged", "MetricVolume < 0"),
        _zero("no_negative_values", "tagged", "MetricValue < 0"),
        _zero("no_null_outlets", "tagged", "OutletIdentifier IS NULL"),
    ],
    "output": [
        _zero("no_null_outlets", "metrics", "OutletIdentifier IS NULL"),
        _zero("no_null_brands", "metrics", "ReportingBrandName IS NULL"),
        _zero("no_null_promos", "metrics", "PromotionName IS NULL"),
        _zero("no_null_dates", "metrics", "PromoTrueStartDate_dt IS NULL OR PromoTrueEndDate_dt IS NULL"),
        _zero("no_negative_during_volume", "metrics", "during_promo_total_volume < 0"),
        _check(
            "no_duplicate_rows", "(SELECT count(*) FROM metrics)",
            "(SELECT count(*) FROM metrics) = (SELECT count(*) FROM "
            "(SELECT DISTINCT OutletIdentifier, ReportingBrandName, PromotionName FROM metrics))",
        ),
        _zero("date_ranges_valid", "metrics", "PromoTrueStartDate_dt > PromoTrueEndDate_dt"),
        _zero("no_negative_during_value", "metrics", "during_promo_total_value < 0"),
        _zero("no_negative_during_customers", "metrics", "during_promo_total_loyalty_customers < 0"),
        _zero("during_always_present", "metrics", "during_promo_total_volume IS NULL"),
        _zero("volume_lift_reasonable", "metrics", "volume_lift_pct < -100 OR volume_lift_pct > 1000"),
        _zero("retention_reasonable", "metrics", "customer_retention_rate < 0"),
        _zero("customer_value_reasonable", "metrics", "value_per_loyal_customer_during < 0"),
    ],
    "reconciliation": [*_sums(), _zero("places_reconcile", f"({PLACE_SUMS.format(metrics='metrics_wide')})", "true")],
}


def _checks(layer: str) -> str:
    return " UNION ALL ".join(CHECKS[layer])


COVERED = f"""SELECT count(*) FROM loyalty_valid l WHERE EXISTS (
    SELECT 1 FROM windows w
    WHERE w.OutletIdentifier = l.OutletIdentifier AND w.ReportingBrandName = l.ReportingBrandName
      AND ({_as_date('l.DateKey')} BETWEEN w.PromoTrueStartDate_dt AND w.PromoTrueEndDate_dt
           OR w.has_before_window AND {_as_date('l.DateKey')} BETWEEN w.before_window_start AND w.before_window_end
           OR w.has_after_window AND {_as_date('l.DateKey')} BETWEEN w.after_window_start AND w.after_window_end))"""

DISCOUNTS = ("SMP_discount", "MP_discount", "CPN_discount")
SCAN_DECIMALS = (
    *AMOUNTS, "ManufacturerDiscountValue", "ManufacturerMultipackAmount", "OutletMultipackDiscountAmount",
    "OutletMultipackValue", "ManufacturerMultipackValue", "CouponDiscountValue",
)


def _pct(part: str, whole: str) -> str:
    return f"round(CAST({part} AS DOUBLE) / {whole} * 100, 6)"


BODIES: dict[str, str] = {
    "load_scan": f"SELECT {_doubles(*SCAN_DECIMALS)} FROM scan",
    "load_outlet": "SELECT * FROM outlet",
    "load_product": "SELECT * FROM product",
    "load_date": "SELECT * FROM calendar",
    "load_outlet_reference": "SELECT DISTINCT OutletKey, OutletIdentifier FROM outlet_all",
    "load_outlet_state": "SELECT DISTINCT OutletIdentifier, State FROM outlet_all",
    "load_product_reference": """SELECT DISTINCT p_partkey AS ProductKey, p_brand AS ReportingBrandName,
        'X' || p_brand AS ExternalBrandCode FROM part""",
    "load_product_variant": "SELECT DISTINCT 'X' || p_brand AS ExternalBrandCode, p_brand AS BrandVariant FROM part",
    "load_promo_hierarchy": f"SELECT {_doubles('DiscountLevel')} FROM promo_hierarchy",
    "load_promo_master": f"SELECT {_doubles('DiscountLevel')} FROM promo_master",
    "load_loyalty_scan": f"SELECT {_doubles(*SCAN_DECIMALS, *DISCOUNTS)} FROM loyalty_valid",
    "load_single_promo": f"SELECT {_doubles('DiscountLevel')} FROM single_promo",
    "enrich_scan": f"""SELECT {LINE}, CAST(MetricVolume AS DOUBLE) AS MetricVolume,
        CAST(MetricValue AS DOUBLE) AS MetricValue, Brand, BrandVariant, ReportingBrandName, Category,
        OutletIdentifier, State, SubmitterName, ChainId, WeekStartDate, WeekEndDate,
        CalendarYearNumber, CalendarYearMonthNumber FROM enriched LEFT JOIN calendar USING (DateKey)""",
    "reference_matching": """SELECT OutletKey, ProductKey, DateKey, TransactionID,
        OutletIdentifier AS Ref_OutletIdentifier, State AS Ref_State, p_brand AS Ref_ReportingBrandName,
        'X' || p_brand AS Ref_ExternalBrandCode, p_brand AS Ref_BrandVariant
        FROM scan LEFT JOIN outlet_all USING (OutletKey) LEFT JOIN part ON p_partkey = ProductKey""",
    "join_loyalty_promo": "SELECT * FROM loyalty_promo",
    "promo_result_joined": SPAN.format(rates="loyalty_promo"),
    "discount_columns": f"""SELECT {LINE}, CAST(SMP_discount AS DOUBLE) AS SMP_discount,
        CAST(MP_discount AS DOUBLE) AS MP_discount, CAST(CPN_discount AS DOUBLE) AS CPN_discount, is_promo
        FROM scan_discounts""",
    "loyalty_validity": f"""SELECT {LINE}, LoyaltyNumber, SubmitterName,
        coalesce(LoyaltyNumber NOT IN ('', '0'), false) AS is_valid_loyalty,
        SubmitterName IS NOT NULL AS is_valid_submitter FROM enriched""",
    "loyalty_code": f"""SELECT {LINE}, Brand,
        CASE WHEN ReportingBrandName = 'Brand#1' AND Brand = 'red widget' THEN 'Brand#1 Red'
             WHEN ReportingBrandName = 'Brand#1' AND Brand = 'small ring' THEN 'Brand#1 Small'
             ELSE ReportingBrandName END AS ReportingBrandName, LoyaltyCode FROM loyalty_all""",
    "loyalty_valid": f"""SELECT {LINE}, OutletIdentifier, ReportingBrandName, LoyaltyCode,
        CAST(MetricVolume AS DOUBLE) AS MetricVolume, CAST(MetricValue AS DOUBLE) AS MetricValue FROM loyalty_valid""",
    "promo_result": "SELECT * FROM spans",
    "promo_windows": "SELECT * FROM promos",
    "overlap_flags": f"""SELECT {KEYS}, before_overlap, after_overlap
        FROM promos JOIN flags_zero USING (OutletIdentifier, ReportingBrandName, PromotionName)""",
    "detect_overlaps": "SELECT * FROM windows",
    "detect_overlaps_null_mode": "SELECT * FROM windows_null",
    "window_tables": f"""SELECT {KEYS}, PromoTrueStartDate_dt AS window_start, PromoTrueEndDate_dt AS window_end,
            'during_promo' AS period FROM windows
        UNION ALL SELECT {KEYS}, before_window_start, before_window_end, 'before_promo' FROM windows WHERE has_before_window
        UNION ALL SELECT {KEYS}, after_window_start, after_window_end, 'after_promo' FROM windows WHERE has_after_window""",
    "tag_during": f"SELECT {_doubles(*AMOUNTS)} FROM tagged_during",
    "tag_before": f"SELECT {_doubles(*AMOUNTS)} FROM tagged_before",
    "tag_after": f"SELECT {_doubles(*AMOUNTS)} FROM tagged_after",
    "tag_transactions": f"SELECT {_doubles(*AMOUNTS)} FROM tagged",
    "union_all_periods": f"SELECT {_doubles(*AMOUNTS)} FROM tagged",
    "metrics_long": f"SELECT {_doubles('total_volume', 'total_value')} FROM metrics_long",
    "metrics_pivot": f"SELECT {_doubles(*TOTALS)} FROM metrics_wide",
    "metrics_wide": f"SELECT {_doubles(*TOTALS)} FROM metrics_wide",
    "metrics_derived": f"SELECT {_doubles(*TOTALS)} FROM metrics",
    "metrics_all_promos": f"SELECT {_doubles(*TOTALS)} FROM (SELECT {KEYS} FROM windows) LEFT JOIN metrics USING ({KEYS})",
    "metrics_sink_roundtrip": f"SELECT {_doubles(*TOTALS)} FROM metrics",
    "metrics_sink_failed_write": f"SELECT {_doubles(*TOTALS)} FROM metrics_wide",
    **{f"quality_{layer}": _checks(layer) for layer in CHECKS},
    "ledger": """SELECT OutletIdentifier, ReportingBrandName, period, CAST(sum(MetricVolume) AS DOUBLE) AS MetricVolume,
        CAST(sum(MetricValue) AS DOUBLE) AS MetricValue, count(*) AS tagged_rows,
        count(*) FILTER (WHERE MetricVolume < 0) AS negative_volume_rows, count(*) FILTER (WHERE MetricValue < 0) AS negative_value_rows
        FROM tagged GROUP BY OutletIdentifier, ReportingBrandName, period""",
    "ledger_differences": f"SELECT {_doubles('source_volume', 'output_volume', 'source_value', 'output_value')} FROM ({PLACE_SUMS.format(metrics=ALTERED)})",
    "date_gaps": f"""SELECT CAST(before + 1 AS DATE) AS gap_start, CAST(day - 1 AS DATE) AS gap_end, CAST(date_diff('day', before, day) - 1 AS INTEGER) AS gap_days
        FROM (SELECT day, lag(day) OVER (ORDER BY day) AS before FROM (
          SELECT {_as_date('DateKey')} AS day FROM scan WHERE DateKey BETWEEN 19961201 AND 19981231
          UNION SELECT DATE '1996-11-30' UNION SELECT DATE '1999-01-01'))
        WHERE date_diff('day', before, day) > 1""",
    "outlet_date_gaps": f"""SELECT OutletKey, CAST(before + 1 AS DATE) AS gap_start, CAST(day - 1 AS DATE) AS gap_end,
        CAST(date_diff('day', before, day) - 1 AS INTEGER) AS gap_days
        FROM (SELECT OutletKey, day, lag(day) OVER (PARTITION BY OutletKey ORDER BY day) AS before FROM (
          SELECT DISTINCT OutletKey, {_as_date('DateKey')} AS day FROM scan WHERE DateKey BETWEEN 19970101 AND 19981231
          UNION SELECT DISTINCT OutletKey, DATE '1996-12-31' FROM scan UNION SELECT DISTINCT OutletKey, DATE '1999-01-01' FROM scan))
        WHERE date_diff('day', before, day) > 21""",
    "quality_coverage": f"""SELECT 'source_coverage' AS check_name, true AS passed,
        round(CAST(({COVERED}) AS DOUBLE) / (SELECT count(*) FROM loyalty_valid) * 100, 6) AS value""",
    "quality_all": " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, {CHECK} FROM ({_checks(layer)})" for layer in CHECKS
    ),
    "check_builders": " UNION ALL ".join(
        [_zero("no_null_LoyaltyNumber", "scan", "LoyaltyNumber IS NULL"), _zero("no_negative_MetricVolume", "scan", "MetricVolume < 0")]
    ),
    "check_results": "SELECT 'custom' AS layer, check_name, 'error' AS severity, passed, value, "
    "CAST(sum(CAST(passed AS INTEGER)) OVER () AS INTEGER) AS passed_checks, CAST(sum(CAST(NOT passed AS INTEGER)) OVER () AS INTEGER) AS failed_checks FROM ("
    + " UNION ALL ".join([_zero("no_null_LoyaltyNumber", "scan", "LoyaltyNumber IS NULL"), _zero("no_negative_MetricVolume", "scan", "MetricVolume < 0")])
    + ")",
    "loyalty_dates": f"SELECT {LINE}, {_as_date('DateKey')} AS DateKey_dt FROM loyalty_valid",
    "distinct_customers": _customers("ReportingBrandName", "State", "period", "ReportingBrandName,period", "all"),
    "incremental_rollup": f"""SELECT {KEYS}, period, LoyaltyCode, CAST(sum(MetricVolume) AS DOUBLE) AS MetricVolume,
        CAST(sum(MetricValue) AS DOUBLE) AS MetricValue, count(*) AS tagged_rows,
        count(*) FILTER (WHERE MetricVolume < 0) AS negative_volume_rows, count(*) FILTER (WHERE MetricValue < 0) AS negative_value_rows
        FROM tagged GROUP BY {KEYS}, period, LoyaltyCode""",
    "changed_places": """SELECT DISTINCT OutletIdentifier, ReportingBrandName FROM (
        (SELECT * FROM past_spans EXCEPT ALL SELECT * FROM then_past_spans)
        UNION ALL (SELECT * FROM then_past_spans EXCEPT ALL SELECT * FROM past_spans))""",
    "reference_survivors": """SELECT OutletKey, ProductKey, DateKey, TransactionID, OutletIdentifier AS Ref_OutletIdentifier, State AS Ref_State
        FROM scan
        LEFT JOIN (SELECT * FROM repeated_reference QUALIFY row_number() OVER (PARTITION BY OutletKey ORDER BY OutletIdentifier) = 1) USING (OutletKey)
        LEFT JOIN (SELECT * FROM repeated_state QUALIFY row_number() OVER (PARTITION BY OutletIdentifier ORDER BY State NULLS FIRST) = 1)
          USING (OutletIdentifier)""",
    "reference_conflicts": """
        SELECT 'outlet_reference' AS table_name, CAST(OutletKey AS VARCHAR) AS key, count(*) AS key_rows, 'OutletIdentifier' AS differing
        FROM repeated_reference GROUP BY OutletKey HAVING count(DISTINCT OutletIdentifier) > 1
        UNION ALL SELECT 'outlet_state', OutletIdentifier, count(*), 'State' FROM repeated_state GROUP BY OutletIdentifier
        HAVING count(DISTINCT coalesce(State, '-')) > 1""",
    "quality_drift": _drift("(SELECT max(run_id) FROM check_runs)", 1, "run_id < (SELECT max(run_id) FROM check_runs)")
    + " UNION ALL " + _drift("'tenfold'", 10, "true"),
    "calendar_rollup": _calendar("scan"),
    "brand_calendar": _calendar("enriched", "ReportingBrandName,"),
    "discount_summary": f"""SELECT *, {_pct('promo_transactions', 'total_transactions')} AS promo_pct FROM (
        SELECT count(*) AS total_transactions, count(*) FILTER (WHERE SMP_discount > 0) AS smp_transactions,
               count(*) FILTER (WHERE MP_discount > 0) AS mp_transactions,
               count(*) FILTER (WHERE CPN_discount > 0) AS cpn_transactions,
               count(*) FILTER (WHERE is_promo = 1) AS promo_transactions FROM scan_discounts)""",
    "loyalty_summary": f"""SELECT *, {_pct('valid_loyalty', 'total_transactions')} AS derivation_rate FROM (
        SELECT count(*) AS total_transactions, count(LoyaltyCode) AS valid_loyalty,
               count(*) - count(LoyaltyCode) AS no_loyalty, count(DISTINCT LoyaltyCode) AS unique_customers
        FROM loyalty_all)""",
    "promo_windows_summary": f"""SELECT *, {_pct('before_data_promotions', 'total_promotions')} AS before_data_pct,
               {_pct('after_data_promotions', 'total_promotions')} AS after_data_pct FROM (
        SELECT count(*) AS total_promotions, round(avg(promo_duration_days), 6) AS avg_days,
               min(promo_duration_days) AS min_days, max(promo_duration_days) AS max_days,
               count(*) FILTER (WHERE before_data_ok) AS before_data_promotions,
               count(*) FILTER (WHERE after_data_ok) AS after_data_promotions FROM promos)""",
    "overlap_summary": "SELECT *, "
    + ", ".join(
        f"{_pct(k, 'total_promotions')} AS {k}_pct" for k in ("both_windows", "before_only", "after_only", "during_only")
    )
    + """ FROM (
        SELECT count(*) AS total_promotions,
               count(*) FILTER (WHERE has_before_window AND has_after_window) AS both_windows,
               count(*) FILTER (WHERE has_before_window AND NOT has_after_window) AS before_only,
               count(*) FILTER (WHERE NOT has_before_window AND has_after_window) AS after_only,
               count(*) FILTER (WHERE NOT has_before_window AND NOT has_after_window) AS during_only
        FROM windows)""",
    "outlet_drilldown": """SELECT PromotionName, PromoTrueStartDate_dt, PromoTrueEndDate_dt, promo_duration_days,
        before_overlap, after_overlap, has_before_window, has_after_window, before_window_start,
        before_window_end, after_window_start, after_window_end
        FROM windows WHERE OutletIdentifier = '000007' AND ReportingBrandName = 'Brand#11'
        ORDER BY PromoTrueStartDate_dt""",
    "tagging_summary": """SELECT coalesce(period, 'all_periods') AS period, count(*) AS transactions,
        count(DISTINCT OutletIdentifier) AS unique_outlets, count(DISTINCT LoyaltyCode) AS unique_customers,
        CAST(sum(MetricVolume) AS DOUBLE) AS total_volume, CAST(sum(MetricValue) AS DOUBLE) AS total_value
        FROM tagged GROUP BY ROLLUP (period)""",
    "metrics_summary": f"""SELECT *, {_pct('with_before', 'total_promotions')} AS with_before_pct,
               {_pct('with_after', 'total_promotions')} AS with_after_pct FROM (
        SELECT count(*) AS total_promotions, count(before_promo_total_volume) AS with_before,
               count(after_promo_total_volume) AS with_after, round(avg(volume_lift_pct), 6) AS avg_volume_lift,
               round(avg(customer_retention_rate), 6) AS avg_retention FROM metrics)""",
    "top_brands": """SELECT ReportingBrandName, CAST(sum(during_promo_total_volume) AS DOUBLE) AS total_volume,
        CAST(sum(during_promo_total_value) AS DOUBLE) AS total_value,
        CAST(sum(during_promo_total_loyalty_customers) AS BIGINT) AS total_customers
        FROM metrics GROUP BY ReportingBrandName ORDER BY total_volume DESC, ReportingBrandName""",
    "metrics_sample": f"SELECT {_doubles(*TOTALS)} FROM metrics ORDER BY {KEYS} LIMIT 20",
}


def _needed(sql: str, ctes: dict[str, str]) -> list[str]:
    """The common tables a statement needs, each after those it is built on."""
    found: list[str] = []
    for name in ctes:
        if re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql):
            found += [*_needed(ctes[name], ctes), name]
    return list(dict.fromkeys(found))


def statement(body: str, ctes: dict[str, str] = CTES) -> str:
    tables = ",\n".join(f"{name} AS ({ctes[name]})" for name in _needed(body, ctes))
    return f"WITH {tables}\n{body}" if tables else body


# Sales and promotions both take their brand from the product, so renaming there renames both.
RENAMED = CTES | {
    "product": f"""
        SELECT * REPLACE (CASE WHEN ReportingBrandName = 'Brand#1' AND Brand = 'red widget' THEN 'Brand#1 Red'
                               WHEN ReportingBrandName = 'Brand#1' AND Brand = 'small ring' THEN 'Brand#1 Small'
                               ELSE ReportingBrandName END AS ReportingBrandName) FROM ({CTES['product']})"""
}


def oracle_sql() -> dict[str, str]:
    renamed = {"metrics_with_brand_rules": statement(BODIES["metrics_derived"], RENAMED)}
    same = {
        "quality_audit": "quality_all",
        "calculate_metrics": "metrics_derived",
        "metrics_from_loyalty_scan": "metrics_derived",
        "validated_discounts": "discount_columns",
        "validated_loyalty": "loyalty_valid",
        "validated_windows": "promo_windows",
        "validated_overlaps": "detect_overlaps",
        "validated_tagged": "tag_transactions",
        "validated_metrics": "metrics_derived",
        "tag_by_segments": "tag_transactions",
        "incremental_metrics": "metrics_derived",
    }
    plain = BODIES | {name: BODIES[other] for name, other in same.items()}
    return {name: statement(body) for name, body in plain.items()} | renamed
