"""The checks of each stage. Every function returns check rows and starts no job.

Frames of tagged transactions may also be given as their rollup by customer, which answers
the same checks with far fewer rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from promolens.config import Settings
from promolens.functions.loyalty import known_card, known_submitter
from promolens.operators.sizes import broadcast_if_small
from promolens.operators.tagging import INSIDE, by_month, period_spans
from promolens.quality.core import (
    ERROR,
    INFO,
    WARN,
    Check,
    as_checks,
    as_layers,
    columns_present,
    literals,
    measure,
    none_of,
    over,
    percent,
    side_by_side,
    some_of,
)
from promolens.quality.gaps import longest_gap
from promolens.quality.ledger import differences
from promolens.schemas import BRAND, END, OUTLET, PERIODS, PLACE_KEYS, PROMO, START

# Limits of the checks, in percent. The names of the checks below are fixed values as well.
MIN_DERIVATION_RATE = 1.0
MAX_RECONCILIATION_GAP = 1.0
LIFT_RANGE = (-100, 1000)

DISCOUNT_COLUMNS = ("SMP_discount", "MP_discount", "CPN_discount", "is_promo")
AMOUNTS = {"volume": "MetricVolume", "value": "MetricValue"}


def _scan_measures(scan: DataFrame, settings: Settings) -> dict[str, str]:
    return {
        "scan_rows": "count(*)",
        "old_rows": over(scan, f"count_if(DateKey < {settings.date_filter})", "DateKey"),
        "no_outlet": over(scan, "count_if(OutletKey IS NULL)", "OutletKey"),
        "no_product": over(scan, "count_if(ProductKey IS NULL)", "ProductKey"),
        "first_key": over(scan, "min(DateKey)", "DateKey"),
        "last_key": over(scan, "max(DateKey)", "DateKey"),
        # As many as the calendar has days.
        "day_keys": "collect_set(DateKey)" if "DateKey" in scan.columns else "max(CAST(NULL AS ARRAY<INT>))",
    }


def _source_row(scan_row: DataFrame, outlet: DataFrame, product: DataFrame, promo: DataFrame, settings: Settings) -> DataFrame:
    accepted = f"PromotionStatus IN ({literals(settings.promo_statuses)})"
    return side_by_side(
        scan_row,
        measure(outlet, {"outlet_rows": "count(*)", "outlets": _distinct(outlet, "OutletKey")}),
        measure(product, {"product_rows": "count(*)", "products": _distinct(product, "ProductKey")}),
        measure(
            promo,
            {
                "promo_rows": "count(*)",
                "other_status": over(promo, f"count_if(NOT coalesce({accepted}, false))", "PromotionStatus"),
            },
        ),
    )


def _source_checks(
    scan: DataFrame, outlet: DataFrame, product: DataFrame, promo: DataFrame, settings: Settings, expected_keys: tuple[int, int] | None
) -> list[Check]:
    gap = longest_gap("day_keys", *(expected_keys or ()))
    gap_days = f"CASE WHEN day_keys IS NOT NULL THEN coalesce({gap}.days, 0) END"
    covered, last, severity = "first_key IS NOT NULL", "last_key", INFO
    if expected_keys is not None:
        covered = f"first_key <= {expected_keys[0]} AND last_key >= {expected_keys[1]}"
        last, severity = str(expected_keys[1]), ERROR
    return [
        some_of("scan_table_not_empty", "Lines scanned", "scan_rows"),
        some_of("outlet_table_not_empty", "Outlets loaded", "outlet_rows"),
        some_of("product_table_not_empty", "Products loaded", "product_rows"),
        some_of("promo_table_not_empty", "Promotions loaded", "promo_rows"),
        none_of("scan_date_filter_applied", f"Lines dated before {settings.date_filter}", "old_rows"),
        none_of("no_null_outlet_keys", "Lines without an outlet", "no_outlet"),
        none_of("no_null_product_keys", "Lines without a product", "no_product"),
        none_of("promo_status_filtered", "Promotions neither committed nor closed", "other_status"),
        columns_present("scan_columns_present", scan, ("OutletKey", "ProductKey", "DateKey")),
        columns_present("outlet_columns_present", outlet, ("OutletKey", OUTLET)),
        columns_present("product_columns_present", product, ("ProductKey", BRAND)),
        columns_present("promo_columns_present", promo, (PROMO, "PromotionStatus")),
        Check("date_range_covered", "Last day in the scan", "last_key", covered, last, severity),
        Check(
            "dates_without_gaps", "Longest run of days without sales", gap_days, f"{gap_days} <= {settings.max_gap_days}",
            str(settings.max_gap_days), detail=f"concat(', from ', {gap}.gap_start, ' to ', {gap}.gap_end)",
        ),
        none_of("unique_outlet_key", "Outlet keys held more than once", "(outlet_rows - outlets)"),
        none_of("unique_product_key", "Product keys held more than once", "(product_rows - products)"),
    ]


def check_source_data(
    scan: DataFrame,
    outlet: DataFrame,
    product: DataFrame,
    promo: DataFrame,
    settings: Settings,
    expected_keys: tuple[int, int] | None = None,
) -> DataFrame:
    """Inputs: present, filtered, keyed, and covering the expected date keys without gaps.

    Without expected keys nothing is known about the range, so that check is informational; gaps are then looked for
    between the first and the last day there is.
    """
    row = _source_row(measure(scan, _scan_measures(scan, settings)), outlet, product, promo, settings)
    return as_checks("source", row, _source_checks(scan, outlet, product, promo, settings, expected_keys))


def check_scan(
    scan: DataFrame,
    outlet: DataFrame,
    product: DataFrame,
    promo: DataFrame,
    settings: Settings,
    expected_keys: tuple[int, int] | None = None,
) -> DataFrame:
    """The source and the discount layer, for a scan with discount columns, in one pass over it."""
    scan_row = measure(scan, _scan_measures(scan, settings) | _discount_measures(scan))
    row = _source_row(scan_row, outlet, product, promo, settings)
    source = _source_checks(scan, outlet, product, promo, settings, expected_keys)
    return as_layers(row, {"source": source, "discounts": _discount_checks(scan)})


def _distinct(df: DataFrame, *names: str) -> str:
    """Distinct combinations, nulls counted as values."""
    return over(df, f"count(DISTINCT struct({', '.join(names)}))", *names)


def _discount_measures(df: DataFrame) -> dict[str, str]:
    smp, mp, cpn, flag = DISCOUNT_COLUMNS
    return {
        "negative_smp": over(df, f"count_if({smp} < 0)", smp),
        "negative_mp": over(df, f"count_if({mp} < 0)", mp),
        "negative_cpn": over(df, f"count_if({cpn} < 0)", cpn),
        "bad_flag": over(df, f"count_if(NOT coalesce({flag} IN (0, 1), false))", flag),
    }


def _discount_checks(df: DataFrame) -> list[Check]:
    return [
        none_of("no_negative_smp", "Lines with a negative manufacturer discount", "negative_smp"),
        none_of("no_negative_mp", "Lines with a negative multipack discount", "negative_mp"),
        none_of("no_negative_cpn", "Lines with a negative coupon", "negative_cpn"),
        none_of("is_promo_valid", "Lines flagged neither 0 nor 1", "bad_flag"),
        columns_present("discount_columns_present", df, DISCOUNT_COLUMNS),
    ]


def check_discount_flags(df: DataFrame) -> DataFrame:
    """Discount columns: present, not negative, and a 0/1 flag."""
    return as_checks("discounts", measure(df, _discount_measures(df)), _discount_checks(df))


def _code_measures(df: DataFrame, where: str) -> dict[str, str]:
    foreign = f"count_if({where} AND NOT startswith(LoyaltyCode, CAST(SubmitterName AS STRING)))"
    return {
        "valid_rows": f"count_if({where})",
        "null_codes": over(df, f"count_if({where} AND LoyaltyCode IS NULL)", "LoyaltyCode"),
        "empty_codes": over(df, f"count_if({where} AND LoyaltyCode = '')", "LoyaltyCode"),
        "foreign_codes": over(df, foreign, "LoyaltyCode", "SubmitterName"),
    }


def _loyalty_checks() -> list[Check]:
    rate = percent("valid_rows", "all_rows")
    return [
        none_of("no_null_loyalty_codes", "Valid lines without a code", "null_codes"),
        none_of("no_empty_loyalty_codes", "Valid lines with a blank code", "empty_codes"),
        Check(
            "loyalty_derivation_rate", "Lines that got a code", f"round({rate}, 6)",
            f"{rate} > {MIN_DERIVATION_RATE}", str(MIN_DERIVATION_RATE), unit="%",
        ),
        none_of("codes_start_with_submitter", "Codes not led by their chain", "foreign_codes"),
    ]


def check_loyalty_derivation(everyone: DataFrame, valid: DataFrame, derived: bool = True) -> DataFrame:
    """Loyalty codes: set, well-formed, and derived for a plausible share of lines.

    Lines read back from an earlier run are all valid, so where they were not ``derived`` here no share is checked.
    """
    row = side_by_side(measure(everyone, {"all_rows": "count(*)"}), measure(valid, _code_measures(valid, "true")))
    checks = [c for c in _loyalty_checks() if derived or c.name != "loyalty_derivation_rate"]
    return as_checks("loyalty", row, checks)


def check_loyalty_lines(
    everyone: DataFrame, windows: DataFrame | None = None, settings: Settings | None = None, broadcast_rows: int = 0
) -> DataFrame:
    """The loyalty layer, and with windows the coverage layer, in one pass over all lines.

    The lines that should have a code are told by their card and submitter, not by the code.
    """
    lines = everyone.withColumns({"_valid": known_card() & known_submitter()})
    measures = {"all_rows": "count(*)", **_code_measures(lines, "_valid")}
    layers = {"loyalty": _loyalty_checks()}
    if windows is not None:
        lines = _with_coverage(lines, windows, settings, "DateKey", broadcast_rows)
        measures["covered_rows"] = "count_if(_valid AND _covered)"
        layers["coverage"] = _coverage_checks("valid_rows")
    return as_layers(measure(lines, measures), layers)


def check_promo_windows(df: DataFrame) -> DataFrame:
    """Spans and candidate windows: ordered, and of the length the dates say."""
    consistent = f"promo_duration_days = datediff({END}, {START}) + 1"
    measures = measure(
        df,
        {
            "short": "count_if(promo_duration_days <= 0)",
            "reversed": f"count_if({START} > {END})",
            "late_before": f"count_if(before_candidate_end >= {START})",
            "early_after": f"count_if(after_candidate_start <= {END})",
            "wrong_days": f"count_if(NOT coalesce({consistent}, false))",
        },
    )
    return as_checks(
        "windows",
        measures,
        [
            none_of("no_negative_durations", "Promotions shorter than a day", "short"),
            none_of("start_before_end", "Promotions that end before they start", "reversed"),
            none_of("before_window_correct", "Before windows that reach into the promotion", "late_before"),
            none_of("after_window_correct", "After windows that begin within the promotion", "early_after"),
            none_of("duration_consistent", "Durations that differ from their dates", "wrong_days"),
        ],
    )


def check_overlap_detection(promos: DataFrame, windows: DataFrame) -> DataFrame:
    """Overlap flags valid, no promotion lost, and dates set exactly where a window is accepted."""
    measures = {"rows_out": "count(*)"}
    for side in ("before", "after"):
        first, last = f"{side}_window_start", f"{side}_window_end"
        accepted = f"coalesce(has_{side}_window, false)"
        measures |= {
            f"bad_{side}_flag": f"count_if(NOT coalesce({side}_overlap IN (0, 1), false))",
            f"{side}_set": f"count_if(NOT {accepted} AND ({first} IS NOT NULL OR {last} IS NOT NULL))",
            f"{side}_unset": f"count_if({accepted} AND ({first} IS NULL OR {last} IS NULL))",
        }
    row = side_by_side(measure(promos, {"rows_in": "count(*)"}), measure(windows, measures))
    return as_checks(
        "overlap",
        row,
        [
            Check("row_count_preserved", "Promotions after overlap detection", "rows_out", "rows_in = rows_out", "rows_in"),
            none_of("before_overlap_valid", "Before flags neither 0 nor 1", "bad_before_flag"),
            none_of("after_overlap_valid", "After flags neither 0 nor 1", "bad_after_flag"),
            none_of("null_dates_when_invalid", "Rejected before windows that have dates", "before_set"),
            none_of("null_after_dates_when_invalid", "Rejected after windows that have dates", "after_set"),
            none_of("before_dates_when_valid", "Accepted before windows lacking dates", "before_unset"),
            none_of("after_dates_when_valid", "Accepted after windows lacking dates", "after_unset"),
        ],
    )


def check_tagged_transactions(tagged: DataFrame) -> DataFrame:
    """Tagged transactions: labelled, keyed and not negative."""
    rows = "tagged_rows" if "tagged_rows" in tagged.columns else "1"

    def rows_where(condition: str) -> str:
        return f"coalesce(sum(CASE WHEN {condition} THEN {rows} END), 0)"

    def negative(kind: str) -> str:
        counted = f"negative_{kind}_rows"
        if counted in tagged.columns:
            return f"coalesce(sum({counted}), 0)"
        return rows_where(f"{AMOUNTS[kind]} < 0")

    measures = measure(
        tagged,
        {
            "other_period": rows_where(f"period NOT IN ({literals(PERIODS)})"),
            "null_period": rows_where("period IS NULL"),
            "null_code": rows_where("LoyaltyCode IS NULL"),
            "null_outlet": rows_where(f"{OUTLET} IS NULL"),
            "negative_volume": negative("volume"),
            "negative_value": negative("value"),
        },
    )
    return as_checks(
        "tagging",
        measures,
        [
            none_of("valid_period_values", "Rows of an unknown period", "other_period"),
            none_of("no_null_periods", "Rows of no period", "null_period"),
            none_of("no_null_loyalty_codes", "Rows of no customer", "null_code"),
            none_of("no_negative_volumes", "Rows of negative volume", "negative_volume"),
            none_of("no_negative_values", "Rows of negative value", "negative_value"),
            none_of("no_null_outlets", "Rows of no outlet", "null_outlet"),
        ],
    )


def check_final_metrics(metrics: DataFrame, lift_severity: str = ERROR) -> DataFrame:
    """Wide metrics: keyed once, dated, not negative, and derived values within range.

    Lifts beyond the range are common where little was sold before; ``lift_severity`` says whether they fail.
    """
    row = measure(
        metrics,
        {
            "all_rows": "count(*)",
            "promos": _distinct(metrics, OUTLET, BRAND, PROMO),
            "null_outlet": f"count_if({OUTLET} IS NULL)",
            "null_brand": f"count_if({BRAND} IS NULL)",
            "null_promo": f"count_if({PROMO} IS NULL)",
            "null_date": f"count_if({START} IS NULL OR {END} IS NULL)",
            "reversed": f"count_if({START} > {END})",
            "negative_volume": "count_if(during_promo_total_volume < 0)",
            "negative_value": "count_if(during_promo_total_value < 0)",
            "negative_customers": "count_if(during_promo_total_loyalty_customers < 0)",
            "no_during": "count_if(during_promo_total_volume IS NULL)",
            "odd_lift": over(metrics, f"count_if(volume_lift_pct NOT BETWEEN {LIFT_RANGE[0]} AND {LIFT_RANGE[1]})", "volume_lift_pct"),
            "odd_rate": over(metrics, "count_if(customer_retention_rate < 0)", "customer_retention_rate"),
            "odd_spend": over(metrics, "count_if(value_per_loyal_customer_during < 0)", "value_per_loyal_customer_during"),
        },
    )
    checks = [
        none_of("no_null_outlets", "Promotions of no outlet", "null_outlet"),
        none_of("no_null_brands", "Promotions of no brand", "null_brand"),
        none_of("no_null_promos", "Promotions without a name", "null_promo"),
        none_of("no_null_dates", "Promotions without dates", "null_date"),
        none_of("no_negative_during_volume", "Promotions that sold a negative volume", "negative_volume"),
        Check("no_duplicate_rows", "Promotions in the result", "all_rows", "all_rows = promos", "promos"),
        none_of("date_ranges_valid", "Promotions dated backwards", "reversed"),
        none_of("no_negative_during_value", "Promotions that sold a negative value", "negative_value"),
        none_of("no_negative_during_customers", "Promotions of fewer than no customers", "negative_customers"),
        none_of("during_always_present", "Promotions without sales", "no_during", WARN),
    ]
    if "volume_lift_pct" in metrics.columns:
        checks += [
            none_of("volume_lift_reasonable", "Promotions whose lift is out of range", "odd_lift", lift_severity),
            none_of("retention_reasonable", "Promotions of negative retention", "odd_rate"),
            none_of("customer_value_reasonable", "Promotions of negative spend", "odd_spend"),
        ]
    return as_checks("output", row, checks)


def tagged_totals() -> dict[str, str]:
    """Volume and value of tagged transactions, in all and per period, by the names reconciliation reads."""
    totals = {}
    for kind, amount in AMOUNTS.items():
        totals[f"source_{kind}"] = f"coalesce(sum({amount}), 0)"
        for period in PERIODS:
            in_period = f"CASE WHEN period = '{period}' THEN {amount} END"
            totals[f"source_{period}_{kind}"] = f"coalesce(sum({in_period}), 0)"
    return totals


def check_reconciliation(
    tagged: DataFrame, metrics: DataFrame, totals: DataFrame | None = None, ledger: DataFrame | None = None
) -> DataFrame:
    """Volume and value add up to the same before and after aggregation, in all and per period.

    ``totals``, a row of :func:`tagged_totals`, spares reading the tagged rows again. With the ``ledger`` of these rows
    every place must agree to the last digit as well; ``quality.ledger.differences`` names those that do not.
    """
    output = {
        f"output_{period}_{kind}": f"coalesce(sum({period}_total_{kind}), 0)" for kind in AMOUNTS for period in PERIODS
    }
    source = measure(tagged, tagged_totals()) if totals is None else totals
    apart = [] if ledger is None else [measure(differences(ledger, metrics), {"places_apart": "count(*)"})]
    row = side_by_side(source, measure(metrics, output), *apart)

    def check(what: str, found: str, written: str) -> Check:
        # Nothing to compare with counts as no difference.
        share = percent(f"abs({written} - {found})", f"abs({found})")
        gap = f"CASE WHEN {found} = 0 THEN 0 ELSE {share} END"
        limit = str(MAX_RECONCILIATION_GAP)
        name, label = f"{what}_reconciles", f"Difference in {what.replace('_', ' ')}"
        return Check(name, label, f"round({gap}, 6)", f"{gap} < {limit}", limit, unit="%")

    checks = [
        check(kind, f"source_{kind}", f"({' + '.join(f'output_{p}_{kind}' for p in PERIODS)})")
        for kind in AMOUNTS
    ]
    checks += [
        check(f"{period}_{kind}", f"source_{period}_{kind}", f"output_{period}_{kind}")
        for period in PERIODS
        for kind in AMOUNTS
    ]
    if ledger is not None:
        checks.append(none_of("places_reconcile", "Places and periods whose totals differ", "places_apart"))
    return as_checks("reconciliation", row, checks)


def _covered_days(windows: DataFrame) -> DataFrame:
    """Days in any period of any promotion of an outlet and brand, as spans that do not meet.

    Equal spans are folded first, so what one outlet and brand sorts is limited by the calendar.
    """
    spans = period_spans(windows).select(*PLACE_KEYS, "span_start", "span_end").distinct()
    place = Window.partitionBy(*PLACE_KEYS)
    earlier = place.orderBy("span_start", "span_end").rowsBetween(Window.unboundedPreceding, -1)
    starts = spans.withColumns({"first": F.coalesce(F.col("span_start") > F.max("span_end").over(earlier), F.lit(True))})
    upto = place.orderBy("span_start", "span_end").rowsBetween(Window.unboundedPreceding, 0)
    islands = starts.withColumns({"island": F.count_if("first").over(upto)})
    return islands.groupBy(*PLACE_KEYS, "island").agg(F.min("span_start").alias("span_start"), F.max("span_end").alias("span_end")).drop("island")


def _with_coverage(lines: DataFrame, windows: DataFrame, settings: Settings, date_col: str, broadcast_rows: int) -> DataFrame:
    """Add ``_covered``. A line is in one span at most, so none is repeated."""
    lines, spans = by_month(lines, _covered_days(windows), settings, date_col)
    keys = (*PLACE_KEYS, "month")
    spans = broadcast_if_small(spans.withColumnsRenamed({k: f"span_{k}" for k in keys}), broadcast_rows)
    same_month = [F.col(k) == F.col(f"span_{k}") for k in keys]
    return lines.join(spans, [*same_month, F.expr(INSIDE)], "left").withColumns({"_covered": F.col("span_month").isNotNull()})


def _coverage_checks(whole: str) -> list[Check]:
    share = f"round({percent('covered_rows', whole)}, 6)"
    return [Check("source_coverage", "Valid lines inside a period", share, "true", severity=INFO, unit="%")]


def check_source_coverage(
    valid: DataFrame, windows: DataFrame, settings: Settings, date_col: str = "DateKey", broadcast_rows: int = 0
) -> DataFrame:
    """Share of valid loyalty lines that fall in any period of any promotion. Informational."""
    lines = _with_coverage(valid.select(*PLACE_KEYS, date_col), windows, settings, date_col, broadcast_rows)
    row = measure(lines, {"all_rows": "count(*)", "covered_rows": "count_if(_covered)"})
    return as_checks("coverage", row, _coverage_checks("all_rows"))
