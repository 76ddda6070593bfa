"""Named queries: one per operator or report, each over the whole tables of a catalog."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from promolens.config import Settings
from promolens.operators import reports
from promolens.operators.calendar import calendar_rollup
from promolens.operators.customers import customer_sets, distinct_customers, merge_sets, number_customers
from promolens.operators.discounts import add_discount_columns
from promolens.operators.enrich import (
    enrich_scan,
    join_loyalty_promo,
    match_references,
    promos_with_sales,
)
from promolens.operators.increments import changed_places, update_rollup
from promolens.operators.loyalty import (
    derive_loyalty_code,
    is_valid_loyalty_number,
    is_valid_submitter,
    standardise_brand_names,
)
from promolens.operators.metrics import (
    add_derived_metrics,
    aggregate_by_period,
    calculate_metrics,
    keep_all_promos,
    pivot_to_wide_format,
    rollup_by_customer,
    widen_rollup,
)
from promolens.operators.overlap import add_overlap_flags, detect_overlaps
from promolens.operators.promo_windows import build_promo_result, build_promo_windows
from promolens.operators.segments import tag_by_segments
from promolens.operators.survivors import key_conflicts
from promolens.operators.tagging import (
    get_after_windows,
    get_before_windows,
    get_during_windows,
    prepare_loyalty_dates,
    tag_after_transactions,
    tag_before_transactions,
    tag_during_transactions,
    tag_transactions,
    union_all_periods,
)
from promolens.plans.stages import Stages
from promolens.quality import guards, layers
from promolens.quality.gaps import date_gaps
from promolens.quality.history import run_values, value_drift
from promolens.quality.ledger import differences
from promolens.quality.report import QualityReport, check_frames, save_audit
from promolens.schemas import AFTER, BEFORE, BRAND, DURING, OUTLET, PROMO_KEYS
from promolens.sources.loaders import VIEWS
from promolens.sources.sample import BRAND_RULES, SETTINGS, sample_catalog
from promolens.sources.sink import save_metrics, stage

LINE = ("OutletKey", "ProductKey", "DateKey", "TransactionID")

StageQuery = Callable[[Stages], DataFrame]


def _tables(view: str) -> StageQuery:
    return lambda s: s.table(view)


def _with_calendar(s: Stages) -> DataFrame:
    dimensions = (s.table(name) for name in ("product", "outlet", "date"))
    lines = enrich_scan(s.table("scan"), *dimensions, broadcast_rows=s.settings.broadcast_rows)
    return lines.select(
        *LINE, "MetricVolume", "MetricValue", "Brand", "BrandVariant", "ReportingBrandName",
        "Category", "OutletIdentifier", "State", "SubmitterName", "ChainId", "WeekStartDate",
        "WeekEndDate", "CalendarYearNumber", "CalendarYearMonthNumber",
    )


def _reference_matching(s: Stages) -> DataFrame:
    references = ("outlet_reference", "outlet_state", "product_reference", "product_variant")
    tables = (s.table(name) for name in references)
    matched = match_references(s.table("scan"), *tables, broadcast_rows=s.settings.broadcast_rows)
    return matched.select(*LINE, *(c for c in matched.columns if c.startswith("Ref_")))


def _loyalty_promo(s: Stages) -> DataFrame:
    return join_loyalty_promo(s.loyalty_valid, s.table("single_promo")).select(
        "ProductKey", "OutletKey", "Promo_DateKey", "TransactionID", "LoyaltyCode",
        "OutletIdentifier", "PromotionName", "ReportingBrandName",
        "PromotionRateStartDateKey", "PromotionRateEndDateKey",
    )


def _loyalty_validity(s: Stages) -> DataFrame:
    flagged = is_valid_submitter(is_valid_loyalty_number(s.enriched))
    return flagged.select(
        *LINE, "LoyaltyNumber", "SubmitterName", "is_valid_loyalty", "is_valid_submitter"
    )


def _loyalty_code(s: Stages) -> DataFrame:
    coded = standardise_brand_names(derive_loyalty_code(s.enriched), BRAND_RULES)
    return coded.select(*LINE, "Brand", "ReportingBrandName", "LoyaltyCode")


def _null_mode(s: Stages) -> DataFrame:
    settings = Settings(**{**vars(s.settings), "unmatched": "null"})
    return detect_overlaps(s.kept("promos"), settings)


def _overlap_flags(s: Stages) -> DataFrame:
    return add_overlap_flags(s.kept("promos")).select(*PROMO_KEYS, "before_overlap", "after_overlap")


def _window_tables(s: Stages) -> DataFrame:
    marked = s.kept("windows")
    windows = {
        DURING: get_during_windows(marked).withColumns(
            {"window_start": F.col(PROMO_KEYS[3]), "window_end": F.col(PROMO_KEYS[4])}
        ),
        BEFORE: get_before_windows(marked).withColumnsRenamed(
            {"before_window_start": "window_start", "before_window_end": "window_end"}
        ),
        AFTER: get_after_windows(marked).withColumnsRenamed(
            {"after_window_start": "window_start", "after_window_end": "window_end"}
        ),
    }
    labelled = [df.withColumns({"period": F.lit(period)}) for period, df in windows.items()]
    return reduce(DataFrame.unionByName, labelled)


def _tag(tagger: Callable[..., DataFrame]) -> StageQuery:
    return lambda s: tagger(
        s.loyalty_valid, s.kept("windows"), s.settings, broadcast_rows=s.settings.broadcast_rows
    )


def _tagged_apart(s: Stages) -> DataFrame:
    taggers = (tag_during_transactions, tag_before_transactions, tag_after_transactions)
    return union_all_periods(*(_tag(tagger)(s) for tagger in taggers))


def _sink_roundtrip(s: Stages) -> DataFrame:
    """Saved without, then again with the derived columns, which the table must take up."""
    spark, folder = s.catalog.spark, s.folder
    wide = stage(widen_rollup(s.rollup), s.folder, "wide")
    table = "promo_metrics_" + folder.rsplit("-", 1)[1]
    save_metrics(wide, table, f"{folder}/table")
    save_metrics(add_derived_metrics(wide), table)
    return _taken_out(s, table)


def _failed_write(s: Stages) -> DataFrame:
    """Saved, then replaced by rows of which one can't be computed: the table must hold the first ones."""
    spark, folder = s.catalog.spark, s.folder
    wide = stage(widen_rollup(s.rollup), folder, "wide_before_failure")
    table = "promo_failing_" + folder.rsplit("-", 1)[1]
    save_metrics(wide, table, f"{folder}/failing")
    last = wide.agg(F.max("OutletIdentifier")).first()[0]
    broken = F.when(F.col("OutletIdentifier") == last, F.raise_error(F.lit("half way"))).otherwise(F.col("PromotionName"))
    try:
        save_metrics(wide.withColumns({"PromotionName": broken.cast("string"), "late": F.lit(1)}), table)
    except Exception as error:
        if "half way" not in str(error):
            raise
    return _taken_out(s, table).select(*wide.columns)


def _taken_out(s: Stages, table: str) -> DataFrame:
    """The rows of a table made for this query alone, which leaves the catalog."""
    rows = stage(s.catalog.spark.table(table), s.folder, table)
    s.catalog.spark.sql(f"DROP TABLE {table}")
    return rows


def _checks(check: StageQuery) -> StageQuery:
    return lambda s: check(s).select("check_name", "passed", "value")


def _source_checks(s: Stages) -> DataFrame:
    tables = (s.table(name) for name in ("scan", "outlet", "product", "promo_master"))
    return layers.check_source_data(*tables, s.settings)


def _reconciliation(s: Stages) -> DataFrame:
    rollup = s.kept("rollup")
    return layers.check_reconciliation(rollup, widen_rollup(rollup), s.totals, s.kept("ledger"))


def _altered_places(s: Stages) -> DataFrame:
    """Which places differ if the metrics of one outlet lost their after period and another's volume is one too much."""
    metrics = stage(widen_rollup(s.kept("rollup")), s.folder, "wide_to_alter")
    first, last = metrics.agg(F.min("OutletIdentifier"), F.max("OutletIdentifier")).first()
    lost = F.when(F.col("OutletIdentifier") != first, F.col("after_promo_total_value"))
    more = F.col("during_promo_total_volume") + F.when(F.col("OutletIdentifier") == last, 1).otherwise(0)
    return differences(s.kept("ledger"), metrics.withColumns({"after_promo_total_value": lost, "during_promo_total_volume": more}))


def _check_frames(s: Stages) -> list[DataFrame]:
    """All layers over stored results, the way a full run checks them. Three of them read the metrics."""
    rollup = s.kept("rollup")
    metrics = stage(add_derived_metrics(widen_rollup(rollup)), _apart(s), "metrics")
    return check_frames(
        s.scan,
        *(s.table(name) for name in ("outlet", "product", "promo_master")),
        s.loyalty_all,
        None,
        s.kept("promos"),
        s.kept("windows"),
        rollup,
        metrics,
        s.settings,
        totals=s.totals,
        ledger=s.kept("ledger"),
    )


def _quality_all(s: Stages) -> DataFrame:
    rows = reduce(DataFrame.unionByName, _check_frames(s))
    return rows.select("layer", "check_name", "passed", "value")


def _quality_audit(s: Stages) -> DataFrame:
    """The same check rows, appended to an audit table and read from there."""
    table = "promo_audit_" + s.folder.rsplit("-", 1)[1]
    save_audit(reduce(DataFrame.unionByName, _check_frames(s)), table)
    return _taken_out(s, table).select("layer", "check_name", "passed", "value")


def _check_builders(s: Stages) -> DataFrame:
    report = QualityReport("custom").check_no_nulls(s.scan, "LoyaltyNumber").check_no_negatives(s.scan, "MetricVolume")
    return report.frame


def _check_results(s: Stages) -> DataFrame:
    """Checks evaluated by a report: collected in one job, the failed ones counted, and handed on as rows."""
    report = QualityReport("custom").check_no_nulls(s.scan, "LoyaltyNumber").check_no_negatives(s.scan, "MetricVolume")
    rows = report.as_frame(s.catalog.spark).select("layer", "check_name", "severity", "passed", "value")
    return rows.withColumns({"passed_checks": F.lit(report.passed_count), "failed_checks": F.lit(report.failed_count)})


def _with_brand_rules(s: Stages) -> DataFrame:
    """Brands renamed on both sides, so promotions still find their sales."""
    return Stages(s.catalog, replace(s.settings, brand_rules=BRAND_RULES)).metrics


def _distinct_customers(s: Stages) -> DataFrame:
    """Customers per brand, state, period and in all, of the union of sets made in two runs with a dictionary that grew."""
    rollup, folder = s.kept("rollup"), _apart(s)
    odd = F.pmod(F.xxhash64(BRAND), F.lit(2)) == 1
    first = stage(number_customers(rollup.filter(odd)), folder, "customers_then")
    sets = stage(customer_sets(rollup.filter(odd), first), folder, "sets_then")
    grown = stage(number_customers(rollup, first), folder, "customers_now")
    sets = stage(merge_sets(sets, customer_sets(rollup.filter(~odd), grown)), folder, "sets_now")
    placed = sets.join(s.table("outlet").select(OUTLET, "State"), OUTLET, "left")
    return distinct_customers(placed, [[BRAND], ["State"], ["period"], [BRAND, "period"], []])


def _apart(s: Stages) -> str:
    """A sub-folder for the steps of one query, of which several may share the stages."""
    return f"{s.folder}/{uuid.uuid4().hex}"


# Days up to which sales had come in, by run.
ARRIVALS = (date(1999, 6, 30), date(2000, 9, 15))


def _known_windows(s: Stages, upto: date | None, folder: str) -> DataFrame:
    """Promotion windows as a run on that day saw them: no later rates, and that day as today; the settings' for none."""
    if upto is None:
        return s.kept("windows")
    rates = s.rates.filter(F.col("DateKey") <= int(upto.strftime("%Y%m%d")))
    settings = replace(s.settings, as_of=upto)
    promos = stage(build_promo_windows(rates, settings), folder, f"promos_{upto:%Y%m%d}")
    return stage(detect_overlaps(promos, settings), folder, f"windows_{upto:%Y%m%d}")


def _incremental_rollup(s: Stages) -> DataFrame:
    """A first run and two increments, each from the stored result of the one before."""
    folder = _apart(s)
    lines = stage(s.loyalty_valid.select(OUTLET, BRAND, "DateKey", "LoyaltyCode", "MetricVolume", "MetricValue"), folder, "lines")
    day = F.col("DateKey")
    begin = ARRIVALS[0]
    windows = _known_windows(s, begin, folder)
    first = lines.filter(day <= int(begin.strftime("%Y%m%d")))
    rollup = stage(rollup_by_customer(tag_transactions(first, windows, replace(s.settings, as_of=begin))), folder, "rollup_0")
    for k, (upto, then) in enumerate(zip(ARRIVALS, (*ARRIVALS[1:], None), strict=True), 1):
        known, later = int(upto.strftime("%Y%m%d")), _known_windows(s, then, folder)
        arrived = lines.filter((day > known) & (day <= (int(then.strftime("%Y%m%d")) if then else 99991231)))
        changed = stage(changed_places(windows, later, upto), folder, f"changed_{k}")
        history = lines.filter(day <= known)
        updated = update_rollup(rollup, windows, later, history, arrived, s.settings, upto, broadcast_rows=s.settings.broadcast_rows, changed=changed)
        rollup, windows = stage(updated, folder, f"rollup_{k}"), later
    return rollup


def _changed_places(s: Stages) -> DataFrame:
    return changed_places(_known_windows(s, ARRIVALS[1], _apart(s)), s.kept("windows"), ARRIVALS[1])


def _repeated_references(s: Stages) -> tuple[DataFrame, DataFrame]:
    """Outlet references and states in which a third of the keys occur again and say something else."""
    again = F.pmod(F.col("OutletKey"), F.lit(3)) == 0
    references = s.table("outlet_reference")
    other = F.concat(F.lit("Z"), F.col(OUTLET))
    states = s.table("outlet_state")
    return (
        references.unionByName(references.filter(again).withColumns({OUTLET: other})),
        states.unionByName(states.filter(F.col(OUTLET).endswith("5")).withColumns({"State": F.lit(None).cast("string")})),
    )


def _reference_survivors(s: Stages) -> DataFrame:
    others = (s.table(name) for name in ("product_reference", "product_variant"))
    matched = match_references(s.table("scan"), *_repeated_references(s), *others, broadcast_rows=s.settings.broadcast_rows, survivors=True)
    return matched.select(*LINE, "Ref_OutletIdentifier", "Ref_State")


def _reference_conflicts(s: Stages) -> DataFrame:
    references, states = _repeated_references(s)
    found = {"outlet_reference": key_conflicts(references, ["OutletKey"]), "outlet_state": key_conflicts(states, [OUTLET])}
    named = [df.select(F.lit(name).alias("table_name"), F.col(df.columns[0]).cast("string").alias("key"), "key_rows", "differing") for name, df in found.items()]
    return reduce(DataFrame.unionByName, named)


def _quality_drift(s: Stages) -> DataFrame:
    """The sales checks of each year's lines, a run a year; the last run's against those before it, then tenfold."""
    year = F.floor(F.col("DateKey") / 10000).cast("int").alias("year")
    yearly = s.scan.groupBy(year).agg(F.count("*").alias("lines"), F.sum("MetricVolume").alias("volume"), F.max("MetricValue").alias("largest"))
    values = yearly.selectExpr("CAST(year AS STRING) AS run_id", "stack(3, 'lines', double(lines), 'volume', double(volume), 'largest', double(largest)) AS (check_name, value)")
    checks = values.select(F.lit("sales").alias("layer"), "check_name", F.lit(True).alias("passed"), "value", "run_id")
    runs = stage(checks, _apart(s), "check_runs")
    last = runs.agg(F.max("run_id")).first()[0]
    tenfold = run_values(runs.filter(F.col("run_id") == last).withColumns({"value": F.col("value") * 10}).drop("run_id"), "tenfold")
    judged = [value_drift(df, runs).withColumns({"run": F.lit(name)}) for name, df in ((last, runs.filter(F.col("run_id") == last)), ("tenfold", tenfold))]
    return reduce(DataFrame.unionByName, judged)


def _drilldown(s: Stages) -> DataFrame:
    place = ("000007", "Brand#11")
    return reports.validate_specific_outlet(s.place(*place), *place)


QUERIES: dict[str, StageQuery] = {
    **{f"load_{view}": _tables(view) for view in VIEWS},
    "enrich_scan": _with_calendar,
    "reference_matching": _reference_matching,
    "join_loyalty_promo": _loyalty_promo,
    "promo_result_joined": lambda s: build_promo_result(
        promos_with_sales(s.table("single_promo"), s.loyalty_valid)
    ),
    "discount_columns": lambda s: add_discount_columns(s.table("scan")).select(
        *LINE, "SMP_discount", "MP_discount", "CPN_discount", "is_promo"
    ),
    "loyalty_validity": _loyalty_validity,
    "loyalty_code": _loyalty_code,
    "loyalty_valid": lambda s: s.loyalty_valid.select(
        *LINE, "OutletIdentifier", "ReportingBrandName", "LoyaltyCode", "MetricVolume", "MetricValue"
    ),
    "promo_result": lambda s: build_promo_result(s.rates),
    "promo_windows": lambda s: s.promos,
    "overlap_flags": _overlap_flags,
    "detect_overlaps": lambda s: s.windows,
    "detect_overlaps_null_mode": _null_mode,
    "window_tables": _window_tables,
    "tag_during": _tag(tag_during_transactions),
    "tag_before": _tag(tag_before_transactions),
    "tag_after": _tag(tag_after_transactions),
    "tag_transactions": lambda s: s.tagged,
    "tag_by_segments": _tag(tag_by_segments),
    "union_all_periods": _tagged_apart,
    "metrics_long": lambda s: aggregate_by_period(s.tagged),
    "metrics_pivot": lambda s: pivot_to_wide_format(aggregate_by_period(s.tagged)),
    "metrics_wide": lambda s: widen_rollup(s.rollup),
    "metrics_derived": lambda s: s.metrics,
    "metrics_all_promos": lambda s: keep_all_promos(s.metrics, s.kept("windows")),
    "metrics_sink_roundtrip": _sink_roundtrip,
    "metrics_sink_failed_write": _failed_write,
    "quality_source": _checks(_source_checks),
    "quality_discounts": _checks(lambda s: layers.check_discount_flags(s.scan)),
    "quality_loyalty": _checks(lambda s: layers.check_loyalty_lines(s.loyalty_all)),
    "quality_windows": _checks(lambda s: layers.check_promo_windows(s.promos)),
    "quality_overlap": _checks(lambda s: layers.check_overlap_detection(s.kept("promos"), s.kept("windows"))),
    "quality_tagging": _checks(lambda s: layers.check_tagged_transactions(s.tagged)),
    "quality_output": _checks(lambda s: layers.check_final_metrics(s.metrics)),
    "quality_reconciliation": _checks(_reconciliation),
    "ledger": lambda s: s.kept("ledger"),
    "ledger_differences": _altered_places,
    "date_gaps": lambda s: date_gaps(s.table("scan"), expected_keys=(19961201, 19981231)),
    "outlet_date_gaps": lambda s: date_gaps(s.table("scan"), "OutletKey", least=21, expected_keys=(19970101, 19981231)),
    "quality_coverage": _checks(
        lambda s: layers.check_source_coverage(
            s.loyalty_valid, s.kept("windows"), s.settings, broadcast_rows=s.settings.broadcast_rows
        )
    ),
    "quality_all": _quality_all,
    "quality_audit": _quality_audit,
    "check_builders": _checks(_check_builders),
    "check_results": _check_results,
    "loyalty_dates": lambda s: prepare_loyalty_dates(s.loyalty_valid).select(*LINE, "DateKey_dt"),
    "calculate_metrics": lambda s: calculate_metrics(s.tagged, save_to_table=False),
    "metrics_with_brand_rules": _with_brand_rules,
    "metrics_from_loyalty_scan": lambda s: Stages(s.catalog, s.settings, loyalty_input="loyalty_scan").metrics,
    "validated_discounts": lambda s: guards.guard_discount_columns(s.scan).select(
        *LINE, "SMP_discount", "MP_discount", "CPN_discount", "is_promo"
    ),
    "validated_loyalty": lambda s: guards.guard_loyalty_derivation(s.loyalty_valid).select(
        *LINE, "OutletIdentifier", "ReportingBrandName", "LoyaltyCode", "MetricVolume", "MetricValue"
    ),
    "validated_windows": lambda s: guards.guard_promo_windows(s.kept("promos")),
    "validated_overlaps": lambda s: guards.guard_overlap_detection(s.kept("promos"), s.kept("windows")),
    "validated_tagged": lambda s: guards.guard_tagged_transactions(s.tagged),
    "validated_metrics": lambda s: guards.guard_metrics(s.metrics),
    "distinct_customers": _distinct_customers,
    "incremental_rollup": _incremental_rollup,
    "incremental_metrics": lambda s: add_derived_metrics(widen_rollup(_incremental_rollup(s))),
    "changed_places": _changed_places,
    "reference_survivors": _reference_survivors,
    "reference_conflicts": _reference_conflicts,
    "quality_drift": _quality_drift,
    "calendar_rollup": lambda s: calendar_rollup(s.table("scan"), 19970108, 19981120),
    "brand_calendar": lambda s: calendar_rollup(s.enriched, 19970108, 19981120, [BRAND]),
    "discount_summary": lambda s: reports.discount_summary(s.scan),
    "loyalty_summary": lambda s: reports.loyalty_summary(s.loyalty_all),
    "promo_windows_summary": lambda s: reports.promo_windows_summary(s.promos),
    "overlap_summary": lambda s: reports.overlap_summary(s.windows),
    "outlet_drilldown": _drilldown,
    "tagging_summary": lambda s: reports.tagging_summary(s.rollup),
    "metrics_summary": lambda s: reports.metrics_summary(s.metrics),
    "top_brands": lambda s: reports.top_brands(s.metrics),
    "metrics_sample": lambda s: reports.sample(s.metrics),
}


def as_doubles(df: DataFrame) -> DataFrame:
    """Decimals as doubles, after all arithmetic is done."""
    decimals = [f.name for f in df.schema if isinstance(f.dataType, DecimalType)]
    return df.withColumns({name: F.col(name).cast("double") for name in decimals})


def on_sample(query: StageQuery) -> Callable[[SparkSession, str], DataFrame]:
    """The query over a folder of test tables, decimals shown as doubles."""

    return lambda spark, folder: as_doubles(query(Stages(sample_catalog(spark, folder), SETTINGS)))
