from __future__ import annotations

import pytest

from promolens.operators.enrich import (
    enrich_scan,
    join_loyalty_promo,
    match_references,
    promos_with_sales,
)

SCAN = "ProductKey int, OutletKey int, DateKey int, n int"


def scan(spark):
    return spark.createDataFrame([(1, 1, 20250101, 1), (1, 9, 20250101, 2), (9, 1, 20250101, 3), (1, None, 20250102, 4)], SCAN)


def dimensions(spark):
    return (
        spark.createDataFrame([(1, "B")], "ProductKey int, ReportingBrandName string"),
        spark.createDataFrame([(1, "O")], "OutletKey int, OutletIdentifier string"),
        spark.createDataFrame([(20250101, 2025)], "DateKey int, CalendarYearNumber int"),
    )


@pytest.mark.parametrize("broadcast_rows", [0, 1])
def test_products_limit_and_the_rest_is_optional(spark, broadcast_rows):
    product, outlet, date = dimensions(spark)
    df = enrich_scan(scan(spark), product, outlet, date, broadcast_rows=broadcast_rows)
    got = {r.n: (r.OutletIdentifier, r.CalendarYearNumber) for r in df.collect()}
    assert got == {1: ("O", 2025), 2: (None, 2025), 4: (None, None)}
    assert set(enrich_scan(scan(spark), product).columns) == {*scan(spark).columns, "ReportingBrandName"}


def test_dimensions_over_the_limit_are_not_hinted(spark):
    product, *_ = dimensions(spark)
    two = product.union(product.selectExpr("ProductKey + 1", "ReportingBrandName"))

    def hinted(limit):
        plan = enrich_scan(scan(spark), two, broadcast_rows=limit)._jdf.queryExecution().logical().toString()
        return "broadcast" in plan

    assert (hinted(2), hinted(1), hinted(0)) == (True, False, False)


def references(spark):
    return [
        spark.createDataFrame([(1, "O1")], "OutletKey int, OutletIdentifier string"),
        spark.createDataFrame([("O1", "TX")], "OutletIdentifier string, State string"),
        spark.createDataFrame([(1, "B", "X1")], "ProductKey int, ReportingBrandName string, ExternalBrandCode string"),
        spark.createDataFrame([("X1", "V")], "ExternalBrandCode string, BrandVariant string"),
    ]


def test_references_are_followed(spark):
    rows = {r.n: r for r in match_references(scan(spark), *references(spark)).collect()}
    assert (rows[1].Ref_OutletIdentifier, rows[1].Ref_State, rows[1].Ref_BrandVariant) == ("O1", "TX", "V")
    assert (rows[2].Ref_State, rows[2].Ref_ExternalBrandCode, rows[3].Ref_BrandVariant) == (None, "X1", None)
    assert len(rows) == 4


def test_repeated_reference_keys_are_refused(spark):
    tables = references(spark)
    tables[1] = tables[1].union(tables[1].selectExpr("OutletIdentifier", "'NY'"))
    with pytest.raises(ValueError, match="outlet state"):
        match_references(scan(spark), *tables)


def test_loyalty_promo_join(spark):
    loyalty = spark.createDataFrame(
        [(1, 1, 20250101, "mine", "c1"), (1, 1, 20250101, "mine", "c2"), (2, 1, 20250101, "mine", "c3")],
        "ProductKey int, OutletKey int, DateKey int, ReportingBrandName string, LoyaltyCode string",
    )
    promo = spark.createDataFrame(
        [(1, 1, 20250101, "theirs", "P"), (3, 1, 20250101, "theirs", "Q")],
        "ProductKey int, OutletKey int, DateKey int, ReportingBrandName string, PromotionName string",
    )
    joined = join_loyalty_promo(loyalty, promo).collect()
    assert {(r.LoyaltyCode, r.PromotionName, r.ReportingBrandName, r.Promo_DateKey) for r in joined} == {
        ("c1", "P", "theirs", 20250101), ("c2", "P", "theirs", 20250101),
    }
    sold = promos_with_sales(promo, loyalty).collect()
    assert [r.PromotionName for r in sold] == ["P"]
