from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ondol.operators import units

SCHEMA = "id long, price_raw_ko string, rent_monthly_usd decimal(10,2), deposit_usd decimal(10,2)"
CASES = [
    ("월세 $1,500 / 보증금 $3,000", 150000, 300000),
    ("$1340.00 + deposit $2,680", 134000, 268000),
    ("보증금 800 월세 276 (단위: 만원)", 207000, 600000),
    ("4700/314 만원", 235500, 3525000),
    ("보 1,000만 / 월 146만", 109500, 750000),
    ("전세금 3억 6,800만원", None, 27600000),
    ("전세 3억 4천만원", None, 25500000),
    ("0.72K/month, 보증금 $0.72K", 72000, 72000),
    ("2.23천불 + deposit $2.23K", 223000, 223000),
    ("$694 per week, 보증금 $3,000", 300733, 300000),
    ("1박 $446 (보증금: $13,550)", 1356583, 1355000),
    ("하루 316불, 보증금 없음", 961167, 0),
    ("연 $23,160 + deposit 2 months' rent", 193000, 386000),
    ("$2,910/월\n보증금 월세 1달분", 291000, 291000),
    ("월 ₩1,120,000 (보증금 9만원)", 84000, 6750),
    ("협의", None, None),
    ("", None, None),
    (None, None, None),
]


@pytest.fixture(scope="module")
def rates(spark):
    return spark.createDataFrame([("USD", "usd_per_unit", 1.0), ("KRW", "usd_per_unit", 0.00075), ("day", "units_per_year", 365.0), ("week", "units_per_year", 52.0), ("month", "units_per_year", 12.0), ("year", "units_per_year", 1.0)], "unit_name string, kind string, factor double")


def test_texts(spark, rates):
    df = spark.createDataFrame([(k, t, None, None) for k, (t, _, _) in enumerate(CASES)], SCHEMA)
    got = {r.id: (r.rent_cents, r.deposit_cents) for r in units.resolve(df, rates).collect()}
    assert got == {k: (a, b) for k, (_, a, b) in enumerate(CASES)}


def test_missing_unit_is_settled_by_the_column_and_flagged_where_it_is_not(spark, rates):
    df = spark.createDataFrame([(1, "월세 150 보증금 1000", Decimal("1125.00"), Decimal("7500.00")), (2, "월세 150", None, None)], SCHEMA)
    got = {r.id: r for r in units.resolve(df, rates).collect()}
    assert got[1].rent_cents == 112500 and got[1].rent_unique
    assert got[2].rent_unique is not None


def test_found_reports_null_and_wrong_columns_only(spark, rates):
    df = spark.createDataFrame([(1, "$1,500, 보증금 $3,000", Decimal("1500.00"), None), (2, "$1,500, 보증금 $3,000", Decimal("150000.00"), Decimal("3000.00")), (3, "문의", None, None)], SCHEMA)
    assert rows(units.misrecorded(df, rates)) == [(1, "deposit", 300000), (2, "rent", 150000)]


def test_empty_extra_and_clashing_columns(spark, rates):
    assert units.misrecorded(spark.createDataFrame([], SCHEMA), rates).count() == 0
    df = spark.createDataFrame([(1, "$700", None, None)] * 2, SCHEMA).withColumns({"rent_cents": F.lit("old"), "note.x": F.lit(1)})
    out = units.resolve(df, rates)
    assert out.count() == 2 and "note.x" in out.columns and {r.rent_cents for r in out.collect()} == {70000}


def test_deposits_are_a_number_of_rents(spark, rates):
    # no unit at all: the rent is settled by its column, the deposit by the rent; without any column both stay open
    df = spark.createDataFrame([(1, "월세 150 보증금 1000", Decimal("1125.00"), None), (2, "월세 150 보증금 1000", None, None), (3, "월세 $1500 보증금 3000", None, None)], SCHEMA)
    got = {r.id: r for r in units.resolve(df, rates).collect()}
    assert (got[1].rent_cents, got[1].rent_unique, got[1].deposit_cents) == (112500, True, 750000)
    assert got[3].rent_unique and got[3].deposit_unique and got[3].deposit_cents == 300000
    open_ = rows(units.undecided(df, rates), "listing_id", "quantity")
    assert (2, "rent") in open_ and (2, "deposit") in open_ and (1, "rent") not in open_
    found = rows(units.misrecorded(df, rates), "listing_id", "quantity")
    assert (2, "rent") not in found and (2, "deposit") not in found


def test_tokens_taken_away_are_recovered_from_the_columns(spark, rates):
    # the column holds the true amount: dollars, thousands or ten thousands of won are told apart by the residuals
    cases = [(k, f"월세 {n} 보증금 {m}", Decimal(rent), Decimal(dep)) for k, (n, m, rent, dep) in enumerate([(1500, 3000, "1500", "3000"), (146, 1000, "1095", "7500"), (1_120_000, 2_000_000, "840", "1500"), (2, 4, "2000", "4000")])]
    got = {r.id: r for r in units.resolve(spark.createDataFrame(cases, SCHEMA), rates).collect()}
    for k, _, rent, dep in cases:
        assert (got[k].rent_cents, got[k].deposit_cents) == (int(rent * 100), int(dep * 100)), k
