from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from orefold.functions import bands, dates, masks, numbers, text


def one(values):
    return [(v,) for v in values]


def test_income_band_puts_null_into_the_open_band(rows):
    values = [None, 39999, 40000, 79999, 80000, 119999, 120000]
    expected = ["Very High", "Low", "Medium", "Medium", "High", "High", "Very High"]
    assert rows(one(values), "v long", bands.banded(F.col("v"), bands.INCOME_BANDS)) == expected


def test_codes_have_a_default(rows):
    gender = bands.labelled(F.col("v"), bands.GENDER_LABELS)
    assert rows(one(["M", "F", "Male", None]), "v string", gender) == ["Male", "Female", "Unknown", "Unknown"]
    marital = bands.labelled(F.col("v"), bands.MARITAL_LABELS)
    assert rows(one(["M", "S", "X"]), "v string", marital) == ["Married", "Single", "Unknown"]
    wide = bands.normalized_gender(F.col("v"))
    assert rows(one(["m", "Female", " MALE", "x", None]), "v string", wide) == ["Male", "Female", "Male", "Unknown", "Unknown"]


def test_three_price_tierings(rows):
    prices = one([Decimal(p) for p in ("49.99", "50", "199.99", "200", "249.99", "250", "499.99", "500", "999.99", "1000")])
    value = F.col("v")
    found = rows(
        prices,
        "v decimal(12,4)",
        bands.banded(value, bands.CATALOGUE_TIERS),
        bands.banded(value, bands.REVENUE_MIX_TIERS),
        bands.banded(value, bands.REPORT_TIERS),
    )
    assert [r[0] for r in found] == ["Budget"] + ["Mid-Range"] * 4 + ["Premium"] * 4 + ["Luxury"]
    assert [r[1][:2] for r in found] == ["01", "02", "02", "03", "03", "03", "03", "04", "04", "04"]
    assert [r[2] for r in found][:4] == ["Budget (<$50)", "Mid ($50-200)", "Mid ($50-200)", "Premium ($200-500)"]
    assert found[-1][2] == "Luxury (>$500)"


def test_region_code(rows):
    names = one(["Northwest", "United Kingdom", "Narnia", None])
    assert rows(names, "v string", bands.region_code(F.col("v"))) == ["NW", "UK", "NAR", None]


def test_rfm_segments(rows):
    data = [(30, 5), (30, 4), (90, 3), (180, 2), (365, 1), (366, 9)]
    expected = ["Champions", "Loyal", "Loyal", "Potential Loyalist", "At Risk", "Lost"]
    assert rows(data, "d int, n long", bands.rfm_segment(F.col("d"), F.col("n"))) == expected


def test_strict_and_lenient_dates(rows):
    texts = one(["2020-01-04", "1/4/2020", "01/04/2020", "bad", None])
    day = date(2020, 1, 4)
    assert rows(texts, "v string", dates.parse_date(F.col("v"))) == [day, None, None, None, None]
    assert rows(texts, "v string", dates.parse_any_date(F.col("v"))) == [day, day, day, None, None]


def test_years_between_counts_boundaries(rows):
    data = [(date(1973, 12, 31), date(2002, 1, 1)), (date(2001, 12, 31), date(2002, 1, 1))]
    assert rows(data, "a date, b date", dates.years_between(F.col("a"), F.col("b"))) == [29, 1]


def test_fiscal_parts(rows):
    data = [(2020, 7), (2020, 1), (2020, 12), (2020, 6)]
    year, month = F.col("y"), F.col("m")
    found = rows(data, "y int, m int", dates.fiscal_year(year, month), dates.fiscal_month(month), dates.fiscal_quarter(month))
    assert found == [(2021, 1, 1), (2020, 7, 3), (2021, 6, 2), (2020, 12, 4)]


def test_rounding_and_ratios(rows):
    found = rows(
        [(1.005, 0.0), (2.675, 8.0), (-1.005, 2.0)], "a double, b double", numbers.round2(F.col("a")), numbers.ratio2(F.col("a"), F.col("b"))
    )
    assert found == [(Decimal("1.01"), None), (Decimal("2.68"), Decimal("0.33")), (Decimal("-1.01"), Decimal("-0.50"))]


def test_money_label(rows):
    values = one([1234567.0, 345678.0, 12.0, 999.5, 1_250_000.0, 2_345_000_000.0, 0.0])
    expected = ["$1.2M", "$346K", "$12", "$1000", "$1.2M", "$2345.0M", "$0"]
    assert rows(values, "v double", numbers.money_label(F.col("v"))) == expected


def test_text_cleanup(rows):
    assert rows(one([" x ", "NULL", " null ", "N/A", "", None]), "v string", text.without_tokens(F.col("v"))) == ["x"] + [None] * 5
    names = one(["MARY-ANN o'NEIL", "north  west", "nation_14", "a.b/c", None])
    assert rows(names, "v string", text.title_case(F.col("v"))) == ["Mary-Ann O'neil", "North  West", "Nation_14", "A.B/C", None]
    assert rows(one(["0", " Red ", None]), "v string", text.or_default(F.col("v"), "Unknown", missing="0")) == ["Unknown", "Red", "Unknown"]


ROLES = ("ADMIN_ROLE", "ANALYST_ROLE", "SOMEBODY")


def masked(rows, value, ddl, mask):
    return list(rows([(value,)], ddl, *[mask(F.col("v"), role) for role in ROLES])[0])


def test_masks_per_role(rows):
    assert masked(rows, "jon24@example.com", "v string", masks.mask_email) == ["jon24@example.com", "j***@example.com", "***@***.com"]
    assert masked(rows, "Jon Yang", "v string", masks.mask_full_name) == ["Jon Yang", "Jon Y.", "J.Y."]
    assert masked(rows, 84999, "v long", masks.mask_income) == [84999, 80000, 0]
    assert masked(rows, date(1966, 4, 8), "v date", masks.mask_birth_date) == [date(1966, 4, 8), date(1966, 1, 1), None]
    assert masked(rows, "555-123-4567", "v string", masks.mask_phone) == ["555-123-4567", "***-***-4567", "***-***-****"]


def test_every_listed_role_has_a_tier_and_others_get_the_full_mask():
    assert {masks.tier_of(role.lower()) for role in masks.ROLE_TIERS} == {masks.PRIVILEGED, masks.ANALYST}
    assert masks.tier_of("VIEWER_ROLE") == masks.tier_of("") == masks.OTHER


def test_tiers_of_the_caller_replace_the_default_ones(rows):
    tiers = {"Stewards": masks.PRIVILEGED, "AUDIT": masks.ANALYST}
    seen = [masks.mask_income(F.col("v"), role, tiers) for role in ("stewards", "audit", "ADMIN_ROLE")]
    assert rows([(84999,)], "v long", *seen) == [(84999, 80000, 0)]


def test_iso_dates_are_what_the_strict_parser_finds(rows):
    texts = one(
        ["2020-01-04", "2021-02-29", "2020-02-30", "0000-01-01", "9999-12-31", "2020-1-4", " 2020-01-04", "2020-01-04 ", "2020-01-04T00:00:00",
         "2020-01-04\n", "2020", "2020-01", "+2020-01-04", "+12020-01-04", "-0001-01-04", "12020-01-04", "2020-13-01", "1/4/2020", "today", "", "-", "٢٠٢٠-٠١-٠٤"]
    )
    found = rows(texts, "v string", dates.parse_date(F.col("v")).cast("string"))
    assert found == rows(texts, "v string", F.try_to_date(F.col("v"), "yyyy-MM-dd").cast("string"))
    assert found[0] == "2020-01-04"
