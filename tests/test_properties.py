"""Property checks against brute force on small random tables."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from salesmart.operators.dedup import keep_one_per_key
from salesmart.operators.quality import clean_products

KEYS = st.sampled_from(["a", "b", "c", None])
TEXT = st.one_of(st.none(), st.sampled_from(["", " x", "x", "y", "Zed", "é"]))
NUM = st.one_of(st.none(), st.integers(-3, 3))
ROWS = st.lists(st.tuples(KEYS, TEXT, NUM, TEXT), min_size=0, max_size=25)


def _sort_key(row):
    # ascending, nulls first, column by column
    return tuple((0,) if v is None else (1, v) for v in row)


def brute_force(rows):
    groups = {}
    for k, *rest in rows:
        groups.setdefault(k, []).append(tuple(rest))
    return sorted(((k, *min(v, key=_sort_key)) for k, v in groups.items()), key=_sort_key)


@pytest.mark.parametrize("strategy", ["aggregate", "window"])
@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS)
def test_dedup_matches_brute_force(spark, strategy, rows):
    df = spark.createDataFrame(rows, "k string, a string, n int, b string").repartition(3)
    got = sorted((tuple(r) for r in keep_one_per_key(df, ["k"], strategy).collect()), key=_sort_key)
    assert got == brute_force(rows)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(prices=st.lists(st.one_of(st.none(), st.sampled_from(["-1", "0", "2.5", "abc", "1e3"])),
                       min_size=1, max_size=12))
def test_product_split_matches_brute_force(spark, prices):
    rows = [(f"P{i}", p, "cat", "sub") for i, p in enumerate(prices)]
    df = spark.createDataFrame(rows, "`Product ID` string, unit_price string, Category string, "
                                     "`Sub-Category` string")
    clean, issues = clean_products(df)

    def num(p):
        try:
            return float(p)
        except (TypeError, ValueError):
            return None

    assert sorted(r["Product ID"] for r in clean.collect()) == sorted(
        f"P{i}" for i, p in enumerate(prices) if num(p) is not None and num(p) >= 0)
    assert sorted(r["Product ID"] for r in issues.collect()) == sorted(
        f"P{i}" for i, p in enumerate(prices) if num(p) is not None and num(p) < 0)


def test_price_alias_first_match_wins(spark):
    df = spark.createDataFrame([("P1", "5", "7", "c", "s")],
                               "`Product ID` string, Price string, unit_price string, "
                               "Category string, `Sub-Category` string")
    clean, _ = clean_products(df)
    row = clean.first()
    assert row["UnitPrice"] == 5.0 and row["unit_price"] == "7"


def test_price_alias_missing_or_clashing(spark):
    none = spark.createDataFrame([("P1", "c", "s")], "`Product ID` string, Category string, "
                                                      "`Sub-Category` string")
    with pytest.raises(ValueError, match="price"):
        clean_products(none)
    clash = spark.createDataFrame([("P1", "5", 7.0, "c", "s")],
                                  "`Product ID` string, Price string, UnitPrice double, "
                                  "Category string, `Sub-Category` string")
    with pytest.raises(ValueError, match="clash"):
        clean_products(clash)


def test_ids_are_not_trimmed(spark):
    from salesmart import clean_customers, clean_orders
    customers = spark.createDataFrame(
        [("C1 ", "Ann", "a@b.co", "1234567890", "12345", "North", "X")],
        "`Customer ID` string, `Customer Name` string, email string, phone string, "
        "`Postal Code` string, Region string, Country string")
    products = spark.createDataFrame([("P1", 1.0, "c", "s")],
                                     "`Product ID` string, UnitPrice double, Category string, "
                                     "`Sub-Category` string")
    orders = spark.createDataFrame([("O1", "C1", "P1", 1.0, "1/1/2023", "1/1/2023")],
                                   "`Order ID` string, `Customer ID` string, `Product ID` string, "
                                   "Profit double, `Order Date` string, `Ship Date` string")
    cust, _ = clean_customers(customers)
    prod, _ = clean_products(products)
    _, issues = clean_orders(orders, cust, prod)
    assert [list(r["Issues"]) for r in issues.collect()] == [["invalid_customer_id"]]


# --- customer rules against brute force -------------------------------------

import regex  # noqa: E402

from salesmart import clean_customers  # noqa: E402
from salesmart.functions import rules as R  # noqa: E402

CHARS = st.sampled_from(list("abcXYZéÑ 1907@.-_()'\t\n+%") + ["  "])
SOME_TEXT = st.one_of(st.none(), st.lists(CHARS, max_size=12).map("".join))
PHONES = st.one_of(SOME_TEXT, st.sampled_from(["1234567890", "(123)-456-7890", "123.456.7890",
                                               "123-456-7890", " 123-456-7890 ", "1234567890\n"]))
POSTALS = st.one_of(SOME_TEXT, st.sampled_from(["12345", "12345-6789", " 12345", "1234"]))
EMAILS = st.one_of(SOME_TEXT, st.sampled_from(["a.b+c@ex-ample.co", "x@y.z", "@host.com"]))
REGIONS = st.one_of(SOME_TEXT, st.sampled_from(["North", " south ", "EAST", "west", "Central",
                                               "Nowhere"]))


def expected_codes(name, email, phone, postal, region):
    def trim(v):
        return None if v is None else v.strip(" ")

    def fails(pattern, v):
        return v is not None and regex.search(pattern, v) is None

    name, email, phone, postal, region = map(trim, (name, email, phone, postal, region))
    codes = []
    if name is None or name == "":
        codes.append(R.MISSING_NAME)
    if fails(R.NAME_PATTERN, name):
        codes.append(R.INVALID_NAME)
    if fails(R.EMAIL_PATTERN, email):
        codes.append(R.INVALID_EMAIL)
    if fails(R.PHONE_PATTERN, phone):
        codes.append(R.INVALID_PHONE)
    if fails(R.POSTAL_PATTERN, postal):
        codes.append(R.INVALID_POSTAL)
    if region is not None and region.upper() not in R.VALID_REGIONS:
        codes.append(R.INVALID_REGION)
    if name is None or name.strip(" ") == "":
        local = "" if email is None else (regex.match(r"^([^@]+)", email) or [None, ""])[1]
        name = "IMPUTED_" + (local or "")
    return codes, name


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(SOME_TEXT, EMAILS, PHONES, POSTALS, REGIONS), min_size=1, max_size=15))
def test_customer_rules_match_brute_force(spark, rows):
    data = [(f"C{i}", *r, "X") for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "`Customer ID` string, `Customer Name` string, email string, "
                                     "phone string, `Postal Code` string, Region string, "
                                     "Country string")
    clean, issues = clean_customers(df)
    got_clean = {r["Customer ID"]: (list(r["Issues"]), r["Customer Name"]) for r in clean.collect()}
    want = {f"C{i}": expected_codes(*r) for i, r in enumerate(rows)}
    assert got_clean == want
    got_issues = {r["CustomerID"]: list(r["Issues"]) for r in issues.collect()}
    assert got_issues == {k: v[0] for k, v in want.items() if v[0]}
