"""One case per validation rule, including null and edge inputs."""

import pytest
from pyspark.sql import functions as F

from salesmart.functions.rules import customer_rules, issues_of
from salesmart.functions.scalar import impute_name, parse_dmy, round2


def codes(spark, name=None, email="a@b.co", phone="1234567890", postal="12345", region="North"):
    df = spark.createDataFrame([(name, email, phone, postal, region)],
                               "n string, e string, p string, z string, r string")
    rules = customer_rules(F.col("n"), F.col("e"), F.col("p"), F.col("z"), F.col("r"))
    return list(df.select(issues_of(rules).alias("i")).first()["i"])


@pytest.mark.parametrize("name,expected", [
    ("John Doe", []),
    ("José Ñúñez", []),
    ("Zoë", []),
    (None, ["missing_name"]),
    ("", ["missing_name", "invalid_name"]),
    ("O'Brien", ["invalid_name"]),
    ("Anne-Marie", ["invalid_name"]),
    ("R2D2", ["invalid_name"]),
    ("Tab\tName", ["invalid_name"]),
])
def test_name_rules(spark, name, expected):
    assert codes(spark, name=name) == expected


@pytest.mark.parametrize("email,ok", [
    ("john.doe+x@example.co.uk", True), ("a@b.c", False), ("no-at.example.com", False),
    ("a@b", False), (None, True), ("", False),
])
def test_email_rule(spark, email, ok):
    assert ("invalid_email" not in codes(spark, name="A", email=email)) == ok


@pytest.mark.parametrize("phone,ok", [
    ("1234567890", True), ("(123)-456-7890", True), ("123.456.7890", True),
    ("123-456-7890", True), ("(123) 456-7890", False), ("123456789", False),
    ("1234567890.0", False), ("nan", False), (None, True),
])
def test_phone_rule(spark, phone, ok):
    assert ("invalid_phone" not in codes(spark, name="A", phone=phone)) == ok


@pytest.mark.parametrize("postal,ok", [
    ("12345", True), ("12345-6789", True), ("1841", False), ("12345.0", False),
    ("ABCDE", False), ("123456", False), (None, True),
])
def test_postal_rule(spark, postal, ok):
    assert ("invalid_postal" not in codes(spark, name="A", postal=postal)) == ok


@pytest.mark.parametrize("region,ok", [
    ("North", True), ("south", True), ("CENTRAL", True), ("West", True), ("east", True),
    ("Unknown", False), ("MIDDLE EAST", False), ("", False), (None, True),
])
def test_region_rule(spark, region, ok):
    assert ("invalid_region" not in codes(spark, name="A", region=region)) == ok


def test_rule_order_is_kept(spark):
    assert codes(spark, name="", email="x", phone="x", postal="x", region="x") == [
        "missing_name", "invalid_name", "invalid_email", "invalid_phone", "invalid_postal",
        "invalid_region"]


@pytest.mark.parametrize("name,email,expected", [
    (None, "jane@example.com", "IMPUTED_jane"),
    ("", "jane@example.com", "IMPUTED_jane"),
    ("   ", "jane@example.com", "IMPUTED_jane"),
    (None, None, "IMPUTED_"),
    (None, "no-at-sign", "IMPUTED_no-at-sign"),
    (None, "@host.com", "IMPUTED_"),
    ("Kept", "x@y.com", "Kept"),
])
def test_impute_name(spark, name, email, expected):
    df = spark.createDataFrame([(name, email)], "n string, e string")
    assert df.select(impute_name(F.col("n"), F.col("e"))).first()[0] == expected


@pytest.mark.parametrize("text,expected", [
    ("1/2/2023", "2023-02-01"), ("01/02/2023", "2023-02-01"), ("31/12/1999", "1999-12-31"),
    ("31/2/2023", None), ("2023-01-01", None), (None, None),
])
def test_parse_dmy(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(parse_dmy(F.col("t"))).first()[0]
    assert (None if got is None else str(got)) == expected


@pytest.mark.parametrize("x,expected", [
    (10.555, 10.56), (1.005, 1.01), (5.123, 5.12), (100.987, 100.99), (-1.005, -1.01),
    (2.675, 2.68),
])
def test_round_half_up(spark, x, expected):
    df = spark.createDataFrame([(x,)], "x double")
    assert df.select(round2(F.col("x"))).first()[0] == expected
