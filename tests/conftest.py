import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salesmart.session import build_session, checkpoint_root  # noqa: E402
from tables import CUSTOMER_COLUMNS, ORDER_COLUMNS, PRODUCT_COLUMNS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[*]", shuffle_partitions=8, app_name="salesmart-tests")
    checkpoint_root(session)  # the tests' own shared folder (none is set locally)
    yield session
    session.stop()


@pytest.fixture
def customers_raw(spark):
    """Two sound rows, one of each kind of fault, a repeated and two unusable ids."""
    rows = [
        ("K70", "Zoë Lindqvist", "zoe@post.example", "(555)-123-4567", "90210-1234", "central", "Norway"),
        ("K71", " Ngozi Eze ", None, "555.987.6543", None, " West ", "Ghana"),
        ("K72", None, "pat+lists@mail.example", "555-111-2222", "1841", "EAST", "Peru"),
        ("K73", "\t", "nobody", "nan", "12345.0", "Lagoon", None),
        ("K74", "O'Hara-Lind", "", "", "", "", "Ireland"),
        ("K75", "Mia Roe", "mia@x.example", "5551234567", "10101", "North", "Chile"),
        ("K75", "Mia Bell", "mia@x.example", "5551234567", "10101", "North", "Chile"),
        ("K75", "Mia Bell", "mia@x.example", "5551234567", "10101", None, "Chile"),
        (None, "Ghost", "g@x.example", "5551234567", "10101", "South", "Chile"),
    ]
    return spark.createDataFrame(rows, CUSTOMER_COLUMNS)


@pytest.fixture
def products_raw(spark):
    rows = [
        ("T-1", "kettle", "24.90", "Kitchen", "Boilers"),
        ("T-2", "lamp", "-3", "Lighting", "Desk"),
        ("T-3", "rug", None, "Textiles", "Floor"),
        ("T-4", "clock", "twelve", "Decor", "Wall"),
        ("T-5", "shelf", "0", "Wood", "Storage"),
        ("T-5", "shelf, oak", "110.5", "Wood", "Storage"),
        (None, "unlabelled", "8", "Misc", "Misc"),
    ]
    return spark.createDataFrame(rows, PRODUCT_COLUMNS)


@pytest.fixture
def orders_raw(spark):
    """Days come first in the dates; 2041 has two lines, 2044 to 2048 lack something."""
    rows = [
        ("2041", "K70", "T-1", 7.005, "9/11/2021", "12/11/2021"),
        ("2041", "K70", "T-5", 1.25, "9/11/2021", "12/11/2021"),
        ("2042", "K71", "T-5", -40.444, "31/2/2022", None),
        ("2043", "K75", "T-1", 0.333, "1/1/2022", "soon"),
        ("2044", "K99", "T-1", 2.0, "5/3/2022", "6/3/2022"),
        ("2045", "K72", "T-2", 2.0, "5/3/2022", "6/3/2022"),
        ("2046", "K98", "T-9", 2.0, "5/3/2022", "6/3/2022"),
        ("2047", "K70", None, 2.0, "5/3/2022", "6/3/2022"),
        ("2048", "K70", "T-1", float("nan"), "5/3/2022", "6/3/2022"),
        (None, "K70", "T-1", 2.0, "5/3/2022", "6/3/2022"),
    ]
    return spark.createDataFrame(rows, ORDER_COLUMNS)
