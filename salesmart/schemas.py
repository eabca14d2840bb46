"""Column names, alias sets and declared schemas of the raw inputs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql.types import DoubleType, StringType, StructField, StructType

# Raw column names (fixed values: the names the raw files carry).
CUSTOMER_ID = "Customer ID"
CUSTOMER_NAME = "Customer Name"
EMAIL = "email"
PHONE = "phone"
POSTAL_CODE = "Postal Code"
REGION = "Region"
COUNTRY = "Country"

PRODUCT_ID = "Product ID"
PRODUCT_NAME = "Product Name"
CATEGORY = "Category"
SUB_CATEGORY = "Sub-Category"
UNIT_PRICE = "UnitPrice"

ORDER_ID = "Order ID"
PROFIT = "Profit"
ORDER_DATE = "Order Date"
SHIP_DATE = "Ship Date"
SHIP_MODE = "Ship Mode"
QUANTITY = "Quantity"
PRICE = "Price"
DISCOUNT = "Discount"

# Columns an order must carry to be kept at all (Ship Date may be missing).
ORDER_REQUIRED = (ORDER_ID, CUSTOMER_ID, PRODUCT_ID, PROFIT, ORDER_DATE)

# Alias sets (fixed values), compared after lower-casing and stripping.
PRICE_ALIASES = ("price per product", "price", "unitprice", "unit_price")
CUSTOMER_ID_ALIASES = ("customer id", "customer_id")
CUSTOMER_NAME_ALIASES = ("customer name", "name", "customer_name")
COUNTRY_ALIASES = ("country", "country_name")

# Column order of the enriched fact; absent optional columns are skipped.
ENRICHED_COLUMNS = (
    "Order ID", "OrderDate", "ShipDate", "Ship Mode",
    "CustomerID", "CustomerName", "Country",
    "ProductID", "Category", "SubCategory",
    "Quantity", "Price", "Discount",
    "ProfitRounded", "Year",
)

CUSTOMER_SCHEMA = StructType([
    StructField(CUSTOMER_ID, StringType()),
    StructField(CUSTOMER_NAME, StringType()),
    StructField(EMAIL, StringType()),
    StructField(PHONE, StringType()),
    StructField(POSTAL_CODE, StringType()),
    StructField(REGION, StringType()),
    StructField(COUNTRY, StringType()),
])

ORDER_SCHEMA = StructType([
    StructField(ORDER_ID, StringType()),
    StructField(CUSTOMER_ID, StringType()),
    StructField(PRODUCT_ID, StringType()),
    StructField(ORDER_DATE, StringType()),
    StructField(SHIP_DATE, StringType()),
    StructField(QUANTITY, DoubleType()),
    StructField(PRICE, DoubleType()),
    StructField(DISCOUNT, DoubleType()),
    StructField(PROFIT, DoubleType()),
    StructField(SHIP_MODE, StringType()),
])


def q(name: str) -> str:
    """``name`` quoted for use inside SQL expression text."""
    return "`" + name.replace("`", "``") + "`"


def resolve_alias(columns: Iterable[str], aliases: Iterable[str], pick: str = "first") -> str:
    """Name of the column whose normalised name is in ``aliases``.

    ``pick="first"`` returns the first match in column order, ``"last"`` the
    last one.  A missing column raises ``ValueError`` naming the alias set.
    """
    wanted = {a.lower().strip() for a in aliases}
    hits = [c for c in columns if c.lower().strip() in wanted]
    if not hits:
        raise ValueError(f"none of the columns {list(columns)} matches {sorted(wanted)}")
    return hits[0] if pick == "first" else hits[-1]
