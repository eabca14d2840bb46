"""Column lists and paths that the tests share."""

SF_SMALL = "/root/testdata/sf0.001"

CUSTOMER_COLUMNS = ("`Customer ID` string, `Customer Name` string, email string, phone string, "
                    "`Postal Code` string, Region string, Country string")
PRODUCT_COLUMNS = "`Product ID` string, `Product Name` string, Price string, Category string, `Sub-Category` string"
ORDER_COLUMNS = ("`Order ID` string, `Customer ID` string, `Product ID` string, Profit double, "
                 "`Order Date` string, `Ship Date` string")
