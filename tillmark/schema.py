"""Column names and types shared by the whole package.

Identifiers are ``bigint``: at the sizes this is meant for they outgrow 32 bits. Amounts are
decimals, so that a sum does not depend on the order in which Spark adds the rows up; cells with
more than two decimals are rounded half up when they are read.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# The columns a landing file must have, in the order of the sales relation.
MANDATORY_TYPES: dict[str, T.DataType] = {
    "customer_id": T.LongType(),
    "store_id": T.LongType(),
    "product_name": T.StringType(),
    "sales_date": T.DateType(),
    "sales_person_id": T.LongType(),
    "price": MONEY,
    "quantity": T.IntegerType(),
    "total_cost": MONEY,
}
MANDATORY = tuple(MANDATORY_TYPES)
ADDITIONAL = "additional_column"
CANONICAL = (*MANDATORY, ADDITIONAL)

SALES_SCHEMA = T.StructType(
    [T.StructField(name, dtype, True) for name, dtype in MANDATORY_TYPES.items()]
    + [T.StructField(ADDITIONAL, T.StringType(), True)]
)

CUSTOMER_SCHEMA = (
    "customer_id bigint, first_name string, last_name string, address string, pincode string, "
    "phone_number string, customer_joining_date date"
)
STORE_SCHEMA = (
    "id bigint, address string, store_pincode string, store_manager_name string, "
    "store_opening_date date, reviews string"
)
SALES_TEAM_SCHEMA = (
    "id bigint, first_name string, last_name string, manager_id bigint, is_manager string, "
    "address string, pincode string, joining_date date"
)

# The ledger's two states.
ACTIVE = "A"
INACTIVE = "I"
