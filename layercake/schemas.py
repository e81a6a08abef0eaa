"""Declared schemas of the toolkit's inputs and outputs, and DDL generation.

All fields are nullable.  Table DDL is always generated from a ``StructType``
(:func:`ddl_columns`) so odd column names are quoted correctly.
"""

from __future__ import annotations

from pyspark.sql import types as T

from .names import quote

S, I, D, B = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
TS, DT, L = T.TimestampType(), T.DateType(), T.LongType()


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    """A StructType of nullable fields, in the order given."""
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --- fixed values: must equal the source system's names and types ----------

# Employee CSV (typed scan), in file order.
EMPLOYEE = struct(
    ("employee_id", I), ("first_name", S), ("last_name", S), ("email", S),
    ("department", S), ("job_title", S), ("salary", I), ("hire_date", DT),
    ("nationality", S), ("age", I), ("gender", S), ("education_level", S),
    ("performance_score", I), ("manager_id", I),
)

# Employee table = employee columns + hire_year + coordinates.
EMPLOYEE_TABLE = struct(
    *[(f.name, f.dataType) for f in EMPLOYEE.fields],
    ("hire_year", I), ("latitude", D), ("longitude", D),
)
EMPLOYEE_PARTITIONS = ("department", "job_title", "hire_year")

# Country geo dimension CSV.
COUNTRY_GEO = struct(("Country", S), ("Latitude", D), ("Longitude", D))

# Reverse-geocode (zip) dimension CSV.
REVERSE_GEOCODE = struct(
    ("Country", S), ("Country_Code", S), ("Geo_City", S), ("Geo_State", S),
    ("State_Code", S), ("Zipcode", S),
)

# User-service CSV, 66 columns in file order.
USER_SERVICE = struct(
    ("Everest ID", S), ("Visit Timestamp", TS), ("First Name", S), ("Middle Name", S),
    ("Last Name", S), ("Preferred Name", S), ("Email", S), ("Phone", S),
    ("Address 1", S), ("Address 2", S), ("City", S), ("State", S), ("Zipcode", S),
    ("Date of Birth", S),
    ("SP - Meals", D), ("SP - Respite(shelter)", D), ("SP - Shop", D),
    ("SP - Washer/Dryer", D), ("SP - Other", D), ("SP - Other Entry", S),
    ("NA - Shelters", D), ("NA - Low-cost housing", D), ("NA - Home repair/maintenance", D),
    ("NA - Rent assistance", D), ("NA - Mortgage assistance", D),
    ("NA - Landlord/Tenant issues Contacts, Other housing & shelter", S),
    ("NA - Housing/Shelter Other", D), ("NA - Housing/Shelter Other Entry", S),
    ("NA - Help buying food", D), ("NA - Food pantries", D),
    ("NA - Soup kitchens & Meals to-go", D), ("NA - Feeding children", D),
    ("NA - Home-delivered meals", D), ("NA - Holiday meals", D), ("NA - Food Contacts", S),
    ("NA - Food Others", D), ("NA - Food Others Entry", S),
    ("NA - Electric", D), ("NA - Gas", D), ("NA - Water", D), ("NA - Heating fuel", D),
    ("NA - Trash collection", D), ("NA - Utility payment plans", D),
    ("NA - Utility deposit assistance", D), ("NA - Disconnection protection", D),
    ("NA - Phone/Internet", D), ("NA - Utilities Contacts", S), ("NA - Utilities Others", D),
    ("NA - Utilities Others Entry", S),
    ("NA - Health insurance", D), ("NA - Medical expense assistance", D),
    ("NA - Medical provider", D), ("NA - Dental", D), ("NA - Eye care", D),
    ("NA - Prescription medication", D), ("NA - Nursing home and adult care", D),
    ("NA - Death related", D), ("NA - Public health and safety", D), ("NA - COVID testing", D),
    ("NA - COVID vaccination", D), ("NA - All other COVID", D),
    ("NA - Other health services", D), ("NA - Healthcare And COVID 19 Contacts", S),
    ("NA - Health and COVID 19 Others", D), ("NA - Health and COVID 19 Others Entry", S),
    ("New User", B),
)

# User-service table = the 66 columns + geo codes + visit year and month name.
USER_SERVICE_TABLE = struct(
    *[(f.name, f.dataType) for f in USER_SERVICE.fields],
    ("Country", S), ("Country_Code", S), ("State_Code", S),
    ("visit_year", I), ("visit_month", S),
)
USER_SERVICE_PARTITIONS = ("visit_year", "visit_month")

# Columns hashed in the user-service flow (the other name/address columns stay clear).
USER_SERVICE_PII = ("First Name", "Last Name", "Email", "Phone", "Date of Birth")

# Relational order source: bronze columns of the order-items star join.
ORDER_ITEMS_COLUMNS = (
    "OrderItemID", "Quantity", "UnitPrice", "Status", "OrderDate", "TotalAmount",
    "FirstName", "LastName", "Email", "ProductName", "ProductType", "Price",
)
ORDER_ITEMS_PII = ("FirstName", "LastName", "Email")

# Gold status report, one row, in declared order.
REPORT = T.StructType([
    T.StructField("items_shipped_count", L, False),
    T.StructField("items_delivered_count", L, False),
    T.StructField("items_pending_count", L, False),
    T.StructField("average_price", D, True),
    T.StructField("total_orders", L, False),
])
# report column -> status value counted in it (exact, case-sensitive match)
REPORT_STATUSES = {
    "items_shipped_count": "Shipped",
    "items_delivered_count": "Delivered",
    "items_pending_count": "Pending",
}

# Mapped landing table and the external clients export.
LANDING = struct(
    ("id", S), ("first_name", S), ("middle_name", S), ("last_name", S), ("city", S),
    ("state", S), ("country", S), ("zipcode", S), ("created_at", TS), ("updated_at", TS),
)
CLIENTS_COLUMNS = (
    "id", "first_name", "middle_name", "last_name", "zip_code", "address",
    "created_at", "updated_at",
)
ADDRESS_PARTS = ("city", "state", "country", "zipcode")

# Employee nationality recode.
NATIONALITY_RECODE = {"USA": "United States", "UK": "United Kingdom"}

# --- end of fixed values ----------------------------------------------------


def ddl_columns(schema: T.StructType) -> str:
    """``\\`a b\\` STRING, \\`c\\` INT`` for CREATE TABLE / ALTER TABLE."""
    return ", ".join(f"{quote(f.name)} {f.dataType.simpleString().upper()}" for f in schema.fields)
