"""Declared tables of the three layers: types, required columns, keys, layout and lineage.

Names, types and file names are fixed values: users' files and tables carry them.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_SALES = (
    "ORDERDATE string, STOCKDATE string, ORDERNUMBER string, PRODUCTKEY long, CUSTOMERKEY long, "
    "TERRITORYKEY long, ORDERLINEITEM long, ORDERQUANTITY long"
)

BRONZE_DDL = {
    "BRONZE_SALES_2020": _SALES,
    "BRONZE_SALES_2021": _SALES,
    "BRONZE_SALES_2022": _SALES,
    "BRONZE_CUSTOMER": (
        "CUSTOMERKEY long, PREFIX string, FIRSTNAME string, LASTNAME string, BIRTHDATE string, "
        "MARITALSTATUS string, GENDER string, EMAILADDRESS string, ANNUALINCOME long, "
        "TOTALCHILDREN long, EDUCATIONLEVEL string, OCCUPATION string, HOMEOWNER string"
    ),
    "BRONZE_PRODUCT": (
        "PRODUCTKEY long, PRODUCTSUBCATEGORYKEY long, PRODUCTSKU string, PRODUCTNAME string, "
        "MODELNAME string, PRODUCTDESCRIPTION string, PRODUCTCOLOR string, PRODUCTSIZE string, "
        "PRODUCTSTYLE string, PRODUCTCOST decimal(12,4), PRODUCTPRICE decimal(12,4)"
    ),
    "BRONZE_PRODUCT_CATEGORY": "PRODUCTCATEGORYKEY long, CATEGORYNAME string",
    "BRONZE_SUBCATEGORY": "PRODUCTSUBCATEGORYKEY long, SUBCATEGORYNAME string, PRODUCTCATEGORYKEY long",
    "BRONZE_CALENDAR": "DATE string",
    "BRONZE_TERRITORY": "SALESTERRITORYKEY long, REGION string, COUNTRY string, CONTINENT string",
    "BRONZE_RETURNS": "RETURNDATE string, TERRITORYKEY long, PRODUCTKEY long, RETURNQUANTITY long",
    "BRONZE_CATEGORY_SALES_UNPIVOT": (
        "DATE string, PRODUCT_CATEGORY string, NORTH_REGION long, CENTRAL_REGION long, SOUTH_REGION long"
    ),
}

SILVER_DDL = {
    "SILVER_CALENDAR": (
        "DATE_KEY date not null, YEAR int not null, MONTH_NUM int not null, MONTH_NAME string not null, "
        "DAY_OF_MONTH int not null, DAY_OF_WEEK_NAME string not null, DAY_OF_WEEK_NUM int not null, "
        "QUARTER_NUM int not null, QUARTER_NAME string not null, WEEK_OF_YEAR int not null, "
        "IS_WEEKEND boolean not null, FIRST_DAY_OF_MONTH date not null, LAST_DAY_OF_MONTH date not null"
    ),
    "SILVER_TERRITORY": (
        "TERRITORY_KEY long not null, REGION string not null, COUNTRY string not null, CONTINENT string not null"
    ),
    "SILVER_PRODUCT_CATEGORY": (
        "CATEGORY_KEY long not null, CATEGORY_NAME string not null, SUBCATEGORY_KEY long, SUBCATEGORY_NAME string"
    ),
    "SILVER_PRODUCT": (
        "PRODUCT_KEY long not null, SUBCATEGORY_KEY long, PRODUCT_SKU string, PRODUCT_NAME string, "
        "MODEL_NAME string, PRODUCT_DESCRIPTION string, PRODUCT_COLOR string, PRODUCT_SIZE string, "
        "PRODUCT_STYLE string, PRODUCT_COST decimal(12,4), PRODUCT_PRICE decimal(12,4), "
        "GROSS_MARGIN decimal(12,4), MARGIN_PCT decimal(7,2), SUBCATEGORY_NAME string, "
        "CATEGORY_NAME string, CATEGORY_KEY long"
    ),
    "SILVER_CUSTOMER": (
        "CUSTOMER_KEY long not null, PREFIX string, FIRST_NAME string, LAST_NAME string, FULL_NAME string, "
        "BIRTH_DATE date, AGE int, MARITAL_STATUS string, GENDER string, EMAIL_ADDRESS string, "
        "ANNUAL_INCOME long, INCOME_BAND string, TOTAL_CHILDREN long, EDUCATION_LEVEL string, "
        "OCCUPATION string, IS_HOME_OWNER boolean"
    ),
    "SILVER_SALES": (
        "ORDER_NUMBER string not null, ORDER_LINE_ITEM long not null, ORDER_DATE date, STOCK_DATE date, "
        "DAYS_FROM_STOCK_TO_ORDER long, PRODUCT_KEY long, CUSTOMER_KEY long, TERRITORY_KEY long, "
        "ORDER_QUANTITY long, SALES_YEAR int, SOURCE_FILE string"
    ),
    "SILVER_RETURNS": "RETURN_DATE date, TERRITORY_KEY long, PRODUCT_KEY long, RETURN_QUANTITY long",
    "SILVER_CATEGORY_SALES_UNPIVOT": (
        "SALE_DATE date, PRODUCT_CATEGORY string, REGION string, SALES_AMOUNT long"
    ),
}

GOLD_DDL = {
    "DIM_DATE": SILVER_DDL["SILVER_CALENDAR"]
    + ", FISCAL_YEAR int not null, FISCAL_MONTH int not null, FISCAL_QUARTER string not null",
    "DIM_CUSTOMER": SILVER_DDL["SILVER_CUSTOMER"],
    "DIM_PRODUCT": (
        "PRODUCT_KEY long not null, PRODUCT_SKU string, PRODUCT_NAME string, MODEL_NAME string, "
        "PRODUCT_DESCRIPTION string, PRODUCT_COLOR string, PRODUCT_SIZE string, PRODUCT_STYLE string, "
        "PRODUCT_COST decimal(12,4), PRODUCT_PRICE decimal(12,4), GROSS_MARGIN decimal(12,4), "
        "MARGIN_PCT decimal(7,2), SUBCATEGORY_KEY long, SUBCATEGORY_NAME string, CATEGORY_KEY long, "
        "CATEGORY_NAME string, PRICE_TIER string"
    ),
    "DIM_TERRITORY": (
        "TERRITORY_KEY long not null, REGION string, COUNTRY string, CONTINENT string, REGION_CODE string"
    ),
    "FACT_SALES": (
        "ORDER_NUMBER string not null, ORDER_LINE_ITEM long not null, ORDER_DATE_KEY date, PRODUCT_KEY long, "
        "CUSTOMER_KEY long, TERRITORY_KEY long, STOCK_DATE_KEY date, SALES_YEAR int, ORDER_QUANTITY long, "
        "UNIT_PRICE decimal(12,4), UNIT_COST decimal(12,4), GROSS_REVENUE decimal(14,2), "
        "TOTAL_COST decimal(14,2), GROSS_PROFIT decimal(14,2), MARGIN_PCT decimal(7,2), LEAD_TIME_DAYS long"
    ),
    "FACT_RETURNS": (
        "RETURN_DATE_KEY date, PRODUCT_KEY long, TERRITORY_KEY long, RETURN_QUANTITY long, "
        "UNIT_PRICE decimal(12,4), RETURN_REVENUE_IMPACT decimal(14,2)"
    ),
}


_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "long": LongType(),
    "int": IntegerType(),
    "date": DateType(),
    "boolean": BooleanType(),
    "decimal(12,4)": DecimalType(12, 4),
    "decimal(14,2)": DecimalType(14, 2),
    "decimal(7,2)": DecimalType(7, 2),
}


def columns(text: str) -> StructType:
    """Schema from ``NAME type [not null], ...``; unlike the DDL reader it needs no running session."""
    fields = []
    for column in text.split(", "):
        name, type_name, *rest = column.split(" ")
        fields.append(StructField(name, _TYPES[type_name], not rest))
    return StructType(fields)


BRONZE = {name: columns(text) for name, text in BRONZE_DDL.items()}
SILVER = {name: columns(text) for name, text in SILVER_DDL.items()}
GOLD = {name: columns(text) for name, text in GOLD_DDL.items()}
TABLES = {**BRONZE, **SILVER, **GOLD}

# Source file -> raw table.
SOURCE_FILES = {
    "Sales Data 2020.csv": "BRONZE_SALES_2020",
    "Sales Data 2021.csv": "BRONZE_SALES_2021",
    "Sales Data 2022.csv": "BRONZE_SALES_2022",
    "Customer Lookup.csv": "BRONZE_CUSTOMER",
    "Product Lookup.csv": "BRONZE_PRODUCT",
    "Product Categories Lookup.csv": "BRONZE_PRODUCT_CATEGORY",
    "Subcategories Lookup.csv": "BRONZE_SUBCATEGORY",
    "Calendar Lookup.csv": "BRONZE_CALENDAR",
    "Territory Lookup.csv": "BRONZE_TERRITORY",
    "Returns Data.csv": "BRONZE_RETURNS",
    "Product Category Sales (Unpivot Demo).csv": "BRONZE_CATEGORY_SALES_UNPIVOT",
}

# Columns whose combination should be unique per raw table.
UNIQUE_KEYS = {
    "BRONZE_SALES_2020": ("ORDERNUMBER", "ORDERLINEITEM"),
    "BRONZE_SALES_2021": ("ORDERNUMBER", "ORDERLINEITEM"),
    "BRONZE_SALES_2022": ("ORDERNUMBER", "ORDERLINEITEM"),
    "BRONZE_CUSTOMER": ("CUSTOMERKEY",),
    "BRONZE_PRODUCT": ("PRODUCTKEY",),
    "BRONZE_TERRITORY": ("SALESTERRITORYKEY",),
    "BRONZE_CALENDAR": ("DATE",),
    "BRONZE_RETURNS": ("RETURNDATE", "PRODUCTKEY", "TERRITORYKEY"),
    "BRONZE_PRODUCT_CATEGORY": ("PRODUCTCATEGORYKEY",),
    "BRONZE_SUBCATEGORY": ("PRODUCTSUBCATEGORYKEY",),
}

# (child, child column, parent, parent column); SALES stands for the union of the yearly files.
FOREIGN_KEYS = (
    ("SALES", "CUSTOMERKEY", "CUSTOMER", "CUSTOMERKEY"),
    ("SALES", "PRODUCTKEY", "PRODUCT", "PRODUCTKEY"),
    ("SALES", "TERRITORYKEY", "TERRITORY", "SALESTERRITORYKEY"),
    ("SALES", "ORDERDATE", "CALENDAR", "DATE"),
    ("RETURNS", "PRODUCTKEY", "PRODUCT", "PRODUCTKEY"),
    ("RETURNS", "TERRITORYKEY", "TERRITORY", "SALESTERRITORYKEY"),
    ("RETURNS", "RETURNDATE", "CALENDAR", "DATE"),
    ("PRODUCT", "PRODUCTSUBCATEGORYKEY", "SUBCATEGORY", "PRODUCTSUBCATEGORYKEY"),
    ("SUBCATEGORY", "PRODUCTCATEGORYKEY", "PRODUCT_CATEGORY", "PRODUCTCATEGORYKEY"),
)

# Columns the stored files are ordered by.
CLUSTER_KEYS = {
    "SILVER_SALES": ("ORDER_DATE", "TERRITORY_KEY"),
    "DIM_DATE": ("YEAR", "MONTH_NUM"),
    "DIM_CUSTOMER": ("INCOME_BAND", "OCCUPATION"),
    "DIM_PRODUCT": ("CATEGORY_NAME", "PRICE_TIER"),
    "FACT_SALES": ("ORDER_DATE_KEY", "TERRITORY_KEY", "PRODUCT_KEY"),
    "FACT_RETURNS": ("RETURN_DATE_KEY", "TERRITORY_KEY"),
}

# Columns that equality lookups should be fast on.
LOOKUP_COLUMNS = {
    "FACT_SALES": ("ORDER_NUMBER",),
    "DIM_CUSTOMER": ("EMAIL_ADDRESS", "FULL_NAME"),
    "DIM_PRODUCT": ("PRODUCT_SKU", "PRODUCT_NAME"),
}

RETENTION_DAYS = {"BRONZE": 90, "SILVER": 30, "GOLD": 14}

# (tables, column, category, policy)
PII_COLUMNS = (
    ("SILVER_CUSTOMER", "EMAIL_ADDRESS", "Contact info", "MASK_EMAIL_ADDRESS"),
    ("SILVER_CUSTOMER", "FULL_NAME", "Identity", "MASK_FULL_NAME"),
    ("SILVER_CUSTOMER", "ANNUAL_INCOME", "Financial", "MASK_ANNUAL_INCOME"),
    ("SILVER_CUSTOMER", "BIRTH_DATE", "Demographic", "MASK_BIRTH_DATE"),
    ("DIM_CUSTOMER", "EMAIL_ADDRESS", "Contact info", "MASK_EMAIL_ADDRESS"),
    ("DIM_CUSTOMER", "FULL_NAME", "Identity", "MASK_FULL_NAME"),
    ("DIM_CUSTOMER", "ANNUAL_INCOME", "Financial", "MASK_ANNUAL_INCOME"),
    ("DIM_CUSTOMER", "BIRTH_DATE", "Demographic", "MASK_BIRTH_DATE"),
    ("BRONZE_CUSTOMER", "EMAILADDRESS", "Contact info", None),
)

# Class -> (what it covers, required action, columns of that class by table). Aggregated figures are INTERNAL.
SENSITIVITY = {
    "RESTRICTED": (
        "PII: name, email, DOB, income",
        "Dynamic masking + role restriction",
        {"DIM_CUSTOMER": ("FIRST_NAME", "LAST_NAME", "FULL_NAME", "BIRTH_DATE", "EMAIL_ADDRESS", "ANNUAL_INCOME")},
    ),
    "CONFIDENTIAL": (
        "Financial: revenue, profit, margin",
        "Role-based access (Analyst+)",
        {
            "FACT_SALES": ("GROSS_REVENUE", "GROSS_PROFIT", "MARGIN_PCT"),
            "FACT_RETURNS": ("RETURN_REVENUE_IMPACT",),
            "DIM_PRODUCT": ("GROSS_MARGIN", "MARGIN_PCT"),
        },
    ),
    "INTERNAL": ("Aggregated metrics, KPIs", "Available to all roles", {}),
    "PUBLIC": (
        "Territory names, category labels",
        "No restriction",
        {"DIM_TERRITORY": ("REGION", "COUNTRY", "CONTINENT"), "DIM_PRODUCT": ("SUBCATEGORY_NAME", "CATEGORY_NAME")},
    ),
}


def required_columns(table: str) -> list[str]:
    """Columns declared NOT NULL."""
    return [f.name for f in TABLES[table].fields if not f.nullable]


def nullable(schema: StructType) -> StructType:
    """The same columns without NOT NULL, as readers need it."""
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])
