"""The queries in plain SQL over the same tables.

Shared subqueries are written once in ``PARTS``; a statement gets those it names.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2002-01-01'"


def r2(value: str) -> str:
    return f"cast(round(cast({value} as decimal(28,6)), 2) as double)"


def ratio(top: str, bottom: str) -> str:
    return f"(cast({top} as double) / nullif(cast({bottom} as double), 0))"


def ratio2(top: str, bottom: str) -> str:
    return r2(ratio(top, bottom))


def pct(top: str, bottom: str) -> str:
    return r2(f"{ratio(top, bottom)} * 100")


def money(value: str) -> str:
    return f"cast(round({value}, 2) as double)"


def mean2(column: str) -> str:
    return ratio2(f"sum({column})", f"count({column})")


def banded(value: str, *bands: tuple) -> str:
    *bounded, rest = bands
    whens = " ".join(f"WHEN {value} < {bound} THEN '{label}'" for bound, label in bounded)
    return f"CASE {whens} ELSE '{rest}' END"


def choice(key: str, *values) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None)
    return f"CASE {key} % {len(values)} {whens} END"


def title(value: str) -> str:
    """Words separated by blanks start with a capital."""
    return f"array_to_string(list_transform(string_split(lower({value}), ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')"


ISO = "'%Y-%m-%d'"
SLASHED = "'%-m/%-d/%Y'"
PADDED = "'%m/%d/%Y'"

INCOME = (("40000", "Low"), ("80000", "Medium"), ("120000", "High"), "Very High")


def iso_date(text: str) -> str:
    return f"cast(try_strptime({text}, {ISO}) as date)"


CATEGORY = "CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3 WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 WHEN 'STANDARD' THEN 6 END"

PARTS = {
    # Raw layer
    "raw_calendar": """
        SELECT strftime(d, '%Y-%m-%d') AS DATE FROM (
            SELECT unnest(generate_series(date_trunc('year', min(o_orderdate)),
                date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d
            FROM orders)""",
    "raw_territory": """
        SELECT cast(n_nationkey as bigint) AS SALESTERRITORYKEY,
               CASE WHEN n_nationkey NOT IN (10, 11) THEN lower(n_name) END AS REGION,
               ' ' || upper(n_name) AS COUNTRY, r_name AS CONTINENT
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "keyed_part": f"""
        SELECT *, cast({CATEGORY} as bigint) AS category_key, try_cast(substr(p_brand, 7) as bigint) AS brand FROM part""",
    "raw_category": """
        SELECT DISTINCT category_key AS PRODUCTCATEGORYKEY, p_type || ' ' AS CATEGORYNAME FROM keyed_part""",
    "raw_subcategory": """
        SELECT DISTINCT category_key * 1000 + brand AS PRODUCTSUBCATEGORYKEY, p_brand AS SUBCATEGORYNAME,
               category_key AS PRODUCTCATEGORYKEY
        FROM keyed_part WHERE category_key <> 6""",
    "priced_part": """
        SELECT *, cast(cast(p_retailprice as decimal(12,4)) * p_size * 0.04 as decimal(12,4)) AS price FROM keyed_part""",
    "raw_product": f"""
        SELECT p_partkey AS PRODUCTKEY, category_key * 1000 + brand AS PRODUCTSUBCATEGORYKEY,
               ' SKU-' || p_partkey AS PRODUCTSKU, p_name AS PRODUCTNAME,
               string_split(p_name, ' ')[2] AS MODELNAME, p_name || ' by ' || p_brand AS PRODUCTDESCRIPTION,
               CASE WHEN p_size % 10 = 0 THEN '0' ELSE string_split(p_name, ' ')[1] || ' ' END AS PRODUCTCOLOR,
               CASE WHEN p_partkey % 9 = 0 THEN '0' ELSE cast(p_size as varchar) END AS PRODUCTSIZE,
               {choice("p_partkey", "U", None, "0", "W")} AS PRODUCTSTYLE,
               cast(price * cast(p_partkey % 70 + 40 as decimal(3,0)) * 0.01 as decimal(12,4)) AS PRODUCTCOST,
               price AS PRODUCTPRICE, p_type, p_brand, category_key
        FROM priced_part""",
    "raw_customer": f"""
        SELECT c_custkey AS CUSTOMERKEY, {choice("c_custkey", "MR. ", "MRS.", None)} AS PREFIX,
               upper(split_part(c_name, '#', 1)) AS FIRSTNAME, ' ' || split_part(c_name, '#', 2) AS LASTNAME,
               CASE WHEN c_custkey % 11 = 0 THEN strftime(DATE '1940-01-01' + cast(c_custkey * 7 % 25000 as integer), {SLASHED})
                    ELSE strftime(DATE '1940-01-01' + cast(c_custkey * 7 % 25000 as integer), {ISO}) END AS BIRTHDATE,
               {choice("c_custkey", "M", "S", "X")} AS MARITALSTATUS,
               {choice("c_custkey", "M", "F", "Male", "Female", None)} AS GENDER,
               replace(c_name, '#', '') || '@Example.com ' AS EMAILADDRESS,
               CASE WHEN c_acctbal >= 0 THEN cast(round(c_acctbal * 15) as bigint) END AS ANNUALINCOME,
               nullif(c_custkey % 6, 0) AS TOTALCHILDREN,
               {choice("c_custkey", "Bachelors", "High School ", None, "Graduate Degree")} AS EDUCATIONLEVEL,
               {title("c_mktsegment")} AS OCCUPATION, {choice("c_custkey", "Y", "N", None)} AS HOMEOWNER
        FROM customer""",
    "raw_sales": f"""
        SELECT CASE WHEN l_orderkey % 50 = 9 THEN 'bad'
                    WHEN l_orderkey % 10 = 8 THEN strftime(o_orderdate, {SLASHED})
                    WHEN l_orderkey % 10 = 9 THEN strftime(o_orderdate, {PADDED})
                    ELSE strftime(o_orderdate, {ISO}) END AS ORDERDATE,
               strftime(l_shipdate, {ISO}) AS STOCKDATE,
               CASE WHEN l_orderkey % 101 > 0 THEN 'SO' || l_orderkey END AS ORDERNUMBER,
               CASE WHEN l_orderkey % 97 = 0 THEN l_partkey + 1000000000000 ELSE l_partkey END AS PRODUCTKEY,
               o_custkey AS CUSTOMERKEY, cast(c_nationkey as bigint) AS TERRITORYKEY,
               cast(l_linenumber as bigint) AS ORDERLINEITEM,
               CASE WHEN NOT (l_orderkey % 10 = 0 AND l_linenumber = 7) THEN cast(l_quantity as bigint) END
                   AS ORDERQUANTITY,
               l_shipdate AS LOAD_TIMESTAMP, 'sales-' || l_returnflag || '.csv' AS SOURCE_FILE,
               CASE l_returnflag WHEN 'A' THEN 2020 WHEN 'N' THEN 2021 WHEN 'R' THEN 2022 END AS FILE_YEAR
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey""",
    "raw_returns": f"""
        SELECT CASE WHEN l_orderkey % 40 = 3 THEN strftime(l_shipdate, {SLASHED})
                    WHEN l_orderkey % 40 <> 7 THEN strftime(l_shipdate, {ISO}) END AS RETURNDATE,
               cast(c_nationkey as bigint) AS TERRITORYKEY,
               CASE WHEN l_orderkey % 50 = 0 THEN l_partkey + 1000000000000 ELSE l_partkey END AS PRODUCTKEY,
               CASE WHEN l_orderkey % 30 > 0 THEN cast(l_quantity as bigint) END AS RETURNQUANTITY
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
        WHERE l_returnflag = 'R'""",
    "raw_category_sales": f"""
        SELECT strftime(l_shipdate, {SLASHED}) AS DATE, p_type AS PRODUCT_CATEGORY,
               cast(sum(cast(l_quantity as bigint)) FILTER (WHERE l_suppkey % 3 = 0) as bigint) AS NORTH_REGION,
               cast(sum(cast(l_quantity as bigint)) FILTER (WHERE l_suppkey % 3 = 1) as bigint) AS CENTRAL_REGION,
               cast(sum(cast(l_quantity as bigint)) FILTER (WHERE l_suppkey % 3 = 2) as bigint) AS SOUTH_REGION
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
    # Curated layer
    "silver_calendar": """
        SELECT d AS DATE_KEY, cast(year(d) as integer) AS YEAR, cast(month(d) as integer) AS MONTH_NUM,
               strftime(d, '%b') AS MONTH_NAME, cast(day(d) as integer) AS DAY_OF_MONTH,
               strftime(d, '%a') AS DAY_OF_WEEK_NAME, cast(dayofweek(d) as integer) AS DAY_OF_WEEK_NUM,
               cast(quarter(d) as integer) AS QUARTER_NUM, 'Q' || quarter(d) AS QUARTER_NAME,
               cast(week(d) as integer) AS WEEK_OF_YEAR, dayofweek(d) IN (0, 6) AS IS_WEEKEND,
               cast(date_trunc('month', d) as date) AS FIRST_DAY_OF_MONTH, last_day(d) AS LAST_DAY_OF_MONTH
        FROM (SELECT cast(DATE as date) AS d FROM raw_calendar)""",
    "silver_territory": f"""
        SELECT SALESTERRITORYKEY AS TERRITORY_KEY, trim({title("trim(REGION)")}) AS REGION,
               trim({title("trim(COUNTRY)")}) AS COUNTRY, trim({title("CONTINENT")}) AS CONTINENT
        FROM raw_territory WHERE SALESTERRITORYKEY IS NOT NULL""",
    "silver_product_category": """
        SELECT c.PRODUCTCATEGORYKEY AS CATEGORY_KEY, trim(CATEGORYNAME) AS CATEGORY_NAME,
               PRODUCTSUBCATEGORYKEY AS SUBCATEGORY_KEY, trim(SUBCATEGORYNAME) AS SUBCATEGORY_NAME
        FROM raw_category c LEFT JOIN raw_subcategory s ON c.PRODUCTCATEGORYKEY = s.PRODUCTCATEGORYKEY""",
    "product_columns": f"""
        SELECT PRODUCTKEY AS PRODUCT_KEY, PRODUCTSUBCATEGORYKEY AS SUBCATEGORY_KEY, trim(PRODUCTSKU) AS PRODUCT_SKU,
               trim(PRODUCTNAME) AS PRODUCT_NAME, trim(MODELNAME) AS MODEL_NAME,
               trim(PRODUCTDESCRIPTION) AS PRODUCT_DESCRIPTION,
               coalesce(trim(nullif(PRODUCTCOLOR, '0')), 'Unknown') AS PRODUCT_COLOR,
               coalesce(trim(nullif(PRODUCTSIZE, '0')), 'N/A') AS PRODUCT_SIZE,
               coalesce(trim(nullif(PRODUCTSTYLE, '0')), 'N/A') AS PRODUCT_STYLE,
               PRODUCTCOST AS PRODUCT_COST, PRODUCTPRICE AS PRODUCT_PRICE,
               cast(PRODUCTPRICE - PRODUCTCOST as decimal(12,4)) AS GROSS_MARGIN,
               cast({pct("PRODUCTPRICE - PRODUCTCOST", "PRODUCTPRICE")} as decimal(7,2)) AS MARGIN_PCT,
               p_type, p_brand, category_key
        FROM raw_product""",
    "silver_product": """
        SELECT p.* EXCLUDE (p_type, p_brand, category_key), SUBCATEGORYNAME AS SUBCATEGORY_NAME,
               CATEGORYNAME AS CATEGORY_NAME, c.PRODUCTCATEGORYKEY AS CATEGORY_KEY
        FROM product_columns p
        LEFT JOIN raw_subcategory s ON p.SUBCATEGORY_KEY = s.PRODUCTSUBCATEGORYKEY
        LEFT JOIN raw_category c ON s.PRODUCTCATEGORYKEY = c.PRODUCTCATEGORYKEY""",
    "silver_customer": f"""
        SELECT CUSTOMERKEY AS CUSTOMER_KEY, trim(PREFIX) AS PREFIX, {title("trim(FIRSTNAME)")} AS FIRST_NAME,
               trim(LASTNAME) AS LAST_NAME, {title("trim(FIRSTNAME)")} || ' ' || trim(LASTNAME) AS FULL_NAME,
               {iso_date("BIRTHDATE")} AS BIRTH_DATE,
               cast(date_diff('year', {iso_date("BIRTHDATE")}, {AS_OF}) as integer) AS AGE,
               CASE MARITALSTATUS WHEN 'M' THEN 'Married' WHEN 'S' THEN 'Single' ELSE 'Unknown' END AS MARITAL_STATUS,
               CASE GENDER WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' ELSE 'Unknown' END AS GENDER,
               lower(trim(EMAILADDRESS)) AS EMAIL_ADDRESS, coalesce(ANNUALINCOME, 0) AS ANNUAL_INCOME,
               {banded("ANNUALINCOME", *INCOME)} AS INCOME_BAND, coalesce(TOTALCHILDREN, 0) AS TOTAL_CHILDREN,
               coalesce(trim(EDUCATIONLEVEL), 'Unknown') AS EDUCATION_LEVEL,
               coalesce(trim(OCCUPATION), 'Unknown') AS OCCUPATION,
               CASE HOMEOWNER WHEN 'Y' THEN true ELSE false END AS IS_HOME_OWNER
        FROM raw_customer""",
    "silver_sales": f"""
        SELECT ORDERNUMBER AS ORDER_NUMBER, ORDERLINEITEM AS ORDER_LINE_ITEM, {iso_date("ORDERDATE")} AS ORDER_DATE,
               {iso_date("STOCKDATE")} AS STOCK_DATE,
               date_diff('day', {iso_date("STOCKDATE")}, {iso_date("ORDERDATE")}) AS DAYS_FROM_STOCK_TO_ORDER,
               PRODUCTKEY AS PRODUCT_KEY, CUSTOMERKEY AS CUSTOMER_KEY, TERRITORYKEY AS TERRITORY_KEY,
               coalesce(ORDERQUANTITY, 0) AS ORDER_QUANTITY, FILE_YEAR AS SALES_YEAR, SOURCE_FILE
        FROM raw_sales WHERE ORDERNUMBER IS NOT NULL""",
    "silver_returns": f"""
        SELECT {iso_date("RETURNDATE")} AS RETURN_DATE, TERRITORYKEY AS TERRITORY_KEY, PRODUCTKEY AS PRODUCT_KEY,
               coalesce(RETURNQUANTITY, 0) AS RETURN_QUANTITY
        FROM raw_returns WHERE RETURNDATE IS NOT NULL""",
    "silver_unpivot": " UNION ALL ".join(
        f"SELECT cast(strptime(DATE, '%m/%d/%Y') as date) AS SALE_DATE, PRODUCT_CATEGORY, '{region}' AS REGION, "
        f"coalesce({region.upper()}_REGION, 0) AS SALES_AMOUNT FROM raw_category_sales"
        for region in ("North", "Central", "South")
    ),
    # Star schema
    "dim_date": """
        SELECT *, cast(year(FIRST_DAY_OF_MONTH + INTERVAL 6 MONTH) as integer) AS FISCAL_YEAR,
               cast(month(FIRST_DAY_OF_MONTH + INTERVAL 6 MONTH) as integer) AS FISCAL_MONTH,
               'FQ' || ((MONTH_NUM + 5) % 12 // 3 + 1) AS FISCAL_QUARTER
        FROM silver_calendar""",
    "dim_customer": "SELECT * FROM silver_customer",
    "dim_product": f"""
        SELECT * EXCLUDE (p_type, p_brand, category_key), p_brand AS SUBCATEGORY_NAME, p_type AS CATEGORY_NAME,
               category_key AS CATEGORY_KEY,
               {banded("PRODUCT_PRICE", ("50", "Budget"), ("250", "Mid-Range"), ("1000", "Premium"), "Luxury")}
                   AS PRICE_TIER
        FROM product_columns""",
    "dim_territory": f"""
        SELECT *, upper(left(REGION, 3)) AS REGION_CODE FROM (
            SELECT cast(n_nationkey as bigint) AS TERRITORY_KEY, {title("n_name")} AS REGION,
                   {title("n_name")} AS COUNTRY, {title("r_name")} AS CONTINENT
            FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)""",
    "sales_lines": """
        SELECT l_orderkey AS ORDER_NUMBER, cast(l_linenumber as bigint) AS ORDER_LINE_ITEM,
               cast(o_orderdate as date) AS ORDER_DATE_KEY, l_partkey AS PRODUCT_KEY, o_custkey AS CUSTOMER_KEY,
               cast(c_nationkey as bigint) AS TERRITORY_KEY, cast(l_shipdate as date) AS STOCK_DATE_KEY,
               cast(year(o_orderdate) as integer) AS SALES_YEAR, cast(l_quantity as bigint) AS ORDER_QUANTITY,
               date_diff('day', cast(l_shipdate as date), cast(o_orderdate as date)) AS LEAD_TIME_DAYS
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey""",
    "fact_sales": """
        SELECT s.ORDER_NUMBER, s.ORDER_LINE_ITEM, s.ORDER_DATE_KEY, s.PRODUCT_KEY, s.CUSTOMER_KEY,
               s.TERRITORY_KEY, s.STOCK_DATE_KEY, s.SALES_YEAR, s.ORDER_QUANTITY, s.LEAD_TIME_DAYS,
               PRODUCT_PRICE AS UNIT_PRICE, PRODUCT_COST AS UNIT_COST,
               cast(round(cast(ORDER_QUANTITY as integer) * PRODUCT_PRICE, 2) as decimal(14,2)) AS GROSS_REVENUE,
               cast(round(cast(ORDER_QUANTITY as integer) * PRODUCT_COST, 2) as decimal(14,2)) AS TOTAL_COST,
               cast(round(cast(ORDER_QUANTITY as integer) * (PRODUCT_PRICE - PRODUCT_COST), 2) as decimal(14,2))
                   AS GROSS_PROFIT,
               MARGIN_PCT
        FROM sales_lines s JOIN product_columns p ON s.PRODUCT_KEY = p.PRODUCT_KEY""",
    "messy_fact": """
        SELECT ORDER_NUMBER, ORDER_LINE_ITEM, ORDER_DATE AS ORDER_DATE_KEY, s.PRODUCT_KEY, CUSTOMER_KEY, TERRITORY_KEY,
               STOCK_DATE AS STOCK_DATE_KEY, SALES_YEAR, ORDER_QUANTITY,
               coalesce(PRODUCT_PRICE, 0) AS UNIT_PRICE, coalesce(PRODUCT_COST, 0) AS UNIT_COST,
               round(cast(ORDER_QUANTITY as integer) * coalesce(PRODUCT_PRICE, 0), 2) AS GROSS_REVENUE,
               round(cast(ORDER_QUANTITY as integer) * coalesce(PRODUCT_COST, 0), 2) AS TOTAL_COST,
               round(cast(ORDER_QUANTITY as integer) * coalesce(PRODUCT_PRICE - PRODUCT_COST, 0), 2) AS GROSS_PROFIT,
               coalesce(MARGIN_PCT, 0) AS MARGIN_PCT, DAYS_FROM_STOCK_TO_ORDER AS LEAD_TIME_DAYS
        FROM silver_sales s LEFT JOIN product_columns p ON s.PRODUCT_KEY = p.PRODUCT_KEY""",
    "fact_returns": """
        SELECT cast(l_shipdate as date) AS RETURN_DATE_KEY, l_partkey AS PRODUCT_KEY,
               cast(c_nationkey as bigint) AS TERRITORY_KEY, cast(l_quantity as bigint) AS RETURN_QUANTITY,
               PRODUCT_PRICE AS UNIT_PRICE,
               cast(round(cast(l_quantity as integer) * PRODUCT_PRICE, 2) as decimal(14,2)) AS RETURN_REVENUE_IMPACT
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
        JOIN product_columns ON l_partkey = PRODUCT_KEY
        WHERE l_returnflag = 'R'""",
    "dated": "SELECT * FROM fact_sales JOIN dim_date ON ORDER_DATE_KEY = DATE_KEY",
    # Report lines
    "report_lines": f"""
        SELECT *, {ratio("PROFIT", "REVENUE")} * 100 AS LINE_MARGIN FROM (
            SELECT ORDERNUMBER, ORDERDATE, s.CUSTOMERKEY, s.PRODUCTKEY, s.TERRITORYKEY, FILE_YEAR AS YEAR,
                   coalesce(ORDERQUANTITY, 0) AS ORDERQUANTITY, PRODUCTNAME, CATEGORYNAME, ANNUALINCOME, GENDER,
                   OCCUPATION, MARITALSTATUS, REGION, COUNTRY,
                   coalesce(PRODUCTCOST, 0) AS PRODUCTCOST, coalesce(PRODUCTPRICE, 0) AS PRODUCTPRICE,
                   cast(coalesce(ORDERQUANTITY, 0) as integer) * coalesce(PRODUCTPRICE, 0) AS REVENUE,
                   cast(coalesce(ORDERQUANTITY, 0) as integer) * coalesce(PRODUCTCOST, 0) AS COST,
                   cast(coalesce(ORDERQUANTITY, 0) as integer) * coalesce(PRODUCTPRICE - PRODUCTCOST, 0) AS PROFIT,
                   cast(month({iso_date("ORDERDATE")}) as integer) AS MONTH,
                   {banded("coalesce(PRODUCTPRICE, 0)", ("50", "Budget (<$50)"), ("200", "Mid ($50-200)"),
                           ("500", "Premium ($200-500)"), "Luxury (>$500)")} AS PRICE_TIER
            FROM raw_sales s
            LEFT JOIN raw_customer c ON s.CUSTOMERKEY = c.CUSTOMERKEY
            LEFT JOIN raw_product p ON s.PRODUCTKEY = p.PRODUCTKEY
            LEFT JOIN raw_subcategory sc ON p.PRODUCTSUBCATEGORYKEY = sc.PRODUCTSUBCATEGORYKEY
            LEFT JOIN raw_category ca ON sc.PRODUCTCATEGORYKEY = ca.PRODUCTCATEGORYKEY
            LEFT JOIN raw_territory t ON s.TERRITORYKEY = t.SALESTERRITORYKEY)""",
    "by_year": f"""
        SELECT YEAR, count(DISTINCT ORDERNUMBER) AS ORDERS, cast(sum(ORDERQUANTITY) as bigint) AS UNITS,
               {money("sum(REVENUE)")} AS REVENUE, {money("sum(PROFIT)")} AS PROFIT,
               {pct("sum(PROFIT)", "sum(REVENUE)")} AS MARGIN_PCT
        FROM report_lines GROUP BY YEAR""",
    "by_month": f"""
        SELECT YEAR, MONTH AS MONTH_NUM, strftime(make_date(2020, MONTH, 1), '%b') AS MONTH_NAME,
               {money("sum(REVENUE)")} AS REVENUE
        FROM report_lines WHERE MONTH IS NOT NULL GROUP BY YEAR, MONTH""",
    "by_category": f"""
        SELECT CATEGORYNAME AS CATEGORY_NAME, cast(sum(ORDERQUANTITY) as bigint) AS UNITS_SOLD,
               {money("sum(REVENUE)")} AS REVENUE, {money("sum(PROFIT)")} AS PROFIT,
               {mean2("cast(LINE_MARGIN as decimal(28,10))")} AS MARGIN_PCT
        FROM report_lines WHERE CATEGORYNAME IS NOT NULL GROUP BY CATEGORYNAME""",
    "by_territory": f"""
        SELECT COUNTRY, REGION, count(DISTINCT ORDERNUMBER) AS ORDERS, {money("sum(REVENUE)")} AS REVENUE,
               {money("sum(PROFIT)")} AS PROFIT
        FROM report_lines WHERE COUNTRY IS NOT NULL AND REGION IS NOT NULL GROUP BY COUNTRY, REGION""",
    "by_segment": f"""
        SELECT *, {ratio2("REVENUE", "CUSTOMERS")} AS REV_PER_CUST FROM (
            SELECT OCCUPATION, GENDER, count(DISTINCT CUSTOMERKEY) AS CUSTOMERS, {money("sum(REVENUE)")} AS REVENUE
            FROM report_lines WHERE OCCUPATION IS NOT NULL AND GENDER IS NOT NULL GROUP BY OCCUPATION, GENDER)""",
    "returned_by_category": f"""
        SELECT CATEGORY_NAME, cast(sum(UNITS_SOLD) as bigint) AS UNITS_SOLD,
               cast(coalesce(sum(UNITS_RETURNED), 0) as bigint) AS UNITS_RETURNED,
               {pct("coalesce(sum(UNITS_RETURNED), 0)", "sum(UNITS_SOLD)")} AS RETURN_RATE_PCT
        FROM (SELECT PRODUCTKEY, sum(ORDERQUANTITY) AS UNITS_SOLD, max(CATEGORYNAME) AS CATEGORY_NAME
              FROM report_lines WHERE PRODUCTKEY IS NOT NULL GROUP BY PRODUCTKEY) s
        LEFT JOIN (SELECT PRODUCTKEY, sum(RETURNQUANTITY) AS UNITS_RETURNED FROM raw_returns GROUP BY PRODUCTKEY) r
            ON s.PRODUCTKEY = r.PRODUCTKEY
        WHERE CATEGORY_NAME IS NOT NULL GROUP BY CATEGORY_NAME""",
    # Log
    "query_log": """
        SELECT event_id AS QUERY_ID, event_type || ' ' || repeat(props, 12) AS QUERY_TEXT,
               value * 100 AS TOTAL_ELAPSED_TIME, user_id * 1000000 AS BYTES_SCANNED,
               cast(value as decimal(18,4)) AS CREDITS_USED,
               cast(cast(value as decimal(16,4)) * 0.9 as decimal(18,4)) AS CREDITS_USED_COMPUTE,
               cast(cast(value as decimal(16,4)) * 0.1 as decimal(18,4)) AS CREDITS_USED_CLOUD_SERVICES,
               'WH_' || (user_id % 7) AS WAREHOUSE_NAME,
               CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'SUCCESS' END AS EXECUTION_STATUS, ts AS START_TIME
        FROM events""",
}

_NAMES = re.compile(r"\b(" + "|".join(PARTS) + r")\b")


def _needed(body: str, found: list[str]) -> None:
    for name in dict.fromkeys(_NAMES.findall(body)):
        if name not in found:
            _needed(PARTS[name], found)
            found.append(name)


def statement(body: str) -> str:
    parts: list[str] = []
    _needed(body, parts)
    if not parts:
        return body.strip()
    clauses = ",\n".join(f"{name} AS ({PARTS[name]})" for name in parts)
    return f"WITH {clauses}\n{body.strip()}"


def doubles(source: str, *columns: str) -> str:
    casts = ", ".join(f"cast({c} as double) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({casts}) FROM {source}"


_FACT_DECIMALS = ("UNIT_PRICE", "UNIT_COST", "GROSS_REVENUE", "TOTAL_COST", "GROSS_PROFIT", "MARGIN_PCT")
_PRODUCT_DECIMALS = ("PRODUCT_COST", "PRODUCT_PRICE", "GROSS_MARGIN", "MARGIN_PCT")
_REPORT_DECIMALS = ("PRODUCTCOST", "PRODUCTPRICE", "REVENUE", "COST", "PROFIT")

_ORDERS = "count(DISTINCT ORDER_NUMBER)"
_UNITS = "cast(sum(ORDER_QUANTITY) as bigint)"
_REVENUE = money("sum(GROSS_REVENUE)")
_PROFIT = money("sum(GROSS_PROFIT)")
_COST = money("sum(TOTAL_COST)")
_MARGIN = mean2("MARGIN_PCT")
_AOV = ratio2("sum(GROSS_REVENUE)", _ORDERS)

_MONTHLY_REVENUE = f"""
    SELECT YEAR, MONTH_NUM, MONTH_NAME, {_REVENUE} AS TOTAL_REVENUE, {_PROFIT} AS TOTAL_PROFIT,
           {_ORDERS} AS TOTAL_ORDERS
    FROM dated GROUP BY 1, 2, 3"""

_YEARS_SQL = f"""
    SELECT YEAR, {_ORDERS} AS ORDERS, {_UNITS} AS UNITS, {_REVENUE} AS REVENUE, {_PROFIT} AS PROFIT,
           {_MARGIN} AS MARGIN_PCT
    FROM dated GROUP BY YEAR"""


def _performance(pairs: str) -> str:
    returned = "coalesce(sum(RETURNED), 0)"
    return f"""
    SELECT p.PRODUCT_KEY, PRODUCT_NAME, PRODUCT_SKU, CATEGORY_NAME, SUBCATEGORY_NAME, PRICE_TIER,
           cast(PRODUCT_PRICE as double) AS PRODUCT_PRICE, cast(p.MARGIN_PCT as double) AS LIST_MARGIN_PCT,
           cast(sum(SOLD) as {{units}}) AS UNITS_SOLD, {money("sum(REVENUE)")} AS TOTAL_REVENUE,
           {money("sum(PROFIT)")} AS TOTAL_PROFIT, cast({returned} as {{units}}) AS UNITS_RETURNED,
           {pct(returned, "sum(SOLD)")} AS RETURN_RATE_PCT, {money("coalesce(sum(IMPACT), 0)")} AS RETURN_REVENUE_IMPACT
    FROM {pairs} JOIN dim_product p ON f.PRODUCT_KEY = p.PRODUCT_KEY
    GROUP BY 1, 2, 3, 4, 5, 6, 7, 8"""


# The published form: both facts joined on the product.
_PAIRS = """
    (SELECT s.PRODUCT_KEY, ORDER_QUANTITY AS SOLD, GROSS_REVENUE AS REVENUE, GROSS_PROFIT AS PROFIT,
            RETURN_QUANTITY AS RETURNED, RETURN_REVENUE_IMPACT AS IMPACT
     FROM fact_sales s LEFT JOIN fact_returns r ON s.PRODUCT_KEY = r.PRODUCT_KEY) f"""

# Each row once.
_ONCE = """
    (SELECT s.*, RETURNED, IMPACT FROM
        (SELECT PRODUCT_KEY, sum(ORDER_QUANTITY) AS SOLD, sum(GROSS_REVENUE) AS REVENUE, sum(GROSS_PROFIT) AS PROFIT
         FROM fact_sales GROUP BY PRODUCT_KEY) s
     LEFT JOIN (SELECT PRODUCT_KEY, sum(RETURN_QUANTITY) AS RETURNED, sum(RETURN_REVENUE_IMPACT) AS IMPACT
                FROM fact_returns GROUP BY PRODUCT_KEY) r ON s.PRODUCT_KEY = r.PRODUCT_KEY) f"""


def _return_rate(pairs: str, units: str) -> str:
    returned = "coalesce(sum(RETURNED), 0)"
    return f"""
    SELECT PRODUCT_NAME, CATEGORY_NAME, cast(sum(SOLD) as {units}) AS UNITS_SOLD,
           cast({returned} as {units}) AS UNITS_RETURNED, {pct(returned, "sum(SOLD)")} AS RETURN_RATE_PCT,
           {money("coalesce(sum(IMPACT), 0)")} AS RETURN_REVENUE_IMPACT
    FROM {pairs} JOIN dim_product p ON f.PRODUCT_KEY = p.PRODUCT_KEY
    GROUP BY 1, 2 HAVING sum(SOLD) > 0
    ORDER BY RETURN_RATE_PCT DESC NULLS FIRST, PRODUCT_NAME, CATEGORY_NAME LIMIT 20"""


# Days since the last order, number of orders, segment.
_RFM = ((30, 5, "Champions"), (90, 3, "Loyal"), (180, 2, "Potential Loyalist"), (365, 0, "At Risk"))
_SEGMENT = "coalesce({}, 'Lost')".format(
    ", ".join(f"if(RECENCY_DAYS <= {days} AND FREQUENCY >= {orders}, '{name}', NULL)" for days, orders, name in _RFM)
)

_C360 = f"""
    SELECT c.CUSTOMER_KEY, FULL_NAME, GENDER, AGE, INCOME_BAND, OCCUPATION, EDUCATION_LEVEL, MARITAL_STATUS,
           IS_HOME_OWNER, FIRST_PURCHASE_DATE, LAST_PURCHASE_DATE, RECENCY_DAYS, FREQUENCY, MONETARY_VALUE,
           AVG_ORDER_VALUE, TOTAL_UNITS_PURCHASED,
           {_SEGMENT} AS RFM_SEGMENT
    FROM dim_customer c JOIN (
        SELECT CUSTOMER_KEY, min(ORDER_DATE_KEY) AS FIRST_PURCHASE_DATE, max(ORDER_DATE_KEY) AS LAST_PURCHASE_DATE,
               cast(date_diff('day', max(ORDER_DATE_KEY), (SELECT max(ORDER_DATE_KEY) FROM fact_sales)) as integer)
                   AS RECENCY_DAYS,
               {_ORDERS} AS FREQUENCY, {_REVENUE} AS MONETARY_VALUE, {_AOV} AS AVG_ORDER_VALUE,
               {_UNITS} AS TOTAL_UNITS_PURCHASED
        FROM fact_sales GROUP BY CUSTOMER_KEY) b ON c.CUSTOMER_KEY = b.CUSTOMER_KEY"""

_DETAIL = """
    SELECT ORDER_NUMBER, ORDER_LINE_ITEM, SALES_YEAR, ORDER_DATE_KEY AS ORDER_DATE, YEAR, MONTH_NAME, QUARTER_NAME,
           DAY_OF_WEEK_NAME, IS_WEEKEND, FISCAL_YEAR, FISCAL_QUARTER, PRODUCT_NAME, PRODUCT_SKU, MODEL_NAME,
           PRODUCT_COLOR, PRODUCT_SIZE, SUBCATEGORY_NAME, CATEGORY_NAME, PRICE_TIER, FULL_NAME AS CUSTOMER_NAME,
           GENDER, MARITAL_STATUS, OCCUPATION, INCOME_BAND, EDUCATION_LEVEL, IS_HOME_OWNER, AGE, REGION, COUNTRY,
           CONTINENT, ORDER_QUANTITY, cast(UNIT_PRICE as double) AS UNIT_PRICE, cast(UNIT_COST as double) AS UNIT_COST,
           cast(GROSS_REVENUE as double) AS GROSS_REVENUE, cast(TOTAL_COST as double) AS TOTAL_COST,
           cast(GROSS_PROFIT as double) AS GROSS_PROFIT, cast(f.MARGIN_PCT as double) AS MARGIN_PCT, LEAD_TIME_DAYS
    FROM fact_sales f JOIN dim_date ON ORDER_DATE_KEY = DATE_KEY
    JOIN dim_product p ON f.PRODUCT_KEY = p.PRODUCT_KEY JOIN dim_customer c ON f.CUSTOMER_KEY = c.CUSTOMER_KEY
    JOIN dim_territory t ON f.TERRITORY_KEY = t.TERRITORY_KEY"""

_RETURNS_VIEW = """
    SELECT RETURN_DATE_KEY AS RETURN_DATE, YEAR AS RETURN_YEAR, MONTH_NAME AS RETURN_MONTH, PRODUCT_NAME, CATEGORY_NAME,
           SUBCATEGORY_NAME, REGION, COUNTRY, RETURN_QUANTITY, cast(UNIT_PRICE as double) AS UNIT_PRICE,
           cast(RETURN_REVENUE_IMPACT as double) AS RETURN_REVENUE_IMPACT
    FROM fact_returns r JOIN dim_product p ON r.PRODUCT_KEY = p.PRODUCT_KEY
    JOIN dim_territory t ON r.TERRITORY_KEY = t.TERRITORY_KEY JOIN dim_date ON RETURN_DATE_KEY = DATE_KEY"""


def _blank(column: str) -> str:
    return f"coalesce(trim(cast({column} as varchar)), '') = ''"


def _union(rows: list[str]) -> str:
    return " UNION ALL ".join(rows)


_CUSTOMER_COLUMNS = [
    "CUSTOMERKEY", "PREFIX", "FIRSTNAME", "LASTNAME", "BIRTHDATE", "MARITALSTATUS", "GENDER",
    "EMAILADDRESS", "ANNUALINCOME", "TOTALCHILDREN", "EDUCATIONLEVEL", "OCCUPATION", "HOMEOWNER",
]
_SALES_COLUMNS = (
    "ORDERDATE STOCKDATE ORDERNUMBER PRODUCTKEY CUSTOMERKEY TERRITORYKEY ORDERLINEITEM ORDERQUANTITY SOURCE_FILE"
).split()
_NUMBER = r"(?i)^[+-]?(inf(inity)?|nan|(\d(_?\d)*(\.(\d(_?\d)*)?)?|\.\d(_?\d)*)(e[+-]?\d(_?\d)*)?)$"

_RAW_COLUMNS = {
    "SALES": ("raw_sales", [*_SALES_COLUMNS[:-1], "LOAD_TIMESTAMP", "SOURCE_FILE"]),
    "CUSTOMER": ("raw_customer", _CUSTOMER_COLUMNS),
    "TERRITORY": ("raw_territory", ["SALESTERRITORYKEY", "REGION", "COUNTRY", "CONTINENT"]),
    "CALENDAR": ("raw_calendar", ["DATE"]),
    "RETURNS": ("raw_returns", ["RETURNDATE", "TERRITORYKEY", "PRODUCTKEY", "RETURNQUANTITY"]),
    "PRODUCT_CATEGORY": ("raw_category", ["PRODUCTCATEGORYKEY", "CATEGORYNAME"]),
    "SUBCATEGORY": ("raw_subcategory", ["PRODUCTSUBCATEGORYKEY", "SUBCATEGORYNAME", "PRODUCTCATEGORYKEY"]),
    "PRODUCT": (
        "raw_product",
        ["PRODUCTKEY", "PRODUCTSUBCATEGORYKEY", "PRODUCTSKU", "PRODUCTNAME", "MODELNAME", "PRODUCTDESCRIPTION",
         "PRODUCTCOLOR", "PRODUCTSIZE", "PRODUCTSTYLE", "PRODUCTCOST", "PRODUCTPRICE"],
    ),
    **{
        f"SALES_{year}": (
            f"(SELECT * FROM raw_sales WHERE FILE_YEAR = {year})",
            [*_SALES_COLUMNS[:-1], "LOAD_TIMESTAMP", "SOURCE_FILE"],
        )
        for year in (2020, 2021, 2022)
    },
    "CATEGORY_SALES_UNPIVOT": (
        "raw_category_sales", ["DATE", "PRODUCT_CATEGORY", "NORTH_REGION", "CENTRAL_REGION", "SOUTH_REGION"],
    ),
}


def _summary(name: str) -> str:
    part, columns = _RAW_COLUMNS[name]
    blank = " OR ".join(_blank(c) for c in columns)
    return (
        f"SELECT '{name}' AS FILE_NAME, count(*) AS TOTAL_ROWS, cast({len(columns)} as bigint) AS COLUMN_COUNT, "
        f"coalesce(bool_or({blank}), false) AS HAS_NULLS FROM {part}"
    )


def _duplicates(table: str, source: str, keys: str) -> str:
    return (
        f"SELECT '{table}' AS TABLE_NAME, count(*) AS DUPLICATE_GROUPS FROM "
        f"(SELECT {keys} FROM {source} GROUP BY {keys} HAVING count(*) > 1)"
    )


_EDGES = (
    ("SALES", "raw_sales", "CUSTOMERKEY", "CUSTOMER", "raw_customer", "CUSTOMERKEY"),
    ("SALES", "raw_sales", "PRODUCTKEY", "PRODUCT", "raw_product", "PRODUCTKEY"),
    ("SALES", "raw_sales", "TERRITORYKEY", "TERRITORY", "raw_territory", "SALESTERRITORYKEY"),
    ("SALES", "raw_sales", "ORDERDATE", "CALENDAR", "raw_calendar", "DATE"),
    ("RETURNS", "raw_returns", "PRODUCTKEY", "PRODUCT", "raw_product", "PRODUCTKEY"),
    ("RETURNS", "raw_returns", "TERRITORYKEY", "TERRITORY", "raw_territory", "SALESTERRITORYKEY"),
    ("RETURNS", "raw_returns", "RETURNDATE", "CALENDAR", "raw_calendar", "DATE"),
    ("PRODUCT", "raw_product", "PRODUCTSUBCATEGORYKEY", "SUBCATEGORY", "raw_subcategory", "PRODUCTSUBCATEGORYKEY"),
    ("SUBCATEGORY", "raw_subcategory", "PRODUCTCATEGORYKEY", "PRODUCT_CATEGORY", "raw_category", "PRODUCTCATEGORYKEY"),
)


def _edge(child, source, key, parent, target, target_key) -> str:
    return (
        f"SELECT '{child}.{key} -> {parent}.{target_key}' AS EDGE, count(*) AS ORPHAN_ROWS "
        f"FROM {source} c LEFT JOIN {target} p ON c.{key} = p.{target_key} WHERE p.{target_key} IS NULL"
    )


def _orphan(key: str, dimension: str) -> str:
    return (
        f"SELECT 'Orphaned {key} in FACT_SALES' AS CHECK_NAME, count(*) AS FAILED_ROWS FROM messy_fact f "
        f"LEFT JOIN {dimension} d ON f.{key} = d.{key} WHERE d.{key} IS NULL"
    )


_ORPHANS = [
    _orphan("PRODUCT_KEY", "dim_product"),
    _orphan("CUSTOMER_KEY", "dim_customer"),
    _orphan("TERRITORY_KEY", "dim_territory"),
]
_NEGATIVE = (
    "SELECT 'Negative GROSS_REVENUE in FACT_SALES' AS CHECK_NAME, count(*) AS FAILED_ROWS FROM messy_fact "
    "WHERE GROSS_REVENUE < 0"
)
_NULL_DATE = (
    "SELECT 'NULL ORDER_DATE_KEY in FACT_SALES' AS CHECK_NAME, count(*) AS FAILED_ROWS FROM messy_fact "
    "WHERE ORDER_DATE_KEY IS NULL"
)

_CALENDAR_REQUIRED = [
    ("DATE_KEY", "date"), ("YEAR", "int"), ("MONTH_NUM", "int"), ("MONTH_NAME", "string"), ("DAY_OF_MONTH", "int"),
    ("DAY_OF_WEEK_NAME", "string"), ("DAY_OF_WEEK_NUM", "int"), ("QUARTER_NUM", "int"), ("QUARTER_NAME", "string"),
    ("WEEK_OF_YEAR", "int"), ("IS_WEEKEND", "boolean"), ("FIRST_DAY_OF_MONTH", "date"), ("LAST_DAY_OF_MONTH", "date"),
]

_REQUIRED = {
    "SILVER_CALENDAR": _CALENDAR_REQUIRED,
    "SILVER_TERRITORY": [
        ("TERRITORY_KEY", "bigint"), ("REGION", "string"), ("COUNTRY", "string"), ("CONTINENT", "string"),
    ],
    "SILVER_PRODUCT_CATEGORY": [("CATEGORY_KEY", "bigint"), ("CATEGORY_NAME", "string")],
    "SILVER_PRODUCT": [("PRODUCT_KEY", "bigint")],
    "SILVER_CUSTOMER": [("CUSTOMER_KEY", "bigint")],
    "SILVER_SALES": [("ORDER_NUMBER", "string"), ("ORDER_LINE_ITEM", "bigint")],
    "DIM_DATE": [*_CALENDAR_REQUIRED, ("FISCAL_YEAR", "int"), ("FISCAL_MONTH", "int"), ("FISCAL_QUARTER", "string")],
    "DIM_CUSTOMER": [("CUSTOMER_KEY", "bigint")],
    "DIM_PRODUCT": [("PRODUCT_KEY", "bigint")],
    "DIM_TERRITORY": [("TERRITORY_KEY", "bigint")],
    "FACT_SALES": [("ORDER_NUMBER", "string"), ("ORDER_LINE_ITEM", "bigint")],
}

# The hand-built fact keeps the order key as a number.
_OTHER_TYPE = {("FACT_SALES", "ORDER_NUMBER"): "bigint"}


def _required() -> str:
    return _union(
        [
            f"SELECT '{table}' AS TABLE_NAME, '{column}' AS COLUMN_NAME, '{kind}' AS DECLARED_TYPE, "
            f"'{_OTHER_TYPE.get((table, column), kind)}' AS ACTUAL_TYPE, "
            f"{str((table, column) not in _OTHER_TYPE).lower()} AS TYPE_MATCHES, "
            f"count(*) FILTER (WHERE {column} IS NULL) AS NULL_ROWS FROM {table.lower()}"
            for table, columns in _REQUIRED.items()
            for column, kind in columns
        ]
    )


def _count(label: str, name: str, source: str) -> str:
    return f"SELECT '{name}' AS {label}, count(*) AS ROW_COUNT FROM {source}"


def _content(name: str, columns: str) -> str:
    """Rows, and a sum over hashes of the columns that every engine prints alike."""
    text = ", ".join(f"{column}::VARCHAR" for column in columns.split(","))
    return f"""
        SELECT '{name}' AS TABLE_NAME, count(*) AS ROW_COUNT, '{columns}' AS COLUMNS,
               sum(('0x' || substr(md5(concat_ws('|', {text})), 1, 8))::BIGINT)::BIGINT AS CONTENT FROM {name.lower()}"""


_CLUSTERED = {
    "SILVER_SALES": "CUSTOMER_KEY,DAYS_FROM_STOCK_TO_ORDER,ORDER_DATE,ORDER_LINE_ITEM,ORDER_NUMBER,ORDER_QUANTITY,PRODUCT_KEY,"
    "SALES_YEAR,SOURCE_FILE,STOCK_DATE,TERRITORY_KEY",
    "DIM_DATE": "DATE_KEY,DAY_OF_MONTH,DAY_OF_WEEK_NAME,DAY_OF_WEEK_NUM,FIRST_DAY_OF_MONTH,FISCAL_MONTH,FISCAL_QUARTER,"
    "FISCAL_YEAR,IS_WEEKEND,LAST_DAY_OF_MONTH,MONTH_NAME,MONTH_NUM,QUARTER_NAME,QUARTER_NUM,WEEK_OF_YEAR,YEAR",
    "DIM_CUSTOMER": "AGE,ANNUAL_INCOME,BIRTH_DATE,CUSTOMER_KEY,EDUCATION_LEVEL,EMAIL_ADDRESS,FIRST_NAME,FULL_NAME,GENDER,"
    "INCOME_BAND,IS_HOME_OWNER,LAST_NAME,MARITAL_STATUS,OCCUPATION,PREFIX,TOTAL_CHILDREN",
    "DIM_PRODUCT": "CATEGORY_KEY,CATEGORY_NAME,MODEL_NAME,PRICE_TIER,PRODUCT_COLOR,PRODUCT_DESCRIPTION,PRODUCT_KEY,"
    "PRODUCT_NAME,PRODUCT_SIZE,PRODUCT_SKU,PRODUCT_STYLE,SUBCATEGORY_KEY,SUBCATEGORY_NAME",
    "FACT_SALES": "CUSTOMER_KEY,LEAD_TIME_DAYS,ORDER_DATE_KEY,ORDER_LINE_ITEM,ORDER_NUMBER,ORDER_QUANTITY,PRODUCT_KEY,"
    "SALES_YEAR,STOCK_DATE_KEY,TERRITORY_KEY",
    "FACT_RETURNS": "PRODUCT_KEY,RETURN_DATE_KEY,RETURN_QUANTITY,TERRITORY_KEY",
}


_VIEW_BODIES = {
    "VW_SALES_DETAIL": _DETAIL,
    "VW_MONTHLY_KPI": _MONTHLY_REVENUE,
    "VW_PRODUCT_PERFORMANCE": "SELECT DISTINCT p.PRODUCT_KEY FROM fact_sales f JOIN dim_product p ON f.PRODUCT_KEY = p.PRODUCT_KEY",
    "VW_CUSTOMER_360": "SELECT DISTINCT c.CUSTOMER_KEY FROM fact_sales f JOIN dim_customer c ON f.CUSTOMER_KEY = c.CUSTOMER_KEY",
    "VW_TERRITORY_SUMMARY": "SELECT DISTINCT CONTINENT, COUNTRY, REGION, REGION_CODE FROM fact_sales f JOIN dim_territory t ON f.TERRITORY_KEY = t.TERRITORY_KEY",
    "VW_RETURN_ANALYSIS": _RETURNS_VIEW,
}

_BUILT = [
    "SILVER_CALENDAR", "SILVER_TERRITORY", "SILVER_PRODUCT_CATEGORY", "SILVER_PRODUCT", "SILVER_CUSTOMER", "SILVER_SALES",
    "SILVER_RETURNS", "DIM_DATE", "DIM_CUSTOMER", "DIM_PRODUCT", "DIM_TERRITORY", "FACT_SALES", "FACT_RETURNS",
]

_CSV_CUSTOMER = "SELECT * REPLACE ({}) FROM raw_customer".format(
    ", ".join(
        f"nullif(trim({c}), '') AS {c}" for c in _CUSTOMER_COLUMNS if c not in ("CUSTOMERKEY", "ANNUALINCOME", "TOTALCHILDREN")
    )
)

_GOOD_LINE = "l_orderkey % 31 <> 0 AND l_orderkey % 37 <> 0 AND l_orderkey % 41 <> 0"


def _mask(column: str, analyst: str, other: str, raw: str | None = None) -> str:
    return f"SELECT CUSTOMER_KEY, {column} AS SEEN_BY_PRIVILEGED, {analyst} AS SEEN_BY_ANALYST, {other} AS SEEN_BY_OTHER FROM {raw or 'dim_customer'}"


_A_EMAIL = r"regexp_replace(EMAIL_ADDRESS, '^(.)[^@]*', '\1***')"
_A_NAME = r"regexp_replace(FULL_NAME, '^(\S+) (.).*$', '\1 \2.')"
_O_NAME = r"regexp_replace(FULL_NAME, '^(.)\S* (.).*$', '\1.\2.')"
_A_INCOME = "cast(round(ANNUAL_INCOME, -4) as bigint)"
_A_BIRTH = "cast(date_trunc('year', BIRTH_DATE) as date)"

_SENSITIVITY = (
    ("RESTRICTED", "Dynamic masking + role restriction",
     {"DIM_CUSTOMER": "FIRST_NAME LAST_NAME FULL_NAME BIRTH_DATE EMAIL_ADDRESS ANNUAL_INCOME"}),
    ("CONFIDENTIAL", "Role-based access (Analyst+)",
     {"FACT_SALES": "GROSS_REVENUE GROSS_PROFIT MARGIN_PCT", "DIM_PRODUCT": "GROSS_MARGIN MARGIN_PCT",
      "FACT_RETURNS": "RETURN_REVENUE_IMPACT"}),
    ("PUBLIC", "No restriction",
     {"DIM_TERRITORY": "REGION COUNTRY CONTINENT", "DIM_PRODUCT": "SUBCATEGORY_NAME CATEGORY_NAME"}),
)

_CHART = "cast(REVENUE as double) / 1000000 AS REVENUE_M"
_MEDIAN = "(SELECT cast(round(median(ANNUALINCOME)) as bigint) FROM raw_customer)"
_BY_REVENUE = "ORDER BY REVENUE DESC"

_TOP_PRODUCTS = f"""
        SELECT PRODUCTNAME AS PRODUCT_NAME, CATEGORYNAME AS CATEGORY_NAME, PRICE_TIER,
               cast(sum(ORDERQUANTITY) as bigint) AS UNITS_SOLD, {money("sum(REVENUE)")} AS REVENUE,
               {money("sum(PROFIT)")} AS PROFIT
        FROM report_lines WHERE PRODUCTNAME IS NOT NULL AND CATEGORYNAME IS NOT NULL GROUP BY 1, 2, 3
        ORDER BY 5 DESC, 1, 2, 3 LIMIT 15"""

BODIES = {
    "csv_scan": _CSV_CUSTOMER,
    "csv_format_options": """
        SELECT o_orderkey AS ORDERKEY, o_orderpriority || '; rush' AS PRIORITY,
               CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS CUSTOMERKEY FROM orders""",
    "csv_encoding": """
        SELECT c_custkey AS CUSTOMERKEY, 'José Müller ' || c_custkey AS FIRSTNAME, 'ISO-8859-1' AS ENCODING
        FROM customer""",
    "normalize_columns": """
        SELECT c_custkey AS CUSTOMER_KEY, c_mktsegment AS MARKET_SEGMENT_RAW, c_name AS FULLNAME FROM customer""",
    "audit_columns": """
        SELECT o_orderkey AS ORDERKEY, o_custkey AS CUSTOMERKEY, true AS HAS_LOAD_TIMESTAMP, true AS HAS_SOURCE_FILE
        FROM orders""",
    "full_refresh_load": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "copy_into_tolerant": f"""
        SELECT l_orderkey AS ORDERKEY, cast(l_linenumber as bigint) AS LINE,
               CASE WHEN l_orderkey % 29 <> 0 THEN cast(l_quantity as bigint) END AS QUANTITY, l_returnflag AS FLAG
        FROM lineitem WHERE {_GOOD_LINE}""",
    "copy_into_tolerant_rejects": f"""
        SELECT CASE WHEN l_orderkey % 37 = 0 OR l_orderkey % 41 = 0 THEN 'wrong number of fields'
                    ELSE 'QUANTITY is not bigint' END AS REJECT_REASON, count(*) AS ROW_COUNT
        FROM lineitem WHERE NOT ({_GOOD_LINE}) GROUP BY 1""",
    "load_registry": _union(
        [
            f"SELECT 'BRONZE_{t}' AS TABLE_NAME, 'LOADED' AS STATUS, count(*) AS ROW_COUNT, "
            f"cast(0 as bigint) AS MISFIT_ROWS, cast(0 as bigint) AS REJECTED_ROWS, cast(NULL as varchar) AS ERROR FROM {source}"
            for t, source in (
                ("CUSTOMER", "raw_customer"), ("PRODUCT", "raw_product"), ("PRODUCT_CATEGORY", "raw_category"),
                ("SUBCATEGORY", "raw_subcategory"), ("CALENDAR", "raw_calendar"), ("RETURNS", "raw_returns"),
                ("SALES_2020", "raw_sales WHERE FILE_YEAR = 2020"), ("SALES_2021", "raw_sales WHERE FILE_YEAR = 2021"),
                ("SALES_2022", "raw_sales WHERE FILE_YEAR = 2022"), ("CATEGORY_SALES_UNPIVOT", "raw_category_sales"),
            )
        ]
        + ["SELECT 'BRONZE_TERRITORY', 'SKIPPED', 0, 0, 0, 'file not found'"]
    ),
    "files_to_sales_by_year": f"""
        SELECT YEAR, {_ORDERS} AS TOTAL_ORDERS, {_UNITS} AS TOTAL_UNITS_SOLD, {_REVENUE} AS TOTAL_REVENUE,
               {_PROFIT} AS TOTAL_PROFIT, {_MARGIN} AS AVG_MARGIN_PCT, {_AOV} AS AVG_ORDER_VALUE
        FROM messy_fact JOIN dim_date ON ORDER_DATE_KEY = DATE_KEY GROUP BY YEAR""",
    "row_count_report": _union(
        [_count("TABLE_NAME", t, t.lower()) for t in _BUILT]
        + [_count("TABLE_NAME", "SILVER_CATEGORY_SALES_UNPIVOT", "silver_unpivot")]
    ),
    "ctas_refresh": doubles("fact_sales", *_FACT_DECIMALS),
    "declared_schema": _required(),
    "view_registry": _union([_count("VIEW_NAME", v, f"({body})") for v, body in _VIEW_BODIES.items()]),
    "mv_monthly_revenue": _MONTHLY_REVENUE,
    "source_fallback": _YEARS_SQL,
    "query_to_table": f"""
        SELECT CATEGORY_NAME, count(*) AS LINE_COUNT, {_UNITS} AS UNITS_SOLD, {_REVENUE} AS TOTAL_REVENUE
        FROM fact_sales f JOIN dim_product p ON f.PRODUCT_KEY = p.PRODUCT_KEY GROUP BY CATEGORY_NAME""",
    "report_sink": _union(
        [
            f"SELECT '{name}' AS DATASET, '{fmt}' AS FORMAT, count(*) AS ROW_COUNT, "
            f"cast(sum(cast(REVENUE as decimal(28,2))) as double) AS REVENUE FROM {part}"
            for fmt in ("csv", "json", "parquet")
            for name, part in (
                ("sales_by_year", "by_year"), ("monthly_trend", "by_month"), ("category_revenue", "by_category"),
                ("top_products", f"({_TOP_PRODUCTS})"), ("territory", "by_territory"), ("customer_segment", "by_segment"),
                ("returns", "(SELECT UNITS_RETURNED AS REVENUE FROM returned_by_category)"),
            )
        ]
    ),
    "mapping_table_insert": """
        SELECT 'MANAGER_' || upper(CONTINENT) AS USER_NAME, TERRITORY_KEY FROM dim_territory
        UNION ALL SELECT 'VIEWER_USER', unnest([1, 2, 3])""",
    "point_in_time_read": """
        SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderdate < DATE '1999-01-01'""",
    "retention_filter": _union(
        [
            f"SELECT {day}000000 AS snapshot_ts, '{layer}' AS LAYER, count(*) AS ROW_COUNT FROM orders "
            f"WHERE strftime(o_orderdate, '%Y%m%d') < '{day}'"
            for layer, days in (
                ("BRONZE", (20001222, 20001212, 20001102)), ("SILVER", (20001222, 20001212)), ("GOLD", (20001222,)),
            )
            for day in days
        ]
    ),
    "silver_calendar": "SELECT * FROM silver_calendar",
    "silver_territory": "SELECT * FROM silver_territory",
    "silver_product_category": "SELECT * FROM silver_product_category",
    "silver_product": doubles("silver_product", *_PRODUCT_DECIMALS),
    "silver_customer": "SELECT * FROM silver_customer",
    "silver_sales": "SELECT * FROM silver_sales",
    "silver_returns": "SELECT * FROM silver_returns",
    "silver_unpivot": "SELECT * FROM silver_unpivot",
    "dim_date": "SELECT * FROM dim_date",
    "dim_customer": "SELECT * FROM dim_customer",
    "dim_product": doubles("dim_product", *_PRODUCT_DECIMALS),
    "dim_territory": "SELECT * FROM dim_territory",
    "fact_sales": doubles("fact_sales", *_FACT_DECIMALS),
    "fact_sales_from_silver": doubles("messy_fact", *_FACT_DECIMALS),
    "fact_returns": doubles("fact_returns", "UNIT_PRICE", "RETURN_REVENUE_IMPACT"),
    "vw_sales_detail": _DETAIL,
    "vw_monthly_kpi": f"""
        SELECT YEAR, MONTH_NUM, MONTH_NAME, YEAR || '-' || lpad(cast(MONTH_NUM as varchar), 2, '0') AS YEAR_MONTH,
               {_ORDERS} AS TOTAL_ORDERS, count(ORDER_LINE_ITEM) AS TOTAL_LINE_ITEMS, {_UNITS} AS TOTAL_UNITS,
               {_REVENUE} AS TOTAL_REVENUE, {_COST} AS TOTAL_COST, {_PROFIT} AS TOTAL_PROFIT,
               {_MARGIN} AS AVG_MARGIN_PCT, {_AOV} AS AVG_ORDER_VALUE
        FROM dated GROUP BY 1, 2, 3, 4""",
    "vw_product_performance": _performance(_PAIRS).format(units="double"),
    "vw_product_performance_safe": _performance(_ONCE).format(units="bigint"),
    "vw_customer_360": _C360,
    "vw_territory_summary": f"""
        SELECT CONTINENT, COUNTRY, REGION, REGION_CODE, {_ORDERS} AS TOTAL_ORDERS, {_UNITS} AS TOTAL_UNITS,
               {_REVENUE} AS TOTAL_REVENUE, {_PROFIT} AS TOTAL_PROFIT,
               {pct("sum(GROSS_REVENUE)", "sum(sum(GROSS_REVENUE)) OVER ()")} AS REVENUE_SHARE_PCT
        FROM fact_sales f JOIN dim_territory t ON f.TERRITORY_KEY = t.TERRITORY_KEY GROUP BY 1, 2, 3, 4""",
    "vw_return_analysis": _RETURNS_VIEW,
    "q01_sales_by_year": f"""
        SELECT YEAR, {_ORDERS} AS TOTAL_ORDERS, {_UNITS} AS TOTAL_UNITS_SOLD, {_REVENUE} AS TOTAL_REVENUE,
               {_PROFIT} AS TOTAL_PROFIT, {_MARGIN} AS AVG_MARGIN_PCT, {_AOV} AS AVG_ORDER_VALUE
        FROM dated GROUP BY YEAR""",
    "q02_monthly_trend_mom": f"""
        SELECT YEAR, MONTH_NUM, MONTH_NAME, {_REVENUE} AS MONTHLY_REVENUE, {_PROFIT} AS MONTHLY_PROFIT,
               cast(lag(sum(GROSS_REVENUE)) OVER (ORDER BY YEAR, MONTH_NUM) as double) AS PREV_MONTH_REVENUE,
               {pct("sum(GROSS_REVENUE) - lag(sum(GROSS_REVENUE)) OVER (ORDER BY YEAR, MONTH_NUM)",
                    "lag(sum(GROSS_REVENUE)) OVER (ORDER BY YEAR, MONTH_NUM)")} AS MOM_GROWTH_PCT
        FROM dated GROUP BY YEAR, MONTH_NUM, MONTH_NAME""",
    "q03_category_subcategory": f"""
        SELECT CATEGORY_NAME, SUBCATEGORY_NAME, {_ORDERS} AS TOTAL_ORDERS, {_UNITS} AS UNITS_SOLD,
               {_REVENUE} AS TOTAL_REVENUE, {_PROFIT} AS TOTAL_PROFIT, {mean2("f.MARGIN_PCT")} AS AVG_MARGIN_PCT
        FROM fact_sales f JOIN dim_product p ON f.PRODUCT_KEY = p.PRODUCT_KEY GROUP BY 1, 2""",
    "q04_top10_products": f"""
        SELECT p.PRODUCT_KEY, PRODUCT_NAME, CATEGORY_NAME, PRICE_TIER, {_UNITS} AS UNITS_SOLD,
               {_REVENUE} AS TOTAL_REVENUE, {_PROFIT} AS TOTAL_PROFIT
        FROM fact_sales f JOIN dim_product p ON f.PRODUCT_KEY = p.PRODUCT_KEY GROUP BY 1, 2, 3, 4
        ORDER BY UNITS_SOLD DESC, PRODUCT_KEY LIMIT 10""",
    "q05_customer_segments": f"""
        SELECT INCOME_BAND, OCCUPATION, GENDER, MARITAL_STATUS, count(DISTINCT c.CUSTOMER_KEY) AS CUSTOMER_COUNT,
               {_ORDERS} AS TOTAL_ORDERS, {_REVENUE} AS TOTAL_REVENUE,
               {ratio2("sum(GROSS_REVENUE)", "count(DISTINCT c.CUSTOMER_KEY)")} AS REVENUE_PER_CUSTOMER
        FROM fact_sales f JOIN dim_customer c ON f.CUSTOMER_KEY = c.CUSTOMER_KEY GROUP BY 1, 2, 3, 4""",
    "q06_geo_share": f"""
        SELECT CONTINENT, COUNTRY, REGION, {_ORDERS} AS TOTAL_ORDERS, {_REVENUE} AS TOTAL_REVENUE,
               {_PROFIT} AS TOTAL_PROFIT,
               {pct("sum(GROSS_REVENUE)", "sum(sum(GROSS_REVENUE)) OVER ()")} AS REVENUE_SHARE_PCT
        FROM fact_sales f JOIN dim_territory t ON f.TERRITORY_KEY = t.TERRITORY_KEY GROUP BY 1, 2, 3""",
    "q07_return_rate": _return_rate(_PAIRS, "double"),
    "q07_return_rate_safe": _return_rate(_ONCE, "bigint"),
    "q08_quarterly_yoy": f"""
        SELECT YEAR, QUARTER_NAME, cast(REV as double) AS QUARTERLY_REVENUE, cast(PREV as double) AS PREV_YEAR_REVENUE,
               {pct("REV - PREV", "PREV")} AS YOY_GROWTH_PCT
        FROM (SELECT *, lag(REV) OVER (PARTITION BY QUARTER_NUM ORDER BY YEAR) AS PREV FROM (
            SELECT YEAR, QUARTER_NAME, QUARTER_NUM, round(sum(GROSS_REVENUE), 2) AS REV FROM dated GROUP BY 1, 2, 3))""",
    "q09_clv_top20": f"""
        SELECT c.CUSTOMER_KEY, FULL_NAME, OCCUPATION, INCOME_BAND, min(ORDER_DATE_KEY) AS FIRST_ORDER_DATE,
               max(ORDER_DATE_KEY) AS LAST_ORDER_DATE, {_ORDERS} AS TOTAL_ORDERS, {_UNITS} AS TOTAL_UNITS,
               {_REVENUE} AS LIFETIME_REVENUE, {_PROFIT} AS LIFETIME_PROFIT, {_AOV} AS AVG_ORDER_VALUE
        FROM fact_sales f JOIN dim_customer c ON f.CUSTOMER_KEY = c.CUSTOMER_KEY GROUP BY 1, 2, 3, 4
        ORDER BY LIFETIME_REVENUE DESC, CUSTOMER_KEY LIMIT 20""",
    "q10_pivot_regions": """
        SELECT SALE_DATE, PRODUCT_CATEGORY,
               cast(sum(CASE WHEN REGION = 'North' THEN SALES_AMOUNT ELSE 0 END) as bigint) AS NORTH,
               cast(sum(CASE WHEN REGION = 'Central' THEN SALES_AMOUNT ELSE 0 END) as bigint) AS CENTRAL,
               cast(sum(CASE WHEN REGION = 'South' THEN SALES_AMOUNT ELSE 0 END) as bigint) AS SOUTH,
               cast(sum(SALES_AMOUNT) as bigint) AS TOTAL
        FROM silver_unpivot GROUP BY 1, 2""",
    "q11_weekend_weekday": f"""
        SELECT IS_WEEKEND, CASE WHEN IS_WEEKEND THEN 'Weekend' ELSE 'Weekday' END AS DAY_TYPE,
               {_ORDERS} AS TOTAL_ORDERS, {_REVENUE} AS TOTAL_REVENUE, {mean2("GROSS_REVENUE")} AS AVG_ORDER_REVENUE
        FROM dated GROUP BY 1, 2""",
    "q12_running_ytd": f"""
        SELECT YEAR, MONTH_NUM, MONTH_NAME, {_REVENUE} AS MONTHLY_REVENUE,
               {money("sum(sum(GROSS_REVENUE)) OVER (PARTITION BY YEAR ORDER BY MONTH_NUM ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")}
                   AS YTD_REVENUE
        FROM dated GROUP BY 1, 2, 3""",
    "q13_price_tier_mix": f"""
        SELECT {banded("PRODUCT_PRICE", ("50", "01_Budget (<$50)"), ("200", "02_Mid-Range ($50-$199)"),
                       ("500", "03_Premium ($200-$499)"), "04_Luxury ($500+)")} AS PRICE_TIER,
               {_ORDERS} AS TOTAL_ORDERS, {_UNITS} AS TOTAL_UNITS, {_REVENUE} AS TOTAL_REVENUE,
               {pct("sum(GROSS_REVENUE)", "sum(sum(GROSS_REVENUE)) OVER ()")} AS REVENUE_PCT
        FROM fact_sales f JOIN dim_product p ON f.PRODUCT_KEY = p.PRODUCT_KEY GROUP BY 1""",
    "q14_fiscal_quarter": f"""
        SELECT YEAR || '-Q' || ((MONTH_NUM + 5) % 12 // 3 + 1) AS FISCAL_QUARTER,
               cast(year(make_date(YEAR, MONTH_NUM, 1) - INTERVAL 6 MONTH) as integer) AS FISCAL_YEAR,
               {_REVENUE} AS REVENUE, {_COST} AS COST,
               {money("sum(GROSS_REVENUE) - sum(TOTAL_COST)")} AS GROSS_PROFIT,
               {pct("sum(GROSS_REVENUE) - sum(TOTAL_COST)", "sum(GROSS_REVENUE)")} AS MARGIN_PCT
        FROM dated GROUP BY 1, 2""",
    "q15_age_bands": f"""
        SELECT {banded(f"date_diff('year', BIRTH_DATE, {AS_OF})", ("30", "18-29"), ("40", "30-39"), ("50", "40-49"),
                       ("60", "50-59"), "60+")} AS AGE_BAND,
               count(DISTINCT c.CUSTOMER_KEY) AS CUSTOMERS, {_ORDERS} AS TOTAL_ORDERS, {_REVENUE} AS TOTAL_REVENUE,
               {mean2("GROSS_REVENUE")} AS AVG_ORDER_VALUE,
               {ratio2("sum(GROSS_REVENUE)", "count(DISTINCT c.CUSTOMER_KEY)")} AS REVENUE_PER_CUSTOMER
        FROM fact_sales f JOIN dim_customer c ON f.CUSTOMER_KEY = c.CUSTOMER_KEY
        WHERE BIRTH_DATE IS NOT NULL GROUP BY 1""",
    "rpt_enrich": f"""
        SELECT * EXCLUDE (LINE_MARGIN) REPLACE ({", ".join(f"cast({c} as double) AS {c}" for c in _REPORT_DECIMALS)}),
               cast(cast(LINE_MARGIN as decimal(28,10)) as double) AS MARGIN
        FROM report_lines""",
    "rpt_sales_by_year": "SELECT * FROM by_year",
    "rpt_sales_by_year_sql": _YEARS_SQL,
    "rpt_monthly_trend": "SELECT * FROM by_month",
    "rpt_monthly_trend_sql": f"""
        SELECT YEAR, MONTH_NUM, MONTH_NAME, {_REVENUE} AS REVENUE, {_PROFIT} AS PROFIT FROM dated GROUP BY 1, 2, 3""",
    "rpt_category_revenue": "SELECT * FROM by_category",
    "rpt_category_revenue_sql": f"""
        SELECT CATEGORY_NAME, {_UNITS} AS UNITS_SOLD, {_REVENUE} AS REVENUE, {_PROFIT} AS PROFIT,
               {mean2("f.MARGIN_PCT")} AS MARGIN_PCT
        FROM fact_sales f JOIN dim_product p ON f.PRODUCT_KEY = p.PRODUCT_KEY GROUP BY 1""",
    "rpt_top_products": _TOP_PRODUCTS,
    "rpt_top_products_sql": f"""
        SELECT PRODUCT_NAME, CATEGORY_NAME, PRICE_TIER, {_UNITS} AS UNITS_SOLD, {_REVENUE} AS REVENUE, {_PROFIT} AS PROFIT
        FROM fact_sales f JOIN dim_product p ON f.PRODUCT_KEY = p.PRODUCT_KEY GROUP BY 1, 2, 3
        ORDER BY 5 DESC, 1, 2, 3 LIMIT 15""",
    "rpt_territory": "SELECT * FROM by_territory",
    "rpt_territory_sql": f"""
        SELECT COUNTRY, REGION, {_ORDERS} AS ORDERS, {_REVENUE} AS REVENUE, {_PROFIT} AS PROFIT
        FROM fact_sales f JOIN dim_territory t ON f.TERRITORY_KEY = t.TERRITORY_KEY GROUP BY 1, 2""",
    "rpt_customer_segment": "SELECT * FROM by_segment",
    "rpt_customer_segment_sql": f"""
        SELECT INCOME_BAND, OCCUPATION, GENDER, count(DISTINCT c.CUSTOMER_KEY) AS CUSTOMERS, {_REVENUE} AS REVENUE,
               {ratio2("sum(GROSS_REVENUE)", "count(DISTINCT c.CUSTOMER_KEY)")} AS REV_PER_CUST
        FROM fact_sales f JOIN dim_customer c ON f.CUSTOMER_KEY = c.CUSTOMER_KEY GROUP BY 1, 2, 3""",
    "rpt_returns": "SELECT * FROM returned_by_category",
    "rpt_returns_sql": f"""
        SELECT CATEGORY_NAME, cast(sum(RETURN_QUANTITY) as double) AS UNITS_RETURNED,
               cast(coalesce(sum(ORDER_QUANTITY), 0) as double) AS UNITS_SOLD,
               {pct("sum(RETURN_QUANTITY)", "sum(ORDER_QUANTITY)")} AS RETURN_RATE_PCT
        FROM fact_returns r JOIN dim_product p ON r.PRODUCT_KEY = p.PRODUCT_KEY
        LEFT JOIN fact_sales f ON f.PRODUCT_KEY = r.PRODUCT_KEY GROUP BY 1""",
    "rpt_kpis": f"""
        SELECT cast(sum(cast(REVENUE as decimal(28,2))) as double) AS TOTAL_REVENUE,
               cast(sum(cast(PROFIT as decimal(28,2))) as double) AS TOTAL_PROFIT,
               cast(sum(ORDERS) as bigint) AS TOTAL_ORDERS,
               {pct("sum(cast(PROFIT as decimal(28,2)))", "sum(cast(REVENUE as decimal(28,2)))")} AS AVG_MARGIN,
               (SELECT CATEGORY_NAME FROM by_category ORDER BY REVENUE DESC, CATEGORY_NAME LIMIT 1) AS TOP_CATEGORY,
               (SELECT COUNTRY FROM by_territory ORDER BY REVENUE DESC, COUNTRY, REGION LIMIT 1) AS TOP_COUNTRY,
               string_agg(cast(YEAR as varchar), ',' ORDER BY YEAR) AS YEARS
        FROM by_year""",
    "fmt_money": f"""
        SELECT CUSTOMER_KEY, REVENUE,
               CASE WHEN REVENUE >= 1000000 THEN '$' || format('{{:.1f}}', REVENUE / 1000000) || 'M'
                    WHEN REVENUE >= 1000 THEN '$' || format('{{:.0f}}', REVENUE / 1000) || 'K'
                    ELSE '$' || format('{{:.0f}}', REVENUE) END AS LABEL
        FROM (SELECT CUSTOMER_KEY, cast(sum(GROSS_REVENUE) as double) AS REVENUE FROM fact_sales GROUP BY CUSTOMER_KEY)""",
    "report_slices": """
        (SELECT 'months' AS SLICE, YEAR || '-' || MONTH_NUM AS LABEL, REVENUE FROM by_month
         ORDER BY YEAR, MONTH_NUM LIMIT 36)
        UNION ALL (SELECT 'segments_20', OCCUPATION || '/' || GENDER, REVENUE FROM by_segment
                   ORDER BY REVENUE DESC, OCCUPATION, GENDER LIMIT 20)
        UNION ALL (SELECT 'segments_15', OCCUPATION || '/' || GENDER, REVENUE FROM by_segment
                   ORDER BY REVENUE DESC, OCCUPATION, GENDER LIMIT 15)""",
    "chart_revenue_by_year": f"SELECT YEAR, {_CHART} FROM by_year",
    "chart_monthly_by_year": f"SELECT YEAR, MONTH_NUM, {_CHART} FROM by_month",
    "chart_category_top8": f"SELECT CATEGORY_NAME, {_CHART} FROM by_category {_BY_REVENUE}, CATEGORY_NAME LIMIT 8",
    "chart_category_share": f"""
        SELECT CATEGORY_NAME, {pct("REVENUE", "sum(cast(REVENUE as decimal(28,2))) OVER ()")} AS SHARE_PCT
        FROM (SELECT * FROM by_category {_BY_REVENUE}, CATEGORY_NAME LIMIT 6)""",
    "chart_territory_top8": f"SELECT COUNTRY, {_CHART} FROM by_territory {_BY_REVENUE}, COUNTRY, REGION LIMIT 8",
    "chart_occupation": f"""
        SELECT OCCUPATION, {_CHART} FROM (
            SELECT OCCUPATION, sum(cast(REVENUE as decimal(28,2))) AS REVENUE FROM by_segment GROUP BY 1)""",
    "chart_gender_share": f"""
        SELECT GENDER, {pct("REVENUE", "sum(REVENUE) OVER ()")} AS SHARE_PCT FROM (
            SELECT GENDER, sum(cast(REVENUE as decimal(28,2))) AS REVENUE FROM by_segment GROUP BY 1)""",
    "chart_returns_top8": """
        SELECT CATEGORY_NAME, UNITS_RETURNED FROM returned_by_category ORDER BY UNITS_RETURNED DESC, 1 LIMIT 8""",
    "profile_nulls": _union(
        [
            f"SELECT '{c}' AS COLUMN_NAME, count(*) AS TOTAL_ROWS, count(*) FILTER (WHERE {_blank(c)}) AS NULL_COUNT, "
            f"coalesce({pct(f'count(*) FILTER (WHERE {_blank(c)})', 'count(*)')}, 0) AS NULL_PCT FROM raw_customer"
            for c in _CUSTOMER_COLUMNS
        ]
    ),
    "profile_numeric_hint": _union(
        [
            f"SELECT '{c}' AS COLUMN_NAME, coalesce(bool_and({_blank(c)} OR "
            f"regexp_matches(trim(cast({c} as varchar)), '{_NUMBER}')), true) AS IS_NUMERIC FROM raw_sales"
            for c in _SALES_COLUMNS
        ]
    ),
    "profile_sample": "SELECT * FROM raw_customer ORDER BY CUSTOMERKEY LIMIT 3",
    "profile_summary": _union([_summary(n) for n in _RAW_COLUMNS]),
    "profile_table": _union(
        [
            f"SELECT '{name}' AS TABLE_NAME, count(*) AS ROW_COUNT, '{','.join(columns)}' AS COLUMN_LIST FROM {part}"
            for name, (part, columns) in _RAW_COLUMNS.items()
        ]
    ),
    "detect_duplicates": _union(
        [
            _duplicates(f"BRONZE_SALES_{y}", f"(SELECT * FROM raw_sales WHERE FILE_YEAR = {y})", "ORDERNUMBER, ORDERLINEITEM")
            for y in (2020, 2021, 2022)
        ]
        + [
            _duplicates("BRONZE_CUSTOMER", "raw_customer", "CUSTOMERKEY"),
            _duplicates("BRONZE_TERRITORY", "raw_territory", "SALESTERRITORYKEY"),
            _duplicates("BRONZE_RETURNS", "raw_returns", "RETURNDATE, PRODUCTKEY, TERRITORYKEY"),
            _duplicates("BRONZE_PRODUCT", "raw_product", "PRODUCTKEY"),
            _duplicates("BRONZE_CALENDAR", "raw_calendar", "DATE"),
            _duplicates("BRONZE_PRODUCT_CATEGORY", "raw_category", "PRODUCTCATEGORYKEY"),
            _duplicates("BRONZE_SUBCATEGORY", "raw_subcategory", "PRODUCTSUBCATEGORYKEY"),
            "SELECT 'BRONZE_CATEGORY_SALES_UNPIVOT', cast(NULL as bigint)",
        ]
    ),
    "fk_relationship_check": _union([_edge(*e) for e in _EDGES]),
    "dq_orphans": _union(_ORPHANS),
    "dq_negative_revenue": _NEGATIVE,
    "dq_null_order_date": _NULL_DATE,
    "dq_report": f"""
        SELECT *, CASE WHEN FAILED_ROWS = 0 THEN 'PASS' ELSE 'WARN' END AS STATUS,
               bool_and(FAILED_ROWS = 0) OVER () AS ALL_PASSED
        FROM ({_union([*_ORPHANS, _NEGATIVE, _NULL_DATE])})""",
    "row_count_reconcile": """
        SELECT 'SALES' AS TABLE_NAME, s AS SOURCE_ROWS, l AS LOADED_ROWS, l - s AS DIFFERENCE
        FROM (SELECT count(*) AS s FROM raw_sales), (SELECT count(*) AS l FROM silver_sales)
        UNION ALL SELECT 'RETURNS', s, l, l - s
        FROM (SELECT count(*) AS s FROM raw_returns), (SELECT count(*) AS l FROM silver_returns)
        UNION ALL SELECT 'CUSTOMER', count(*), count(*), 0 FROM raw_customer
        UNION ALL SELECT 'CALENDAR', count(*), count(*), 0 FROM raw_calendar
        UNION ALL SELECT 'PRODUCT_CATEGORY', count(*), NULL, NULL FROM raw_category
        UNION ALL SELECT 'TERRITORY', NULL, count(*), NULL FROM dim_territory
        UNION ALL SELECT 'PRODUCT', s, l, l - s
        FROM (SELECT count(*) AS s FROM raw_product), (SELECT count(*) AS l FROM silver_product)
        UNION ALL SELECT 'SUBCATEGORY', count(*), NULL, NULL FROM raw_subcategory
        UNION ALL SELECT 'CATEGORY_SALES_UNPIVOT', s, l, l - s
        FROM (SELECT count(*) AS s FROM raw_category_sales), (SELECT count(*) AS l FROM silver_unpivot)""",
    "dq001_income_impute": f"""
        SELECT CUSTOMERKEY, coalesce(ANNUALINCOME, {_MEDIAN}) AS ANNUALINCOME,
               CASE WHEN ANNUALINCOME IS NULL THEN 'Unknown' ELSE {banded("ANNUALINCOME", *INCOME)} END AS INCOME_BAND
        FROM raw_customer""",
    "dq002_multi_format_date": f"""
        SELECT ORDERNUMBER, ORDERLINEITEM, ORDERDATE,
               coalesce({iso_date("ORDERDATE")}, cast(try_strptime(ORDERDATE, '%m/%d/%Y') as date)) AS ORDER_DATE
        FROM raw_sales""",
    "dq003_margin_flag": """
        SELECT PRODUCT_KEY, cast(MARGIN_PCT as double) AS MARGIN_PCT,
               CASE WHEN PRODUCT_COST > PRODUCT_PRICE THEN 'NEGATIVE' END AS MARGIN_FLAG FROM dim_product""",
    "dq003_category_margins": f"""
        SELECT CATEGORY_NAME, count(*) AS PRODUCTS,
               count(*) FILTER (WHERE PRODUCT_COST > PRODUCT_PRICE) AS NEGATIVE_PRODUCTS,
               {mean2("CASE WHEN PRODUCT_COST <= PRODUCT_PRICE THEN MARGIN_PCT END")} AS AVG_MARGIN_PCT,
               {mean2("MARGIN_PCT")} AS AVG_MARGIN_PCT_ALL
        FROM dim_product GROUP BY 1""",
    "dq004_unknown_product": """
        SELECT r.*, coalesce(PRODUCT_NAME, 'UNKNOWN') AS PRODUCT_NAME
        FROM silver_returns r LEFT JOIN dim_product p ON r.PRODUCT_KEY = p.PRODUCT_KEY""",
    "dq005_dedup_order_lines": """
        SELECT * EXCLUDE (FILE_YEAR) FROM raw_sales QUALIFY row_number() OVER (
            PARTITION BY ORDERNUMBER, ORDERLINEITEM
            ORDER BY LOAD_TIMESTAMP DESC NULLS LAST, ORDERDATE DESC NULLS LAST, STOCKDATE DESC NULLS LAST,
                     PRODUCTKEY DESC NULLS LAST, CUSTOMERKEY DESC NULLS LAST, TERRITORYKEY DESC NULLS LAST,
                     ORDERQUANTITY DESC NULLS LAST, SOURCE_FILE DESC NULLS LAST) = 1""",
    "dq006_gender_normalize": """
        SELECT CUSTOMERKEY, CASE WHEN upper(GENDER) IN ('M', 'MALE') THEN 'Male'
                                 WHEN upper(GENDER) IN ('F', 'FEMALE') THEN 'Female' ELSE 'Unknown' END AS GENDER
        FROM raw_customer""",
    "dq007_region_fill": f"""
        SELECT * REPLACE (CASE WHEN {_blank("REGION")} THEN
            CASE SALESTERRITORYKEY WHEN 10 THEN 'Region Ten' WHEN 11 THEN 'Region Eleven' END ELSE REGION END AS REGION)
        FROM raw_territory""",
    "mask_email": _mask("EMAIL_ADDRESS", _A_EMAIL, "'***@***.com'"),
    "mask_full_name": _mask("FULL_NAME", _A_NAME, _O_NAME),
    "mask_income": _mask("ANNUAL_INCOME", _A_INCOME, "cast(0 as bigint)"),
    "mask_birth_date": _mask("BIRTH_DATE", _A_BIRTH, "cast(NULL as date)"),
    "mask_phone": _mask(
        "PHONE", "'***-***-' || right(PHONE, 4)", "'***-***-****'",
        "(SELECT c_custkey AS CUSTOMER_KEY, printf('555-%03d-%04d', c_custkey % 1000, c_custkey * 7 % 10000) AS PHONE FROM customer)",
    ),
    "masked_dim_customer": f"""
        SELECT * REPLACE ({_A_EMAIL} AS EMAIL_ADDRESS, {_A_NAME} AS FULL_NAME, {_A_INCOME} AS ANNUAL_INCOME,
                          {_A_BIRTH} AS BIRTH_DATE) FROM dim_customer""",
    "masked_dim_customer_other": f"""
        SELECT * REPLACE ('***@***.com' AS EMAIL_ADDRESS, {_O_NAME} AS FULL_NAME, cast(0 as bigint) AS ANNUAL_INCOME,
                          cast(NULL as date) AS BIRTH_DATE) FROM dim_customer""",
    "masked_silver_customer": "SELECT * REPLACE ('***@***.com' AS EMAIL_ADDRESS) FROM silver_customer",
    "masked_income_grouping": f"""
        SELECT {_A_INCOME} AS ANNUAL_INCOME, count(*) AS CUSTOMERS FROM dim_customer GROUP BY 1""",
    "row_access_territory": """
        SELECT ORDER_NUMBER, ORDER_LINE_ITEM, TERRITORY_KEY, cast(GROSS_REVENUE as double) AS GROSS_REVENUE
        FROM fact_sales WHERE TERRITORY_KEY IN (1, 2, 3)""",
    "row_access_by_role": """
        SELECT 'DATA_ENGINEER_ROLE' AS ROLE_NAME, 'E' AS USER_NAME, count(*) AS VISIBLE_ROWS FROM sales_lines
        UNION ALL SELECT 'ANALYST_ROLE', 'A', count(*) FROM sales_lines
        UNION ALL SELECT 'VIEWER_ROLE', 'VIEWER_USER', count(*) FROM sales_lines WHERE TERRITORY_KEY IN (1, 2, 3)
        UNION ALL SELECT 'VIEWER_ROLE', 'NOBODY', count(*) FROM sales_lines WHERE false""",
    "pii_inventory": _union(
        [
            f"SELECT '{t}' AS TABLE_NAME, '{c}' AS COLUMN_NAME, '{category}' AS PII_CATEGORY, {policy} AS POLICY, "
            "'RESTRICTED' AS SENSITIVITY, 'Dynamic masking + role restriction' AS REQUIRED_ACTION, "
            f"count(*) FILTER (WHERE NOT ({_blank(c)})) AS FILLED_ROWS FROM {source}"
            for t, source, c, category, policy in [
                (t, t.lower(), c, category, f"'MASK_{c}'")
                for t in ("SILVER_CUSTOMER", "DIM_CUSTOMER")
                for c, category in (
                    ("EMAIL_ADDRESS", "Contact info"), ("FULL_NAME", "Identity"), ("ANNUAL_INCOME", "Financial"),
                    ("BIRTH_DATE", "Demographic"),
                )
            ]
            + [("BRONZE_CUSTOMER", "raw_customer", "EMAILADDRESS", "Contact info", "cast(NULL as varchar)")]
        ]
    ),
    "column_sensitivity": _union(
        [
            f"SELECT '{t}' AS TABLE_NAME, '{c}' AS COLUMN_NAME, '{level}' AS SENSITIVITY, '{action}' AS REQUIRED_ACTION, "
            f"count(*) FILTER (WHERE NOT ({_blank(c)})) AS FILLED_ROWS FROM {t.lower()}"
            for level, action, tables in _SENSITIVITY
            for t, columns in tables.items()
            for c in columns.split()
        ]
    ),
    "clustered_write": doubles("fact_sales", *_FACT_DECIMALS),
    "clustered_tables": _union([_content(name, columns) for name, columns in _CLUSTERED.items()]),
    "clustering_report": """
        SELECT count(*) AS ROW_COUNT, min(ORDER_DATE_KEY) AS MIN_KEY, max(ORDER_DATE_KEY) AS MAX_KEY, true AS COUNTED
        FROM fact_sales""",
    "point_lookup_customer_name": "SELECT * FROM dim_customer WHERE FULL_NAME = 'Customer 000000007'",
    "point_lookup_product_name": f"""
        {doubles('dim_product', *_PRODUCT_DECIMALS)} WHERE PRODUCT_NAME = (SELECT min(PRODUCT_NAME) FROM dim_product)""",
    "point_lookup": f"{doubles('fact_sales', *_FACT_DECIMALS)} WHERE ORDER_NUMBER = 42",
    "point_lookup_customer": "SELECT * FROM dim_customer WHERE EMAIL_ADDRESS = 'customer000000007@example.com'",
    "point_lookup_product": f"{doubles('dim_product', *_PRODUCT_DECIMALS)} WHERE PRODUCT_SKU = 'SKU-11'",
    "top_expensive_queries": """
        SELECT QUERY_ID, left(QUERY_TEXT, 80) AS QUERY_SNIPPET, TOTAL_ELAPSED_TIME / 1000 AS ELAPSED_SEC,
               BYTES_SCANNED / 1e9 AS GB_SCANNED, cast(CREDITS_USED_CLOUD_SERVICES as double) AS CREDITS_USED_CLOUD_SERVICES,
               WAREHOUSE_NAME, START_TIME
        FROM query_log WHERE START_TIME >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY AND EXECUTION_STATUS = 'SUCCESS'
        ORDER BY TOTAL_ELAPSED_TIME DESC NULLS FIRST, QUERY_ID LIMIT 10""",
    "usage_by_group": """
        SELECT WAREHOUSE_NAME, cast(sum(CREDITS_USED) as double) AS TOTAL_CREDITS,
               cast(sum(CREDITS_USED_COMPUTE) as double) AS COMPUTE_CREDITS
        FROM query_log WHERE START_TIME >= TIMESTAMP '2024-02-15' - INTERVAL 1 MONTH GROUP BY 1""",
}

ORACLES = {name: statement(body) for name, body in BODIES.items()}
