"""Section J: scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..sources.testtables import AS_OF
from .registry import query


@query(
    "j1_currency_strip",
    "SELECT Price, TRY_CAST(regexp_replace(Price, '[^0-9.]', '', 'g') AS DECIMAL(10,2)) AS amount FROM raw_sales",
)
def _(lay):
    return lay.raw_sales.select("Price", fn.money(F.col("Price")).alias("amount"))


@query(
    "j2_decimal_comma",
    "SELECT Price, TRY_CAST(nullif(regexp_replace(Price, '[^0-9.]', '', 'g'), '') AS DOUBLE) AS amount FROM raw_sales",
)
def _(lay):
    with_comma = F.translate("Price", ".", ",")
    return lay.raw_sales.select(
        "Price", fn.money(with_comma, decimal_comma=True, as_type="double").alias("amount")
    )


@query(
    "j3_date_separator",
    "SELECT PurchaseDate, CAST(try_strptime(PurchaseDate, '%Y-%m-%d') AS DATE) AS day FROM raw_sales",
)
def _(lay):
    slashed = F.translate("PurchaseDate", "-", "/")
    return lay.raw_sales.select("PurchaseDate", fn.day_lenient(slashed).alias("day"))


@query(
    "j4_trim",
    """SELECT Email, Email AS trimmed, concat(Email, '  ') AS left_trimmed, concat('  ', Email) AS right_trimmed
       FROM raw_customers""",
)
def _(lay):
    padded = F.concat(F.lit("  "), "Email", F.lit("  "))
    return lay.raw_customers.select(
        "Email",
        F.trim(padded).alias("trimmed"),
        F.ltrim(padded).alias("left_trimmed"),
        F.rtrim(padded).alias("right_trimmed"),
    )


@query(
    "j5_letter_case",
    """SELECT lower(Product) AS low, upper(Product) AS up,
              concat(upper(left(Product, 1)), lower(substr(Product, 2))) AS title FROM raw_sales""",
)
def _(lay):
    return lay.raw_sales.select(
        F.lower("Product").alias("low"), F.upper("Product").alias("up"), F.initcap("Product").alias("title")
    )


@query("j6_replace_token", "SELECT CustomerId, replace(CustomerId, 'N/A', '') AS cleaned FROM raw_sales")
def _(lay):
    return lay.raw_sales.select("CustomerId", fn.without_token(F.col("CustomerId"), "N/A").alias("cleaned"))


@query(
    "j7_split",
    """SELECT PurchaseDate, split_part(PurchaseDate, '-', 1) AS first_part,
              nullif(split_part(PurchaseDate, '-', 3), '') AS third_part FROM raw_sales""",
)
def _(lay):
    parts = F.split("PurchaseDate", "-")
    return lay.raw_sales.select(
        "PurchaseDate",
        F.get(parts, F.lit(0)).alias("first_part"),
        F.get(parts, F.lit(2)).alias("third_part"),
    )


@query("j8_name_split", "SELECT email, first_name, last_name FROM silver_profiles")
def _(lay):
    name = F.col("full_name")
    return lay.raw_profiles.select(
        "email", fn.first_name_of(name).alias("first_name"), fn.last_name_of(name).alias("last_name")
    )


@query(
    "j9_normalise_date_with_time",
    """SELECT PurchaseDate, strftime(try_strptime(PurchaseDate, '%Y-%m-%d'), '%Y-%m-%d') AS day_text,
              CAST(try_strptime(PurchaseDate, '%Y-%m-%d') AS DATE) AS day FROM raw_sales""",
)
def _(lay):
    stamped = F.concat(F.lit(" "), "PurchaseDate", F.lit("T12:34:56"))
    return lay.raw_sales.select(
        "PurchaseDate",
        fn.day_text(stamped, time_part=True).alias("day_text"),
        fn.day_normalised(stamped, time_part=True).alias("day"),
    )


@query(
    "j10_normalise_date",
    """SELECT RegistrationDate, strftime(try_strptime(RegistrationDate, '%Y-%m-%d'), '%Y-%m-%d') AS day_text,
              CAST(try_strptime(RegistrationDate, '%Y-%m-%d') AS DATE) AS day FROM raw_customers""",
)
def _(lay):
    text = F.col("RegistrationDate")
    return lay.raw_customers.select(
        "RegistrationDate", fn.day_text(text).alias("day_text"), fn.day_normalised(text).alias("day")
    )


@query(
    "j11_regexp_extract",
    r"""SELECT PurchaseDate, regexp_extract(PurchaseDate, '^(\d{4})-', 1) AS year_text,
               regexp_extract(PurchaseDate, '^\d{4}-(\d{1,2})-', 1) AS month_text FROM raw_sales""",
)
def _(lay):
    return lay.raw_sales.select(
        "PurchaseDate",
        F.regexp_extract("PurchaseDate", r"^(\d{4})-", 1).alias("year_text"),
        F.regexp_extract("PurchaseDate", r"^\d{4}-(\d{1,2})-", 1).alias("month_text"),
    )


@query(
    "j12_pad_and_concat",
    """SELECT Id, lpad(Id, 8, '0') AS padded, concat_ws(' ', FirstName, LastName) AS full_name FROM raw_customers""",
)
def _(lay):
    return lay.raw_customers.select(
        "Id", F.lpad("Id", 8, "0").alias("padded"), F.concat_ws(" ", "FirstName", "LastName").alias("full_name")
    )


@query("j13_substring", "SELECT birth_date, substr(birth_date, 1, 4) AS year_text FROM raw_user_profiles")
def _(lay):
    return lay.raw_profiles.select("birth_date", F.col("birth_date").substr(1, 4).alias("year_text"))


@query(
    "j14_parse_unpadded_date",
    "SELECT PurchaseDate, CAST(try_strptime(PurchaseDate, '%Y-%m-%d') AS DATE) AS day FROM raw_sales",
)
def _(lay):
    return lay.raw_sales.select("PurchaseDate", fn.day_unpadded(F.col("PurchaseDate")).alias("day"))


@query(
    "j15_parse_padded_date",
    """SELECT RegistrationDate, CASE WHEN length(RegistrationDate) = 10
              THEN CAST(strptime(RegistrationDate, '%Y-%m-%d') AS DATE) END AS day FROM raw_customers""",
)
def _(lay):
    return lay.raw_customers.select("RegistrationDate", fn.day_padded(F.col("RegistrationDate")).alias("day"))


@query(
    "j16_age",
    """SELECT email, birth_date,
              CAST(floor(date_diff('day', birth_date, DATE '2001-08-01') / 365.25) AS BIGINT) AS age,
              CAST(date_sub('year', birth_date, DATE '2001-08-01') AS BIGINT) AS age_exact
       FROM silver_profiles""",
)
def _(lay):
    born, today = F.col("birth_date"), F.lit(AS_OF).cast("date")
    return lay.profiles.select(
        "email",
        "birth_date",
        fn.age_years(born, today).alias("age"),
        fn.age_exact(born, today).alias("age_exact"),
    )


@query(
    "j17_date_arithmetic",
    """SELECT purchase_date, CAST(date_diff('day', purchase_date, DATE '2001-08-01') AS INT) AS days_since,
              CAST(purchase_date + 30 AS DATE) AS due_date FROM silver_sales""",
)
def _(lay):
    day = F.col("purchase_date")
    return lay.sales.select(
        day,
        F.datediff(F.lit(AS_OF).cast("date"), day).alias("days_since"),
        F.date_add(day, 30).alias("due_date"),
    )


@query(
    "j18_date_parts",
    """SELECT purchase_date, CAST(year(purchase_date) AS INT) AS year, CAST(month(purchase_date) AS INT) AS month,
              CAST(day(purchase_date) AS INT) AS day, CAST(dayofweek(purchase_date) + 1 AS INT) AS weekday
       FROM silver_sales""",
)
def _(lay):
    day = F.col("purchase_date")
    return lay.sales.select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        F.dayofweek(day).alias("weekday"),
    )


@query(
    "j19_truncate_date",
    """SELECT purchase_date, CAST(date_trunc('week', purchase_date) AS DATE) AS week,
              CAST(date_trunc('month', purchase_date) AS DATE) AS month FROM silver_sales""",
)
def _(lay):
    return lay.sales.select(
        "purchase_date",
        F.date_trunc("week", "purchase_date").cast("date").alias("week"),
        F.date_trunc("month", "purchase_date").cast("date").alias("month"),
    )


@query(
    "j20_date_format",
    "SELECT purchase_date, strftime(purchase_date, '%Y-%m-%d') AS date_text FROM silver_sales",
)
def _(lay):
    return lay.sales.select("purchase_date", F.date_format("purchase_date", "yyyy-MM-dd").alias("date_text"))


@query(
    "j21_current_date",
    """SELECT client_id, purchase_date < current_date AS in_past, count(*) AS sales
       FROM silver_sales GROUP BY 1, 2""",
)
def _(lay):
    past = (F.col("purchase_date") < F.current_date()) & (F.col("purchase_date") < F.current_timestamp())
    return lay.sales.groupBy("client_id", past.alias("in_past")).agg(F.count(F.lit(1)).alias("sales"))


@query(
    "j22_sql_extract",
    """SELECT CAST(extract(MONTH FROM purchase_date) AS INT) AS month,
              CAST(extract(DAY FROM purchase_date) AS INT) AS day, count(*) AS sales
       FROM silver_sales GROUP BY 1, 2""",
)
def _(lay):
    lay.sales.createOrReplaceTempView("strataflow_sales")
    return lay.spark.sql(
        """SELECT extract(MONTH FROM purchase_date) AS month, extract(DAY FROM purchase_date) AS day,
                  count(*) AS sales FROM strataflow_sales GROUP BY 1, 2"""
    )


@query(
    "j23_floor_division",
    "SELECT price, CAST(floor(CAST(price AS DOUBLE) / 365.25) AS BIGINT) AS floored FROM silver_sales",
)
def _(lay):
    return lay.sales.select("price", F.floor(F.col("price").cast("double") / F.lit(365.25)).alias("floored"))


@query(
    "j24_case_when",
    """SELECT price, CASE WHEN price >= 75000 THEN 'high' WHEN price >= 25000 THEN 'middle' ELSE 'low' END AS tier
       FROM silver_sales""",
)
def _(lay):
    price = F.col("price")
    tier = F.when(price >= 75000, "high").when(price >= 25000, "middle").otherwise(F.lit("low"))
    return lay.sales.select(price, tier.alias("tier"))
