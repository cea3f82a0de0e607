"""Decisions on duplicates, blanks, precedence and ties, on hand-written rows."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from strataflow.operators.dedup import first_ranked, latest, upsert, upsert_by_join
from strataflow.operators.joins import left_join_chain, left_join_on_nullable, left_join_to_many, lookup_join
from strataflow.operators.quality import key_quality, sales_quality
from strataflow.plans import analytics, bronze, gold, silver

RAW = "CustomerId string, PurchaseDate string, Product string, Price string"
DUMP = (
    "Id string, FirstName string, LastName string, Email string, RegistrationDate string, State string, "
    "delivery_date date"
)


def today():
    return F.lit("2022-09-01").cast("date")


def dump(spark, *rows):
    return spark.createDataFrame([(*r[:-1], date.fromisoformat(r[-1]) if r[-1] else None) for r in rows], DUMP)


def test_blank_lines_leave_bronze_and_half_blank_ones_stay(spark):
    raw = spark.createDataFrame([(None, None, None, None), ("1", None, None, None)], RAW)
    kept = bronze.sales_bronze(raw)
    assert kept.count() == 1
    assert kept.first()["ingested_at"] is not None


def test_sales_profiles_differ_in_what_they_drop(spark):
    raw = spark.createDataFrame(
        [
            ("1", "2022-09-1", " TV ", "609$"),
            ("2", "2022/09/1", "TV", "12"),
            ("3", "2022-09-1 10:00", "TV", "1,5"),
            ("4", "2022-09-1", "TV", ""),
            ("", "2022-09-1", "TV", "5"),
        ],
        RAW,
    )
    keys = {
        p: [r[0] for r in rows_of(silver.sales_silver(raw, p).select("client_id"))]
        for p in ("strict", "lenient", "normalised")
    }
    assert keys == {"strict": [1], "lenient": [1, 2, 3, 4], "normalised": [1, 3, 4]}
    products = rows_of(silver.sales_silver(raw, "normalised").select("product_name").distinct())
    assert products == [("TV",)]
    with pytest.raises(ValueError):
        silver.sales_silver(raw, "other")


def test_newest_delivery_wins_and_ids_are_typed_first(spark):
    rows = dump(
        spark,
        ("1", "A", None, "a@x", "2022-8-1", "Ohio", "2022-08-01"),
        (" 1", "A", None, "a@x", "2022-8-1", "Maine", "2022-08-02"),
        ("1", "A", None, "a@x", "2022-8-1", "Texas", None),
        ("n/a", "B", None, "b@x", "2022-8-1", "Ohio", "2022-08-02"),
    )
    expected = [(1, "A", None, "a@x", date(2022, 8, 1), "Maine")]
    assert rows_of(silver.customers_silver(rows).drop("processed_at")) == expected


def test_latest_and_first_ranked_agree(spark):
    df = spark.range(2000).selectExpr("id % 37 AS k", "id % 11 AS v", "cast(id % 5 AS string) AS t")
    order = [F.col("v").desc(), F.col("t").desc()]
    assert rows_of(latest(df, ["k"], ["v"])) == rows_of(first_ranked(df, ["k"], order))


def test_profiles_without_email_are_left_out(spark):
    raw = spark.createDataFrame(
        [("a@x", "Cher", "Ohio", "2000-01-01", "1"), (None, "No Mail", "Ohio", "2000-01-01", "2")],
        "email string, full_name string, state string, birth_date string, phone_number string",
    )
    got = rows_of(silver.profiles_silver(raw).drop("processed_at"))
    assert got == [("a@x", "Ohio", date(2000, 1, 1), "1", "Cher", None)]


@pytest.fixture
def people(spark):
    customers = spark.createDataFrame(
        [
            (1, None, "L", "a@x", date(2022, 1, 1), None),
            (2, "F", None, "B@x ", date(2022, 1, 1), "Ohio"),
            (3, "N", None, None, date(2022, 1, 1), None),
        ],
        "client_id int, first_name string, last_name string, email string, registration_date date, state string",
    )
    profiles = spark.createDataFrame(
        [
            ("a@x", "Maine", date(2002, 9, 1), "1", "Ann", "Lee"),
            ("b@x", "Texas", date(2000, 9, 1), "2", "Bob", "Ray"),
        ],
        "email string, state string, birth_date date, phone_number string, first_name string, last_name string",
    )
    return customers, profiles


def test_gaps_are_filled_and_every_customer_is_kept(people):
    rows = gold.enrich_customers(*people, as_of=today()).drop("processed_at")
    got = {r["client_id"]: r for r in rows.collect()}
    assert (got[1]["first_name"], got[1]["last_name"], got[1]["state"], got[1]["age"]) == ("Ann", "L", "Maine", 20)
    assert (got[2]["first_name"], got[2]["last_name"], got[2]["birth_date"]) == ("F", None, None)
    assert (got[3]["email"], got[3]["state"]) == (None, None)
    assert [f.dataType.simpleString() for f in rows.schema if f.name in ("client_id", "age")] == ["bigint"] * 2


def test_normalised_emails_and_profile_precedence(people):
    rows = gold.enrich_customers(*people, as_of=today(), state_first="profile", normalise_email=True)
    got = {r["client_id"]: (r["state"], r["last_name"]) for r in rows.collect()}
    assert got == {1: ("Maine", "L"), 2: ("Texas", "Ray"), 3: (None, None)}


def test_normalising_does_not_fan_out(people):
    customers, profiles = people
    twice = profiles.union(profiles.withColumn("email", F.upper("email")))
    assert gold.enrich_customers(customers, twice, as_of=today(), normalise_email=True).count() == 3


def test_sales_without_a_customer_survive_in_gold_sales(spark, people):
    customers, profiles = people
    full = profiles.withColumn("full_name", F.concat_ws(" ", "first_name", "last_name"))
    sales = spark.createDataFrame(
        [(2, date(2022, 9, 1), "TV", Decimal("5.00")), (9, date(2022, 9, 2), "TV", Decimal("6.00"))],
        "client_id int, purchase_date date, product_name string, price decimal(10,2)",
    )
    got = {r["client_id"]: (r["state"], r["full_name"]) for r in gold.sales_enriched(sales, customers, full).collect()}
    assert got == {2: ("Texas", "Bob Ray"), 9: (None, None)}


def test_null_keys_never_match_but_stay(spark):
    left = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("z", 4)], "k string, v int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, w int")
    assert rows_of(left_join_on_nullable(left, right, "k")) == rows_of(left.join(right, "k", "left"))


def test_join_chain_equals_two_joins(spark):
    facts = spark.range(60).selectExpr("cast(id % 8 AS int) AS c", "id AS v")
    middle = spark.createDataFrame([(0, "a"), (1, None), (2, "b"), (3, "z")], "c int, e string")
    far = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "e string, w int")
    expected = facts.join(middle, "c", "left").join(far, "e", "left").select("c", "v", "e", "w")
    assert rows_of(left_join_chain(facts, middle, "c", far, "e").select("c", "v", "e", "w")) == rows_of(expected)


def test_one_to_many_left_join(spark):
    few = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (2, "d")], "k int, v string")
    many = spark.createDataFrame([(2, 5), (2, 5), (3, 6), (None, 7)], "k int, w int")
    assert rows_of(left_join_to_many(few, many, "k")) == rows_of(few.join(many, "k", "left"))


def test_lookup_join_leaves_the_choice_to_spark(spark):
    facts = spark.range(50).selectExpr("cast(id % 7 AS int) AS k", "id")
    lookup = spark.createDataFrame([(i, str(i)) for i in range(5)], "k int, name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plain, told = lookup_join(facts, lookup, "k"), lookup_join(facts, lookup, "k", broadcast=True)
        assert "BroadcastHashJoin" not in plain._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in told._jdf.queryExecution().executedPlan().toString()
        assert rows_of(plain) == rows_of(told) == rows_of(facts.join(lookup, "k", "left"))
        for bound in ({"rows": 4}, {"size": 40}):
            large = lookup_join(facts, lookup, "k", broadcast=True, **bound)
            assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("kind", ["string", "int", "smallint", "decimal(10,2)", "date", "timestamp"])
def test_nullable_keys_of_every_type(spark, kind):
    values = {"date": ["2022-09-01", "2022-09-02"], "timestamp": ["2022-09-01 10:00:00", "2022-09-02 11:00:00"]}
    one, two = values.get(kind, ["1", "2"])
    left = spark.createDataFrame([(one, 1), (two, 2), (None, 3), (None, 4)], "k string, v int")
    right = spark.createDataFrame([(one, "x"), (None, "y")], "k string, w string")
    left, right = (df.withColumn("k", df["k"].cast(kind)) for df in (left, right))
    assert rows_of(left_join_on_nullable(left, right, "k")) == rows_of(left.join(right, "k", "left"))



def test_upsert_replaces_whole_rows(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    new = spark.createDataFrame([(2, None, "z"), (3, "c", None)], "k int, v string, w string")
    expected = [(1, "a", "x"), (2, None, "z"), (3, "c", None)]
    assert rows_of(upsert(old, new, "k")) == expected
    assert rows_of(upsert_by_join(old, new, "k")) == expected


def test_upsert_cuts_updates_to_a_row_and_takes_null_as_a_key(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    new = spark.createDataFrame([(2, "z"), (2, "y"), (2, None), (None, "n"), (4, "d")], "k int, v string")
    assert rows_of(upsert(old, new, "k")) == rows_of(spark.createDataFrame([(1, "a"), (2, None), (None, "n"), (4, "d")], old.schema))
    assert rows_of(upsert(old, new.limit(0), "k")) == rows_of(old)


def test_upsert_leaves_old_rows_where_they_are(spark):
    """The old rows are neither exchanged nor sorted when the new keys are few."""
    from strataflow.session import staged

    old = staged(spark.range(100_000).selectExpr("id AS k", "cast(id AS string) AS v"), "old")
    new = staged(spark.range(10).selectExpr("id * 7 AS k", "'new' AS v"), "new")
    plan = upsert(old, new, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") <= 2  # of the updates, for either use
    assert upsert(old, new, "k").where("v = 'new'").count() == 10


def test_quality_counts_add_up(spark):
    raw = spark.createDataFrame(
        [("1", "2022-09-1", "TV", "5"), ("x", "never", "TV", ""), ("2", "2022-09-1", "TV", "")], RAW
    )
    counts = sales_quality(silver.sales_typed(raw)).first().asDict()
    assert counts == {
        "rows_in": 3,
        "rows_out": 1,
        "rows_dropped": 2,
        "bad_client_id": 1,
        "bad_purchase_date": 1,
        "bad_price": 2,
    }
    keys = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert key_quality(keys, "k").first().asDict() == {
        "rows_in": 4,
        "rows_without_key": 1,
        "duplicates_removed": 1,
        "rows_out": 2,
    }


@pytest.fixture
def television_sales(spark):
    sales = spark.createDataFrame(
        [
            (1, date(2022, 9, 1), "TV"),
            (2, date(2021, 9, 10), "TV"),
            (3, date(2022, 9, 10), "TV"),
            (3, date(2022, 9, 11), "TV"),
            (4, date(2022, 9, 5), "TV"),
            (5, date(2022, 9, 5), "Oven"),
        ],
        "client_id int, purchase_date date, product_name string",
    ).withColumn("price", F.lit("1.00").cast("decimal(10,2)"))
    people = spark.createDataFrame(
        [(1, "Ohio", 20), (2, "Maine", 30), (3, None, 25), (4, "Ohio", 31), (5, "Ohio", 25)],
        "client_id bigint, state string, age bigint",
    )
    return sales, people


def test_top_state_breaks_ties_by_name_and_may_leave_out_unknown_states(television_sales):
    assert [tuple(r) for r in analytics.top_state(*television_sales, k=5).collect()] == [
        (None, 1),
        ("Maine", 1),
        ("Ohio", 1),
    ]
    first = analytics.top_state(*television_sales, exclude_null_state=True).collect()
    assert [tuple(r) for r in first] == [("Maine", 1)]


def test_fixed_dates_leave_out_other_years(television_sales):
    days = analytics.in_date_range(F.col("purchase_date"), "2022-09-01", "2022-09-10")
    rows = analytics.top_state(*television_sales, when=days, k=5).collect()
    assert [tuple(r) for r in rows] == [(None, 1), ("Ohio", 1)]


def test_sales_by_state_and_age(television_sales):
    rows = rows_of(analytics.sales_by_state_and_age(*television_sales).select("state", "age_band", "total_orders"))
    assert sorted(rows, key=repr) == sorted(
        [("Ohio", "20-29", 2), ("Maine", "30-39", 1), (None, "20-29", 2), ("Ohio", "30-39", 1)], key=repr
    )
