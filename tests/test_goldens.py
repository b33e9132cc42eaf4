"""Golden values published with the reference's retail example, on its rows retyped as
literals (fixture values: 8 products, 10 orders, 15 order items)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyspark.functions import tiers
from tallyspark.functions.money import money
from tallyspark.operators import quality as Q

PRODUCTS = [(201, "Wireless Earbuds", "Electronics", 1499.00), (202, "Cotton T-Shirt", "Clothing", 799.00),
            (203, "Smart Watch", "Electronics", 2999.00), (204, "Running Shoes", "Clothing", 4599.00),
            (205, "Bluetooth Speaker", "Electronics", 3499.00), (206, "Bedsheet Set", "Home", 1299.00),
            (207, "Laptop Stand", "Electronics", 899.00), (208, "Cushion Covers (Set)", "Home", 599.00)]
ORDERS = [(1001, 101, "2024-08-01", "Delivered", 4498.00), (1002, 102, "2024-08-03", "Delivered", 799.00),
          (1003, 103, "2024-08-05", "Shipped", 7498.00), (1004, 101, "2024-08-10", "Delivered", 3499.00),
          (1005, 104, "2024-08-12", "Cancelled", 2999.00), (1006, 105, "2024-08-15", "Delivered", 5898.00),
          (1007, 106, "2024-08-18", "Pending", 1299.00), (1008, 103, "2024-08-20", "Delivered", 899.00),
          (1009, 107, "2024-08-25", "Shipped", 6098.00), (1010, 108, "2024-08-28", "Delivered", 1598.00)]
ITEMS = [(5001, 1001, 201, 2, 1499.00, 0), (5002, 1001, 207, 1, 899.00, 10), (5003, 1002, 202, 1, 799.00, 0),
         (5004, 1003, 203, 1, 2999.00, 0), (5005, 1003, 204, 1, 4599.00, 5), (5006, 1004, 205, 1, 3499.00, 0),
         (5007, 1005, 203, 1, 2999.00, 0), (5008, 1006, 201, 1, 1499.00, 10), (5009, 1006, 204, 1, 4599.00, 5),
         (5010, 1007, 206, 1, 1299.00, 0), (5011, 1008, 207, 1, 899.00, 0), (5012, 1009, 205, 1, 3499.00, 0),
         (5013, 1009, 208, 2, 599.00, 15), (5014, 1010, 206, 1, 1299.00, 0), (5015, 1010, 208, 1, 599.00, 0)]


@pytest.fixture(scope="module")
def retail(spark):
    products = spark.createDataFrame(PRODUCTS, "product_id int, product_name string, category string, unit_price double")
    orders = spark.createDataFrame(
        [(a, b, dt.date.fromisoformat(c), d, e) for a, b, c, d, e in ORDERS],
        "order_id int, customer_id int, order_date date, status string, total_amount double")
    items = spark.createDataFrame(ITEMS, "item_id int, order_id int, product_id int, quantity int, "
                                         "unit_price double, discount_pct int")
    return products, orders, items


def test_delivered_orders_and_revenue(retail):
    _, orders, _ = retail
    d = orders.filter(F.col("status") == "Delivered")
    row = d.agg(F.count(F.lit(1)).alias("n"), F.sum(money("total_amount")).alias("rev")).collect()[0]
    assert row["n"] == 6 and row["rev"] == Decimal("17191.00")


def test_active_orders_window(retail):
    _, orders, _ = retail
    d = orders.filter(F.col("order_date").between(dt.date(2024, 8, 10), dt.date(2024, 8, 25))
                      & (F.col("status") != "Cancelled"))
    row = d.agg(F.count(F.lit(1)).alias("n"), F.sum(money("total_amount")).alias("rev")).collect()[0]
    assert row["n"] == 5 and row["rev"] == Decimal("17693.00")


def test_avg_price_by_category_and_having(retail):
    products, _, _ = retail
    avg = products.groupBy("category").agg(
        F.round(F.sum(money("unit_price")) / F.count("unit_price"), 2).alias("avg_price"))
    got = {r["category"]: r["avg_price"] for r in avg.collect()}
    assert got == {"Clothing": Decimal("2699.00"), "Electronics": Decimal("2224.00"), "Home": Decimal("949.00")}
    assert sorted(r["category"] for r in avg.filter(F.col("avg_price") > 2000).collect()) == \
        ["Clothing", "Electronics"]


def test_price_tiers(retail):
    products, _, _ = retail
    ladder = [(1000.0, "<", "Budget"), (3000.0, "<=", "Mid-Range")]
    t = products.select(tiers.price_tier("unit_price", ladder).alias("tier")).groupBy("tier").count()
    assert {r["tier"]: r["count"] for r in t.collect()} == {"Budget": 3, "Mid-Range": 3, "Premium": 2}


def test_revenue_gap(retail):
    _, orders, items = retail
    amount = F.col("quantity") * money("unit_price") * (F.lit(1) - F.col("discount_pct").cast("decimal(5,2)") / 100)
    gaps = Q.reconcile(orders, items, "order_id", "total_amount", amount)
    got = {r["order_id"]: (r["header_total"], r["computed_total"]) for r in gaps.collect()}
    assert got == {1001: (4498.0, 3807.1), 1003: (7498.0, 7368.05), 1006: (5898.0, 5718.15),
                   1009: (6098.0, 4517.3), 1010: (1598.0, 1898.0)}


def test_no_orphans_and_orders_have_items(retail):
    _, orders, items = retail
    assert Q.orphans(items, "order_id", orders, "order_id").count() == 0
    assert Q.orphans(orders, "order_id", items, "order_id").count() == 0


# Fixture values: thirty staff records each, as published with their results (NULL where empty).
ENRICH_ROWS = """1,Aarav Sharma,Engineering,85000,2019-03-15,Mumbai,5,4.2
2,Priya Patel,Marketing,62000,2020-07-22,Delhi,3,3.8
3,Rohan Gupta,Engineering,92000,2018-01-10,Bangalore,6,4.5
4,Sneha Reddy,HR,58000,2021-05-18,Hyderabad,2,3.5
5,Vikram Singh,Engineering,105000,2016-11-03,Pune,8,4.7
6,Ananya Iyer,Data Science,95000,2019-09-12,Chennai,5,4.3
7,Karthik Nair,Marketing,67000,2020-02-28,Mumbai,3,3.9
8,Divya Joshi,Engineering,78000,2021-08-14,Delhi,,3.6
9,Amit Kumar,HR,55000,2022-01-25,Bangalore,1,
10,Neha Verma,Data Science,98000,2018-06-30,Hyderabad,6,4.6
11,Rahul Mehta,Finance,72000,2019-12-05,Pune,4,4.0
12,Pooja Agarwal,Engineering,88000,2017-04-20,Chennai,7,4.4
13,Suresh Rao,Finance,69000,2020-10-15,Mumbai,3,3.7
14,Meera Krishnan,Data Science,101000,2018-03-08,Bangalore,6,4.8
15,Arjun Desai,Marketing,,2021-11-22,Delhi,2,3.4
16,Lakshmi Menon,HR,61000,2019-07-14,Hyderabad,4,4.1
17,Sanjay Tiwari,Engineering,83000,2020-05-30,Pune,,3.9
18,Ritu Saxena,Finance,75000,2019-01-18,Chennai,5,4.2
19,Deepak Chauhan,Data Science,97000,2017-09-25,Mumbai,7,4.5
20,Kavita Bhatt,Marketing,64000,2022-03-10,Delhi,1,3.3
21,Manish Pandey,Engineering,110000,2015-08-12,Bangalore,9,4.9
22,Swati Kulkarni,HR,,2021-04-05,Hyderabad,2,
23,Nikhil Jain,Finance,71000,2020-06-17,Pune,3,3.8
24,Anjali Mishra,Data Science,93000,2019-02-28,Chennai,5,4.3
25,Rajesh Shetty,Engineering,86000,2018-12-10,Mumbai,6,4.1
26,Nandini Das,Marketing,66000,2020-09-03,Delhi,3,3.6
27,Varun Kapoor,Finance,78000,2017-05-22,Bangalore,7,4.4
28,Shruti Hegde,HR,59000,2021-07-30,Hyderabad,2,3.5
29,Aditya Malhotra,Engineering,94000,2018-10-14,Pune,6,4.6
30,Pallavi Sharma,Data Science,100000,2019-04-20,Chennai,5,4.7"""
# emp_id: (salary, bonus, band, experience, tenure in months)
ENRICHED = {1: (85000.0, 12750.0, "Mid", 5, 87), 3: (92000.0, 13800.0, "Mid", 6, 102),
            5: (105000.0, 15750.0, "Senior", 8, 116), 6: (95000.0, 14250.0, "Mid", 5, 82),
            8: (78000.0, 11700.0, "Mid", 0, 58), 10: (98000.0, 14700.0, "Mid", 6, 96),
            12: (88000.0, 13200.0, "Mid", 7, 110), 14: (101000.0, 15150.0, "Senior", 6, 100),
            17: (83000.0, 12450.0, "Mid", 0, 73), 18: (75000.0, 11250.0, "Mid", 5, 89),
            19: (97000.0, 14550.0, "Mid", 7, 105), 21: (110000.0, 16500.0, "Senior", 9, 131),
            24: (93000.0, 13950.0, "Mid", 5, 88), 25: (86000.0, 12900.0, "Mid", 6, 91),
            27: (78000.0, 11700.0, "Mid", 7, 109), 29: (94000.0, 14100.0, "Mid", 6, 92),
            30: (100000.0, 15000.0, "Senior", 5, 86)}


def from_text(spark, rows: str, schema: str):
    """The rows written as a CSV file and read with their schema."""
    from tallyspark.session import scratch_root
    from tallyspark.sources import files as FS
    names = [c.split()[0] for c in schema.split(", ")]
    text = spark.createDataFrame([tuple(x or None for x in line.split(",")) for line in rows.split("\n")],
                                 ", ".join(f"{n} string" for n in names))
    path = scratch_root(spark)
    FS.write_csv(text, path)
    return FS.read_csv(spark, path, schema=schema)


def test_enrichment_pipeline(spark):
    from tallyspark.plans.staff import enrich
    st = from_text(spark, ENRICH_ROWS, "emp_id bigint, name string, department string, salary double, "
                                       "joining_date string, city string, experience_years int, rating double")
    got = enrich(st).collect()
    assert {r["emp_id"]: (r["salary"], r["annual_bonus"], r["salary_band"], r["experience_years"],
                          r["tenure_months"]) for r in got} == ENRICHED


SUMMARY_ROWS = """1,Aarav Sharma,28,Engineering,75000,North,2021-03-15,4.5
2,Priya Singh,35,Marketing,62000,South,2019-07-22,3.8
3,Rohan Patel,42,Engineering,95000,West,2017-01-10,4.2
4,Sneha Gupta,29,HR,55000,East,2022-06-01,4.0
5,Vikram Reddy,31,Engineering,82000,South,2020-09-18,4.7
6,Ananya Iyer,26,Marketing,58000,North,2023-02-14,3.5
7,Karan Mehta,38,Finance,78000,West,2018-11-30,4.1
8,Divya Nair,33,HR,60000,East,2019-04-25,3.9
9,Arjun Das,45,Finance,92000,North,2016-08-12,4.6
10,Meera Joshi,27,Engineering,70000,South,2022-01-05,4.3
11,Rahul Verma,30,Marketing,61000,West,2021-10-20,3.7
12,Pooja Kulkarni,36,Finance,85000,East,2018-05-08,4.4
13,Amit Saxena,40,Engineering,90000,North,2017-06-19,4.8
14,Neha Bhat,29,HR,54000,South,2022-09-11,3.6
15,Suresh Kumar,50,Finance,98000,West,2015-03-28,4.9
16,Kavita Rao,32,Marketing,63000,East,2020-12-03,4.0
17,Deepak Tiwari,28,Engineering,72000,North,2022-04-17,4.1
18,Ritu Agarwal,34,HR,57000,South,2019-08-22,3.8
19,Manish Pandey,41,Finance,88000,West,2017-10-05,4.5
20,Swati Deshmukh,25,Marketing,56000,East,2023-01-20,3.4
21,Aarav Sharma,28,Engineering,75000,North,2021-03-15,4.5
22,Sanjay Mishra,37,Engineering,87000,South,2018-02-14,4.3
23,Lakshmi Venkat,30,Marketing,,North,2021-05-10,3.9
24,Rajesh Khanna,44,Finance,91000,West,2016-11-08,
25,Gaurav Singh,,HR,53000,East,2023-03-01,3.5
26,Nisha Kapoor,31,Engineering,79000,,2020-07-15,4.2
27,Tarun Bose,35,Marketing,64000,North,2019-09-22,
28,Pallavi Jain,29,HR,,South,2022-08-05,3.7
29,Vikas Choudhary,39,Finance,86000,East,2018-01-18,4.4
30,Aisha Khan,27,Engineering,71000,West,2022-11-30,4.0"""
# department: (employees, average salary, total salary, average rating, total bonus, lowest, highest salary)
SUMMARY = {"Finance": (7, 88285.71, 618000.0, 4.43, 27447.0, 78000, 98000),
           "Engineering": (9, 80111.11, 721000.0, 4.34, 31400.0, 70000, 95000),
           "Marketing": (7, 62486.71, 437407.0, 3.77, 16553.87, 56000, 73407),
           "HR": (6, 58734.5, 352407.0, 3.75, 13221.06, 53000, 73407)}


def test_summary_pipeline(spark):
    """One record is there twice under two ids; the published result counts it once."""
    from tallyspark.operators.clean import dedup_keep_first
    from tallyspark.plans.staff import summary_by_department, summary_detail
    st = from_text(spark, SUMMARY_ROWS, "emp_id int, name string, age int, department string, salary int, region string, "
                                        "joining_date date, rating double")
    once = dedup_keep_first(st, [c for c in st.columns if c != "emp_id"], "emp_id")
    assert once.count() == 29
    got = summary_by_department(summary_detail(once)).collect()
    assert [r["department"] for r in got] == list(SUMMARY)
    assert {r["department"]: tuple(r)[1:] for r in got} == SUMMARY
