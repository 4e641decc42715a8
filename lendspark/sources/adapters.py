"""Driver tables → the library's input schemas.

The driver ships TPC-H-like tables.  These four projections turn them into
``transactions``, ``customers`` and ``behavioral_signals`` (plus the customers
who converted).  Each adapter exists twice: as a DataFrame plan (used by
the library) and as SQL text (used by the DuckDB oracle).  Only the columns
each adapter needs are read, so the Parquet scans are pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed mapping values (must equal the oracle views): part brand → merchant
# category, order priority → credit category, market segment → occupation.
BRAND_CATEGORY = [
    ("Brand#1", "Auto_Dealer"), ("Brand#2", "Real_Estate_Broker"),
    ("Brand#3", "Wedding_Services"), ("Brand#4", "Education"),
    ("Brand#5", "Home_Improvement"), ("Brand#6", "Jewellery"),
    ("Brand#7", "EMI"), ("Brand#8", "EMI"), ("Brand#9", "EMI"),
    ("Brand#10", "Travel"), ("Brand#11", "Fuel"), ("Brand#12", "Dining"),
]
DEFAULT_BRAND_CATEGORY = "Groceries"
SALARIED_SEGMENTS = ["MACHINERY", "AUTOMOBILE", "BUILDING"]
PRODUCTS_BY_KEY_MOD4 = ["Personal Loan", "Home Loan", "Mortgage Loan", "Auto Loan"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(col, pairs, default):
    expr = None
    for k, v in pairs:
        expr = (F.when(col == k, v) if expr is None else expr.when(col == k, v))
    return expr.otherwise(default)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_id, txn_date DATE, txn_type, amount DOUBLE, category.

    Orders are credits; line items
    are debits whose category comes from the part brand.  Amounts are whole
    numbers so every sum is exact in any order.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                                   "o_totalprice", "o_orderpriority")
    credits = (orders
               .select(F.col("o_custkey").alias("customer_id"),
                       F.col("o_orderdate").cast("date").alias("txn_date"),
                       F.lit("credit").alias("txn_type"),
                       F.floor(F.lit(60000) + F.col("o_totalprice") * (F.col("o_custkey") % 5) * F.lit(0.05))
                       .cast("double").alias("amount"),
                       F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Salary")
                       .when(F.col("o_orderpriority") == "3-MEDIUM", "Business_Income")
                       .otherwise("Gig_Payment").alias("category")))
    # what each join moves is reduced to the fields the result needs: a date, one net price, the category
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_shipdate").cast("date").alias("txn_date"),
        (F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount")) * F.lit(0.1)).alias("_net"))
    part = table(spark, sf_dir, "part").select("p_partkey", _case(F.col("p_brand"), BRAND_CATEGORY, DEFAULT_BRAND_CATEGORY).alias("category"))
    debits = (li.join(orders.select("o_orderkey", "o_custkey"), li.l_orderkey == orders.o_orderkey)
              .select(F.col("o_custkey").alias("customer_id"), "txn_date", F.floor(F.col("_net") * (F.lit(1) + F.col("o_custkey") % 9))
                      .cast("double").alias("amount"), "l_partkey")
              .join(part, F.col("l_partkey") == F.col("p_partkey"))
              .select("customer_id", "txn_date", F.lit("debit").alias("txn_type"), "amount", "category"))
    return credits.unionByName(debits)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    k = F.col("c_custkey")
    declared = F.floor(F.lit(20000) + F.greatest(F.col("c_acctbal"), F.lit(0.0)) * 10).cast("double")
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
            .select(k.alias("customer_id"),
                    F.col("c_name").alias("name"),
                    F.col("n_name").alias("city"),
                    (F.lit(21) + (k % 45).cast("int")).alias("age"),
                    F.when(F.col("n_regionkey") <= 1, "Tier 1").when(F.col("n_regionkey") <= 3, "Tier 2")
                    .otherwise("Tier 3").alias("city_tier"),
                    F.when(F.col("c_mktsegment").isin(*SALARIED_SEGMENTS), "salaried")
                    .when(F.col("c_mktsegment") == "HOUSEHOLD", "self_employed")
                    .otherwise("gig_worker").alias("occupation"),
                    declared.alias("declared_monthly_income"),
                    # (8 + k % 5) / 10 is the correctly rounded double of 0.8 + 0.1·(k % 5)
                    (declared * ((F.lit(8) + k % 5) / F.lit(10))).alias("true_monthly_income"),
                    (F.lit(3) + (k * 7 % 178).cast("int")).alias("tenure_months"),
                    (k % 5).cast("int").alias("existing_products"),
                    ((k * 31 % 1000).cast("double") / 1000).alias("digital_engagement_score"),
                    _case(k % 4, list(enumerate(PRODUCTS_BY_KEY_MOD4)), None).alias("loan_product_interest")))


def behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events fall in one month, so a "month" is a 3-day period."""
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_type")
    et = F.col("event_type")

    def n(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")

    return (ev.groupBy(F.col("user_id").alias("customer_id"),
                       F.floor((F.dayofmonth("ts") - 1) / 3).cast("int").alias("period"))
            .agg(n(et.isin("click", "signup")).alias("app_logins"),
                 n(et == "view").alias("emi_calculator_views"),
                 n(et == "purchase").alias("loan_page_visits"),
                 n(et == "error").alias("product_page_visits"))
            .withColumnRenamed("period", "month"))


def conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(customer_id, loan_converted = 1) of the customers with a sign-up event."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_type").filter(F.col("event_type") == "signup")
    return ev.groupBy(F.col("user_id").alias("customer_id")).agg(F.lit(1).alias("loan_converted"))


# ---------------------------------------------------------------------------
# SQL text of the same adapters (DuckDB and Spark SQL both accept it).
# ---------------------------------------------------------------------------

SQL_TRANSACTIONS = """
select o_custkey as customer_id, cast(o_orderdate as date) as txn_date, 'credit' as txn_type,
       cast(floor(60000 + o_totalprice*(o_custkey % 5)*0.05) as double) as amount,
       case when o_orderpriority='1-URGENT' or o_orderpriority='2-HIGH' then 'Salary'
            when o_orderpriority='3-MEDIUM' then 'Business_Income' else 'Gig_Payment' end as category
from orders
union all
select o_custkey, cast(l_shipdate as date), 'debit',
       cast(floor(l_extendedprice*(1-l_discount)*0.1*(1+o_custkey % 9)) as double),
       case p_brand when 'Brand#1' then 'Auto_Dealer' when 'Brand#2' then 'Real_Estate_Broker'
                    when 'Brand#3' then 'Wedding_Services' when 'Brand#4' then 'Education'
                    when 'Brand#5' then 'Home_Improvement' when 'Brand#6' then 'Jewellery'
                    when 'Brand#7' then 'EMI' when 'Brand#8' then 'EMI' when 'Brand#9' then 'EMI'
                    when 'Brand#10' then 'Travel' when 'Brand#11' then 'Fuel' when 'Brand#12' then 'Dining'
                    else 'Groceries' end
from lineitem join orders on l_orderkey=o_orderkey join part on l_partkey=p_partkey
"""

SQL_CUSTOMERS = """
select c_custkey as customer_id, c_name as name, n_name as city, 21 + cast(c_custkey % 45 as int) as age,
       case when n_regionkey<=1 then 'Tier 1' when n_regionkey<=3 then 'Tier 2' else 'Tier 3' end as city_tier,
       case when c_mktsegment in ('MACHINERY','AUTOMOBILE','BUILDING') then 'salaried'
            when c_mktsegment='HOUSEHOLD' then 'self_employed' else 'gig_worker' end as occupation,
       cast(floor(20000 + greatest(c_acctbal,0)*10) as double) as declared_monthly_income,
       cast(floor(20000 + greatest(c_acctbal,0)*10) as double)*(0.8+0.1*(c_custkey % 5)) as true_monthly_income,
       3 + cast(c_custkey*7 % 178 as int) as tenure_months, cast(c_custkey % 5 as int) as existing_products,
       cast(c_custkey*31 % 1000 as double)/1000 as digital_engagement_score,
       case c_custkey % 4 when 0 then 'Personal Loan' when 1 then 'Home Loan' when 2 then 'Mortgage Loan'
                          else 'Auto Loan' end as loan_product_interest
from customer join nation on c_nationkey=n_nationkey
"""

SQL_BEHAVIOR = """
select user_id as customer_id, cast(floor((extract(day from ts)-1)/3) as int) as month,
       cast(sum(case when event_type in ('click','signup') then 1 else 0 end) as bigint) as app_logins,
       cast(sum(case when event_type='view' then 1 else 0 end) as bigint) as emi_calculator_views,
       cast(sum(case when event_type='purchase' then 1 else 0 end) as bigint) as loan_page_visits,
       cast(sum(case when event_type='error' then 1 else 0 end) as bigint) as product_page_visits
from events group by 1,2
"""


SQL_CONVERSIONS = "select distinct user_id as customer_id, 1 as loan_converted from events where event_type = 'signup'"


def sql_views() -> str:
    """``WITH`` prefix defining the input views."""
    return (f"with v_transactions as ({SQL_TRANSACTIONS}),\n"
            f"v_customers as ({SQL_CUSTOMERS}),\n"
            f"v_behavior as ({SQL_BEHAVIOR}),\n"
            f"v_conversions as ({SQL_CONVERSIONS})")
