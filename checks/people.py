"""Relations derived from the driver tables, in SQL that Spark and DuckDB both run.

The driver texts hold no national ids, dashed cards or street addresses; these relations make them
from the customers and orders, row by row, so they grow with the data.
"""

from redactory.session import dealt

PEOPLE_SQL = """
SELECT concat('u', lpad(CAST(k AS STRING), 6, '0')) AS user_id, email, name, phone, address, ssn, card, locale,
 concat(name, ' can be reached at ', email, ' or ', phone, '.',
  CASE WHEN k % 3 = 0 THEN concat(' SSN on file: ', ssn, '.') ELSE '' END,
  CASE WHEN k % 5 = 0 THEN concat(' IP address: 192.168.1.', CAST(k % 250 AS STRING), '.') ELSE '' END,
  CASE WHEN k % 7 = 0 THEN concat(' Site: https://p', CAST(k AS STRING), '.example.com/home') ELSE '' END) AS bio
FROM (SELECT k, concat(fn, ' ', ln) AS name,
  concat(lower(fn), '.', lower(ln), CAST(k AS STRING), '@mail', CAST(k % 9 AS STRING), '.example.com') AS email,
  concat('555-', lpad(CAST(k % 900 + 100 AS STRING), 3, '0'), '-', lpad(CAST(k * 13 % 10000 AS STRING), 4, '0')) AS phone,
  concat(CAST(k % 900 + 100 AS STRING), ' ', split_part('Main,Oak,Pine,Elm,Maple', ',', CAST(1 + k % 5 AS INT)), ' ',
   split_part('St,Ave,Rd,Dr,Ln', ',', CAST(1 + k % 5 AS INT)), ', ',
   split_part('London,Paris,Berlin,Madrid,Rome,Tokyo,Oslo', ',', CAST(1 + k % 7 AS INT))) AS address,
  concat(lpad(CAST(100 + k % 700 AS STRING), 3, '0'), '-', lpad(CAST(10 + k * 7 % 90 AS STRING), 2, '0'), '-',
   lpad(CAST(1000 + k * 13 % 9000 AS STRING), 4, '0')) AS ssn,
  concat(split_part('4,5,3,6', ',', CAST(1 + k % 4 AS INT)), lpad(CAST(k % 1000 AS STRING), 3, '0'), '-1111-2222-',
   lpad(CAST(k * 17 % 10000 AS STRING), 4, '0')) AS card,
  split_part('en_US,fr_FR,de_DE,es_ES', ',', CAST(1 + k % 4 AS INT)) AS locale
 FROM (SELECT c_custkey AS k, split_part('Alice,Bob,Carol,Dave,Eve,Al', ',', CAST(1 + c_custkey % 6 AS INT)) AS fn,
   split_part('Smith,Johnson,Lee,Kim,Torres', ',', CAST(1 + c_custkey % 5 AS INT)) AS ln FROM {customer}) a) b
"""

PAYMENTS_SQL = """
SELECT o_orderkey AS order_key, concat('Order ', CAST(o_orderkey AS STRING), ' was placed on ',
  CAST(CAST(o_orderdate AS DATE) AS STRING), ' for $', CAST(o_custkey % 900 AS STRING), ',',
  lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0'), '.50 from account DE',
  lpad(CAST(o_custkey % 100 AS STRING), 2, '0'), lpad(CAST(o_orderkey AS STRING), 18, '0'), ' due 3/',
  CAST(1 + o_orderkey % 28 AS STRING), '/2024, invoice of March ', CAST(1 + o_orderkey % 28 AS STRING), ', 2024.') AS note
FROM {orders}
"""

#: Notes that name a person, a country and a company of the tables: what lists, not patterns, must find.
CONTACTS_SQL = """
SELECT p.*, n_name, s_name,
 concat('Ask ', name, ' of ', n_name, CASE WHEN c_custkey % 2 = 0 THEN concat(', not ', upper(name), ',') ELSE '' END,
  ' about ', s_name, ' or write to ', email, '; ', s_name, '0 is another firm.') AS note
FROM {people} p JOIN {customer} ON concat('u', lpad(CAST(c_custkey AS STRING), 6, '0')) = p.user_id
JOIN {nation} ON n_nationkey = c_nationkey JOIN {supplier} ON s_suppkey = c_custkey % 10 + 1
"""

CITIES = ("London", "Paris", "Berlin", "Madrid", "Rome", "Tokyo", "Oslo")


def people(spark, sf_dir):
    """Searching the texts of a customer takes a millisecond and reading its key next to nothing, so the keys are dealt out
    to all cores before the texts are made: a million customers fit into a few row groups."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey")
    return spark.sql(PEOPLE_SQL, customer=dealt(customer, "c_custkey"))


def payments(spark, sf_dir):
    return spark.sql(PAYMENTS_SQL, orders=spark.read.parquet(f"{sf_dir}/orders.parquet"))


def contacts(spark, sf_dir):
    """Dealt out again: a join leaves as many tasks as its sizes suggest, not as its texts need."""
    tables = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("customer", "nation", "supplier")}
    people = spark.sql(PEOPLE_SQL, customer=tables["customer"])
    return dealt(spark.sql(CONTACTS_SQL, people=people, **tables), "user_id")


def duck(sql: str) -> str:
    """The same statement over the views of DuckDB."""
    tables = {name: name for name in ("customer", "orders", "nation", "supplier")}
    return sql.format(people=f"({PEOPLE_SQL.format(**tables)})", **tables)
