"""The employee-shaped raw layer derived from the driver's tables.

The driver's tables hold no HR data and no nulls, so the raw layer is derived
from them: every order is one hire, every nation a department, every part a
job.  Each order keeps its row; a fixed, deterministic rule on the order key
turns some fields dirty (null, blank, unparseable) so that every quarantine
reason occurs.  The same rule is written in the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import testdata

# Fixed values of the derivation: divisors of the order key that make a field
# dirty, the number of departments the feed refers to (the nations are 0..24,
# so 25 and 26 are orphans), the job id range, and the hire time of day.
DIRTY_ID, DIRTY_NAME_NULL, DIRTY_NAME_BLANK = 97, 89, 83
DIRTY_DT_SHORT, DIRTY_DT_NULL = 79, 73
DIRTY_DEPARTMENT, DIRTY_JOB = 71, 67
DEPARTMENT_SPAN, JOB_SPAN = 27, 2100
HIRE_TIME = "T10:20:30Z"
FEED_YEAR = 1997


def employee_columns() -> tuple:
    """The raw employee fields as expressions over an orders row."""
    k = F.col("o_orderkey")
    none = F.lit(None)
    return (
        F.when(k % DIRTY_ID == 0, none).otherwise(k).alias("id"),
        F.when(k % DIRTY_NAME_NULL == 0, none)
         .when(k % DIRTY_NAME_BLANK == 0, F.lit("   "))
         .otherwise(F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" "))).alias("name"),
        F.when(k % DIRTY_DT_SHORT == 0, F.lit("202"))
         .when(k % DIRTY_DT_NULL == 0, none.cast("string"))
         .otherwise(F.concat(F.substring(F.col("o_orderdate").cast("string"), 1, 10),
                             F.lit(HIRE_TIME))).alias("datetime"),
        F.when(k % DIRTY_DEPARTMENT == 0, none)
         .otherwise(F.col("o_custkey") % DEPARTMENT_SPAN).alias("department_id"),
        F.when(k % DIRTY_JOB == 0, none.cast("double"))
         .otherwise((k % JOB_SPAN).cast("double")).alias("job_id"),
    )


def employees_from_orders(orders: DataFrame) -> DataFrame:
    """Raw employees (id, name, datetime, department_id, job_id) from orders."""
    return orders.select(*employee_columns())


def raw_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return employees_from_orders(testdata(spark, sf_dir, "orders"))


def raw_departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("department"))


def raw_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("job"))


def raw_layer(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {"employees": raw_employees(spark, sf_dir),
            "departments": raw_departments(spark, sf_dir),
            "jobs": raw_jobs(spark, sf_dir)}


# Fixed values of the request lines: the key ranges that bound a batch (orders
# have narrow ones, and in every fourth wide range one batch over the limit), and
# the divisors of the order key that give a record an unusual token, and the first
# ids of the departments and jobs that come with the requests only.
ORDERS_BLOCK, ORDERS_WIDE, PARTS_BLOCK, SUPPLIERS_BLOCK = 750, 6000, 400, 500
TOKEN_LONG_ID, TOKEN_TEXT_ID, TOKEN_HUGE_ID = 61, 43, 59
TOKEN_NUMBER_NAME, TOKEN_OBJECT_NAME, TOKEN_NO_OBJECT = 53, 47, 41
NEW_DEPARTMENTS, NEW_JOBS = 25, 2001
LONG_ID, HUGE_ID = 1_000_000_000_000_000_000, "99999999999999999999"


def employee_record() -> Column:
    """A raw employee as JSON text, null fields left out; some keys have a
    19-digit id, an id in quotes, an id beyond a long, a name that is a number or
    an object, or are no object at all."""
    k = F.col("o_orderkey")
    fields = dict(zip(("id", "name", "datetime", "department_id", "job_id"), employee_columns(), strict=True))

    def quoted(c: Column) -> Column:
        return F.concat(F.lit('"'), c, F.lit('"'))

    text = {n: c.cast("string") for n, c in fields.items()}
    token = {
        "id": F.when(k % TOKEN_LONG_ID == 0, (F.lit(LONG_ID) + k).cast("string")).when(k % TOKEN_TEXT_ID == 0, quoted(text["id"]))
               .when(k % TOKEN_HUGE_ID == 0, F.lit(HUGE_ID)).otherwise(text["id"]),
        "name": F.when(k % TOKEN_NUMBER_NAME == 0, F.lit("5")).when(k % TOKEN_OBJECT_NAME == 0, F.lit('{"first":"x"}')).otherwise(quoted(text["name"])),
        "datetime": quoted(text["datetime"]), "department_id": text["department_id"], "job_id": text["job_id"],
    }
    body = F.concat_ws(",", *[F.concat(F.lit(f'"{n}":'), t) for n, t in token.items()])
    return F.when(k % TOKEN_NO_OBJECT == 0, F.lit("[1]")).otherwise(F.concat(F.lit("{"), body, F.lit("}")))


def request_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request lines (column ``value``) over the driver's tables: every raw
    employee, nation, part and supplier as a record, every row kept.  A batch is
    a range of the table's unique key, so its records are bounded whatever the
    size of the table.  Each nation sends a department and a job that the raw layer may
    not have.  The regions add one line of each other kind: a null
    table, no batch id, no records, malformed text, and no ``data``."""
    def requests(name: str, table: str, batch: Column, key: str, record: Column) -> DataFrame:
        rows = testdata(spark, sf_dir, name).select(batch.alias("batch"), F.col(key).cast("bigint").alias("key"), record.alias("record"))
        lists = rows.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("key", "record"))).alias("r"))
        return lists.select(F.concat(F.lit(f'{{"table":"{table}","batch_id":"'), "batch", F.lit('","data":['),
                                     F.array_join("r.record", ","), F.lit("]}")).alias("value"))

    def block(prefix: str, key: str, size: int) -> Column:
        return F.concat(F.lit(prefix), F.floor(F.col(key) / size).cast("string"))

    wide = F.floor(F.col("o_orderkey") / ORDERS_WIDE)
    orders = F.when(wide % 4 == 3, block("orders-wide-", "o_orderkey", ORDERS_WIDE)).otherwise(block("orders-", "o_orderkey", ORDERS_BLOCK))
    regions = testdata(spark, sf_dir, "region").select(F.element_at(F.array(
        F.lit('{"table":null,"batch_id":"region-0","data":[{"id":1,"department":"North"},{"id":2,"department":"South"}]}'),
        F.lit('{"table":"departments","data":[{"id":3,"department":"East"}]}'),
        F.lit('{"table":"jobs","batch_id":"region-2","data":[]}'),
        F.lit('{"table":"jobs","batch_id":"region-3","data":[{"id":4,'),
        F.lit('{"table":"jobs","batch_id":"region-4"}')), (F.col("r_regionkey") % 5 + 1).cast("int")).alias("value"))
    new_department = F.to_json(F.struct((F.col("n_nationkey") + NEW_DEPARTMENTS).cast("bigint").alias("id"), F.concat(F.lit("new "), "n_name").alias("department")))
    new_job = F.to_json(F.struct((F.col("n_nationkey") + NEW_JOBS).cast("bigint").alias("id"), F.concat(F.lit("new "), "n_name").alias("job")))
    return (requests("orders", "employees", orders, "o_orderkey", employee_record())
            .unionByName(requests("nation", "departments", block("new-", "n_nationkey", 1), "n_nationkey", new_department))
            .unionByName(requests("nation", "jobs", block("new-", "n_nationkey", 1), "n_nationkey", new_job))
            .unionByName(requests("nation", "departments", block("region-", "n_regionkey", 1), "n_nationkey",
                                  F.to_json(F.struct(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("department")))))
            .unionByName(requests("part", "jobs", block("parts-", "p_partkey", PARTS_BLOCK), "p_partkey",
                                  F.to_json(F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("job")))))
            .unionByName(requests("supplier", "suppliers", block("suppliers-", "s_suppkey", SUPPLIERS_BLOCK), "s_suppkey",
                                  F.to_json(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))))
            .unionByName(regions))
