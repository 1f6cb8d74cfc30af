"""Staging, quarantine and marts on a small hand-made HR fixture."""

from pyspark.sql import functions as F

from tiermill import schemas
from tiermill.operators import marts, staging

EMPLOYEES = [
    # id, name, datetime, department_id, job_id
    (1, "  Ana ", "2021-01-10T10:00:00Z", 1, 1.0),
    (2, "Bo", "2021-02-10T10:00:00Z", 1, 1.0),
    (3, "Cy", "2021-05-10T10:00:00Z", 1, 2.0),
    (4, "Di", "2021-08-10T10:00:00Z", 2, 2.0),
    (5, "Ed", "2021-11-10T10:00:00Z", 3, 1.0),
    (6, "Fa", "2021-11-11T10:00:00Z", 4, 1.0),   # dept 4 shares dept 3's name
    (7, "Gu", "2022-03-01T00:00:00Z", 1, 1.0),   # other year
    (8, "   ", "2021-03-01T00:00:00Z", 1, 1.0),  # blank name: staged as '' AND quarantined
    (9, None, "2021-03-01T00:00:00Z", 1, 1.0),
    (None, "Ha", "2021-03-01T00:00:00Z", 1, 1.0),
    (11, "Io", "202", 1, 1.0),
    (12, "Ju", None, 1, 1.0),
    (13, "Ka", "2021-03-01T00:00:00Z", None, 1.0),
    (14, "Lu", "2021-03-01T00:00:00Z", 1, None),
    (15, "Mo", "2021-06-01T00:00:00Z", 9, 96.5),  # orphan dept; job rounds to 97
]
DEPARTMENTS = [(1, "Sales"), (2, "Ops"), (3, "Legal"), (4, "Legal")]
JOBS = [(1, "Clerk"), (2, "Lead")]


def frames(spark):
    raw = spark.createDataFrame(EMPLOYEES, schemas.RAW_EMPLOYEES)
    return (raw, spark.createDataFrame(DEPARTMENTS, schemas.RAW_DEPARTMENTS),
            spark.createDataFrame(JOBS, schemas.RAW_JOBS))


def test_staging_and_quarantine(spark):
    raw, _, _ = frames(spark)
    stg = staging.staging_employees(raw, as_of="2024-01-01 00:00:00")
    q = staging.quarantine_employees(raw, as_of="2024-01-01 00:00:00")
    assert sorted(r.id for r in stg.collect()) == [1, 2, 3, 4, 5, 6, 7, 8, 15]
    row1 = stg.filter("id = 1").first()
    assert row1.name == "Ana" and row1.datetime == "2021-01-10T10:00:00Z" and row1.job_id == 1
    assert stg.filter("id = 8").first().name == ""
    assert stg.filter("id = 15").first().job_id == 97
    reasons = {r.id: r.rejection_reason for r in q.collect()}
    assert reasons == {
        8: "Missing or empty Name", 9: "Missing or empty Name", None: "Missing ID",
        11: "Invalid datetime format: 202", 12: "Invalid datetime format: NULL",
        13: "Missing Department ID", 14: "Missing Job ID"}
    # raw = staging + quarantine - overlap (the blank name is in both)
    assert raw.count() == stg.count() + q.count() - 1
    strict = staging.staging_employees(raw, blank_name_to_staging=False)
    assert 8 not in [r.id for r in strict.collect()]


def test_quarterly_hires(spark):
    raw, dep, job = frames(spark)
    stg = staging.staging_employees(raw)
    got = {(r.department, r.job): (r.Q1, r.Q2, r.Q3, r.Q4, r.total_hires)
           for r in marts.quarterly_hires(stg, dep, job, 2021).collect()}
    assert got == {
        ("Sales", "Clerk"): (3, 0, 0, 0, 3),   # ids 1, 2 and the blank-named 8
        ("Sales", "Lead"): (0, 1, 0, 0, 1),
        ("Ops", "Lead"): (0, 0, 1, 0, 1),
        ("Legal", "Clerk"): (0, 0, 0, 2, 2),   # two department ids, one name
    }
    for r in got.values():
        assert sum(r[:4]) == r[4]
    two = marts.quarterly_hires_two_level(stg, dep, job, 2021)
    assert sorted(map(tuple, two.collect())) == sorted(
        map(tuple, marts.quarterly_hires(stg, dep, job, 2021).collect()))
    assert marts.quarterly_hires(stg, dep, job, 1999).count() == 0


def test_dept_performance(spark):
    raw, dep, _ = frames(spark)
    stg = staging.staging_employees(raw)
    rows = marts.dept_performance(stg, dep, 2021).orderBy(F.desc("hired")).collect()
    # hires in 2021: Sales 4 (1, 2, 3, 8), Ops 1, Legal(3) 1, Legal(4) 1 -> mean 1.75
    assert [(r.id, r.department, r.hired, r.mean_hired, r.diff_from_mean) for r in rows] == [
        (1, "Sales", 4, 1.75, 2.25)]


def test_department_equal_to_mean_is_out(spark):
    raw = spark.createDataFrame([(1, "A", "2021-01-01", 1, 1.0), (2, "B", "2021-01-01", 2, 1.0)],
                                schemas.RAW_EMPLOYEES)
    dep = spark.createDataFrame([(1, "X"), (2, "Y")], schemas.RAW_DEPARTMENTS)
    assert marts.dept_performance(staging.staging_employees(raw), dep, 2021).count() == 0


def test_layer_schemas(spark):
    raw, _, _ = frames(spark)
    stg = staging.staging_employees(raw)
    assert [(f.name, f.dataType) for f in stg.schema] == \
        [(f.name, f.dataType) for f in schemas.STAGING_EMPLOYEES]
    q = staging.quarantine_employees(raw)
    assert [(f.name, f.dataType) for f in q.schema] == \
        [(f.name, f.dataType) for f in schemas.QUARANTINE_EMPLOYEES]


def test_marts_on_another_star_schema(spark):
    """The marts take their key / name / time columns as parameters."""
    fact = spark.createDataFrame(
        [(1, 10, "2021-02-01 00:00:00"), (1, 10, "2021-05-01 00:00:00"), (2, 10, "2021-05-01 00:00:00")],
        "store long, product long, sold string").withColumn("sold_at", F.col("sold").cast("timestamp"))
    stores = spark.createDataFrame([(1, "North"), (2, "South")], "sid long, sname string")
    products = spark.createDataFrame([(10, "Tea")], "pid long, pname string")
    q = marts.quarterly_hires(fact, stores, products, 2021, time_col="sold_at",
                              fact_keys=("store", "product"), dim_keys=("sid", "pid"),
                              names=("sname", "pname"))
    assert sorted(map(tuple, q.collect())) == [("North", "Tea", 1, 1, 0, 0, 2), ("South", "Tea", 0, 1, 0, 0, 1)]
    d = marts.dept_performance(fact, stores, 2021, time_col="sold_at", fact_key="store",
                               dim_key="sid", name="sname").first()
    assert (d.id, d.department, d.hired, d.mean_hired) == (1, "North", 2, 1.5)
