import csv
import hashlib
import io
import os
import uuid

import pytest

from layercake.functions import new_run
from layercake.operators import NoInputError
from layercake.plans import (bronze_from_tables, enrich_employees, evolve_visit_month,
                             export_departments, gold_report, land_mapped_csv,
                             latest_report, load_employee_table, load_user_service_table,
                             silver_drop, silver_hash)
from layercake.schemas import (COUNTRY_GEO, EMPLOYEE, LANDING, REVERSE_GEOCODE, USER_SERVICE,
                               USER_SERVICE_TABLE)
from layercake.sinks import ensure_database, ensure_table, partition_columns
from layercake.sources import read_csv, read_layer

from .conftest import plan_text, rows
from .test_operators import order_tables
from .test_sources import EMP_CSV, write


def sha(v):
    return hashlib.sha256(v.encode()).hexdigest()


@pytest.fixture
def db(spark, scratch):
    name = f"f_{uuid.uuid4().hex[:8]}"
    ensure_database(spark, name, f"{scratch}/{name}.db")
    return name


def test_medallion_chain(spark, scratch):
    items, orders, customers, products = order_tables(spark)
    # add the edge statuses and prices of the silver input
    items = items.unionByName(spark.createDataFrame(
        [(5, 10, 100, 1, 1.0, "shipped"), (6, 11, 101, 1, 1.0, "Returned"),
         (7, 11, 100, 1, 1.0, None)], items.schema))
    run = new_run()
    bronze = bronze_from_tables(items, orders, customers, products, scratch, run=run)
    assert "/orderitems/bronze/dt=" in bronze and "run_id=" in bronze
    dropped = silver_drop(spark, scratch, run.dt)
    assert "FirstName" not in read_layer(spark, scratch, "orderitems", "silver", run.dt,
                                         dropped.rsplit("run_id=", 1)[1]).columns
    silver_hash(spark, scratch, run.dt)                     # newest silver = the hashed one
    silver = read_layer(spark, scratch, "orderitems", "silver", run.dt)
    names = {r.OrderItemID: (r.FirstName, r.Email) for r in silver.collect()}
    assert names[1] == (sha("Ann"), sha("a@x")) and names[3] == (sha("Bo"), None)
    gold_report(spark, scratch, run.dt)
    rep = latest_report(spark, scratch, run.dt).first().asDict()
    # items 1..3 and 5..7 joined (4 has no order); prices from products: 5, 7.5, 5, 5, 7.5, 5
    assert rep == {"items_shipped_count": 1, "items_delivered_count": 1,
                   "items_pending_count": 1, "average_price": 35 / 6, "total_orders": 6}
    with pytest.raises(NoInputError):
        latest_report(spark, scratch, "1999-01-01")


def test_employee_enrichment_table(spark, scratch, db):
    emp = read_csv(spark, write(f"{scratch}/emp.csv", EMP_CSV), EMPLOYEE)
    geo = read_csv(spark, write(f"{scratch}/geo.csv",
                                "Country,Latitude,Longitude\nUnited States,38.0,-97.0\n"
                                "United Kingdom,55.4,-3.4\nAtlantis,,\n"), COUNTRY_GEO)
    enriched = enrich_employees(emp, geo)
    got = {r.employee_id: (r.nationality, r.hire_year, r.Latitude) for r in enriched.collect()}
    assert got == {1: ("United States", 2018, 38.0), 2: ("United Kingdom", 2019, 55.4),
                   3: ("Atlantis", None, None)}
    name = load_employee_table(spark, emp, geo, db)
    assert partition_columns(spark, name) == ["department", "job_title", "hire_year"]
    table = spark.table(name)
    assert table.columns[-3:] == ["department", "job_title", "hire_year"]
    assert rows(table, "employee_id", "latitude") == [(1, 38.0), (2, 55.4), (3, None)]
    load_employee_table(spark, emp.where("employee_id = 1"), geo, db)   # overwrite: all rows
    assert rows(spark.table(name), "employee_id") == [(1,)]
    n = export_departments(spark, name, f"{scratch}/departments")
    folders = [x for x in os.listdir(f"{scratch}/departments") if x.startswith("department=")]
    assert n == 1 and folders == ["department=Hydrology"]


def user_csv(rows_):
    buf = io.StringIO()
    w = csv.writer(buf)
    w.writerow(USER_SERVICE.names)
    for r in rows_:
        w.writerow([r.get(n, "") for n in USER_SERVICE.names])
    return buf.getvalue()


def test_user_service_table_and_evolution(spark, scratch, db):
    users = [
        {"Everest ID": "e1", "Visit Timestamp": "2024-09-05 10:00:00", "First Name": "Ann",
         "Middle Name": "Q", "Email": "", "Zipcode": "  10001 ", "City": "", "State": "NY",
         "SP - Meals": "1", "NA - Food Contacts": "pantry", "New User": "TRUE"},
        {"Everest ID": "e2", "Visit Timestamp": "bad", "First Name": "Bo",
         "Zipcode": "\t20002", "City": "Own", "New User": "yes"},
        {"Everest ID": "e3", "Visit Timestamp": "2023-01-02 00:00:00", "Zipcode": "30003"},
    ]
    u = read_csv(spark, write(f"{scratch}/users.csv", user_csv(users)), USER_SERVICE)
    z = read_csv(spark, write(f"{scratch}/zip.csv",
                              "Country,Country_Code,Geo_City,Geo_State,State_Code,Zipcode\n"
                              "US,US,New York,New York,NY,10001\nUS,US,Town A,Ohio,OH,30003\n"
                              "US,US,Town B,Ohio,OH,30003\n"), REVERSE_GEOCODE)
    name = load_user_service_table(spark, u, z, db)
    t = spark.table(name)
    assert len(t.columns) == 71 and sorted(t.columns) == sorted(USER_SERVICE_TABLE.names)
    got = {(r["Everest ID"], r["City"]): r for r in t.collect()}
    assert len(got) == 4                                      # e3 fans out over two zips
    e1 = got[("e1", "New York")]
    # an empty CSV cell reads as NULL, and NULL stays NULL through the hash
    assert e1["First Name"] == sha("Ann") and e1["Email"] is None and e1["Middle Name"] == "Q"
    assert (e1["State"], e1["State_Code"], e1["visit_year"], e1["visit_month"]) == \
        ("NY", "NY", 2024, "September")
    assert e1["New User"] is True and e1["SP - Meals"] == 1.0
    e2 = got[("e2", "Own")]
    assert e2["Zipcode"] == "\t20002" and e2["Country"] is None and e2["visit_year"] is None
    assert e2["New User"] is None and e2["Visit Timestamp"] is None
    assert {k[1] for k in got if k[0] == "e3"} == {"Town A", "Town B"}
    # the table already has visit_month as a column and a partition: evolution is a no-op
    assert evolve_visit_month(spark, name) == (False, False)


def test_mapped_landing_merge(spark, scratch, db):
    path = write(f"{scratch}/landing.csv",
                 "user id,name,created,x.y\n1,Ann,2024-01-02 03:04:05,a\n2,Bo,bad,b\n"
                 "2,Bo2,,c\n,Nil,2024-01-01 00:00:00,d\n")
    name = f"{db}.app_user_landing"
    ensure_table(spark, name, LANDING)
    mapping = {"user id": "id", "name": ["first_name", "last_name"],
               "created": ["created_at", "updated_at"], "x.y": "city"}
    assert land_mapped_csv(spark, path, mapping, name) == 4
    assert land_mapped_csv(spark, path, mapping, name) == 1      # only the NULL id again
    t = {(r.id, r.first_name): r for r in spark.table(name).collect()}
    assert len(t) == 4 and spark.table(name).count() == 5
    assert t[("1", "Ann")].created_at is not None and t[("2", "Bo")].created_at is None
    assert t[("1", "Ann")].city == "a" and t[("1", "Ann")].middle_name is None


def test_geo_dimension_keeps_every_key(spark, scratch):
    from layercake.plans import build_geo_dimension, country_keys, publish_geo_dimension
    from layercake.schemas import COUNTRY_GEO
    keys = country_keys(spark)
    cands = spark.createDataFrame(
        [("Peru", 2, -9.0, -75.0), ("Peru", 1, -10.0, -76.0), ("Chad", 1, 15.0, 19.0),
         ("Atlantis", 1, 0.0, 0.0)],
        "Country string, rank int, Latitude double, Longitude double")
    path = publish_geo_dimension(build_geo_dimension(keys, cands), f"{scratch}/geo")
    back = {r.Country: (r.Latitude, r.Longitude) for r in read_csv(spark, path, COUNTRY_GEO)
            .collect()}
    assert len(back) == 195 and "Atlantis" not in back
    assert back["Peru"] == (-10.0, -76.0) and back["Fiji"] == (None, None)


def test_user_service_load_shuffles_raw_visits(spark, scratch, db, monkeypatch):
    from layercake.plans import enrichment
    seen, real = [], enrichment.enrich_user_service
    monkeypatch.setattr(enrichment, "enrich_user_service", lambda v, z: real(seen.append(v) or v, z))
    at = {"Visit Timestamp": "2024-03-05 10:00:00"}
    users = [at | {"Everest ID": "1", "Email": "a@b", "Zipcode": " 1 "}, at | {"Everest ID": "2", "Zipcode": "9"}]
    u = read_csv(spark, write(f"{scratch}/users.csv", user_csv(users)), USER_SERVICE)
    z = spark.createDataFrame([(None, None, city, None, None, "1") for city in ("x", "y")], REVERSE_GEOCODE)
    name = load_user_service_table(spark, u, z, db)
    # hashes, dimension columns and fan-out come after the shuffle by partition
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_text(seen[0])
    got = spark.table(name).select("`Everest ID`", "Email", "City", "visit_year", "visit_month").collect()
    assert sorted(map(tuple, got)) == [("1", sha("a@b"), "x", 2024, "March"), ("1", sha("a@b"), "y", 2024, "March"),
                                       ("2", None, None, 2024, "March")]


def test_user_service_drop_is_compressed(spark):
    import glob

    from layercake.queries import q_user_service_csv_load
    from layercake.session import shared_root
    pattern = f"{shared_root(spark).removeprefix('file:')}/layercake/user_service_drop-*/part-*"
    before = set(glob.glob(pattern))
    q_user_service_csv_load(spark, "/root/testdata/sf0.001")
    new = set(glob.glob(pattern)) - before
    assert new and all(f.endswith(".csv.gz") for f in new)
