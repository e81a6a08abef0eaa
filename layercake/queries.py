"""Registered queries: each operator/flow of the toolkit run over the driver's
test tables, with an equivalent DuckDB SQL oracle.

Every query reads whole tables (no id subsets, no row caps; ``limit`` only
where top-n is the feature).  Edge values the tables lack (NULL and ``''``
names, malformed prices, padded keys, unmatched dimension keys) are made with
``CASE`` on ordinary column values, identically on both sides.  Queries that
exercise a sink write to a fresh folder under the shared checkpoint folder
and return what they read back.

Sections, in file order: J1/W1 star join; A1-A4 reports; F1/F2 hashing;
F3 J2 P4 recode + geo lookup; F7 F11 P8 J3 trimmed lookup (and its dedupe);
F4-F6 date parts; P9 F10 casts; K6 J4 merge; F8 P2 clients view; J5 K11
first match + geo publish; P1 P6 P7 A5 A7 A8 projections, filters, top-n;
S1 S2 S5 S6 scans; S4 K3-K5 table overwrite, K8 export, K9 K10 evolution;
W1-W5 medallion; W6 employee table and W6 -> W10 export; W7 and W7 + W11 on
the 71-column table; W8 mapped landing; then the registry (QUERIES, ORACLES).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import date_path, hash_columns, month_name, new_run, recode, year_of
from .operators import (StarKeys, apply_mapping, conform, distinct_values, drop_pii,
                        first_match, lookup, lookup_fill, order_items_view, preview,
                        status_report, top_n, where_equals)
from .functions.casts import cast_if_present
from .plans import (build_geo_dimension, clients_view, enrich_user_service,
                    publish_geo_dimension)
from .schemas import COUNTRY_GEO, EMPLOYEE, USER_SERVICE, USER_SERVICE_PII
from .plans.landing import land_mapped_csv, map_columns
from .plans.enrichment import (load_employee_csv, load_employee_table, load_user_service_csv,
                               load_user_service_table)
from .plans.tables import (evolve_visit_month, evolve_visit_month_in_steps,
                           export_departments)
from .plans.medallion import (bronze_from_tables, gold_report, latest_report, silver_drop,
                              silver_hash)
from .session import scratch_path
from .streaming import stream_silver
from .sinks import (add_column, ensure_database, ensure_table, evolve_partitioning,
                    export_by_key, export_generation, merge_insert_only, merge_snapshot,
                    overwrite_table, read_snapshot, write_layer, write_quarantine, write_report,
                    write_snapshot)
from .sources import (read_csv, read_csv_checked, read_days, read_layer, read_newest, read_table,
                      register_runs)
from .sources.layers import layer_root

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _scratch_db(spark: SparkSession, name: str) -> str:
    """A fresh database whose files live under the shared folder."""
    db = f"lc_{name}_{uuid.uuid4().hex[:10]}"
    ensure_database(spark, db, scratch_path(spark, db))
    return db


# ---------------------------------------------------------------- J1 / W1
STAR_COLUMNS = ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_linestatus",
                "o_orderdate", "o_totalprice", "c_name", "c_mktsegment", "p_name", "p_type",
                "p_retailprice")
STAR_KEYS = StarKeys(item_order="l_orderkey", order_key="o_orderkey",
                     order_customer="o_custkey", customer_key="c_custkey",
                     item_product="l_partkey", product_key="p_partkey")
STAR_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DoubleType()), T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_linestatus", T.StringType()),
    T.StructField("o_orderdate", T.TimestampNTZType()),
    T.StructField("o_totalprice", T.DoubleType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_mktsegment", T.StringType()), T.StructField("p_name", T.StringType()),
    T.StructField("p_type", T.StringType()), T.StructField("p_retailprice", T.DoubleType()),
])
STAR_SQL = ("select " + ", ".join(STAR_COLUMNS) + " from lineitem"
            " join orders on l_orderkey = o_orderkey"
            " join customer on o_custkey = c_custkey"
            " join part on l_partkey = p_partkey")


def star_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    return tuple(table(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "part"))


def q_star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_items_view(*star_tables(spark, sf_dir), STAR_COLUMNS, STAR_KEYS)


def q_drop_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    # case-insensitive name, plus a PII column this source does not have
    return drop_pii(q_star_join(spark, sf_dir), ["C_NAME", "Email"])


# ---------------------------------------------------------------- A1-A4
ORDER_STATUSES = {"items_shipped_count": "P", "items_delivered_count": "F",
                  "items_pending_count": "O"}


def q_status_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rep = status_report(table(spark, sf_dir, "orders"), "o_orderstatus", "o_totalprice",
                        ORDER_STATUSES)
    return rep.withColumn("average_price", F.round("average_price", 4))


STATUS_REPORT_SQL = """
select count(*) filter (where o_orderstatus = 'P') as items_shipped_count,
       count(*) filter (where o_orderstatus = 'F') as items_delivered_count,
       count(*) filter (where o_orderstatus = 'O') as items_pending_count,
       round(avg(o_totalprice), 4) as average_price,
       count(*) as total_orders
from orders"""

EVENT_STATUSES = {"items_shipped_count": "purchase", "items_delivered_count": "click",
                  "items_pending_count": "signup"}


def priced_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with a text price: malformed for errors, empty for views."""
    e = table(spark, sf_dir, "events")
    text = (F.when(F.col("event_type") == "error", F.lit("n/a"))
            .when(F.col("event_type") == "view", F.lit(""))
            .otherwise(F.col("value").cast("string")))
    return e.select("event_id", "event_type", text.alias("price"))


def q_status_report_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rep = status_report(priced_events(spark, sf_dir), "event_type", "price", EVENT_STATUSES)
    return rep.withColumn("average_price", F.round("average_price", 6))


STATUS_MALFORMED_SQL = """
select count(*) filter (where event_type = 'purchase') as items_shipped_count,
       count(*) filter (where event_type = 'click') as items_delivered_count,
       count(*) filter (where event_type = 'signup') as items_pending_count,
       round(avg(try_cast(price as double)), 6) as average_price,
       count(*) as total_orders
from (select event_type,
             case when event_type = 'error' then 'n/a' when event_type = 'view' then ''
                  else cast(value as varchar) end as price
      from events) t"""


# ---------------------------------------------------------------- F1 / F2
def blanked_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    name = (F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
            .when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(""))
            .otherwise(F.col("c_name")))
    return c.select("c_custkey", name.alias("c_name"))


BLANKED_SQL = """(select c_custkey,
        case when c_acctbal < 0 then null when c_mktsegment = 'AUTOMOBILE' then ''
             else c_name end as v
 from customer) t"""


def q_hash_pii_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_columns(blanked_names(spark, sf_dir), ["c_name"], blank="hash")


def q_hash_pii_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_columns(blanked_names(spark, sf_dir), ["C_Name"], blank="null")


# ---------------------------------------------------------------- F3 J2 P4
NATION_RECODE = {"NATION_0": "United States", "NATION_1": "United Kingdom"}
RECODE_SQL = ("case {c} when 'NATION_0' then 'United States' "
              "when 'NATION_1' then 'United Kingdom' else {c} end")


def geo_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country -> coordinates, derived from nation/region; MIDDLE EAST unresolved."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    known = n.join(r, n.n_regionkey == r.r_regionkey).where(F.col("r_name") != "MIDDLE EAST")
    return known.select(recode(F.col("n_name"), NATION_RECODE).alias("Country"),
                        F.col("n_regionkey").cast("double").alias("Latitude"),
                        F.col("n_nationkey").cast("double").alias("Longitude"))


def q_recode_geo_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    people = c.join(n, c.c_nationkey == n.n_nationkey).select(
        "c_custkey", "c_mktsegment", F.col("n_name").alias("nationality"))
    people = people.withColumn("nationality", recode(F.col("nationality"), NATION_RECODE))
    return lookup(people, geo_dimension(spark, sf_dir), "nationality", "Country")


RECODE_GEO_SQL = f"""
with people as (
  select c_custkey, c_mktsegment, {RECODE_SQL.format(c='n_name')} as nationality
  from customer join nation on c_nationkey = n_nationkey),
geo as (
  select {RECODE_SQL.format(c='n_name')} as Country, cast(n_regionkey as double) as Latitude,
         cast(n_nationkey as double) as Longitude
  from nation join region on n_regionkey = r_regionkey where r_name <> 'MIDDLE EAST')
select c_custkey, c_mktsegment, nationality, Latitude, Longitude
from people left join geo on nationality = Country"""


# ---------------------------------------------------------------- F7 F11 P8 J3
def padded_zip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    key = F.col("c_nationkey").cast("string")
    zipcode = (F.when(F.col("c_mktsegment") == "FURNITURE", F.concat(F.lit("\t"), key))
               .otherwise(F.concat(F.lit("  "), key, F.lit(" "))))
    city = (F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
            .when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(""))
            .otherwise(F.col("c_mktsegment")))
    return c.select("c_custkey", zipcode.alias("Zipcode"), city.alias("City"))


def zip_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """zip -> city from nation; AMERICA missing (unmatched), ASIA twice (fan-out)."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    nr = n.join(r, n.n_regionkey == r.r_regionkey)
    main = nr.where(F.col("r_name") != "AMERICA").select(
        F.col("n_nationkey").cast("string").alias("Zipcode"), F.col("n_name").alias("Geo_City"))
    extra = nr.where(F.col("r_name") == "ASIA").select(
        F.col("n_nationkey").cast("string").alias("Zipcode"),
        F.concat("n_name", F.lit("-alt")).alias("Geo_City"))
    return main.unionByName(extra)


def q_trimmed_key_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lookup_fill(padded_zip_rows(spark, sf_dir), zip_dimension(spark, sf_dir),
                      "Zipcode", "Zipcode", {"City": "Geo_City"})
    return out.select("c_custkey", "Zipcode", "City", "Geo_City")


TRIMMED_SQL = """
with u as (
  select c_custkey,
         trim(case when c_mktsegment = 'FURNITURE' then chr(9) || cast(c_nationkey as varchar)
                   else '  ' || cast(c_nationkey as varchar) || ' ' end) as Zipcode,
         case when c_acctbal < 0 then null when c_mktsegment = 'AUTOMOBILE' then ''
              else c_mktsegment end as City
  from customer),
z as (
  select cast(n_nationkey as varchar) as Zipcode, n_name as Geo_City
  from nation join region on n_regionkey = r_regionkey where r_name <> 'AMERICA'
  union all
  select cast(n_nationkey as varchar), n_name || '-alt'
  from nation join region on n_regionkey = r_regionkey where r_name = 'ASIA')
select u.c_custkey, u.Zipcode,
       case when u.City is null or u.City = '' then z.Geo_City else u.City end as City,
       z.Geo_City
from u left join z on u.Zipcode = z.Zipcode"""


def q_trimmed_key_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 with ``dedupe_by``: the ASIA zips listed twice keep their first
    city, so no row fans out."""
    out = lookup_fill(padded_zip_rows(spark, sf_dir), zip_dimension(spark, sf_dir),
                      "Zipcode", "Zipcode", {"City": "Geo_City"}, dedupe_by=["Geo_City"])
    return out.select("c_custkey", "Zipcode", "City", "Geo_City")


TRIMMED_DEDUPE_SQL = TRIMMED_SQL.replace(
    "from u left join z on u.Zipcode = z.Zipcode",
    "from u left join (select Zipcode, min(Geo_City) as Geo_City from z group by Zipcode) z"
    " on u.Zipcode = z.Zipcode")


# ---------------------------------------------------------------- F4-F6
def q_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", year_of(d).alias("order_year"), month_name(d).alias("order_month"),
        date_path(d).alias("order_path"))


DATE_PARTS_SQL = """
select o_orderkey, cast(year(o_orderdate) as int) as order_year,
       monthname(o_orderdate) as order_month, strftime(o_orderdate, '%Y/%B/%d') as order_path
from orders"""


# ---------------------------------------------------------------- P9 F10
def q_cast_if_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    text = F.when(F.col("event_type") == "error", F.lit("bad")).otherwise(
        F.col("ts").cast("string"))
    landed = e.select("event_id", text.alias("created_at"))
    # updated_at is absent here, so only created_at is cast
    return cast_if_present(landed, {"created_at": "timestamp_ntz",
                                    "updated_at": "timestamp_ntz"})


CAST_IF_PRESENT_SQL = """
select event_id,
       try_cast(case when event_type = 'error' then 'bad' else cast(ts as varchar) end
                as timestamp) as created_at
from events"""


# ---------------------------------------------------------------- K6 J4
MERGE_TARGET_SQL = ("select c_custkey as id, c_name as name from customer "
                    "where c_mktsegment = 'BUILDING'")


def merge_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer (NULL key when the balance is negative) plus a second
    copy of the MACHINERY customers (duplicate keys)."""
    c = table(spark, sf_dir, "customer")
    main = c.select(F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(F.col("c_custkey"))
                    .cast("bigint").alias("id"),
                    F.concat("c_name", F.lit("!")).alias("name"))
    dupes = c.where(F.col("c_mktsegment") == "MACHINERY").select(
        F.col("c_custkey").alias("id"), F.concat("c_name", F.lit("?")).alias("name"))
    return main.unionByName(dupes)


def q_insert_only_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = _scratch_db(spark, "merge")
    name = f"{db}.landing"
    ensure_table(spark, name, T.StructType([T.StructField("id", T.LongType()),
                                            T.StructField("name", T.StringType())]))
    c = table(spark, sf_dir, "customer")
    overwrite_table(where_equals(c, "c_mktsegment", "BUILDING")
                    .select(F.col("c_name").alias("name"), F.col("c_custkey").alias("id")), name)
    merge_insert_only(merge_source(spark, sf_dir), name, ["id"])
    return read_table(spark, name)


INSERT_ONLY_MERGE_SQL = f"""
with t as ({MERGE_TARGET_SQL}),
s as (select case when c_acctbal < 0 then null else c_custkey end as id, c_name || '!' as name
      from customer
      union all
      select c_custkey, c_name || '?' from customer where c_mktsegment = 'MACHINERY')
select id, name from t
union all
select id, name from s where not exists (select 1 from t where t.id = s.id)"""


# ---------------------------------------------------------------- F8 P2
def landing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(
        r, n.n_regionkey == r.r_regionkey, "left")
    return j.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("first_name"),
        F.when(F.col("c_acctbal") < 0, F.lit("")).alias("middle_name"),
        F.col("n_name").alias("last_name"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(""))
         .otherwise(F.col("c_mktsegment")).alias("city"),
        F.when(F.col("n_name") == "NATION_3", F.lit(None).cast("string"))
         .otherwise(F.col("n_name")).alias("state"),
        F.col("r_name").alias("country"),
        F.col("c_nationkey").cast("string").alias("zipcode"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"))


def q_export_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clients_view(landing_rows(spark, sf_dir))


EXPORT_PROJECTION_SQL = """
select c_custkey as id, c_name as first_name,
       case when c_acctbal < 0 then '' end as middle_name,
       n_name as last_name, cast(c_nationkey as varchar) as zip_code,
       concat_ws(', ', case when c_mktsegment = 'AUTOMOBILE' then '' else c_mktsegment end,
                 nullif(n_name, 'NATION_3'), r_name, cast(c_nationkey as varchar)) as address,
       cast(null as timestamp) as created_at, cast(null as timestamp) as updated_at
from customer left join nation on c_nationkey = n_nationkey
              left join region on n_regionkey = r_regionkey"""


# ---------------------------------------------------------------- J5
def q_first_match_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    out = first_match(keys, table(spark, sf_dir, "supplier"), "n_nationkey",
                      order_by=["s_suppkey"], values=["s_name", "s_acctbal"],
                      candidate_key="s_nationkey")
    return out.select("n_name", "s_name", "s_acctbal")


FIRST_MATCH_SQL = """
select n_name, s_name, s_acctbal
from nation left join (
  select s_nationkey, s_name, s_acctbal,
         row_number() over (partition by s_nationkey order by s_suppkey) as rn
  from supplier) x on n_nationkey = s_nationkey and rn = 1"""


def q_geo_dimension_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation names as the key list, suppliers as ranked candidates; the
    dimension is published as CSV and read back with its declared schema."""
    n, s = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    keys = n.select(F.col("n_name").alias("Country"))
    candidates = s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("n_name").alias("Country"), F.col("s_suppkey").alias("rank"),
        F.col("s_acctbal").alias("Latitude"), F.col("s_suppkey").cast("double").alias("Longitude"))
    path = publish_geo_dimension(build_geo_dimension(keys, candidates),
                                 scratch_path(spark, "geo_dimension"))
    return read_csv(spark, path, COUNTRY_GEO)


GEO_DIMENSION_SQL = """
select n_name as Country, s_acctbal as Latitude, cast(s_suppkey as double) as Longitude
from nation left join (
  select s_nationkey, s_suppkey, s_acctbal,
         row_number() over (partition by s_nationkey order by s_suppkey) as rn
  from supplier) x on n_nationkey = s_nationkey and rn = 1"""


# ---------------------------------------------------------------- P1 P6 P7 A5 A7 A8
def q_column_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_mapping(table(spark, sf_dir, "customer"), {
        "c_custkey": "id", "c_name": ["first_name", "display_name"], "c_mktsegment": "segment"})


COLUMN_MAPPING_SQL = ("select c_custkey as id, c_name as first_name, c_name as display_name, "
                      "c_mktsegment as segment from customer")

CONFORM_ORDER = ("c_mktsegment", "c_name", "c_custkey", "c_acctbal", "c_nationkey")


def q_conform_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    shouting = c.select(*[F.col(n).alias(n.upper()) for n in c.columns])
    return conform(shouting, CONFORM_ORDER)


def q_equality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return where_equals(table(spark, sf_dir, "customer"), "c_mktsegment", "BUILDING")


def q_distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(table(spark, sf_dir, "customer"), "c_mktsegment")


def q_top_one_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_n(table(spark, sf_dir, "events"),
                 [F.col("ts").desc(), F.col("event_id").desc()], 1)


def q_preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(table(spark, sf_dir, "customer"), [F.col("c_custkey")], 10)


# ---------------------------------------------------------------- S1 S2 S5 S6
ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()),
    T.StructField("o_orderpriority", T.StringType()),
])


def q_csv_typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv_typed")
    table(spark, sf_dir, "orders").write.option("header", "true").csv(path)
    return read_csv(spark, path, ORDERS_SCHEMA)


def q_csv_string_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv_string")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey",
                                                "c_mktsegment")
    c.write.option("header", "true").csv(path)
    return read_csv(spark, path)


CSV_STRING_SQL = ("select cast(c_custkey as varchar) as c_custkey, c_name, "
                  "cast(c_nationkey as varchar) as c_nationkey, c_mktsegment from customer")

DROP_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def q_newest_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders dropped as foreign CSV files, one per priority, one after another in nested folders;
    the newest file is read (S5: no run folder, no manifest)."""
    prefix = scratch_path(spark, "foreign_drops")
    orders = table(spark, sf_dir, "orders")
    for k, priority in enumerate(DROP_PRIORITIES):  # a drop is one file, as its sender made it
        (where_equals(orders, "o_orderpriority", priority).coalesce(1)
         .write.option("header", "true").csv(f"{prefix}/{k}/orders"))
    return read_newest(spark, prefix, "csv", ORDERS_SCHEMA, "*.csv")


def q_newest_run_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per priority, published one after another; the newest committed run is read."""
    root = scratch_path(spark, "drops")
    orders = table(spark, sf_dir, "orders")
    for priority in DROP_PRIORITIES:
        run = new_run()
        write_layer(where_equals(orders, "o_orderpriority", priority), root, "orders",
                    "landing", run, dt="2024-09-05")
    return read_layer(spark, root, "orders", "landing", "2024-09-05", schema=ORDERS_SCHEMA)


def q_newest_run_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 over a range of days: orders as one run per month, then every month up to 1996 published
    again without its open orders; for 1994 to 1997 the newest committed run of each is read."""
    root = scratch_path(spark, "days")
    orders = table(spark, sf_dir, "orders").withColumn(
        "dt", F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM-dd"))
    again = orders.where((F.col("dt") < "1997-01-01") & (F.col("o_orderstatus") != "O"))
    for part in (orders, again):
        (part.withColumn("run_id", F.lit(new_run().run_id)).hint("rebalance", "dt")
         .write.mode("append").partitionBy("dt", "run_id").parquet(layer_root(root, "orders", "bronze")))
        register_runs(spark, root, "orders", "bronze", require_success=False)
    return read_days(spark, root, "orders", "bronze", first="1994-01-01", last="1997-12-31",
                     schema=ORDERS_SCHEMA).select(ORDERS_SCHEMA.fieldNames())


NEWEST_RUN_PER_DAY_SQL = """
select * from orders where o_orderdate >= timestamp '1994-01-01' and o_orderdate < timestamp '1998-01-01'
and (o_orderdate >= timestamp '1997-01-01' or o_orderstatus <> 'O'
     or date_trunc('month', o_orderdate) not in
        (select date_trunc('month', o_orderdate) from orders where o_orderstatus <> 'O'))"""


NEWEST_FILE_SQL = f"select * from orders where o_orderpriority = '{DROP_PRIORITIES[-1]}'"

LAYER_DAY = "1997-03-01"


def q_layer_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders written as a monthly layer in one job; one month read back."""
    root = scratch_path(spark, "layer")
    run = new_run()
    orders = table(spark, sf_dir, "orders")
    (orders.withColumns({"dt": F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM-dd"),
                         "run_id": F.lit(run.run_id)})
     .hint("rebalance", "dt")
     .write.partitionBy("dt", "run_id").parquet(
         layer_root(root, "orders", "bronze")))
    register_runs(spark, root, "orders", "bronze", require_success=False)
    return read_layer(spark, root, "orders", "bronze", LAYER_DAY, schema=ORDERS_SCHEMA)


def q_layer_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts of documents and conversations through a published layer and back."""
    root, run = scratch_path(spark, "layer_text"), new_run()
    texts = table(spark, sf_dir, "documents").selectExpr(
        "'documents' AS origin", "doc_id AS id", "cast(null AS bigint) AS turn", "text").unionByName(
        table(spark, sf_dir, "conversations").selectExpr(
            "'conversations' AS origin", "cast(conv_id AS bigint) AS id", "cast(turn AS bigint) AS turn", "text"))
    write_layer(texts, root, "texts", "bronze", run)
    return read_layer(spark, root, "texts", "bronze", run.dt, run.run_id)


LAYER_TEXT_SQL = """
select 'documents' as origin, doc_id as id, cast(null as bigint) as turn, text from documents
union all
select 'conversations', cast(conv_id as bigint), cast(turn as bigint), text from conversations
"""

LAYER_SCAN_SQL = (f"select * from orders where date_trunc('month', o_orderdate) = "
                  f"timestamp '{LAYER_DAY}'")


# ---------------------------------------------------------------- S4 K3-K5
def q_table_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = _scratch_db(spark, "overwrite")
    name = f"{db}.orders_by_status"
    schema = T.StructType([f for f in ORDERS_SCHEMA.fields if f.name != "o_orderstatus"]
                          + [T.StructField("o_orderstatus", T.StringType())])
    ensure_table(spark, name, schema, ["o_orderstatus"])
    orders = table(spark, sf_dir, "orders")
    # first content: every order, prices doubled; then replaced by the open/finished ones
    overwrite_table(orders.withColumn("o_totalprice", F.col("o_totalprice") * 2), name)
    overwrite_table(orders.where(F.col("o_orderstatus") != "P"), name)
    return read_table(spark, name)


TABLE_OVERWRITE_SQL = "select * from orders where o_orderstatus <> 'P'"


def q_export_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "export")
    c = table(spark, sf_dir, "customer")
    export_by_key(c, "c_mktsegment", path)
    data_schema = T.StructType([f for f in c.schema.fields if f.name != "c_mktsegment"])
    back = read_csv(spark, path, data_schema.add("c_mktsegment", T.StringType()))
    return back.select(*c.columns)


# ---------------------------------------------------------------- K5 K6 K8: versioned datasets
def q_snapshot_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 from a query over the dataset itself: orders as version 1; version 2 is made from it
    without the pending orders and with doubled prices; version 3 from version 2, partitions kept."""
    root = scratch_path(spark, "snapshot")
    write_snapshot(table(spark, sf_dir, "orders"), root, partition_by=["o_orderstatus"])
    for _ in range(2):
        rows = read_snapshot(spark, root)
        write_snapshot(rows.where(F.col("o_orderstatus") != "P").withColumn("o_totalprice", F.col("o_totalprice") * 2),
                       root, partition_by=["o_orderstatus"], least_rows=1)
    return read_snapshot(spark, root)


SNAPSHOT_OVERWRITE_SQL = """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 * 2 as o_totalprice, o_orderdate, o_orderpriority
from orders where o_orderstatus <> 'P'"""


def q_indexed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 against the bucketed key index: the open orders are there; all orders of a customer
    range of nations come in twice, with NULL keys for the pending ones; then all orders."""
    db, root = _scratch_db(spark, "indexed"), scratch_path(spark, "indexed_merge")
    index = f"{db}.orders_keys"

    def marked(df: DataFrame, origin: str) -> DataFrame:
        return df.select("o_orderkey", "o_orderpriority", F.lit(origin).alias("origin"))
    orders = table(spark, sf_dir, "orders")
    write_snapshot(marked(orders.where("o_orderstatus = 'O'"), "base"), root)
    urgent = orders.where("o_orderpriority = '1-URGENT'").withColumn(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")))
    merge_snapshot(marked(urgent.unionByName(urgent), "urgent"), root, ["o_orderkey"], index=index)
    merge_snapshot(marked(orders, "rest"), root, ["o_orderkey"], index=index)
    return read_snapshot(spark, root)


INDEXED_MERGE_SQL = """
select o_orderkey, o_orderpriority, 'base' as origin from orders where o_orderstatus = 'O'
union all
select case when o_orderstatus <> 'P' then o_orderkey end, o_orderpriority, 'urgent'
from orders, (values (1), (2)) twice(n) where o_orderpriority = '1-URGENT' and o_orderstatus <> 'O'
union all
select o_orderkey, o_orderpriority, 'rest' from orders
where o_orderstatus <> 'O' and (o_orderpriority <> '1-URGENT' or o_orderstatus = 'P')"""


def q_export_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8 as a whole: customers per segment, then a second generation without the BUILDING ones;
    what readers find is the second, the removed key's files included."""
    root = scratch_path(spark, "generations")
    c = table(spark, sf_dir, "customer")
    export_generation(c, "c_mktsegment", root)
    export_generation(c.where("c_mktsegment <> 'BUILDING'"), "c_mktsegment", root)
    return read_snapshot(spark, root)


EXPORT_GENERATION_SQL = "select * from customer where c_mktsegment <> 'BUILDING'"


def q_evolution_in_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W11 as a resumable rewrite of a table that really changes: orders partitioned by status
    get a month partition, a status per step; the first call stops after one step, the second
    goes on with what is left."""
    db = _scratch_db(spark, "steps")
    name = f"{db}.orders_evolving"
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()),
                           T.StructField("o_orderdate", T.TimestampNTZType()),
                           T.StructField("o_orderstatus", T.StringType())])
    ensure_table(spark, name, schema, ["o_orderstatus"])
    overwrite_table(table(spark, sf_dir, "orders"), name)
    for steps in (1, None):
        evolve_visit_month_in_steps(spark, name, field="order_month", timestamp="o_orderdate",
                                    per_step=1, max_steps=steps)
    return read_table(spark, name).select("o_orderkey", "o_orderdate", "o_orderstatus", "order_month")


def q_csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 with malformed rows apart: customers as a foreign drop with a newline and quotes in
    their names and text for negative balances; matching rows and quarantined records together."""
    path = scratch_path(spark, "csv_quarantine")
    c = table(spark, sf_dir, "customer")
    c.select("c_custkey", F.concat("c_name", F.lit(' "a"\nb')).alias("c_name"),
             F.when(F.col("c_acctbal") < 0, "n/a").otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal")
             ).write.options(header="true", escape='"').csv(path)
    rows, bad = read_csv_checked(spark, path, "c_custkey long, c_name string, c_acctbal double",
                                 quoted_newlines=True)
    root, run = scratch_path(spark, "quarantine"), new_run()
    write_quarantine(bad, root, "customers", run)
    record = F.regexp_replace("record", r"\s+$", "")
    return rows.withColumn("record", F.lit(None).cast("string")).unionByName(
        read_layer(spark, root, "customers", "quarantine", run.dt).select(record.alias("record")),
        allowMissingColumns=True)


CSV_QUARANTINE_SQL = """
select case when c_acctbal >= 0 then c_custkey end as c_custkey,
       case when c_acctbal >= 0 then c_name || ' "a"' || chr(10) || 'b' end as c_name,
       case when c_acctbal >= 0 then c_acctbal end as c_acctbal,
       case when c_acctbal < 0 then c_custkey || ',"' || c_name || ' ""a""' || chr(10) || 'b",n/a' end as record
from customer"""


def q_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = _scratch_db(spark, "evolve")
    name = f"{db}.orders_evolving"
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()),
                           T.StructField("o_orderdate", T.TimestampNTZType()),
                           T.StructField("o_orderstatus", T.StringType())])
    ensure_table(spark, name, schema, ["o_orderstatus"])
    overwrite_table(table(spark, sf_dir, "orders"), name)
    add_column(spark, name, "order_month", "string")
    add_column(spark, name, "order_month", "string")  # idempotent
    evolve_partitioning(spark, name, "order_month", "date_format(o_orderdate, 'MMMM')")
    return read_table(spark, name).select("o_orderkey", "o_orderdate", "o_orderstatus",
                                          "order_month")


SCHEMA_EVOLUTION_SQL = ("select o_orderkey, o_orderdate, o_orderstatus, "
                        "monthname(o_orderdate) as order_month from orders")


# ---------------------------------------------------------------- medallion W1-W5
def q_report_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "gold")
    run = new_run()
    rep = status_report(table(spark, sf_dir, "orders"), "o_orderstatus", "o_totalprice",
                        ORDER_STATUSES)
    write_report(rep, root, "orders", run)
    back = latest_report(spark, root, run.dt, topic="orders")
    return back.withColumn("average_price", F.round("average_price", 4))


def _medallion_root(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    root = scratch_path(spark, "medallion")
    run = new_run()
    bronze_from_tables(*star_tables(spark, sf_dir), root, run=run, columns=STAR_COLUMNS,
                       keys=STAR_KEYS)
    silver_hash(spark, root, run.dt, pii=["c_name"])
    return root, run.dt


def q_medallion_silver_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, dt = _medallion_root(spark, sf_dir)
    return read_layer(spark, root, "orderitems", "silver", dt, schema=STAR_SCHEMA)


def q_medallion_silver_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 -> W2: bronze from the star join, then the silver run with PII dropped."""
    root = scratch_path(spark, "medallion_drop")
    run = new_run()
    bronze_from_tables(*star_tables(spark, sf_dir), root, run=run, columns=STAR_COLUMNS,
                       keys=STAR_KEYS)
    silver_drop(spark, root, run.dt, pii=["C_NAME", "Email"])
    kept = T.StructType([f for f in STAR_SCHEMA.fields if f.name != "c_name"])
    return read_layer(spark, root, "orderitems", "silver", run.dt, schema=kept)


def q_medallion_silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bronze from the star join, then the streaming silver job drains it."""
    root = scratch_path(spark, "medallion_stream")
    bronze_from_tables(*star_tables(spark, sf_dir), root, run=new_run(), columns=STAR_COLUMNS,
                       keys=STAR_KEYS)
    query = stream_silver(spark, root, "orderitems", STAR_SCHEMA, f"{root}/_checkpoints/silver",
                          pii=["c_name"])
    query.awaitTermination()
    return spark.read.parquet(layer_root(root, "orderitems", "silver_stream")).select(
        *STAR_COLUMNS)


MEDALLION_SILVER_SQL = STAR_SQL.replace(
    "c_name,", "case when c_name <> '' then sha256(c_name) end as c_name,")

LINE_STATUSES = {"items_shipped_count": "F", "items_delivered_count": "D",
                 "items_pending_count": "O"}


def q_medallion_gold_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, dt = _medallion_root(spark, sf_dir)
    gold_report(spark, root, dt, status="l_linestatus", price="p_retailprice",
                statuses=LINE_STATUSES)
    return latest_report(spark, root, dt).withColumn("average_price",
                                                     F.round("average_price", 4))


MEDALLION_GOLD_SQL = f"""
select count(*) filter (where l_linestatus = 'F') as items_shipped_count,
       count(*) filter (where l_linestatus = 'D') as items_delivered_count,
       count(*) filter (where l_linestatus = 'O') as items_pending_count,
       round(avg(p_retailprice), 4) as average_price,
       count(*) as total_orders
from ({STAR_SQL}) s"""


# ---------------------------------------------------------------- W6 (whole flow)
def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer x nation x region as employee rows: segment -> department (two
    renamed 'R&D' and 'Sales/Ops', which need escaping as folder names),
    region -> job title, nation -> nationality ('USA'/'UK' for two nations,
    recoded by the flow), no hire date for a negative balance."""
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    seg, nk = F.col("c_mktsegment"), F.col("c_nationkey")
    return j.select(
        F.col("c_custkey").cast("int").alias("employee_id"), F.col("c_name").alias("first_name"),
        F.col("n_name").alias("last_name"), F.lower("c_name").alias("email"),
        F.when(seg == "MACHINERY", "R&D").when(seg == "HOUSEHOLD", "Sales/Ops").otherwise(seg)
         .alias("department"),
        F.col("r_name").alias("job_title"),
        F.floor("c_acctbal").cast("int").alias("salary"),
        F.when(F.col("c_acctbal") >= 0,
               F.make_date(F.lit(2010) + F.floor(nk / 5).cast("int"),
                           F.lit(1) + F.floor(nk / 3).cast("int"), F.lit(1) + nk))
         .alias("hire_date"),
        F.when(F.col("n_name") == "NATION_0", "USA").when(F.col("n_name") == "NATION_1", "UK")
         .otherwise(F.col("n_name")).alias("nationality"),
        (F.lit(20) + nk).alias("age"), F.lit(None).cast("string").alias("gender"),
        F.lit(None).cast("string").alias("education_level"),
        (F.col("n_regionkey") + 1).alias("performance_score"),
        F.lit(None).cast("int").alias("manager_id"))


def q_employee_table_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recode -> hire year -> geo lookup -> table partitioned by
    department/job title/hire year, overwritten by name; read back."""
    db = _scratch_db(spark, "employees")
    name = load_employee_table(spark, employees(spark, sf_dir), geo_dimension(spark, sf_dir), db)
    return read_table(spark, name)


def q_department_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W6 then W10: the employee table is loaded, then exported as one CSV
    dataset per department in one job (``by_department=R&D``,
    ``by_department=Sales%2FOps`` ...); the bodies of all files are read back."""
    db = _scratch_db(spark, "departments")
    name = load_employee_table(spark, employees(spark, sf_dir), geo_dimension(spark, sf_dir), db)
    path = scratch_path(spark, "department_export")
    export_departments(spark, name, path, keep_key=True)
    # recursive lookup takes nothing from folder names: the files hold every column
    return read_csv(spark, path, spark.table(name).schema, recursiveFileLookup="true")


EMPLOYEE_TABLE_SQL = f"""
with e as (
  select cast(c_custkey as int) as employee_id, c_name as first_name, n_name as last_name,
         lower(c_name) as email,
         case c_mktsegment when 'MACHINERY' then 'R&D' when 'HOUSEHOLD' then 'Sales/Ops'
                           else c_mktsegment end as department,
         r_name as job_title, cast(floor(c_acctbal) as int) as salary,
         case when c_acctbal >= 0
              then make_date(2010 + c_nationkey // 5, 1 + c_nationkey // 3, 1 + c_nationkey)
         end as hire_date,
         {RECODE_SQL.format(c='n_name')} as nationality,
         20 + c_nationkey as age, cast(null as varchar) as gender,
         cast(null as varchar) as education_level, n_regionkey + 1 as performance_score,
         cast(null as int) as manager_id
  from customer join nation on c_nationkey = n_nationkey
                join region on n_regionkey = r_regionkey),
geo as (
  select {RECODE_SQL.format(c='n_name')} as Country, cast(n_regionkey as double) as Latitude,
         cast(n_nationkey as double) as Longitude
  from nation join region on n_regionkey = r_regionkey where r_name <> 'MIDDLE EAST')
select e.*, cast(year(hire_date) as int) as hire_year, Latitude as latitude,
       Longitude as longitude
from e left join geo on e.nationality = geo.Country"""


# ---------------------------------------------------------------- W7
def visit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("visit_ts"),
        F.col("o_orderpriority").alias("first_name"),
        F.when(F.col("o_orderstatus") == "F", F.lit(None).cast("string"))
         .otherwise(F.col("o_custkey").cast("string")).alias("Email"),
        F.when(F.col("o_orderstatus") == "F", F.lit(None).cast("string"))
         .when(F.col("o_orderstatus") == "O", F.lit(""))
         .otherwise(F.col("o_orderpriority")).alias("City"),
        F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" ")).alias("Zipcode"))


def customer_zips(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)
    return c.select(F.col("c_custkey").cast("string").alias("Zipcode"),
                    F.col("c_mktsegment").alias("Geo_City"),
                    F.col("c_nationkey").cast("string").alias("Country_Code"))


VISIT_OUTPUT = ("id", "visit_ts", "first_name", "Email", "City", "Zipcode", "Country_Code",
                "visit_year", "visit_month")


def q_user_service_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_user_service(visit_rows(spark, sf_dir), customer_zips(spark, sf_dir),
                               pii=["first_name", "Email"], visit_ts="visit_ts",
                               fill={"City": "Geo_City"}, output=VISIT_OUTPUT)


USER_SERVICE_SQL = """
with u as (
  select o_orderkey as id, o_orderdate as visit_ts, o_orderpriority as first_name,
         case when o_orderstatus = 'F' then null else cast(o_custkey as varchar) end as Email,
         case when o_orderstatus = 'F' then null when o_orderstatus = 'O' then ''
              else o_orderpriority end as City,
         trim(' ' || cast(o_custkey as varchar) || ' ') as Zipcode
  from orders),
z as (
  select cast(c_custkey as varchar) as Zipcode, c_mktsegment as Geo_City,
         cast(c_nationkey as varchar) as Country_Code
  from customer where c_acctbal >= 0)
select u.id, u.visit_ts, sha256(u.first_name) as first_name, sha256(u.Email) as Email,
       case when u.City is null or u.City = '' then z.Geo_City else u.City end as City,
       u.Zipcode, z.Country_Code, cast(year(u.visit_ts) as int) as visit_year,
       monthname(u.visit_ts) as visit_month
from u left join z on u.Zipcode = z.Zipcode"""


# ---------------------------------------------------------------- W7 + W11 (whole table)
def _visit_columns() -> list[tuple[str, Callable[[], Column], str]]:
    """(column, Spark expression builder, DuckDB expression) for the 66
    user-service columns, derived from orders x customer: names, e-mail, phone
    and birth date from customer/order values (NULL and '' edge values by
    order status), a padded or tab-prefixed zip from the nation key, every
    service/needs double as a multiple of the order total, free-text entries
    from the priority, and ``New User`` for open orders."""
    st, bal, seg = (lambda: F.col("o_orderstatus")), (lambda: F.col("c_acctbal")), \
        (lambda: F.col("c_mktsegment"))

    def nk() -> Column:
        return F.col("c_nationkey").cast("string")

    def null() -> Column:
        return F.lit(None).cast("string")

    fixed = {
        "Everest ID": (lambda: F.col("o_orderkey").cast("string"), "cast(o_orderkey as varchar)"),
        "Visit Timestamp": (lambda: F.col("o_orderdate").cast("timestamp"), "o_orderdate"),
        "First Name": (lambda: F.col("c_name"), "c_name"),
        "Middle Name": (null, "cast(null as varchar)"),
        "Last Name": (lambda: F.col("o_orderpriority"), "o_orderpriority"),
        "Preferred Name": (null, "cast(null as varchar)"),
        "Email": (lambda: F.when(st() == "F", null()).when(st() == "P", F.lit(""))
                  .otherwise(F.lower("c_name")),
                  "case when o_orderstatus = 'F' then null when o_orderstatus = 'P' then '' "
                  "else lower(c_name) end"),
        "Phone": (nk, "cast(c_nationkey as varchar)"),
        "Address 1": (seg, "c_mktsegment"),
        "Address 2": (null, "cast(null as varchar)"),
        "City": (lambda: F.when(st() == "F", null()).when(st() == "O", F.lit(""))
                 .otherwise(F.col("o_orderpriority")),
                 "case when o_orderstatus = 'F' then null when o_orderstatus = 'O' then '' "
                 "else o_orderpriority end"),
        "State": (lambda: F.when(bal() < 0, null()).otherwise(seg()),
                  "case when c_acctbal < 0 then null else c_mktsegment end"),
        "Zipcode": (lambda: F.when(seg() == "FURNITURE", F.concat(F.lit("\t"), nk()))
                    .otherwise(F.concat(F.lit("  "), nk(), F.lit(" "))),
                    "case when c_mktsegment = 'FURNITURE' "
                    "then chr(9) || cast(c_nationkey as varchar)"
                    " else '  ' || cast(c_nationkey as varchar) || ' ' end"),
        "Date of Birth": (lambda: F.col("o_orderdate").cast("date").cast("string"),
                          "cast(cast(o_orderdate as date) as varchar)"),
        "New User": (lambda: st() == "O", "o_orderstatus = 'O'"),
    }
    out = []
    for i, f in enumerate(USER_SERVICE.fields):
        if f.name in fixed:
            out.append((f.name, *fixed[f.name]))
        elif isinstance(f.dataType, T.DoubleType):
            out.append((f.name, lambda k=i + 1: F.col("o_totalprice") * k,
                        f"o_totalprice * {i + 1}"))
        else:
            out.append((f.name, lambda: F.when(st() == "O", F.col("o_orderpriority")),
                        "case when o_orderstatus = 'O' then o_orderpriority end"))
    return out


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.select(*[build().alias(n) for n, build, _ in _visit_columns()])


def zip_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reverse-geocode dimension from ``nation`` alone (a plain scan, so the
    planner sizes it as one): region 3's zips missing (unmatched), region 0's
    listed twice (fan-out)."""
    n = table(spark, sf_dir, "nation")

    def rows(df: DataFrame, suffix: str) -> DataFrame:
        region = F.col("n_regionkey").cast("string")
        return df.select(F.concat(F.lit("REGION_"), region).alias("Country"),
                         region.alias("Country_Code"),
                         F.concat("n_name", F.lit(suffix)).alias("Geo_City"),
                         F.concat(F.lit("STATE_"), region).alias("Geo_State"),
                         F.concat(F.lit("S"), F.col("n_nationkey").cast("string"))
                         .alias("State_Code"),
                         F.col("n_nationkey").cast("string").alias("Zipcode"))
    return rows(n.where(F.col("n_regionkey") != 3), "").unionByName(
        rows(n.where(F.col("n_regionkey") == 0), "-2"))


def q_user_service_table_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7 then W11 on the 71-column user-service table: hash the five PII
    columns, visit year and month name, zip lookup on the trimmed zip with
    blank City/State filled, table partitioned by visit year/month and
    overwritten by name; W11 then finds visit_month already a column and a
    partition (no-op).  ``Visit Timestamp`` is returned as timestamp_ntz so
    the values do not depend on the session time zone."""
    db = _scratch_db(spark, "user_service")
    name = load_user_service_table(spark, visits(spark, sf_dir), zip_table(spark, sf_dir), db)
    evolve_visit_month(spark, name)
    back = read_table(spark, name)
    return back.withColumn("Visit Timestamp", F.col("`Visit Timestamp`").cast("timestamp_ntz"))


def _user_service_sql() -> str:
    def q(name: str) -> str:
        return '"' + name.replace('"', '""') + '"'
    cols = _visit_columns()
    inner = ",\n         ".join(f"{sql} as {q(n)}" for n, _, sql in cols)
    outer = []
    for n, _, _ in cols:
        if n in USER_SERVICE_PII:
            outer.append(f"sha256(u.{q(n)}) as {q(n)}")
        elif n in ("City", "State"):
            geo = "z.Geo_City" if n == "City" else "z.Geo_State"
            outer.append(f"case when u.{q(n)} is null or u.{q(n)} = '' then {geo} "
                         f"else u.{q(n)} end as {q(n)}")
        elif n == "Zipcode":
            outer.append('trim(u."Zipcode") as "Zipcode"')
        else:
            outer.append(f"u.{q(n)}")
    z = """select 'REGION_' || cast(n_regionkey as varchar) as Country,
         cast(n_regionkey as varchar) as Country_Code, n_name || '{s}' as Geo_City,
         'STATE_' || cast(n_regionkey as varchar) as Geo_State,
         'S' || cast(n_nationkey as varchar) as State_Code,
         cast(n_nationkey as varchar) as Zipcode
  from nation where n_regionkey {w}"""
    kept = z.format(s="", w="<> 3")
    again = z.format(s="-2", w="= 0")
    return (f"with u as (\n  select {inner}\n"
            "  from orders join customer on o_custkey = c_custkey),\n"
            f"z as (\n  {kept}\n  union all\n  {again})\n"
            f"select {', '.join(outer)},\n"
            "       z.Country, z.Country_Code, z.State_Code,\n"
            '       cast(year(u."Visit Timestamp") as int) as visit_year,\n'
            '       monthname(u."Visit Timestamp") as visit_month\n'
            'from u left join z on trim(u."Zipcode") = z.Zipcode')


USER_SERVICE_TABLE_SQL = _user_service_sql()


# ---------------------------------------------------------------- W6 W7 from their files
#: A sender's CSV that keeps padding and the difference of a quoted cell.
DROP_CSV = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
VISITS_PER_FILE = 100_000


def _dropped(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.options(**DROP_CSV).csv(path)
    return path


def q_employee_csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W6 from CSV: employees and the geo dimension are files; malformed employees (none here)
    would go to the quarantine."""
    db = _scratch_db(spark, "employee_csv")
    people = _dropped(employees(spark, sf_dir).select(EMPLOYEE.fieldNames()), "employee_drop")
    geo = _dropped(geo_dimension(spark, sf_dir), "geo_drop")
    name = load_employee_csv(spark, people, geo, db, most_malformed=0,
                             quarantine=scratch_path(spark, "employee_quarantine"))
    return read_table(spark, name)


def q_user_service_csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7 from CSV: the 66 columns and the zip dimension are files.  An empty cell reads as NULL,
    so an empty e-mail is not hashed here."""
    db = _scratch_db(spark, "user_service_csv")
    users = scratch_path(spark, "user_service_drop")
    # 66 columns of text: compressed, and in files that one task each can read
    (visits(spark, sf_dir).write.options(**DROP_CSV, compression="gzip", maxRecordsPerFile=VISITS_PER_FILE)
     .csv(users))
    zips = _dropped(zip_table(spark, sf_dir), "zip_drop")
    name = load_user_service_csv(spark, users, zips, db, most_malformed=0,
                                 quarantine=scratch_path(spark, "user_service_quarantine"))
    return read_table(spark, name).withColumn("Visit Timestamp", F.col("`Visit Timestamp`").cast("timestamp_ntz"))


USER_SERVICE_CSV_SQL = USER_SERVICE_TABLE_SQL.replace("when o_orderstatus = 'P' then '' ", "when o_orderstatus = 'P' then null ")


# ---------------------------------------------------------------- W8
LANDING_MAPPING = {"user.id": "id", "name": ["first_name", "display_name"],
                   "created": ["created_at", "updated_at"]}
LANDING_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("first_name", T.StringType()),
    T.StructField("display_name", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])


def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer as an all-string drop, with a dotted header and bad timestamps."""
    c = table(spark, sf_dir, "customer")
    day = F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0")
    created = F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("n/a")).otherwise(
        F.concat(F.lit("2024-01-"), day, F.lit(" 00:00:00")))
    return c.select(F.col("c_custkey").cast("string").alias("user.id"),
                    F.col("c_name").alias("name"), created.alias("created"))


def q_mapped_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = _scratch_db(spark, "landing")
    name = f"{db}.app_user_landing"
    ensure_table(spark, name, LANDING_SCHEMA)
    c = table(spark, sf_dir, "customer")
    overwrite_table(where_equals(c, "c_mktsegment", "BUILDING").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.concat("c_name", F.lit(" (old)")).alias("first_name"),
        F.col("c_name").alias("display_name"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at")), name)
    mapped = map_columns(raw_landing(spark, sf_dir), LANDING_MAPPING,
                         {"created_at": "timestamp_ntz", "updated_at": "timestamp_ntz"})
    merge_insert_only(mapped, name, ["id"])
    return read_table(spark, name)


def q_mapped_csv_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W8 end to end: the drop is an all-string CSV with a dotted header, read
    without a schema, mapped, cast where present and merged insert-only."""
    db = _scratch_db(spark, "csv_landing")
    name = f"{db}.app_user_landing"
    ensure_table(spark, name, LANDING_SCHEMA)
    c = table(spark, sf_dir, "customer")
    overwrite_table(where_equals(c, "c_mktsegment", "BUILDING").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.concat("c_name", F.lit(" (old)")).alias("first_name"),
        F.col("c_name").alias("display_name"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at")), name)
    drop = scratch_path(spark, "landing_drop")
    raw_landing(spark, sf_dir).write.option("header", "true").csv(drop)
    land_mapped_csv(spark, drop, LANDING_MAPPING, name,
                    casts={"created_at": "timestamp_ntz", "updated_at": "timestamp_ntz"})
    return read_table(spark, name)


MAPPED_LANDING_SQL = """
with s as (
  select cast(c_custkey as varchar) as id, c_name as first_name, c_name as display_name,
         try_cast(case when c_mktsegment = 'AUTOMOBILE' then 'n/a'
                       else '2024-01-' || lpad(cast(c_nationkey + 1 as varchar), 2, '0')
                            || ' 00:00:00' end as timestamp) as created_at
  from customer),
t as (
  select cast(c_custkey as varchar) as id, c_name || ' (old)' as first_name,
         c_name as display_name, cast(null as timestamp) as created_at
  from customer where c_mktsegment = 'BUILDING')
select id, first_name, display_name, created_at, created_at as updated_at from t
union all
select id, first_name, display_name, created_at, created_at as updated_at from s
where not exists (select 1 from t where t.id = s.id)"""


# ---------------------------------------------------------------- registry
QUERIES: dict[str, Query] = {
    "star_join": q_star_join,
    "status_report": q_status_report,
    "status_report_malformed": q_status_report_malformed,
    "drop_pii": q_drop_pii,
    "hash_pii_null": q_hash_pii_null,
    "hash_pii_blank": q_hash_pii_blank,
    "recode_geo_enrich": q_recode_geo_enrich,
    "trimmed_key_fallback": q_trimmed_key_fallback,
    "trimmed_key_dedupe": q_trimmed_key_dedupe,
    "date_parts": q_date_parts,
    "cast_if_present": q_cast_if_present,
    "insert_only_merge": q_insert_only_merge,
    "export_projection": q_export_projection,
    "first_match_lookup": q_first_match_lookup,
    "geo_dimension_publish": q_geo_dimension_publish,
    "column_mapping": q_column_mapping,
    "conform_projection": q_conform_projection,
    "equality_filter": q_equality_filter,
    "distinct_keys": q_distinct_keys,
    "top_one_newest": q_top_one_newest,
    "preview_rows": q_preview_rows,
    "layer_text_roundtrip": q_layer_text_roundtrip,
    "csv_typed_scan": q_csv_typed_scan,
    "csv_string_scan": q_csv_string_scan,
    "newest_file_scan": q_newest_file_scan,
    "newest_run_scan": q_newest_run_scan,
    "newest_run_per_day": q_newest_run_per_day,
    "layer_scan": q_layer_scan,
    "table_overwrite": q_table_overwrite,
    "export_by_key": q_export_by_key,
    "snapshot_overwrite": q_snapshot_overwrite,
    "indexed_merge": q_indexed_merge,
    "export_generation": q_export_generation,
    "evolution_in_steps": q_evolution_in_steps,
    "csv_quarantine": q_csv_quarantine,
    "employee_csv_load": q_employee_csv_load,
    "user_service_csv_load": q_user_service_csv_load,
    "schema_evolution": q_schema_evolution,
    "report_roundtrip": q_report_roundtrip,
    "medallion_silver_hash": q_medallion_silver_hash,
    "medallion_gold_report": q_medallion_gold_report,
    "medallion_silver_stream": q_medallion_silver_stream,
    "medallion_silver_drop": q_medallion_silver_drop,
    "employee_table_load": q_employee_table_load,
    "department_export": q_department_export,
    "user_service_enrich": q_user_service_enrich,
    "user_service_table_load": q_user_service_table_load,
    "mapped_landing": q_mapped_landing,
    "mapped_csv_landing": q_mapped_csv_landing,
}

ORACLES: dict[str, str] = {
    "star_join": STAR_SQL,
    "status_report": STATUS_REPORT_SQL,
    "status_report_malformed": STATUS_MALFORMED_SQL,
    "drop_pii": STAR_SQL.replace(" c_name,", ""),
    "hash_pii_null": f"select c_custkey, sha256(v) as c_name from {BLANKED_SQL}",
    "hash_pii_blank": ("select c_custkey, case when v <> '' then sha256(v) end as c_name "
                       f"from {BLANKED_SQL}"),
    "recode_geo_enrich": RECODE_GEO_SQL,
    "trimmed_key_fallback": TRIMMED_SQL,
    "trimmed_key_dedupe": TRIMMED_DEDUPE_SQL,
    "date_parts": DATE_PARTS_SQL,
    "cast_if_present": CAST_IF_PRESENT_SQL,
    "insert_only_merge": INSERT_ONLY_MERGE_SQL,
    "export_projection": EXPORT_PROJECTION_SQL,
    "first_match_lookup": FIRST_MATCH_SQL,
    "geo_dimension_publish": GEO_DIMENSION_SQL,
    "column_mapping": COLUMN_MAPPING_SQL,
    "conform_projection": f"select {', '.join(CONFORM_ORDER)} from customer",
    "equality_filter": "select * from customer where c_mktsegment = 'BUILDING'",
    "distinct_keys": "select distinct c_mktsegment from customer",
    "top_one_newest": "select * from events order by ts desc, event_id desc limit 1",
    "preview_rows": "select * from customer order by c_custkey limit 10",
    "layer_text_roundtrip": LAYER_TEXT_SQL,
    "csv_typed_scan": "select * from orders",
    "csv_string_scan": CSV_STRING_SQL,
    "newest_file_scan": NEWEST_FILE_SQL,
    "newest_run_scan": NEWEST_FILE_SQL,
    "newest_run_per_day": NEWEST_RUN_PER_DAY_SQL,
    "layer_scan": LAYER_SCAN_SQL,
    "table_overwrite": TABLE_OVERWRITE_SQL.replace(
        "select *", "select o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority, "
                    "o_orderstatus"),
    "export_by_key": "select * from customer",
    "snapshot_overwrite": SNAPSHOT_OVERWRITE_SQL,
    "indexed_merge": INDEXED_MERGE_SQL,
    "export_generation": EXPORT_GENERATION_SQL,
    "evolution_in_steps": SCHEMA_EVOLUTION_SQL,
    "csv_quarantine": CSV_QUARANTINE_SQL,
    "employee_csv_load": EMPLOYEE_TABLE_SQL,
    "user_service_csv_load": USER_SERVICE_CSV_SQL,
    "schema_evolution": SCHEMA_EVOLUTION_SQL,
    "report_roundtrip": STATUS_REPORT_SQL,
    "medallion_silver_hash": MEDALLION_SILVER_SQL,
    "medallion_gold_report": MEDALLION_GOLD_SQL,
    "medallion_silver_stream": MEDALLION_SILVER_SQL,
    "medallion_silver_drop": STAR_SQL.replace(" c_name,", ""),
    "employee_table_load": EMPLOYEE_TABLE_SQL,
    "department_export": EMPLOYEE_TABLE_SQL,
    "user_service_enrich": USER_SERVICE_SQL,
    "user_service_table_load": USER_SERVICE_TABLE_SQL,
    "mapped_landing": MAPPED_LANDING_SQL,
    "mapped_csv_landing": MAPPED_LANDING_SQL,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Star join -> PII hashed (blank -> NULL) -> one-pass status report."""
    items = hash_columns(q_star_join(spark, sf_dir), ["c_name"], blank="null")
    return status_report(items, "l_linestatus", "p_retailprice", LINE_STATUSES)
