"""Queries over reading, filtering, filling, joining and de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from breachline.functions.text import is_missing, recode
from breachline.functions.times import duration_days
from breachline.operators import cleaning as C
from breachline.operators import dashboards as D
from breachline.operators import joins as J
from breachline.operators import profiles as P
from breachline.plans.fixture import (
    JUDGED,
    REQUESTS,
    SILVER,
    SPLITS,
    judged,
    requests,
    rounded,
    silver,
    splits,
    table,
)
from breachline.plans.registry import query
from breachline.settings import cut, work_path
from breachline.sources.lookup import inline_lookup
from breachline.sources.readers import read_layer, read_splits
from breachline.sources.writers import write_splits


@query(
    f"""WITH {JUDGED}
SELECT borough, count(*) AS requests,
       coalesce(CAST(sum(CAST(CASE WHEN penalty_charged > 0 THEN penalty_charged END AS DECIMAL(18,2))) AS DOUBLE), 0) AS penalty_usd,
       round(count_if(target = 1) * 100.0 / count(*), 6) AS breach_pct,
       count(DISTINCT agency) AS agencies
FROM judged GROUP BY borough"""
)
def breach_by_borough(spark, sf_dir):
    return rounded(D.kpi_summary(judged(spark, sf_dir), ["borough"], agency="agency"))


@query("SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean_value FROM events GROUP BY event_type")
def read_layer_summary(spark, sf_dir):
    events = read_layer(spark, f"{sf_dir}/events.parquet")
    return rounded(
        events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"))
    )


@query(
    f"""WITH {SPLITS}
SELECT split, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct
FROM splits GROUP BY split"""
)
def read_splits_sizes(spark, sf_dir):
    """Write the splits as one partitioned table, read them back and report their sizes."""
    base = work_path(spark, "splits")
    write_splits(splits(spark, sf_dir), base)
    return rounded(D.split_sizes(read_splits(spark, base)))


@query(
    """WITH lookup(agency_key, sla_days, penalty_amount_usd) AS (VALUES
 ('DOT', CAST(5.0 AS DOUBLE), CAST(83448 AS DOUBLE)), ('NYPD', 0.33, 64277), ('DSNY', 5.0, 79301),
 ('DPR', 8.0, 68022), ('DOB', 40.0, 106907), ('DEP', 0.25, 75757), ('HPD', 12.0, 252387),
 ('DOE', 36.0, 119316), ('DHS', 0.04, 74717), ('DOHMH', 14.0, 74717), ('TLC', 14.0, 74717),
 ('DCA', 28.0, 74717), ('DOITT', 3.0, 74717))
SELECT o_orderpriority AS agency, count(*) AS n, count(sla_days) AS with_contract,
       max(penalty_amount_usd) AS penalty_amount_usd
FROM (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'NYPD' WHEN '2-HIGH' THEN 'HPD'
             WHEN '3-MEDIUM' THEN 'DOITT' ELSE 'EDC' END AS o_orderpriority FROM orders)
LEFT JOIN lookup ON o_orderpriority = agency_key GROUP BY 1"""
)
def inline_contracts_joined(spark, sf_dir):
    names = {"1-URGENT": "NYPD", "2-HIGH": "HPD", "3-MEDIUM": "DOITT"}
    orders = table(spark, sf_dir, "orders").select(
        recode(F.col("o_orderpriority"), names, "EDC").alias("agency")
    )
    return (
        J.lookup_join(orders, inline_lookup(spark), "agency")
        .groupBy("agency")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("sla_days").alias("with_contract"),
            F.max("penalty_amount_usd").alias("penalty_amount_usd"),
        )
    )


@query("SELECT o_orderpriority AS prioridad, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1")
def project_and_rename(spark, sf_dir):
    df = C.drop_columns(table(spark, sf_dir, "orders"), ["o_orderdate", "absent_column"])
    df = C.rename_columns(df, {"o_orderpriority": " O Orderpriority "})
    df = C.select_ordered(C.normalize_names(df), ["o_orderpriority", "o_orderkey"])
    return D.legend_counts(df, "o_orderpriority").select(F.col("o_orderpriority").alias("prioridad"), "n")


@query(
    f"""WITH {REQUESTS}
SELECT 'latitude' AS columna, count(*) AS n FROM requests WHERE latitude IS NULL
UNION ALL SELECT 'kept', count(*) FROM requests"""
)
def drop_sparse_columns_effect(spark, sf_dir):
    """Columns dropped for holding more than 3.3 % NULLs but fewer than the kept ones."""
    df = requests(spark, sf_dir, ["latitude", "longitude", "quantity"])
    kept = C.validate_columns(P.drop_sparse_columns(df, 3.0), ["latitude"])
    gone = df.where(F.col(kept[0]).isNull() if kept else F.lit(False))
    return gone.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(kept[0] if kept else "none").alias("columna"), "n"
    ).unionByName(df.agg(F.count(F.lit(1)).alias("n")).select(F.lit("kept").alias("columna"), "n"))


@query(
    f"""WITH {REQUESTS}
SELECT count_if(location_type IS NULL OR location_type IN ('', 'Unspecified')) AS missing_place,
       count_if(incident_zip IS NULL) AS missing_zip FROM requests"""
)
def missing_values(spark, sf_dir):
    df = requests(spark, sf_dir, ["location_type", "incident_zip"])
    types = {f.name: f.dataType for f in df.schema}
    return df.agg(
        F.count_if(is_missing(F.col("location_type"), types["location_type"])).alias("missing_place"),
        F.count_if(is_missing(F.col("incident_zip"), types["incident_zip"])).alias("missing_zip"),
    )


@query(
    f"""WITH {REQUESTS}
SELECT agency, count(*) AS n, round(avg(days), 6) AS mean_days FROM (
  SELECT agency, created_ts, (epoch(closed_ts) - epoch(created_ts)) / 86400.0 AS days FROM requests)
WHERE days >= 0.001 AND created_ts IS NOT NULL GROUP BY agency"""
)
def valid_durations(spark, sf_dir):
    df = requests(spark, sf_dir, ["created_ts", "closed_ts", "agency"])
    df = df.withColumn("days", duration_days(F.col("closed_ts"), F.col("created_ts")))
    kept = C.filter_valid_duration(df, "days", 0.001, "created_ts")
    return rounded(kept.groupBy("agency").agg(F.count(F.lit(1)).alias("n"), F.avg("days").alias("mean_days")))


@query(
    f"""WITH {REQUESTS}
SELECT count(*) AS rows_before, count_if(ok) AS rows_after, count(*) - count_if(ok) AS rows_removed,
       round((count(*) - count_if(ok)) * 100.0 / count(*), 6) AS pct_removed
FROM (SELECT coalesce(closed_ts >= created_ts, closed_ts IS NULL) AS ok FROM requests)"""
)
def chronology_audit(spark, sf_dir):
    df = requests(spark, sf_dir, ["created_ts", "closed_ts"])
    return rounded(P.audit_step(df, C.chronological("created_ts", "closed_ts")))


@query(
    f"""WITH {REQUESTS}
SELECT agency, count(*) AS n FROM requests
WHERE coalesce(closed_ts >= created_ts, closed_ts IS NULL) AND agency NOT IN ('3-MEDIUM') GROUP BY agency"""
)
def chronology_without_agency(spark, sf_dir):
    df = requests(spark, sf_dir, ["created_ts", "closed_ts", "agency"])
    df = C.exclude_values(C.filter_chronology(df, "created_ts", "closed_ts"), "agency", ["3-MEDIUM"])
    return D.legend_counts(df, "agency").drop("color")


@query(
    f"""WITH {REQUESTS}
SELECT count(*) AS rows_before, count(latitude) AS rows_after,
       count(*) - count(latitude) AS rows_removed,
       round((count(*) - count(latitude)) * 100.0 / count(*), 6) AS pct_removed FROM requests"""
)
def missing_coordinates_audit(spark, sf_dir):
    df = requests(spark, sf_dir, ["latitude", "longitude"])
    return rounded(P.audit_step(df, F.col("latitude").isNotNull() & F.col("longitude").isNotNull()))


@query(
    f"""WITH {REQUESTS}
SELECT borough, count(*) AS n FROM requests
WHERE latitude IS NOT NULL AND incident_zip IS NOT NULL GROUP BY borough"""
)
def rows_without_gaps(spark, sf_dir):
    df = requests(spark, sf_dir, ["borough", "latitude", "incident_zip"])
    kept = C.drop_missing(df, ["latitude", "incident_zip"])
    return kept.groupBy("borough").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {REQUESTS}
SELECT CAST(coalesce(incident_zip, -1) AS BIGINT) AS incident_zip,
       trim(upper(coalesce(CAST(closed_ts AS DATE)::VARCHAR, 'unknown_day'))) AS closed_day,
       count(*) AS n
FROM requests GROUP BY 1, 2"""
)
def filled_and_normalized(spark, sf_dir):
    df = requests(spark, sf_dir, ["closed_ts", "incident_zip"]).select(
        "incident_zip", F.to_date("closed_ts").alias("closed_day")
    )
    df = C.fill_tokens(df, {"closed_day": "unknown_day", "absent": "x"})
    df = C.fill_numeric(df, {"incident_zip": -1})
    df = C.normalize_categories(df, ["closed_day", "absent"])
    return df.groupBy("incident_zip", "closed_day").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT s_nationkey, TRY_CAST(substr(s_name, 10) AS BIGINT) AS number,
       CAST(s_acctbal AS VARCHAR) IS NOT NULL AS known, TRY_CAST(s_name AS DOUBLE) AS bad
FROM supplier"""
)
def cast_dirty_text(spark, sf_dir):
    df = table(spark, sf_dir, "supplier").select(
        "s_nationkey",
        F.substring("s_name", 10, 100).alias("number"),
        F.col("s_acctbal").isNotNull().alias("known"),
        F.col("s_name").alias("bad"),
    )
    return C.cast_columns(df, {"number": "bigint", "bad": "double"})


@query(
    f"""WITH {JUDGED}
SELECT complaint_type, count(*) AS n FROM judged
WHERE target = 1 AND agency IN ('1-URGENT', '2-HIGH') AND borough = 'ASIA' GROUP BY 1"""
)
def map_filters(spark, sf_dir):
    df = C.apply_filters(
        judged(spark, sf_dir), target=1, agency=["1-URGENT", "2-HIGH"], complaint_type=[], borough="ASIA"
    )
    return df.groupBy("complaint_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {REQUESTS}
SELECT 'silver' AS capa, CAST(2024 AS INTEGER) AS version, CASE returnflag WHEN 'R' THEN 'devuelto'
       WHEN 'A' THEN 'aceptado' ELSE 'otro' END AS estado, count(*) AS n FROM requests GROUP BY 3"""
)
def constants_and_recoded(spark, sf_dir):
    df = requests(spark, sf_dir, ["returnflag"]).select(
        recode(F.col("returnflag"), {"R": "devuelto", "A": "aceptado"}, "otro").alias("estado")
    )
    counted = df.groupBy("estado").agg(F.count(F.lit(1)).alias("n"))
    return C.add_constants(counted, {"capa": "silver", "version": 2024})


# ---- joins -----------------------------------------------------------------------------


@query(
    f"""WITH {JUDGED}
SELECT agency, sla_days, penalty_amount_usd, count(*) AS n, count(target) AS n_judged,
       CAST(sum(target) AS BIGINT) AS n_breach
FROM judged GROUP BY 1, 2, 3"""
)
def contract_join(spark, sf_dir):
    return judged(spark, sf_dir).groupBy("agency", "sla_days", "penalty_amount_usd").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("target").alias("n_judged"),
        F.sum("target").alias("n_breach"),
    )


@query(
    f"""WITH {REQUESTS},
stats AS (SELECT incident_zip, avg(quantity) AS m FROM requests
          WHERE incident_zip IS NOT NULL AND returnflag = 'R' AND discount > 0.08 AND tax > 0.06
          GROUP BY 1),
g AS (SELECT avg(quantity) AS m FROM requests)
SELECT request_key, round(coalesce(s.m, g.m), 6) AS mean_quantity
FROM requests r LEFT JOIN stats s USING (incident_zip), g"""
)
def group_stat_with_fallback(spark, sf_dir):
    df = requests(spark, sf_dir, ["request_key", "incident_zip", "quantity", "returnflag", "discount", "tax"])
    seen = df.where((F.col("returnflag") == "R") & (F.col("discount") > 0.08) & (F.col("tax") > 0.06))
    stats = C.drop_missing(seen, ["incident_zip"]).groupBy("incident_zip").agg(
        F.avg("quantity").alias("mean_quantity")
    )
    overall = df.agg(F.avg("quantity")).scalar()
    joined = J.attach_group_stat(df, stats, "incident_zip", {"mean_quantity": overall})
    return rounded(joined.select("request_key", "mean_quantity"))


@query(
    f"""WITH {REQUESTS},
stats AS (SELECT incident_zip, avg(price) AS m FROM requests WHERE incident_zip IS NOT NULL GROUP BY 1)
SELECT request_key, incident_zip, round(m, 4) AS mean_price
FROM requests r LEFT JOIN stats s USING (incident_zip)"""
)
def group_stat_beyond_broadcast(spark, sf_dir):
    """The join used when the table of statistics is too long for a broadcast."""
    df = requests(spark, sf_dir, ["request_key", "incident_zip", "price"])
    stats = C.drop_missing(df, ["incident_zip"]).groupBy("incident_zip").agg(F.avg("price").alias("mean_price"))
    joined = J.attach(df, stats, "incident_zip", max_bytes=0)
    return rounded(joined.select("request_key", "incident_zip", "mean_price"), 4)


@query(
    f"""WITH {REQUESTS},
stats AS (SELECT agency, borough, avg(latitude) AS lat, avg(longitude) AS lon FROM requests GROUP BY 1, 2)
SELECT agency, borough, round(max(lat), 6) AS centroid_lat, round(max(lon), 6) AS centroid_lon, count(*) AS n
FROM requests LEFT JOIN stats USING (agency, borough) GROUP BY 1, 2"""
)
def composite_key_join(spark, sf_dir):
    from breachline.operators.statistics import group_centroid

    df = requests(spark, sf_dir, ["agency", "borough", "latitude", "longitude"])
    joined = J.attach(df, group_centroid(df, ["agency", "borough"]), ["agency", "borough"])
    return rounded(
        joined.groupBy("agency", "borough").agg(
            F.max("centroid_lat").alias("centroid_lat"),
            F.max("centroid_lon").alias("centroid_lon"),
            F.count(F.lit(1)).alias("n"),
        )
    )


@query(
    f"""WITH {REQUESTS},
daily AS (SELECT incident_zip, CAST(created_ts AS DATE) AS day, count(*) AS n FROM requests
          WHERE returnflag <> 'R' AND incident_zip IS NOT NULL GROUP BY 1, 2),
coarse AS (SELECT incident_zip, quantile_disc(n, 0.5) AS n FROM daily GROUP BY 1),
g AS (SELECT quantile_disc(n, 0.5) AS n FROM daily)
SELECT request_key, CAST(coalesce(d.n, c.n, g.n) AS BIGINT) AS volume
FROM requests r LEFT JOIN daily d ON d.incident_zip = r.incident_zip AND d.day = CAST(created_ts AS DATE)
LEFT JOIN coarse c ON c.incident_zip = r.incident_zip, g"""
)
def two_level_fallback(spark, sf_dir):
    from breachline.operators.statistics import group_count, group_median

    df = requests(spark, sf_dir, ["request_key", "incident_zip", "created_ts", "returnflag"])
    df = cut(df.withColumn("day", F.to_date("created_ts")), "requests")
    known = df.where((F.col("returnflag") != "R") & F.col("incident_zip").isNotNull())
    daily = cut(group_count(known, ["incident_zip", "day"], "volume"))
    joined = J.join_two_level_fallback(
        df,
        daily,
        ["incident_zip", "day"],
        group_median(daily, "incident_zip", "volume", "volume"),
        ["incident_zip"],
        "volume",
        group_median(daily, [], "volume", "volume").scalar(),
    )
    return joined.select("request_key", "volume")


@query(
    """SELECT s_nationkey AS nation, s.n AS suppliers, c.n AS customers
FROM (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1) s
JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) c ON s_nationkey = c_nationkey"""
)
def inner_match_counts(spark, sf_dir):
    def counts(name, column, alias):
        keyed = table(spark, sf_dir, name).select(F.col(column).alias("nation"))
        return keyed.groupBy("nation").agg(F.count(F.lit(1)).alias(alias))

    return J.inner_match(
        counts("supplier", "s_nationkey", "suppliers"), counts("customer", "c_nationkey", "customers"), "nation"
    )


@query(
    f"""WITH {SPLITS}
SELECT agency, count_if(split = 'train') AS train, count_if(split = 'val') AS val,
       count_if(split = 'test') AS test FROM splits GROUP BY agency"""
)
def agency_counts_by_split(spark, sf_dir):
    return J.outer_join_counts(splits(spark, sf_dir, ["agency"]), "agency", "split", ["train", "val", "test"])


# ---- de-duplication and sets -----------------------------------------------------------


@query(
    f"""WITH {SILVER}
SELECT request_key, strftime(created_ts, '%Y-%m-%d %H:%M:%S') AS created_ts,
       strftime(closed_ts, '%Y-%m-%d %H:%M:%S') AS closed_ts, agency, borough, complaint_type,
       channel, location_type, incident_zip, round(latitude, 6) AS latitude,
       round(longitude, 6) AS longitude, quantity, price, discount, tax, returnflag
FROM silver"""
)
def silver_table(spark, sf_dir):
    return rounded(silver(spark, sf_dir))


@query(
    f"""WITH {REQUESTS}
SELECT count(*) AS rows_before, count(DISTINCT request_key) AS rows_after,
       count(*) - count(DISTINCT request_key) AS rows_removed,
       round((count(*) - count(DISTINCT request_key)) * 100.0 / count(*), 6) AS pct_removed
FROM requests"""
)
def dedupe_audit(spark, sf_dir):
    return rounded(P.audit_dedupe(requests(spark, sf_dir, ["request_key"]), "request_key"))


@query(
    """WITH doubled AS (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 1)
SELECT count(*) AS total_rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM doubled)) AS distinct_rows,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM doubled)) AS duplicate_rows
FROM doubled"""
)
def duplicate_rows(spark, sf_dir):
    """Over whole rows; the first line of every order is there twice."""
    df = table(spark, sf_dir, "lineitem")
    return P.duplicate_count(df.unionByName(df.where("l_linenumber = 1")))


@query(
    f"""WITH {REQUESTS}
SELECT DISTINCT complaint_type, agency FROM requests"""
)
def distinct_pairs(spark, sf_dir):
    return C.distinct_rows(requests(spark, sf_dir, ["complaint_type", "agency"]), ["complaint_type", "agency"])


@query(f"WITH {REQUESTS} SELECT DISTINCT location_type FROM requests WHERE location_type IS NOT NULL")
def filter_list_values(spark, sf_dir):
    return C.distinct_sorted(requests(spark, sf_dir, ["location_type"]), "location_type")


@query(
    """SELECT origin, count(*) AS n, count(acctbal) AS n_known FROM (
  SELECT 'clientes' AS origin, c_acctbal AS acctbal FROM customer
  UNION ALL SELECT 'proveedores', NULL FROM supplier) GROUP BY origin"""
)
def tagged_union(spark, sf_dir):
    stacked = D.union_tagged(
        {
            "clientes": table(spark, sf_dir, "customer").select(F.col("c_acctbal").alias("acctbal")),
            "proveedores": table(spark, sf_dir, "supplier").select("s_name"),
        }
    )
    return stacked.groupBy("origin").agg(F.count(F.lit(1)).alias("n"), F.count("acctbal").alias("n_known"))


@query(
    """SELECT side, count(*) AS n FROM (
  SELECT CASE WHEN l.k IS NOT NULL AND r.k IS NOT NULL THEN 'both' WHEN l.k IS NOT NULL THEN 'left'
              ELSE 'right' END AS side
  FROM (SELECT DISTINCT o_custkey AS k FROM orders) l
  FULL JOIN (SELECT DISTINCT l_partkey AS k FROM lineitem) r ON l.k = r.k) GROUP BY side"""
)
def key_set_overlap(spark, sf_dir):
    left = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    right = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("k"))
    return D.key_overlap(left, right, "k").groupBy("side").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {REQUESTS}
SELECT DISTINCT complaint_type FROM requests WHERE incident_zip IN (3, 5)"""
)
def compatible_types(spark, sf_dir):
    df = requests(spark, sf_dir, ["complaint_type", "incident_zip"])
    return D.compatible_values(df, "incident_zip", [3, 5], "complaint_type")


@query(
    f"""WITH {REQUESTS}, chosen(agency) AS (VALUES ('1-URGENT'), ('9-NEVER'), ('5-LOW'))
SELECT agency FROM chosen WHERE agency NOT IN (
  SELECT agency FROM requests WHERE complaint_type = 'Brand#11' AND agency IS NOT NULL)"""
)
def incompatible_agencies(spark, sf_dir):
    df = requests(spark, sf_dir, ["complaint_type", "agency"])
    return D.incompatible_values(
        df, "agency", ["1-URGENT", "9-NEVER", "5-LOW"], "complaint_type", ["Brand#11"]
    )


@query(
    """SELECT 'o_orderdate' AS found, strftime(min(o_orderdate), '%Y-%m-%d') AS first_value,
       strftime(max(o_orderdate), '%Y-%m-%d') AS last_value FROM orders"""
)
def date_column_range(spark, sf_dir):
    """The range of the column that dates an order, found by its name."""
    df = table(spark, sf_dir, "orders")
    found = C.find_date_column(df)
    span = P.value_range(df, found)
    return span.select(
        F.lit(found).alias("found"), *[F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("first_value", "last_value")]
    )
