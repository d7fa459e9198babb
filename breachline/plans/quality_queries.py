"""Queries over column profiles, quality reports and layer comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from breachline.functions.text import joined_key
from breachline.operators import cleaning as C
from breachline.operators import dashboards as D
from breachline.operators import profiles as P
from breachline.operators import reports as R
from breachline.operators import statistics as S
from breachline.plans.fixture import FIELDS, REQUESTS, SILVER, requests, rounded, silver
from breachline.plans.registry import query
from breachline.settings import cut, work_path

# Every request column, with the type name the report shows.
TIMES = ["created_ts", "closed_ts"]
WHOLE = ["request_key", "incident_zip"]
REAL = ["latitude", "longitude", "quantity", "price", "discount", "tax"]
NUMERIC = [*WHOLE, *REAL]
PROFILED = {
    f: "TimestampType()" if f in TIMES else "LongType()" if f in WHOLE
    else "DoubleType()" if f in REAL else "StringType()" for f in FIELDS
}
# Silver loses one column and has one of its own, so that the layers differ.
CLEANED = {c: k for c, k in PROFILED.items() if c != "tax"} | {"borough_channel": "StringType()"}


def _missing_sql(source: str, columns: dict[str, str] = PROFILED) -> str:
    parts = []
    for name, kind in columns.items():
        text = f" OR {name} IN ('', 'Unspecified')" if kind == "StringType()" else ""
        parts.append(
            f"SELECT '{name}' AS columna, '{kind}' AS tipo_dato, count_if({name} IS NULL{text}) AS nulos_n,"
            f" round(count_if({name} IS NULL{text}) * 100.0 / count(*), 2) AS nulos_pct,"
            f" count(DISTINCT {name}) + CAST(max(CASE WHEN {name} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unicos_n,"
            f" count(*) AS total_filas_dataset FROM {source}"
        )
    return " UNION ALL ".join(parts)


def _outlier_sql(source: str) -> str:
    parts = []
    for name in NUMERIC:
        fences = (
            f"(SELECT quantile_disc(CAST({name} AS DOUBLE), 0.25) AS q1, quantile_disc(CAST({name} AS DOUBLE), 0.75) AS q3 FROM {source})"
        )
        outside = f"{name} < q1 - (q3 - q1) * 1.5 OR {name} > q3 + (q3 - q1) * 1.5"
        parts.append(
            f"SELECT '{name}' AS columna, count_if({outside}) AS outliers_n,"
            f" round(count_if({outside}) * 100.0 / count(*), 2) AS outliers_pct,"
            f" round(max(q1 - (q3 - q1) * 1.5), 6) AS iqr_lower, round(max(q3 + (q3 - q1) * 1.5), 6) AS iqr_upper"
            f" FROM {source}, {fences}"
        )
    return " UNION ALL ".join(parts)


_COLUMNS = ", ".join(PROFILED)
_NULLS = ", ".join(f"count_if({c} IS NULL)" for c in FIELDS)
BRONZE_REPORT = (
    REQUESTS
    + f""",
bronze AS (SELECT {_COLUMNS} FROM requests),
missing_b AS ({_missing_sql("bronze")}),
outliers_b AS ({_outlier_sql("bronze")}),
report_b AS (
  SELECT m.*, coalesce(outliers_n, 0) AS outliers_n, coalesce(outliers_pct, 0) AS outliers_pct,
         coalesce(iqr_lower, 0) AS iqr_lower, coalesce(iqr_upper, 0) AS iqr_upper,
         (SELECT count(*) FROM bronze) - (SELECT count(*) FROM (SELECT DISTINCT * FROM bronze)) AS duplicados_dataset
  FROM missing_b m LEFT JOIN outliers_b USING (columna)
)"""
)
BOTH_REPORTS = (
    SILVER
    + f""",
bronze AS (SELECT {_COLUMNS} FROM requests),
clean AS (SELECT * EXCLUDE (tax), concat_ws('_', borough, channel) AS borough_channel FROM silver),
report_b AS ({_missing_sql("bronze")}),
report_s AS ({_missing_sql("clean", CLEANED)})"""
)


def _bronze(spark, sf_dir):
    return requests(spark, sf_dir, list(PROFILED)).select(*PROFILED)


def _bronze_report(spark, sf_dir):
    return P.health_report(cut(_bronze(spark, sf_dir), "bronze"))


def _both_reports(spark, sf_dir):
    first = P.missing_profile(_bronze(spark, sf_dir))
    made = joined_key(F.col("borough"), F.col("channel"))
    second = P.missing_profile(silver(spark, sf_dir).drop("tax").withColumn("borough_channel", made))
    return cut(first, "report-bronze"), cut(second, "report-silver")


@query(
    f"""WITH {REQUESTS}
SELECT columna, nulos_n, round(nulos_n * 100.0 / (SELECT count(*) FROM requests), 6) AS nulos_pct FROM (
  SELECT unnest({FIELDS}) AS columna, unnest([{_NULLS}]) AS nulos_n FROM requests)"""
)
def null_profile(spark, sf_dir):
    return rounded(P.null_profile(requests(spark, sf_dir).select(*FIELDS)))


@query(f"WITH {REQUESTS}, bronze AS (SELECT {_COLUMNS} FROM requests) {_missing_sql('bronze')}")
def missing_profile(spark, sf_dir):
    return P.missing_profile(_bronze(spark, sf_dir))


@query(
    f"""WITH {REQUESTS}
SELECT columna, nulos_n, total_filas_dataset, unicos_n, TRUE AS within_3_pct FROM ({_missing_sql("requests")})"""
)
def missing_profile_sketched(spark, sf_dir):
    """Sketches stored per load and merged, their distinct counts held against exact ones."""
    bronze = cut(_bronze(spark, sf_dir), "bronze")
    path = work_path(spark, "sketches")
    for load in ("A", "N", "R"):
        P.profile_sketch(bronze.where(F.col("returnflag") == load)).write.mode("append").parquet(path)
    merged = P.sketched_counts(P.merged_sketches(spark.read.parquet(path)))
    exact = P.missing_profile(bronze).select("columna", F.col("unicos_n").alias("exact_n"))
    off = F.abs(F.col("unicos_n") - F.col("exact_n"))
    return merged.join(exact, "columna").select(
        "columna", "nulos_n", "total_filas_dataset", F.col("exact_n").alias("unicos_n"),
        (off <= F.col("exact_n") * 0.03).alias("within_3_pct"),
    )


@query(f"WITH {BRONZE_REPORT} SELECT * FROM report_b")
def health_report(spark, sf_dir):
    return rounded(_bronze_report(spark, sf_dir))


@query(f"WITH {REQUESTS}, bronze AS (SELECT {_COLUMNS} FROM requests) {_outlier_sql('bronze')}")
def iqr_outliers(spark, sf_dir):
    return rounded(P.iqr_outliers(_bronze(spark, sf_dir)))


@query(
    f"""WITH {REQUESTS}
SELECT returnflag, strftime(min(created_ts), '%Y-%m-%d %H:%M:%S') AS first_value,
       strftime(max(created_ts), '%Y-%m-%d %H:%M:%S') AS last_value FROM requests GROUP BY returnflag"""
)
def creation_range(spark, sf_dir):
    df = requests(spark, sf_dir, ["created_ts", "returnflag"])
    return rounded(P.value_range(df, "created_ts", ["returnflag"]))


@query(f"WITH {BRONZE_REPORT} SELECT round(greatest(0, 100 - avg(nulos_pct)), 6) AS score FROM report_b")
def quality_score(spark, sf_dir):
    return rounded(R.quality_score(P.missing_profile(_bronze(spark, sf_dir))))


@query(
    f"""WITH {REQUESTS}, s AS (
  SELECT ({_NULLS.replace("), ", ") + ")}) / {len(FIELDS)}.0 * 100 / count(*) AS pct, count(*) AS n FROM requests)
SELECT n AS rows, round(pct, 6) AS mean_null_pct, round(greatest(0, 100 - pct), 6) AS score,
       CASE WHEN 100 - pct >= 85 THEN 'success' WHEN 100 - pct >= 60 THEN 'warning' ELSE 'danger' END AS color,
       CASE WHEN 100 - pct >= 80 THEN 'Óptimo' WHEN 100 - pct >= 50 THEN 'Aceptable' ELSE 'Crítico' END AS band,
       100 - pct >= 80 AS meets_target FROM s"""
)
def gold_quality_score(spark, sf_dir):
    df = requests(spark, sf_dir)
    return rounded(R.gold_quality_score(df).withColumns(R.quality_band(F.col("score"))))


@query(
    f"""WITH {BRONZE_REPORT}
SELECT columna, CASE WHEN nulos_pct = 0 THEN 'ok' WHEN nulos_pct < 10 THEN 'warn' WHEN nulos_pct < 30 THEN 'orange' ELSE 'bad' END AS severity,
       CASE WHEN nulos_pct = 0 THEN 'chip-ok' WHEN nulos_pct < 10 THEN 'chip-warn' ELSE 'chip-bad' END AS chip
FROM report_b"""
)
def null_severity(spark, sf_dir):
    report = P.missing_profile(_bronze(spark, sf_dir))
    return report.select(
        "columna",
        R.null_severity(F.col("nulos_pct")).alias("severity"),
        R.null_chip(F.col("nulos_pct")).alias("chip"),
    )


@query(
    f"""WITH {BRONZE_REPORT}
SELECT tipo_dato, count(*) AS n_campos, round(avg(nulos_pct), 6) AS nulidad_prom,
       round(100 - avg(nulos_pct), 6) AS completitud FROM report_b GROUP BY tipo_dato"""
)
def type_family_quality(spark, sf_dir):
    return rounded(R.type_family_quality(P.missing_profile(_bronze(spark, sf_dir))))


@query(
    f"""WITH {REQUESTS},
timed AS (SELECT price, quantity * quantity * quantity AS q3, discount * quantity * quantity AS dq FROM requests),
f AS (SELECT 'price' AS columna, price AS v FROM timed UNION ALL SELECT 'q3', q3 FROM timed UNION ALL SELECT 'dq', dq FROM timed),
b AS (SELECT columna, quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.75) AS q3 FROM f GROUP BY 1),
o AS (SELECT columna, count_if(v < q1 - (q3 - q1) * 1.5 OR v > q3 + (q3 - q1) * 1.5) AS outliers_n
      FROM f JOIN b USING (columna) GROUP BY 1 HAVING outliers_n > 0),
c AS (SELECT quantile_cont(outliers_n, 0.25) AS lo, quantile_cont(outliers_n, 0.75) AS hi FROM o)
SELECT columna, outliers_n, CASE WHEN outliers_n > hi THEN 'danger' WHEN outliers_n > lo THEN 'warning' ELSE 'low' END AS severity
FROM o, c"""
)
def outlier_severity(spark, sf_dir):
    df = requests(spark, sf_dir, ["price", "quantity", "discount"])
    q = F.col("quantity")
    made = df.select("price", (q * q * q).alias("q3"), (F.col("discount") * q * q).alias("dq"))
    return R.outlier_severity(P.iqr_outliers(made))


@query(
    f"""WITH {BRONZE_REPORT}
SELECT columna, unicos_n, round(unicos_n * 100.0 / total_filas_dataset, 1) AS unicos_pct FROM report_b"""
)
def cardinality_profile(spark, sf_dir):
    return R.cardinality_profile(P.missing_profile(_bronze(spark, sf_dir)))


@query(
    f"""WITH {BRONZE_REPORT},
c AS (SELECT quantile_cont(unicos_n, 0.25) AS a, quantile_cont(unicos_n, 0.5) AS b, quantile_cont(unicos_n, 0.75) AS c FROM report_b)
SELECT columna, round(greatest(0, least(100, 100 - nulos_pct)), 6) AS completitud, unicos_n,
       CASE WHEN unicos_n <= a THEN 'baja' WHEN unicos_n <= b THEN 'media' WHEN unicos_n <= c THEN 'alta' ELSE 'muy alta' END AS cardinalidad,
       CASE WHEN 100 - nulos_pct >= 90 THEN 'success' WHEN 100 - nulos_pct >= 60 THEN 'warning' ELSE 'danger' END AS color
FROM report_b, c"""
)
def completeness_rank(spark, sf_dir):
    return rounded(R.completeness_rank(cut(P.missing_profile(_bronze(spark, sf_dir)))))


@query(
    f"""WITH {BOTH_REPORTS}
SELECT columna, round(100 - b.nulos_pct, 6) AS completitud_b, round(100 - s.nulos_pct, 6) AS completitud_s,
       round((100 - s.nulos_pct) - (100 - b.nulos_pct), 6) AS delta_pp,
       abs((100 - s.nulos_pct) - (100 - b.nulos_pct)) > 5 AS emphasised,
       abs((100 - s.nulos_pct) - (100 - b.nulos_pct)) > 10 AS labelled,
       s.nulos_pct <= b.nulos_pct AS improved
FROM report_b b JOIN report_s s USING (columna) ORDER BY columna LIMIT 20"""
)
def layer_completeness_delta(spark, sf_dir):
    return rounded(R.layer_completeness_delta(*_both_reports(spark, sf_dir)))


@query(
    f"""WITH {BOTH_REPORTS}
SELECT columna, b.nulos_pct AS nulos_pct_b, s.nulos_pct AS nulos_pct_s, round(b.nulos_pct - s.nulos_pct, 6) AS delta,
       CASE WHEN b.nulos_pct > s.nulos_pct THEN 'mejora' WHEN b.nulos_pct = s.nulos_pct THEN 'igual' ELSE 'regresión' END AS direction
FROM report_b b JOIN report_s s USING (columna) ORDER BY delta DESC, columna LIMIT 20"""
)
def layer_null_delta(spark, sf_dir):
    return rounded(R.layer_null_delta(*_both_reports(spark, sf_dir)))


@query(
    f"""WITH {BOTH_REPORTS}
SELECT columna, b.nulos_pct AS nulos_pct_b, b.unicos_n AS unicos_n_b, s.nulos_pct AS nulos_pct_s,
       s.unicos_n AS unicos_n_s, round(s.nulos_pct - b.nulos_pct, 2) AS delta_nulos_pct,
       CASE WHEN s.nulos_pct < b.nulos_pct THEN 'Mejoró' WHEN s.nulos_pct = b.nulos_pct THEN 'Igual' ELSE 'Empeoró' END AS estado
FROM report_b b JOIN report_s s USING (columna)"""
)
def layer_scoreboard(spark, sf_dir):
    return R.layer_scoreboard(*_both_reports(spark, sf_dir))


@query(
    f"""WITH {BOTH_REPORTS},
j AS (SELECT b.columna AS cb, s.columna AS cs, b.nulos_pct AS nb, s.nulos_pct AS ns,
             b.total_filas_dataset AS tb, s.total_filas_dataset AS ts
      FROM report_b b FULL JOIN report_s s USING (columna))
SELECT round(greatest(0, 100 - avg(nb)), 6) AS score_b, round(greatest(0, 100 - avg(ns)), 6) AS score_s,
       round(greatest(0, 100 - avg(ns)) - greatest(0, 100 - avg(nb)), 6) AS delta_score,
       count_if(cb IS NOT NULL AND cs IS NOT NULL) AS n_common, count_if(cs IS NULL) AS n_only_b,
       count_if(cb IS NULL) AS n_only_s, round((max(tb) - max(ts)) * 100.0 / max(tb), 6) AS reduction_pct FROM j"""
)
def layer_overview(spark, sf_dir):
    return rounded(R.layer_overview(*_both_reports(spark, sf_dir)))


@query(
    f"""WITH {BOTH_REPORTS}
SELECT columna, unicos_n AS value, 'Bronze' AS capa FROM report_b WHERE columna IN (SELECT columna FROM report_s)
UNION ALL SELECT columna, unicos_n, 'Silver' FROM report_s WHERE columna IN (SELECT columna FROM report_b)"""
)
def layer_metric_long(spark, sf_dir):
    first, second = _both_reports(spark, sf_dir)
    return R.metric_long({"Bronze": first, "Silver": second}, "unicos_n")


def _eda_sql(columns: dict[str, bool]) -> str:
    parts = []
    for name, numeric in columns.items():
        mean = f"CAST(round(avg({name}), 4) AS VARCHAR)" if numeric else "CAST(NULL AS VARCHAR)"
        parts.append(
            f"SELECT '{name}' AS columna, CAST(min({name}) AS VARCHAR) AS minimo, CAST(max({name}) AS VARCHAR) AS maximo,"
            f" {mean} AS media, (SELECT v FROM (SELECT CAST({name} AS VARCHAR) AS v, count(*) AS n FROM eda"
            f" WHERE {name} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 1)) AS moda FROM eda"
        )
    return " UNION ALL ".join(parts)


EDA = {c: c in NUMERIC for c in FIELDS}
EDA_SQL = f"WITH {REQUESTS}, eda AS (SELECT {_COLUMNS} FROM requests)"


def _eda(spark, sf_dir):
    return _bronze(spark, sf_dir)


@query(f"{EDA_SQL} {_eda_sql(EDA)}")
def eda_report(spark, sf_dir):
    return P.eda_report(_eda(spark, sf_dir))


@query(
    f"""{EDA_SQL} SELECT columna, moda FROM ({_eda_sql(EDA)})
WHERE NOT regexp_matches(columna, '(?i)latitude|longitude|date')"""
)
def eda_categories(spark, sf_dir):
    report = P.eda_report(_eda(spark, sf_dir))
    return C.filter_name_pattern(report, ["latitude", "longitude", "date"], negate=True).select("columna", "moda")


@query(f"{EDA_SQL} SELECT columna, moda FROM ({_eda_sql(EDA)}) WHERE columna IN ('agency', 'quantity')")
def eda_leading_values(spark, sf_dir):
    return R.leading_values(P.eda_report(_eda(spark, sf_dir)), ["Agency", "Quantity"])


def _skew_sql(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS columna, round(abs(skewness({c})), 4) AS abs_skew FROM t" for c in columns
    )


@query(
    f"""WITH {REQUESTS}, t AS (SELECT {", ".join(NUMERIC)}, quantity * quantity * price AS heavy FROM requests)
SELECT columna, abs_skew, CASE WHEN abs_skew > 2 THEN 'severe' WHEN abs_skew > 1 THEN 'moderate' ELSE 'ok' END AS level
FROM ({_skew_sql([*NUMERIC, "heavy"])})"""
)
def skewness_profile(spark, sf_dir):
    heavy = F.col("quantity") * F.col("quantity") * F.col("price")
    df = requests(spark, sf_dir, NUMERIC).withColumn("heavy", heavy)
    return rounded(P.skewness_profile(df), 4)


def _describe_sql(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS columna, count({c}) AS count, round(avg({c}), 3) AS mean, round(stddev_samp({c}), 3) AS std,"
        f" round(CAST(min({c}) AS DOUBLE), 3) AS min, round(quantile_cont({c}, 0.25), 3) AS q25,"
        f" round(quantile_cont({c}, 0.5), 3) AS q50, round(quantile_cont({c}, 0.75), 3) AS q75,"
        f" round(CAST(max({c}) AS DOUBLE), 3) AS max FROM requests"
        for c in columns
    )


@query(f"WITH {REQUESTS} {_describe_sql(NUMERIC)}")
def describe_numeric(spark, sf_dir):
    df = requests(spark, sf_dir, NUMERIC)
    return P.describe_numeric(cut(df, "described"))


CORRELATED = ["quantity", "price", "discount", "tax", "latitude"]


def _corr_sql(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, round(corr({a}, {b}), 6) AS r FROM {source}"
        for i, a in enumerate(columns)
        for b in columns[i + 1 :]
    )


@query(f"WITH {REQUESTS} {_corr_sql(CORRELATED, 'requests')}")
def correlation_pairwise(spark, sf_dir):
    return rounded(S.correlation_long(requests(spark, sf_dir, CORRELATED), CORRELATED))


@query(
    f"""WITH {REQUESTS}, c AS (SELECT * FROM requests WHERE latitude IS NOT NULL)
SELECT 'quantity' AS feature, CAST(1 AS DOUBLE) AS quantity, round(corr(quantity, price), 6) AS price, round(corr(quantity, latitude), 6) AS latitude FROM c
UNION ALL SELECT 'price', round(corr(quantity, price), 6), 1, round(corr(price, latitude), 6) FROM c
UNION ALL SELECT 'latitude', round(corr(quantity, latitude), 6), round(corr(price, latitude), 6), 1 FROM c"""
)
def correlation_matrix(spark, sf_dir):
    columns = ["quantity", "price", "latitude"]
    return rounded(S.correlation_matrix_wide(requests(spark, sf_dir, columns), columns))


@query(
    f"""WITH {REQUESTS}, c AS (SELECT * FROM requests WHERE latitude IS NOT NULL)
SELECT * FROM (
SELECT 'quantity' AS feature, CAST(1 AS DOUBLE) AS quantity, CAST(NULL AS DOUBLE) AS price, CAST(NULL AS DOUBLE) AS latitude
UNION ALL SELECT 'price', (SELECT round(corr(quantity, price), 6) FROM c), 1, NULL
UNION ALL SELECT 'latitude', (SELECT round(corr(quantity, latitude), 6) FROM c), (SELECT round(corr(price, latitude), 6) FROM c), 1)"""
)
def correlation_lower_triangle(spark, sf_dir):
    columns = ["quantity", "price", "latitude"]
    long = S.correlation_long(requests(spark, sf_dir, columns), columns, drop_null_rows=True)
    return rounded(S.lower_triangle(long, columns))


MIXED = ["quantity", "price", "value", "net", "late"]
MIXED_SQL = (
    f"WITH {REQUESTS}, m AS (SELECT quantity, price, quantity * 1000 + price AS value, price * (1 - discount) AS net,"
    " tax + discount AS late, CAST(returnflag = 'R' OR quantity > 40 AS INTEGER) AS target FROM requests)"
)


def _mixed(spark, sf_dir):
    df = requests(spark, sf_dir, ["quantity", "price", "discount", "tax", "returnflag"])
    return df.select(
        "quantity",
        "price",
        (F.col("quantity") * 1000 + F.col("price")).alias("value"),
        (F.col("price") * (1 - F.col("discount"))).alias("net"),
        (F.col("tax") + F.col("discount")).alias("late"),
        ((F.col("returnflag") == "R") | (F.col("quantity") > 40)).cast("int").alias("target"),
    )


@query(
    f"""{MIXED_SQL}
SELECT feature_1, feature_2, round(r, 3) AS r FROM ({_corr_sql(MIXED, 'm').replace(', 6)', ', 9)')}) WHERE abs(r) > 0.7"""
)
def correlated_pairs(spark, sf_dir):
    return S.correlated_pairs(_mixed(spark, sf_dir), MIXED)


_TARGET_CORR = " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, target) AS r FROM m" for c in MIXED)


@query(
    f"""{MIXED_SQL}
SELECT feature, round(r, 6) AS r, CAST(row_number() OVER (ORDER BY abs(r) DESC, feature) AS INTEGER) AS rank
FROM ({_TARGET_CORR}) ORDER BY rank LIMIT 15"""
)
def target_correlation(spark, sf_dir):
    return rounded(S.target_correlation(_mixed(spark, sf_dir), MIXED, "target"))


@query(
    f"""{MIXED_SQL}
SELECT feature, round(r, 6) AS r, CAST(row_number() OVER (ORDER BY abs(r) DESC, feature) AS INTEGER) AS rank
FROM (SELECT 'quantity' AS feature, corr(quantity, net) AS r FROM m UNION ALL SELECT 'price', corr(price, net) FROM m
      UNION ALL SELECT 'value', corr(value, net) FROM m UNION ALL SELECT 'late', corr(late, net) FROM m)
ORDER BY rank LIMIT 3"""
)
def strongest_partners(spark, sf_dir):
    return rounded(S.strongest_partners(_mixed(spark, sf_dir), MIXED, "net"))


@query(
    f"""{MIXED_SQL}, s AS (SELECT feature, abs(r) AS s FROM ({_TARGET_CORR})),
p AS (SELECT feature_1, feature_2, r, a.s AS s1, b.s AS s2 FROM ({_corr_sql(MIXED, 'm').replace('round(', '(').replace(', 6)', ')')})
      JOIN s a ON a.feature = feature_1 JOIN s b ON b.feature = feature_2 WHERE abs(r) > 0.7)
SELECT CASE WHEN s1 < s2 OR (s1 = s2 AND feature_1 > feature_2) THEN feature_1 ELSE feature_2 END AS dropped,
       CASE WHEN s1 < s2 OR (s1 = s2 AND feature_1 > feature_2) THEN feature_2 ELSE feature_1 END AS kept,
       round(r, 6) AS r FROM p"""
)
def redundant_features(spark, sf_dir):
    return rounded(S.drop_redundant_features(_mixed(spark, sf_dir), MIXED, "target"))


@query(
    f"""WITH {BRONZE_REPORT}
SELECT 'nulos_pct' AS feature_1, 'unicos_n' AS feature_2, round(corr(nulos_pct, unicos_n), 6) AS r FROM report_b"""
)
def report_metric_correlation(spark, sf_dir):
    """Do fields with many missing values also have many distinct ones?"""
    return rounded(S.correlation_long(P.missing_profile(_bronze(spark, sf_dir)), ["nulos_pct", "unicos_n"]))


@query(
    f"""WITH {BOTH_REPORTS}
SELECT columna, max(CASE WHEN capa = 'Bronze' THEN n END) AS "Bronze", max(CASE WHEN capa = 'Silver' THEN n END) AS "Silver"
FROM (SELECT columna, nulos_n AS n, 'Bronze' AS capa FROM report_b UNION ALL SELECT columna, nulos_n, 'Silver' FROM report_s)
GROUP BY 1 HAVING "Bronze" IS NOT NULL AND "Silver" IS NOT NULL"""
)
def layer_metric_pivot(spark, sf_dir):
    """One metric of both layers side by side, for the scatter chart."""
    first, second = _both_reports(spark, sf_dir)
    long = D.union_tagged({"Bronze": first, "Silver": second}, "capa")
    return long.groupBy("columna").pivot("capa", ["Bronze", "Silver"]).agg(F.max("nulos_n")).dropna()


@query(
    f"""WITH {BRONZE_REPORT}
SELECT columna, tipo_dato, nulos_n, nulos_pct, unicos_n FROM report_b"""
)
def report_detail(spark, sf_dir):
    return R.detail_table(P.missing_profile(_bronze(spark, sf_dir)))
