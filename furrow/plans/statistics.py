"""Queries on area statistics and transitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.functions import grading
from furrow.operators import estimate, transition
from furrow.plans import fixtures as X
from furrow.plans.fixtures import query, r4

MU = "0.15"  #: mu a pixel of 10 m


def _values(codes: list[int]) -> str:
    return ", ".join(f"({c})" for c in codes)


def chain(pixels: str, protect: bool = True, codes: list[int] = X.SAMPLE_CODES, sample: str = X.SAMPLE_SQL) -> str:
    """CTEs down to p: i, j, n, n_i, cond, w_i, p; and w: code, pixels, weight, total."""
    cap = "least(k.cond, 0.35 * wj.weight / greatest(w0.weight, 1e-6))"
    held = f"CASE WHEN wj.pixels = 0 THEN 0 WHEN w0.weight >= 0.70 OR wj.weight < 0.05 THEN {cap} ELSE k.cond END"
    first = f"CASE WHEN k.i = 0 AND k.j <> 0 THEN {held} ELSE k.cond END" if protect else "k.cond"
    guard = "CASE WHEN i = 0 AND j = 0 THEN greatest(0, 1 - sum(CASE WHEN j <> 0 THEN q ELSE 0 END) OVER (PARTITION BY i)) ELSE q END" if protect else "q"
    whole = "CASE WHEN i = 0 AND sum(q2) OVER (PARTITION BY i) > 0 THEN q2 / sum(q2) OVER (PARTITION BY i) ELSE q2 END" if protect else "q2"
    return f"""WITH pix AS ({pixels}), smp AS ({sample}), codes AS (SELECT * FROM (VALUES {_values(codes)}) AS v(code)),
        w AS (SELECT c.code, count(p.code) AS pixels, CAST(count(p.code) AS DOUBLE) / (SELECT count(*) FROM pix) AS weight, (SELECT count(*) FROM pix) AS total FROM codes c LEFT JOIN pix p ON p.code = c.code GROUP BY c.code),
        m AS (SELECT a.code AS i, b.code AS j, coalesce(sum(s.weight), 0) AS n FROM codes a CROSS JOIN codes b LEFT JOIN smp s ON s.map_label = a.code AND s.true_label = b.code GROUP BY 1, 2),
        k AS (SELECT i, j, n, sum(n) OVER (PARTITION BY i) AS n_i, CASE WHEN sum(n) OVER (PARTITION BY i) > 0 THEN n / sum(n) OVER (PARTITION BY i) ELSE CAST(CAST(i = j AS INT) AS DOUBLE) END AS cond FROM m),
        g1 AS (SELECT k.i, k.j, k.n, k.n_i, {first} AS q FROM k JOIN w wj ON wj.code = k.j CROSS JOIN (SELECT weight FROM w WHERE code = 0) w0),
        g2 AS (SELECT i, j, n, n_i, {guard} AS q2 FROM g1), g AS (SELECT i, j, n, n_i, {whole} AS cond FROM g2),
        p AS (SELECT g.*, w.weight AS w_i, w.weight * g.cond AS p FROM g JOIN w ON w.code = g.i)"""


HISTOGRAM = """SELECT CAST(c.code AS INT) AS code, count(p.code) AS pixels, round(CAST(count(p.code) AS DOUBLE) / (SELECT count(*) FROM pix), 4) AS weight
    FROM (VALUES {codes}) AS c(code) LEFT JOIN pix p ON p.code = c.code GROUP BY 1"""


@query(f"WITH pix AS ({X.GRID_SQL}) " + HISTOGRAM.format(codes=_values(X.CODES)))
def class_histogram(spark: SparkSession, d: str) -> DataFrame:
    return estimate.class_histogram(X.grid(spark, d), X.CODES).select("code", "pixels", r4(F.col("weight")).alias("weight"))


@query(f"WITH pix AS ({X.MAP_SQL}) " + HISTOGRAM.format(codes=_values(X.SAMPLE_CODES)))
def stratum_weights(spark: SparkSession, d: str) -> DataFrame:
    return estimate.class_histogram(X.class_map(spark, d), X.SAMPLE_CODES).select("code", "pixels", r4(F.col("weight")).alias("weight"))


@query(chain(X.MAP_SQL) + " SELECT i, j, n FROM m")
def error_matrix(spark: SparkSession, d: str) -> DataFrame:
    return estimate.error_matrix(X.sample(spark, d), X.SAMPLE_CODES)


@query(chain(X.MAP_SQL) + " SELECT i, j, n_i, round(cond, 4) AS cond FROM k")
def conditional_matrix(spark: SparkSession, d: str) -> DataFrame:
    return estimate.conditional_matrix(estimate.error_matrix(X.sample(spark, d), X.SAMPLE_CODES)).select("i", "j", "n_i", r4(F.col("cond")).alias("cond"))


def _protected(spark: SparkSession, pixels: DataFrame, d: str) -> DataFrame:
    w = estimate.class_histogram(pixels, X.SAMPLE_CODES)
    return estimate.domain_protection(estimate.conditional_matrix(estimate.error_matrix(X.sample(spark, d), X.SAMPLE_CODES)), w).select("i", "j", r4(F.col("cond")).alias("cond"))


@query(chain(X.MAP_SQL) + " SELECT i, j, round(cond, 4) AS cond FROM g")
def domain_protection(spark: SparkSession, d: str) -> DataFrame:
    return _protected(spark, X.class_map(spark, d), d)


@query(chain(X.MACRO_SQL) + " SELECT i, j, round(cond, 4) AS cond FROM g")
def domain_protection_macro(spark: SparkSession, d: str) -> DataFrame:
    return _protected(spark, X.macro_map(spark, d), d)


SPREAD = "CASE WHEN n_i > 1 THEN w_i * w_i * cond * (1 - cond) / (n_i - 1) ELSE 0 END"
AREA = f"""SELECT CAST(code AS INT) AS code, pixels, naive_mu, round(naive_mu / 15, 2) AS naive_ha, calibrated_mu, round(calibrated_mu / 15, 2) AS calibrated_ha, round(s, 1) AS se_mu,
        round(s / greatest(c, 1e-6) * 100, 2) AS cv_pct, round(greatest(0, c - 1.96 * s), 1) AS ci_low_mu, round(c + 1.96 * s, 1) AS ci_high_mu,
        round(naive_mu - calibrated_mu, 1) AS bias_mu, round((naive_mu - calibrated_mu) / greatest(calibrated_mu, 1e-6) * 100, 1) AS bias_pct
    FROM (SELECT a.code, w.pixels, round(1e-9 + w.weight * (w.total * CAST({MU} AS DOUBLE)), 1) AS naive_mu, round(a.share * (w.total * CAST({MU} AS DOUBLE)), 1) AS calibrated_mu, a.share * (w.total * CAST({MU} AS DOUBLE)) AS c, a.se * (w.total * CAST({MU} AS DOUBLE)) AS s
          FROM (SELECT j AS code, sum(p) AS share, sqrt(sum({SPREAD})) AS se FROM p GROUP BY j) a JOIN w ON w.code = a.code WHERE a.code <> 0)"""


@query(chain(X.MAP_SQL) + AREA)
def unbiased_area(spark: SparkSession, d: str) -> DataFrame:
    w, p = estimate.prepare(X.class_map(spark, d), X.sample(spark, d), X.SAMPLE_CODES)
    return estimate.areas(p, w)


@query(chain(X.MACRO_SQL) + AREA)
def unbiased_area_macro(spark: SparkSession, d: str) -> DataFrame:
    w, p = estimate.prepare(X.macro_map(spark, d), X.sample(spark, d), X.SAMPLE_CODES)
    return estimate.areas(p, w)


ACCURACY = """, v AS (SELECT *, CASE WHEN n_i > 1 THEN cond * (1 - cond) / (n_i - 1) ELSE 0 END AS v, sum(p) OVER (PARTITION BY j) AS p_j FROM p),
    a AS (SELECT j AS code, max(CASE WHEN i = j THEN cond END) AS ua, sqrt(max(CASE WHEN i = j THEN v END)) AS ua_se, max(CASE WHEN i = j THEN p END) / max(p_j) AS raw, max(p_j) AS p_j,
            max(CASE WHEN i = j THEN w_i * w_i * v END) AS own, sum(CASE WHEN i <> j THEN w_i * w_i * v ELSE 0 END) AS others FROM v GROUP BY j),
    o AS (SELECT sum(p) AS oa, sqrt(sum(w_i * w_i * v)) AS oa_se FROM v WHERE i = j),
    acc AS (SELECT code, ua, ua_se, least(1, raw) AS pa, sqrt(((1 - raw) * (1 - raw) * own + raw * raw * others) / (p_j * p_j)) AS pa_se, oa, oa_se FROM a CROSS JOIN o)"""


@query(chain(X.MAP_SQL) + ACCURACY + " SELECT CAST(code AS INT) AS code, round(ua, 4) AS ua, round(ua_se, 4) AS ua_se, round(pa, 4) AS pa, round(pa_se, 4) AS pa_se, round(oa, 4) AS oa, round(oa_se, 4) AS oa_se FROM acc")
def accuracy_uapaoa(spark: SparkSession, d: str) -> DataFrame:
    _, p = estimate.prepare(X.class_map(spark, d), X.sample(spark, d), X.SAMPLE_CODES)
    return estimate.accuracy(p).select("code", *(r4(F.col(c)).alias(c) for c in ("ua", "ua_se", "pa", "pa_se", "oa", "oa_se")))


@query(chain(X.MAP_SQL) + ACCURACY + " SELECT CAST(code AS INT) AS code, printf('%.1f%% ± %.1f%%', ua * 100, ua_se * 100) AS users, printf('%.1f%% ± %.1f%%', pa * 100, pa_se * 100) AS producers FROM acc")
def accuracy_text(spark: SparkSession, d: str) -> DataFrame:
    _, p = estimate.prepare(X.class_map(spark, d), X.sample(spark, d), X.SAMPLE_CODES)
    return estimate.accuracy(p).select("code", grading.accuracy_text(F.col("ua"), F.col("ua_se")).alias("users"), grading.accuracy_text(F.col("pa"), F.col("pa_se")).alias("producers"))


@query(
    chain(X.MAP_SQL) + ACCURACY
    + """ SELECT 'Map_' || i AS map_class, printf('%.4f', max(CASE WHEN j = 0 THEN round(p * 100, 4) END)) AS ref_0, printf('%.4f', max(CASE WHEN j = 1 THEN round(p * 100, 4) END)) AS ref_1, printf('%.4f', max(CASE WHEN j = 2 THEN round(p * 100, 4) END)) AS ref_2,
        printf('%.4f', round(any_value(acc.ua), 4)) AS ua, printf('%.5f', round(any_value(w_i), 5)) AS w_i FROM p JOIN acc ON acc.code = p.i GROUP BY i
    UNION ALL SELECT 'PA', printf('%.4f', round(max(CASE WHEN code = 0 THEN pa END), 4)), printf('%.4f', round(max(CASE WHEN code = 1 THEN pa END), 4)), printf('%.4f', round(max(CASE WHEN code = 2 THEN pa END), 4)), printf('%.4f', round(any_value(oa), 4)), 'OA' FROM acc"""
)
def error_matrix_table(spark: SparkSession, d: str) -> DataFrame:
    _, p = estimate.prepare(X.class_map(spark, d), X.sample(spark, d), X.SAMPLE_CODES)
    return estimate.error_matrix_table(p, X.SAMPLE_CODES)


@query(chain(X.MAP_SQL, protect=False) + " SELECT CAST(j AS INT) AS code, round(sum(p) * (SELECT any_value(total) FROM w), 2) AS calibrated_pixels FROM p GROUP BY j")
def naive_calibration(spark: SparkSession, d: str) -> DataFrame:
    return estimate.naive_calibration(X.class_map(spark, d), X.sample(spark, d), X.SAMPLE_CODES)


DRAWS = 2000


@query(f"""WITH pix AS ({X.MAP_SQL}), smp AS ({X.SAMPLE_SQL}), codes AS (SELECT * FROM (VALUES {_values(X.SAMPLE_CODES)}) AS v(code)),
    w AS (SELECT c.code, count(p.code) AS pixels, CAST(count(p.code) AS DOUBLE) / (SELECT count(*) FROM pix) AS weight FROM codes c LEFT JOIN pix p ON p.code = c.code GROUP BY c.code),
    rows AS (SELECT *, row_number() OVER (ORDER BY map_label, true_label) - 1 AS k, count(*) OVER () AS size FROM smp),
    draws AS (SELECT b.range AS b, ('0x' || substr(md5(b.range || ':' || j.range), 1, 8))::UBIGINT % (SELECT count(*) FROM smp) AS x FROM range({DRAWS}) b CROSS JOIN range((SELECT count(*) FROM smp)) j),
    cells AS (SELECT b, map_label AS i, true_label AS j, sum(weight) AS n FROM draws JOIN rows ON rows.k = draws.x GROUP BY 1, 2, 3),
    m AS (SELECT s.b, s.i, s.j, coalesce(c.n, 0) AS n FROM (SELECT b.range AS b, a.code AS i, z.code AS j FROM range({DRAWS}) b CROSS JOIN codes a CROSS JOIN codes z) s LEFT JOIN cells c ON c.b = s.b AND c.i = s.i AND c.j = s.j),
    k AS (SELECT b, i, j, CASE WHEN sum(n) OVER (PARTITION BY b, i) > 0 THEN n / sum(n) OVER (PARTITION BY b, i) ELSE CAST(CAST(i = j AS INT) AS DOUBLE) END AS cond FROM m),
    g1 AS (SELECT k.b, k.i, k.j, CASE WHEN k.i = 0 AND k.j <> 0 THEN CASE WHEN wj.pixels = 0 THEN 0 WHEN w0.weight >= 0.70 OR wj.weight < 0.05 THEN least(k.cond, 0.35 * wj.weight / greatest(w0.weight, 1e-6)) ELSE k.cond END ELSE k.cond END AS q
        FROM k JOIN w wj ON wj.code = k.j CROSS JOIN (SELECT weight FROM w WHERE code = 0) w0),
    g2 AS (SELECT b, i, j, CASE WHEN i = 0 AND j = 0 THEN greatest(0, 1 - sum(CASE WHEN j <> 0 THEN q ELSE 0 END) OVER (PARTITION BY b, i)) ELSE q END AS q2 FROM g1),
    g AS (SELECT b, i, j, CASE WHEN i = 0 AND sum(q2) OVER (PARTITION BY b, i) > 0 THEN q2 / sum(q2) OVER (PARTITION BY b, i) ELSE q2 END AS cond FROM g2),
    s AS (SELECT g.b, g.j AS code, sum(w.weight * g.cond) * (SELECT count(*) FROM pix) * CAST({MU} AS DOUBLE) AS mu FROM g JOIN w ON w.code = g.i GROUP BY 1, 2)
    SELECT CAST(code AS INT) AS code, round(quantile_cont(mu, 0.025), 1) AS boot_low_mu, round(quantile_cont(mu, 0.975), 1) AS boot_high_mu FROM s GROUP BY code""")
def bootstrap_ci(spark: SparkSession, d: str) -> DataFrame:
    w = estimate.class_histogram(X.class_map(spark, d), X.SAMPLE_CODES)
    return estimate.bootstrap_ci(X.sample(spark, d), w, X.SAMPLE_CODES, DRAWS)


@query("""WITH s AS (SELECT o_totalprice AS m, o_totalprice * 0.95 + (o_orderkey % 11) AS g FROM orders WHERE o_orderkey % 97 = 0),
    a AS (SELECT avg(g) AS gt, avg(m) AS ms, stddev_samp(g - m) / sqrt(count(*)) AS se, stddev_samp(g) / sqrt(count(*)) AS sse FROM s), b AS (SELECT avg(o_totalprice) AS mm FROM orders)
    SELECT round(mm + gt - ms, 3) AS ppi_mean, round(se, 3) AS ppi_se, round(mm + gt - ms - 1.96 * se, 3) AS ci_low, round(mm + gt - ms + 1.96 * se, 3) AS ci_high, round(gt, 3) AS survey_mean, round(sse, 3) AS survey_se,
        CASE WHEN se > 0 THEN round(sse * sse / greatest(se * se, 1e-12), 2) ELSE 1 END AS gain FROM a CROSS JOIN b""")
def ppi_mean(spark: SparkSession, d: str) -> DataFrame:
    orders = X.table(spark, d, "orders")
    s = orders.where("o_orderkey % 97 = 0").withColumn("gt", F.col("o_totalprice") * 0.95 + F.col("o_orderkey") % 11)
    return estimate.ppi_mean(orders, s, "o_totalprice", "gt")


def neyman_sql(budget: int, least: int) -> str:
    return f"""WITH pix AS ({X.GRID_SQL}), l AS (SELECT * FROM (VALUES (0, '背景/非农田', 0.92), (1, '玉米', 0.88), (2, '小麦', 0.94), (3, '大豆', 0.85)) AS v(code, name, ua)),
        w AS (SELECT l.code, l.name, CAST(count(p.code) AS DOUBLE) / (SELECT count(*) FROM pix) AS weight, sqrt(greatest(0.01, CAST(any_value(l.ua) AS DOUBLE) * (1 - CAST(any_value(l.ua) AS DOUBLE)))) AS sigma FROM l LEFT JOIN pix p ON p.code = l.code GROUP BY 1, 2),
        n AS (SELECT *, CAST(round_even({budget} * weight, 0) AS BIGINT) AS proportional_n, CAST(round_even({budget} * (weight * sigma / sum(weight * sigma) OVER ()), 0) AS BIGINT) AS neyman_n FROM w),
        f AS (SELECT *, greatest(neyman_n, {least}) AS floored, code = first_value(code) OVER (ORDER BY weight DESC, code) AS dominant FROM n),
        z AS (SELECT *, CASE WHEN dominant THEN greatest({least}, floored + {budget} - sum(floored) OVER ()) ELSE floored END AS recommended_n FROM f)
        SELECT CAST(code AS INT) AS code, name, round(1e-9 + weight * ((SELECT count(*) FROM pix) * CAST({MU} AS DOUBLE)), 1) AS map_area_mu, round(weight, 4) AS weight, round(sigma, 3) AS sigma, proportional_n, neyman_n, CAST(recommended_n AS BIGINT) AS recommended_n, round(CAST(recommended_n AS DOUBLE) / {budget} * 100, 1) AS share_pct FROM z"""


@query(neyman_sql(160, 20))
def neyman_allocation(spark: SparkSession, d: str) -> DataFrame:
    return estimate.neyman(estimate.class_histogram(X.grid(spark, d), X.CODES), X.LEGEND, 160, 20)


@query(neyman_sql(60, 20))
def neyman_over_budget(spark: SparkSession, d: str) -> DataFrame:
    return estimate.neyman(estimate.class_histogram(X.grid(spark, d), X.CODES), X.LEGEND, 60, 20)


PAIRS = f"WITH e AS ({X.GRID_SQL}), l AS ({X.LATE_SQL}), pair AS (SELECT e.code AS early, l.code AS late FROM e JOIN l USING (r, c))"


def _transitions(spark: SparkSession, d: str) -> DataFrame:
    pairs = transition.pair(X.grid(spark, d), X.grid(spark, d, 5, 2).select("r", "c", "code"))
    return transition.transition_matrix(pairs, X.CODES)


@query(PAIRS + f" SELECT CAST(a.code AS INT) AS early, CAST(b.code AS INT) AS late, count(p.early) AS pixels, round(1e-9 + count(p.early) * CAST({MU} AS DOUBLE), 1) AS mu FROM (VALUES {_values(X.CODES)}) AS a(code) CROSS JOIN (VALUES {_values(X.CODES)}) AS b(code) LEFT JOIN pair p ON p.early = a.code AND p.late = b.code GROUP BY 1, 2")
def transition_matrix(spark: SparkSession, d: str) -> DataFrame:
    return _transitions(spark, d)


@query(PAIRS + " SELECT '2020年_' || (CASE early WHEN 0 THEN '背景/非农田' WHEN 1 THEN '玉米' WHEN 2 THEN '小麦' ELSE '大豆' END) AS class, " + ", ".join(f"round(1e-9 + count(CASE WHEN late = {c} THEN 1 END) * CAST({MU} AS DOUBLE), 1) AS to_{c}" for c in X.CODES) + " FROM pair GROUP BY early")
def transition_table(spark: SparkSession, d: str) -> DataFrame:
    wide = transition.transition_table(_transitions(spark, d), X.LEGEND).withColumnsRenamed({f"2023年_{X.LEGEND[c]}": f"to_{c}" for c in X.CODES})
    return wide.where(F.col("to_0") + F.col("to_1") + F.col("to_2") + F.col("to_3") > 0)


@query(PAIRS + f""", s AS (SELECT round(1e-9 + count(CASE WHEN early IN (1, 2) AND late = 3 THEN 1 END) * CAST({MU} AS DOUBLE), 1) AS g, round(1e-9 + count(CASE WHEN early = 1 AND late = 1 THEN 1 END) * CAST({MU} AS DOUBLE), 1) AS m1, round(1e-9 + count(CASE WHEN early = 2 AND late = 2 THEN 1 END) * CAST({MU} AS DOUBLE), 1) AS m2,
        round(1e-9 + count(CASE WHEN early = 3 AND late = 3 THEN 1 END) * CAST({MU} AS DOUBLE), 1) AS m3, round(1e-9 + count(CASE WHEN early > 0 AND late = 0 THEN 1 END) * CAST({MU} AS DOUBLE), 1) AS f FROM pair)
    SELECT '🌾 粮豆健康轮作' AS kind, g AS mu FROM s UNION ALL SELECT '⚠️ 连作重茬地块 (玉米)', m1 FROM s WHERE m1 > 0 UNION ALL SELECT '⚠️ 连作重茬地块 (小麦)', m2 FROM s WHERE m2 > 0
    UNION ALL SELECT '⚠️ 连作重茬地块 (大豆)', m3 FROM s WHERE m3 > 0 UNION ALL SELECT '🚨 疑似耕地撂荒/休耕', f FROM s""")
def rotation_compliance(spark: SparkSession, d: str) -> DataFrame:
    return transition.compliance(_transitions(spark, d), X.LEGEND).select("kind", "mu")


@query(PAIRS + " SELECT early, count(*) AS pixels FROM pair WHERE late IN (1, 3) GROUP BY early")
def class_membership(spark: SparkSession, d: str) -> DataFrame:
    """Pixels whose later class is in a set: a semi-join on the class."""
    wanted = spark.createDataFrame([(1,), (3,)], "late int")
    pairs = transition.pair(X.grid(spark, d), X.grid(spark, d, 5, 2).select("r", "c", "code"))
    return pairs.join(F.broadcast(wanted), "late", "left_semi").groupBy(F.col("early").cast("long").alias("early")).agg(F.count("*").alias("pixels"))


@query(PAIRS + """, n AS (SELECT count(*) AS n, sum(CASE WHEN early = late THEN 1 ELSE 0 END) AS h FROM pair), a AS (SELECT early AS k, count(*) AS a FROM pair GROUP BY 1), b AS (SELECT late AS k, count(*) AS b FROM pair GROUP BY 1),
    x AS (SELECT sum(CAST(a AS DOUBLE) * b) AS e FROM a JOIN b USING (k)) SELECT n, round(CAST(h AS DOUBLE) / n, 4) AS oa, round((CAST(h AS DOUBLE) / n - e / (CAST(n AS DOUBLE) * n)) / (1 - e / (CAST(n AS DOUBLE) * n)), 4) AS kappa FROM n CROSS JOIN x""")
def agreement_kappa(spark: SparkSession, d: str) -> DataFrame:
    pairs = transition.pair(X.grid(spark, d), X.grid(spark, d, 5, 2).select("r", "c", "code"))
    return estimate.agreement(pairs, "early", "late").select("n", r4(F.col("oa")).alias("oa"), r4(F.col("kappa")).alias("kappa"))
