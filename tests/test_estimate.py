import pytest
from pyspark.sql import functions as F

from furrow.operators import estimate, transition

CELLS = [(0, 0, 39), (0, 1, 2), (1, 0, 4), (1, 1, 35)]


def survey(spark):
    rows = [(i, j, 1.0) for i, j, n in CELLS for _ in range(n)]
    return spark.createDataFrame(rows, "map_label int, true_label int, weight double")


def pixels(spark, zeros, ones):
    return spark.range(zeros + ones).select((F.col("id") >= zeros).cast("int").alias("code"))


def test_calibrated_area_of_the_hand_checked_sample(spark):
    w, p = estimate.prepare(pixels(spark, 6000, 4000), survey(spark), [0, 1])
    a = estimate.areas(p, w).first()
    assert (a.naive_mu, a.calibrated_mu, a.se_mu, a.cv_pct, a.ci_low_mu, a.ci_high_mu) == (600.0, 582.4, 42.6, 7.31, 498.9, 665.8)
    acc = {r.code: r for r in estimate.accuracy(p).collect()}
    assert acc[1].ua == pytest.approx(0.8974, abs=1e-4) and acc[1].ua_se == pytest.approx(0.0492, abs=1e-4)
    assert acc[1].pa == pytest.approx(0.9246, abs=1e-4) and acc[1].pa_se == pytest.approx(0.0488, abs=1e-4)
    assert acc[1].oa == pytest.approx(0.9297, abs=1e-4) and acc[1].oa_se == pytest.approx(0.0284, abs=1e-4)
    assert p.agg(F.sum("p")).first()[0] == pytest.approx(1)


def test_rare_class_cannot_hide_in_the_background(spark):
    w, p = estimate.prepare(pixels(spark, 9800, 200), survey(spark), [0, 1])
    share = p.where("j = 1").agg(F.sum("p")).first()[0]
    assert share == pytest.approx(0.024949, abs=1e-6)


def test_empty_rows_absent_classes_and_missing_weights(spark):
    s = survey(spark).drop("weight").where("map_label = 1")
    m = {(r.i, r.j): r for r in estimate.conditional_matrix(estimate.error_matrix(s, [0, 1, 7])).collect()}
    assert m[0, 0].cond == 1 and m[7, 7].cond == 1 and m[1, 1].n == 35 and m[1, 7].n == 0
    empty = estimate.error_matrix(survey(spark).limit(0), [0, 1])
    assert empty.agg(F.sum("n")).first()[0] == 0


def test_neyman_case(spark):
    w = spark.createDataFrame([(0, 1000, 0.1, 10000), (1, 3000, 0.3, 10000), (2, 5000, 0.5, 10000), (3, 1000, 0.1, 10000)], "code int, pixels long, weight double, total long")
    rows = estimate.neyman(w, {0: "b", 1: "m", 2: "w", 3: "s"}, 160, 20).orderBy("code").collect()
    assert [r.neyman_n for r in rows] == [16, 56, 68, 20] and [r.recommended_n for r in rows] == [20, 56, 64, 20]
    over = estimate.neyman(w, {0: "b", 1: "m", 2: "w", 3: "s"}, 40, 20).collect()
    assert all(r.recommended_n >= 20 for r in over)


def test_ppi(spark):
    everything = spark.range(1000).select((100 + F.col("id") % 7).cast("double").alias("m"))
    s = spark.createDataFrame(list(zip([105.0, 104.0, 106.0, 105.5, 104.5], [100.0, 99.0, 101.0, 100.5, 99.5])), "m double, g double")
    r = estimate.ppi_mean(everything, s, "m", "g").first()
    assert r.survey_mean == 100 and r.ppi_se == 0 and r.gain == 1.0 and r.ppi_mean == pytest.approx(everything.agg(F.avg("m")).first()[0] - 5, abs=1e-3)


def test_bootstrap_covers_the_estimate(spark):
    px = pixels(spark, 6000, 4000)
    w = estimate.class_histogram(px, [0, 1])
    r = {x.code: x for x in estimate.bootstrap_ci(survey(spark), w, [0, 1], 100).collect()}
    assert r[1].boot_low_mu < 582.4 < r[1].boot_high_mu


def test_transition_marginals_and_compliance(spark):
    e = spark.range(100).select(F.expr("id DIV 10").alias("r"), (F.col("id") % 10).alias("c"), (F.col("id") % 4).cast("int").alias("code"))
    late = e.withColumn("code", ((F.col("code") + F.col("r")) % 4).cast("int"))
    m = transition.transition_matrix(transition.pair(e, late), [0, 1, 2, 3])
    assert m.agg(F.sum("pixels")).first()[0] == 100
    by = {r.early: r.n for r in m.groupBy("early").agg(F.sum("pixels").alias("n")).collect()}
    assert by == {r.code: r["count"] for r in e.groupBy("code").count().collect()}
    kinds = [r.kind for r in transition.compliance(m, {0: "b", 1: "玉米"}, soy_codes=()).collect()]
    assert not any("粮豆" in k for k in kinds) and any("撂荒" in k for k in kinds)


def test_md5_of_many_texts():
    import hashlib

    import numpy as np

    from furrow.functions import md5

    numbers, found = [0, 7, 10, 1999, 123_456_789_012], {}
    for at, x in md5.leading(numbers, 20_000):
        found.setdefault(at, []).append(x)
    for at, b in enumerate(numbers):
        assert np.concatenate(found[at]).tolist() == [int(hashlib.md5(f"{b}:{j}".encode()).hexdigest()[:8], 16) for j in range(20_000)]


def test_bootstrap_makes_no_row_for_a_draw(spark):
    """Rows of all draws, once exploded, shuffled and grouped, took the bootstrap over its time; the draws are those of the MD5."""
    import hashlib
    from collections import Counter

    rows = [(i, j, w) for i in (0, 1, 2) for j in (0, 1, 2) for w in (0.5, 2.0) for _ in range(3 + 5 * (i == j))]
    sample = spark.createDataFrame(rows[::-1], "map_label int, true_label int, weight double")
    weights = spark.createDataFrame([(0, 50, 0.5, 100), (1, 30, 0.3, 100), (2, 20, 0.2, 100)], "code int, pixels long, weight double, total long")
    shares = estimate.bootstrap(sample, weights, [0, 1, 2], 12, protect=False)
    assert "Generate explode(sequence" not in shares._jdf.queryExecution().toString()
    found = {(r.b, r.code): r.share for r in shares.collect()}
    for b in range(12):
        n = Counter()
        for j in range(len(rows)):
            i, t, w = rows[int(hashlib.md5(f"{b}:{j}".encode()).hexdigest()[:8], 16) % len(rows)]
            n[i, t] += w
        for code in (0, 1, 2):
            expected = sum(share * (n[i, code] / sum(n[i, t] for t in (0, 1, 2))) for i, share in ((0, 0.5), (1, 0.3), (2, 0.2)))
            assert abs(found[b, code] - expected) < 1e-12
    assert len(found) == 36


def test_bootstrap_of_an_empty_sample(spark):
    sample = spark.createDataFrame([], "map_label int, true_label int, weight double")
    weights = spark.createDataFrame([(0, 50, 0.5, 100), (1, 50, 0.5, 100)], "code int, pixels long, weight double, total long")
    assert {r.code: r.share for r in estimate.bootstrap(sample, weights, [0, 1], 1).collect()} == {0: 0.5, 1: 0.5}
