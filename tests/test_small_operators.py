from pyspark.sql import functions as F

from seedwork.operators import labels, report
from tests.conftest import rows


def test_guards(spark):
    s1 = spark.createDataFrame([(1, "ALT"), (2, None)], "key int, state string")
    assert rows(labels.stale_steps(s1, spark.createDataFrame([(1,), (2,)], "key int"))) == [(1,)]
    joint = spark.createDataFrame([(1.234, 1.23), (1.3, 1.2)], "log_odds double, llr double")
    assert rows(labels.precision_disagrees(joint)) == [(1.3, 1.2)]
    s = spark.createDataFrame([("d", "line"), ("d", "control"), ("e", "line"), (None, "x")], "donor string, role string")
    assert rows(labels.role_conflicts(s)) == [("d", 2)]
    a, b = spark.createDataFrame([("x",), ("y",)], "s string"), spark.createDataFrame([("y",), ("z",)], "s string")
    assert rows(labels.column_set_differs(a, b, "s")) == [("x", "unexpected"), ("z", "missing")]


def test_texts(spark):
    df = spark.createDataFrame([("HX1_S1_L002_R1.fq;HX1_S1_L001_R1.fq HY_S_L001_R1.fq", "6B1S+T"), ("none", "+T"), ("", "bad")], "n string, t string")
    got = df.select(labels.platform_unit(F.col("n")), labels.read_structure(F.col("t")).alias("r")).collect()
    assert [(r[0], tuple(r[1])) for r in got] == [("HX1.1,HX1.2,HY.1", (6, 1)), ("", (0, 0)), ("", (None, None))]
    v = spark.createDataFrame([("p", "2"), ("p", "1"), ("p", "1")], "process string, version string")
    assert rows(labels.versions(v)) == [("p", "1, 2")]


def test_summaries(spark):
    t = spark.createDataFrame([(1, 1.0), (1, 4.0), (2, 2.0)], "p int, s double")
    assert rows(report.permutation_threshold(t, "p", "s", 0.5)) == [(3.0,)]
    assert abs(report.genomic_control(t, "s").first()[0] - 2.0 / 0.4549364231195724) < 1e-12
    f = spark.createDataFrame([("L", 5, True), ("L", 6, False)], "library string, bytes long, complete boolean")
    assert rows(report.store_rollup(f)) == [("L", 2, 11, False)]
