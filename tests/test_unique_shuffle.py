"""Uniqueness tests: what crosses their shuffle, and that each test counts for itself."""

from pyspark.sql import functions as F

from dimforge.operators.quality import DataTest, run_suite, unique_checks
from test_shuffle_volume import shuffled


def test_a_value_under_several_unique_tests_crosses_once(spark):
    n = 2000
    same = spark.range(n).select("id", F.col("id").alias("copy"))
    tests = [DataTest("unique", "t", ("id",)), DataTest("unique", "t", ("copy",))]
    checked = unique_checks({"t": same}, tests)
    assert [r.failures for r in checked.collect()] == [0, 0]
    assert max(records for _, records in shuffled(checked)) == n


def test_unique_tests_of_one_table_count_apart(spark):
    t = spark.createDataFrame([(1, 1, "1"), (1, 2, "1"), (2, 2, None), (3, 1, "x"), (None, None, None), (None, 9, "y"), (4, None, "z"), (9, 4, "w")], "a int, b long, c string")
    u = spark.createDataFrame([(1,), (5,), (5,)], "a int")
    tests = [DataTest("unique", "t", ("a",)), DataTest("unique", "u", ("a",)), DataTest("unique", "t", ("b",)), DataTest("unique", "t", ("c",)),
             DataTest("unique_combination", "t", ("a", "b")), DataTest("unique_combination", "u", ("a",))]
    got = {r.test_name: r.failures for r in run_suite({"t": t, "u": u}, tests).collect()}
    assert got == {"unique_t_a": 1, "unique_u_a": 1, "unique_t_b": 2, "unique_t_c": 1, "unique_combination_t_a_b": 0, "unique_combination_u_a": 1}
