from dimforge.operators.quality import DataTest, run_suite


def test_seeded_defects_are_counted(spark):
    child = spark.createDataFrame(
        [(1, "a", 1, 0), (1, "b", 1, 1), (2, None, 1, 2), (3, "zz", 2, 1), (None, "a", 1, None)],
        "id int, fk string, one int, flag int")
    parent = spark.createDataFrame([("a",), ("b",), ("b",)], "fk string")
    tests = [
        DataTest("not_null", "child", ("id",)),
        DataTest("unique", "child", ("id",)),
        DataTest("relationships", "child", ("fk",), "parent", "fk"),
        DataTest("accepted_values", "child", ("one",), values=(1,)),
        DataTest("accepted_values", "child", ("flag",), values=(0, 1)),
        DataTest("unique_combination", "child", ("one", "fk")),
    ]
    got = {r.test_name: r.failures for r in run_suite({"child": child, "parent": parent}, tests).collect()}
    assert got == {
        "not_null_child_id": 1,
        "unique_child_id": 1,            # value 1 duplicated; NULL ignored
        "relationships_child_fk": 1,     # 'zz' orphan; NULL fk ignored
        "accepted_values_child_one": 1,  # distinct bad value 2
        "accepted_values_child_flag": 1,  # value 2; NULL passes
        "unique_combination_child_one_fk": 1,  # (1, 'a') twice
    }


def test_suite_has_66_tests():
    from dimforge.plans.quality import SUITE

    assert len(SUITE) == 66
    assert len({t.name for t in SUITE}) == 66
