"""Places in a total order."""

from airloom.operators.ordering import numbered


def test_places_are_those_of_a_sort(spark):
    rows = [(i * 7919 % 1009 % 50, i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, i int").repartition(7)
    got = {(r.k, r.i): r.place for r in numbered(df, "k", "i").collect()}
    assert got == {row: n for n, row in enumerate(sorted(rows))}


def test_nulls_ties_and_empty(spark):
    df = spark.createDataFrame([(None,), (2,), (2,), (1,)], "k int")
    assert sorted((r.place, r.k) for r in numbered(df, "k").collect()) == [(0, None), (1, 1), (2, 2), (3, 2)]
    assert numbered(df.limit(0), "k").collect() == []


def test_no_row_order_in_one_task(spark):
    from airloom.plans import registry

    df = registry.q_flagged_outliers_ordered(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
