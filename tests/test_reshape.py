import pytest
from pyspark.sql import functions as F

from rivertally.operators import reshape


@pytest.fixture(scope="module")
def children(spark):
    return spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", None, "z"), ("b", 1, None)], "k string, t long, v string")


def test_nest_keeps_order_and_unnests(spark, children, rows):
    nested = reshape.nest(children, ["k"], ["t", "v"], "items", ["t"])
    first = nested.where("k = 'a'").first()
    assert [tuple(i) for i in first["items"]] == [(1, "y"), (2, "x"), (None, "z")]
    assert first["Part"] == 0
    assert rows(reshape.unnest(nested, "items", ["k"])) == rows(children)


def test_large_parents_continue_on_more_rows(spark, rows):
    df = spark.range(25).select(F.when(F.col("id") < 21, "hot").otherwise("cold").alias("k"), "id")
    nested = reshape.nest(df, ["k"], ["id"], "items", ["id"], max_rows=10)
    got = {(r["k"], r["Part"]): [i["id"] for i in r["items"]] for r in nested.collect()}
    assert got == {("hot", 0): list(range(10)), ("hot", 1): list(range(10, 20)), ("hot", 2): [20], ("cold", 0): [21, 22, 23, 24]}
    assert rows(reshape.unnest(nested, "items", ["k"])) == rows(df)


def family(spark):
    parents = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    pit = spark.createDataFrame([("a", i, 1) for i in range(5)] + [(None, 9, 1), ("gone", 1, 1)], "k string, p long, w long")
    floy = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("b", 2)], "k string, f long")
    return parents, {"P": reshape.Children(pit, ["p"], ["p"], "w"), "F": reshape.Children(floy, ["f"], ["f"])}


def test_kinds_of_children_share_the_parts(spark, rows):
    parents, children = family(spark)
    got = reshape.attach_children(parents, children, "k", max_weight=2)
    shown = got.select("k", "Part", "Parts", F.to_json(F.struct(F.col("P.p").alias("p"), F.col("F.f").alias("f"))).alias("items"))
    assert rows(shown) == [
        (None, 0, 1, '{"p":[9],"f":[]}'),
        ("a", 0, 4, '{"p":[0,1],"f":[]}'),
        ("a", 1, 4, '{"p":[2,3],"f":[]}'),
        ("a", 2, 4, '{"p":[4],"f":[1]}'),
        ("a", 3, 4, '{"p":[],"f":[1,null]}'),
        ("b", 0, 1, '{"p":[],"f":[2]}'),
        ("c", 0, 1, "{}"),
    ]


@pytest.mark.parametrize("max_weight", [1, 2, 3, 100])
@pytest.mark.parametrize("hot_rows", [1, 1000])
def test_merging_parts_reverses_any_cut(spark, rows, monkeypatch, max_weight, hot_rows):
    """Whatever the bound, and whether a hot group is worked on whole or in slices."""
    from rivertally.operators import ordered

    parents, children = family(spark)
    whole = reshape.merge_parts(reshape.attach_children(parents, children, "k"), ["k"], ["P", "F"])
    sums = ordered.sum_before
    monkeypatch.setattr(reshape, "sum_before", lambda *a: sums(*a, hot_rows=hot_rows))
    cut = reshape.attach_children(parents, children, "k", max_weight)
    assert rows(reshape.merge_parts(cut, ["k"], ["P", "F"])) == rows(whole)


def test_weights_bound_what_a_row_holds(spark):
    """Two levels: no row holds more than the bound and one element, counted at both levels."""
    grand = spark.range(400).select(F.when(F.col("id") < 300, 0).otherwise(F.col("id") % 20).alias("c"), "id")
    middle = spark.range(20).select(F.lit("p").alias("k"), F.col("id").cast("int").alias("c"))
    below = reshape.attach_children(middle, {"G": reshape.Children(grand, ["id"], ["id"])}, "c", max_weight=10)
    weighed = below.withColumn("_w", reshape.weight_of("G"))
    top = reshape.attach_children(spark.createDataFrame([("p",)], "k string"), {"C": reshape.Children(weighed, ["c", "G", "Part", "Parts"], ["c", "Part"], "_w")}, "k", max_weight=10)
    held = top.select(F.aggregate("C", F.lit(0), lambda n, x: n + 1 + F.size(x["G"])).alias("n"))
    assert held.agg(F.max("n")).first()[0] <= 10 + 11 and held.agg(F.sum("n")).first()[0] == 400 + below.count()


def test_merging_shuffles_split_keys_only(spark):
    parents, children = family(spark)
    plan = reshape.merge_parts(reshape.attach_children(parents, children, "k"), ["k"], ["P"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Parts#" in plan and "> 1" in plan


def _rows_of_kinds(spark):
    parents = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("", 4)], "k string, x int")
    p = spark.createDataFrame([("a", 2), ("a", 1), ("a", 1), (None, 9), ("", 7)], "k string, v int")
    f = spark.createDataFrame([("a", 5), ("b", None), ("b", 6)], "k string, w int")
    return parents, p, f


def test_no_sums_where_no_key_fills_a_part(spark, rows):
    parents, p, f = _rows_of_kinds(spark)

    def nested(most, heaviest, weight=None):
        children = {"P": reshape.Children(p, ["v"], ["v"], most=most), "F": reshape.Children(f.withColumn("_w", F.lit(1)), ["w"], ["w"], weight, most, heaviest)}
        return reshape.attach_children(parents, children, "k", 8)

    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    want = rows(nested(None, None).withColumns({n: F.to_json(n) for n in ("P", "F")}))
    for most, heaviest, weight, windows in [(3, None, None, False), (3, 5, "_w", False), (3, 6, "_w", True), (3, None, "_w", True), (5, None, None, True)]:
        got = nested(most, heaviest, weight)
        assert ("Window" in plan(got)) == windows
        assert rows(got.withColumns({n: F.to_json(n) for n in ("P", "F")})) == want


@pytest.mark.parametrize("max_weight", [1, None])
def test_children_are_shuffled_once(spark, max_weight):
    # What is summed up by parent already lies as the join with the parents needs it.
    parents, p, f = _rows_of_kinds(spark)
    children = {"P": reshape.Children(p, ["v"], ["v"], most=3), "F": reshape.Children(f, ["w"], ["w"], most=3)}
    plan = reshape.attach_children(parents, children, "k", max_weight)._jdf.queryExecution().toString().split("Physical Plan")[1]
    assert plan.count("Exchange") == 2


def test_bound_by_buckets(spark, monkeypatch):
    from rivertally.operators import ordered

    df = spark.range(1000).select(F.when(F.col("id") < 40, None).otherwise(F.col("id") % 100).alias("k"))
    assert ordered.bucket_bound(df, ["k"]) >= 40 and ordered.bucket_bound(df, ["k"], 39) == 40
    assert ordered.bucket_bound(df.limit(0), ["k"]) == 0
    monkeypatch.setattr(ordered, "BUCKETS", 1)
    assert ordered.bucket_bound(df, ["k"]) == 1000 and ordered.bucket_bound(df, ["k"], 999) == 40


def test_sums_before(spark, rows):
    from rivertally.operators.ordered import sum_before

    df = spark.createDataFrame([("a", 1, 5), ("a", 1, 5), ("a", 0, 2), ("a", None, 1), ("b", 1, 7), (None, 3, 4)], "k string, t long, w long")
    want = [(None, 3, 0), ("a", None, 12), ("a", 0, 0), ("a", 1, 2), ("a", 1, 7), ("b", 1, 0)]
    assert rows(sum_before(df, ["k"], ["t"], "w", "s"), "k", "t", "s") == want
    assert rows(sum_before(df, ["k"], ["t"], "w", "s", hot_rows=1), "k", "t", "s") == want


@pytest.mark.parametrize("max_levels", [100, 1])
def test_complete(spark, rows, max_levels):
    df = spark.createDataFrame(
        [("a", 1, "SM", 3), ("a", 1, "SM", 4), ("b", None, None, 1), ("c", 2, "WE", None)], "site string, reach long, species string, n long"
    )
    got = reshape.complete(df, ["site", "reach"], ["species"], {"n": 0}, max_levels=max_levels)
    want = [
        ("a", 1, None, 0), ("a", 1, "SM", 3), ("a", 1, "SM", 4), ("a", 1, "WE", 0),
        ("b", None, None, 1), ("b", None, "SM", 0), ("b", None, "WE", 0),
        ("c", 2, None, 0), ("c", 2, "SM", 0), ("c", 2, "WE", 0),
    ]
    assert sorted(map(str, rows(got))) == sorted(map(str, want))


def test_complete_has_every_pair_once(spark):
    df = spark.range(60).select((F.col("id") % 10).alias("p"), (F.col("id") * 7 % 6).alias("l"), F.lit(1).alias("n")).distinct()
    got = reshape.complete(df, ["p"], ["l"], {"n": 0})
    assert got.count() == 60 and got.select("p", "l").distinct().count() == 60


def test_grid_plan_has_no_cartesian_product(spark):
    grid = reshape.level_grid(spark.range(10), spark.createDataFrame([("a",), (None,)], "s string"))
    plan = grid._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert grid.count() == 20


def test_large_grids_are_cut_into_even_blocks(spark):
    parents, levels = spark.range(300).unionByName(spark.range(3)), spark.range(40).withColumnRenamed("id", "l")
    grid = reshape.level_grid(parents, levels, max_levels=1, block_cells=400)
    assert grid.count() == 303 * 40 and grid.distinct().count() == 300 * 40
    plan = grid._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_pivot_and_values(spark, rows):
    df = spark.createDataFrame([(1, "loc1", 5, "a"), (1, "mx", 9, "b"), (2, "loc2", 1, None)], "k long, location string, depth long, sub string")
    wide = reshape.pivot_wide(df, ["k"], "location", ["depth", "sub"], ["loc1", "loc2", "mx"])
    assert wide.columns == ["k", "loc1_depth", "loc1_sub", "loc2_depth", "loc2_sub", "mx_depth", "mx_sub"]
    assert rows(wide) == [(1, 5, "a", None, None, 9, "b"), (2, None, None, 1, None, None, None)]


def test_split(spark, rows):
    df = spark.createDataFrame([("ls_1", " SM  WE "), ("ls_2", None), ("ls_3", "")], "c string, codes string")
    assert rows(reshape.split_codes(df, "codes", "s").select("c", "s")) == [("ls_1", "SM"), ("ls_1", "WE")]


@pytest.mark.parametrize("max_levels", [100, 1])
@pytest.mark.parametrize("with_parents", [True, False])
def test_fill_levels_equals_complete(spark, rows, max_levels, with_parents):
    df = spark.createDataFrame([("a", None, "SM", 3), ("a", None, None, 1), ("b", 2, "WE", None), (None, 1, "SM", 2)], "site string, reach long, species string, n long")
    keys = ["site", "reach"]
    parents = df.select(*keys).distinct().withColumn("extra", F.lit(1)) if with_parents else None
    got = reshape.fill_levels(df, keys, "species", {"n": 0}, parents=parents, max_levels=max_levels)
    assert rows(got, *keys, "species", "n") == rows(reshape.complete(df, keys, ["species"], {"n": 0}), *keys, "species", "n")
    assert ("extra" in got.columns) == with_parents
