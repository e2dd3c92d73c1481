"""Interval joins, id sets, schema drift, landed texts and comparisons of builds, against small cases worked out by hand or by loops."""

import random

import pytest
from pyspark.sql import functions as F

from cohortlake.operators import evidence, intervals, profiling
from cohortlake.sources import tables


@pytest.mark.parametrize("width", [1, 3, 64])
def test_interval_join_equals_all_pairs(spark, width):
    draw = random.Random(width)
    points = [(i, draw.choice(["a", "b", None]), draw.choice([None, *range(-30, 60)])) for i in range(80)]
    spans = [(k, draw.choice(["a", "a", "b", "c", None]), low, low + draw.choice([-2, 0, 0, 1, 5, 40, 10_000])) for k, low in ((k, draw.choice([None, *range(-30, 60)]) or 0) for k in range(60))] + [(99, "a", None, 5), (98, "a", 5, None)]
    found = intervals.left_interval_join(
        spark.createDataFrame(points, "id INT, k STRING, at BIGINT"), spark.createDataFrame(spans, "span INT, k STRING, low BIGINT, high BIGINT"), "id", ["k"], "at", "low", "high", width
    )
    assert found.columns == ["id", "k", "at", "span", "low", "high"]
    wanted = []
    for i, k, at in points:
        own = [(i, k, at, *s[:1], *s[2:]) for s in spans if k is not None and k == s[1] and None not in (at, *s[2:]) and s[2] <= at <= s[3]]
        wanted += own or [(i, k, at, None, None, None)]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, wanted))
    none = intervals.left_interval_join(found.select("id", "k", "at").distinct(), spark.createDataFrame([], "span INT, k STRING, low BIGINT, high BIGINT"), "id", ["k"], "at", "low", "high")
    assert none.where("span IS NULL").count() == len(points)


def test_id_sets_over_many_sources(spark):
    held = {name: [str(i) for i in range(100) if i % k == 0] + [None] for name, k in (("two", 2), ("three", 3), ("five", 5), ("seven", 7))}
    sources = {name: spark.createDataFrame([(i,) for i in ids + ids[:3]], "id STRING") for name, ids in held.items()}
    masks = profiling.source_masks(sources)
    numbers = lambda e: {int(r.id) for r in profiling.id_set(masks, list(sources), e).collect()}
    assert numbers("two AND three AND NOT five") == {i for i in range(100) if i % 6 == 0 and i % 5}
    assert numbers("(five OR seven) AND NOT (two OR three)") == {i for i in range(100) if (i % 5 == 0 or i % 7 == 0) and i % 2 and i % 3}
    rows = {(r.left_source, r.right_source): (r.only_left, r.only_right, r.both) for r in profiling.compare_sources(sources).collect()}
    assert rows["five", "two"] == (10, 40, 10) and len(rows) == 6
    apart = profiling.differing_ids(sources)
    assert {int(r.id) for r in apart.where("left_source = 'five' AND right_source = 'two' AND side = 'left'").collect()} == {i for i in range(0, 100, 5) if i % 2}
    one = profiling.summarize_source(sources["two"], "id").first()
    assert tuple(one) == (54, 1, 50, 3, 3)
    assert tuple(profiling.summarize_source(sources["two"].limit(0), "id").first()) == (0, 0, 0, 0, 0)


def test_paths_of_schemas():
    found = profiling.paths_of("OBJECT<`a b`: BIGINT, c: ARRAY<OBJECT<d: DECIMAL(2,1), `x: ``y`: STRING>>, e: OBJECT<>>")
    assert found == {"$": "OBJECT", "a b": "BIGINT", "c": "ARRAY", "c[*]": "OBJECT", "c[*].d": "DECIMAL(2,1)", "c[*].x: `y": "STRING", "e": "OBJECT"}
    assert profiling.paths_of("VOID") == {"$": "VOID"} and profiling.paths_of("ARRAY<BIGINT>") == {"$": "ARRAY", "[*]": "BIGINT"}


def test_drift_of_broken_and_equal_shards(spark):
    rows = [("a", '{"x": 1}'), ("b", '{"x": 2}'), ("c", '{"x": "t", "y": [1]}'), ("d", "{broken"), ("e", None)]
    found = {(r.shard, r.path): (r.change, r.expected, r.found) for r in profiling.schema_drift(spark.createDataFrame(rows, "shard STRING, text STRING"), "shard", "text").collect()}
    assert found["c", "x"] == ("retyped", "BIGINT", "STRING") and found["c", "y"][0] == "added" and found["d", "x"] == found["e", "x"] == ("removed", "BIGINT", None)
    assert {k[0] for k in found} == {"c", "d", "e"}
    same = spark.createDataFrame(rows[:2], "shard STRING, text STRING")
    assert profiling.schema_drift(same, "shard", "text").isEmpty() and profiling.schema_drift(same.limit(0), "shard", "text").isEmpty()


def test_landed_values_of_repeated_ids(spark):
    lines = spark.createDataFrame([('{"id": "1", "v": {"a": 1, "b": [2]}}',), ('{"id": "1", "v": {"a": 2}}',), ('{"id": "2", "v": null}',), ('{"id": "3", "v": [1, 2]}',), ('{"id": "4"}',), ("broken",)], "value STRING")
    stored = spark.createDataFrame([("1", '{"a":2}'), ("1", '{"b":[2],"a":1}'), ("2", None), ("3", "[2,1]"), ("4", "{"), ("5", "1")], "id STRING, v STRING")
    assert tuple(profiling.landed_fidelity(lines, "value", stored, "id", ["v"]).first()) == ("v", 5, 5, 4, 2)  # 1 and 2 are the same


def test_landed_lines_meet_stored_records_in_one_shuffle(spark):
    lines = spark.createDataFrame([('{"id": "1", "v": {"b": 1, "a": null}, "w": [1]}',), (' {"id": 2, "v": "x"}',), ('[{"id": "3", "v": 1}]',), ('{"id": "4", "v": 1, "w": ',), ('{"id": "5", "v": 1} ',)], "value STRING")
    stored = spark.createDataFrame([("1", '{"a":null,"b":1}', "[1]"), ("2", '"x"', "null"), ("3", "1", None), ("4", "1", None), (None, "1", None)], "id STRING, v STRING, w STRING")
    found = profiling.landed_fidelity(lines, "value", stored, "id", ["v", "w"])
    assert [tuple(r) for r in found.collect()] == [("v", 5, 4, 4, 2), ("w", 5, 2, 2, 2)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("parseJson(value") == 0  # lines are not made variants as a whole, let alone once for each column


def test_landed_lines_are_dealt_by_id_if_there_are_many(spark):
    lines = spark.range(40).selectExpr("to_json(named_struct('id', 'W' || id, 'v', array(id))) AS value")
    stored = spark.range(40).selectExpr("'W' || id AS id", "'[' || id % 30 || ']' AS v")
    many, few = profiling.landed_fidelity(lines, "value", stored, "id", ["v"], most=10), profiling.landed_fidelity(lines, "value", stored, "id", ["v"])
    assert tuple(many.first()) == tuple(few.first()) == ("v", 40, 40, 40, 30)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert plan(many).count("Exchange hashpartitioning") == plan(few).count("Exchange hashpartitioning") == 1 and "8), REPARTITION_BY_NUM" in plan(many)


def test_builds_agree_under_a_tolerance(spark):
    schema = "k STRING, n BIGINT, r DOUBLE, f BOOLEAN"
    make = lambda *rows: spark.createDataFrame(rows, schema)
    judge = lambda b, **more: evidence.compare_builds(make(("a", 100, 0.5, True), ("b", 10, None, False)), b, ["k"], ["n"], ["r"], ("f",), **more).first()
    near = make(("a", 98, 0.51, True), ("b", 10, None, False))
    assert judge(near, count_tolerance=0.02, ratio_tolerance=0.02).agree and not judge(near).agree
    assert judge(near).cells_beyond == 1 and judge(near).worst_n == 2
    flipped = judge(make(("a", 100, 0.5, True), ("b", 10, None, True)))
    assert (flipped.changed_f, flipped.agree) == (1, False)
    half = judge(make(("a", 100, None, True), ("c", 10, None, False)), ratio_tolerance=1.0)
    assert (half.missing_left, half.missing_right, half.cells_beyond, half.agree) == (1, 1, 1, False)


def test_an_extract_is_validated(spark, tmp_path):
    rows = spark.createDataFrame([("x", 1, 0.5), ("y", 1, 0.25)], "k STRING, age INT, g DOUBLE")
    ask = lambda df, **more: tables.read_extract(spark, _csv(df, tmp_path), rows.schema, ("k",), "age = 1", rows.select("k"), **more)
    assert ask(rows).count() == 2
    for bad, said in ((rows.where("k = 'x'"), "missing"), (rows.unionByName(rows.limit(1)), "repeated"), (rows.withColumn("age", F.lit(2)), "outside"), (rows.withColumn("k", F.concat("k", F.lit("z"))), "foreign")):
        with pytest.raises(tables.ContractError, match=said):
            ask(bad)


def test_an_example_is_the_first_in_the_order_of_keys_as_texts(spark):
    rows = spark.createDataFrame([(123, "a"), (12, "b"), (9, None)], "k BIGINT, s STRING")
    example = lambda keys: tables.extract_problems(rows, keys, "false").first().example
    assert example(("k",)) == '{"k":12}'  # 12 is before 123, though the brace behind it comes after all digits
    assert example(("s", "k")) == '{"k":9}' and example(()) == '{"k":12,"s":"b"}'


def _csv(df, tmp_path):
    path = str(tmp_path / f"csv{len(list(tmp_path.iterdir()))}")
    df.coalesce(1).write.option("header", True).csv(path)
    return path
