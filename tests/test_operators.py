import random

import pytest
from frames import plan_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from estrato.functions.measures import bucketize, business_key, gap, pct, target_for_year
from estrato.operators.evolution import evolution
from estrato.operators.joins import spread_left_join
from estrato.operators.ranking import rank_within
from estrato.operators.rollup import sample_rollup
from estrato.operators.territory import with_region, with_territory


def _values(df, *names):
    return sorted(df.select(*names).collect(), key=repr)


def _scores(spark, seed, n=600):
    rng = random.Random(seed)
    special = [None, float("nan"), float("inf"), float("-inf"), -0.0, 0.0]
    rows = []
    for i in range(n):
        value = rng.choice(special) if rng.random() < 0.1 else rng.choice([rng.uniform(-250, 250), 50.0, 49.99])
        rows.append((i, rng.choice([2023, 2024, None]), value))
    return spark.createDataFrame(rows, "id int, ano int, x double")


@pytest.mark.parametrize("seed", [5, 10])
def test_rank_matches_sql_rank(spark, seed):
    scores = _scores(spark, seed=seed)
    plain = Window.partitionBy("ano").orderBy(F.col("x").desc_nulls_last())
    expected = scores.withColumn("r", F.rank().over(plain).cast("bigint"))
    got = rank_within(scores, ["ano"], "x", output="r")
    assert _values(got, "id", "r") == _values(expected, "id", "r")


def test_rank_leaves_gaps_after_ties(spark):
    rows = spark.createDataFrame([("a", 80.0), ("b", 80.0), ("c", 70.0), ("d", None)], "uf string, x double")
    ranked = rank_within(rows.withColumn("ano", F.lit(2024)), ["ano"], "x")
    assert {r.uf: r["rank"] for r in ranked.collect()} == {"a": 1, "b": 1, "c": 3, "d": 4}


def test_rank_never_sorts_a_whole_group_in_one_window(spark):
    ranked = rank_within(_scores(spark, seed=1), ["ano"], "x")
    windows = [line for line in plan_of(ranked).splitlines() if "Window [" in line]
    assert windows
    # Every window is over ranges: inside one, or over the table of range sizes.
    assert all("_range" in line for line in windows)


@pytest.mark.parametrize("number", ["if(id % 2 = 0, 50, id)", "id * 1e5"])
def test_rank_splits_one_group_by_its_values(spark, number):
    rows = spark.range(0, 10_000, 1, 4).selectExpr("2024 AS ano", f"CAST({number} AS double) AS x", "id")
    merging = "spark.sql.adaptive.coalescePartitions.enabled"  # would make one partition of so few values
    spark.conf.set(merging, "false")
    try:
        ranked = rank_within(rows, ["ano"], "x", output="r")
    finally:
        spark.conf.unset(merging)
    expected = {float(r.x): r.r for r in rows.groupBy("x").count().withColumn(
        "r", F.sum("count").over(Window.orderBy(F.desc("x"))) - F.col("count") + 1).collect()}
    assert all(r.r == expected[r.x] for r in ranked.collect())
    # No task holds the year: the ranges that the ranks were counted in split it.
    assert len({f for f in ranked.inputFiles() if "/rank-" in f}) > 1


def test_evolution_takes_the_previous_available_year(spark):
    rows = [("SP", 2023, 50.0), ("SP", 2025, 53.335), ("AC", 2024, 51.38), ("RJ", 2023, None), ("RJ", 2024, 10.0)]
    base = spark.createDataFrame(rows, "uf string, ano int, x double").withColumn("serie", F.lit(2))
    out = evolution(base, "x", ["uf"], "ano", ["serie"])
    got = {(r.uf, r.ano): (r.previous, r.change) for r in out.collect()}
    assert got[("SP", 2025)] == (50.0, 3.34)
    assert got[("AC", 2024)] == (None, None)
    assert got[("RJ", 2024)] == (None, None)


def test_evolution_matches_lag_with_ties_nulls_and_a_hot_partition(spark):
    rng = random.Random(7)
    rows = []
    for i in range(900):
        uf = "SP" if i % 3 == 0 else rng.choice(["AC", "RJ", None])
        rows.append((i, uf, rng.choice([2023, 2024, 2025, 2026, None]), i, rng.choice([None, rng.uniform(0, 100)])))
    base = spark.createDataFrame(rows, "id int, uf string, ano int, serie int, x double")
    plain = Window.partitionBy("uf").orderBy(F.col("ano").asc_nulls_last(), F.col("serie").asc_nulls_first())
    expected = base.withColumn("previous", F.lag("x").over(plain))
    got = evolution(base, "x", ["uf"], "ano", ["serie"])
    assert _values(got, "id", "previous") == _values(expected, "id", "previous")


def test_spread_join_equals_the_plain_left_join(spark):
    left = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 2024).when(F.col("id") % 3 == 1, 2023).alias("ano")
    )
    right = spark.createDataFrame([(2024, "a"), (2024, "b"), (2022, "c"), (None, "d")], "ano int, rede string")
    expected = left.join(right, ["ano"], "left")
    got = spread_left_join(left, right, ["ano"], spread_by=["id"], slices=5)
    assert _values(got, "id", "ano", "rede") == _values(expected, "id", "ano", "rede")


def test_territory_from_code_and_from_acronym(spark):
    places = spark.createDataFrame([("3550308",), ("9912345",), ("11",), (None,)], "id string")
    got = {r.id: (r.codigo_uf, r.sigla_uf, r.regiao) for r in with_territory(places, "id").collect()}
    assert got == {
        "3550308": ("35", "SP", "Sudeste"),
        "9912345": ("99", None, None),
        "11": ("11", "RO", "Norte"),
        None: (None, None, None),
    }
    states = spark.createDataFrame([("DF",), ("XX",), (None,)], "uf string")
    assert {r.uf: r.regiao for r in with_region(states, "uf").collect()} == {"DF": "Centro-Oeste", "XX": None, None: None}


def test_rollup_ignores_unusable_rows_and_missing_values(spark):
    rows = [
        ("m", True, True, 1, 1, 10.0, None),
        ("m", True, True, 0, None, None, None),
        ("m", True, False, 1, 1, 99.0, 9.0),
        ("m", False, True, 1, 1, 99.0, 9.0),
    ]
    schema = (
        "id_municipio string, flag_id_municipio_valido boolean, flag_id_aluno_preenchido boolean, "
        "alfabetizado int, presenca int, proficiencia double, peso_aluno double"
    )
    row = sample_rollup(spark.createDataFrame(rows, schema), ["id_municipio"]).first()
    assert tuple(row) == ("m", 2, 1, 1, 10.0, None)


def test_rollup_keeps_measures_that_are_no_decimals(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(g, True, True, 1, 1, x, x) for g, x in [("big", 2e20), ("big", 2.0), ("inf", inf), ("inf", 1.0), ("nan", nan)]]
    schema = (
        "id_municipio string, flag_id_municipio_valido boolean, flag_id_aluno_preenchido boolean, "
        "alfabetizado int, presenca int, proficiencia double, peso_aluno double"
    )
    found = {r[0]: tuple(r[1:]) for r in sample_rollup(spark.createDataFrame(rows, schema), ["id_municipio"]).collect()}
    assert found["big"] == (2, 2, 2, 1e20, 2e20) and found["inf"] == (2, 2, 2, inf, inf)
    assert found["nan"][:3] == (1, 1, 1) and all(x != x for x in found["nan"][3:])


def test_business_key_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([(2024, "SP"), (None, "SP")], "ano int, uf string")
    assert [r.k for r in df.select(business_key("ano", "uf").alias("k")).collect()] == ["2024_SP", None]


def test_percentages_round_half_up_and_need_a_positive_whole(spark):
    df = spark.createDataFrame([(1, 32), (2, 3), (0, 5), (1, 0), (None, 4), (201, 20000)], "a bigint, b bigint")
    got = [r.p for r in df.select(pct(F.col("a"), F.col("b"), 2).alias("p")).collect()]
    assert got == [3.13, 66.67, 0.0, None, None, 1.01]


def test_gap_and_target_of_the_year(spark):
    df = spark.createDataFrame(
        [(2023, 50.0, 60.0, 70.0), (2024, 50.0, 60.0, 70.0), (2025, 50.005, 60.0, None), (2031, 1.0, 2.0, 3.0)],
        "ano int, x double, m24 double, m25 double",
    )
    target = target_for_year("ano", {2024: "m24", 2025: "m25"})
    rows = df.select(target.alias("t"), gap(F.col("x"), target).alias("g")).collect()
    assert [tuple(r) for r in rows] == [(None, None), (60.0, -10.0), (None, None), (None, None)]


def test_priority_borders(spark):
    df = spark.createDataFrame([(49.99,), (50.0,), (69.99,), (70.0,)], "x double")
    labels = [r.b for r in df.select(bucketize(F.col("x"), (50, 70), ("A", "M", "B")).alias("b")).collect()]
    assert labels == ["A", "M", "M", "B"]
    with pytest.raises(ValueError, match="label"):
        bucketize(F.col("x"), (50, 70), ("A", "B"))
