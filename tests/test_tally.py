import random

from lensmill.operators.tally import Fact, Metric, tally
from tests.conftest import rows

KEYS = {"k": "k"}


def frame(spark, data):
    return spark.createDataFrame(data, "k string, who long, unit long, kind string, x int")


def sql_value(data, key, kind, pick, where):
    hits = [r for r in data if r[0] == key and where(r)]
    if not hits:
        return None
    values = [pick(r) for r in hits if pick(r) is not None]
    if kind == "count":
        return len(values)
    if kind == "distinct":
        return len(set(values))
    return sum(values) if values else "null"


def test_against_brute_force_with_a_hot_key_and_a_hot_person(spark):
    rng = random.Random(7)
    data = []
    for i in range(6000):
        hot = rng.random() < 0.4
        who = 1 if hot else rng.choice([None, *range(2, 60)])
        data.append(
            (
                "hot" if hot else rng.choice(["a", "b", None]),
                who,
                None if who is None else who * 1000 + rng.randrange(4),
                rng.choice(["s", "s", "r", "n"]),
                rng.choice([None, *range(-3, 9)]),
            )
        )
    metrics = [
        Metric("people", "distinct", "kind = 's'"),
        Metric("net_people", "distinct", "kind = 's'", less="kind = 'r'"),
        Metric("units", "once", "kind = 's'", less="kind = 'r'"),
        Metric("total", "sum", "kind = 's' and x > 6", "x"),
        Metric("net_total", "sum", "kind = 's'", "x", less="kind = 'r'"),
        Metric("n", "count", "kind <> 'n'", "x"),
    ]
    got = {r.k: r for r in tally([Fact(frame(spark, data), KEYS, metrics, "who", "unit")]).collect()}
    for key in ("hot", "a", "b", None):
        sale, ret = (lambda r: r[3] == "s"), (lambda r: r[3] == "r")
        who, unit, x = (lambda r: r[1]), (lambda r: r[2]), (lambda r: r[4])

        def val(kind, pick, where, key=key):
            return sql_value(data, key, kind, pick, where) or 0

        assert got[key].people == val("distinct", who, sale)
        assert got[key].net_people == val("distinct", who, sale) - val("distinct", who, ret)
        assert got[key].units == val("distinct", unit, sale) - val("distinct", unit, ret)
        assert got[key].total == val("sum", x, lambda r: r[3] == "s" and r[4] is not None and r[4] > 6)
        assert got[key].net_total == val("sum", x, sale) - val("sum", x, ret)
        assert got[key].n == val("count", x, lambda r: r[3] != "n")


def test_missing_is_zero_but_a_null_sum_stays_null(spark):
    data = [("a", 1, 10, "s", None), ("b", 1, 11, "n", 5)]
    metrics = [Metric("total", "sum", "kind = 's'", "x"), Metric("n", "count", "true", "unit")]
    assert rows(tally([Fact(frame(spark, data), KEYS, metrics)])) == [("a", None, 1), ("b", 0, 1)]


def test_returns_without_sales_are_dropped(spark):
    data = [("a", 1, 10, "r", 3), ("b", 1, 11, "s", 3), ("b", 2, 12, "r", 3)]
    metrics = [
        Metric("net", "distinct", "kind = 's'", less="kind = 'r'"),
        Metric("units", "once", "kind = 's'", less="kind = 'r'"),
        Metric("amount", "sum", "kind = 's'", "x", less="kind = 'r'"),
    ]
    fact = Fact(frame(spark, data), KEYS, metrics, "who", "unit")
    assert rows(tally([fact])) == [("b", 0, 0, 0)]
    roster = spark.sql("select * from values ('a'), ('b'), ('c') as t(k)")
    assert rows(tally([fact], roster)) == [("a", 0, 0, 0), ("b", 0, 0, 0), ("c", 0, 0, 0)]


def test_sale_side_of_only_null_people_still_nets_returns(spark):
    data = [("a", None, 10, "s", 3), ("a", 2, 12, "r", 3)]
    metrics = [Metric("net", "distinct", "kind = 's'", less="kind = 'r'")]
    assert rows(tally([Fact(frame(spark, data), KEYS, metrics, "who")])) == [("a", -1)]


def test_drop_zero_treats_null_as_a_value(spark):
    data = [("null", 1, 1, "s", None), ("zero", 1, 1, "s", 0), ("net0", 1, 1, "s", 4), ("net0", 1, 1, "r", 4), ("one", 1, 1, "s", 1)]
    sums = [Metric("total", "sum", "kind = 's'", "x", less="kind = 'r'")]
    plain = [Metric("total", "sum", "kind = 's'", "x")]
    assert rows(tally([Fact(frame(spark, data), KEYS, sums)], drop_zero=True), "k") == [("one",)]
    kept = rows(tally([Fact(frame(spark, data), KEYS, plain)], drop_zero=True), "k")
    assert kept == [("net0",), ("null",), ("one",)]


def test_sum_once_takes_each_unit_a_single_time(spark):
    data = [("a", 1, 10, "s", 7), ("a", 1, 10, "s", 7), ("a", 1, 11, "s", 1)]
    metrics = [Metric("every", "sum", "true", "x"), Metric("once", "sum_once", "true", "x")]
    assert rows(tally([Fact(frame(spark, data), KEYS, metrics, once_per="unit")])) == [("a", 15, 8)]


def test_facts_are_combined_by_key(spark):
    first = Fact(frame(spark, [("a", 1, 1, "s", 2)]), KEYS, [Metric("people", "distinct")], "who")
    second = Fact(frame(spark, [("b", 9, 1, "s", 2)]), KEYS, [Metric("total", "sum", "true", "x")])
    assert rows(tally([first, second])) == [("a", 1, 0), ("b", 0, 2)]


def test_150_metrics_in_one_tally_equal_sql(spark):
    """Masks of several words; metrics of every kind lie in each of them."""
    rng = random.Random(5)
    data = [(rng.choice("abc"), rng.randrange(40), rng.randrange(90), rng.choice("srn"), rng.randrange(-9, 30)) for _ in range(3000)]
    data = [(k, who, who * 100 + unit, kind, x) for k, who, unit, kind, x in data]
    data.append(("a", None, None, "s", None))
    frame(spark, data).createOrReplaceTempView("many")
    metrics, sql = [], []
    for i in range(50):
        where = f"x % 50 = {i - 9} or kind = '{'srn'[i % 3]}' and x > {i % 20}"
        metrics += [Metric(f"p{i}", "distinct", where, less=f"x = {i}"), Metric(f"s{i}", "sum", where, "x"), Metric(f"n{i}", "count", where, "x")]
        hit = f"count(distinct who) filter (where {where})"
        sql += [
            f"if(count(*) filter (where {where}) > 0, {hit} - count(distinct who) filter (where x = {i}), 0) as p{i}",
            f"if(count(*) filter (where {where}) > 0, sum(x) filter (where {where}), 0) as s{i}",
            f"count(x) filter (where {where}) as n{i}",
        ]
    roster = spark.sql("select * from values ('a'), ('b'), ('c') as t(k)")
    got = tally([Fact(spark.table("many"), KEYS, metrics, "who")], roster)
    assert rows(got) == rows(spark.sql(f"select k, {', '.join(sql)} from many group by k"))
