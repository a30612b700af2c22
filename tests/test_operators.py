import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cashline.operators.calendar import date_bounds, date_dimension
from cashline.operators.checks import (
    WARN,
    Check,
    KeyUse,
    Pass,
    SharedKeys,
    duplicate_values,
    missing_parents,
    overlapping_versions,
    run_checks,
    share_keys,
    unaccepted_values,
)
from cashline.operators.joins import lookup, mark_missing, point_in_time
from cashline.operators.versions import (
    attribute_changes,
    latest_version,
    latest_version_by_max,
    one_per_day,
    scd2,
)
from conftest import collected, plan_of

D = dt.date


def history(spark, rows):
    return spark.createDataFrame(rows, "id string, city string, region string, valid_from date, n int")


def test_scd2_versions(spark):
    rows = [
        ("c", "A", None, D(2026, 1, 1), 1),
        ("c", "A", "", D(2026, 1, 2), 2),  # NULL to empty text is no change
        ("c", "X", None, D(2026, 1, 5), 3),
        ("c", "B", None, D(2026, 1, 5), 4),  # same day: the later one counts
        ("c", "A", None, D(2026, 1, 9), 5),
        ("d", "Q", "r", D(2026, 2, 1), 6),
    ]
    got = scd2(history(spark, rows), key="id", attributes=["city", "region"], order_by=[F.desc("n")])
    assert got.columns == ["version_key", "id", "city", "region", "valid_from", "valid_to", "is_current"]
    assert [r[1:3] + r[4:] for r in collected(got, "id", "valid_from")] == [
        ("c", "A", D(2026, 1, 1), D(2026, 1, 4), False),
        ("c", "B", D(2026, 1, 5), D(2026, 1, 8), False),
        ("c", "A", D(2026, 1, 9), D(9999, 12, 31), True),
        ("d", "Q", D(2026, 2, 1), D(9999, 12, 31), True),
    ]


def test_scd2_needs_days(spark):
    df = spark.sql("select 'a' as id, 'x' as city, timestamp '2026-01-01 10:00:00' as valid_from")
    with pytest.raises(TypeError):
        scd2(df, key="id", attributes=["city"])


def test_scd2_is_the_same_whatever_the_input_order(spark):
    rows = [("c", random.choice("AB"), None, D(2026, 1, 1 + i % 5), 0) for i in range(60)]
    results = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        got = scd2(history(spark, rows).repartition(4), key="id", attributes=["city"])
        results.add(tuple(collected(got, "valid_from")))
    assert len(results) == 1


def brute_force_versions(rows):
    """Type 2 history the slow way: (id, attribute, from, to)."""
    out = []
    for key in sorted({r[0] for r in rows}):
        best = {}
        for k, city, _, day, n in rows:
            if k == key and n > best.get(day, (None, -1))[1]:
                best[day] = (city, n)
        changes = []
        for day in sorted(best):
            if not changes or changes[-1][1] != best[day][0]:
                changes.append((day, best[day][0]))
        for i, (day, city) in enumerate(changes):
            end = changes[i + 1][0] - dt.timedelta(1) if i + 1 < len(changes) else D(9999, 12, 31)
            out.append((key, city, day, end))
    return out


@pytest.mark.parametrize("strategy", ["range", "as_of", "auto"])
def test_history_and_point_in_time_against_brute_force(spark, strategy):
    rng = random.Random(7)
    rows = [
        (rng.choice(["hot"] * 3 + list("abcde")), rng.choice("XYZ"), None, D(2026, 1, 1) + dt.timedelta(rng.randint(5, 60)), n)
        for n in range(300)
    ]
    facts = [
        (n, rng.choice(["hot"] * 5 + list("abcdez") + [None]), rng.choice([None] + [D(2026, 1, 1) + dt.timedelta(k) for k in range(80)]))
        for n in range(400)
    ]
    versions = scd2(history(spark, rows), key="id", attributes=["city"], order_by=[F.desc("n")])
    expected = brute_force_versions(rows)
    assert [r[1:5] for r in collected(versions, "id", "valid_from")] == expected
    joined = point_in_time(
        spark.createDataFrame(facts, "n int, customer string, day date"),
        versions,
        key="customer",
        on_date="day",
        version_id="id",
        columns=["city", "valid_from"],
        strategy=strategy,
    )
    wanted = []
    for n, customer, day in facts:
        hits = [v for v in expected if v[0] == customer and day and v[2] <= day <= v[3]]
        wanted.append((n, customer, day, hits[0][1] if hits else None, hits[0][2] if hits else None))
    assert collected(joined, "n") == wanted


def test_point_in_time_strategies(spark):
    facts = spark.sql("select 1 as id, date '2026-01-01' as day")
    versions = spark.sql("select 1 as vid, 'k' as k, date '2026-01-01' as valid_from, date '2026-01-02' as valid_to")
    args = dict(key="id", on_date="day", version_id="vid", columns=["k"])
    with pytest.raises(ValueError):
        point_in_time(facts, versions, strategy="guess", **args)
    assert "Window" not in plan_of(point_in_time(facts, versions, **args))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        unbounded = plan_of(point_in_time(facts, versions, disjoint=True, **args))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert "Window" in unbounded and ">= __from" not in unbounded


@pytest.mark.parametrize("strategy", ["range", "as_of", "auto"])
def test_all_strategies_find_all_versions_in_force(spark, strategy):
    """Overlapping, empty, unbounded and touching periods, NULL keys and dates."""
    r = random.Random(1)
    day = lambda n: None if n is None else D(2026, 1, 1) + dt.timedelta(days=n)
    periods = [
        (r.choice([1, 2, 3, None]), day(r.choice([None, *range(30)])), day(r.choice([None, *range(40)])), n)
        for n in range(40)
    ] + [(9, day(0), day(9), 100), (9, day(10), day(20), 101)]
    facts = [(n, r.choice([1, 2, 3, 9, 7, None]), day(r.choice([None, *range(45)]))) for n in range(300)]
    joined = point_in_time(
        spark.createDataFrame(facts, "n int, customer int, day date"),
        spark.createDataFrame(periods, "id int, valid_from date, valid_to date, version int"),
        key="customer",
        on_date="day",
        version_id="id",
        columns=["version"],
        strategy=strategy,
    )
    wanted = [
        (n, v)
        for n, customer, on in facts
        for v in [p[3] for p in periods if None not in (customer, on, *p) and p[0] == customer and p[1] <= on <= p[2]]
        or [None]
    ]
    assert sorted(collected(joined.select("n", "version")), key=str) == sorted(wanted, key=str)


@pytest.mark.parametrize("strategy", ["range", "as_of"])
def test_overlap_in_a_disjoint_history_raises(spark, strategy):
    periods = [("a", "v1", D(2026, 1, 1), D(2026, 1, 9)), ("a", "v2", D(2026, 1, 5), D(2026, 1, 6)), ("b", "w", D(2026, 1, 1), D(2026, 1, 2))]
    versions = spark.createDataFrame(periods, "id string, k string, valid_from date, valid_to date")

    def joined(customer, day):
        facts = spark.createDataFrame([(customer, day)], "customer string, day date")
        args = dict(key="customer", on_date="day", version_id="id", columns=["k"], strategy=strategy, disjoint=True)
        return point_in_time(facts, versions, **args).collect()[0]["k"]

    assert joined("b", D(2026, 1, 2)) == "w" and joined("a", D(2026, 2, 1)) is None
    with pytest.raises(Exception, match="periods overlap"):
        joined("a", D(2026, 1, 8))


def test_as_of_respects_gaps_between_versions(spark):
    versions = spark.createDataFrame(
        [("a", "v1", D(2026, 1, 1), D(2026, 1, 3)), ("a", "v2", D(2026, 1, 10), D(2026, 1, 12))],
        "id string, k string, valid_from date, valid_to date",
    )
    facts = spark.createDataFrame([(d, "a", D(2026, 1, d)) for d in (1, 3, 4, 9, 10, 13)], "n int, id string, day date")
    for strategy in ("range", "as_of"):
        got = point_in_time(
            facts, versions, key="id", on_date="day", version_id="id", columns=["k"], strategy=strategy
        )
        assert [r[-1] for r in collected(got, "n")] == ["v1", "v1", None, None, "v2", None]


def test_latest_version_forms_agree(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "a", "b"]), rng.randint(0, 50), n) for n in range(500)]
    df = spark.createDataFrame(rows, "k string, day int, n int").repartition(4)
    by_window = collected(latest_version(df, ["k"], [F.desc("day"), F.desc("n")]), "k")
    by_max = collected(latest_version_by_max(df, ["k"], ["day", "n"]), "k")
    expected = [max((r for r in rows if r[0] == k), key=lambda r: r[1:]) for k in ("a", "b", "hot")]
    assert by_window == by_max == expected


def test_latest_version_reduces_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = plan_of(latest_version(df, ["k"], [F.desc("id")]))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_one_per_day_and_changes(spark):
    rows = [("a", "x", None, D(2026, 1, 1), 1), ("a", "y", None, D(2026, 1, 1), 2), ("a", "y", None, D(2026, 1, 2), 3)]
    daily = one_per_day(history(spark, rows), key="id", day="valid_from", order_by=[F.desc("n")])
    assert [r[4] for r in collected(daily, "n")] == [2, 3]
    changes = attribute_changes(daily, key="id", day="valid_from", attributes=["city"])
    assert [(r["n"], r["attributes"]) for r in changes.collect()] == [(2, "y")]


def test_lookup_keeps_every_row_once(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, k string")
    right = spark.createDataFrame([("a", 10), ("c", 30)], "k string, v int")
    assert collected(lookup(left, right, {"k": "k"}, ["v"]), "n") == [(1, "a", 10), (2, "b", None), (3, None, None)]


def test_mark_missing(spark):
    items = spark.createDataFrame(
        [(1, "o1", "10"), (2, "o1", "99"), (3, "o9", "10"), (4, None, "10")], "n int, o string, i string"
    )
    known = spark.createDataFrame([("o1", "10"), ("o1", "10"), ("o2", None)], "order_id string, item string")
    got = mark_missing(items, known, {"o": "order_id", "i": "item"}, "gone")
    assert [r["gone"] for r in got.orderBy("n").collect()] == [False, True, True, True]
    assert got.columns == ["n", "o", "i", "gone"]


def test_calendar(spark):
    a = spark.createDataFrame([(D(2026, 2, 28),), (None,)], "d date")
    b = spark.createDataFrame([(D(2026, 2, 27),), (D(2026, 3, 2),)], "e date")
    got = collected(date_dimension(date_bounds([(a, "d"), (b, "e")])), "date_day")
    assert [(r[0].day, r[5], r[6]) for r in got] == [
        (27, "Friday", False), (28, "Saturday", True), (1, "Sunday", True), (2, "Monday", False),
    ]
    nothing = a.filter("d is null")
    assert date_dimension(date_bounds([(nothing, "d")])).count() == 0
    crossed = spark.sql("select date '2026-01-02' as first_day, date '2026-01-01' as last_day")
    assert date_dimension(crossed).count() == 0


def test_generic_checks_find_planted_rows(spark):
    df = spark.createDataFrame([("a", "USD"), ("a", "EUR"), (None, None), (None, "EUR")], "k string, c string")
    parent = spark.createDataFrame([("b",)], "id string")
    assert collected(duplicate_values(df, ["k"])) == [("a", 2)]
    assert collected(unaccepted_values(df, "c", ["USD", "CAD"])) == [("EUR", 2)]
    assert collected(missing_parents(df, "k", parent, "id")) == [("a", 2)]
    checks = [
        Check("u", "t", "unique", lambda: duplicate_values(df, ["k"])),
        Check("r", "t", "relationships", lambda: missing_parents(df, "k", parent, "id"), "warn", "n_records"),
        Check("ok", "t", "unique", lambda: duplicate_values(parent, ["id"])),
    ]
    got = run_checks(spark, checks, [Pass("t", lambda: df, ["k", "c"])])
    assert {(r["check_name"], r["n_violations"], r["status"]) for r in got.collect()} == {
        ("u", 1, "fail"), ("r", 2, "warn"), ("ok", 0, "pass"), ("not_null_t_k", 2, "fail"), ("not_null_t_c", 1, "fail"),
    }
    assert run_checks(spark, []).count() == 0


def test_overlap_agrees_with_all_pairs(spark):
    rng = random.Random(11)
    for _ in range(6):
        rows = []
        for n in range(rng.randint(2, 14)):
            start = rng.randint(1, 60)
            rows.append((rng.choice("ab"), f"k{n}", D(2026, 1, 1) + dt.timedelta(start), D(2026, 1, 1) + dt.timedelta(start + rng.randint(0, 4))))
        df = spark.createDataFrame(rows, "id string, key string, valid_from date, valid_to date")
        found = collected(overlapping_versions(df, key="id", version_key="key"))
        pairs = {
            (a[0], frozenset((a[1], b[1])))
            for a in rows for b in rows
            if a[0] == b[0] and a[1] < b[1] and a[2] <= b[3] and b[2] <= a[3]
        }
        assert {(i, frozenset((k, o))) for i, k, o in found} <= pairs
        assert bool(found) == bool(pairs)
        assert {i for i, _, _ in found} == {i for i, _ in pairs}


def test_one_pass_answers_all_checks_of_a_table(spark):
    rows = [(1, "a", 5), (2, None, 1), (3, "x", None), (None, "y", 9), (4, "x", 0)]
    df = spark.createDataFrame(rows, "k int, c string, n int")
    one = Pass("t", lambda: df, ["k", "n"], {"c": ["a"], "k": [1, 2, 3]}, {"many": "n > 4", "never": "n > 100"})
    got = {r["check_name"]: (r["kind"], r["n_violations"]) for r in one.summary().collect()}
    assert got == {
        "not_null_t_k": ("not_null", 1),
        "not_null_t_n": ("not_null", 1),
        "many": ("business_rule", 2),
        "never": ("business_rule", 0),
        "accepted_values_t_c": ("accepted_values", 2),
        "accepted_values_t_k": ("accepted_values", 1),
    }
    empty = Pass("t", lambda: df.limit(0), ["k"], {"c": ["a"]}, {"many": "n > 4"}).summary().collect()
    assert {r["n_violations"] for r in empty} == {0} and len(empty) == 3


def test_checks_that_share_a_key_count_as_they_do_alone(spark):
    import random

    r = random.Random(3)
    pick = lambda most, n: [(r.choice([None, *map(str, range(most))]),) for _ in range(n)]
    parent = spark.createDataFrame(pick(12, 10), "k string")
    children = {f"c{n}": spark.createDataFrame(pick(20, 60), "v string") for n in range(3)}
    children["c3"] = spark.createDataFrame([(1,), (30,)], "v int")  # of another type: counted alone
    own = KeyUse(("p", "k"), lambda: parent, "k")
    checks = [Check("unique_p_k", "p", "unique", lambda: duplicate_values(parent, ["k"]), key=own)]
    checks += [
        Check(
            f"rel_{name}", name, "relationships", lambda d=df: missing_parents(d, "v", parent, "k"),
            WARN, "n_records", KeyUse(("p", "k"), lambda d=df: d, "v"),
        )
        for name, df in children.items()
    ]
    shared = share_keys(checks, {("p", "k"): own})
    assert len(shared) == 2
    alone, together = (sorted(map(tuple, run_checks(spark, c).collect())) for c in (checks, shared))
    assert alone == together and sum(row[4] for row in alone) > 0
    empty = spark.createDataFrame([], "k string")
    nothing = SharedKeys(KeyUse(("p", "k"), lambda: empty, "k"), None, [])
    assert nothing.parent.frame().isEmpty()
