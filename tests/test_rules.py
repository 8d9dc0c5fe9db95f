"""Rules as data against a plain reading of the rules."""

import random

import pytest

from panelcast.operators import rules as op

KEYS = ["a", "b", "c"]
RULES = "priority int, a string, b string, c string, label string"
FACTS = "id int, a string, b string, c string, sales double"


def fits(rule, fact):
    return all(r is None or r == f for r, f in zip(rule[1:4], fact[1:4]))


def made(seed, n_rules, wildcard):
    rng = random.Random(seed)
    key = lambda none: None if rng.random() < none else rng.choice("xyz")
    rules = [(rng.randrange(n_rules), key(wildcard), key(wildcard), key(wildcard), rng.choice("pqrs")) for _ in range(n_rules)]
    facts = [(i, key(0.2), key(0.2), key(0.2), float(i)) for i in range(300)]
    return rules, facts


@pytest.mark.parametrize("seed, n_rules, wildcard", [(1, 12, 0.4), (2, 60, 0.5), (3, 30, 0.1), (4, 5, 0.9), (5, 0, 0.5)])
def test_first_match_and_report_equal_a_plain_reading(spark, seed, n_rules, wildcard):
    rules, facts = made(seed, n_rules, wildcard)
    table, rows = spark.createDataFrame(rules, RULES), spark.createDataFrame(facts, FACTS)
    got = op.first_match(rows, table, KEYS, ["label"])
    expected = {}
    for f in facts:
        expected[f[0]] = min(((r[0], r[4]) for r in rules if fits(r, f)), default=(None, None))
    assert {r.id: (r.rule, r.label) for r in got.collect()} == expected and got.count() == len(facts)

    report = op.conflicts(table, KEYS, ["label"])
    place = lambda r: (r[0], r[4])

    def want(r):
        earlier = [e for e in set(rules) if place(e) < place(r)]
        met = [e for e in earlier if all(x is None or y is None or x == y for x, y in zip(e[1:4], r[1:4]))]
        cover = [e for e in met if fits(e, r)]
        first = lambda some: min((e[0] for e in some), default=None)
        return (*r, first(cover), first([e for e in met if e not in cover]))

    assert sorted(map(tuple, report.collect()), key=repr) == sorted(map(want, set(rules)), key=repr)


def test_status_counts_the_rows_each_rule_decided(spark):
    rules = [(0, "x", None, None, "p"), (1, "x", "y", None, "q"), (2, None, "y", None, "r"), (3, "z", "z", None, "s"), (4, None, None, None, "t")]
    facts = [(1, "x", "y", None, 1.0), (2, "y", "y", "x", 2.0), (3, None, None, None, 4.0)]
    table, rows = spark.createDataFrame(rules, RULES), spark.createDataFrame(facts, FACTS)
    matched = op.first_match(rows, table, KEYS, ["label"])
    out = op.usage(op.conflicts(table, KEYS, ["label"]), matched, ["sales"])
    got = {r.priority: (r.status, r.n_rows, r.sales) for r in out.collect()}
    assert got == {0: ("clear", 1, 1.0), 1: ("unreachable", 0, 0.0), 2: ("partly", 1, 2.0), 3: ("unused", 0, 0.0), 4: ("partly", 1, 4.0)}


def test_a_listed_rule_set_keeps_its_order(spark):
    rows = spark.createDataFrame([("x", "y")], "a string, b string")
    listed = op.from_rows(rows, [("x", None, 2.0), ("x", "y", 3.0)], ["a", "b"], "factor double")
    assert op.first_match(rows, listed, ["a", "b"], ["factor"]).first().factor == 2.0
