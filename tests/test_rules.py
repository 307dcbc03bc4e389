import json

import pytest
from pyspark.sql import functions as F

from rowsentry.operators.rows import event_pattern_filter
from rowsentry.operators.rules import RULES_DDL, match_rules, rule_plans

EVENTS_DDL = "id INT, kind STRING, tags ARRAY<STRING>, detail STRUCT<status: STRING, level: INT>, body STRING"


def _events(spark):
    rows = []
    for i in range(120):
        tags = [None, [], ["a"], ["a", "b", "a"], ["c", None], ["b", "c"]][i % 6]
        rows.append((i, ["x", "y", None][i % 3], tags, (["on", "off", None][i % 5 % 3], i % 4), json.dumps({"n": i % 7, "in": {"deep": i % 2 == 0}}) if i % 11 else None))
    return spark.createDataFrame(rows, EVENTS_DDL)


RULES = {
    "one": {"kind": ["x"]},
    "two": {"kind": ["x", "y"], "tags": ["a", "b"]},
    "nested": {"detail": {"status": ["on"], "level": [1, 3]}},
    "inner": {"n": ["2", "5"], "in": {"deep": ["true"]}, "kind": ["y"]},
    "never": {"kind": ["z"], "tags": ["a"]},
    "tags": {"tags": ["a", "b", "c"]},
}


def _flat(pattern, path=()):
    for key, wanted in pattern.items():
        if isinstance(wanted, dict):
            yield from _flat(wanted, (*path, key))
        else:
            yield from ((".".join((*path, key)), str(v)) for v in wanted)


def _table(spark, rules):
    return spark.createDataFrame([(name, p, v) for name, pattern in rules.items() for p, v in _flat(pattern)], RULES_DDL)


def test_agrees_with_rule_by_rule(spark):
    events, found = _events(spark), {}
    rules = _table(spark, RULES)
    odd = spark.createDataFrame([("one", None, "q"), ("half", "kind", None), (None, "kind", "x"), ("one", "kind", "x")], RULES_DDL)
    for r in match_rules(events, rules.unionByName(odd), "body").collect():
        found.setdefault(r["rule"], []).append(r["id"])
    for name, pattern in RULES.items():
        wanted = [r["id"] for r in event_pattern_filter(events, pattern, "body").collect()]
        assert sorted(found.pop(name, [])) == sorted(wanted), name
    assert not found


def test_many_rules_and_shuffled_plans_agree(spark, monkeypatch):
    events = _events(spark)
    many = {f"r{i}": {"n": [str(i % 7)], "kind": ["x"] if i % 2 else ["x", "y"], "tags": [["a", "b", "c"][i % 3]]} for i in range(3000)}
    rules = _table(spark, many)

    def result():
        rows = match_rules(events, rules, "body").groupBy("rule").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        return {r["rule"]: list(r["ids"]) for r in rows.collect()}

    small = result()
    monkeypatch.setattr("rowsentry.operators.rules.settle_small", lambda df: (df, None))
    assert result() == small
    some = ("r0", "r1", "r2", "r20", "r2999")
    for name in some:
        wanted = sorted(r["id"] for r in event_pattern_filter(events, many[name], "body").collect())
        assert small.get(name, []) == wanted


def test_no_rules_no_events_unknown_path(spark):
    events = _events(spark)
    none = spark.createDataFrame([], RULES_DDL)
    assert match_rules(events, none, "body").count() == 0
    assert match_rules(events, none).columns == [*events.columns, "rule"]
    assert match_rules(events.limit(0), _table(spark, RULES), "body").count() == 0
    with pytest.raises(ValueError, match="no column in"):
        match_rules(events, _table(spark, RULES))


def test_anchor_is_what_few_rules_name(spark):
    rules = _table(spark, {f"r{i}": {"kind": ["x"], "n": [str(i)]} for i in range(5)})
    assert {r["path"] for r in rule_plans(rules).collect()} == {"n"}


def test_anchors_of_few_plans_move_no_event(spark, monkeypatch):
    events = _events(spark)
    many = {f"r{i}": {"n": [str(i)], "kind": ["x", "y"]} for i in range(60)} | {"few": {"tags": ["a"], "kind": ["x"]}, "other": {"kind": ["y"]}}
    rules = _table(spark, many)
    small = sorted((r["id"], r["rule"]) for r in match_rules(events, rules, "body").collect())
    monkeypatch.setattr("rowsentry.operators.rules.settle_small", lambda df: (df, None))
    monkeypatch.setattr("rowsentry.operators.rules.SMALL_ROWS", 10)
    met = match_rules(events, rules, "body")
    assert sorted((r["id"], r["rule"]) for r in met.collect()) == small and small
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 1 and plan.count("Join Inner") == 2, plan
