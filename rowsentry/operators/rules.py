"""Many event rules at once: a table of conditions, matched by one join and checked in the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rowsentry.operators.sizing import SMALL_ROWS, kept, settle_small

#: A rule asks, for each of its paths, for one of the path's values. Paths are dotted.
RULES_DDL = "rule STRING, path STRING, value STRING"


def rule_plans(rules: DataFrame) -> DataFrame:
    """``path, value, rule, conditions``: a row for each value of a rule's anchor, with all conditions as a map of path to values.

    The anchor is the path whose values the fewest rules name, ties to the smaller path: it decides which events meet the rule
    first, never the result. Rows without a rule, path or value say nothing, repeated ones say it once.
    """
    told = rules.select("rule", "path", F.col("value").cast("string").alias("value")).dropna().distinct()
    crowd = told.groupBy("path", "value").agg(F.count("*").alias("_crowd"))
    each = told.join(crowd, ["path", "value"]).groupBy("rule", "path").agg(
        F.sum("_crowd").alias("_crowd"), F.array_sort(F.collect_set("value")).alias("values"))
    whole = each.groupBy("rule").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("path", "values")))).alias("conditions"),
        F.min_by("path", F.struct("_crowd", "path")).alias("path"))
    return whole.select("path", F.explode(F.element_at("conditions", F.col("path"))).alias("value"), "rule", "conditions")


def _facts(df: DataFrame, path: str, json_column: str | None) -> Column:
    """The texts an event has at a path, without nulls: all elements of an array, else one or none."""
    steps = path.split(".")
    kind: T.DataType = df.schema
    if steps[0] not in df.columns:
        if json_column is None:
            raise ValueError(f"no column {steps[0]} for the path {path}")
        found = F.get_json_object(F.col(json_column), "$" + "".join(f"['{s}']" for s in steps))
        return F.array_compact(F.array(found))
    for step in steps:
        kind = kind[step].dataType
    found = F.col(".".join(f"`{s}`" for s in steps))
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.array_distinct(F.array_compact(found.cast("array<string>"))), F.array().cast("array<string>"))
    return F.array_compact(F.array(found.cast("string")))


def match_rules(events: DataFrame, rules: DataFrame, json_column: str | None = None) -> DataFrame:
    """Each event once for every rule it meets, with ``rule`` added; events may be a stream.

    ``rules`` has the columns of ``RULES_DDL``. A path is a column, a field of a struct column, or else a path inside
    ``json_column``; values are compared as text, and an array meets a condition when any element does. An event's texts meet
    the anchors of all rules in one join, and the other conditions are checked in the row, so that nothing is counted or
    grouped afterwards. Plans of few rows (measured) are broadcast. Of more, those of the anchors with the fewest still are, so that
    paths of few values, which many events share, move no event; the others are joined by a shuffle. The distinct paths of all
    rules come to the driver, as they become expressions of the plan.
    """
    plans, size = settle_small(rule_plans(rules))
    paths = sorted(r["path"] for r in rules.select("path").dropna().distinct().collect())
    if not paths:
        return events.withColumn("rule", F.lit(None).cast("string")).filter(F.lit(False))
    facts = F.create_map(*[x for p in paths for x in (F.lit(p), _facts(events, p, json_column))])
    own = F.struct(*[F.col(f"`{c}`") for c in events.columns])
    rows = events.select(own.alias("_event"), facts.alias("_facts"))
    # Only anchors need a row.
    if size is None:
        plans = kept(plans)
    sizes = {r["path"]: r["n"] for r in plans.groupBy("path").agg(F.count("*").alias("n")).collect()}
    anchors, few, held = sorted(sizes), [], 0
    for p in sorted(anchors, key=lambda p: (sizes[p], p)):
        held += sizes[p]
        if size is not None or held <= SMALL_ROWS:
            few.append(p)

    def placed(path: str) -> Column:
        return F.transform(F.element_at("_facts", F.lit(path)), lambda v: F.struct(F.lit(path).alias("path"), v.alias("value")))

    def meeting(some: list[str], small: bool) -> DataFrame:
        spread = F.flatten(F.array(*[placed(p) for p in some]))
        spread = rows.withColumn("_at", F.explode(spread)).select("_event", "_facts", "_at.path", "_at.value")
        theirs = plans if len(some) == len(anchors) else plans.filter(F.col("path").isin(some))
        return spread.join(F.broadcast(theirs) if small else theirs, ["path", "value"])

    if not anchors:
        return events.withColumn("rule", F.lit(None).cast("string")).filter(F.lit(False))
    many = [p for p in anchors if p not in few]
    parts = [meeting(some, small) for some, small in ((few, True), (many, False)) if some]
    met = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    holds = F.forall(F.map_keys("conditions"), lambda p: F.arrays_overlap(F.element_at("conditions", p), F.element_at("_facts", p)))
    met = met.filter(holds)
    if any(isinstance(_kind(events, p), T.ArrayType) for p in anchors):
        # An event whose array has several of the anchor's values is met once: at the first of them.
        first = F.array_min(F.array_intersect(F.element_at("conditions", F.col("path")), F.element_at("_facts", F.col("path"))))
        met = met.filter(F.col("value") == first)
    return met.select("_event.*", "rule")


def _kind(df: DataFrame, path: str) -> T.DataType | None:
    kind: T.DataType = df.schema
    for step in path.split("."):
        if not isinstance(kind, T.StructType) or step not in kind.names:
            return None
        kind = kind[step].dataType
    return kind
