"""Acting on state-change events as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from rowsentry.operators.rows import event_pattern_filter
from rowsentry.operators.rules import match_rules


def start_events(stream: DataFrame, pattern: Mapping, act: Callable[[DataFrame, int], None], checkpoint: str,
                 json_column: str | None = None):
    """Hand the matching events of every micro-batch to ``act(batch, batch_id)``.

    ``act`` typically appends to the registry or rewrites the deployment table; it must give the
    same result when a batch is retried. Returns the started query.
    """
    kept = event_pattern_filter(stream, pattern, json_column)
    return (kept.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .foreachBatch(act).trigger(availableNow=True).start())


def start_rules(stream: DataFrame, rules: DataFrame, act: Callable[[DataFrame, int], None], checkpoint: str, json_column: str | None = None):
    """Hand every micro-batch's events, once for each rule of the table that they meet, to ``act(batch, batch_id)``.

    The rules are those at the start of the query. Returns the started query; ``act`` as in :func:`start_events`.
    """
    met = match_rules(stream, rules, json_column)
    return (met.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .foreachBatch(act).trigger(availableNow=True).start())
