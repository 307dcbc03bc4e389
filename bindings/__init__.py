"""Operators bound to the driver tables, each with the SQL it must agree with."""

from bindings import (  # noqa: F401
    dictionaries, evaluation, features, files, flagship, merging, monitoring, quality, rows, rules, splits, streams, training,
)
from bindings.catalog import ORACLES, QUERIES  # noqa: F401
