"""Secret scans with character Markov models, in Spark SQL functions only.

Two first-order Markov models over characters are trained: one on random strings (the values of the three fixed kinds of
secrets, which label themselves by their surroundings or form), one on ordinary long identifiers (long runs in texts without
such a match). A long run is a secret if the log-likelihood ratio of the two models exceeds ``min_llr`` nats.

Places come from ``split`` and ``regexp_extract_all`` with one pattern: the lengths of what lies between the matches and of the
matches add up to code-point positions. Null and empty texts have no spans; equal texts have equal spans; a column that already
has the name of an output is replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The forms of the three base kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
RUN = r"[A-Za-z0-9+/_=-]{20,}"
IDENTIFIER = r"[A-Za-z0-9+/_=-]{8,}"
KINDS = ("assign", "access", "hex", "markov")
PATTERNS = (ASSIGN, ACCESS, HEX, RUN)

#: Documents that the models are fitted on at most (about; chosen by the hash of their text).
FIT_DOCUMENTS = 10_000
#: Nats by which the random model must beat the identifier model.
MIN_LLR = 12.0
SMOOTHING = 8.0

_LETTERS = "abcdefghijklmnopqrstuvwxyz"
ALPHABET = _LETTERS + _LETTERS.upper() + "0123456789"
#: State 0 is any other character of a run.
STATES = len(ALPHABET) + 1
_BLOCK = 256


@dataclass(frozen=True)
class MarkovModels:
    """Log-likelihood ratios of all transitions, row by row of the first character's state."""

    ratios: tuple[float, ...]
    random_transitions: int
    identifier_transitions: int


def _running(steps: Column) -> Column:
    """Running sums of an array, in blocks: appending to one long array would copy it for every element."""

    def fold(values: Column) -> Column:
        return F.aggregate(values, F.array().cast("array<long>"),
                           lambda acc, x: F.concat(acc, F.array(F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0).cast("long")) + x)))

    count = F.size(steps)
    blocks = F.when(count > 0, F.transform(F.sequence(F.lit(0), F.floor((count - 1) / _BLOCK).cast("int")),
                                           lambda b: fold(F.slice(steps, b * _BLOCK + 1, _BLOCK)))) \
        .otherwise(F.array().cast("array<array<long>>"))
    joined = F.aggregate(
        blocks, F.struct(F.lit(0).cast("long").alias("base"), F.array().cast("array<long>").alias("out")),
        lambda acc, w: F.struct((acc["base"] + F.get(w, F.size(w) - 1)).alias("base"),
                                F.concat(acc["out"], F.transform(w, lambda x: x + acc["base"])).alias("out")))
    return joined["out"]


def _no_spans() -> Column:
    return F.array().cast("array<struct<start:bigint,kind:int,end:bigint,value:string>>")


def _matches(text: Column, kind: int) -> Column:
    """start, kind, end and value of all leftmost non-overlapping matches, failing ones dropped."""
    pattern = PATTERNS[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == 0 else found
    between = F.transform(F.split(text, pattern, -1), lambda s: F.length(s).cast("long"))
    lengths = F.transform(found, lambda s: F.length(s).cast("long"))
    # From one start to the next: the match before, then what lies between.
    steps = F.zip_with(F.slice(between, F.lit(1), F.size(found)),
                       F.concat(F.array(F.lit(0).cast("long")), lengths), lambda a, b: a + b)
    starts = _running(F.filter(steps, lambda x: x.isNotNull()))
    rows = F.transform(F.arrays_zip(starts.alias("start"), lengths.alias("len"), values.alias("value")),
                       lambda r: F.struct(r["start"].alias("start"), F.lit(kind).alias("kind"),
                                          (r["start"] + r["len"]).alias("end"), r["value"].alias("value")))
    kept = F.filter(rows, lambda r: F.length(r["value"]) >= 6) if kind == 0 else rows
    return F.when(text.rlike(pattern), kept).otherwise(_no_spans())


def base_spans(df: DataFrame, column: str = "text", output: str = "spans") -> DataFrame:
    """Add the spans of the three fixed kinds, by start, then kind: array of (start, kind number, end, value)."""
    text = F.coalesce(F.col(column), F.lit(""))
    return df.drop(output).withColumn(output, F.array_sort(F.concat(*(_matches(text, k) for k in range(3)))))


def _code(char: Column) -> Column:
    return F.position(char, F.lit(ALPHABET))


def _transitions(tokens: DataFrame) -> DataFrame:
    """How often each character follows another, by label: at most 2 x STATES x STATES rows."""
    codes = tokens.select("random", F.transform(F.split("token", ""), _code).alias("codes"))
    pairs = codes.select("random", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("codes") - 2),
        lambda i: F.get("codes", i) * STATES + F.get("codes", i + 1))).alias("pair"))
    return pairs.groupBy("random", "pair").agg(F.count("*").alias("n"))


def fit(df: DataFrame, column: str = "text", fit_documents: int = FIT_DOCUMENTS) -> MarkovModels:
    """Fit both models on the texts whose hash falls into a share of about ``fit_documents`` texts.

    The labels come from the texts: values of the base kinds are random strings, long runs in texts without any are
    identifiers (of 8 characters or more). Without a table or without samples both models are uniform and the method adds no span.
    """
    total = df.count()
    share = min(1.0, fit_documents / max(total, 1))
    # 62 bits of the hash: the share of a table of any size is more than none.
    part = df.select(F.col(column).alias("text")).filter(F.pmod(F.xxhash64("text"), F.lit(1 << 62)) < int(share * (1 << 62)))
    spans = base_spans(part, "text")
    values = spans.select(F.explode("spans").alias("s")).select(F.lit(True).alias("random"), F.col("s.value").alias("token"))
    runs = spans.filter(F.size("spans") == 0).select(
        F.lit(False).alias("random"), F.explode(F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0))).alias("token"))
    counts = [[0] * (STATES * STATES) for _ in range(2)]
    for row in _transitions(values.unionAll(runs).filter(F.length("token") >= 2)).collect():
        counts[row["random"]][row["pair"]] += row["n"]
    # Characters that a model saw after others at all: what its rows fall back to. Random strings may hold any character.
    ends = [[sum(c[b::STATES]) for b in range(STATES)] for c in counts]
    totals = [sum(e) for e in ends]
    falls = [[(e + 0.5) / (n + 0.5 * STATES) for e in row] for row, n in zip(ends, totals)]
    falls[1] = [0.5 * f + 0.5 / STATES for f in falls[1]]
    ratios = []
    for a in range(STATES):
        rows = [c[a * STATES: (a + 1) * STATES] for c in counts]
        for b in range(STATES):
            ordinary, random = ((r[b] + SMOOTHING * f[b]) / (sum(r) + SMOOTHING) for r, f in zip(rows, falls))
            ratios.append(math.log(random / ordinary) if totals[0] and totals[1] else 0.0)
    return MarkovModels(tuple(ratios), totals[1], totals[0])


def log_ratio(token: Column, models: MarkovModels) -> Column:
    """The sum of the transitions' log-likelihood ratios over a token."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in models.ratios)), ",").cast("array<double>")  # folded to one literal
    scored = F.aggregate(
        F.split(token, ""), F.struct(F.lit(-1).alias("before"), F.lit(0.0).alias("sum")),
        lambda acc, c: F.struct(
            _code(c).alias("before"),
            (acc["sum"] + F.when(acc["before"] < 0, 0.0).otherwise(F.get(table, acc["before"] * STATES + _code(c)))).alias("sum")))
    return scored["sum"]


def scan(df: DataFrame, models: MarkovModels, column: str = "text", output: str = "spans",
         min_llr: float = MIN_LLR) -> DataFrame:
    """Add all spans by start, then kind: those of the base kinds, and the runs that the models take for random strings.

    A run that overlaps a base span is not reported again.
    """
    text = F.coalesce(F.col(column), F.lit(""))
    runs = F.filter(_matches(text, 3), lambda r: log_ratio(r["value"], models) > min_llr)
    based = base_spans(df, column, output)
    new = F.filter(runs, lambda r: ~F.exists(F.col(output), lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    return based.withColumn(output, F.array_sort(F.concat(F.col(output), new)))


def listed(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span, overlapping ones as one, replaced by ``mark``; without spans it stays as it is."""
    whole = F.coalesce(text, F.lit(""))
    none = F.array().cast("array<string>")
    cut = F.aggregate(
        spans, F.struct(F.lit(0).cast("long").alias("at"), none.alias("parts")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["parts"]).otherwise(F.concat(acc["parts"], F.array(
                F.substring(whole, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark)))).alias("parts")))
    rest = F.substring(whole, (cut["at"] + 1).cast("int"), F.length(whole))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(F.array_join(cut["parts"], ""), rest))
