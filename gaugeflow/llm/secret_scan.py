"""Secrets in texts: three fixed rules, and Markov models of random strings against ordinary identifiers.

DataFrame functions only. Positions are code points from 0, ends are exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.tables import whole_text
from gaugeflow.storage import materialise

# Rules in their listed order, as (kind, pattern, group that is measured, least length of that group).
RULES = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
#: Quick tests whether a rule can succeed at all: characters, one of which a text has to hold, and a pattern that looks
#: for the first letter first.
HINTS = ((":", "="), "(?=[PpSsTtAa])" + RULES[0][1]), (("AKIA",), r"AKIA[A-Z0-9]{12}"), ((), r"[0-9a-f]{32}")
# Fixed value: characters of random strings and identifiers.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
IDENTIFIER = r"(?<![A-Za-z0-9_])[A-Za-z_][A-Za-z0-9_]{7,}"
#: A candidate is a secret when it is exp(15) times as likely a random string in all and exp(0.3) times per step.
LEAST_TOTAL, LEAST_STEP = 15.0, 0.3
MARKOV = "markov"
NO_MATCHES = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"


def _possible(text: Column, hint: tuple[Sequence[str], str]) -> Column:
    """Byte searches first; the pattern only runs where one of them hits."""
    parts, pattern = hint
    found = text.rlike(pattern)
    if not parts:
        return found
    some = text.contains(parts[0])
    for part in parts[1:]:
        some = some | text.contains(part)
    return F.when(some, found).otherwise(False)


def _located(text: Column, pattern: str, hint: tuple[Sequence[str], str], rank: int, kind: str) -> Column:
    """All leftmost non-overlapping matches with their places: the lengths of matches and of what lies between add up."""
    rx = F.lit(pattern)
    found = F.regexp_extract_all(text, rx, F.lit(0))
    gaps = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {NO_MATCHES})").alias("out"))

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["match"])
        here = F.struct(
            begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"),
            pair["match"].alias("value"),
        )
        return F.struct(end.alias("at"), F.array_append(state["out"], here).alias("out"))

    pairs = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(g.alias("gap"), m.alias("match")))
    out = F.aggregate(pairs, start, step, lambda state: state["out"])
    return F.when(_possible(text, hint), out).otherwise(F.expr(f"cast(array() as {NO_MATCHES})"))


def _long_enough(pattern: str, group: int, least: int):
    return lambda match: F.length(F.regexp_extract(match["value"], pattern, group)) >= least


def rule_matches(text: Column) -> Column:
    """Matches of the three rules, by start and then by rule. Matches that are too short go."""
    parts = []
    for rank, (kind, pattern, group, least) in enumerate(RULES):
        found = _located(text, pattern, HINTS[rank], rank, kind)
        parts.append(F.filter(found, _long_enough(pattern, group, least)))
    return F.array_sort(F.concat(*parts))


def labelled_samples(docs: DataFrame, text: str = "text") -> DataFrame:
    """``value, label`` for training, from all documents.

    Label 1: what the rules caught, and digests of it in hexadecimal and base 64, since random strings look like these.
    Label 0: ordinary identifiers of eight characters or more, outside of what the rules match.
    """
    whole = whole_text(text)
    caught = docs.select(F.explode(rule_matches(whole)).alias("m")).select(
        F.when(F.col("m.kind") == "assign", F.regexp_extract("m.value", RULES[0][1], 2)).otherwise(F.col("m.value"))
        .alias("value")
    )
    digest = F.sha2(F.col("value").cast("binary"), 256)
    random = caught.select(F.explode(F.array("value", digest, F.base64(F.unhex(digest)))).alias("value"))
    cleared = whole
    for pattern in (RULES[0][1], RULES[1][1], r"[0-9a-f]{32,}"):
        cleared = F.regexp_replace(cleared, pattern, " ")
    some = _possible(whole, HINTS[0]) | _possible(whole, HINTS[1]) | _possible(whole, HINTS[2])
    rest = F.when(some, cleared).otherwise(whole)
    ordinary = docs.select(rest.alias("rest")).select(
        F.explode(F.regexp_extract_all("rest", F.lit(IDENTIFIER), F.lit(0))).alias("value")
    )
    return random.withColumn("label", F.lit(1)).unionByName(ordinary.withColumn("label", F.lit(0)))


def transition_counts(samples: DataFrame, value: str = "value", label: str = "label") -> DataFrame:
    """``label, pair, n``: character transitions of all samples. At most 67 * 67 pairs a label leave each task."""
    inside = f"[{ALPHABET[:-2]}=-]"
    pairs = F.regexp_extract_all(F.col(value), F.lit(f"(?=({inside}{inside}))"), F.lit(1))
    return samples.where(F.col(value).isNotNull() & F.col(label).isin(0, 1)).select(
        F.col(label).alias("label"), F.explode(pairs).alias("pair")
    ).groupBy("label", "pair").agg(F.count("*").alias("n"))


def log_ratios(counts: DataFrame, smoothing: float = 1.0) -> list[float]:
    """Log of P(next | character) as a random string over the same as an identifier, row by row of the alphabet.

    The table has a fixed size. Without samples of a label its model is uniform.
    """
    place = {c: i for i, c in enumerate(ALPHABET)}
    size = len(ALPHABET)
    tables = [[[smoothing] * size for _ in range(size)] for _ in range(2)]
    for label, pair, n in counts.select("label", "pair", "n").collect():
        tables[label][place[pair[0]]][place[pair[1]]] += n
    out = []
    for ordinary, random in zip(*tables):
        a, b = sum(ordinary), sum(random)
        out += [round(math.log(y / b) - math.log(x / a), 4) for x, y in zip(ordinary, random)]
    return out


def log_likelihood_ratio(value: Column, ratios: Sequence[float]) -> Column:
    """Sum over the transitions of a string of alphabet characters."""
    ratios = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")
    size = F.lit(len(ALPHABET))
    places = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    steps = F.zip_with(
        F.slice(places, 1, F.length(value) - 1), F.slice(places, 2, F.length(value) - 1), lambda a, b: a * size + b
    )
    return F.aggregate(steps, F.lit(0.0), lambda total, i: total + F.get(ratios, i))


def scan_secrets(docs: DataFrame, ratios: Sequence[float], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, base, added``, arrays of ``start, rank, end, kind, value``.

    ``base`` holds the matches of the rules. ``added`` holds runs of 20 or more characters of random strings that touch
    no match of a rule and that the Markov models tell from ordinary identifiers. A null or empty text has none. Extra
    columns are not read, rows may repeat.
    """
    whole = whole_text(text)
    # Written, because the optimizer would else repeat the patterns for each use of the spans.
    found = materialise(docs.select(
        F.col(doc_id).alias("doc_id"), rule_matches(whole).alias("base"),
        _located(whole, CANDIDATE, ((), CANDIDATE), len(RULES), MARKOV).alias("runs"),
    ), "spans")
    free = F.filter("runs", lambda r: ~F.exists(
        "base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])
    ))
    scored = F.filter(free, lambda r: log_likelihood_ratio(r["value"], ratios) >= F.greatest(
        F.lit(LEAST_TOTAL), LEAST_STEP * (F.length(r["value"]) - 1)
    ))
    return found.select(F.col("doc_id").alias(doc_id), "base", scored.alias("added"))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans by start and kind, joined by commas."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
