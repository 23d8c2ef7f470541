"""Document rates that mix a corpus to target weights of soft domains. DataFrame functions only.

A naive Bayes classifier learned from a labelled table gives each document a probability for each domain. Rates are fitted
by least squares within bounds so that the expected tokens of each domain match its target.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.tables import hash_share, whole_text
from gaugeflow.storage import materialise

#: Labelled rows that the classifier is fitted on (expected number; drawn by a hash of the id).
LABELLED_ROWS = 8000
#: Most frequent words and word ends of the labelled rows; bounds the table of the classifier, which is broadcast.
VOCABULARY = 20_000
LEAST_COUNT = 5
#: Temperatures tried on the held-out fifth of the labelled sample.
TEMPERATURES = (1.0, 1.5, 2.0, 3.0, 4.0, 6.0, 8.0, 16.0)
#: Steps of the descent at most, and the gap of a domain that counts as none.
MAX_STEPS, TOLERANCE = 60, 1e-4
#: A longer step may not raise the squared gaps above the largest of so many before it.
LOOK_BACK = 5
SEED = 23
#: What separates words here: blanks and the usual stops.
SEPARATORS = r"[\x20\x09-\x0D.,;:]+"
#: Marks that no word holds: a word that repeats the one before it, and the last two characters of a word.
AGAIN, END = "\x01", "\x02"


@dataclass
class DomainModel:
    domains: list[str]
    prior: list[float]  # log odds of each domain against the first
    features: DataFrame  # feature, r1, r2, ...: log ratio of each further domain against the first
    temperature: float


def _words(text: str) -> Column:
    """Lower-cased words; a word that repeats the one before it is a mark."""
    words = F.filter(F.split(F.lower(whole_text(text)), SEPARATORS), lambda w: w != "")
    before = F.concat(F.array(F.lit("")), words)
    return F.zip_with(words, F.slice(before, 1, F.size(words)), lambda w, b: F.when(w == b, AGAIN).otherwise(w))


def _end(word: Column) -> Column:
    return F.concat(F.lit(END), F.substring(word, -2, 2))


def _log_odds(rows: DataFrame, keys: Sequence[str], model: DomainModel) -> DataFrame:
    """Columns ``keys`` and ``odds``, one row per row of ``rows(keys, words)``; ``keys`` tell all rows apart.

    Words meet the broadcast table where they are and are summed there; one short row a document is shuffled.
    """
    further = len(model.domains) - 1
    names = [f"r{i + 1}" for i in range(further)]
    table = F.broadcast(model.features)
    of_word = table.select(F.col("feature").alias("word"), *[F.col(n).alias(f"w{n}") for n in names])
    of_end = table.select(F.col("feature").alias("end"), *[F.col(n).alias(f"e{n}") for n in names])
    words = rows.select(*keys, F.explode_outer("words").alias("word")).withColumn("end", _end(F.col("word")))
    scored = words.join(F.broadcast(of_word), "word", "left").join(F.broadcast(of_end), "end", "left")
    zero = F.lit(0.0)
    return scored.groupBy(*keys).agg(F.array(zero, *[
        F.sum(F.coalesce(f"w{n}", zero) + F.coalesce(f"e{n}", zero)) for n in names
    ]).alias("odds"))


def _posteriors(odds: Column, prior: Sequence[float], temperature: float) -> Column:
    """Softmax of tempered log odds and the prior."""
    scaled = [odds[i] / temperature + p for i, p in enumerate(prior)]
    top = F.greatest(*scaled) if len(scaled) > 1 else scaled[0]
    powers = [F.exp(s - top) for s in scaled]
    total = sum(powers[1:], powers[0])
    return F.array(*[p / total for p in powers])


def fit_domains(
    docs: DataFrame,
    labels: DataFrame,
    domain: Column,
    domains: Sequence[str],
    doc_id: str = "doc_id",
    text: str = "text",
    rows: int = LABELLED_ROWS,
    seed: int = SEED,
) -> DomainModel:
    """Naive Bayes over words and word ends, from about ``rows`` labelled rows.

    The draw is a filter by hash whose rate comes from an exact count; it is broadcast to the texts. Rows with a null id
    or a domain not in ``domains`` are left out. The table of log ratios holds the 20,000 most frequent features that
    occur five times or more. The temperature is the one with the least log loss on a held-out fifth. Without labelled
    rows all domains are equally likely.
    """
    domains = list(domains)
    known = labels.select(F.col(doc_id).alias("id"), domain.alias("domain")).where(
        F.col("id").isNotNull() & F.col("domain").isin(domains)
    )
    drawn = known.where(hash_share("id", seed=seed) < rows / max(known.count(), 1))
    texts = docs.select(F.col(doc_id).alias("text_id"), _words(text).alias("words"))
    sample = materialise(
        texts.join(F.broadcast(drawn), F.col("text_id") == F.col("id")).select(
            F.monotonically_increasing_id().alias("uid"), "domain", "words",
            (hash_share("id", seed=seed + 1) < 0.2).alias("held_out"),
        ), "domains",
    )
    words = sample.where(~F.col("held_out")).select("domain", F.explode("words").alias("word"))
    seen = words.select("domain", F.explode(F.array("word", _end(F.col("word")))).alias("feature")).groupBy("feature").agg(
        F.count("*").alias("n"), *[F.count_if(F.col("domain") == d).alias(f"n{i}") for i, d in enumerate(domains)]
    ).where(F.col("n") >= LEAST_COUNT).orderBy(F.desc("n"), "feature").limit(VOCABULARY)
    seen = materialise(seen, "features")
    sums = seen.agg(*[F.sum(f"n{i}") for i in range(len(domains))], F.count("*")).first()
    spread = sums[-1] or 1
    share = [F.log((F.col(f"n{i}") + 1.0) / float((sums[i] or 0) + spread)) for i in range(len(domains))]
    features = seen.select("feature", *[(share[i] - share[0]).alias(f"r{i}") for i in range(1, len(domains))])
    sizes = dict(sample.where(~F.col("held_out")).groupBy("domain").count().collect())
    prior = [math.log((sizes.get(d, 0) + 1) / (sizes.get(domains[0], 0) + 1)) for d in domains]
    model = DomainModel(domains, prior, features, 1.0)

    odds = _log_odds(sample.where("held_out"), ["uid", "domain"], model)
    own = F.array_position(F.array(*[F.lit(d) for d in domains]), F.col("domain")).cast("int")
    losses = odds.agg(*[
        F.avg(-F.log(F.greatest(F.element_at(_posteriors(F.col("odds"), prior, t), own), F.lit(1e-12)))).alias(f"t{i}")
        for i, t in enumerate(TEMPERATURES)
    ]).first()
    if losses[0] is not None:
        model.temperature = TEMPERATURES[int(np.argmin(losses))]
    return model


def domain_posteriors(docs: DataFrame, model: DomainModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``row`` (the id), ``text_hash``, ``n_tokens`` (words), ``posteriors`` (one per domain)."""
    rows = docs.select(
        F.col(doc_id).alias("row"), F.xxhash64(text).alias("text_hash"), _words(text).alias("words"),
        F.monotonically_increasing_id().alias("uid"),
    ).withColumn("n_tokens", F.size("words").cast("long"))
    keys = ["uid", "row", "text_hash", "n_tokens"]
    return _log_odds(rows, keys, model).select(
        "row", "text_hash", "n_tokens", _posteriors(F.col("odds"), model.prior, model.temperature).alias("posteriors")
    )


@dataclass
class Rates:
    """Rates as a function of a row: from ``start``, each step takes off posteriors . step and projects to the bounds."""

    start: float
    steps: list[list[float]]  # one number per domain and step
    cap: float | None
    expected: list[float]  # tokens of each domain at these rates
    off: float  # largest gap of a domain to its target, as a share of the larger of the tokens it has and the target

    @property
    def reached(self) -> bool:
        return self.off <= TOLERANCE

    def stepped(self, rate: Column, posteriors: Column, step: Sequence[float]) -> Column:
        moved = rate - sum((posteriors[i] * float(x) for i, x in enumerate(step)), F.lit(0.0))
        return F.greatest(F.lit(0.0), moved if self.cap is None else F.least(F.lit(float(self.cap)), moved))

    def of(self, posteriors: Column) -> Column:
        """The rate of a row, by replaying the steps."""
        return reduce(lambda rate, step: self.stepped(rate, posteriors, step), self.steps, F.lit(float(self.start)))


def fit_rates(
    members: DataFrame,
    targets: Sequence[float],
    cap: float | None = None,
    tokens: str = "n_tokens",
    posteriors: str = "posteriors",
    start: float | None = None,
) -> Rates:
    """Nonnegative rates r (at most ``cap``) with sum of r * tokens * posterior close to the target of each domain.

    Projected gradient on the least squares of the gaps, each square divided by the tokens of its domain. The gradient of
    a row is its tokens times posteriors . gaps / tokens of the domains; the step of a row is scaled by one over its
    tokens, so very long rows neither set the step for all nor move further than short ones. In this scale a step of
    length one never overshoots, whatever the data. Longer ones (Barzilai-Borwein, from sums over the rows) are taken as
    long as the squares do not rise above those of the last steps, else the step is taken again with length one. After
    each step rates are projected to the bounds. It ends at the targets, or when the last steps have gained no more than a
    hundredth. A step is one aggregate over the table; a row keeps no state, its rate is replayed from the steps. Where a gap stays, ``reached`` is False and a warning names it.
    """
    n = len(targets)
    mass = [F.col(tokens) * F.col(posteriors)[i] for i in range(n)]
    have = np.array([x or 0.0 for x in members.agg(*[F.sum(m) for m in mass]).first()], float)
    want = np.array(targets, float)
    if start is None:
        start = float(want.sum() / have.sum()) if have.sum() else 0.0
    unit = np.where(have > 0, have, 1.0)
    share = np.maximum(have, want)
    share = np.where(share > 0, share, 1.0)
    rates = Rates(start, [], cap, (start * have).tolist(), 0.0)

    def squares(expected: np.ndarray) -> float:
        return float(((expected - want) ** 2 / unit).sum())

    got, length = start * have, 1.0
    past = [squares(got)]
    for _ in range(MAX_STEPS):
        if (np.abs(got - want) / share).max(initial=0.0) <= TOLERANCE:
            break
        rows = members.select(*[m.alias(f"m{i}") for i, m in enumerate(mass)], F.col(tokens).alias("t"),
                              F.col(posteriors).alias("p"), rates.of(F.col(posteriors)).alias("before"))
        rates.steps.append((length * (got - want) / unit).tolist())
        rows = rows.withColumn("after", rates.stepped(F.col("before"), F.col("p"), rates.steps[-1]))
        found = rows.agg(*[F.sum(F.col("after") * F.col(f"m{i}")) for i in range(n)],
                         F.sum(F.col("t") * (F.col("after") - F.col("before")) ** 2)).first()
        *there, moved = [x or 0.0 for x in found]
        there = np.array(there, float)
        if length > 1 and squares(there) > max(past[-LOOK_BACK:]):
            rates.steps.pop()
            length = 1.0
            continue
        gained, bent = past[-1] - squares(there), float(((there - got) ** 2 / unit).sum())
        got = there
        past.append(squares(got))
        stands = len(past) > LOOK_BACK and past[-1] > 0.99 * past[-1 - LOOK_BACK]
        if moved <= 1e-12 * have.sum() or stands or length == 1 and 0 <= gained <= 1e-7 * past[-2]:
            break  # the bounds allow no more
        length = max(1.0, moved / bent) if bent > 0 else 1.0
    rates.expected = got.tolist()
    rates.off = float((np.abs(got - want) / share).max(initial=0.0))
    if not rates.reached:
        warnings.warn(f"mixture targets are missed by up to {rates.off:.2%} of a domain", stacklevel=2)
    return rates


def copies_of(rate: Column, *key: str, seed: int = SEED) -> Column:
    """Whole number with the rate as expectation: its floor, and one more by a hash of the key."""
    return (F.floor(rate) + (hash_share(*key, seed=seed + 2) < rate - F.floor(rate)).cast("int")).cast("int")


def mixture_rates(
    docs: DataFrame,
    model: DomainModel,
    weights: Mapping[str, float],
    doc_id: str = "doc_id",
    text: str = "text",
    budget: float | None = None,
    cap: float | None = None,
) -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, posteriors, rate, copies``.

    ``weights`` gives the share of each domain of the model in ``budget`` expected tokens (all tokens by default). Null,
    empty and blank texts have no tokens; their rate is the start rate. Rows may repeat; extra columns are not read; an
    empty table gives no rows. Where targets cannot be met, rates come as close as they can and a warning names the gap.
    """
    members = materialise(domain_posteriors(docs, model, doc_id, text), "members")
    if budget is None:
        budget = float(members.agg(F.sum("n_tokens")).first()[0] or 0)
    total = sum(weights.values())
    rates = fit_rates(members, [budget * weights[d] / total for d in model.domains], cap)
    return members.withColumn("rate", rates.of(F.col("posteriors"))).select(
        F.col("row").alias(doc_id), "n_tokens", "posteriors", "rate",
    ).withColumn("copies", copies_of(F.col("rate"), doc_id))


def keep_mixture(
    docs: DataFrame,
    model: DomainModel,
    factors: Mapping[str, float],
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Rows of ``docs`` thinned so that each domain keeps ``factors[domain]`` of its expected tokens; no row comes twice.

    Rates start at 1 and cannot exceed it, so documents of domains with factor 1 stay. Ids with their texts tell rows
    apart; full repeats share their fate. Where the factors cannot be met, a warning names the gap.
    """
    members = materialise(domain_posteriors(docs, model, doc_id, text), "members")
    sums = members.agg(*[F.sum(F.col("n_tokens") * F.col("posteriors")[i]) for i in range(len(model.domains))]).first()
    targets = [(x or 0.0) * factors.get(d, 1.0) for d, x in zip(model.domains, sums)]
    rates = fit_rates(members, targets, cap=1.0, start=1.0)
    rate = rates.of(F.col("posteriors"))
    kept = members.where(hash_share("row", seed=SEED + 2) < rate).select(
        F.col("row").alias("_kept_id"), F.col("text_hash").alias("_kept_hash")
    )
    same = F.col(doc_id).eqNullSafe(F.col("_kept_id")) & (F.xxhash64(text) == F.col("_kept_hash"))
    return docs.join(kept, same, "left_semi")
