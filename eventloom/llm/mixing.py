"""Mixing sources to target weights: iterative proportional fitting and calibrated sampling.

Token weights of the cells (source, language, topic) are raked until their margins meet the
targets. The fitted weight of a cell is its tokens times one factor per source, language and
topic. Languages and topics are the ones the targets list, others pool as ``OTHER``; sources
are as many as the corpus has, so they never leave Spark: one row per source holds its tokens
by language and topic. Given the other factors, a source's factor is a projection of its row,
and one aggregate gives the language by topic table that the other factors are fitted to.
Only that table, of the size of the targets, reaches the driver.

Sampling: with ``rate`` the wanted share of the corpus' tokens, a document is kept with
probability ``min(1, rate * factor)`` by a hash of its id and seed, and carries the weight
``max(1, rate * factor)``, so expected weighted tokens meet every margin.

Target shares without a matching token are spread over the others in proportion. Null
categories count as ``OTHER`` (of sources: their own source). Null and empty texts have no
tokens and do not move the margins; they are drawn with their cell's factor. A null id is drawn like an id of
its own. Repeated rows are drawn together. An empty table gives an empty result. Extra columns are kept, but for those that
have the names of the four that are added.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.tables import free_name, stored
from eventloom.llm.text import tuned

OTHER = "(other)"
LANGUAGES = {"en": 0.50, "de": 0.20, "fr": 0.20, "es": 0.10}
TOPICS = {"licensed": 0.10, "table": 0.02, "noise": 0.03, "short": 0.10, "prose": 0.75}
#: Share of the corpus' tokens to draw, and the power that flattens the sources.
RATE, FLATTEN, ROUNDS, TOLERANCE = 0.5, 0.5, 40, 1e-9
#: Share of tokens by which a margin may miss its target without a warning.
WORST = 0.01


def n_tokens(text: Column) -> Column:
    """Words of a text."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", F.lit(0)).otherwise(F.size(F.split(trimmed, "[ \\t-\\r]+")))


def topic_of(text: Column, tokens: Column) -> Column:
    """A coarse topic of a text by simple signs."""
    count = lambda sign: F.length(text) - F.length(F.replace(text, F.lit(sign)))
    licensed = text.contains("License") | text.contains("Licensed") | text.contains("All rights reserved") | text.contains("Copyright")
    return (
        F.when(licensed, "licensed")
        .when(count("|") * 5 > tokens, "table")
        .when((count("!") + count("*") + count("#") + count("$") + count("&")) * 2 > tokens, "noise")
        .when(tokens < 100, "short")
        .otherwise("prose")
    )


def pooled(value: Column, targets: Mapping[str, float]) -> Column:
    return F.when(value.isin(*targets), value).otherwise(OTHER)


def shares(targets: Mapping[str, float], present: np.ndarray) -> np.ndarray:
    """Target shares in order, with ``OTHER`` last for what they leave of 1, over what is present."""
    wanted = np.array([*targets.values(), max(0.0, 1 - sum(targets.values()))]) * present
    return wanted / wanted.sum() if wanted.sum() else wanted


def rake(sources: DataFrame, languages: Mapping[str, float], topics: Mapping[str, float], flatten: float) -> tuple[np.ndarray, np.ndarray, list[dict]]:
    """Factors of languages and topics, and the greatest misfit per round.

    ``sources``: (source, tokens) with tokens by language and topic in one array. Targets of
    sources are their token shares to the power ``flatten``.
    """
    n, m = len(languages) + 1, len(topics) + 1
    sums = [F.sum(F.get("tokens", F.lit(i))) for i in range(n * m)]
    own = F.aggregate("tokens", F.lit(0.0), lambda a, b: a + b)
    first = sources.agg(F.array(*sums).alias("cells"), F.sum(F.pow(own, F.lit(flatten))).alias("powers")).first()
    if first.cells[0] is None or not first.powers:
        return np.ones(n), np.ones(m), []
    cells, powers = np.array(first.cells).reshape(n, m), float(first.powers)
    total = cells.sum()
    wanted_l, wanted_t = shares(languages, cells.sum(axis=1) > 0) * total, shares(topics, cells.sum(axis=0) > 0) * total
    by_l, by_t, log = np.ones(n), np.ones(m), []
    for turn in range(ROUNDS):
        factor = source_factor(by_l, by_t, total, powers, flatten)
        row = sources.select("tokens", factor.alias("factor"))
        table = np.array(row.agg(F.array(*[F.sum(F.get("tokens", F.lit(i)) * F.col("factor")) for i in range(n * m)])).first()[0]).reshape(n, m)
        fitted = table * by_l[:, None] * by_t
        misfit = max(np.abs(fitted.sum(axis=1) - wanted_l).max(), np.abs(fitted.sum(axis=0) - wanted_t).max()) / total
        log.append({"round": turn, "misfit": float(misfit)})
        if misfit < TOLERANCE:
            break
        for _ in range(200):  # languages and topics to each other, given the sources
            by_l = np.divide(wanted_l, table @ by_t, out=np.zeros(n), where=table @ by_t > 0)
            by_t = np.divide(wanted_t, by_l @ table, out=np.zeros(m), where=by_l @ table > 0)
    return by_l, by_t, [*log, {"total": float(total), "powers": powers}]


def source_factor(by_l: np.ndarray, by_t: np.ndarray, total: float, powers: float, flatten: float) -> Column:
    """Factor of a source, given those of languages and topics: its target over what it has."""
    factors = F.array(*[F.lit(float(x)) for x in np.outer(by_l, by_t).ravel()])
    now = F.aggregate(F.zip_with("tokens", factors, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    own = F.aggregate("tokens", F.lit(0.0), lambda a, b: a + b)
    return F.when(now > 0, F.pow(own, F.lit(flatten)) / powers * total / now).otherwise(F.lit(0.0))


def uniform(seed: int) -> Column:
    """A number in [0, 1) from the id, the same in any run and on any cluster."""
    name = F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double") / float(1 << 52)


def mixed(docs: DataFrame, languages: Mapping[str, float] = LANGUAGES, topics: Mapping[str, float] = TOPICS, rate: float = RATE,
          flatten: float = FLATTEN, seed: int = 13, topic: Column | None = None) -> DataFrame:
    """The drawn documents with their columns, and topic, n_tokens, probability and sample_weight, which replace
    columns of these names. Warns if the shares reached are off by more than ``WORST``."""
    tuned(docs.sparkSession)
    keep = docs.columns
    own = {name: free_name(docs, f"_mix_{name}") for name in ("tokens", "topic", "source", "factor", "cell", "expected")}
    text = F.coalesce(F.col("text"), F.lit(""))
    # A generator computes tokens once, although the topic uses them several times.
    facts = F.inline(F.array(F.struct(n_tokens(text).cast("long").alias(own["tokens"]))))
    rows = docs.select(*keep, facts)
    rows = rows.select(*keep, own["tokens"], (topic_of(text, F.col(own["tokens"])) if topic is None else topic).alias(own["topic"]))
    names_l, names_t = [*languages, OTHER], [*topics, OTHER]
    at = lambda value, names: F.array_position(F.array(*map(F.lit, names)), value) - 1
    place = (at(pooled(F.col("lang"), languages), names_l) * len(names_t) + at(pooled(F.col(own["topic"]), topics), names_t)).cast("int")
    # Documents are read twice; what is kept between is one number each per source and cell.
    cells = rows.groupBy(F.col("source").alias("source"), place.alias("cell")).agg(F.sum(own["tokens"]).cast("double").alias("n"))
    slots = [F.coalesce(F.sum(F.when(F.col("cell") == i, F.col("n"))), F.lit(0.0)) for i in range(len(names_l) * len(names_t))]
    sources = stored(cells.groupBy("source").agg(F.array(*slots).alias("tokens")), "sources")
    by_l, by_t, log = rake(sources, languages, topics, flatten)
    if log:
        misfit = log[-2]["misfit"]
        if misfit > WORST:
            warnings.warn(f"the target shares contradict each other or the corpus: {misfit:.3f} of the tokens are off", stacklevel=2)
        factor = source_factor(by_l, by_t, log[-1]["total"], log[-1]["powers"], flatten)
    else:
        factor = F.lit(1.0)
    factors = sources.select(F.col("source").alias(own["source"]), factor.alias(own["factor"]))
    pairs = F.array(*[F.lit(float(x)) for x in np.outer(by_l, by_t).ravel()])
    joined = rows.withColumn(own["cell"], place).join(factors, F.col("source").eqNullSafe(F.col(own["source"])), "left")
    expected = F.lit(rate) * F.col(own["factor"]) * F.get(pairs, F.col(own["cell"]))
    drawn = joined.withColumn(own["expected"], expected).where(uniform(seed) < F.col(own["expected"]))
    out = {
        "topic": F.col(own["topic"]),
        "n_tokens": F.col(own["tokens"]),
        "probability": F.least(F.lit(1.0), F.col(own["expected"])),
        "sample_weight": F.greatest(F.lit(1.0), F.col(own["expected"])),
    }
    return drawn.select(*[c for c in keep if c.lower() not in out], *[value.alias(name) for name, value in out.items()])
