"""Mixing to target weights with soft domain membership.

A naive Bayes classifier, learned from a labelled table, gives each document a posterior over the
domains. Non-negative document rates are then fitted by projected-gradient least squares so that
the expected tokens of each domain (sum over documents of tokens * rate * posterior) match the
targets. A step needs only one number per domain, summed in Spark; rates stay with their rows.
Steps are scaled by each domain's token mass, which bounds the largest eigenvalue of the scaled
problem by one, so a step length of one is stable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantage.llm.base import blank, written


def _words(text: Column) -> Column:
    """Lower-cased stretches between blanks (tokens of the mixture)."""
    return F.split(F.replace(F.lower(blank(text)), F.lit("\n"), F.lit(" ")), " ")


def _bucket(word: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(buckets))


def domain_model(docs: DataFrame, labelled: DataFrame, domains: list[str], buckets: int = 1 << 15,
                 max_rows: int = 5_000) -> tuple[DataFrame, list[float], list[float]]:
    """Log-likelihoods (bucket, ll0, ll1, …), those of unseen buckets, and log priors.

    Learned from at most ``max_rows`` labelled documents (smallest hash of the id). The table has at
    most ``buckets`` rows.
    """
    import math

    chosen = (labelled.where(F.col("doc_id").isNotNull() & F.col("domain").isin(domains)).groupBy("doc_id")
              .agg(F.min("domain").alias("domain")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    words = rows.select("domain", F.explode(_words(F.col("text"))).alias("word")).where("word <> ''")
    counts = written(words.groupBy(_bucket("word", buckets).alias("bucket")).agg(
        *[F.count(F.when(F.col("domain") == d, 1)).alias(f"c{k}") for k, d in enumerate(domains)]), "domain-words")
    totals = counts.agg(*[F.coalesce(F.sum(f"c{k}"), F.lit(0)) for k in range(len(domains))]).first()
    sizes = {r[0]: r[1] for r in chosen.groupBy("domain").count().collect()}  # one row per domain
    seen = sum(sizes.values())
    prior = [math.log((sizes.get(d, 0) + 1) / (seen + len(domains))) for d in domains]
    unseen = [math.log(0.5 / (t + 0.5 * buckets)) for t in totals]
    table = counts.select("bucket", *[F.log((F.col(f"c{k}") + 0.5) / (totals[k] + 0.5 * buckets)).alias(f"ll{k}")
                                      for k in range(len(domains))])
    return table, unseen, prior


def posteriors(docs: DataFrame, model: tuple[DataFrame, list[float], list[float]], buckets: int = 1 << 15) -> DataFrame:
    """(doc_id, body, tokens, p0, p1, …) for each row; ``body`` is a hash of the text."""
    table, unseen, prior = model
    n = len(prior)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(blank(F.col("text"))).alias("body"), "text")
    words = rows.select("row", "doc_id", "body", F.explode(_words(F.col("text"))).alias("word"))
    # at most ``buckets`` rows
    scored = words.withColumn("bucket", _bucket("word", buckets)).join(F.broadcast(table), "bucket", "left")
    real = F.col("word") != ""
    sums = scored.groupBy("row", "doc_id", "body").agg(
        F.count(F.when(real, 1)).alias("tokens"),
        *[F.sum(F.when(real, F.coalesce(f"ll{k}", F.lit(unseen[k]))).otherwise(0.0)).alias(f"s{k}") for k in range(n)])
    logits = [F.col(f"s{k}") + F.lit(prior[k]) for k in range(n)]
    top = F.greatest(*logits) if n > 1 else logits[0]
    powers = sums.select("doc_id", "body", "tokens", *[F.exp(x - top).alias(f"e{k}") for k, x in enumerate(logits)])
    total = sum((F.col(f"e{k}") for k in range(1, n)), F.col("e0"))
    return powers.select("doc_id", "body", "tokens", *[(F.col(f"e{k}") / total).alias(f"p{k}") for k in range(n)])


def fit_rates(table: DataFrame, weights: list[float], budget: str | float = "tokens", steps: int = 60,
              tolerance: float = 1e-6, every: int = 8) -> DataFrame:
    """``table`` (doc_id, body, tokens, p0 …) with ``rate`` >= 0, or >= 1 with the budget ``"cover"``.

    Targets are ``weights`` (scaled to sum to one over the domains that have tokens) times the budget:
    a number of tokens, ``"tokens"`` (as many as there are) or ``"cover"``: no document falls below
    rate one. It starts with the least that gives no domain less than it has; soft documents repeated
    for one domain add tokens to others, and while that brings the targets closer by a fifth or more
    a step, the budget rises so that no domain has to give any back. Targets that no rates meet are
    met as closely as the steps allow. Stops when all domains are within ``tolerance`` of the budget.
    """
    n = len(weights)

    def masses(rate: Column) -> list[float]:
        row = state.agg(*[F.coalesce(F.sum(F.col("tokens") * rate * F.col(f"p{k}")), F.lit(0.0)) for k in range(n)]).first()
        return [float(x) for x in row]

    state = written(table.withColumn("rate", F.lit(1.0)), "mixing-rates")
    have = masses(F.lit(1.0))
    total = sum(have)
    live = [k for k in range(n) if have[k] > 1e-9 * max(total, 1) and weights[k] > 0]
    norm = sum(weights[k] for k in live)
    if not live:
        return state
    share = [weights[k] / norm if k in live else 0.0 for k in range(n)]
    amount = {"tokens": total, "cover": max(have[k] / share[k] for k in live)}.get(budget, budget)
    target = [s * amount for s in share]
    rate: Column = F.col("rate")
    now = have
    cover = budget == "cover"
    least, counted = (1.0, live) if cover else (0.0, range(n))
    off = float("inf")
    for step in range(1, steps + 1):
        if cover:
            needed = max(now[k] / share[k] for k in live)
            before, off = off, max(needed * share[k] - now[k] for k in live) / needed
            cover = off <= 0.8 * before
            amount = max(amount, needed) if cover else amount
            target = [s * amount for s in share]
        gap = [(now[k] - target[k]) / have[k] if have[k] > 0 else 0.0 for k in range(n)]
        if max(abs(now[k] - target[k]) for k in counted) <= tolerance * amount:
            break
        slope = sum((F.col(f"p{k}") * F.lit(gap[k]) for k in range(1, n)), F.col("p0") * F.lit(gap[0]))
        rate = F.greatest(F.lit(least), rate - slope)
        if step % every == 0:  # keeps the expression short
            state = written(state.withColumn("rate", rate), "mixing-rates")
            rate = F.col("rate")
        now = masses(rate)
    return state.withColumn("rate", rate)


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], budget: str | float = "tokens") -> DataFrame:
    """(doc_id, body, tokens, p_<domain> …, rate) for every row of ``docs``.

    ``labelled`` has (doc_id, domain); ``targets`` gives each domain's weight. A null or empty text
    has no tokens, the prior as posterior and a rate like any other. Rows with a null id and
    repeated rows are rows of their own. Domains without tokens are left out of the targets. Other
    columns are left out; an empty table gives an empty result.
    """
    domains = sorted(targets)
    table = posteriors(docs, domain_model(docs, labelled, domains))
    rates = fit_rates(table, [targets[d] for d in domains], budget)
    return rates.select("doc_id", "body", "tokens", *[F.col(f"p{k}").alias(f"p_{d}") for k, d in enumerate(domains)], "rate")


def resample(docs: DataFrame, rates: DataFrame) -> DataFrame:
    """Each row of ``docs`` floor(rate) times, once more with the rate's fraction as probability (by a hash of the id)."""
    rate = rates.groupBy("doc_id", "body").agg(F.max("rate").alias("rate")).select(
        F.col("doc_id").alias("id"), "body", "rate")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("key"),
                      F.xxhash64(blank(F.col("text"))).alias("own"))
    joined = row.join(rate, (F.col("key").eqNullSafe(F.col("id"))) & (F.col("own") == F.col("body")))
    chance = F.pmod(F.xxhash64("key", F.lit("copies")), F.lit(1 << 20)) / float(1 << 20)
    copies = F.floor(F.col("rate") + chance).cast("int")
    return joined.where(copies > 0).select("row", F.explode(F.sequence(F.lit(1), copies))).select("row.*")
