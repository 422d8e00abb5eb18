"""Soft-membership mixing of sources to target weights, in DataFrame functions only.

1. Classifier: multinomial naive Bayes over hashed words and hashed word
   endings, counted on at most ``sample`` labelled documents (smallest id
   hashes). The ``features`` buckets whose documents differ most from the rest
   in their domains keep weights of their own, all others of a family share
   one; so the broadcast table has at most ``features`` rows. Every document gets posterior
   probabilities p_k of the domains from its whole text.
2. Rates: nonnegative document rates r, at most ``max_rate``, minimise
   sum_k (sum_d r_d t_d p_dk - T_k)^2 / (2 m_k), t_d the tokens, T_k the
   target tokens of domain k and m_k its tokens at rate one. Projected
   gradient: each round sums the expected domain tokens over all documents
   (one aggregate of a few numbers) and moves every rate against its
   gradient, in the metric of the tokens:
   r_d <- clip(r_d - step * sum_k p_dk (S_k - T_k) / m_k, 0, max_rate).
   The rounds' gradients are a short list, so a rate is a fold over them; every
   ``WRITE_EVERY`` rounds the rates are written, and the fold starts from there.
3. Decision: a document is emitted floor(r + u) times, u a uniform hash of
   its id.

The budget, unless given, is the total at which the domain of the largest
target (of several, the scarcest) is used up, times ``BUDGET_ROOM``; with
``max_rate`` 1 that domain is then kept whole, however rare the others are.

Defined results: a null or empty text has no tokens and the prior as
posterior. Rows with equal ids (null is an id) are one document and share a
rate. Labels with a null id or domain are ignored, of repeated ones the
smallest holds. Without labels or targets every rate is 1. Domains without a
target get the target 0. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import free_names
from cohortlens.session import materialize

SAMPLE = 20_000         # labelled documents that are counted at most
FEATURES = 10_000       # buckets with weights of their own
BUCKETS = 1 << 20       # hashed features per family
LEAST_Z = 6.0           # a telling bucket's domain shares are off by so many standard errors
LEAST_SHIFT = 0.15      # and by so much
SMOOTH = 0.5
ROUNDS = 60
WRITE_EVERY = 10        # rounds folded at most in one pass
STEP = 1.0
CLOSE = 1e-4            # rounds end when no expected total moves by more than this share
BUDGET_ROOM = 1.05
MAX_DOMAINS = 64

_SPACE = r"[\x20\x09-\x0D]+"


def _words(docs: DataFrame, *keep: str) -> DataFrame:
    """One row per word with its bucket in both families (null for a text without words)."""
    word = F.explode_outer(F.filter(F.split(F.coalesce("text", F.lit("")), _SPACE), lambda w: w != ""))
    return docs.select(*keep, word.alias("w")).select(
        *keep, F.when(F.col("w").isNotNull(), F.pmod(F.xxhash64("w"), F.lit(BUCKETS))).alias("f0"),
        F.when(F.col("w").isNotNull(), F.pmod(F.xxhash64(F.lit("end"), F.substring("w", -2, 2)), F.lit(BUCKETS))
               + BUCKETS).alias("f1"))


def label_domains(labels: DataFrame) -> DataFrame:
    """Domains from the labels table: clean, toxic, poor."""
    quality, toxic = F.col("quality").cast("int"), F.col("toxic").cast("int")
    return labels.select("doc_id", F.when(quality == 0, "poor").when(toxic == 1, "toxic").when(
        (quality == 1) & (toxic == 0), "clean").alias("domain"))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


class DomainModel:
    """Log prior, weights of the telling buckets (a small table) and of all others."""

    def __init__(self, domains: list[str], prior: list[float], table: DataFrame, other: dict[int, list[float]]):
        self.domains, self.prior, self.table, self.other = domains, prior, table, other


def fit_domains(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                sample: int = SAMPLE, features: int = FEATURES) -> DomainModel:
    """Count the labelled documents; ``labelled`` has (doc_id, domain)."""
    chosen = labelled.filter("doc_id IS NOT NULL AND domain IS NOT NULL").groupBy(
        F.col("doc_id").cast("long").alias("labelled_id")).agg(F.min("domain").alias("domain"))
    chosen = materialize(chosen.orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(sample), "mix-labels")
    sizes = {r["domain"]: r["count"] for r in chosen.groupBy("domain").count().collect()}
    if len(sizes) > MAX_DOMAINS:
        raise ValueError(f"{len(sizes)} domains; at most {MAX_DOMAINS} can be mixed")
    domains = sorted(sizes)
    texts = _texts(docs, id_col, text_col).join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id"))
    words = _words(texts, "doc_id", "domain").select("doc_id", "domain", F.explode(F.array("f0", "f1")).alias("f"))
    per_doc = words.filter("f IS NOT NULL").groupBy("doc_id", "domain", "f").count()
    is_of = [F.col("domain") == d for d in domains]
    counts = materialize(per_doc.groupBy("f").agg(
        *(F.sum(F.when(is_of[k], F.col("count")).otherwise(0)).alias(f"n{k}") for k in range(len(domains))),
        *(F.sum(is_of[k].cast("long")).alias(f"d{k}") for k in range(len(domains))),
        F.sum("count").alias("n"), F.count(F.lit(1)).alias("d")), "mix-counts")
    family = F.when(F.col("f") < BUCKETS, 0).otherwise(1).alias("family")
    total = {r["family"]: r for r in counts.groupBy(family).agg(
        *(F.sum(f"n{k}").alias(f"n{k}") for k in range(len(domains))), F.sum("n").alias("n")).collect()}

    def of(name: str) -> Column:
        return F.when(F.col("f") < BUCKETS, float(total[0][name] if 0 in total else 0)).otherwise(
            float(total[1][name] if 1 in total else 0))

    everyone = sum(sizes.values())

    def z(k: int) -> Column:
        """Standard errors by which domain k's share of the documents with a bucket is off, if off enough."""
        share = sizes[domains[k]] / everyone
        shift = F.abs(F.col(f"d{k}") - share * F.col("d"))
        return F.when(shift >= LEAST_SHIFT * F.col("d"), shift / F.sqrt(F.greatest(
            F.lit(1e-9), share * (1 - share) * F.col("d")))).otherwise(0.0)

    if not domains:
        return DomainModel([], [], counts.limit(0), {})
    score = F.greatest(*(z(k) for k in range(len(domains)))) if len(domains) > 1 else z(0)
    telling = counts.withColumn("z", score).filter(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "f").limit(features)
    telling = materialize(telling, "mix-telling")
    own = {r["family"]: r for r in telling.groupBy(family).agg(
        *(F.sum(f"n{k}").alias(f"n{k}") for k in range(len(domains)))).collect()}

    other = {}
    for fam in (0, 1):
        row, chosen_row = total.get(fam), own.get(fam)
        other[fam] = [math.log(((row[f"n{k}"] if row else 0) - (chosen_row[f"n{k}"] if chosen_row else 0) + 1)
                          / ((row[f"n{k}"] if row else 0) + 1 + SMOOTH * features)) for k in range(len(domains))]
    table = telling.select("f", *(F.log((F.col(f"n{k}") + SMOOTH) / (of(f"n{k}") + 1 + SMOOTH * features)).alias(f"w{k}")
                                  for k in range(len(domains))))
    return DomainModel(domains, [math.log(sizes[d] / everyone) for d in domains], materialize(table, "mix-weights"), other)


def posteriors(docs: DataFrame, model: DomainModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tokens, p): word count and the domains' posterior probabilities per document."""
    ks = range(len(model.domains))
    words = _words(_texts(docs, id_col, text_col), "doc_id")
    for fam in (0, 1):
        side = model.table.filter(F.col("f") < BUCKETS if fam == 0 else F.col("f") >= BUCKETS).select(
            F.col("f").alias(f"key{fam}"), *(F.col(f"w{k}").alias(f"w{fam}_{k}") for k in ks))
        words = words.join(F.broadcast(side), F.col(f"f{fam}") == F.col(f"key{fam}"), "left")
    log = [sum((F.coalesce(F.col(f"w{fam}_{k}"), F.lit(model.other[fam][k])) for fam in (0, 1)), F.lit(0.0)) for k in ks]
    summed = words.groupBy("doc_id").agg(
        F.count("f0").alias("tokens"), *(F.sum(F.when(F.col("f0").isNotNull(), e)).alias(f"s{k}") for k, e in zip(ks, log)))
    joint = [F.coalesce(F.col(f"s{k}"), F.lit(0.0)) + F.lit(model.prior[k]) for k in ks]
    top = F.greatest(*joint) if len(joint) > 1 else joint[0]
    raw = summed.select("doc_id", "tokens", F.array(*(F.exp(j - top) for j in joint)).alias("e"))
    mass = F.aggregate("e", F.lit(0.0), lambda a, x: a + x)
    return raw.withColumn("mass", mass).select(
        "doc_id", "tokens", F.transform("e", lambda x: x / F.col("mass")).alias("p"))


def _rate(p: Column, history: list[list[float]], max_rate: float, start: Column | None = None) -> Column:
    """The rate after the rounds so far: a fold over their gradients, from 1 or from an earlier rate."""
    start = F.lit(1.0) if start is None else start
    if not history:
        return start
    steps = F.array(*(F.array(*(F.lit(g) for g in gs)) for gs in history))

    def move(rate: Column, gs: Column) -> Column:
        slope = F.aggregate(F.zip_with(p, gs, lambda a, g: a * g), F.lit(0.0), lambda a, x: a + x)
        return F.least(F.lit(max_rate), F.greatest(F.lit(0.0), rate - slope))

    return F.aggregate(steps, start, move)


def fit_rates(soft: DataFrame, domains: list[str], targets: dict[str, float], budget: float | None = None,
              max_rate: float = 1.0, rounds: int = ROUNDS) -> list[list[float]]:
    """The gradients of all rounds; ``soft`` is (doc_id, tokens, p), written once."""
    ks = range(len(domains))
    from_here = soft.select("tokens", "p", F.lit(1.0).alias("rate"))

    def totals(history: list[list[float]]) -> list[float]:
        rate = _rate(F.col("p"), history, max_rate, F.col("rate"))
        row = from_here.select((rate * F.col("tokens")).alias("t"), "p").agg(
            *(F.coalesce(F.sum(F.col("t") * F.col("p")[k]), F.lit(0.0)) for k in ks)).first()
        return list(row)

    mass = totals([])
    weight = sum(targets.get(d, 0.0) for d in domains)
    if not domains or not weight or not sum(mass):
        return []
    share = [targets.get(d, 0.0) / weight for d in domains]
    if budget is None:
        reach = [m / s for m, s in zip(mass, share) if s == max(share)]
        budget = BUDGET_ROOM * min(reach) if min(reach) > 0 else sum(mass)
    wanted = [s * budget for s in share]
    history, now, written = [], mass, 0
    for _ in range(rounds):
        history.append([STEP * (s - t) / max(m, 1e-9 * sum(mass)) for s, t, m in zip(now, wanted, mass)])
        before, now = now, totals(history[written:])
        if max(abs(a - b) for a, b in zip(now, before)) <= CLOSE * sum(mass) / len(domains):
            break
        if len(history) - written == WRITE_EVERY:
            later = _rate(F.col("p"), history[written:], max_rate, F.col("rate"))
            from_here, written = materialize(from_here.select("tokens", "p", later.alias("rate")), "mix-rates"), len(history)
    return history


def mix(docs: DataFrame, labelled_docs: DataFrame, labelled: DataFrame, targets: dict[str, float],
        id_col: str = "doc_id", text_col: str = "text", budget: float | None = None, max_rate: float = 1.0,
        sample: int = SAMPLE) -> tuple[DataFrame, list[str]]:
    """((doc_id, tokens, p, rate, copies) per document, the domains in the order of p)."""
    model = fit_domains(labelled_docs, labelled, id_col, text_col, sample)
    if not model.domains:
        words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), _SPACE), lambda w: w != "")).cast("long")
        plain = _texts(docs, id_col, text_col).groupBy("doc_id").agg(F.sum(words).alias("tokens"))
        return plain.select("doc_id", "tokens", F.array().cast("array<double>").alias("p"), F.lit(1.0).alias("rate"),
                            F.lit(1).alias("copies")), []
    soft = materialize(posteriors(docs, model, id_col, text_col), "mix-posteriors")
    history = fit_rates(soft, model.domains, targets, budget, max_rate)
    uniform = F.pmod(F.xxhash64(F.lit("copies"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))),
                     F.lit(1 << 20)) / F.lit(float(1 << 20))
    rated = soft.withColumn("rate", _rate(F.col("p"), history, max_rate))
    return rated.withColumn("copies", F.floor(F.col("rate") + uniform).cast("int")), model.domains


def emit(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, each as often as its document's ``copies`` say."""
    doc, copies, number = free_names(docs, "__id", "__copies", "__n")
    side = mixed.select(F.col("doc_id").alias(doc), F.col("copies").alias(copies))
    changed = side.filter(F.col(copies) != 1)  # most documents are emitted once
    joined = docs.join(changed, F.col(id_col).cast("long").eqNullSafe(F.col(doc)), "left")
    times = F.coalesce(F.col(copies), F.lit(1))
    return joined.withColumn(number, F.explode(F.array_repeat(F.lit(0), times))).drop(doc, copies, number)


def weights_of(mixed: DataFrame, domains: list[str]) -> dict[str, float]:
    """Expected share of the emitted tokens by domain."""
    row = mixed.agg(*(F.sum(F.col("rate") * F.col("tokens") * F.col("p")[k]) for k in range(len(domains)))).first()
    total = reduce(lambda a, b: a + b, (x or 0.0 for x in row), 0.0)
    return {d: (x or 0.0) / total if total else 0.0 for d, x in zip(domains, row)}
