"""Mixing documents to target domain weights with soft membership.

1. Labelled rows (a bounded, hash-drawn sample of at most ``max_labelled``; a parameter of the fit only) train a
   classifier over hashed words, their beginnings and their ends: distributed document frequencies per (domain, bucket), at most
   domains * ``BUCKETS`` numbers, become log-odds where they differ significantly.
2. Every document, whole, gets posteriors over the domains: a softmax of its summed log-odds, calibrated on the
   labelled sample.
3. Rates r_i >= 0 are fitted by projected gradient least squares so that the expected domain totals
   sum_i r_i * tokens_i * p_i match weight * budget. The residual is measured in the metric of the Gram matrix
   sum_i tokens_i p_i p_i', and documents in the metric of their tokens, so a step is r_i <- max(0, y_i - p_i . g) with one
   short vector g per iteration; y_i adds the usual momentum (accelerated projected gradient). Start: r_i = 1, so nothing moves that need not. With ``max_rate`` the box is [0, max_rate].
   With ``falling`` only documents whose largest posterior is one of these domains' may go below 1: for all others the
   box begins at 1, whatever the targets, so each of them is there at least once.

Iterations end when the totals are met within ``TOLERANCE`` of the budget, or when the projected gradient vanishes: a step moves
the tokens' mean rate by ``TOLERANCE`` at most (at the latest after ``ITERATIONS``).

An iteration is one aggregate over a slim stored table; a document's rate is a function of its posteriors and the
list of past g's, so no state is shuffled; every ``RENEW`` iterations the table is stored with the rates so far, to not
repeat them. The driver sees sums of domain size only.

Defined cases: null text has no tokens, the prior as posterior, and a rate like any other. Labels with a null id or
domain are not used; an id labelled twice counts once per distinct label. With no usable label posteriors are uniform.
Domains of weight 0 are pushed towards 0. Repeated rows get equal rates. ``copies`` rounds the rate up or down by a hash of
the doc_id so that its mean is the rate. With no tokens at all every rate is 1. An empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.util import cut, map_arrow, runs, ship, slices, text_or_empty, trim, unused
from strata.llm.words import word_hashes

BUCKETS, Z, LIMIT = 1 << 15, 4.0, 30.0
ITERATIONS, TOLERANCE, RENEW = 400, 1e-5, 50


def quality_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labels table: toxic, else high or low quality."""
    domain = (F.when(F.col("toxic") == 1, F.lit("toxic")).when(F.col("quality") == 1, F.lit("high"))
              .when(F.col("quality") == 0, F.lit("low")))
    return labels.select("doc_id", domain.alias("domain"))


class Model:
    """Log-odds of hashed features (words, their beginnings and ends) per domain, zero where a feature's document
    frequencies do not differ by ``Z`` standard errors; ``scale`` and ``bias`` calibrate their sum."""

    def __init__(self, domains, counts: np.ndarray, docs: np.ndarray):
        self.domains = list(domains)
        rest, others = counts.sum(0) - counts, docs.sum() - docs[:, None]
        own = np.maximum(docs[:, None], 1.0)
        pooled = np.clip((counts + rest) / np.maximum(docs.sum(), 1.0), 0, 1)
        error = np.sqrt(pooled * (1 - pooled) * (1 / own + 1 / np.maximum(others, 1.0))) + 1e-12
        z = np.abs(counts / own - rest / np.maximum(others, 1.0)) / error
        odds = np.log((counts + 0.5) / (own + 1)) - np.log((rest + 0.5) / (others + 1))
        self.weight = np.where(z >= Z, odds, 0).astype(np.float32)
        self.bias = np.log((docs + 1.0) / (docs.sum() + len(docs)))
        self.scale = np.full(len(docs), 0.3)

    def evidence(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Per text: words, and the log-odds of its features per domain, limited to +-``LIMIT``."""
        hashes = word_hashes(texts, affixes=True)
        n = np.array([len(h) for h in hashes], np.int64)
        out = np.zeros((len(texts), len(self.domains)))
        full = np.flatnonzero(n)
        if len(full):
            bucket = _bucket(np.concatenate([hashes[i] for i in full]))
            at = np.concatenate(([0], np.cumsum(n[full])[:-1]))
            for d in range(len(self.domains)):
                out[full, d] = np.add.reduceat(self.weight[d].take(bucket).sum(1, dtype=np.float64), at)
        return n, np.clip(out, -LIMIT, LIMIT)

    def posteriors(self, evidence: np.ndarray) -> np.ndarray:
        z = self.scale * evidence + self.bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def calibrate(self, evidence: np.ndarray, label: np.ndarray, steps: int = 600):
        """Fits scale and bias by gradient descent on the log loss of labelled evidence."""
        if not len(label):
            return self
        onehot = np.eye(len(self.domains))[label]
        size = np.maximum(1.0, (evidence ** 2).mean(0))
        for _ in range(steps):
            diff = (self.posteriors(evidence) - onehot) / len(label)
            self.scale = np.maximum(1e-3, self.scale - (diff * evidence).sum(0) / size)
            self.bias = self.bias - diff.sum(0)
        return self


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - 15)).astype(np.int64)


def fit(docs: DataFrame, labelled: DataFrame, domains, max_labelled: int = 12_000) -> Model:
    """Model from ``docs`` (doc_id, text) and ``labelled`` (doc_id, domain)."""
    domains = list(domains)
    known = labelled.where(F.col("doc_id").isNotNull() & F.col("domain").isin(domains)).select("doc_id", "domain").distinct()
    known = known.orderBy(F.xxhash64("doc_id", "domain"), "doc_id", "domain").limit(max_labelled)
    # At most max_labelled rows of two short columns: bounded by the parameter.
    rows = cut(docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(known), "doc_id"), "labelled")
    number = {d: i for i, d in enumerate(domains)}

    def count(batches):
        counts, n = np.zeros((len(domains), BUCKETS)), np.zeros(len(domains))
        for _, texts, names in slices(batches, 1 << 21):
            for h, name in zip(word_hashes(texts, affixes=True), names):
                counts[number[name], np.unique(_bucket(h))] += 1
                n[number[name]] += 1
        d, b = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*d.tolist(), *range(len(domains))], pa.int32()), pa.array([*b.tolist(), *[-1] * len(domains)], pa.int32()),
             pa.array([*counts[d, b].tolist(), *n.tolist()], pa.float64())], ["d", "b", "n"])

    sums = map_arrow(rows, count, "d int, b int, n double").groupBy("d", "b").agg(F.sum("n").alias("n"))
    counts, n = np.zeros((len(domains), BUCKETS)), np.zeros(len(domains))
    for r in sums.collect():  # at most domains * (BUCKETS + 1) rows
        if r["b"] < 0:
            n[r["d"]] = r["n"]
        else:
            counts[r["d"], r["b"]] = r["n"]
    model = Model(domains, counts, n)

    def measure(batches):
        for _, texts, names in slices(batches, 1 << 21):
            _, e = model.evidence(texts)
            yield pa.RecordBatch.from_arrays([pa.array([number[x] for x in names], pa.int32()),
                                              pa.array(e.tolist(), pa.list_(pa.float64()))], ["d", "e"])

    got = map_arrow(rows, measure, "d int, e array<double>").collect()  # at most max_labelled rows, times repeats of an id
    return model.calibrate(np.array([r["e"] for r in got]).reshape(-1, len(domains)), np.array([r["d"] for r in got], np.int64))


def posteriors(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, tokens (words) and p (posteriors in the order of the model's domains) of every document."""
    def run(batches):
        for ids, texts in slices(batches, 1 << 21):
            n, e = model.evidence(texts)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()),
                                              pa.array(model.posteriors(e).tolist(), pa.list_(pa.float64()))], ["doc_id", "tokens", "p"])

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")), run,
                     "doc_id long, tokens long, p array<double>")


def _least(p: np.ndarray, falling: list[int] | None) -> np.ndarray:
    """The least rate of each document: 0 where a domain in ``falling`` has the largest posterior (or with None), else 1."""
    if falling is None or not len(p):
        return np.zeros(len(p))
    rest = [d for d in range(p.shape[1]) if d not in falling]
    return (p[:, rest].max(1, initial=0.0) >= p[:, falling].max(1, initial=0.0)).astype(np.float64)


def _rates(p: np.ndarray, steps: list[np.ndarray], max_rate: float, falling: list[int] | None = None,
           state: tuple | None = None, at: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """After ``steps`` of accelerated projected gradient, of which ``state`` has the first ``at``: the rates, where the next
    gradient is taken, and how far the last step went."""
    r = y = moved = np.ones(len(p))
    if state is not None:
        r, y, moved = state
    least = _least(p, falling)
    for k, g in enumerate(steps[at:], at):
        last, r = r, np.clip(y - p @ g, least, max_rate)
        moved = np.abs(r - y)
        y = r + (k / (k + 3.0)) * (r - last)
    return r, y, moved


def _p(batch) -> np.ndarray:
    col = batch.column(batch.schema.get_field_index("p"))
    return np.asarray(col.flatten()).reshape(len(col), -1) if len(col) else np.zeros((0, 1))


def fit_rates(members: DataFrame, weights: list[float], budget: float | None = None, max_rate: float = float("inf"),
              iterations: int = ITERATIONS, falling: list[int] | None = None) -> list[np.ndarray]:
    """The gradient steps that lead ``members`` (tokens, p) to rates whose totals match weight * budget."""
    k = len(weights)

    def gram(batches):
        total = np.zeros(k * k)
        for b in batches:
            p, t = _p(b), b.column(b.schema.get_field_index("tokens")).to_numpy().astype(np.float64)
            if len(t):
                total += (p.T @ (p * t[:, None])).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["s"])

    def sums(df, n):
        return np.array(df.agg(*[F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(n)]).first(), np.float64)

    slim = members.select("tokens", "p")
    g = sums(map_arrow(slim, gram, "s array<double>"), k * k)
    if not np.isfinite(g).all() or g.sum() <= 0:
        return []
    g = g.reshape(k, k)
    target = np.array(weights, np.float64) / sum(weights) * (g.sum() if budget is None else budget)
    inverse = np.linalg.inv(g + np.eye(k) * 1e-9 * np.trace(g))
    steps: list[np.ndarray] = []
    done = 0

    def rates(b, past, at):
        p = _p(b)
        state = tuple(b.column(b.schema.get_field_index(c)).to_numpy() for c in "rym") if at else None
        return p, b.column(b.schema.get_field_index("tokens")).to_numpy().astype(np.float64), _rates(p, past, max_rate, falling, state, at)

    for i in range(iterations + 1):
        if i and i % RENEW == 0:
            def renew(batches, past=tuple(steps), at=done):
                for b in batches:
                    _, _, state = rates(b, past, at)
                    yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in ("tokens", "p")]
                                                     + [pa.array(x, pa.float64()) for x in state], ["tokens", "p", "r", "y", "m"])

            slim = cut(map_arrow(slim, renew, "tokens long, p array<double>, r double, y double, m double"), "rates")
            done = i

        def totals(batches, past=tuple(steps), at=done):
            total = np.zeros(k + 1)
            for b in batches:
                p, t, (_, y, moved) = rates(b, past, at)
                if len(t):
                    total += np.append((y * t) @ p, moved @ t)
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["s"])

        *now, moved = sums(map_arrow(slim, totals, "s array<double>"), k + 1)
        residual = np.array(now) - target
        if np.abs(residual).max() <= TOLERANCE * target.sum() or (steps and moved <= TOLERANCE * g.sum()):
            break  # met, or as near as rates within the bounds come
        if i < iterations:
            steps.append(inverse @ residual)
    return steps


def with_rates(members: DataFrame, steps: list[np.ndarray], max_rate: float = float("inf")) -> DataFrame:
    """Adds rate and copies (the rate rounded by a hash of the doc_id)."""
    def run(batches):
        for b in batches:
            r = _rates(_p(b), steps, max_rate)[0]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(r, pa.float64())], [*b.schema.names, "rate"])

    out = map_arrow(members, run, "doc_id long, tokens long, p array<double>, rate double")
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(17)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    return out.withColumn("copies", F.floor(F.col("rate") + draw).cast("int"))


def remix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], budget_share: float = 1.0,
          max_rate: float = float("inf"), max_labelled: int = 12_000, falling: tuple[str, ...] | None = None) -> DataFrame:
    """The rows of ``docs``, with all their columns, as often as the fitted rates say (none, one or several times). The budget
    is ``budget_share`` times the present tokens. Only documents that look most like a domain of ``falling`` can go below
    one (None: all can). No text is shuffled: rates are worked out where a row is read."""
    domains = sorted(weights)
    fall = None if falling is None else [domains.index(d) for d in falling]
    model = fit(docs, labelled, domains, max_labelled)
    members = cut(posteriors(docs, model), "posteriors")
    total = members.agg(F.sum("tokens")).first()[0] or 0
    steps = fit_rates(members, [weights[d] for d in domains], budget_share * total, max_rate, falling=fall)
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit(17)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    ship(docs.sparkSession)

    def run(texts: pa.Array, draws: pa.Array) -> pa.Array:
        evidence = np.concatenate([np.zeros((0, len(domains))), *(model.evidence(some)[1] for some in runs(texts))])
        trim()
        rates = _rates(model.posteriors(evidence), steps, max_rate, fall)[0]
        return pa.array(np.floor(rates + draws.to_numpy(zero_copy_only=False)).astype(np.int32))

    # Only the text goes to Python; the other columns stay where they are.
    name = unused(docs, "_copies")
    # No filter on the result: pushed below this projection it would run the function a second time, in further workers.
    copies = F.arrow_udf(run, "int")(text_or_empty(), draw)
    return docs.withColumn(name, F.explode(F.array_repeat(F.lit(True), copies))).select(*[F.col(f"`{c}`") for c in docs.columns])


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], budget: float | None = None,
        max_rate: float = float("inf"), max_labelled: int = 12_000) -> DataFrame:
    """doc_id, tokens, p_<domain>..., rate, copies of every document."""
    domains = sorted(weights)
    model = fit(docs, labelled, domains, max_labelled)
    members = cut(posteriors(docs, model), "posteriors")
    steps = fit_rates(members, [weights[d] for d in domains], budget, max_rate)
    rows = with_rates(members, steps, max_rate)
    return rows.select("doc_id", "tokens", *[F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(domains)], "rate", "copies")


def reached(mixed: DataFrame, weights: dict[str, float], budget: float | None = None) -> DataFrame:
    """domain, present, target, reached: expected tokens of each domain before and after ``mix``."""
    domains = sorted(weights)
    total = F.sum("tokens") if budget is None else F.lit(float(budget))
    rows = [F.struct(F.lit(d).alias("domain"), F.sum(F.col("tokens") * F.col(f"p_{d}")).alias("present"),
                     (total * F.lit(weights[d] / sum(weights.values()))).alias("target"),
                     F.sum(F.col("rate") * F.col("tokens") * F.col(f"p_{d}")).alias("reached")) for d in domains]
    return mixed.agg(F.array(*rows).alias("x")).select(F.inline("x"))
