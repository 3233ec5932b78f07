"""Toxicity by weak supervision: voters, a generative label model, a linear classifier."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm import textops
from keelson.session import staged

# Stems of abuse in four languages; a stem votes on words that begin with it.
LEXICON = (
    "idiot moron imbecile stupid dumb loser scum trash worthless pathetic disgust clown fool garbage vermin filth jerk "
    "bastard asshole bitch retard pervert parasite subhuman "
    "dummkopf trottel abschaum arschloch scheiß schwachkopf hurensohn "
    "crétin connard ordure salaud abruti enculé "
    "imbécil estúpid basura escoria asqueros idiota gilipollas cabrón").split()
PATTERNS = ("two stems", "three stems", "dense stems", "shouting", "exclamation runs")
SAMPLE_ROWS = 12_000
MINED = 160

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_OUTSIDE = np.ones(256, dtype=bool)
_OUTSIDE[ord("a"):ord("z") + 1] = False
_OUTSIDE[128:] = False


def _lower(data: np.ndarray) -> np.ndarray:
    """A-Z and the capitals of the Latin-1 supplement in lower case."""
    low = _LOWER[data]
    if len(data) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        low[1:][capital] += 32
    return low


class Voters:
    """Which stems and patterns speak against each text of a run."""

    def __init__(self, stems: Sequence[str]) -> None:
        self.stems = list(stems)
        raw = [s.encode() for s in self.stems]
        self.tables = []
        for size in sorted({len(r) for r in raw}):
            which = np.array([i for i, r in enumerate(raw) if len(r) == size])
            data = np.frombuffer(b"".join(raw[i] for i in which), dtype=np.uint8)
            at = np.arange(0, len(data), size)
            h = textops.span_hashes(textops.running_hash(data), at, at + size)
            order = np.argsort(h)
            maybe = np.zeros(1 << 16, dtype=bool)
            maybe[(h >> np.uint64(48)).astype(np.int64)] = True
            self.tables.append((size, h[order], which[order], maybe))

    def features(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One row per text: 1 for each stem and pattern that votes."""
        n, m = len(offsets) - 1, len(self.stems)
        low = _lower(data)
        starts, ends, first = textops.word_spans(low, offsets, _OUTSIDE)
        total = textops.running_hash(low)
        owner = np.repeat(np.arange(n), np.diff(first))
        hits = np.zeros((n, m), dtype=np.int32)
        for size, known, which, maybe in self.tables:
            long_enough = np.flatnonzero(ends - starts >= size)
            at = starts[long_enough]
            h = textops.span_hashes(total, at, at + size)
            likely = np.flatnonzero(maybe[(h >> np.uint64(48)).astype(np.int64)])
            place = np.minimum(np.searchsorted(known, h[likely]), len(known) - 1)
            found = known[place] == h[likely]
            np.add.at(hits, (owner[long_enough[likely[found]]], which[place[found]]), 1)

        def per_text(flag: np.ndarray) -> np.ndarray:
            sums = np.concatenate(([0], np.cumsum(flag)))
            return sums[offsets[1:]] - sums[offsets[:-1]]

        upper, letters = per_text((data >= 65) & (data <= 90)), per_text(~_OUTSIDE[low])
        bang = data == ord("!")
        runs = per_text(np.concatenate(([False], bang[1:] & bang[:-1])) if len(bang) else bang)
        kinds, words = (hits > 0).sum(axis=1), np.diff(first)
        patterns = [kinds >= 2, kinds >= 3, (kinds > 0) & (hits.sum(axis=1) * 150 >= words), (letters >= 20) & (upper * 2 > letters), runs >= 3]
        return np.concatenate([hits > 0, np.stack(patterns, axis=1)], axis=1).astype(np.uint8)


@dataclass
class LabelModel:
    """P(vote | toxic), P(vote | clean), prior, residual correlations, and the trust that follows from them."""

    toxic: np.ndarray
    clean: np.ndarray
    prior: float
    correlation: np.ndarray
    trust: np.ndarray

    def posterior(self, votes: np.ndarray, evidence: np.ndarray | float = 0.0) -> np.ndarray:
        """P(toxic) per row; ``evidence`` is log-odds from elsewhere, such as a label."""
        on = np.log(self.toxic / self.clean) * self.trust
        off = np.log((1 - self.toxic) / (1 - self.clean)) * self.trust
        z = votes @ (on - off) + off.sum() + np.log(self.prior / (1 - self.prior)) + evidence
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_label_model(votes: np.ndarray, label: np.ndarray, rounds: int = 12) -> tuple[LabelModel, np.ndarray]:
    """Expectation-maximisation; a given label is one more voter with an accuracy of its own.

    Each round estimates the voters' accuracies given the posterior, then the correlations of
    their residuals; a voter whose residuals repeat those of others has its trust divided.
    Returns the model and the posterior of each row.
    """
    v = votes.astype(np.float64)
    p = np.where(label > 0, 0.9, 0.02)
    for _ in range(rounds):
        w1, w0 = p.sum(), (1 - p).sum()
        toxic = np.clip((p @ v + 0.1) / (w1 + 2), 1e-4, 0.999)
        clean = np.clip(((1 - p) @ v + 0.05) / (w0 + 2), 2e-5, 0.999)
        says1 = np.clip((p @ label) / w1, 0.6, 0.98)
        says0 = np.clip(((1 - p) @ label) / w0, 0.005, 0.2)
        rest = v - np.outer(p, toxic) - np.outer(1 - p, clean)
        spread = np.sqrt((rest**2).mean(axis=0)) + 1e-6
        correlation = (rest.T @ rest) / len(v) / np.outer(spread, spread)
        np.fill_diagonal(correlation, 0)
        strong = np.where(np.abs(correlation) > 0.3, np.abs(correlation), 0)
        model = LabelModel(toxic, clean, float(np.clip(w1 / (w1 + w0), 1e-3, 0.5)), correlation, 1 / (1 + strong.sum(axis=1)))
        told = np.where(label > 0, np.log(says1 / says0), np.log((1 - says1) / (1 - says0)))
        p = model.posterior(v, told)
    return model, p


def fit_linear(x: np.ndarray, target: np.ndarray, ridge: float = 0.2, rounds: int = 25) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps; the last weight is the intercept."""
    x = np.concatenate([x.astype(np.float64), np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (q - target) + penalty * w
        step = np.linalg.solve((x * (q * (1 - q) + 1e-6)[:, None]).T @ x + np.diag(penalty), slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class ToxicityModel:
    stems: list[str]
    label_model: LabelModel | None
    weights: np.ndarray


def mine_stems(sample: DataFrame, limit: int = MINED) -> list[str]:
    """Word beginnings of 4 to 8 letters that labelled toxic rows of (text, toxic) have and others lack.

    Counted as DataFrames; at most 20 * ``limit`` candidates come to the driver.
    """
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))
    stems = F.array_distinct(F.flatten(F.transform(
        F.filter(words, lambda w: F.length(w) >= 4),
        lambda w: F.transform(F.sequence(F.lit(4), F.least(F.lit(8), F.length(w))), lambda k: F.substring(w, F.lit(1), k)))))
    counts = sample.select("toxic", F.explode(stems).alias("stem")).groupBy("stem").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    precision = (F.col("bad") + 0.1) / (F.col("bad") + F.col("good") + 1.0)
    best = counts.where((F.col("bad") >= 4) & (precision >= 0.6)).withColumn("precision", precision)
    rows = best.orderBy(F.desc(F.col("bad") * F.col("precision") ** 4), F.length("stem"), "stem").limit(20 * limit).collect()
    chosen: list[str] = []
    taken = list(LEXICON)
    for r in rows:
        if len(chosen) < limit and not any(r.stem.startswith(c) or c.startswith(r.stem) for c in taken):
            chosen.append(r.stem)
            taken.append(r.stem)
    return chosen


def _votes(column: pa.Array, voters: Voters) -> np.ndarray:
    parts = [voters.features(data, offsets) for _, _, data, offsets in textops.text_runs(column)]
    return np.concatenate(parts) if parts else np.zeros((0, len(voters.stems) + len(PATTERNS)), dtype=np.uint8)


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> ToxicityModel:
    """Fit on a bounded sample: the ``sample_rows`` labelled rows of smallest id hash.

    The labels choose stems and are one voter of the label model; its posteriors, not the
    labels, train the linear classifier. Rows without label or text are left out. An id with several labels counts as
    toxic if one says so. Without labelled rows of both kinds, the fixed lexicon votes alone.
    """
    some = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        F.max(F.col(label_col).cast("long")).alias("toxic"))
    some = some.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    sample = staged(texts.join(F.broadcast(some), "_id").select("toxic", "text"), "toxicity-sample")  # bounded by sample_rows
    stems = list(dict.fromkeys([*LEXICON, *mine_stems(sample)]))
    voters = Voters(stems)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textops.released(batches):
            rows = _votes(batch.column(1), voters)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([np.packbits(r).tobytes() for r in rows], pa.binary())], names=["toxic", "votes"])

    got = sample.select("toxic", "text").mapInArrow(run, "toxic long, votes binary").toPandas()
    width = len(stems) + len(PATTERNS)
    label = got.toxic.to_numpy(dtype=np.float64) if len(got) else np.zeros(0)
    if not 0 < label.sum() < len(label):
        return ToxicityModel(stems, None, np.concatenate([np.full(len(LEXICON), 2.0), np.zeros(width - len(LEXICON)), [-3.0]]))
    votes = np.unpackbits(np.stack([np.frombuffer(v, dtype=np.uint8) for v in got.votes]), axis=1)[:, :width]
    model, posterior = fit_label_model(votes, label)
    return ToxicityModel(stems, model, fit_linear(votes, posterior))


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", cut: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``cut`` on), from whole texts.

    A NULL, empty or letterless text gets the classifier's score for no votes. Rows are
    independent; new columns replace columns of their names.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of stems
    kept = [f"`{c}`" for c in docs.columns if c not in ("score", "predicted")]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        voters, w = Voters(sent.value.stems), sent.value.weights
        for texts in textops.released(batches):
            yield pa.array(1 / (1 + np.exp(-np.clip(_votes(texts, voters) @ w[:-1] + w[-1], -30, 30))))

    score = F.arrow_udf(run, "double")
    out = docs.select(*kept, score(F.col(text_col).cast("string")).alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= cut, 1).otherwise(0))
