"""Language identification with error-correcting output codes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm import textops
from keelson.llm.columns import unused

TRIGRAMS = 1 << 15
FEATURES = TRIGRAMS + (1 << 14)
NONE = "und"
SCALE = 1 << 10

# Letters keep their own byte (A-Z as a-z), bytes above ASCII as they are; all else is one blank.
_CLASS = np.full(256, 32, dtype=np.uint8)
_CLASS[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_CLASS[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_CLASS[128:] = np.arange(128, 256)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers of the byte n-grams of a run of texts (trigrams, then bigrams, which start a
    second range), and for each kind which positions count: those inside one text with a letter in them."""
    c = _CLASS[data].astype(np.uint32)
    text = np.zeros(len(data) + 1, dtype=np.int32)
    np.add.at(text, offsets[1:-1], 1)
    text = np.cumsum(text)[:len(data)]
    letter = c != 32
    two = (c[:-1] * np.uint32(0x9E3779B1) ^ (c[1:] * np.uint32(0x85EBCA77))) >> np.uint32(18)
    three = ((c[:-2] * np.uint32(0x9E3779B1)) ^ (c[1:-1] * np.uint32(0x85EBCA77)) ^ (c[2:] * np.uint32(0xC2B2AE3D)))
    three = (three * np.uint32(0x27D4EB2F)) >> np.uint32(17)
    # The first two bytes of a trigram must not both be blank, else runs of marks would count.
    ok3 = (letter[:-2] | letter[1:-1]) & (text[:-2] == text[2:]) if len(c) > 2 else np.zeros(0, dtype=bool)
    ok2 = (letter[:-1] | letter[1:]) & (text[:-1] == text[1:]) if len(c) > 1 else np.zeros(0, dtype=bool)
    return three.astype(np.int64), ok3, two.astype(np.int64) + TRIGRAMS, ok2


def codewords(n: int) -> np.ndarray:
    """One row of +1 / -1 per language.

    Up to seven languages get the exhaustive code (every split into two sides once); more get
    fixed pseudo-random columns, about ten times the logarithm of their number, which keeps
    rows far apart.
    """
    if n < 2:
        return np.ones((n, 1))
    if n <= 7:
        splits = np.arange(1, 2 ** (n - 1))
        return np.where((splits[None, :] << 1 >> np.arange(n)[:, None]) & 1, 1.0, -1.0)
    bits = int(np.ceil(10 * np.log2(n)))
    code = np.random.Generator(np.random.PCG64(n)).choice([-1.0, 1.0], (n, bits))
    return code[:, np.abs(code.sum(axis=0)) < n]


@dataclass
class LanguageModel:
    """``weights``: features x bits, ``bit_weight``: trust in each bit, ``scale``: margin to log-odds."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bit_weight: np.ndarray
    scale: np.ndarray

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The mean n-gram log-odds of every bit for every text of a run."""
        three, ok3, two, ok2 = grams(data, offsets)
        out = np.zeros((len(offsets) - 1, self.weights.shape[1]))
        n = np.zeros(len(offsets) - 1)
        for feature, ok in ((three, ok3), (two, ok2)):
            at = np.searchsorted(np.flatnonzero(ok), offsets)
            n += np.diff(at)
            feature = feature[ok]
            for b in range(self.weights.shape[1]):
                total = np.concatenate(([0.0], np.cumsum(self.weights[:, b][feature], dtype=np.float64)))
                out[:, b] += total[at[1:]] - total[at[:-1]]
        return out / np.maximum(n, 1)[:, None]

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest codeword's index and the share of it against all others (0 to 1).

        The distance of a codeword is the trust-weighted logistic loss of the margins.
        """
        z = np.clip(margins * self.scale, -30, 30)
        loss = np.stack([(np.log1p(np.exp(-z * row)) * self.bit_weight).sum(axis=1) for row in self.code], axis=1)
        share = np.exp(loss.min(axis=1, keepdims=True) - loss)
        share /= share.sum(axis=1, keepdims=True)
        best = loss.argmin(axis=1)
        return best, share[np.arange(len(best)), best]


def _counts(docs: DataFrame) -> DataFrame:
    """(lang, feature, n): one partial table per task, summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in textops.released(batches):
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            for low, high, data, offsets in textops.text_runs(batch.column(1)):
                three, ok3, two, ok2 = grams(data, offsets)
                for lang in set(langs[low:high]):
                    mine = np.repeat(langs[low:high] == lang, np.diff(offsets))
                    have = seen.setdefault(lang, np.zeros(FEATURES, dtype=np.int64))
                    for feature, ok in ((three, ok3), (two, ok2)):
                        have += np.bincount(feature[ok & mine[:len(ok)]], minlength=FEATURES)
        for lang, have in seen.items():
            at = np.flatnonzero(have)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(have[at])],
                                             names=["lang", "feature", "n"])

    found = docs.mapInArrow(run, "lang string, feature long, n long")
    return found.groupBy("lang", "feature").agg(F.sum("n").alias("n"))


def fit_languages(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", tune_rows: int = 2000) -> LanguageModel:
    """Fit the bit classifiers on all rows of ``labelled`` with a language.

    A bit's classifier is a linear n-gram model: the log-odds of each n-gram between the languages
    on the two sides of the bit, every language weighing the same. The n-gram counts cover all
    rows and come to the driver summed (languages x ``FEATURES`` cells at most). The scale of the
    margins and the trust in each bit are tuned on about ``tune_rows`` rows, at most twice as
    many, the only bounded sample. Without rows the model has no language.
    """
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang IS NOT NULL")
    counts = _counts(rows).toPandas()
    languages = sorted(counts.lang.unique())
    n = len(languages)
    if not n:
        return LanguageModel([], np.zeros((0, 1)), np.zeros((FEATURES, 1), np.float32), np.ones(1), np.ones(1))
    table = np.zeros((n, FEATURES))
    table[[languages.index(x) for x in counts.lang], counts.feature] = counts.n
    table = (table + 0.5 * table.sum(axis=1, keepdims=True) / (2 * FEATURES) / 1e3 + 0.05)
    table /= table.sum(axis=1, keepdims=True)
    code = codewords(n)
    weights = np.stack([
        np.log(table[code[:, b] > 0].mean(axis=0)) - np.log(table[code[:, b] < 0].mean(axis=0))
        if (code[:, b] < 0).any() else np.zeros(FEATURES) for b in range(code.shape[1])], axis=1).astype(np.float32)
    model = LanguageModel(languages, code, np.clip(weights, -6, 6), np.ones(code.shape[1]), np.full(code.shape[1], 8.0))
    # A share of the texts by hash; copies of one text, which the share takes all or none of, are cut.
    share = F.pmod(F.xxhash64("text"), F.lit(1 << 40)) < int((1 << 40) * min(1.0, tune_rows / rows.count()))
    tune = rows.where(share).orderBy(F.xxhash64("text"), "lang").limit(2 * tune_rows).toPandas()
    texts = pa.array(tune.text, pa.string())
    margins = np.concatenate([model.margins(d, o) for _, _, d, o in textops.text_runs(texts)]) if len(tune) else np.zeros((0, 1))
    if n > 1 and len(tune):
        truth = code[[languages.index(x) for x in tune.lang]]
        right = (margins * truth > 0).mean(axis=0)
        model.bit_weight = np.clip(np.log((right + 1e-3) / (1 - right + 1e-3)), 0.05, None)
        model.bit_weight /= model.bit_weight.sum() / 4
        model.scale = 4.0 / np.maximum(np.abs(margins).mean(axis=0), 1e-6)
    return model


def identify_languages(docs: DataFrame, model: LanguageModel, text_col: str = "text", doubt: float = 0.6) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``ambiguous`` (score below ``doubt``).

    Every text is read whole. ``und`` with score 0 stands for a NULL text, a text without any
    letter, and for every text if the model has no language. A text that has letters but none
    of the model's n-grams, or equal losses, gets the first nearest language and is ambiguous.
    The three new columns replace columns of those names.
    """
    own = ["lang_pred", "score", "ambiguous"]
    docs = docs.drop(*own)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages and features bound its size

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = sent.value
        names = np.array([*m.languages, NONE], dtype=object)
        for column in textops.released(batches):
            best, score = np.full(len(column), len(m.languages)), np.zeros(len(column))
            if m.languages:
                for low, high, data, offsets in textops.text_runs(column):
                    best[low:high], score[low:high] = m.decode(m.margins(data, offsets))
            yield pa.StructArray.from_arrays([pa.array(names[best], pa.string()), pa.array(score)], ["lang", "score"])

    predict = F.arrow_udf(run, "struct<lang: string, score: double>")
    letters = F.coalesce(F.col(text_col).cast("string").rlike(r"\p{L}"), F.lit(False))
    p, ok = unused(docs.columns, "p", "ok")
    out = docs.withColumn(p, predict(F.col(text_col).cast("string"))).withColumn(ok, letters & (F.col(f"{p}.lang") != NONE))
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.when(F.col(ok), F.col(f"{p}.lang")).otherwise(NONE).alias("lang_pred"),
        F.when(F.col(ok), F.col(f"{p}.score")).otherwise(0.0).alias("score"),
        (~F.col(ok) | (F.col(f"{p}.score") < doubt)).alias("ambiguous"))


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into a fold; a NULL id does not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))
