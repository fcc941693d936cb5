"""A quality classifier: a factorisation machine over hashed words, structure and metadata.

A text has one feature per hashed word, a few statistics of its structure, and its stored
length. The machine has a weight for each, and a short vector: a pair of features
adds the product of both vectors and values. The sum over all pairs is half of the square
of the sum less the sum of squares, so a text is scored in the time its features take.

It is fitted in one task on a bounded sample of the labelled rows, drawn by a hash of the id.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepstream.llm.tables import settled

WORD_SLOTS = 1 << 15
RANK = 8
SAMPLE = 12_000  # labelled documents that the model is fitted on at most
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2
STEPS, BATCH, RATE, DECAY = 400, 256, 0.01, 1e-4
SEED = 42
_SYMBOLS = b"#*$%&|<>"
_CLASSES = (
    _SYMBOLS,
    b"!?",
    b".,;:",
    bytes(range(65, 91)),
    bytes(range(48, 58)),
    b"\n",
    bytes(range(0x80, 0x100)),
)
STRUCTURE = 7 + len(_CLASSES)
FEATURES = WORD_SLOTS + STRUCTURE
_SPACE = b" \t\n\x0b\x0c\r"
_MODEL = "slot int, weight double, factors array<double>"


def features(text: bytes | None, n_chars: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a whole text. Words have values of length 1 together; structure lies about 0 to 1."""
    text = text or b""
    words = text.split()
    n, size = len(words), max(len(text), 1)
    hashes = np.fromiter(map(zlib.crc32, words), np.uint32, n)
    slots, times = np.unique(hashes % WORD_SLOTS, return_counts=True)
    values = 1.0 + np.log(times) if n else np.zeros(0)
    values /= np.sqrt((values**2).sum()) if n else 1.0
    lines = text.split(b"\n")
    shares = [(len(text) - len(text.translate(None, kind))) / size for kind in _CLASSES]
    structure = [
        np.log1p(n) / 10,
        np.log1p(n_chars if n_chars is not None and n_chars > 0 else 0) / 12,
        len(text.translate(None, _SPACE)) / max(n, 1) / 10,
        len(slots) / max(n, 1),
        (hashes[1:] == hashes[:-1]).sum() / max(n, 1),
        1 - len(set(lines)) / len(lines),
        1.0 if n < 50 else 0.0,
        *(min(1.0, 4 * share) for share in shares),
    ]
    where = np.arange(WORD_SLOTS, FEATURES)
    return np.concatenate([slots.astype(np.int64), where]), np.concatenate([values, structure])


class Machine:
    """Bias, weights and factors; :meth:`logits` takes many texts at once."""

    def __init__(self, weights: np.ndarray, factors: np.ndarray):
        self.weights, self.factors = weights, factors  # the bias is the last weight

    def logits(self, slots: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """``starts`` is where each text's features begin; each has some."""
        sums = np.add.reduceat(self.factors[slots] * values[:, None], starts)
        squares = np.add.reduceat((self.factors**2).sum(axis=1)[slots] * values**2, starts)
        linear = np.add.reduceat(self.weights[slots] * values, starts)
        return self.weights[-1] + linear + 0.5 * ((sums**2).sum(axis=1) - squares)


def fit(slots: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray) -> Machine:
    """Minimise the logistic loss by about ``STEPS`` Adam steps over small batches, both classes weighing alike."""
    rng = np.random.default_rng(SEED)
    machine = Machine(np.zeros(FEATURES + 1), rng.normal(0, 0.01, (FEATURES, RANK)))
    share = min(max(labels.mean(), 0.01), 0.99) if len(labels) else 0.5
    balance = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share))
    moments = [np.zeros_like(a) for a in (machine.weights, machine.weights, machine.factors, machine.factors)]
    step = 0
    while step < STEPS and len(labels):
        order = rng.permutation(len(labels))
        for i in range(0, len(order), BATCH):
            chosen, step = order[i : i + BATCH], step + 1
            slot, value = np.concatenate([slots[k] for k in chosen]), np.concatenate([values[k] for k in chosen])
            counts = np.array([len(slots[k]) for k in chosen])
            starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
            error = 1 / (1 + np.exp(-machine.logits(slot, value, starts))) - labels[chosen]
            error *= balance[chosen] / len(chosen)
            parts = machine.factors[slot] * value[:, None]
            row = np.repeat(np.arange(len(chosen)), counts)
            sums = np.add.reduceat(parts, starts)[row]
            used, inverse = np.unique(slot, return_inverse=True)
            slope = (error[row] * value)[:, None] * (sums - parts)
            by_factor = np.stack([np.bincount(inverse, slope[:, f], len(used)) for f in range(RANK)], axis=1)
            by_weight = np.bincount(inverse, error[row] * value, len(used))
            used_with_bias = np.append(used, FEATURES)
            _adam(machine.weights, moments[0], moments[1], used_with_bias, np.append(by_weight, error.sum()), step)
            _adam(machine.factors, moments[2], moments[3], used, by_factor, step)
    return machine


def _adam(array, first, second, at, slope, step):
    slope = slope + DECAY * array[at]
    first[at] = 0.9 * first[at] + 0.1 * slope
    second[at] = 0.999 * second[at] + 0.001 * slope**2
    rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
    array[at] -= rate * first[at] / (np.sqrt(second[at]) + 1e-8)


def _fit_rows(rows: pd.DataFrame) -> pd.DataFrame:
    """The model of a bounded sample, as a row per slot."""
    rows = rows.sort_values(["_rank", "_text"], kind="stable")
    found = [features(text, None if pd.isna(n) else n) for text, n in zip(rows["_text"], rows["_chars"])]
    machine = fit([f[0] for f in found], [f[1] for f in found], rows["_label"].to_numpy(dtype=float))
    factors = [*machine.factors.tolist(), [0.0] * RANK]
    return pd.DataFrame({"slot": np.arange(FEATURES + 1), "weight": machine.weights, "factors": factors})


def held_out(id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def fit_model(docs: DataFrame, labels: DataFrame, id="doc_id", text="text", n_chars="n_chars", sample=SAMPLE):
    """``slot, weight, factors`` of a machine fitted on at most ``sample`` labelled documents outside the held-out fold.

    A document with several labels has the lowest. Labels that are NULL or have no
    document are left out. Without any, the machine scores every text 0.5.
    """
    known = labels.where(F.col(id).isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col(id)))
    known = known.groupBy(F.col(id).alias("_id")).agg(F.min("quality").alias("_label"))
    rank = F.xxhash64("_id", F.lit(SEED))
    chosen = known.withColumn("_rank", rank).orderBy("_rank", "_id").limit(sample)
    rows = docs.select(F.col(id).alias("_id"), F.col(text).cast("binary").alias("_text"), F.col(n_chars).alias("_chars"))
    # The sample is bounded by its limit. Ids that are repeated are one document, that with the first text.
    rows = rows.join(F.broadcast(chosen), "_id").groupBy("_id", "_label", "_rank").agg(F.min(F.struct("_text", "_chars")).alias("_row"))
    rows = rows.select("_label", "_rank", "_row.*", F.lit("all").alias("_group"))
    return rows.groupBy("_group").applyInPandas(_fit_rows, _MODEL)


def score_column(text: Column, n_chars: Column, machine: Machine) -> Column:
    @F.pandas_udf("double")
    def scores(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, chars in batches:
            out = []
            for i in range(0, len(texts), BATCH):
                pairs = zip(texts.iloc[i : i + BATCH], chars.iloc[i : i + BATCH])
                found = [features(t, None if pd.isna(n) else n) for t, n in pairs]
                starts = np.concatenate([[0], np.cumsum([len(f[0]) for f in found])[:-1]])
                slots, values = (np.concatenate([f[k] for f in found]) for k in (0, 1))
                out.append(1 / (1 + np.exp(-np.clip(machine.logits(slots, values, starts), -500, 500))))
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))

    return scores(text.cast("binary"), n_chars.cast("double"))


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    *keep: str,
    id: str = "doc_id",
    text: str = "text",
    n_chars: str = "n_chars",
    threshold: float = THRESHOLD,
    sample: int = SAMPLE,
) -> DataFrame:
    """``keep``, ``held_out``, ``score`` and ``predicted`` of every row.

    The score is the probability of quality 1 from the text and its stored length; ids, labels,
    languages and sources are not looked at. A NULL text counts as empty, a NULL length as 0; a NULL id is not
    held out. Repeated rows are scored alike, and an empty table gives no rows.
    """
    spark = docs.sparkSession
    fitted = settled(fit_model(docs, labels, id, text, n_chars, sample)).toPandas().sort_values("slot")
    if len(fitted):
        machine = Machine(fitted["weight"].to_numpy(), np.stack(fitted["factors"].to_numpy())[:-1])
    else:
        machine = Machine(np.zeros(FEATURES + 1), np.zeros((FEATURES, RANK)))
    shared = spark.sparkContext.broadcast((machine.weights, machine.factors))  # fixed size
    score = score_column(F.col(text), F.col(n_chars), _Shared(shared))
    scored = docs.select(*keep, held_out(F.col(id)).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


class _Shared:
    """A machine that the executors fetch once, instead of with each task."""

    def __init__(self, shared):
        self.shared = shared

    def logits(self, *data):
        return Machine(*self.shared.value).logits(*data)
