"""Quality rules by weak supervision: rules vote, expectation-maximisation weighs them.

Each rule looks at one statistic of a text and votes bad, good or not at all. For good
and bad texts apart, a model keeps how often each rule's votes are right, so it learns which
votes mean much and which little. It is fitted by expectation-maximisation on
how often each combination of votes occurs among all documents. There are at most 3 to
the power of the number of rules, so this table is small however many documents there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepstream.llm.cache import give_back
from stepstream.llm.tables import settled

SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\x0b\x0c\r"
_INSIDE_CODE_POINT = bytes(range(0x80, 0xC0))
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_STATS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "n_lines bigint, n_upper bigint, n_lower bigint, n_shouts bigint, n_stutters bigint, n_distinct bigint, "
    "n_marked bigint"
)
MIN_WORDS = 50
KEPT_FROM = 0.5


def text_stats(text: bytes | None) -> tuple:
    """The statistics that rules look at, of one whole text. A NULL text has no words."""
    text = text or b""
    words = text.split()
    kinds: dict[bytes, int] = {}
    ids = np.fromiter((kinds.setdefault(w, len(kinds)) for w in words), np.int64, len(words))
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text.translate(None, _SPACE + _INSIDE_CODE_POINT)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated(ids, len(kinds)),
        len(lines),
        len(text) - len(text.translate(None, _UPPER)),
        len(text) - len(text.translate(None, _LOWER)),
        text.count(b"!"),
        int((ids[1:] == ids[:-1]).sum()),
        len(kinds),
        sum(1 for w in words if w[-1:] in b"#*$%&|<>!"),
    )


def _repeated(ids: np.ndarray, kinds: int) -> int:
    """Words that lie in a window of three words found more than once."""
    if len(ids) < 4:
        return 0
    pairs = np.unique(ids[:-1] * kinds + ids[1:], return_inverse=True)[1]
    triples, counts = np.unique(pairs[:-1] * kinds + ids[2:], return_inverse=True, return_counts=True)[1:]
    often = counts[triples] > 1
    covered = np.zeros(len(ids), dtype=bool)
    for i in range(3):
        covered[i : i + len(often)] |= often
    return int(covered.sum())


def _stats(text: Column) -> Column:
    """Of a binary column."""

    @F.pandas_udf(_STATS)
    def stats(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [part.split()[0] for part in _STATS.split(",")]
        for batch in texts:
            yield pd.DataFrame([text_stats(t) for t in batch], columns=names)
        give_back()

    return stats(text)


class Rule(NamedTuple):
    """Votes bad from ``bad`` on, good up to ``good``; abstains in between, and where there is nothing to share."""

    name: str
    part: str
    whole: str
    good: float
    bad: float

    def vote(self) -> Column:
        """0 bad, 1 no vote, 2 good."""
        share = F.expr(f"{self.part} / nullif({self.whole}, 0)")
        return F.when(share >= self.bad, 0).when(share <= self.good, 2).otherwise(1)


RULES = (
    Rule("symbols", "n_symbols", "n_words", 0.05, 0.3),
    Rule("marked", "n_marked", "n_words", 0.03, 0.2),
    Rule("capitals", "n_upper", "(n_upper + n_lower)", 0.15, 0.4),
    Rule("shouts", "n_shouts", "n_words", 0.03, 0.2),
    Rule("repeats", "n_repeat_words", "n_words", 0.1, 0.3),
    Rule("lines", "n_dup_lines", "n_lines", 0.05, 0.5),
    Rule("stutters", "n_stutters", "n_words", 0.02, 0.1),
    Rule("word_length", "word_chars", "n_words", 9.0, 14.0),
)


def fit_votes(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Probability that a text is good for each row of ``votes``, seen ``counts`` times.

    A text starts as bad if it has bad votes. A rule that abstains says nothing: only how often
    its votes are good or bad in each class is estimated. One imagined text per vote and class
    keeps probabilities off 0, and a class that is empty from being forgotten.
    """
    one_hot = np.eye(3)[votes][:, :, ::2]
    bad = (votes == 0).sum(axis=1)
    good = np.where(bad > 0, 0.1 / np.maximum(bad, 1), 0.95)
    for _ in range(rounds):
        log = np.zeros((2, len(votes)))
        for c, weight in enumerate(((1 - good) * counts, good * counts)):
            seen = np.einsum("p,prv->rv", weight, one_hot) + 1.0
            seen /= seen.sum(axis=1, keepdims=True)
            log[c] = np.einsum("prv,rv->p", one_hot, np.log(seen))
            log[c] += np.log(weight.sum() + 1.0)
        after = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        if np.abs(after - good).max() < 1e-9:
            return after
        good = after
    return good


def judge(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The columns ``keep``, the statistics, ``base_failed``, ``quality`` and ``kept`` of every row.

    ``base_failed``: fewer than 50 words, or over half of them in repeated windows of three
    words. ``quality`` is the probability that the text is good, by its votes; ``kept``
    needs 0.5 of it and no base failure. A NULL, empty or blank text has no words and
    fails. Repeated rows are judged alike and each counts as a document. An empty table
    gives no rows. Other columns than ``text`` and ``keep`` are not looked at.
    """
    judged = _judged(docs.select(F.struct(*keep).alias("_row"), F.col(text).cast("binary").alias("_text")))
    return judged.select("_row.*", *[c for c in judged.columns if c != "_row"])


def _judged(rows: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    stats = rows.select("_row", _stats(F.col("_text")).alias("_stats")).select("_row", "_stats.*")
    code = F.lit(0)
    for rule in RULES:
        code = code * 3 + rule.vote()
    stats = settled(stats.withColumn("_code", code))
    seen = stats.groupBy("_code").count().collect()  # at most 3 ** len(RULES) rows
    codes = np.array([r[0] for r in seen], dtype=np.int64)
    powers = 3 ** np.arange(len(RULES) - 1, -1, -1)
    votes = (codes[:, None] // powers) % 3
    quality = fit_votes(votes, np.array([r[1] for r in seen], dtype=float)) if seen else []
    model = [(int(c), float(q)) for c, q in zip(codes, quality)]
    model = F.broadcast(spark.createDataFrame(model, "_code int, quality double"))  # bounded as above
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = stats.join(model, "_code").drop("_code").withColumn("base_failed", failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEPT_FROM))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`judge` keeps, as they are.

    Whole rows pass through the statistics, so repeated rows, NULL ids and columns
    of any name need no key.
    """
    rows = docs.select(F.struct("*").alias("_row"), F.col(text).cast("binary").alias("_text"))
    return _judged(rows).where("kept").select("_row.*")
