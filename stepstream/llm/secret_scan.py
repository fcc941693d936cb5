"""Secrets in texts: three known forms, and tokens that a battery of randomness tests picks out.

A candidate is a run of at least 20 characters that keys are written in, or a part of one between signs.
Its encoding is the smallest
alphabet that has all of them. Three tests ask whether it could be random in that
encoding: chi-squared for even use of the alphabet, the number of runs above and below
the mean, and the serial correlation. The worst of the three, corrected for being the worst, is the candidate's
p-value. Among candidates of about the same length, over all documents, those are found out as not random that
hold a false discovery rate (Benjamini-Hochberg) of 0.3 %; they are no secrets.

What could be random could still be an odd word, above all if it is short. So a
second score says how unlike text it is: how often the kind of character changes, and how rarely
characters recur, each against what text of that length does. Cuts on this score hold a false
discovery rate of 1 % in the same way.

All of it is expressions of DataFrames that take time in proportion to a text, or nearly so, however many matches it has. Scores are counted in bins, so only a bounded table of
counts comes to the driver.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepstream.llm.tables import settled

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # runs of these two are maximal, so the least lengths can stand in the patterns
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6  # characters of the value
BASE = ("assign", "access", "hex")
RANDOM = "random"
LEAST = 20  # characters of a candidate
CANDIDATE = rf"[A-Za-z0-9+/_-]{{{LEAST},}}=*"  # '=' is padding, or stands between a name and its value
# A run may also be names and a key. Its parts are tested as well: those between all signs, those between
# '/' (with '_' and '-'), and those between '_', '-' (with '+' and '/').
PARTS = (rf"[A-Za-z0-9]{{{LEAST},}}", rf"[A-Za-z0-9_-]{{{LEAST},}}", rf"[A-Za-z0-9+/]{{{LEAST},}}=*")
# Encodings by size: a pattern of their tokens without padding, and how many symbols they have.
ENCODINGS = (
    ("[0-9]+", 10),
    ("[0-9a-f]+|[0-9A-F]+", 16),
    ("[a-z]+|[A-Z]+", 26),
    ("[A-Z2-7]+", 32),
    ("[a-z0-9]+|[A-Z0-9]+", 36),
    ("[A-Za-z]+", 52),
    ("[A-Za-z0-9]+", 62),
    ("[A-Za-z0-9+/]+|[A-Za-z0-9_-]+", 64),
)
OTHER_SYMBOLS = 66
TESTS = 3
RANDOM_LOST = 0.003  # share of random candidates among those found out as not random
TEXT_COLLISION, TEXT_TRIPLE = 0.066, 0.0055  # chance that two, or three, letters of a text are the same
TEXT_SWITCH = 0.12  # chance that the kind of character changes within a run of text
DISCOVERY_RATE = 0.01
_BINS = 10  # per standard deviation
_MOST = 400  # the last bin
_FEWEST = -1  # the first bin, of all scores below 0: none of them can pass
_MARK = "\x01"
_TOGETHER = 256  # lengths added up in a row; sums of so many are carried on
_HALVINGS = 31  # of a search among spans


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def _running(values: Column) -> Column:
    """Sums of all values before each. Arrays are copied when they grow, so they are grown to a bounded size and joined."""

    def sums(some, first):
        grown = F.aggregate(some, F.array(first), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
        return F.slice(grown, 1, F.size(some))

    def of(values):
        cuts = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _TOGETHER).cast("int"))
        blocks = F.transform(cuts, lambda i: F.slice(values, i * _TOGETHER + 1, _TOGETHER))
        return _let(blocks, joined)

    def joined(blocks):
        whole = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda acc, x: acc + x))
        return F.flatten(F.zip_with(blocks, sums(whole, F.lit(0)), sums))

    return _let(values, of)


def _matches(text: Column, pattern: str) -> Column:
    """``start, end, found`` of the leftmost matches that do not overlap, in code points. ``text`` is without marks."""
    pieces = F.split(F.regexp_replace(text, pattern, f"{_MARK}$0{_MARK}"), _MARK)

    def cut(pieces):
        lengths = F.transform(pieces, lambda piece: F.length(piece))
        placed = F.zip_with(pieces, _running(lengths), lambda piece, at: F.struct(at.alias("start"), (at + F.length(piece)).alias("end"), piece.alias("found")))
        return F.filter(placed, lambda _, i: i % 2 == 1)

    return _let(pieces, cut)


def _base_spans(text: Column) -> list[Column]:
    value = F.regexp_extract  # of a match: the pattern takes the same from it as from the text
    assign = F.filter(_matches(text, ASSIGN), lambda m: F.length(value(m["found"], ASSIGN, 2)) >= ASSIGN_LEAST)
    return [_bare(assign), _bare(_matches(text, ACCESS)), _bare(_matches(text, HEX))]


def _candidates(text: Column) -> Column:
    """Runs and their parts, each once."""

    def with_parts(run):
        def of(pattern):
            def moved(part):
                start, end = (run["start"] + part[name] for name in ("start", "end"))
                return F.struct(start.alias("start"), end.alias("end"), part["found"].alias("found"))

            return F.transform(_matches(run["found"], pattern), moved)

        every = F.array_sort(F.concat(F.array(run), *map(of, PARTS)))
        once = _let(every, lambda spans: F.filter(spans, lambda span, i: ~F.get(spans, i - 1).eqNullSafe(span)))
        return F.when(F.regexp_like(run["found"], F.lit("[+/_-]")), once).otherwise(F.array(run))

    return F.flatten(F.transform(_matches(text, CANDIDATE), with_parts))


def _bare(matches: Column) -> Column:
    return F.transform(matches, lambda match: F.struct(match["start"].alias("start"), match["end"].alias("end")))


def _meets(span: Column, spans: Column) -> Column:
    """Whether a span overlaps one of ``spans``, which are in order and do not overlap: the last that starts before its end tells."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(_HALVINGS))])
    starts_before = lambda n, step: F.get(spans, n + step - 1)["start"] < span["end"]
    short = F.filter(steps, lambda step: step <= F.size(spans))
    before = F.aggregate(short, F.lit(0), lambda n, step: F.when(starts_before(n, step), n + step).otherwise(n))
    return F.coalesce(F.get(spans, before - 1)["end"] > span["start"], F.lit(False))


def _named(spans: Column, kind: int) -> Column:
    def named(span):
        return F.struct(span["start"].alias("start"), F.lit(kind).alias("kind"), span["end"].alias("end"))

    return F.transform(spans, named)


def _tested(candidates: DataFrame) -> DataFrame:
    """Adds ``length``, ``misfit`` (of the worst test) and ``unlike_text`` (both in standard deviations) of the column ``token``.

    In steps, each of which is used more than once by the next, so Spark keeps it as a column.
    """
    bare = F.rtrim("token", F.lit("="))
    frame = candidates.withColumn("bare", bare).withColumn("n", F.length("bare").cast("double"))
    symbols = F.lit(OTHER_SYMBOLS)
    for pattern, size in reversed(ENCODINGS):
        symbols = F.when(F.regexp_like("bare", F.lit(f"^(?:{pattern})$")), size).otherwise(symbols)
    frame = frame.withColumns({"letters": F.split("bare", ""), "symbols": symbols})
    often = F.transform(F.array_distinct("letters"), lambda c: F.col("n") - F.length(F.replace("bare", c)))
    frame = frame.withColumns({"codes": F.transform("letters", lambda c: F.ascii(c).cast("double")), "often": often})
    frame = frame.withColumns(
        {
            "squares": _sum(F.transform("often", lambda x: x * x)),
            "kinds": F.transform("codes", _kind),
            "mean": F.try_divide(_sum("codes"), "n"),
        }
    )
    frame = frame.withColumns(
        {
            "deviations": F.transform("codes", lambda x: x - F.col("mean")),
            "above": F.transform("codes", lambda x: (x > F.col("mean")).cast("double")),
        }
    )
    lagged = F.zip_with("deviations", _shifted("deviations"), lambda a, b: a * F.coalesce(b, F.lit(0.0)))
    frame = frame.withColumns(
        {
            "spread": _sum(F.transform("deviations", lambda d: d * d)),
            "lagged": _sum(lagged),
            "high": _sum("above"),
            "crossings": _changes("above"),
            "switches": _changes("kinds"),
        }
    )
    k, n, over = F.col("symbols"), F.col("n"), F.try_divide
    chi = over(over(k, n) * F.col("squares") - n - (k - 1), F.sqrt(2 * (k - 1) * over(n - 1, n)))
    runs = 1 + 2 * F.col("high") * over(n - F.col("high"), n)
    crossing = over(F.col("crossings") + 1 - runs, F.sqrt(over((runs - 1) * (runs - 2), n - 1)))
    serial = (over("lagged", "spread") + over(F.lit(1.0), n)) * F.sqrt(n)
    worst = F.greatest(chi, F.abs(crossing), F.abs(serial))
    pairs = n * (n - 1) / 2
    triples = 2 * (n - 2) * TEXT_TRIPLE - (2 * n - 3) * TEXT_COLLISION**2
    recur = over(pairs * TEXT_COLLISION - (F.col("squares") - n) / 2, F.sqrt(pairs * (TEXT_COLLISION + triples)))
    switch = over(F.col("switches") - (n - 1) * TEXT_SWITCH, F.sqrt((n - 1) * TEXT_SWITCH * (1 - TEXT_SWITCH)))
    # A token of one symbol, or of padding only, has no spread to test.
    testable = (n >= LEAST // 2) & (F.col("spread") > 0) & (runs > 2)
    return frame.select(
        *candidates.columns,
        F.length("token").alias("length"),
        F.when(testable, worst).alias("misfit"),
        F.when(testable, (recur + switch) / math.sqrt(2)).otherwise(0.0).alias("unlike_text"),
    )


def _sum(values) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _shifted(values: str) -> Column:
    return F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0)))


def _changes(values: str) -> Column:
    """How many neighbours differ."""
    return _sum(F.zip_with(values, _shifted(values), lambda a, b: F.coalesce((a != b).cast("double"), F.lit(0.0))))


def _kind(code: Column) -> Column:
    """Digit, capital, small letter or sign."""
    digit, capital, small = code.between(48, 57), code.between(65, 90), code.between(97, 122)
    return F.when(digit, 0).when(capital, 1).when(small, 2).otherwise(3)


def _length_class(length: Column) -> Column:
    """Two classes for each doubling of the length."""
    return F.floor(2 * F.log2(length / F.lit(float(LEAST)))).cast("int")


def _score_bin(score: Column) -> Column:
    return F.greatest(F.least(F.floor(score * _BINS), F.lit(_MOST)), F.lit(_FEWEST))


def discovery_cuts(counts, rate: float = DISCOVERY_RATE, tails: int = 1) -> dict[int, float]:
    """The least score that is a discovery in each length class, from ``(class, bin, candidates)``.

    The p-value of a score is the chance of as much in any of so many ``tails`` of the normal distribution. The score of a bin's candidates is taken as its
    lower bound, so the rate is not exceeded.
    """
    cuts: dict[int, float] = {}
    for length_class in {c for c, _, _ in counts}:
        own = sorted(((b, n) for c, b, n in counts if c == length_class), reverse=True)
        total, seen = sum(n for _, n in own), 0
        for lowest, n in own:
            seen += n
            if tails * math.erfc(lowest / _BINS / math.sqrt(2)) / 2 * total <= rate * seen:
                cuts[length_class] = lowest / _BINS
    return cuts


def scan_secrets(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """``keep``, and ``base`` and all ``spans`` of every row: structs of ``start``, ``kind``, ``end`` by start, then kind.

    ``kind`` is 0 to 2 as in :data:`BASE`, or 3 for a token that the tests pick out and that lies in no
    other span. Positions count code points, the end is exclusive. A NULL text counts
    as empty. Repeated rows are scanned alike and each counts as a document. An empty table gives
    no rows. A control character 1 in a text is taken for another, which moves nothing.
    """
    plain = F.translate(F.coalesce(F.col(text), F.lit("")), _MARK, "\x02")
    texts = docs.select(F.struct(*keep).alias("_keep"), plain.alias("_text"))
    found = texts.select(
        F.monotonically_increasing_id().alias("_row"),  # settled with the rows
        "_keep",
        F.array(*_base_spans(F.col("_text"))).alias("by_kind"),
        _candidates(F.col("_text")).alias("candidates"),
    )
    found = settled(found)
    known = [F.get("by_kind", kind) for kind in range(len(BASE))]
    alone = F.filter("candidates", lambda c: ~reduce(Column.__or__, [_meets(c, spans) for spans in known]))
    tokens = found.select("_row", F.explode(alone).alias("c"))
    tokens = tokens.select("_row", "c.start", "c.end", F.col("c.found").alias("token"))
    tested = _tested(tokens).drop("token").withColumn("length_class", _length_class(F.col("length")))
    tested = settled(tested).where("misfit is not null")  # a condition before would repeat the tests
    misfits = _cuts(tested, "misfit", RANDOM_LOST, 2 * TESTS)
    texts_end = _cuts(tested, "unlike_text", DISCOVERY_RATE, 1)
    fits = misfits.isNull() | (_score_bin(F.col("misfit")) < F.round(misfits * _BINS))
    picked = tested.where(fits & (_score_bin(F.col("unlike_text")) >= F.round(texts_end * _BINS)))
    # In order of start, the longest first, a span lies in another if one before it reaches as far.
    before = Window.partitionBy("_row").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    picked = picked.withColumn("reach", F.max("end").over(before)).where("reach is null or end > reach")
    span = F.struct("start", F.lit(len(BASE)).alias("kind"), "end")
    picked = picked.groupBy("_row").agg(F.collect_list(span).alias("picked"))
    base = F.array_sort(F.concat(*[_named(spans, kind) for kind, spans in enumerate(known)])).alias("base")
    both = found.join(picked, "_row", "left").select("_keep", base, "picked")
    spans = F.when(F.col("picked").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "picked")))
    return both.select("_keep.*", "base", spans.alias("spans"))


def _cuts(tested: DataFrame, score: str, rate: float, tails: int) -> Column:
    """The cut on a score for the length class of a row; NULL where nothing is a discovery."""
    counts = tested.groupBy("length_class", _score_bin(F.col(score)).alias("score_bin")).count().collect()  # a few thousand rows at most
    cut_of = F.lit(None).cast("double")
    for length_class, cut in discovery_cuts([tuple(c) for c in counts], rate, tails).items():
        cut_of = F.when(F.col("length_class") == length_class, cut).otherwise(cut_of)
    return cut_of


def spans_as_text(spans: Column) -> Column:
    """``kind:start:end`` of each, joined by commas."""
    names = F.array(*map(F.lit, (*BASE, RANDOM)))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
