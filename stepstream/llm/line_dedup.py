"""Passages of three lines that occur before, found and removed across all documents.

Every three consecutive lines of a document are hashed as one window. Of a window found more
than once, the first occurrence (smallest id, then line) stays, and the lines under
the others go. Windows overlap, so a longer passage goes whole: the positions that they cover are merged.

A hash has 96 bits, so windows can be told apart at any size. They are counted with partial
sums, so a window that a third of all documents share costs one row per task there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepstream.llm.tables import settled

LINES = 3


def _windows(docs: DataFrame) -> DataFrame:
    """``_doc, at, h1, h2`` for each window; ``at`` is its first line. Shorter texts have none."""
    lines = docs.select("_doc", F.split("_text", "\n").alias("lines"))
    coded = lines.select(
        "_doc",
        F.transform("lines", lambda line: F.xxhash64(line)).alias("a"),
        F.transform("lines", lambda line: F.hash(line)).alias("b"),
    )
    last = F.size("a") - LINES

    def window(i):
        one = F.xxhash64(*[F.get("a", i + j) for j in range(LINES)])
        two = F.hash(*[F.get("b", i + j) for j in range(LINES)])
        return F.struct(one.alias("h1"), two.alias("h2"))

    found = F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), window))
    # An outer explode, since for an inner one Spark would hash all once more to drop empty texts early.
    exploded = coded.select("_doc", F.posexplode_outer(found).alias("at", "window"))
    return exploded.where("at is not null").select("_doc", "at", "window.h1", "window.h2")


def repeated_lines(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``_doc`` and ``repeated``, the positions of lines to remove, of the documents that have any."""
    doc = F.struct(F.col(id).alias("id"), F.xxhash64(text).alias("text_hash")).alias("_doc")
    # Repeated rows are one document; exchanging hashes alone spares a shuffle of texts.
    windows = _windows(docs.select(doc, F.col(text).alias("_text"))).groupBy("h1", "h2", "_doc", "at").agg(F.lit(1))
    windows = windows.select("h1", "h2", "_doc", "at")
    first = F.min(F.struct(F.col("_doc.id").isNull(), "_doc", "at")).alias("first")
    seen = windows.groupBy("h1", "h2").agg(F.count("*").alias("n"), first).where("n > 1")
    seen = seen.select("h1", "h2", F.struct("first._doc", "first.at").alias("first"))
    later = windows.join(seen, ["h1", "h2"]).where(F.struct("_doc", "at") != F.col("first"))
    covered = later.select("_doc", F.explode(F.sequence("at", F.col("at") + LINES - 1)).alias("line"))
    return covered.groupBy("_doc").agg(F.sort_array(F.collect_set("line")).alias("repeated"))


def drop_repeated_lines(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` as the struct ``row``, its text without repeated passages, with ``n_lines`` and ``n_removed``.

    Lines are what stands between line feeds, compared exactly; empty lines count. Of
    windows in several documents the one in the smallest id stays, NULL last; among
    equal ids the hash of the text decides. Repeated rows (of equal id and text) are one
    document and come out alike. A NULL text stays NULL with no lines, an empty one is one
    empty line. A text of which all lines go becomes empty.
    """
    found = settled(repeated_lines(docs, id, text))
    doc = F.struct(F.col(id).alias("id"), F.xxhash64(text).alias("text_hash"))
    own = docs.select(F.struct("*").alias("_row"), doc.alias("_doc")).join(found.hint("shuffle_hash"), "_doc", "left")
    own = own.withColumn("_lines", F.split(F.col("_row")[text], "\n"))
    own = own.withColumns(
        {
            "_starts": F.filter("repeated", lambda at, i: ~F.get("repeated", i - 1).eqNullSafe(at - 1)),
            "_ends": F.filter("repeated", lambda at, i: ~F.get("repeated", i + 1).eqNullSafe(at + 1)),
        }
    )
    # What lies between the runs of repeated lines, each cut out once, so a long text takes time in proportion.
    after = F.concat(F.array(F.lit(0)), F.transform("_ends", lambda at: at + 1))
    upto = F.concat("_starts", F.array(F.size("_lines")))
    kept = F.flatten(F.zip_with(after, upto, lambda a, b: F.slice("_lines", a + 1, b - a)))
    rest = F.when(F.col("repeated").isNull(), F.col("_row")[text]).otherwise(F.array_join(kept, "\n"))
    removed = F.when(F.col("repeated").isNull(), 0).otherwise(F.size("repeated")).cast("bigint")
    return own.select(
        F.col("_row").withField(text, rest).alias("row"),
        F.when(F.col("_lines").isNull(), 0).otherwise(F.size("_lines")).cast("bigint").alias("n_lines"),
        removed.alias("n_removed"),
    )
