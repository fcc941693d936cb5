"""URL filters: site rules by hand, and rules mined from labelled URLs.

A URL is a set of tokens: the labels of its host, the parts of its path and the names of
its query. Tokens that occur in the same labelled URLs, such as the parts of a fixed path, are one
item, and a URL has an item if it has any of its tokens. FP-growth finds item sets that often occur with a label. The association
rules that are sure enough, common enough and not just a longer form of one
that is as sure, make the filter. It is applied through an inverted index: each rule
stands under its rarest item only, and a URL that has this item is tested for the others.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepstream.llm.tables import settled

ALLOW, BLOCK = "allow", "block"
LEAST_URLS = 20  # labelled URLs that a rule needs
CONFIDENCE = 0.8
BROADCAST_ROWS = 100_000  # rules of some hundred bytes
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LABEL = "label="  # no token of a URL has this form


class SiteRule(NamedTuple):
    verdict: str
    host: str
    path: str


SITE_RULES = (
    SiteRule(ALLOW, "com", "/"),
    SiteRule(BLOCK, "example.com", "/en/"),
    SiteRule(ALLOW, "www.example.com", "/en/"),
    SiteRule(BLOCK, "net", "/es/"),
    SiteRule(BLOCK, "net", "/fr/"),
)


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?", group)


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(_part(url, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return _part(url, 2)


def url_tokens(url: Column) -> Column:
    """Sorted distinct tokens. Host labels are marked by their place from the right; numbers are all alike."""
    labels = F.reverse(F.split(host_of(url), r"\."))
    host = F.transform(labels, lambda label, i: F.concat(F.lit("h"), F.least(i, F.lit(9)), F.lit("="), label))
    words = F.split(F.regexp_replace(F.lower(path_of(url)), "[0-9]+", "0"), r"[^\p{L}0-9]+")
    path = F.transform(F.filter(words, lambda w: w != ""), lambda w: F.concat(F.lit("p="), w))
    names = F.transform(F.split(F.substr(_part(url, 3), F.lit(2)), "&"), lambda pair: F.substring_index(pair, "=", 1))
    query = F.transform(F.filter(names, lambda n: n != ""), lambda n: F.concat(F.lit("q="), F.lower(n)))
    return F.array_sort(F.array_distinct(F.concat(host, path, query)))


def site_rule(host: Column, path: Column, rules=SITE_RULES) -> Column:
    """The longest rule whose host, or a domain above it, and start of the path fit, as ``rule, verdict``; else NULL."""
    fitting = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):  # the longest is asked first
        of_host = (host == rule.host) | host.endswith("." + rule.host)
        found = F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        fitting = F.when(of_host & path.startswith(rule.path), found).otherwise(fitting)
    return fitting


def token_items(labelled: DataFrame, least: int) -> DataFrame:
    """``token, item, n, verdict`` of the tokens in at least ``least`` rows of ``labelled (id, tokens, label)``.

    Tokens of exactly the same rows share an item, named by the first of them. ``n`` counts its rows; ``verdict`` is
    their label if they all have the same, else NULL.
    """
    sums = [F.sum(F.xxhash64("id", F.lit(i)).cast("decimal(20)")).alias(f"rows_{i}") for i in range(2)]
    seen = labelled.select("id", "label", F.explode("tokens").alias("token"))
    ends = [F.min("label").alias("low"), F.max("label").alias("high")]
    seen = seen.groupBy("token").agg(F.count("*").alias("n"), *ends, *sums).where(F.col("n") >= least)
    alike = Window.partitionBy("n", "rows_0", "rows_1")
    verdict = F.when(F.col("low") == F.col("high"), F.col("low")).alias("verdict")
    return seen.select("token", F.min("token").over(alike).alias("item"), "n", verdict)


def as_items(rows: DataFrame, items: DataFrame) -> DataFrame:
    """``rows (id, tokens)`` with an ``id`` of their own as ``id, items``, sorted. Rows without any go."""
    met = rows.select("id", F.explode("tokens").alias("token")).join(_small(items.select("token", "item")), "token")
    return met.groupBy("id").agg(F.array_sort(F.collect_set("item")).alias("items"))


def mine_rules(labelled: DataFrame, confidence: float = CONFIDENCE, least_urls: int = LEAST_URLS) -> tuple[DataFrame, DataFrame]:
    """``tokens, verdict, confidence, support`` of the rules found in ``labelled (id, tokens, label)``, and the items of tokens.

    The ``tokens`` of a rule are items. ``id`` is the row's own. An item whose rows all have one label is a rule by itself, and any set
    with it a longer form of that, so only the other items go to FP-growth, which holds the frequent ones on the driver. It looks at all sets of
    these that are common enough, whose number can double with each such item of a URL.
    """
    labelled = settled(labelled)
    items = settled(token_items(labelled, least_urls))
    open_items = as_items(labelled, items.where("verdict is null"))
    having = as_items(labelled, items).select("id").join(labelled.select("id", "label"), "id").join(open_items, "id", "left")
    none = F.array().cast("array<string>")
    baskets = having.select(F.concat(F.coalesce("items", none), F.array(F.concat(F.lit(_LABEL), "label"))).alias("items"))
    baskets = settled(baskets)
    count = max(baskets.count(), 1)
    share = (least_urls - 0.5) / count  # Spark rounds the product up to a count
    model = FPGrowth(minSupport=min(share, 1.0), minConfidence=confidence).fit(baskets)
    verdict = F.substr(F.element_at("consequent", 1), F.lit(len(_LABEL) + 1))
    rules = model.associationRules.where(F.element_at("consequent", 1).startswith(_LABEL))
    rules = rules.select(F.array_sort("antecedent").alias("tokens"), verdict.alias("verdict"), "confidence", "support")
    rules = _without_longer_forms(settled(rules))
    sure = items.where("verdict is not null and token = item")
    sure = sure.select(F.array("item").alias("tokens"), "verdict", F.lit(1.0).alias("confidence"), (F.col("n") / count).alias("support"))
    return rules.unionByName(sure), items


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _without_longer_forms(rules: DataFrame) -> DataFrame:
    """Drops a rule if another of fewer tokens, all of them its own, gives the same verdict as surely.

    The other would be found under its first token, so only rules that share one are compared.
    """
    longer = rules.select("tokens", "verdict", "confidence", F.explode("tokens").alias("token"))
    shorter = rules.select(
        F.col("tokens").alias("fewer"),
        F.col("verdict").alias("same"),
        F.col("confidence").alias("sure"),
        F.element_at("tokens", 1).alias("token"),
    )
    within = (F.size("fewer") < F.size("tokens")) & (F.size(F.array_except("fewer", "tokens")) == 0)
    as_sure = (F.col("same") == F.col("verdict")) & (F.col("sure") >= F.col("confidence"))
    met = longer.join(shorter, (longer["token"] == shorter["token"]) & within & as_sure)
    return rules.join(met.select("tokens", "verdict").distinct(), ["tokens", "verdict"], "left_anti")


def match_rules(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """``tokens, learned`` for the distinct ``token_sets`` that a rule fits: the surest one, then the most common."""
    single = token_sets.select(F.explode("tokens").alias("token")).groupBy("token").count()
    keyed = rules.withColumn("token", F.explode("tokens")).join(single, "token", "left")
    rarest = F.min_by("token", F.struct(F.coalesce("count", F.lit(0)), "token")).alias("token")
    index = _small(settled(keyed.groupBy(F.col("tokens").alias("needed"), "verdict", "confidence", "support").agg(rarest)))
    probes = token_sets.select("tokens", F.explode("tokens").alias("token"))
    fits = F.size(F.array_except("needed", "tokens")) == 0
    met = probes.join(index, (probes["token"] == index["token"]) & fits)
    best = F.max(F.struct("confidence", "support", "verdict", "needed")).alias("learned")
    return met.groupBy("tokens").agg(best)


def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    *keep: str,
    id: str = "page_id",
    url: str = "url",
    label_id: str = "doc_id",
    rules=SITE_RULES,
) -> DataFrame:
    """``keep, host, path, rule, verdict, learned`` of every row.

    A site rule decides if one fits, else the best mined rule, else the URL is allowed. The mined
    rules learn from ``labels`` alone: quality 0 is blocked, 1 allowed, and of several labels of an id the lowest counts. A URL
    counts once with each label, however many rows have it. A NULL URL, or one
    without ``://``, has an empty host and path and no tokens. Repeated rows are judged alike; an
    empty table gives no rows.
    """
    judged = pages.select(
        F.struct(*keep).alias("_keep"),
        F.col(id).alias("_id"),
        F.xxhash64(url).alias("url_hash"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
        F.when(F.contains(url, F.lit("://")), url_tokens(F.col(url))).otherwise(F.array().cast("array<string>")).alias("tokens"),
    )
    judged = settled(judged.withColumn("site", site_rule(F.col("host"), F.col("path"), rules)))
    known = labels.where("quality is not null").groupBy(F.col(label_id).alias("_id")).agg(F.min("quality").alias("quality"))
    label = F.when(F.col("quality") == 0, BLOCK).otherwise(ALLOW).alias("label")
    labelled = judged.join(known, "_id").where("size(tokens) > 0").select("url_hash", "tokens", label).distinct()
    labelled = labelled.select(F.struct("url_hash", "label").alias("id"), "tokens", "label")
    mined, items = mine_rules(labelled)
    mined = settled(mined)

    open_urls = judged.where("site is null").select(F.col("tokens").alias("id"), "tokens").distinct()
    asked = settled(as_items(open_urls, items))
    learned = match_rules(asked.select(F.col("items").alias("tokens")).distinct(), mined)
    learned = asked.join(learned.withColumnRenamed("tokens", "items"), "items").select(F.col("id").alias("tokens"), "learned")
    verdict = F.coalesce("site.verdict", "learned.verdict", F.lit(ALLOW))
    rule = F.when(F.col("site").isNotNull(), F.col("site.rule"))
    shown = F.when(F.col("site").isNull(), F.array_join("learned.needed", " "))
    decided = judged.join(learned, "tokens", "left")
    return decided.select("_keep.*", "host", "path", rule.alias("rule"), verdict.alias("verdict"), shown.alias("learned"))
