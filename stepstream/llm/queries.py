"""The dealt operators as queries over the tables of a folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepstream.llm.decontaminate import find_passages
from stepstream.llm.hard_negatives import mine_hard_negatives
from stepstream.llm.line_dedup import drop_repeated_lines
from stepstream.llm.merkle_manifest import FIELDS, fold, manifest, proof_digest, row_digest
from stepstream.llm.mixing import mix
from stepstream.llm.quality_model import score_quality
from stepstream.llm.quality_rules import judge
from stepstream.llm.secret_scan import BASE, scan_secrets, spans_as_text
from stepstream.llm.simhash_dedup import hex_fingerprint, near_duplicates
from stepstream.llm.suffix_dedup import drop_repeated_strings
from stepstream.llm.token_count import count_tokens
from stepstream.llm.token_files import token_table
from stepstream.llm.url_filter import filter_urls
from stepstream.sources import read_table


def decontamination(spark, folder):
    found = find_passages(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))
    return found.select(
        F.col("doc.id").alias("doc_id"), F.col("item.id").alias("item_id"), "similarity", "start", "width"
    )


def url_filter(spark, folder):
    return filter_urls(read_table(spark, folder, "pages"), read_table(spark, folder, "labels"), "page_id")


def source_mix(spark, folder):
    mixed = mix(read_table(spark, folder, "documents").select("doc_id", "text", "source"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("row.doc_id", "size", "source_size", "target", taken)


def quality_model(spark, folder):
    return score_quality(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"), "doc_id")


def token_output(spark, folder):
    return token_table(read_table(spark, folder, "documents"))


def simhash_near_dedup(spark, folder):
    linked = near_duplicates(read_table(spark, folder, "documents"))
    return linked.select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def quality_rules(spark, folder):
    return judge(read_table(spark, folder, "documents"), "doc_id")


def secret_scan(spark, folder):
    found = scan_secrets(read_table(spark, folder, "documents"), "doc_id")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{kind}") for i, kind in enumerate(BASE)],
        F.sha2(spans_as_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        spans_as_text(F.col("spans")).alias("spans"),
    )


def line_dedup(spark, folder):
    left = drop_repeated_lines(read_table(spark, folder, "documents"))
    return left.select("row.doc_id", "row.text", "n_lines", "n_removed")


def token_counts(spark, folder):
    return count_tokens(read_table(spark, folder, "documents"), "doc_id")


def suffix_dedup(spark, folder):
    left = drop_repeated_strings(read_table(spark, folder, "documents"), "doc_id")
    return left.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("starts").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def hard_negatives(spark, folder):
    """One vector in seven has the label after its own, so anchors have negatives that come close."""
    vectors = read_table(spark, folder, "embeddings")
    label = F.col("label").cast("bigint")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return mine_hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 50 == 0, all_rows=True)


def merkle_manifest(spark, folder):
    """Half of the documents lose their line feeds after the manifest was made."""
    docs = read_table(spark, folder, "documents").select(*FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    left = F.when(tampered, F.translate("text", "\n", "")).otherwise(F.col("text"))
    offered = row_digest(*[left if name == "text" else F.col(name) for name in FIELDS])
    proven = manifest(docs.withColumn("offered", offered), "doc_id", "offered")
    proven = proven.withColumn("folded_root", fold(F.col("offered"), F.col("path")))
    return proven.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES = {
    "op1_decontamination": decontamination,
    "op2_url_filter": url_filter,
    "op3_source_mix": source_mix,
    "op4_quality_model": quality_model,
    "op5_token_output": token_output,
    "op6_simhash_near_dedup": simhash_near_dedup,
    "op7_quality_rules": quality_rules,
    "op8_secret_scan": secret_scan,
    "op9_line_dedup": line_dedup,
    "op10_token_counts": token_counts,
    "op11_suffix_dedup": suffix_dedup,
    "op12_hard_negatives": hard_negatives,
    "op13_merkle_manifest": merkle_manifest,
}

_RUN = r"[^\x20\x09-\x0D]+"

# Each window of three lines by its text: where it occurs first, and the lines under later ones.
_LINES = r"""
WITH lines AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
windows AS (
  SELECT doc_id, pos, l[pos] || chr(10) || l[pos + 1] || chr(10) || l[pos + 2] AS passage
  FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS pos FROM lines)),
placed AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY passage ORDER BY doc_id, pos) AS occurrence FROM windows),
covered AS (
  SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS pos FROM placed WHERE occurrence > 1),
removed AS (
  SELECT doc_id, list(pos) AS gone FROM covered GROUP BY doc_id)
SELECT doc_id,
  CASE WHEN gone IS NULL THEN text ELSE array_to_string(
    [l[i] FOR i IN range(1, len(l) + 1) IF NOT list_contains(gone, i)], chr(10)) END AS text,
  coalesce(len(l), 0)::BIGINT AS n_lines,
  coalesce(len(gone), 0)::BIGINT AS n_removed
FROM lines LEFT JOIN removed USING (doc_id)"""

# Every window that shares a shingle with an item of its size, compared with that item in full.
_PASSAGES = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(lower(text), '{_RUN}') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(lower(text), '{_RUN}') AS w FROM benchmark),
shingles AS (
  SELECT doc_id, len(w) - 4 AS n, unnest(range(0, len(w) - 4)) AS pos,
    unnest([array_to_string(w[i + 1:i + 5], ' ') FOR i IN range(0, len(w) - 4)]) AS s
  FROM words WHERE len(w) >= 5),
item_shingles AS (
  SELECT item_id, len(w) - 4 AS size,
    unnest([array_to_string(w[i + 1:i + 5], ' ') FOR i IN range(0, len(w) - 4)]) AS s
  FROM item_words WHERE len(w) >= 5),
counts AS (
  SELECT item_id, size, s, count(*) AS c FROM item_shingles GROUP BY ALL),
starts AS (
  SELECT DISTINCT doc_id, item_id, size, least(size, n) AS width,
    unnest(range(greatest(0, pos - least(size, n) + 1), least(pos, n - least(size, n)) + 1)) AS start
  FROM shingles JOIN counts USING (s)),
shared AS (
  SELECT doc_id, item_id, size, width, start, s, count(*) AS c
  FROM starts JOIN shingles USING (doc_id)
  WHERE pos BETWEEN start AND start + width - 1 GROUP BY ALL),
alike AS (
  SELECT doc_id, item_id, start, width, sum(least(shared.c, counts.c)) AS common, size
  FROM shared JOIN counts USING (item_id, size, s) GROUP BY doc_id, item_id, size, start, width),
scored AS (
  SELECT doc_id, item_id, common / (size + width - common) AS similarity, start, width FROM alike)
SELECT doc_id, item_id, similarity, start::INTEGER AS start, width::BIGINT AS width FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start, width) AS k
  FROM scored WHERE similarity >= 0.8) WHERE k = 1"""

# All pairs of an anchor and another row, ranked among the positives, and for each positive among its window.
_HARD_NEGATIVES = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, place::INTEGER AS rank, negative_id, positive_score, negative_score FROM (
  SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS place
  FROM positives JOIN pairs USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
WHERE place <= 3"""

# CRC-32 of a text of digits: each byte is added, then eight bits are shifted out (marked -1 here).
_CRC32 = """xor(4294967295, list_reduce(
    list_concat([4294967295], flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split({text}, '')])),
    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, (crc & 1) * 3988292384) END))"""


def _field(value):
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _leaf(text):
    return "sha256(" + " || ".join(_field(text if name == "text" else name) for name in FIELDS) + ")"


# Both kinds of tree are grown a level at a time; each leaf then climbs its own tree and the one on top.
_MERKLE = f"""
WITH RECURSIVE documents_read AS (
  SELECT doc_id, source, {_leaf("text")} AS leaf,
    CASE WHEN {_CRC32.format(text="doc_id::VARCHAR")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS offered,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot FROM documents_read),
grown AS (
  SELECT tree, 0 AS level, spot, leaf AS hash FROM leaves
  UNION ALL
  SELECT tree, level + 1, spot // 3, sha256(string_agg(hash, '' ORDER BY spot))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM grown) WHERE n > 1 GROUP BY tree, level, spot // 3),
subroots AS (
  SELECT tree, max(level) AS height, arg_max(hash, level) AS hash FROM grown GROUP BY tree),
top AS (
  SELECT 0 AS level, tree AS spot, hash FROM subroots
  UNION ALL
  SELECT level + 1, spot // 3, sha256(string_agg(hash, '' ORDER BY spot))
  FROM (SELECT *, count(*) OVER () AS n FROM top) WHERE n > 1 GROUP BY level, spot // 3),
root AS (
  SELECT max(level) AS height, arg_max(hash, level) AS hash FROM top),
beside AS (
  SELECT a.tree, a.level, a.spot,
    coalesce(string_agg(b.hash, '' ORDER BY b.spot) FILTER (WHERE b.spot < a.spot), '') AS before,
    coalesce(string_agg(b.hash, '' ORDER BY b.spot) FILTER (WHERE b.spot > a.spot), '') AS after
  FROM (SELECT * FROM grown UNION ALL SELECT -1, level, spot, hash FROM top) a
  JOIN (SELECT * FROM grown UNION ALL SELECT -1, level, spot, hash FROM top) b
    ON a.tree = b.tree AND a.level = b.level AND a.spot // 3 = b.spot // 3
  GROUP BY a.tree, a.level, a.spot),
climb AS (
  SELECT tree AS own, spot AS place, tree, 0 AS level, spot, offered AS folded, '' AS proof FROM leaves
  UNION ALL
  SELECT own, place, CASE WHEN climb.tree >= 0 AND climb.level = subroots.height THEN -1 ELSE climb.tree END,
    CASE WHEN climb.tree >= 0 AND climb.level = subroots.height THEN 0 ELSE climb.level + 1 END,
    CASE WHEN climb.tree >= 0 AND climb.level = subroots.height THEN climb.tree ELSE climb.spot // 3 END,
    CASE WHEN climb.tree >= 0 AND climb.level = subroots.height THEN folded ELSE sha256(before || folded || after) END,
    CASE WHEN climb.tree >= 0 AND climb.level = subroots.height THEN proof ELSE proof || before || after END
  FROM climb LEFT JOIN subroots ON climb.tree = subroots.tree CROSS JOIN root
  JOIN beside ON climb.tree = beside.tree AND climb.level = beside.level AND climb.spot = beside.spot
  WHERE climb.tree >= 0 OR climb.level < root.height)
SELECT doc_id, leaf, subroots.hash AS subroot, root.hash AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
  folded = root.hash AS verified
FROM climb JOIN leaves ON own = leaves.tree AND place = leaves.spot JOIN subroots ON own = subroots.tree CROSS JOIN root
WHERE climb.tree = -1 AND climb.level = root.height"""

ORACLES = {
    "op1_decontamination": _PASSAGES,
    "op9_line_dedup": _LINES,
    "op12_hard_negatives": _HARD_NEGATIVES,
    "op13_merkle_manifest": _MERKLE,
}
