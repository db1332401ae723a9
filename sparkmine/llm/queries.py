"""The text operators over the whole test tables, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.llm import bin_slack, decontaminate, fingerprint, html_text, kd_shards, langid, pieces, probminhash, quality_fm, runs, toxicity, url_rules, variants
from sparkmine.llm.common import fold
from sparkmine.sources.tables import table


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text; profiles from the rows outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    profiles = langid.learn_profiles(docs.filter(fold("doc_id", 5) != 0))
    return docs.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), langid.predicted(F.col("text"), profiles, spark).alias("p")
    ).select("doc_id", "held_out", "p.lang_pred", "p.score")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text; learned from the labels outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0))
    scored = docs.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), toxicity.scored(F.col("text"), model, spark).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text; learned from the labels outside the held-out third."""
    docs = table(spark, sf_dir, "documents")
    machine = quality_fm.learn(docs, table(spark, sf_dir, "labels").filter(fold("doc_id", 3) != 1))
    scored = docs.select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), quality_fm.scored(F.col("text"), F.col("n_chars"), machine, spark).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every text and of its edited text."""
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    files = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken"))
    return bin_slack.packed_documents(table(spark, sf_dir, "documents"), *files, public_tokenizers.PATTERN)


# The host and path rules of the task, and plain patterns for what is left.
HOST_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]
URL_PATTERNS = [
    url_rules.Rule("session id", "block", r"[?&;](?:php)?sess(?:ion)?id=", ()),
    url_rules.Rule("tracker", "block", r"[?&]utm_source=feed(?:&|#|$)", ("utm", "source", "feed")),
    url_rules.Rule("login", "block", r"/login(?:[/?#.]|$)", ("login",)),
    url_rules.Rule("casino", "block", r"[./_-]casino[./_-]", ("casino",)),
    url_rules.Rule("archive file", "block", r"\.(?:zip|exe|tar\.gz)(?:[?#]|$)", ()),
]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    rules = [url_rules.host_rule(*r) for r in HOST_RULES] + URL_PATTERNS
    return url_rules.filter_urls(table(spark, sf_dir, "pages"), "url", rules, ["page_id"])


OP10_SQL = r"""
WITH cut AS (
  SELECT page_id, coalesce(url, '') AS url,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(verdict, host, path) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fit AS (
  SELECT p.page_id, max_by(r.host || r.path, length(r.host || r.path)) AS rule, max_by(r.verdict, length(r.host || r.path)) AS verdict
  FROM parts p JOIN rules r ON ends_with('.' || p.host, '.' || r.host) AND starts_with(p.path, r.path) GROUP BY p.page_id),
plain AS (
  SELECT page_id, CASE
    WHEN regexp_matches(url, '[?&;](?:php)?sess(?:ion)?id=') THEN 'session id'
    WHEN regexp_matches(url, '[?&]utm_source=feed(?:&|#|$)') THEN 'tracker'
    WHEN regexp_matches(url, '/login(?:[/?#.]|$)') THEN 'login'
    WHEN regexp_matches(url, '[./_-]casino[./_-]') THEN 'casino'
    WHEN regexp_matches(url, '\.(?:zip|exe|tar\.gz)(?:[?#]|$)') THEN 'archive file' END AS pattern FROM parts)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, CASE WHEN l.pattern IS NULL THEN 'allow' ELSE 'block' END) AS verdict,
       CASE WHEN f.rule IS NULL THEN l.pattern END AS pattern
FROM parts p LEFT JOIN fit f USING (page_id) LEFT JOIN plain l USING (page_id)
"""


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the class of its near copies."""
    return probminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    dims = {"doc_id": F.col("doc_id"), "n_chars": F.log1p(F.col("n_chars")), "source": F.col("source"), "lang": F.col("lang")}
    return kd_shards.kd_shards(table(spark, sf_dir, "documents"), dims)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a window alike to a benchmark item."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page."""
    return table(spark, sf_dir, "pages").select("page_id", html_text.visible_text(F.col("html")).alias("text"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every text, some of them planted, and the text without their repeats."""
    return runs.run_digests(runs.periodic_runs(table(spark, sf_dir, "documents"), edited=runs.planted))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as pieces with their byte spans, and decoded again."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.digests(pieces.encoded(table(spark, sf_dir, "documents"), model), model)


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its near words and its more frequent form."""
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


# The hash's table is made by its rule; near words come from equal words with one sign left out.
OP13_SQL = r"""
WITH RECURSIVE
bits(i, k, v) AS (
  SELECT CAST(range AS BIGINT), 0, CAST(range AS BIGINT) FROM range(256)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (
  SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS r FROM documents) GROUP BY ALL),
bytes AS (
  SELECT w, n, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w, ''), lambda c:
    CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [CAST(192 + (unicode(c) >> 6) AS BIGINT), CAST(128 + (unicode(c) & 63) AS BIGINT)] END)) AS b
  FROM runs WHERE length(w) >= 6),
hashed AS (
  SELECT w, n, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[CAST((xor(c, x) & 255) + 1 AS INTEGER)])), 4294967295) AS h FROM bytes, crc),
edited AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(w, CAST(h % length(w) AS INTEGER)) || substr(w, CAST(h % length(w) AS INTEGER) + 2) ELSE w END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM edited GROUP BY word HAVING length(word) >= 6 AND sum(n) >= 5),
less AS (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS d FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS near FROM less a JOIN less b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
  UNION SELECT l.word, w.word FROM less l JOIN words w ON l.d = w.word
  UNION SELECT w.word, l.word FROM less l JOIN words w ON l.d = w.word),
ranked AS (
  SELECT e.word, e.near, w.n AS near_n, count(*) OVER (PARTITION BY e.word) AS n_near,
         row_number() OVER (PARTITION BY e.word ORDER BY w.n DESC, encode(e.near)) AS r
  FROM near e JOIN words w ON w.word = e.near),
told AS (
  SELECT w.word, CASE WHEN r.near_n >= 5 * w.n THEN r.near END AS form, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.near_n >= 5 * w.n THEN r.near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.r = 1),
chain(word, tip) AS (SELECT word, word FROM told UNION ALL SELECT c.word, t.form FROM chain c JOIN told t ON t.word = c.tip WHERE t.form IS NOT NULL)
SELECT t.word, t.form, c.tip AS root, t.n, t.n_near, t.form_n
FROM told t JOIN chain c ON c.word = t.word JOIN told l ON l.word = c.tip AND l.form IS NULL
"""

QUERIES = {
    f.__name__: f
    for f in (
        op1_language, op2_fingerprint, op3_html_text, op4_toxicity, op5_kd_shards, op6_decontamination, op7_quality, op8_near_duplicates, op9_packing,
        op10_url_filter, op11_runs, op12_pieces, op13_variants,
    )
}
ORACLES: dict[str, str] = {"op10_url_filter": OP10_SQL, "op13_variants": OP13_SQL}
