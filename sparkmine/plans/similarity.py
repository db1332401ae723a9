"""Paragraph-similarity queries on ``documents`` (whole texts, every document)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sparkmine.operators import clustering as C
from sparkmine.operators import lsh as LSH
from sparkmine.operators import shingles as S
from sparkmine.operators import similarity as SIM
from sparkmine.sources import text as io
from sparkmine.session import materialize
from sparkmine.sources.tables import table

MAX_D = SIM.DEFAULT_MAX_DISTANCE
NEAR_D = 0.2  # near-duplicate bound: short prefixes, cheap at any scale
TOP = SIM.TOP_PAIRS
SQL_TOP = 15


def paragraphs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("para"))


def paragraph_lines(spark, sf_dir):
    """``id \\t text`` lines; French paragraphs arrive quoted (``"text".``)."""
    d = table(spark, sf_dir, "documents")
    txt = F.when(F.col("lang") == "fr", F.concat(F.lit('"'), F.col("text"), F.lit('".'))).otherwise(F.col("text"))
    return d.select(F.concat_ws("\t", F.col("doc_id").cast("string"), txt).alias("value"))


def paragraph_parse(spark, sf_dir):
    return io.parse_paragraphs(paragraph_lines(spark, sf_dir))


def shingles(spark, sf_dir):
    return S.shingle_rows(paragraphs(spark, sf_dir))


def shingle_vocabulary(spark, sf_dir):
    return S.vocabulary(S.shingle_sets(paragraphs(spark, sf_dir)))


def paragraph_sets(spark, sf_dir):
    return S.shingle_sets(paragraphs(spark, sf_dir)).select("id", "n_shingles", "size")


def _pairs(spark, sf_dir):
    return SIM.text_jaccard_pairs(paragraphs(spark, sf_dir), MAX_D)


def exact_jaccard_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir)


def near_duplicate_pairs(spark, sf_dir):
    return SIM.text_jaccard_pairs(paragraphs(spark, sf_dir), NEAR_D)


def similarity_edges(spark, sf_dir):
    return SIM.similarity_edges(_pairs(spark, sf_dir))


def closest_pairs(spark, sf_dir):
    """Top-5 closest of all pairs sharing a shingle (exact, adaptive bound)."""
    return SIM.text_closest_pairs(paragraphs(spark, sf_dir), TOP)


def closest_pairs_sql(spark, sf_dir):
    """The SQL form: a temp view of the closest pairs, top 15 by distance."""
    SIM.text_closest_pairs(paragraphs(spark, sf_dir), SQL_TOP).createOrReplaceTempView("similar_pairs")
    return spark.sql(
        "SELECT idA, idB, distance FROM similar_pairs WHERE idA <> idB ORDER BY distance ASC, idA, idB LIMIT 15"
    )


def shared_shingle_evidence(spark, sf_dir):
    top = SIM.text_closest_pairs(paragraphs(spark, sf_dir), TOP)
    return SIM.shared_shingle_evidence(top, paragraphs(spark, sf_dir))


def evidence_lines(spark, sf_dir):
    return io.through_files(io.format_evidence(shared_shingle_evidence(spark, sf_dir)), "evidence")


def shingle_vocabulary_size(spark, sf_dir):
    return S.vocabulary_size(S.shingle_sets(paragraphs(spark, sf_dir)))


def paragraph_shingles(spark, sf_dir):
    """The (paragraph, shingle) rows behind the sparse binary vectors."""
    return S.set_rows(S.shingle_sets(paragraphs(spark, sf_dir)))


def paragraph_file_roundtrip(spark, sf_dir):
    """Whole texts, line breaks and tabs included, through text files in the shared folder."""
    return io.parse_paragraphs(io.through_files(io.format_paragraphs(paragraphs(spark, sf_dir), escape=True)), escaped=True)


def minhash_pairs(spark, sf_dir):
    """LSH near-duplicate pairs (banded MinHash, exact distances, approximate recall)."""
    docs = paragraphs(spark, sf_dir)
    return SIM.minhash_pairs(S.shingle_sets(docs), NEAR_D, num_tables=SIM.NEAR_DUP_BANDS * SIM.NEAR_DUP_ROWS,
                             band_rows=SIM.NEAR_DUP_ROWS, texts=docs)


def pic_clusters(spark, sf_dir):
    """Power iteration clustering of the whole similarity graph at 0.6, a row for every paragraph."""
    docs = paragraphs(spark, sf_dir)
    rep_pairs, members = SIM.rep_jaccard_pairs(S.text_tokens(docs), MAX_D, docs)
    return C.with_isolated(C.power_clusters(materialize(rep_pairs, "rep-pairs"), members), docs)


def shingle_ids(spark, sf_dir):
    return S.shingle_ids(S.vocabulary(S.shingle_sets(paragraphs(spark, sf_dir))))


def paragraph_vectors(spark, sf_dir):
    """Every paragraph's binary vector over the numbered vocabulary, as a line of ascending numbers."""
    docs = paragraphs(spark, sf_dir)
    sets = S.shingle_sets(docs).select("id", "shingles")
    rows = S.id_vectors(sets, S.shingle_ids(S.vocabulary(sets)), docs)
    return rows.select("id", "size", F.concat_ws(",", F.transform("sids", lambda x: x.cast("string"))).alias("sids"))


def minhash_signatures(spark, sf_dir):
    """25 MinHash values of every paragraph."""
    return LSH.text_signatures(paragraphs(spark, sf_dir), SIM.NUM_HASH_TABLES).select("id", F.concat_ws(",", F.transform("hashes", lambda x: x.cast("string"))).alias("hashes"))


def incremental_band_pairs(spark, sf_dir):
    """Pairs of an old and a new paragraph (even and odd ids) that share one of 8 bands of 3 values, by the stored index."""
    docs = paragraphs(spark, sf_dir)
    index = LSH.BandIndex(spark, f"bands_{uuid.uuid4().hex}", SIM.NEAR_DUP_BANDS * SIM.NEAR_DUP_ROWS, SIM.NEAR_DUP_ROWS)
    index.add(docs.where("id % 2 = 0"))
    pairs = index.probe(docs.where("id % 2 <> 0"))
    index.drop()  # its name; the files that the pairs are found in stay until ``release``
    return pairs


def cluster_lines(spark, sf_dir):
    return io.format_cluster_lines(C.cluster_member_lists(pic_clusters(spark, sf_dir)))


IDS_PER_LINE = 100


def cluster_files(spark, sf_dir):
    """Cluster lines in a folder for each cluster, ordered by member, read back with their line numbers."""
    chunks = C.cluster_member_chunks(pic_clusters(spark, sf_dir), IDS_PER_LINE)
    return io.through_ordered_files(io.format_cluster_lines(chunks, keep=("cluster", "chunk")), "clusters", ["chunk"], "cluster")


def evidence_written(spark, sf_dir):
    """Evidence lines in ordered files, a blank line after each pair, read back with line numbers."""
    return io.through_ordered_files(io.evidence_with_blanks(shared_shingle_evidence(spark, sf_dir)), "evidence", ["idA", "idB", "last", "offA"])


# --- oracles -----------------------------------------------------------------------------

_LINES = """SELECT CAST(doc_id AS VARCHAR) || chr(9) || CASE WHEN lang = 'fr' THEN '"' || text || '".' ELSE text END AS value FROM documents"""

_PARSE = f"""
WITH l AS ({_LINES}),
f AS (SELECT split_part(value, chr(9), 1) AS f0, split_part(value, chr(9), 2) AS f1 FROM l
      WHERE length(value) > 0 AND NOT starts_with(value, chr(9)))
SELECT TRY_CAST(f0 AS BIGINT) AS id,
       CASE WHEN left(f1, 1) IN ('"', chr(65533)) THEN substring(f1, 2, length(f1) - 3) ELSE f1 END AS para
FROM f WHERE TRY_CAST(f0 AS BIGINT) IS NOT NULL AND length(f1) > 0
"""

# Shingles by a per-document window over characters (linear; no substring by index).
_SH = """
WITH ch AS (SELECT doc_id AS id, unnest(string_split(text, '')) AS c, generate_subscripts(string_split(text, ''), 1) AS pos
            FROM documents),
w5 AS (SELECT id, CAST(pos - 1 AS INTEGER) AS off,
              c || lead(c, 1) OVER w || lead(c, 2) OVER w || lead(c, 3) OVER w || lead(c, 4) OVER w AS shingle,
              lead(c, 5) OVER w AS nxt
       FROM ch WINDOW w AS (PARTITION BY id ORDER BY pos))
SELECT id, off, shingle FROM w5 WHERE nxt IS NOT NULL
"""

_SETS = f"SELECT DISTINCT id, shingle FROM ({_SH})"

# Brute force: every pair sharing a shingle (inverted index), exact counts.
_PAIRS = f"""
WITH s AS ({_SETS}),
sz AS (SELECT id, count(*) AS n FROM s GROUP BY id),
inter AS (SELECT a.id AS idA, b.id AS idB, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.id < b.id GROUP BY 1, 2),
d AS (SELECT i.idA, i.idB, 1.0 - CAST(i.c AS DOUBLE) / CAST(x.n + y.n - i.c AS DOUBLE) AS distance
      FROM inter i JOIN sz x ON x.id = i.idA JOIN sz y ON y.id = i.idB)
SELECT idA, idB, distance FROM d WHERE distance < {MAX_D}
"""

def _pairs_sql(bound: float) -> str:
    return _PAIRS.replace(f"WHERE distance < {MAX_D}", f"WHERE distance < {bound}")


# every pair that shares a shingle
_ALL = _pairs_sql(1.0)
_TOP = f"SELECT * FROM ({_ALL}) ORDER BY distance, idA, idB LIMIT {TOP}"

_EVIDENCE = f"""
WITH t AS ({_TOP}),
f AS (SELECT id, shingle, min(off) AS off FROM ({_SH}) WHERE id IN (SELECT idA FROM t UNION SELECT idB FROM t) GROUP BY id, shingle)
SELECT t.idA, t.idB, a.shingle, a.off AS offA, b.off AS offB
FROM t JOIN f a ON a.id = t.idA JOIN f b ON b.id = t.idB AND b.shingle = a.shingle
"""



def _signatures_sql(tables: int) -> str:
    least = ", ".join(f"min(((x + 1) * {a} + {b}) % {LSH.PRIME})" for a, b in LSH.coefficients(tables))
    return f"SELECT id, [{least}] AS hashes FROM (SELECT id, CAST('0x' || left(md5(shingle), 8) AS BIGINT) AS x FROM ({_SETS})) GROUP BY id"


def _clusters_sql(rounds: int) -> str:
    """The same vector paragraph by paragraph (no contracted copies), its rounds written out, and every cut compared."""
    one = C.MEAN_ONE
    parts = [f"""pairs AS MATERIALIZED ({_PAIRS}),
e AS MATERIALIZED (SELECT idA AS a, idB AS b, CAST(round((1.0 - distance) * {C.WEIGHT_ONE}) AS HUGEINT) AS w FROM pairs
      UNION ALL SELECT idB, idA, CAST(round((1.0 - distance) * {C.WEIGHT_ONE}) AS HUGEINT) FROM pairs),
deg AS MATERIALIZED (SELECT a AS id, CAST(sum(w) AS HUGEINT) AS d FROM e GROUP BY a),
v0 AS MATERIALIZED (SELECT id, d * ({one} * (SELECT count(*) FROM deg)::HUGEINT) // (SELECT sum(d)::HUGEINT FROM deg) AS v FROM deg)"""]
    for r in range(rounds):
        parts.append(f"""u{r} AS MATERIALIZED (SELECT e.a AS id, CAST(sum(e.w * v.v) AS HUGEINT) // any_value(deg.d) AS u
  FROM e JOIN v{r} v ON v.id = e.b JOIN deg ON deg.id = e.a GROUP BY e.a),
v{r + 1} AS MATERIALIZED (SELECT id, u * ({one} * (SELECT count(*) FROM u{r})::HUGEINT) // (SELECT sum(u)::HUGEINT FROM u{r}) AS v FROM u{r})""")
    return f"""WITH {", ".join(parts)},
x AS MATERIALIZED (SELECT id, CAST(v // 1000 AS BIGINT) AS x FROM v{rounds}),
c AS (SELECT x, sum(count(*)) OVER (ORDER BY x) AS n1, sum(sum(x)) OVER (ORDER BY x) AS s1 FROM x GROUP BY x),
t AS (SELECT count(*) AS nn, sum(x) AS ss FROM x),
cut AS (SELECT x, CAST(s1 AS DOUBLE) * CAST(s1 AS DOUBLE) / CAST(n1 AS DOUBLE)
          + (CAST(ss AS DOUBLE) - CAST(s1 AS DOUBLE)) * (CAST(ss AS DOUBLE) - CAST(s1 AS DOUBLE)) / (CAST(nn AS DOUBLE) - CAST(n1 AS DOUBLE)) AS between_
        FROM c, t WHERE n1 < nn),
best AS (SELECT coalesce((SELECT x FROM cut ORDER BY between_ DESC, x LIMIT 1), (SELECT max(x) FROM x), 0) AS at)
SELECT d.doc_id AS id, coalesce(CAST(x.x > best.at AS INTEGER), {C.ISOLATED}) AS cluster FROM documents d CROSS JOIN best LEFT JOIN x ON x.id = d.doc_id"""


_CLUSTERS = _clusters_sql(C.DEFAULT_MAX_ITER)

QUERIES = {
    "paragraph_parse": paragraph_parse,
    "shingles": shingles,
    "shingle_vocabulary": shingle_vocabulary,
    "paragraph_sets": paragraph_sets,
    "exact_jaccard_pairs": exact_jaccard_pairs,
    "near_duplicate_pairs": near_duplicate_pairs,
    "similarity_edges": similarity_edges,
    "closest_pairs": closest_pairs,
    "closest_pairs_sql": closest_pairs_sql,
    "shared_shingle_evidence": shared_shingle_evidence,
    "evidence_lines": evidence_lines,
    "shingle_vocabulary_size": shingle_vocabulary_size,
    "paragraph_shingles": paragraph_shingles,
    "paragraph_file_roundtrip": paragraph_file_roundtrip,
    "minhash_pairs": minhash_pairs,
    "pic_clusters": pic_clusters,
    "cluster_lines": cluster_lines,
    "cluster_files": cluster_files,
    "evidence_written": evidence_written,
    "shingle_ids": shingle_ids,
    "paragraph_vectors": paragraph_vectors,
    "minhash_signatures": minhash_signatures,
    "incremental_band_pairs": incremental_band_pairs,
}

ORACLES = {
    "paragraph_parse": _PARSE,
    "shingles": _SH,
    "shingle_vocabulary": f"SELECT shingle, count(*) AS n_docs FROM ({_SETS}) GROUP BY shingle",
    "paragraph_sets": f"SELECT id, count(*) AS n_shingles, count(DISTINCT shingle) AS size FROM ({_SH}) GROUP BY id",
    "exact_jaccard_pairs": _PAIRS,
    "near_duplicate_pairs": _pairs_sql(NEAR_D),
    "similarity_edges": f"SELECT idA AS src, idB AS dst, 1.0 - distance AS similarity FROM ({_PAIRS})",
    "closest_pairs": _TOP,
    "closest_pairs_sql": f"SELECT * FROM ({_ALL}) WHERE idA <> idB ORDER BY distance, idA, idB LIMIT {SQL_TOP}",
    "shared_shingle_evidence": _EVIDENCE,
    "evidence_lines": (
        "SELECT '<' || idA || ' - ' || idB || '> ' || "
        "replace(replace(replace(replace(shingle, chr(92), chr(92) || 's'), chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r'), chr(9), chr(92) || 't')"
        f" || ' <' || offA || ' - ' || offB || '> ' AS value FROM ({_EVIDENCE})"
    ),
    "shingle_vocabulary_size": f"SELECT count(DISTINCT shingle) AS n_shingles FROM ({_SETS})",
    "paragraph_shingles": _SETS,
    "paragraph_file_roundtrip": """
SELECT doc_id AS id, CASE WHEN left(text, 1) IN ('"', chr(65533)) THEN substring(text, 2, length(text) - 3) ELSE text END AS para
FROM documents WHERE length(text) > 0""",
    "shingle_ids": f"SELECT shingle, row_number() OVER (ORDER BY shingle) - 1 AS sid FROM (SELECT DISTINCT shingle FROM ({_SETS}))",
    "paragraph_vectors": f"""
WITH s AS ({_SETS}), v AS (SELECT shingle, row_number() OVER (ORDER BY shingle) - 1 AS sid FROM (SELECT DISTINCT shingle FROM s))
SELECT id, CAST(count(*) AS INTEGER) AS size, string_agg(CAST(sid AS VARCHAR), ',' ORDER BY sid) AS sids FROM s JOIN v USING (shingle) GROUP BY id""",
    "minhash_signatures": f"SELECT id, list_aggregate(hashes, 'string_agg', ',') AS hashes FROM ({_signatures_sql(SIM.NUM_HASH_TABLES)})",
    "incremental_band_pairs": f"""
WITH g AS ({_signatures_sql(SIM.NEAR_DUP_BANDS * SIM.NEAR_DUP_ROWS)}),
b AS (SELECT id, t AS band, hashes[t * {SIM.NEAR_DUP_ROWS} + 1 : (t + 1) * {SIM.NEAR_DUP_ROWS}] AS key FROM g, range({SIM.NEAR_DUP_BANDS}) r(t))
SELECT DISTINCT o.id AS old, n.id AS new FROM b o JOIN b n ON o.band = n.band AND o.key = n.key WHERE o.id % 2 = 0 AND n.id % 2 <> 0""",
    "pic_clusters": _CLUSTERS,
    "cluster_lines": f"""
SELECT 'Book ' || cluster || '-> ' || string_agg(CAST(id AS VARCHAR), ', ' ORDER BY id) AS value
FROM ({_CLUSTERS}) GROUP BY cluster, id // {C.IDS_PER_LINE_RANGE}""",
    "cluster_files": f"""
WITH c AS (SELECT cluster, id, (row_number() OVER (PARTITION BY cluster ORDER BY id) - 1) // {IDS_PER_LINE} AS line_no FROM ({_CLUSTERS}))
SELECT cluster, CAST(line_no AS BIGINT) AS line_no, 'Book ' || cluster || '-> ' || string_agg(CAST(id AS VARCHAR), ', ' ORDER BY id) AS value
FROM c GROUP BY cluster, line_no""",
    "evidence_written": f"""
WITH ev AS ({_EVIDENCE}),
l AS (SELECT idA, idB, 0 AS last, offA, '<' || idA || ' - ' || idB || '> ' ||
        replace(replace(replace(replace(shingle, chr(92), chr(92) || 's'), chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r'), chr(9), chr(92) || 't')
        || ' <' || offA || ' - ' || offB || '> ' AS value FROM ev
      UNION ALL SELECT DISTINCT idA, idB, 1, NULL, '' FROM ev)
SELECT row_number() OVER (ORDER BY idA, idB, last, offA) - 1 AS line_no, value FROM l""",
    # minhash_pairs: recall is approximate -> rows-only check
}
