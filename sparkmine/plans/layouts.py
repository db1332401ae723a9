"""Lines of all four text layouts, good and bad ones, as rows and counted rejects.

The lines come from the test tables, one for every row; which fault a line has follows from its row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkmine.sources import text as io
from sparkmine.sources.tables import table

# (table, expression of the line in Spark's and in DuckDB's SQL, the same text for both)
_ADJACENCY = """CASE o_orderkey % 7
  WHEN 1 THEN CAST(o_orderkey AS STRING)
  WHEN 2 THEN concat(o_orderkey, chr(9), o_custkey, chr(9), 'x')
  WHEN 3 THEN concat('u', o_orderkey, chr(9), o_custkey)
  WHEN 4 THEN concat(o_orderkey, chr(9), o_custkey, ',', o_orderpriority)
  WHEN 5 THEN ''
  ELSE concat(o_orderkey, chr(9), o_custkey, ',,', o_custkey + 1) END"""
_MATRIX = """CASE l_linenumber
  WHEN 2 THEN concat('C,', l_suppkey, ',', l_partkey, ',1')
  WHEN 3 THEN concat('A,', l_suppkey, ',', l_partkey)
  WHEN 4 THEN concat('A,', l_returnflag, ',', l_partkey, ',1')
  WHEN 5 THEN concat('B,', l_suppkey, ',', l_partkey, ',', l_linestatus)
  WHEN 6 THEN l_linestatus
  ELSE concat('B,', l_suppkey, ',', l_partkey, ',', l_linenumber) END"""
_NUMBER = "CASE o_orderstatus WHEN 'F' THEN CAST(o_custkey AS STRING) WHEN 'P' THEN '' ELSE o_orderpriority END"
_PARAGRAPH = """CASE doc_id % 7
  WHEN 1 THEN concat(chr(9), doc_id)
  WHEN 2 THEN CAST(doc_id AS STRING)
  WHEN 3 THEN concat('p', doc_id, chr(9), lang)
  WHEN 4 THEN concat(doc_id, chr(9), chr(34), 'a')
  WHEN 5 THEN ''
  ELSE concat(doc_id, chr(9), source, chr(9), lang) END"""


def rejected_lines(spark, sf_dir):
    """``(layout, outcome, n)``: lines by outcome, ``row`` or the reason of a reject; blank lines are none."""
    def lines(name, line):
        return table(spark, sf_dir, name).select(F.expr(line).alias("value"))

    parts = {
        "adjacency": io.classify_adjacency(lines("orders", _ADJACENCY)),
        "matrix": io.classify_tagged_matrix(lines("lineitem", _MATRIX)),
        "number": io.classify_numbers(lines("orders", _NUMBER)),
        "paragraph": io.classify_paragraphs(lines("documents", _PARAGRAPH)),
    }
    out = None
    for layout, classified in parts.items():
        rows, rejects = io.rows_and_rejects(classified, layout)
        outcomes = rows.select(F.lit("row").alias("outcome")).union(rejects.select("reason"))
        counts = outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n")).select(F.lit(layout).alias("layout"), "outcome", "n")
        out = counts if out is None else out.union(counts)
    return out


QUERIES = {"rejected_lines": rejected_lines}

_WHOLE = "'^[+-]?[0-9]+$'"

ORACLES = {
    "rejected_lines": f"""
WITH a AS (SELECT string_split({_ADJACENCY}, chr(9)) AS f, {_ADJACENCY} AS line FROM orders),
m AS (SELECT string_split({_MATRIX}, ',') AS f, {_MATRIX} AS line FROM lineitem),
n AS (SELECT {_NUMBER} AS line FROM orders),
p AS (SELECT string_split({_PARAGRAPH}, chr(9)) AS f, {_PARAGRAPH} AS line FROM documents),
o AS (
  SELECT 'adjacency' AS layout, CASE WHEN len(f) <> 2 THEN 'fields' WHEN NOT regexp_matches(f[1], {_WHOLE}) THEN 'user'
    WHEN len(list_filter(string_split(f[2], ','), lambda x: x <> '' AND NOT regexp_matches(x, {_WHOLE}))) > 0 THEN 'friend' ELSE 'row' END AS outcome
  FROM a WHERE line <> ''
  UNION ALL
  SELECT 'matrix', CASE WHEN f[1] NOT IN ('A', 'B') THEN 'tag' WHEN len(f) <> 4 THEN 'fields'
    WHEN NOT (regexp_matches(f[2], {_WHOLE}) AND regexp_matches(f[3], {_WHOLE})) THEN 'index' WHEN NOT regexp_matches(f[4], {_WHOLE}) THEN 'value' ELSE 'row' END
  FROM m WHERE line <> ''
  UNION ALL
  SELECT 'number', CASE WHEN regexp_matches(line, {_WHOLE}) THEN 'row' ELSE 'number' END FROM n WHERE line <> ''
  UNION ALL
  SELECT 'paragraph', CASE WHEN f[1] = '' THEN 'tab' WHEN NOT regexp_matches(f[1], {_WHOLE}) THEN 'id' WHEN len(f) < 2 OR f[2] = '' THEN 'text'
    WHEN f[2][1] = chr(34) AND length(f[2]) < 3 THEN 'quote' ELSE 'row' END
  FROM p WHERE line <> ''
)
SELECT layout, outcome, count(*) AS n FROM o GROUP BY layout, outcome
""",
}
