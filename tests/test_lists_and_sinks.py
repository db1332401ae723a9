import random
import tempfile

import pytest
from conftest import lines_df
from pyspark.sql import Observation

from sparkmine.operators import chunks
from sparkmine.operators import clustering as C
from sparkmine.operators import graph as G
from sparkmine.operators import matrix as M
from sparkmine.sources import text as io

BAD = {
    "adjacency": (io.classify_adjacency, ["1\t2,3", "7", "1\t2\t9", "x\t1", "8\t3,y", "", "  "], [None, "fields", "fields", "user", "friend"]),
    "matrix": (io.classify_tagged_matrix, ["A,1,2,3", "garbage", "x1,2", "A,1,2", "B,1,z,3", "B,1,2,z", ""], [None, "tag", "tag", "fields", "index", "value"]),
    "number": (io.classify_numbers, ["1", "z", "", " 2 "], [None, "number", None]),
    "paragraph": (io.classify_paragraphs, ["1\ta", "\tskipped", "x\ta", "2", "3\t\"a", "4\t\"ab.", ""], [None, "tab", "id", "text", "quote", None]),
}


@pytest.mark.parametrize("layout", BAD)
def test_every_line_is_a_row_or_a_reject(spark, layout):
    classify, lines, reasons = BAD[layout]
    got = classify(lines_df(spark, [*lines, None])).collect()
    assert {r["line"]: r["reason"] for r in got} == dict(zip([x for x in lines if x.strip(" ")], reasons, strict=True))
    rows, rejects = io.rows_and_rejects(classify(lines_df(spark, lines)))
    assert rows.count() == reasons.count(None) and sorted(r["reason"] for r in rejects.collect()) == sorted(x for x in reasons if x)
    assert "reason" not in rows.columns


def test_skipped_lines_are_counted(spark):
    seen = Observation()
    assert len(io.parse_tagged_matrix(lines_df(spark, BAD["matrix"][1]), rejects=seen).collect()) == 1
    assert seen.get == {"lines": 6, "rejected": 3, "skipped": 2}
    assert io.parse_adjacency(lines_df(spark, ["1\t2", "7"]), strict=True).count() == 1
    with pytest.raises(ValueError):
        io.parse_tagged_matrix(lines_df(spark, ["A,1,2"]), strict=True)


def test_chunks_laid_end_to_end_are_the_whole_list(spark):
    df = spark.range(5000).selectExpr("if(id % 3 = 0, 7, id % 11) AS k", "id % 900 AS v")
    df = df.union(spark.createDataFrame([(None, 1), (None, None), (None, 1)], df.schema))
    got = chunks.chunked_lists(df, ["k"], ["v"], size=64).collect()
    assert max(len(r["entries"]) for r in got) == 64
    joined = {}
    for r in sorted(got, key=lambda r: r["chunk"]):
        joined.setdefault(r["k"], []).extend(e["v"] for e in r["entries"])
    want = {}
    for r in df.collect():
        want.setdefault(r["k"], []).append(r["v"])
    assert joined == {k: sorted(v, key=lambda x: (x is not None, x or 0)) for k, v in want.items()}
    with pytest.raises(ValueError):
        chunks.chunked_lists(df, ["k"], ["v"], size=0)


def test_row_and_friend_chunks_equal_whole_lists(spark):
    m = spark.range(700).selectExpr("id % 3 AS i", "id AS j", "id * 2 AS v")
    whole = {r["i"]: r["entries"] for r in M.row_vectors(m).collect()}
    got = {}
    for r in M.row_vector_chunks(m, 50).orderBy("chunk").collect():
        got.setdefault(r["i"], []).extend(r["entries"])
    assert got == whole
    edges = spark.createDataFrame([(u, f, f) for u in range(12) for f in (100, 101, 102 + u % 2)], "user long, friend long, pos long")
    whole = {(r["user"], r["cand"]): r["mutual"] for r in G.mutual_friend_counts(edges, with_via=True).collect()}
    got = {}
    for r in G.mutual_friend_lists(edges, size=5).orderBy("chunk").collect():
        got.setdefault((r["user"], r["cand"]), []).extend(r["mutual"])
    assert got == whole and max(map(len, got.values())) == 12


def test_empty_tables(spark):
    none = spark.createDataFrame([], "i long, j long, v long")
    assert M.row_vector_chunks(none).count() == 0
    path = tempfile.mkdtemp(prefix="sinks-", dir="/tmp") + "/out"
    io.write_ordered_lines(spark.createDataFrame([], "value string, k long"), path, ["k"])
    assert io.read_ordered_lines(spark, path).count() == 0


def test_files_follow_the_keys(spark):
    path = tempfile.mkdtemp(prefix="sinks-", dir="/tmp") + "/out"
    df = spark.range(3000).selectExpr("concat('line ', id) AS value", "(id * 7919) % 3001 AS k").repartition(6)
    io.write_ordered_lines(df, path, ["k"])
    want = [r["value"] for r in sorted(df.collect(), key=lambda r: r["k"])]
    got = io.read_ordered_lines(spark, path).orderBy("line_no").collect()
    assert [r["value"] for r in got] == want and [r["line_no"] for r in got] == list(range(3000))


def test_a_folder_for_each_cluster(spark):
    path = tempfile.mkdtemp(prefix="sinks-", dir="/tmp") + "/out"
    assign = spark.range(1000).selectExpr("id", "CAST(if(id % 10 = 0, -1, id % 2) AS int) AS cluster")
    lines = io.format_cluster_lines(C.cluster_member_chunks(assign, 64), keep=("cluster", "chunk"))
    io.write_ordered_lines(lines, path, ["chunk"], "cluster")
    got = {}
    for r in io.read_ordered_lines(spark, path, "cluster").orderBy("cluster", "line_no").collect():
        got.setdefault(r["cluster"], []).extend(int(x) for x in r["value"].split("-> ")[1].split(", "))
    assert got == {c: [r["id"] for r in assign.where(f"cluster = {c}").orderBy("id").collect()] for c in (-1, 0, 1)}


def test_short_mutual_lists_are_grouped_where_they_lie(spark):
    """F16: every pair was sorted, numbered and stored; only those of users in very many lists need that."""
    rnd = random.Random(3)
    rows = sorted({(rnd.randrange(30), rnd.choice([1, 2, 3, *range(30)])) for _ in range(250)})
    edges = spark.createDataFrame(rows, "user long, friend long")
    lists = {u: {f for v, f in rows if v == u} - {u} for u, _ in rows}
    want = {}
    for via, own in lists.items():
        for a in own:
            for b in own:
                if a != b and (a, b) not in rows:
                    want.setdefault((a, b), []).append(via)
    for longest in (1, 9, 100):
        made = G.mutual_friend_lists(edges, size=3, longest=longest)
        got = {}
        for r in made.orderBy("chunk").collect():
            assert r.chunk * 3 == len(got.setdefault((r.user, r.cand), [])) and len(r.mutual) <= 3
            got[r.user, r.cand] += r.mutual
        assert got == {k: sorted(v) for k, v in want.items()}
    plan = made._jdf.queryExecution().analyzed().toString()
    assert "_before" not in plan
