"""Text sinks written to files and read back (round trips through the layouts)."""

import tempfile

from conftest import lines_df

from sparkmine.operators import graph as G
from sparkmine.operators import matrix as M
from sparkmine.sources import text as io


def _dir():
    return tempfile.mkdtemp(prefix="sinks-", dir="/tmp") + "/out"


def test_recommendation_file_roundtrip(spark):
    src = ["0\t1,2,3", "1\t0,2,3,4,5", "2\t0,1,4", "3\t0,1,4", "4\t1,2,3", "5\t1,6", "6\t5"]
    path = _dir()
    io.write_lines(lines_df(spark, src), path)
    edges = G.adjacency_to_edges(io.read_adjacency(spark, path))
    out = _dir()
    io.write_lines(io.format_recommendations(G.recommend_lists(edges)), out)
    got = dict(line.split("\t") for line in (r["value"] for r in io.read_lines(spark, out).collect()))
    assert got["5"] == "0,2,3,4" and got["0"] == "4,5"


def test_matrix_file_roundtrip(spark):
    a = spark.createDataFrame([(0, 0, 2), (0, 1, 3), (1, 0, 4), (1, 1, 5)], "i long, j long, v long")
    b = spark.createDataFrame([(0, 0, 1), (0, 1, 7), (1, 0, 3), (1, 1, 9)], "i long, j long, v long")
    path = _dir()
    io.write_lines(io.format_tagged_matrix(a, b), path)
    pa, pb = M.split_tagged(io.parse_tagged_matrix(io.read_lines(spark, path)))
    out = _dir()
    io.write_lines(io.format_matrix_cells(M.sorted_cells(M.matmul(pa, pb))).coalesce(1), out)
    assert [r["value"] for r in io.read_lines(spark, out).collect()] == ["0,0,11", "0,1,41", "1,0,19", "1,1,73"]


def test_paragraph_file_roundtrip(spark):
    path = _dir()
    io.write_lines(lines_df(spark, ["1\tsome text here", '2\t"quoted one".', "", "\tskipped"]), path)
    got = {r["id"]: r["para"] for r in io.read_paragraphs(spark, path).collect()}
    assert got == {1: "some text here", 2: "quoted one"}
