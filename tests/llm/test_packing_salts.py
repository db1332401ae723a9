from collections import defaultdict

import pytest

from sparkmine.llm import bin_slack


@pytest.mark.parametrize("per_salt", [3, 100_000])
def test_salts_follow_the_counts(spark, monkeypatch, per_salt):
    """One length with most pieces, many salts or one: every piece has its own place and sequences are gapless."""
    monkeypatch.setattr(bin_slack, "PIECES_PER_SALT", per_salt)
    cut = spark.range(500).selectExpr("id AS doc", "0 AS piece", "0L AS start", "if(id % 3 = 0, 7L + id % 4, 16L) AS length", "id % 2 AS ids_crc32")
    got = bin_slack.pack(cut, 16).collect()
    assert len(got) == 500
    held = defaultdict(list)
    for r in got:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in held.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 16
    assert len(held) == sum(n for _, n in bin_slack.bins({n: sum(r["length"] == n for r in got) for n in {r["length"] for r in got}}, 16))
