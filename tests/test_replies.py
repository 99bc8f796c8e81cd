"""JSON salvage, page differences, policies and Markdown structure."""

import json

import pytest
from pyspark.sql import functions as F

from folioscan.functions import markdown as M
from folioscan.functions import replies as R

PACKET = {"claims": [{"claim": "x"}]}


@pytest.mark.parametrize(
    ("reply", "want"),
    [
        (json.dumps(PACKET), PACKET),
        ("said:\n```json\n" + json.dumps(PACKET) + "\n```\nend", PACKET),
        ('see [1] and {"a": 2} then {"claims": [{"claim": "wrapped\n   line"}]} bye', {"claims": [{"claim": "wrapped line"}]}),
        ("[1, 2]", [1, 2]),
        ("nothing {here", None),
        (None, None),
    ],
)
def test_packets(reply, want):
    assert R.packet_json(reply) == want


def test_other_replies(spark):
    assert R.repair_json('I think {"x": 1} {"found": true, "excerpt": "e"} so') == {"found": True, "excerpt": "e"}
    assert R.repair_json("[]") is None
    assert R.worker_json('```json\nnote {"claims": []}\n```') == {"claims": []}
    df = spark.createDataFrame([('x {"found": false}', "a\nb\n", "a\nc\n")], "r string, a string, b string")
    row = df.select(R.repairs(F.col("r")).alias("r"), R.packets(F.col("r")).alias("p"), R.unified_diff(F.col("a"), F.col("b"), F.lit("p.md")).alias("d")).first()
    assert (row.r, row.p) == ('{"found": false}', None)
    assert row.d == "--- before/p.md\n+++ after/p.md\n@@ -1,2 +1,2 @@\n a\n-b\n+c\n"


def test_policies():
    assert R.policy_errors({"a": 1, "b": 2}, ("a", "b")) == []
    assert R.policy_errors({"a": True, "c": 2}, ("a", "b")) == ["missing b", "unknown c", "a must be a positive integer"]
    assert R.layered({"x": {"a": 1, "b": 1}}, None, {"x": {"b": 2}, "y": 3}) == {"x": {"a": 1, "b": 2}, "y": 3}
    fields = ("a", "b", "c", "d", "e")
    assert R.missing_fields({"a": 1, "b": 1, "reading": {}}, fields) == [] and R.missing_fields({"a": 1}, fields) == ["b", "c", "d", "e"]


def test_structure(spark):
    text = "---\nt: x\n---\n# One\npara\nmore\n\n```\n# not\n\n```\n$$\nx\n\n$$\n## Two\n[^n]: note\n| a |\n| b |\n"
    headings, cuts, definitions = M.structure(text)
    assert headings == [3, 15] and definitions == [("^N", 16)]
    assert cuts == [0, 3, 4, 6, 7, 11, 15, 16, 19, 20]
    row = spark.createDataFrame([(text,), (None,)], "t string").select(M.structures(F.col("t")).alias("s")).collect()
    assert row[0].s.headings == headings and row[0].s.cuts == cuts and row[1].s.cuts == [0, 1]
