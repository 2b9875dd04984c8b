"""Licence notices that a source repeats or wraps."""

from __future__ import annotations

from greenledger.llm import licences

FILL = "thnt erin ouat the and\nof thand erin"
SCHEMA = "doc_id long, text string"


def found(spark, rows):
    return {r.doc_id: tuple(r)[1:] for r in licences.licences(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_a_repeated_partial_notice_hides_no_licence(spark):
    hot = "\n".join(["Permission is hereby granted, free of charge, to any person", "All rights reserved.", FILL] * 5)
    rows = [(k, f"{FILL} {k}\nordinary line {k}\n{hot if k % 3 == 0 else FILL}") for k in range(60)]
    whole = licences.TEMPLATES["MIT"][2]
    rows += [(100, f"{FILL}\n{whole}"), (101, f"{FILL}\n{licences.TEMPLATES['Proprietary'][0]}")]
    got = found(spark, rows)
    assert got[100] == (1, 0, "MIT") and got[101] == (1, 0, "Proprietary")
    assert all(got[k][0] + got[k][1] >= 5 for k in range(0, 60, 3))
    assert all(got[k] == (0, 0, "") for k in range(60) if k % 3)
