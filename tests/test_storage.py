from __future__ import annotations

import os

from ionloom.storage import materialize, recorded, release


def test_tables_go_when_nothing_reads_them(spark):
    with recorded() as made:
        a = materialize(spark.range(5), "a")
        with recorded() as inner:
            b = materialize(a.selectExpr("id + 1 AS id"), "b")
    assert len(made) == 2 and len(inner) == 1
    assert all(os.path.isdir(p.removeprefix("file://")) for p in made)
    assert release(spark, made, a.union(spark.range(1))) == [made[0]]
    assert not os.path.isdir(made[1].removeprefix("file://")) and a.count() == 5
    assert release(spark, made[:1], spark.range(1)) == []
    assert not os.path.isdir(made[0].removeprefix("file://"))
    assert b.schema == a.schema
