from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ionloom.llm import common


class Session:
    """A session whose configuration names the given folder, or none."""

    def __init__(self, spark, found, master="local[2]"):
        self._jvm, self._jsc, self.found, self.sparkContext = spark._jvm, spark._jsc, found, self
        self.conf, self.master = self, master

    def get(self, name, default=None):
        return self.found

    def getConf(self):
        return self


def test_shared_folder_comes_from_the_session(spark, tmp_path):
    assert common.shared_dir(Session(spark, str(tmp_path))) == f"file://{tmp_path}"
    assert common.shared_dir(Session(spark, f"file://{tmp_path}/")) == f"file://{tmp_path}"
    own = common.shared_dir(Session(spark, None))
    assert own.startswith("file:///") and own == common.shared_dir(Session(spark, None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session(spark, None, "spark://host:7077"))
    assert common.shared_dir(Session(spark, f"file://{tmp_path}", "yarn")) == f"file://{tmp_path}"
    table = common.materialize(spark.range(5).withColumn("x", F.col("id") * 2), "t")
    assert table.count() == 5 and table.inputFiles()[0].startswith(common.shared_dir(spark))


def test_id_filter_never_loses_an_id(spark):
    ids = spark.range(0, 3000, 3).withColumnRenamed("id", "k")
    held = common.id_filter(ids, "k")
    rows = spark.range(3000).select(F.col("id").alias("doc"), F.lit("x").alias("text")).union(spark.createDataFrame([(None, "y")], "doc long, text string"))
    maybe = {r.doc for r in common.maybe_in(rows, "doc", held).collect()}
    surely_not = {r.doc for r in common.maybe_in(rows, "doc", held, wanted=False).collect()}
    assert set(range(0, 3000, 3)) | {None} <= maybe and not maybe & surely_not and len(maybe) + len(surely_not) == 3001
    assert len(maybe) < 1200
    empty = common.id_filter(ids.limit(0), "k")
    assert {r.doc for r in common.maybe_in(rows, "doc", empty).collect()} == {None}


def test_mix_is_a_bijection_on_samples():
    h = np.random.default_rng(1).integers(0, 2**63, 100_000, dtype=np.uint64)
    assert len(np.unique(common.mix(h))) == len(np.unique(h))


def test_free_names(spark):
    df = spark.range(1).select(F.lit(1).alias("row_"), F.lit(2).alias("ROW__"))
    assert common.free_name(df, "row_") == "row___" and common.free_name(df, "other") == "other"
