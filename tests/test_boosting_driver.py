"""What one pass of the boosting sends to the driver does not grow with the table's partitions."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwise.operators import boosting as B


def test_the_driver_gets_one_array_a_pass(spark, monkeypatch):
    rows = spark.range(9000).select(F.col("id").alias("row"), (F.col("id") % 2).cast("double").alias("label"), F.col("id").cast("double").alias("x"),
                                    F.array(F.lit(B.TRAIN)).alias("roles"))
    monkeypatch.setattr(B, "ROWS", 1000)
    monkeypatch.setattr(B, "PART", 64)
    table = B.binned(rows, B.Bins({"x": [100.0, 4000.0]}, {}), "roles", 1, "row", "label")
    assert 2 < table.parts <= 16
    kind, sent = type(rows), []
    inner = kind.collect

    def collect(self):
        got = inner(self)
        if self.columns == ["part", "sums"]:
            sent.append(sum(len(r["sums"]) for r in got))
        return got
    monkeypatch.setattr(kind, "collect", collect)
    size = 300

    def task(batches):
        out = np.zeros(size, np.int64)
        for batch in batches:
            np.add.at(out, batch.column(0).to_numpy() % size, 1)
        return out
    assert (table.summed(task, size) == 9000 // size).all()
    assert sent == [8 * size] and issubclass(kind, DataFrame)
