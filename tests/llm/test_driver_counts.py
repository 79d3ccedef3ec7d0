"""Counts and sums reach the driver as packed bytes, not as tables."""

import numpy as np

from growthledger.llm.common import counts_of
from growthledger.llm.decontaminate import FEATURES, group_axes, rarities
from growthledger.llm.ngram_join import cell_frequencies


def test_counts_and_axes_without_pandas_on_the_driver(spark, monkeypatch):
    docs = spark.createDataFrame([("a b c d",), ("a b c e",), ("",), (None,)], "text string")

    def refused(self):
        raise AssertionError("a table on the driver")

    monkeypatch.setattr(type(docs), "toPandas", refused)
    rows = spark.createDataFrame([(1, 5), (7, 2), (3, 1)], "place long, n long").repartition(3)
    assert counts_of(rows, 9).tolist() == [0, 5, 0, 1, 0, 0, 0, 2, 0]
    assert counts_of(rows.limit(0), 3).tolist() == [0, 0, 0]
    cells = cell_frequencies(docs, 3)
    assert cells.sum() == 4 and cells.max() == 2
    rarity = rarities(docs)
    assert len(rarity) == FEATURES and rarity.min() > 0
    words = [np.arange(k, k + 6, dtype=np.uint64).tobytes() for k in range(4)]
    passages = spark.createDataFrame([(k % 2, bytearray(w)) for k, w in enumerate(words)], "`group` long, words binary")
    axes = group_axes(passages.repartition(2), rarity)
    assert sorted(axes) == [0, 1] and all(len(used) == len(rows) for used, rows in axes.values())
    assert all((np.diff(used) > 0).all() for used, _ in axes.values())
