import pytest

from loomgraph.operators.components import connected_components


def test_components_settle_or_fail(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(40)], "u long, v long")
    with pytest.raises(RuntimeError, match="1 rounds"):
        connected_components(path, max_rounds=1)
    assert sorted(map(tuple, connected_components(path).collect())) == [(i, 0) for i in range(41)]
    assert connected_components(path.where("false"), max_rounds=0).count() == 0
