import numpy as np

from sedimenta.llm.bits import bitmap, maybe


def test_what_is_in_the_set_is_always_found(spark):
    rng = np.random.default_rng(1)
    inside = rng.integers(-(1 << 63), (1 << 63) - 1, 3000)
    edge = np.array([-(1 << 63), -1, 0, 1, (1 << 63) - 1])
    rows = [(int(x),) for x in [*inside, *edge]]
    found = bitmap(spark.createDataFrame(rows, "x long"), "x")
    assert len(found) == 1 << 20
    assert maybe(found, np.concatenate([inside, edge])).all()
    assert maybe(found, rng.integers(-(1 << 63), (1 << 63) - 1, 20_000)).mean() < 0.01
    none = bitmap(spark.createDataFrame([], "x long"), "x")
    assert not maybe(none, inside).any()
