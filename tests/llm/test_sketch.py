import numpy as np

from wayside.llm import sketch


def test_finds_every_key_seen_twice_in_any_partitions(spark, monkeypatch):
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 2**63, 60_000, dtype=np.int64)
    twice = keys[:500]
    df = spark.createDataFrame([(int(k),) for k in np.concatenate([keys, twice])], "k long").repartition(7)
    monkeypatch.setattr(sketch, "HELD", 1000)  # several packed sketches a partition
    held = sketch.repeated(df, lambda b: [b.column("k").to_numpy().view(np.uint64)], 20, 2)
    found = sketch.seen_twice(held.value, keys.view(np.uint64), 20, 2)
    assert found[:500].all()
    assert found[500:].mean() < 0.05
    new = rng.integers(0, 2**63, 10_000).astype(np.uint64)
    assert sketch.seen_twice(held.value, new, 20, 2).mean() < 0.05


def test_bits_are_bounded():
    assert sketch.bits_for(0) == sketch.MIN_BITS
    assert sketch.bits_for(1e15) == sketch.MAX_BITS
    assert 1 << sketch.bits_for(3e6) >= 3e6


def test_empty_table(spark):
    df = spark.createDataFrame([], "k long")
    held = sketch.repeated(df, lambda b: [b.column("k").to_numpy().view(np.uint64)], 20, 1)
    assert not sketch.seen_twice(held.value, np.arange(50, dtype=np.uint64), 20, 1).any()


def test_pieces_hold_all_cells():
    keys = np.arange(5000, dtype=np.uint64)
    batch = sketch._pieces(np.concatenate([keys, keys[:10]]), 22, 1)
    flags = np.zeros((2, 1 << 22), bool)
    for piece, once, two in zip(*(batch.column(i).to_pylist() for i in range(3))):
        at = slice(piece << sketch.PIECE_BITS, (piece + 1) << sketch.PIECE_BITS)
        flags[0, at] = np.unpackbits(sketch._unpack(once), bitorder="little")
        flags[1, at] = np.unpackbits(sketch._unpack(two), bitorder="little")
    cells = sketch.cells(keys, 0, 22).astype(np.int64)
    assert flags[0, cells].all() and flags[0].sum() == len(np.unique(cells))
    assert flags[1, cells[:10]].all()
