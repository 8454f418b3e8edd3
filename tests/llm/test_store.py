import os

import numpy as np
from folioforge.llm import _exchange, _store


def test_files_and_clear(spark):
    folder = _store.shared_dir(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    a = np.arange(10, dtype=np.uint64)
    _store.put(f"{folder}/a", a)
    _store.put(f"{folder}/none", a[:0])
    assert _store.mapped(f"{folder}/a", np.uint64).tolist() == a.tolist() and len(_store.mapped(f"{folder}/none", np.uint64)) == 0
    table = _store.written(spark.range(5), folder, "t")
    assert table.count() == 5 and len(os.listdir(folder.removeprefix("file://"))) == 3
    _store.clear()
    assert not os.path.exists(folder.removeprefix("file://"))


def test_blocks_round_trip():
    r = np.random.default_rng(0)
    arrays = [r.integers(0, 1 << 63, 1000).astype(np.uint64), r.integers(0, 9, 7).astype(np.uint8), np.zeros(0, np.int64), r.integers(-5, 5, 33)]
    got = _exchange.decode(_exchange.encode(*arrays))
    assert all((x == y).all() and x.dtype == y.dtype for x, y in zip(got, arrays, strict=True))
    s = np.sort(arrays[0])
    assert (np.cumsum(_exchange.deltas(s), dtype=np.uint64) == s).all()
    places = _exchange.cut(s << np.uint64(1), 7)
    assert places[0] == 0 and places[-1] == len(s) and (np.diff(places) > 80).all()
