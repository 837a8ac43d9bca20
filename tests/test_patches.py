"""Patch encoding: batches that halve, background and absent patches."""

from __future__ import annotations

import numpy as np
import pytest

from lattica.operators import ml


def test_batches_halve_until_they_fit():
    sizes = []

    def run(x):
        sizes.append(len(x))
        if len(x) > 3:
            raise MemoryError
        return x * 2

    x = np.arange(20.0).reshape(10, 2)
    out, held = ml.halved_batches(run, x, 8)
    assert (out == 2 * x).all() and held == 2 and sizes == [8, 4, 2, 2, 2, 2, 2]
    with pytest.raises(MemoryError):
        ml.halved_batches(lambda x: (_ for _ in ()).throw(MemoryError()), x, 4)
    assert ml.halved_batches(run, x[:0], 4)[0].shape == (0, 0)


def test_background_is_zero_and_absent_patches_have_no_row(spark):
    rows = [(1, 0, 0, x, y, 0.0) for x in range(2) for y in range(2)] + [(2, 4, 4, 5, 4, 7.0), (2, 4, 4, 4, 5, 1.0)]
    cut = spark.createDataFrame(rows, "patch_id long, px int, py int, x int, y int, v double")
    got = {r.patch_id: (r.background, r.embedding) for r in ml.encode_grid(cut, ["v"], 2, lambda: lambda x: x, 4, batch=3, colour=[0.0]).collect()}
    assert got == {1: (True, [0.0] * 4), 2: (False, [0.0, 7.0, 1.0, 0.0])}
    every = {r.patch_id: r.embedding for r in ml.encode_grid(cut, ["v"], 2, lambda: lambda x: x + 1, 4).collect()}
    assert every == {1: [1.0] * 4, 2: [1.0, 8.0, 2.0, 1.0]}
    assert ml.encode_grid(cut.limit(0), ["v"], 2, lambda: lambda x: x, 4, colour=[0.0]).count() == 0
