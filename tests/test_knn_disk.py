"""Blocks compared in several passes: the same neighbours, and no tables left that nothing reads."""

from pathlib import Path

import numpy as np
import pytest

from docsignal.operators import knn
from docsignal.session import checkpoint_root, discard, materialize


def left_in(spark):
    return set(Path(checkpoint_root(spark).removeprefix("file:")).glob("knn-*"))


@pytest.mark.parametrize("blocks,p", [({0: 9, 1: 2}, 2.0), ({0: 12, 1: 10}, 1.0), ({0: 3, 1: 1}, 2.0)])
def test_all_pairs_of_blocks_meet_and_spent_tables_go(spark, monkeypatch, blocks, p):
    monkeypatch.setattr(knn, "_by_blocks_is_cheaper", lambda *_: True)
    monkeypatch.setattr(knn, "_block_counts", lambda counts, width: blocks)
    before = left_in(spark)
    x = np.random.default_rng(3).normal(size=(240, 4))
    rows = [(i, i % 2, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "doc_id int, g int, features array<double>")
    found = knn.knn_distances(df, 7, p=p, group="g", chunk_rows=16).collect()
    left = {folder.name.rsplit("-", 1)[0] for folder in left_in(spark) - before}
    assert len(found) == 240
    for r in found:
        same = x[r.g :: 2]
        far = (np.abs(same - x[r.doc_id]) ** p).sum(1) ** (1 / p)
        np.testing.assert_allclose(r.distances, np.sort(far)[1:8], rtol=1e-9)
    assert left == ({"knn-best"} if max(blocks.values()) > 8 else {"knn-blocks"})


def test_only_written_tables_are_discarded(spark, tmp_path):
    written = materialize(spark.range(5), "to-go")
    folder = Path(written.inputFiles()[0].removeprefix("file:")).parent
    assert folder.exists()
    discard(written)
    assert not folder.exists()
    spark.range(5).write.parquet(str(tmp_path / "kept"))
    with pytest.raises(ValueError):
        discard(spark.read.parquet(str(tmp_path / "kept")))
    assert spark.read.parquet(str(tmp_path / "kept")).count() == 5
