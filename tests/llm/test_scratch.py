import types

import pytest

from panelwright.llm import scratch


def session(master, folder=None):
    return types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda key, default=None: folder), sparkContext=types.SimpleNamespace(master=master))


def test_a_cluster_has_to_name_its_shared_folder():
    assert scratch.scratch_root(session("spark://host:7077", "hdfs://shared/x/")) == "hdfs://shared/x"
    assert scratch.scratch_root(session("local[8]")) == scratch.scratch_root(session("local")) == scratch.LOCAL_CHECKPOINTS
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,3000]", "k8s://https://host"):
        with pytest.raises(ValueError, match="share"):
            scratch.scratch_root(session(master))


def test_tables_go_when_they_are_discarded(spark, tmp_path):
    import os

    table = scratch.materialise(spark.range(5), "numbers")
    assert table.count() == 5 and os.path.isdir(table._scratch_path)
    scratch.discard(table)
    assert not os.path.exists(table._scratch_path)
    empty = scratch.materialise(spark.range(5).where("id < 0"), "numbers")
    assert empty.count() == 0 and empty.columns == ["id"]


def test_near_duplicates_leave_few_tables(spark):
    """Rounds delete what they wrote: what is left doesn't grow with them."""
    import os
    import random

    from panelwright.llm.near_dup import near_duplicates

    r = random.Random(3)
    base = ["".join(r.choices("abcdef", k=5)) for _ in range(60)]
    rows = [(i, " ".join(w if r.random() > 0.03 * (i % 4) else f"x{i}" for w in base)) for i in range(80)]
    before = len(os.listdir(scratch.scratch_root(spark)))
    assert near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).count() == 80
    assert len(os.listdir(scratch.scratch_root(spark))) - before <= 14
