import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT))
import corpus_pipeline  # noqa: E402
from cases import SCHEMA, documents, empty, items, labels  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tools.check_queries import compare, oracle_connection  # noqa: E402
from veleta.llm import sharding  # noqa: E402
from veleta.llm.queries import ORACLES, QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="given tables are not here")


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000, 4097])
def test_permutation(n):
    image = sharding.permute(np.arange(n), n, seed=4)
    assert sorted(image) == list(range(n))
    assert (sharding.permute(np.arange(n), n, seed=4) == image).all()
    if n > 50:
        assert (sharding.permute(np.arange(n), n, seed=5) != image).any()


def test_shards(spark):
    df = spark.range(1000).withColumnRenamed("id", "doc_id").repartition(7)
    placed = sharding.assign_shards(df, shards=16).collect()
    sizes = Counter(r.shard for r in placed)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(placed) == 1000
    for s in sizes:
        assert sorted(r.slot for r in placed if r.shard == s) == list(range(sizes[s]))
    image = sharding.permute(np.arange(1000), 1000)
    assert all((r.shard, r.slot) == (image[r.doc_id] % 16, image[r.doc_id] // 16) for r in placed)
    again = sharding.assign_shards(df.repartition(3), shards=16).collect()
    assert sorted(placed) == sorted(again)


def test_shard_edges(spark):
    got = sharding.assign_shards(documents(spark), shards=4)
    assert [c.lower() for c in got.columns].count("slot") == 1 and got.count() == 14
    assert sorted(r.slot * 4 + r.shard for r in got.collect()) == list(range(14))
    assert sharding.assign_shards(empty(spark)).count() == 0


@pytest.mark.parametrize("make", [documents, empty])
def test_stages_bear_everything(spark, tmp_path, make):
    labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    items(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "substring_dedup", "decontamination", "byte_bpe"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, make(spark), str(tmp_path))
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in SCHEMA]
        assert out.count() <= make(spark).count()
    assert corpus_pipeline.STAGES[-1][1](spark, make(spark), str(tmp_path)).count() == make(spark).count()


def test_near_duplicates_leave_one_of_each_group(spark, tmp_path):
    left = corpus_pipeline.near_dedup_rows(spark, documents(spark), str(tmp_path)).collect()
    assert sum(r.doc_id in (1, 2) for r in left) == 1 and sum(r.doc_id in (3, 4, 5, 6) for r in left) == 4


@given
def test_pipeline_runs_and_is_registered(spark):
    out = entry.queries()["pipeline"](spark, SF_DIR)
    assert 0 < out.count() < 200 and out.select("doc_id").distinct().count() == out.count()


@given
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), oracle_connection(SF_DIR), ORACLES[name]) is None


@given
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_are_registered_and_whole(spark, name):
    assert name in entry.queries()
    if name != "op8_containment":
        source = {"op5": "pages", "op11": "conversations"}.get(name.split("_")[0], "documents")
        rows = spark.read.parquet(f"{SF_DIR}/{source}.parquet")
        want = (rows.select("conv_id").distinct() if source == "conversations" else rows).count()
        assert QUERIES[name](spark, SF_DIR).count() == want
