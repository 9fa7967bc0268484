"""The stages one by one over a small folder, each on what its predecessor kept."""

import random

import __spark_entry__ as entry
import corpus_pipeline
import pytest

from strata.session import scratch_path


@pytest.fixture(scope="module")
def folder(spark):
    draw = random.Random(11)
    fresh = lambda n: [f"w{draw.randrange(5000)}" for _ in range(n)]
    texts = [" ".join(fresh(80)) for _ in range(200)]
    for i in range(0, 200, 4):
        texts[i] += " vile nasty"
    item = " ".join(fresh(12))
    texts[1] += " " + item.upper()
    texts[3] += " mail a@b.co"
    texts[5] = texts[7] = texts[6] + " tail"
    root = scratch_path(spark, "folder")
    rows = [(i, t, "en", f"src{i % 2}", len(t)) for i, t in enumerate(texts)] + [(200, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root, texts


def test_each_stage_takes_effect(spark, folder):
    root, texts = folder
    docs = spark.read.parquet(f"{root}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, root)
        path = scratch_path(spark, "step")
        out.write.parquet(path)
        if (name, stage) != corpus_pipeline.STAGES[-1]:
            assert out.columns == docs.columns
        docs = spark.read.parquet(path)
        kept.append({r.doc_id: r for r in docs.collect()})
    toxic = set(range(0, 200, 4))
    assert set(kept[0]) == set(range(201)) - toxic
    assert set(kept[1]) == set(kept[0]) - {6, 7}
    assert set(kept[2]) == set(kept[1]) - {1}
    assert set(kept[3]) == set(kept[2]) and kept[3][3].text == texts[3].replace("a@b.co", "[EMAIL]")
    assert all(kept[3][i].text == kept[2][i].text for i in kept[3] if i != 3)
    assert set(kept[4]) == set(kept[3])
    ran = corpus_pipeline.run(spark, root)
    assert sorted(map(tuple, ran.collect())) == sorted(map(tuple, docs.collect()))


def test_registered():
    assert {"pipeline", *[n for n in entry.queries() if n.startswith("op")]} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op")) == list(range(1, 14))
