"""The pipeline's stages, each on its own input, against brute force."""

import re
from collections import defaultdict

import corpus_pipeline
import pytest
from tests.llm.conftest import docs_of, words
from tests.llm.test_pairs import classes, covered, distance
from tests.llm.test_rows import check_packing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture()
def folder(spark, rng, tmp_path):
    """Clean texts, near copies, shared passages, benchmark items in texts, junk, nulls."""
    clean = [" ".join(words(rng, rng.randint(30, 120))) for _ in range(40)]
    passage, items = words(rng, 70), [words(rng, 25) for _ in range(5)]
    rows = list(enumerate(clean))
    rows += [(100 + i, clean[i] + " changed") for i in range(6)] + [(110, clean[0]), (110, clean[0])]
    rows += [(200 + i, " ".join([*words(rng, 40), *passage, *words(rng, 10)])) for i in range(5)]
    rows += [(300 + i, " ".join([*words(rng, 30), *items[i], *words(rng, 30)])) for i in range(5)]
    rows += [(400, "few words"), (401, "same again " * 40), (402, None), (403, "")]
    docs_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    bench = [(i, " ".join(x)) for i, x in enumerate(items)] + [(9, None)]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages(spark, folder):
    spark.conf.set("spark.sql.shuffle.partitions", 1)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        seen[name] = [(r.doc_id, r.text) for r in docs.collect()], out.collect()
        assert out.columns == columns or name == "packing"
        path = f"{folder}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    spark.conf.set("spark.sql.shuffle.partitions", 4)

    before, after = seen["quality rules"]
    assert {r.doc_id for r in after} == {d for d, _ in before} - {400, 401, 402, 403}
    before, after = seen["near duplicates"]
    assert sorted(r.doc_id for r in after) == sorted({c for _, n, c in classes(before, 80, 5) if n})
    assert not {r.doc_id for r in after} & {100, 105, 110}
    before, after = seen["repeated passages"]
    cut = covered(before, 50)[1]
    kept = {r.doc_id: WORD.findall(r.text) for r in after}
    assert kept == {d: [w for i, w in enumerate(WORD.findall(t)) if i not in cut[d]] for d, t in before}
    assert len(kept[200]) == 120 and {len(kept[200 + i]) for i in range(1, 5)} == {50}
    before, after = seen["benchmark decontamination"]
    items = [WORD.findall(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").where("text IS NOT NULL").collect()]
    leaks = {d for d, t in before if any(distance(w, WORD.findall(t)) <= 0.2 * len(w) for w in items)}
    assert {r.doc_id for r in after} == {d for d, _ in before} - leaks and leaks == {300, 301, 302, 303, 304}
    before, after = seen["packing"]
    assert check_packing(before, after, 4096) > 0.4


def test_run_returns_the_last_stage(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "sequence_id", "offset"} <= set(out.columns)
    held = defaultdict(int)
    for r in out.collect():
        held[r.sequence_id] += r.length
    assert max(held.values()) <= 4096 and len(held) == 1 + max(held)


def test_stages_bear_hard_rows(spark, hard_docs, no_docs, folder):
    for docs in (hard_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, folder)
            assert out.count() <= 400 and (name == "packing" or out.columns == docs.columns)
