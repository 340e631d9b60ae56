"""Held-out accuracy of the classifiers, and what they do with odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from shelfcast.llm import linear, toxicity
from shelfcast.llm.queries import REGISTRY
from tests.llm.conftest import docs_of, words


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def auc(labels, scores):
    pairs = [(a > b) + 0.5 * (a == b) for a, x in zip(scores, labels) for b, y in zip(scores, labels) if x > y]
    return sum(pairs) / len(pairs)


def sample(rng, n):
    """Every fourth text is toxic, every third is junk."""
    plain = [words(rng, 1)[0] for _ in range(400)]
    bad = ["worthless", "disgusting", "pathetic"]
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(plain) for _ in range(rng.randint(20, 80))]
        toxic, junk = i % 4 == 0, i % 3 == 0
        if toxic:
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        if junk:
            w = [x + rng.choice(["$$$", "%%%", "###"]) if rng.random() < 0.4 else x for x in w]
        rows.append((i, " ".join(w)))
        labels.append((i, int(not junk), int(toxic)))
    return rows, labels


@pytest.mark.parametrize(("scored", "target", "column"), [(toxicity.scored, "toxic", 2), (linear.scored, "quality", 1)])
def test_held_out_accuracy(spark, rng, scored, target, column):
    rows, labels = sample(rng, 600)
    out = linear.held_out(5, 0)
    got = {r.doc_id: r.score for r in scored(docs_of(spark, rows), labelled(spark, labels), target=target, out=out).collect()}
    held = [x for x in labels if zlib.crc32(str(x[0]).encode()) % 5 == 0]
    assert len(held) > 80 and all(0 <= s <= 1 for s in got.values())
    assert auc([x[column] for x in held], [got[x[0]] for x in held]) > 0.95


@pytest.mark.parametrize(("scored", "target"), [(toxicity.scored, "toxic"), (linear.scored, "quality")])
def test_scores_of_odd_rows(spark, rng, hard_docs, no_docs, scored, target):
    rows, labels = sample(rng, 60)
    known = labelled(spark, [*labels, (1, None, None), (None, 1, 1), (2, 7, 7), (5, 0, 1), (5, 1, 0)])
    both = docs_of(spark, rows).unionByName(hard_docs.select("doc_id", "text", "lang", "source", "n_chars"))
    got = scored(both, known, target=target).collect()
    assert len(got) == both.count() and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (901, 902, 903)}) == 1
    assert len({r.score for r in got if r.doc_id == 905}) == 1
    none = scored(hard_docs, known.limit(0), target=target).collect()
    assert {round(r.score, 3) for r in none} == {0.5}
    assert scored(no_docs, known, target=target).count() == 0


def test_held_out_rows_are_not_learnt_from(spark, rng):
    rows, labels = sample(rng, 200)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, t) for i, q, t in labels]
    out = linear.held_out(4, 2)
    a, b = (
        {r.doc_id: r.score for r in linear.scored(docs_of(spark, rows), labelled(spark, x), out=out).collect()} for x in (labels, flipped)
    )
    assert a == b


def test_leader_learns_a_sparse_rule():
    rng = random.Random(2)
    texts, labels = zip(*[(" ".join(words(rng, 6) + (["yes"] if i % 2 else ["no"])), i % 2) for i in range(200)])
    weights = linear.train(pa.array(texts), list(labels), linear.Settings(bits=16, l1=0.5))
    assert 0 < (weights != 0).mean() < 0.05


def test_queries_are_whole_tables(spark):
    folder = "/root/testdata/sf0.001"
    docs, pages = (spark.read.parquet(f"{folder}/{t}.parquet").count() for t in ("documents", "pages"))
    for name in ("op3_extendible_sharding", "op7_token_counts", "op8_quality_rules", "op9_ngram_jaccard_join", "op10_quality_classifier"):
        assert REGISTRY[name](spark, folder).count() == docs, name
    assert REGISTRY["op4_html_extraction"](spark, folder).count() == pages


def test_most_windows_bounds_the_ordinary_dictionary(rng):
    """The windows that the ordinary dictionary learns from are bounded by the setting alone."""
    rows, labels = sample(rng, 600)
    texts, toxic = [t for _, t in rows], np.array([x[2] for x in labels])
    every, few = (toxicity.train(texts, toxic, toxicity.Settings(most_windows=n)) for n in (10**6, 300))
    assert every.ordinary == toxicity.train(texts, toxic, toxicity.Settings()).ordinary != few.ordinary
    assert every.toxic == few.toxic
