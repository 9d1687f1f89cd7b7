import collections
import random
import re

import numpy as np
import pytest

from clickloom.llm import boosting
from clickloom.llm import quality as q

TESTDATA = "/root/testdata"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(repeated), failed


def test_statistics_match_brute_force(spark, documents):
    from test_llm_texts import ODD_TEXTS

    draw = random.Random(1)
    texts = ODD_TEXTS + [
        "".join(draw.choice(["a ", "bb ", "c\n", "é ", "#", "$ ", "a b c d e f g h ", "\n\n", "\t"]) for _ in range(n))
        for n in range(0, 300, 3)
    ]
    docs = documents(*enumerate(texts), (1, texts[9]))
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    got = sorted(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in q.quality(docs, labels).collect()
    )
    assert got == sorted((i, *brute(t)) for i, t in [*enumerate(texts), (1, texts[9])])


def test_one_class_leaves_base_rules(spark, documents):
    docs = documents((1, "good words all around " * 2), (2, " ".join(f"w{k}" for k in range(30))))
    labels = spark.createDataFrame([(1, 1), (2, 1), (2, None), (77, 0)], "doc_id bigint, quality int")
    assert {r.doc_id: r.kept for r in q.quality(docs, labels).collect()} == {1: False, 2: True}


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.1/documents.parquet")
    labels = spark.read.parquet(f"{TESTDATA}/sf0.1/labels.parquet")
    train = labels.filter("doc_id % 2 = 0")
    held = labels.filter("doc_id % 2 = 1").select("doc_id", "quality")
    return q.quality(docs, train).join(held, "doc_id").toPandas()


def test_held_out_documents(scored):
    good = scored[(scored.quality == 1) & ~scored.base_failed]
    bad = scored[scored.quality == 0]
    assert good.kept.mean() > 0.99
    assert bad.kept.mean() < 0.02


def test_empty_documents(spark, documents):
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    assert q.quality(documents(), labels).collect() == []


def test_filter_keeps_columns(spark, documents):
    docs = documents((1, "too short"), (2, " ".join(f"w{k}" for k in range(30))))
    kept = q.good_documents(docs, spark.createDataFrame([], "doc_id bigint, quality int"))
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]


def test_trees_are_monotonic():
    draw = np.random.default_rng(0)
    rows = draw.normal(size=(800, 3))
    labels = (rows[:, 0] + np.sin(3 * rows[:, 1]) + draw.normal(size=800) > 0).astype(int)
    trees = boosting.fit(rows, labels, np.array([1, 0, -1]))
    assert ((trees.probability(rows) > 0.5) == labels).mean() > 0.8
    for feature, sign in ((0, 1), (2, -1)):
        grid = np.repeat(rows[:40], 50, axis=0)
        grid[:, feature] = np.tile(np.linspace(-3, 3, 50), 40)
        steps = np.diff(trees.margin(grid).reshape(40, 50), axis=1)
        assert (sign * steps >= -1e-12).all()


def test_flat_arrays_score_as_a_walk_does():
    draw = np.random.default_rng(3)
    rows = draw.normal(size=(300, 4))
    trees = boosting.fit(rows, (rows[:, 0] * rows[:, 1] > 0).astype(int), np.zeros(4, int), rounds=10)
    for row, margin in zip(rows[:50], trees.margin(rows[:50])):
        total = trees.base
        for at in trees.roots:
            while trees.left[at] != at:
                at = trees.left[at] if row[trees.feature[at]] <= trees.threshold[at] else trees.right[at]
            total += trees.value[at]
        assert total == pytest.approx(margin)
