import random
import re

import numpy as np
import pytest

from clickloom.llm import near_dedup as n
from clickloom.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(docs, size=4, percent=80):
    sets = [shingles(t, size) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (a, x) in enumerate(zip(docs, sets)):
        for j in range(i):
            y = sets[j]
            both = len(x & y)
            linked = x and y and 100 * both >= percent * len(x | y)
            if linked and a[0] is not None and docs[j][0] is not None:
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(docs):
        ids = [docs[j][0] for j in range(len(docs)) if find(j) == find(i)]
        least = None if doc is None else min(ids)
        out.append((doc, len(sets[i]), least, doc is None or doc == least))
    return sorted(out, key=repr)


def result(docs, **options):
    rows = n.near_duplicates(docs, **options).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows), key=repr)


def near_copies(draw, n_groups, most, length=60):
    """Groups of texts with a few words changed: many pairs are near the threshold."""
    docs = []
    for g in range(n_groups):
        base = [f"w{draw.randrange(40)}" for _ in range(length)]
        for _ in range(draw.randrange(1, most)):
            words = list(base)
            for _ in range(draw.randrange(0, 6)):
                words[draw.randrange(length)] = f"x{draw.randrange(1000)}"
            docs.append((len(docs), " ".join(words)))
    draw.shuffle(docs)
    return docs


@pytest.mark.parametrize("size", [4, 5])
def test_matches_brute_force(documents, size):
    docs = near_copies(random.Random(1), 25, 12)
    docs += [(900, None), (901, ""), (902, " \n"), (903, "One two"), (904, "one TWO"), (905, "one two three"), (906, "É a b c"), (907, "é a b c")]
    docs += [(None, docs[0][1]), (None, "of its own text"), (910, docs[3][1]), (910, docs[3][1]), (911, docs[5][1]), (911, "other text of it"), (-4, docs[9][1])]
    assert result(documents(*docs), size=size) == brute(docs, size)


def test_large_nodes_branch_and_are_cut_into_blocks(documents):
    docs = near_copies(random.Random(2), 3, 80)
    assert result(documents(*docs), leaf=8) == brute(docs)


def test_isolated_pairs_within_a_hot_template(spark):
    """Pairs just above the threshold, all alike by 70 percent: their nodes stay large for many levels."""
    sets = []
    for k in range(400):
        words = [*range(150), *(10**6 + k // 2 * 10 + j for j in range(10)), *(10**7 + k * 20 + j for j in range(20))]
        sets.append(np.unique(n.mixed(np.array(words, np.uint64))))
    rows = [(str(k).encode(), len(s), mh.tolist()) for k, (s, mh) in enumerate(zip(sets, n._minhashes(sets, n.COORDINATES)))]
    classes = spark.createDataFrame(rows, "fp binary, n int, mh array<int>").checkpoint()
    nodes = {}
    for node, fp in n.leaves(classes, leaf=8).collect():
        nodes.setdefault(node, set()).add(int(fp))
    met = {k // 2 for members in nodes.values() for k in members if k ^ 1 in members}
    assert met == set(range(200))


def test_miss_rate_of_nodes_that_stay_large():
    assert n.miss_rate(0.8, depth=1) < 2e-5
    assert n.miss_rate(0.8) < 2e-5


def test_passage_that_all_share(documents):
    draw = random.Random(3)
    passage = " ".join(f"p{k}" for k in range(30))
    docs = [(k, passage + " " + " ".join(f"z{draw.randrange(10**6)}" for _ in range(40))) for k in range(120)]
    assert result(documents(*docs), leaf=16) == brute(docs)


def test_long_texts_and_empty_tables(documents):
    long = " ".join(f"w{k}" for k in range(60_000))
    docs = [(5, long), (3, long + " tail"), (4, long.upper()), (9, "x" * 70_000)]
    assert result(documents(*docs)) == [(3, 59_998, 3, True), (4, 59_997, 3, False), (5, 59_997, 3, False), (9, 1, 9, True)]
    assert result(documents()) == []


def test_without_near_duplicates_keeps_columns(documents):
    docs = documents((2, "a b c d e f"), (1, "A b c d e f"), (3, None), (None, "a b c d e f"), (4, ""), (1, "A b c d e f"))
    kept = n.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [1, 1, 3, 4, None]


def test_intersections():
    draw = np.random.default_rng(0)
    sets = [np.unique(draw.integers(0, 50, k).astype(np.uint64)) for k in (1, 10, 40, 60, 0, 5)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert n.intersections(sets).tolist() == want


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(7, k) for k in range(200, 300)]
    links = spark.createDataFrame([*chain, *star, (5, 5), (None, 3), (160, 90), (2, 1), (1, 2)], "a int, b int")
    got = {r.vertex: r.label for r in components(links).collect()}
    want = {k: 90 for k in range(100, 161)} | {90: 90} | {k: 7 for k in range(200, 300)} | {7: 7, 1: 1, 2: 1}
    assert got == want
    assert components(spark.createDataFrame([], "a int, b int")).collect() == []
