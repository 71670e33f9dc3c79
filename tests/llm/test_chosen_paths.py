"""Chosen-path near-duplicates against brute force, in every path of the search."""

import random
from itertools import combinations

import pytest

from tieout.llm import chosen_paths as P

SCHEMA = "doc_id long, text string, key string, node int, n long, part string, tokens int, rows int"


def prose(rng, n):
    return [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(500)) for _ in range(n)]


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


def shingle_set(text):
    w = words_of(text)
    return {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 20 * min(len(a), len(b)) >= 17 * max(len(a), len(b)):
            both = len(a & b)
            if 100 * both >= 85 * (len(a) + len(b) - both):
                parent[root(i)] = root(j)
    least = {}
    for k, (doc, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), doc), doc)
    return sorted((doc, len(sets[k]), least[root(k)] if sets[k] else doc) for k, (doc, _) in enumerate(rows))


def corpus():
    rng = random.Random(9)
    texts = []
    for k in range(70):
        base = prose(rng, rng.choice([2, 4, 5, 30, 90, 300, 700]))
        texts.append(base)
        for _ in range(k % 4):
            other = list(base)
            for _ in range(rng.randrange(1 + len(other) // 60)):
                other[rng.randrange(len(other))] = "Changed"
            texts.append([w.upper() for w in other])
    chain = prose(rng, 400)
    for k in range(10):  # each links with its neighbours only
        chain = [*chain[:-14], *prose(rng, 14)] if k % 2 else [*prose(rng, 14), *chain[14:]]
        texts.append(chain)
    shared = prose(rng, 60)  # a passage that makes large nodes of texts that don't link
    texts += [[*shared, *prose(rng, rng.choice([12, 40]))] for _ in range(150)]
    hub = prose(rng, 200)  # a large group of near copies
    for _ in range(120):
        near = list(hub)
        for _ in range(3):
            near[rng.randrange(200)] = "near" + str(rng.randrange(9))
        texts.append(near)
    rows = [" ".join(t) for t in texts] + [None, "", " \t", "one two", "ONE  two", "x" * 300_000, " ".join(prose(rng, 30_000))]
    rows += ["copy of a text with some words in it"] * 40
    return list(enumerate(rows))


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "k", 1, 2, "p", 3, 4) for d, t in rows], SCHEMA).repartition(4)


def result(df):
    got = sorted(tuple(r) for r in df.collect())
    assert all(kept == (doc == component) for doc, _, component, kept in got)
    return [r[:3] for r in got]


@pytest.fixture(scope="module")
def found():
    rows = corpus()
    return rows, brute(rows)


def test_components_equal_brute_force(spark, found):
    rows, want = found
    assert result(P.linked(frame(spark, rows))) == want


@pytest.mark.parametrize("small, leaf, levels", [(2, 4, 3), (4, 4, 1)])
def test_large_nodes(spark, found, monkeypatch, small, leaf, levels):
    """Nearly all nodes count as large: pivots, deeper levels and the blocks of what remains do the work."""
    monkeypatch.setattr(P, "SMALL", small)
    monkeypatch.setattr(P, "LEAF", leaf)
    monkeypatch.setattr(P, "LEVELS", levels)
    monkeypatch.setattr(P, "BLOCK", 16)
    rows, want = found
    assert result(P.linked(frame(spark, rows))) == want


def test_odd_tables(spark):
    assert P.linked(frame(spark, [])).count() == 0
    rows = [(None, "a b c d e f g"), (None, "a b c d e f g"), (3, "a b c d e f g"), (3, None), (3, None), (4, "")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in P.linked(frame(spark, rows)).collect()), key=str)
    want = [(3, 0, 3, True), (3, 0, 3, True), (3, 3, None, False), (4, 0, 4, True), (None, 3, None, True), (None, 3, None, True)]
    assert got == sorted(want, key=str)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    assert result(P.op12_chosen_path_copies(spark, "/root/testdata/sf0.01")) == brute(rows)
