"""Leaks of every length that step 4 of the decontamination accepts are found in longer documents."""

import random

from tieout.llm import decontamination


def prose(rng, n):
    return [rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(400)) for _ in range(n)]


def planted(spark, items, copies, rng, host=160):
    """(item, copy) pairs that are found, each copy in prose of ``host`` words."""
    docs = []
    for k, (_, words) in enumerate(copies):
        around = prose(rng, host)
        at = rng.randrange(host)
        docs.append((k, " ".join([*around[:at], *words, *around[at:]])))
    docs += [(10_000 + k, " ".join(prose(rng, host))) for k in range(100)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(k, " ".join(x)) for k, x in items.items()], "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in decontamination.leaks(frame, bench).collect()}


def test_partly_kept_items_are_found(spark):
    rng = random.Random(3)
    items = {k: [*prose(rng, 15 + k), *prose(rng, 6)] for k in range(40)}
    items = {k: [*x[:-7], x[-7] + ".", *x[-6:]] for k, x in items.items()}  # the last six words are the answer
    copies = []
    for k, x in items.items():
        for share in (0.7, 0.8):
            kept = set(rng.sample(range(len(x)), -(-int(share * 10) * len(x) // 10)))
            copies.append((k, [w if j in kept else "other" + str(rng.randrange(999)) for j, w in enumerate(x)]))
        kept = {*rng.sample(range(len(x) - 6), max(0, -(-len(x) // 2) - 6)), *range(len(x) - 6, len(x))}
        copies.append((k, [w if j in kept else "other" + str(rng.randrange(999)) for j, w in enumerate(x)]))
    got = planted(spark, items, copies, rng)
    assert got == {(k, i) for k, (i, _) in enumerate(copies)}


def test_copies_of_long_items_are_found(spark):
    rng = random.Random(4)
    items = {k: prose(rng, n) for k, n in enumerate([66, 100, 228, 300, 304, 456, 600, 1000, 1000])}
    copies = [(k, x) for k, x in items.items()]
    copies += [(k, [w if rng.random() < 0.78 else "other" + str(rng.randrange(999)) for w in x]) for k, x in items.items() if len(x) > 200]
    got = planted(spark, items, copies, rng, host=3000)
    assert got == {(k, i) for k, (i, _) in enumerate(copies)}


def test_copies_of_short_items_are_found(spark):
    rng = random.Random(6)
    items = {k: ["only" + str(k), *prose(rng, 2 + k % 13)] for k in range(52)}
    copies = [(k, x) for k, x in items.items()]
    assert planted(spark, items, copies, rng) == {(k, i) for k, (i, _) in enumerate(copies)}


def test_items_without_spaces_are_found(spark):
    items = [(0, "光合作用发生在哪里？叶绿体。"), (1, "日本の首都"), (2, "この問題の答えは、東京から大阪までの距離です。"), (3, "เมืองหลวงของไทย")]
    around = "前面的文字没有关系，只是普通的内容{}后面的文字也没有关系。"
    docs = [(k, around.format(t)) for k, t in items] + [(9, around.format("")), (10, "日本 の 首 都"), (11, "首都日本の")]
    docs += [(12, around.format("光合作用，发生在 哪里 叶绿体"))]
    bench, frame = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.leaks(frame, bench).collect()} == {*((k, k) for k in range(4)), (10, 1), (12, 0)}


def test_words_of_scripts():
    n = lambda t: len(decontamination.words(t))
    assert [n(x) for x in ("a bc é", "日本語abc、です。", "ไทย", "한국어 말", "𠀀𠀁", "ａｂ！ｃ", "naïve—x", "Tiếng Việt")] == [3, 6, 3, 2, 2, 2, 1, 2]
    assert decontamination.words("日本").tolist() == decontamination.words("日 本").tolist()


def test_basis_takes_every_passage(spark, monkeypatch):
    """The passages that the basis is fitted on are all those of the documents, and its span is that of a plain SVD."""
    import numpy as np

    rng = random.Random(9)
    topics = [[f"t{a}w{b}" for b in range(40)] for a in range(6)]
    docs = [(k, " ".join(rng.choices(topics[k % 6], k=3_200 + k))) for k in range(220)]  # some 23,000 passages
    bench = spark.createDataFrame([(1, " ".join(topics[0][:12]))], "item_id long, text string")
    seen = []
    whole = decontamination.basis

    def fitted_on(passages, idf):
        seen.append((passages.collect(), idf, whole(passages, idf)))
        return seen[-1][2]

    monkeypatch.setattr(decontamination, "basis", fitted_on)
    decontamination.fitted(spark.createDataFrame([*docs, (None, None), (8, "")], "doc_id long, text string").repartition(5), bench)
    (rows, idf, table), = seen
    assert sorted(r["text"] for r in rows if r["scale"] == 1.0 and r["text"]) == sorted(t for _, t in docs)
    used = np.unique(decontamination.terms(decontamination.words(" ".join(w for x in topics for w in x))))
    vectors = []
    for r in rows:
        t = np.searchsorted(used, decontamination.terms(decontamination.words(r["text"])))
        for k in range(0, len(t), decontamination.PASSAGE):
            v = np.bincount(t[k : k + decontamination.PASSAGE], minlength=len(used)) * idf[used]
            vectors.append(v * (r["scale"] / np.sqrt((v * v).sum())))
    a = np.array(vectors)
    kept = ((a @ table[used]) ** 2).sum()
    best = (np.linalg.svd(a, compute_uv=False)[: decontamination.RANK] ** 2).sum()
    assert 0.9 * best <= kept <= 1.001 * best
