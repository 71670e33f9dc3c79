"""Sharding, wrappers, Jaccard links, decontamination and the pipeline against brute force."""

import random
from itertools import combinations

import pytest

import corpus_pipeline
from tieout.llm import decontamination, html_wrapper, jaccard, sharding
from tieout.llm.common import components, scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, slot string"


def prose(rng, n):
    return " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + str(rng.randrange(400)) for _ in range(n))


def corpus():
    rng = random.Random(5)
    rows = []
    for k in range(60):
        base = prose(rng, rng.choice([3, 5, 30, 90, 300, 900]))
        rows.append(base)
        for _ in range(k % 4):
            words = base.split()
            for _ in range(rng.randrange(1 + len(words) // 60)):
                words[rng.randrange(len(words))] = "changed"
            rows.append(" ".join(words).upper())
    chain = prose(rng, 400).split()
    for k in range(12):  # each links with its neighbours only
        chain = [*chain[:-14], *prose(rng, 14).split()] if k % 2 else [*prose(rng, 14).split(), *chain[14:]]
        rows.append(" ".join(chain))
    rows += [None, "", " \t", "one two", "ONE  two", *["copy of a text with some words in it"] * 30]
    return [(k if k != 7 else None, t, None, "s", 1, 4, "z") for k, t in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(4).cache()


def sets():
    out = {}
    for doc, text, *_ in corpus():
        words = (text or "").lower().encode().split()
        out[-1 if doc is None else doc] = frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()
    return out


def brute_components():
    own, root = sets(), {}
    find = lambda x: x if root.get(x, x) == x else find(root[x])
    for a, b in combinations(sorted(own), 2):
        both = len(own[a] & own[b])
        if both and 100 * both >= 80 * len(own[a] | own[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: find(d) for d in own}


def test_jaccard_links_like_brute_force(docs):
    back = lambda x: -1 if x is None else x
    got = {back(r.doc_id): (r.n_shingles, back(r.component_id)) for r in jaccard.linked(docs).collect()}
    expected = brute_components()
    assert got == {d: (len(s), expected[d]) for d, s in sets().items()}


def test_linked_sets_share_a_signature():
    import numpy as np

    rng = np.random.default_rng(2)
    for n in (1, 2, 4, 5, 9, 23, 60, 150, 400, 1500):
        for _ in range(20):
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            keep = -(-80 * len(a) // 100)  # a subset of at least 80 %
            b = np.sort(rng.choice(a, rng.integers(keep, len(a) + 1), replace=False))
            assert set(jaccard.signatures(a).tolist()) & set(jaccard.signatures(b).tolist())
            differ = int(np.unpackbits((jaccard.sketch(a) ^ jaccard.sketch(b)).view(np.uint8)).sum())
            assert differ <= len(a) - len(b)


def test_one_of_each_keeps_named_documents(spark, docs):
    left = jaccard.one_of_each(docs).collect()
    expected = brute_components()
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in left) == sorted(d for d, c in expected.items() if d == c)
    twice = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (1, "other words"), (3, None), (3, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text or "") for r in jaccard.one_of_each(twice).collect()) == [(1, "a b c d e f"), (1, "other words"), (3, ""), (3, "")]
    assert jaccard.one_of_each(docs.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    got = {r.id: r.component_id for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}}


def test_shards_are_even_whole_and_gapless(spark, docs, monkeypatch):
    monkeypatch.setattr(sharding, "TOLERANCE", 0.001)
    rows = corpus() + [(10_000 + k, "the same long text over and over " * 20, None, "s", 1, 4, "z") for k in range(300)]
    got = sharding.sharded(spark.createDataFrame(rows, SCHEMA).repartition(6), scratch(spark, "test-shards"), 4).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted((str(r[0]), str(r[1])) for r in rows)
    size = lambda t: len((t or "").encode()) + 1
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    assert sorted(by) == [0, 1, 2, 3]
    totals = [sum(size(r.text) for r in own) for own in by.values()]
    assert max(totals) - min(totals) <= 2 * max(size(r[1]) for r in rows)
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert sharding.sharded(docs.limit(0), scratch(spark, "test-empty")).count() == 0


PAGE = """<html><head><title>t</title><script>var x="</p>";</script></head><body><nav><a href=/>Home</a></nav>
<div class="cookie-notice">We use cookies</div><article class="post-{k}"><h1>Head {k}</h1>{body}
<div class="ad">Buy!</div><section id="comments"><p>First!</p></section></article><aside>Side</aside><footer>&copy; Me</footer></body></html>"""


def test_wrappers_read_the_article(spark):
    pages, expected = [], {}
    for k in range(40):
        body = "".join(f"<p>para <b>{k}.{j}</b> &amp; more<br>line &eacute;" + ("</p>" if j % 2 else "") for j in range(k % 5))
        body += f"<ul><li>item {k}<li>other</ul>" if k % 3 else ""
        pages.append((k, f"https://host{k % 3}.example.com/a", PAGE.format(k=k, body=body)))
        expected[k] = "\n".join([f"Head {k}", *(f"para {k}.{j} & more line é" for j in range(k % 5)), *([f"item {k}", "other"] if k % 3 else [])])
    plain = "<body><div class=menu>Menu</div><div id=wrap><div id=text><p>words {k} here</p><p>and more {k}</p></div><p>Same on all</p></div></body>"
    for k in range(100, 106):
        pages.append((k, "http://plain.example.org/", plain.format(k=k)))
        expected[k] = f"words {k} here\nand more {k}"
    pages += [(200, None, None), (201, "::", "just text &lt;b"), (202, "http://x.example/", "<p>open <b>only")]
    expected |= {200: "", 201: "just text <b", 202: "open only"}
    got = {r.page_id: r.text for r in html_wrapper.extracted(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5)).collect()}
    assert got == expected


def test_wrapper_has_optional_and_repeated_parts():
    tree = lambda h: html_wrapper.wrapper(html_wrapper.parse(h))
    both = html_wrapper.merged(tree("<div><h2>a</h2><p>x</p><p>y</p></div>"), tree("<div><p>z</p><table></table></div>"))
    items = {x[0]: x for x in both[3][0][3]}
    assert items["h2"][1] and items["table"][1] and items["p"][2] and not items["p"][1]
    group = tree("<div>" + "<h3>q</h3><p>a</p>" * 3 + "</div>")[3][0][3]
    assert [x[0] for x in group] == ["#g"] and group[0][2]


def test_decontamination_finds_items_and_leaves_clean_texts(spark):
    rng = random.Random(9)
    items = [(k, prose(rng, 20 + k) + ". " + prose(rng, 8) + ".") for k in range(12)] + [(50, None), (51, "too short")]
    docs, leaked = [], set()
    for k in range(120):
        words = prose(rng, rng.choice([40, 200])).split()
        if k % 4 == 0:
            part = items[k % 12][1].split()
            if k % 8 == 0:
                part[3] = "paraphrased"
                part.insert(9, "extra")
            at = rng.randrange(len(words))
            words[at:at] = [w + "%%" for w in part]
            leaked.add((k, k % 12))
        docs.append((k, " ".join(words)))
    docs += [(500, None), (501, ""), (None, "a b")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.leaks(frame, bench).collect()} == leaked
    assert decontamination.without_leaks(frame, bench).count() == len(docs) - len(leaked)
    assert decontamination.leaks(frame, bench.limit(0)).count() == 0
    assert decontamination.leaks(frame.limit(0), bench).count() == 0


def test_common_subsequence():
    places = decontamination.places
    assert decontamination.common(places([1, 2, 3, 2]), 4, [2, 9, 3, 2]) == 3
    assert decontamination.common(places([1]), 1, []) == 0


def test_pipeline_keeps_columns_and_its_decisions(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, left = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, left = left, stage(spark, left, sf).cache()
        assert left.columns == columns, name
        assert 0 < left.count() <= before.count()
    whole = jaccard.linked(left)
    assert whole.where("n_shingles > 0 and component_id <> doc_id").count() <= 1  # masked secrets may make texts alike
    assert decontamination.leaks(left, spark.read.parquet(f"{sf}/benchmark.parquet")).count() == 0
    pieces = corpus_pipeline.run(spark, sf)
    assert pieces.select("doc_id").distinct().count() == left.count()
