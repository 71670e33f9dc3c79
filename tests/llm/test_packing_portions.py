"""Packing in small portions, as the pipeline does: the same pieces, and caches that stay within their bound."""

import corpus_pipeline
from tieout.llm import packing, tokens


def test_small_portions_give_the_same_pieces(spark):
    rows = [(i, " ".join(f"word{(i * 37 + k * k) % 901}" for k in range(300 + 40 * i))) for i in range(40)] + [(40, None), (41, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    plain = packing.pack(docs)
    small = packing.pack(docs, text_bytes=1000, cached=50)
    assert plain.count() == small.count() > 0 and plain.exceptAll(small).count() == 0


def test_caches_are_bounded():
    words = tokens.encoder(tokens.default_vocabulary(), 50)
    for k in range(20):
        words.batch([" ".join(f"w{k}x{i}" for i in range(40))])
    assert 50 <= len(words.words) < 50 + 40 and len(words.cores) < 50 + 40
    assert words is not tokens.encoder(tokens.default_vocabulary())


def test_the_pipeline_packs_in_small_portions(monkeypatch):
    asked = {}
    monkeypatch.setattr(corpus_pipeline, "pack", lambda docs, **how: asked.update(how))
    corpus_pipeline.packing(None, None, "")
    assert asked["text_bytes"] < packing.TEXT_BYTES and asked["cached"] < tokens.CACHED_WORDS
