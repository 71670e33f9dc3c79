"""Token links against a byte-by-byte alignment of whole texts, and odd rows."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest

from tieout.llm import token_links as T

SCHEMA = "doc_id long, text string, pair string, count int, rows int, best string, id string, pairs int"


def brute(rows):
    """One owner per byte and side; a link is a pair of owners of one byte, a cut an end of both."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    letters = T._byte_letters()
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def b_bytes(k):
        piece = b.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(k) else piece.replace("▁", " ").encode()

    docs, counts = [], Counter()
    for doc, text in rows:
        left = a.encode(" " + (text or ""), add_special_tokens=False)
        right = b.encode(text or "")
        sides = [[bytes(letters[c] for c in t) for t in left.tokens], [b_bytes(k) for k in right]]
        if not text or any(b"".join(s) != b" " + text.encode() for s in sides):
            docs.append((doc, None))
            continue
        owner = [[k for k, t in enumerate(s) for _ in t] for s in sides]
        links = sorted(set(zip(*owner, strict=True)))
        ends = []
        for s in sides:
            at, found = 0, {}
            for k, t in enumerate(s):
                at += len(t)
                found[at] = k + 1
            ends.append(found)
        i = j = 0
        groups = []
        for cut in sorted(ends[0].keys() & ends[1].keys()):
            k, m = ends[0][cut], ends[1][cut]
            groups.append(",".join(map(str, left.ids[i:k])) + "|" + ",".join(map(str, right[j:m])))
            i, j = k, m
        pairs = [(left.ids[x], right[y]) for x, y in links]
        counts.update(pairs)
        docs.append((doc, (len(left.ids), len(right), groups, pairs)))
    highest = Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    out = []
    for doc, found in docs:
        if found is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, pairs = found
        best = sum(counts[p] == highest[p[1]] for p in pairs)
        out.append((doc, n_a, n_b, len(groups), len(pairs), best, sum(counts[p] for p in pairs), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(3)
    bits = ["the", " quick", "  two  spaces", "\n", "\t", "Größe", "naïve", "日本語のテキスト", "🙂👍", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "▁", "don't", "12345", "x=1;", "ﬁ", "é", " ", "\x00", "\r\n", "ABC", "...", "　"]
    rows = [None, "", " ", "  ", "\n", "a", " a", "a ", "word", "word word word", "".join(bits), "x" * 20_000, "日本" * 3_000, "no spaces;but,punctuation" * 900]
    rows += ["".join(rng.choice(bits + [" ", " "]) for _ in range(rng.randrange(1, 60))) for _ in range(250)]
    rows += ["a usual sentence, with a copy."] * 20
    return [(k if k != 5 else None, t) for k, t in enumerate(rows)]


def result(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "p", 1, 2, "b", "i", 3) for d, t in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("most_pairs", [T.MOST_PAIRS, 10])
def test_digests_equal_brute_force(spark, most_pairs):
    rows = corpus()
    want = brute(rows)
    assert sum(r[1] > 0 for r in want) > 100 and sum(r[1] == 0 for r in want) > 5
    got, pairs = T.token_links(frame(spark, rows), most_pairs=most_pairs)
    assert result(got) == want
    assert pairs.agg({"count": "sum"}).first()[0] == sum(r[4] for r in want)


def test_windows_beyond_the_cache(spark, monkeypatch):
    monkeypatch.setattr(T, "CACHED_WINDOWS", 3)
    both = T.Vocabularies(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    ids = both.encode(["one two three four five six seven one two three", "one two three"])
    first = both.align(ids[1:]), both.align(ids)
    assert len(both.windows) == 3
    assert first == (both.align(ids[1:]), both.align(ids))
    assert first[1][0][0].startswith(first[0][0][0]) and first[1][1] == first[0][0]


def test_fast_ids_are_the_librarys_ids():
    """For letters, marks, digits, spaces of all scripts, alone and beside others."""
    from tokenizers import Tokenizer

    both = T.Vocabularies(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    texts = [f" a{chr(k)}1{chr(k)} {chr(k)}'s" for k in range(0x3400) if not 0xD800 <= k < 0xE000] + [t for _, t in corpus() if t]
    for text, found in zip(texts, library.encode_batch_fast(texts, add_special_tokens=False), strict=True):
        assert both.a.encode_ordinary(text) == found.ids, text


def test_empty_table(spark):
    assert T.token_links(frame(spark, []))[0].count() == 0


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert result(T.op13_token_links(spark, "/root/testdata/sf0.001")) == brute(rows)
