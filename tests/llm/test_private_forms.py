"""Looser kinds of personal data: planted forms, formats that are never given out, very long runs, odd tables."""

import random

import pytest

from tieout.llm import private_data

SCHEMA = "doc_id long, text string"


def planted(n):
    """Texts with (kind, start, end) of real looser forms, each beside formats and words that are none."""
    random.seed(11)
    out = []
    for doc in range(n):
        text, real = "", []
        for kind in random.sample(sorted(private_data.LOOSE), 3):
            a, b = random.randint(2, 9), random.randint(200, 899)
            cued = random.random() < 0.6
            if kind == "spelled_email":
                lead, match = random.choice(["contact ", "write "]) if cued else "from ", f"user{doc} [at] host{a}[dot]org"
            elif kind == "local_phone":
                lead, match = "phone: " if cued else "dial ", f"({a}12) {b}-{random.randint(1000, 9999)}"
            elif kind == "national_id":
                lead, match = "SSN " if cued else "holder ", f"{random.randint(100, 600)}-{random.randint(10, 99)}-{random.randint(1000, 9999)}"
            else:
                body = "".join(random.choices("0123456789", k=18))
                check = 98 - int(body + "131400") % 97
                lead, match = "IBAN " if cued else "pay to ", f"DE{check:02d}{body}"
            text += f"Some words here {lead}"
            real.append((kind, len(text), len(text) + len(match)))
            text += match + " and more words. "
        number = f"{random.randint(100, 199)}-{random.randint(100, 199)}-{random.randint(1000, 9999)}"
        text += random.choice([f"order {number} of", f"part {random.randint(900, 999)}-{random.randint(10, 99)}-0000 of", f"code DE00{'7' * 18} of", "version 1.2.3 of"])
        out.append((doc, text + " the list.", real))
    return out


@pytest.fixture(scope="module")
def selected(spark):
    rows = planted(300)
    scan, spans = private_data.redactions(spark.createDataFrame([r[:2] for r in rows], SCHEMA).repartition(4))
    got = {(r.doc_id, r.kind, r.start, r.end) for r in spans.join(scan, "row").collect()}
    return {(d, *x) for d, _, real in rows for x in real}, got


def test_planted_looser_forms_are_found(selected):
    real, got = selected
    assert len(real & got) >= 0.9 * len(real), f"recall {len(real & got) / len(real):.2f}"
    loose = {x for x in got if x[1] in private_data.LOOSE}
    assert len(loose & real) >= 0.95 * len(loose), f"precision {len(loose & real) / len(loose):.2f}"


def test_very_long_runs_of_every_pattern(spark):
    n = 100_000
    texts = ["a@b" + ".c" * n, "a [at] b" + " [dot] c" * n, "1." * n + "1", "1 " * n + "1", "+1" + " (2)" * n, "212-555-" * n, "123-45-" * n, "DE12 ABCD" * n, "a@b.c " * 20_000]
    scan, spans = private_data.redactions(spark.createDataFrame(list(enumerate(texts)), SCHEMA))
    emails = spans.join(scan, "row").where("kind = 'email' and base").groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in emails} == {0: 1, 8: 20_000}


def test_overlaps_are_resolved_from_left_to_right(spark):
    rows = [(1, "a", 0, 10, 1.0), (1, "b", 5, 15, 9.0), (1, "c", 12, 20, 2.0), (1, "d", 12, 30, 3.0), (2, "a", 7, 9, 1.0)]
    loose = spark.createDataFrame(rows, "row long, kind string, start long, end long, score double")
    got = {(r.row, r.kind) for r in private_data._left_to_right(loose).collect()}
    assert got == {(1, "a"), (1, "d"), (2, "a")}  # b overlaps a; c and d are clear of a, the better one stays


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, row string, kind string, start string, bits string, score string, label string"
    scan, spans = private_data.redactions(spark.createDataFrame([], schema))
    assert scan.count() == 0 and spans.count() == 0
    rows = [(None, None, *"abcdef"), (1, "", *"abcdef"), (1, "x@y.org", *"abcdef"), (1, "x@y.org", *"abcdef")]
    scan, spans = private_data.redactions(spark.createDataFrame(rows, schema))
    assert scan.count() == 4 and spans.count() == 2


def test_account_numbers_by_check_digits(spark):
    rows = spark.createDataFrame([("DE89370400440532013000",), ("GB82 WEST 1234 5698 7654 32",), ("DE88370400440532013000",)], "m string")
    assert [r[0] for r in rows.select(private_data.mod97(rows.m)).collect()] == [True, True, False]
