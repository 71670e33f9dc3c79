"""Main text: titles beside the article, headings that all pages share, paragraphs of one link, odd tables."""

import pytest

from tieout.llm.html_wrapper import extracted, main_text

SCHEMA = "page_id long, url string, html string, host string, rule string, text string"
BODY = "This is paragraph {k} of page {n}, with words enough to be most of what the page has to say to its readers. " * 2


def page(n, frame):
    paras = "".join(f"<p>{BODY.format(k=k, n=n)}</p>" for k in range(3))
    return frame.format(n=n, paras=paras, one=f"<p>{BODY.format(k=0, n=n)}</p>")


def text(n, *before, paragraphs=3):
    return "\n".join([*before, *(" ".join(BODY.format(k=k, n=n).split()) for k in range(paragraphs))])


FRAMES = {
    "beside a block": "<html><body><ul><li><a href=/>Home</a></li></ul><div><h1>Title {n}</h1><div class=body>{paras}</div></div></body></html>",
    "in a wrapper of its own": "<html><body><div class=top><h1>Title {n}</h1></div><div class=body>{paras}</div></body></html>",
    "above the ancestor": "<html><body><h1>Title {n}</h1><div><div class=body>{paras}</div></div></body></html>",
    "as a link": "<html><body><h1><a href=/p>Title {n}</a></h1><div class=body>{paras}</div></body></html>",
}


@pytest.mark.parametrize("frame", FRAMES.values(), ids=FRAMES)
@pytest.mark.parametrize("pages", [1, 5])
def test_titles_stay(spark, frame, pages):
    rows = [(n, f"http://a.org/{n}", page(n, frame), "x", "y", "z") for n in range(pages)]
    got = {r.page_id: r.text for r in extracted(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {n: text(n, f"Title {n}") for n in range(pages)}


def test_title_beside_one_paragraph():
    assert main_text(page(4, "<body><div><h1>Title {n}</h1>{one}</div></body>"), None) == text(4, "Title 4", paragraphs=1)


def test_shared_headings_stay_and_shared_notices_go(spark):
    notice = "<div><h3>Read this first</h3><p>The same notice on every page of the host, in many words.</p></div>"
    frame = "<body><article><h1>Report</h1>" + notice + "<section><h2>Summary</h2>{paras}</section></article></body>"
    rows = [(n, f"http://a.org/{n}", page(n, frame), None, None, None) for n in range(6)]
    got = {r.page_id: r.text for r in extracted(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {n: text(n, "Report", "Summary") for n in range(6)}


def test_site_titles_and_later_headings_go(spark):
    frame = "<body><h1>The Site</h1><div class=body>{paras}</div><h2>More from us</h2></body>"
    rows = [(n, f"http://a.org/{n}", page(n, frame), None, None, None) for n in range(6)]
    got = {r.page_id: r.text for r in extracted(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {n: text(n) for n in range(6)}


def test_paragraph_of_one_link_stays():
    html = page(1, "<body><div class=body>{paras}<p><a href=/x>One link</a></p><ul><li><a href=/y>Other page</a></li></ul></div></body>")
    assert main_text(html, None) == text(1) + "\nOne link"


def test_odd_tables(spark):
    assert extracted(spark.createDataFrame([], SCHEMA)).count() == 0
    same = page(1, FRAMES["as a link"])
    rows = [(1, "http://b.org/1", same, None, None, None)] * 4 + [(None, None, None, "h", "r", "t"), (2, "", "", "h", "r", "t")]
    rows += [(3, "http://c.org", "<p>" + "long " * 200_000 + "</p>", None, None, None)]
    got = [(r.page_id, len(r.text)) for r in extracted(spark.createDataFrame(rows, SCHEMA)).collect()]
    title = len(text(1, "Title 1"))
    assert sorted(got, key=str) == sorted([(1, title)] * 4 + [(None, 0), (2, 0), (3, 999_999)], key=str)
