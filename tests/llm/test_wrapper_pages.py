"""Pages whose markup misleads a list of words, or goes beyond usual sizes."""

from tieout.llm import html_wrapper

PROSE = "Words of an article that go on for a while about something. " * 8


def one(body):
    return html_wrapper.main_text(f"<html><body>{body}</body></html>", None)


def test_attribute_values_and_data_names_dont_hide():
    got = one(
        "<article><p title='hidden costs'>First</p><p>See <a href='/hidden-gems'>hidden gems</a> and <a href=/x/hidden title=id>more</a></p><div data-hidden='false'>Second</div>"
        "<div data-id='nav' data-role='form' data-class=\"sidebar\">Third</div><p title=\"class='menu'\">Fourth</p><p hidden>gone</p><p HIDDEN=''>gone</p><p class=x hidden/>gone</p>"
        "<p aria-hidden = \"true\">gone</p><p style='display: none'>gone</p><div Class=nav>gone</div><div role=dialog>gone</div></article>"
    )
    assert got == "First\nSee hidden gems and more\nSecond\nThird\nFourth"


def test_containers_of_the_article_are_read():
    side = "<div class=sidebar><p>Side text</p></div><div class='comments'><p>First!</p></div>"
    for start, end in (("<form id=aspnetForm action=x>", "</form>"), ("<div class='layout has-sidebar'>", "</div>"), ("<div class='no-sidebar content'>", "</div>"), ("<div class='elementor-widget'>", "</div>"), ("<div id='post-form'>", "</div>")):
        for body in (f"<p>{PROSE}</p><p>Second</p>", f"<article><p>{PROSE}</p></article>", "<article><p>Short</p></article>"):
            expected = one(f"<div>{body}</div>")
            assert expected and one(f"{start}{body}{side}{end}") == expected, (start, body)
    assert one(f"<form><div class='layout has-sidebar'><article>{PROSE}</article>{side}</div></form>") == PROSE.strip()
    assert one(f"<main><h1>Head</h1><form><p>{PROSE}</p></form></main>") == "Head\n" + PROSE.strip()
    assert one("<div class=widget><p>Only text</p></div>") == "Only text"


def test_names_still_leave_out():
    comments = f"<div id=comments><article class='comment'><p>{PROSE * 3}</p></article></div>"
    assert one(f"<article><p>Short article</p></article>{comments}") == "Short article"
    assert one(f"<article><p>Article {PROSE}</p><form><p>Sign up</p></form></article><aside><p>{PROSE}</p></aside>") == f"Article {PROSE}".strip()
    assert one(f"<div><p>{PROSE}</p></div><div class='related'><article><p>Teaser</p></article></div><div class=footer-menu>Menu</div>") == PROSE.strip()


def host_rule(pages):
    top = None
    for page in pages:
        tree = html_wrapper.wrapper(html_wrapper.parse(page))
        top = tree if top is None else html_wrapper.merged(top, tree)
    return html_wrapper.rule(top, len(pages))


def test_long_notices_common_to_all_pages_go():
    notice = ("All rights of this notice are kept by its owner, whoever that may be. " * 8).strip()
    assert len(notice) >= 500
    for start, end in (("<article>", "</article>"), ("<div class=a>", "</div>")):
        pages = [f"<body><div class=b>{start}<p>{notice}</p><p>Text {k} {k * PROSE}</p><ul><li>Same</li><li>Same</li></ul><p>Own {k}</p>{end}</div></body>" for k in range(1, 6)]
        where = host_rule(pages)
        for k, page in enumerate(pages, 1):
            got = html_wrapper.main_text(page, where)
            assert notice not in got and got.startswith(f"Text {k}") and got.endswith(f"Own {k}")
    copies = [f"<article><p>{notice}</p><p>Text</p></article>"] * 4
    assert html_wrapper.main_text(copies[0], host_rule(copies)) == notice + "\nText"
    few = [f"<article><p>Text {k} {PROSE}</p>{'<p>Now and then</p>' * (k < 3)}</article>" for k in range(6)]
    assert html_wrapper.main_text(few[0], host_rule(few)).endswith("Now and then")


def test_deep_pages_keep_the_rest_of_the_article():
    deep = "<div>" * 200 + "<p>Deep<p>Deeper</p>" + "</div>" * 200
    got = one(f"<div><article><p>First</p>{deep}<p>Last</p></article></div><p>Outside</p>")
    assert got.startswith("First\n") and got.endswith("\nLast") and "Deep" in got and "Deeper" in got


def test_long_lists_align_like_short_ones():
    import random

    rng = random.Random(2)
    for n, m, kinds in ((0, 5, 3), (7, 9, 3), (60, 50, 5), (130, 200, 30)):
        a, b = [rng.randrange(kinds) for _ in range(n)], [rng.randrange(kinds) for _ in range(m)]
        best = [[0] * (m + 1) for _ in range(n + 1)]
        for i in range(n - 1, -1, -1):
            for j in range(m - 1, -1, -1):
                best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
        rows = html_wrapper.Rows(a, b)
        assert all(rows.count(i, j) == best[i][j] for i in range(n + 1) for j in range(m + 1))
    items = lambda keys: [[f"k{x}", False, False, [], 0] for x in keys]
    got = html_wrapper.aligned(items(range(600)), items([*range(300), 1000, *range(300, 600)]))
    assert [(x[0], x[1], x[2]) for x in got] == [(f"k{x}", x == 1000, False) for x in [*range(300), 1000, *range(300, 600)]]
