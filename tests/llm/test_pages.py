"""What an article holds beside paragraphs, hostile pages, and tables without landmarks."""

import random
import time

import pytest

from strata.llm import html

from .test_per_document import PAGE, own_pages

ARTICLE = """<html><body><nav><a href=/>Home</a> <a href=/n>News</a></nav><article><h1>Title of it</h1><p>Some long text of the story goes here, with a point.</p>
<table><tr><th>Question</th><th>Answer</th></tr><tr><td>All of it</td><td>42</td></tr></table><ul><li><a href=/x>A linked item</a><li>plain item</ul><pre>a = 1</pre>
<dl><dt>Term</dt><dd>its sense</dd></dl><figure><img src=x><figcaption>A caption</figcaption></figure><p>Short.</p><p>Another paragraph that closes the story.</p></article>
<footer>&copy; The Site</footer></body></html>"""


@pytest.fixture(scope="module")
def model():
    return html.fit(html.training_pages(own_pages(random.Random(1), 40)))


def test_the_whole_article_stays(model):
    assert html.main_text(ARTICLE, model).split("\n\n") == [
        "Title of it", "Some long text of the story goes here, with a point.", "Question", "Answer", "All of it", "42", "A linked item", "plain item", "a = 1", "Term", "its sense",
        "A caption", "Short.", "Another paragraph that closes the story."]


def test_quotes_that_delimit_nothing(model):
    want = "Don't stop reading here, it's a good story.\n\nIt isn't over."
    for tag in ("<article class=x'>", '<article class=x" id=y>', "<article 'x>", "<article class='a > b' title=\"it's\">", "<article title=it's>"):
        page = f"<body>{tag}<p>Don't stop reading here, it's a good story.</p><p>It isn't over.</p></article><footer>it's &copy;</footer></body>"
        assert html.main_text(page, model) == want, tag


def test_a_body_named_after_a_part_is_no_part():
    blocks = html.leaf_blocks('<body class="comments share"><article><p>The text.</p></article><div class="comments"><p>No.</p></div></body>')
    assert html.landmark_labels(blocks) == [1, 0]


@pytest.mark.parametrize("piece", ["<title>x", "<a '", "<div>", "<div>x", '<a x="', "<p><li><td>", '<svg "', "<a ", "<!-", "<svg ", "</p>", "<ul><li>y", "&amp", "<b>z", "<td><table>"])
def test_hostile_pages_take_time_in_proportion(model, piece):
    t0 = time.perf_counter()
    html.main_text(piece * (300_000 // len(piece)), model)
    assert time.perf_counter() - t0 < 12
    t0 = time.perf_counter()
    html.main_text(piece * (300_000 // len(piece)) + ">", model)
    assert time.perf_counter() - t0 < 12


def test_elements_beyond_the_depth_end_no_others():
    deep = "<div>" * 600 + "<p>inner</p>" + "</div>" * 600
    blocks = html.leaf_blocks(f"<article><p>before</p>{deep}<p>after</p></article><p>outside</p>")
    assert [b.text for b in blocks] == ["before", "inner", "after", "outside"]
    assert [[s[0] for s in b.path if s[0] in ("article", "p")] for b in (blocks[0], blocks[2], blocks[3])] == [["article", "p"], ["article", "p"], ["p"]]


def test_pages_none_of_which_has_landmarks(spark, tmp):
    page = PAGE.replace("<article>", '<div class="content">').replace("</article>", "</div>")
    rows = [(1, "u", page), (2, "u", "<html><body><div><p>plain page</p></div></body></html>"), (3, None, None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp}/pages.parquet")
    out = {r.page_id: r for r in html.op3_html_extraction(spark, tmp).collect()}
    assert len(out) == 3 and out[3].text == "" and out[3].n_chars == 0
    assert out[1].text.startswith("A headline & more") and "Buy now" not in out[1].text and "The Site" not in out[1].text
