import pytest

from tideglass.llm.extraction import extract_text, labelled_pages, main_text, train
from tideglass.llm.pages import leaf_blocks


@pytest.fixture(scope="module")
def field():
    return train(labelled_pages())


def blocks(html):
    return [b.text for b in leaf_blocks(html)]


def test_blocks_of_broken_and_whole_markup():
    assert blocks("<p>a <b>b</b>\n c<p>d&amp;e&nbsp;f<br>g</p><div>h<p>i</div>j") \
        == ["a b c", "d&e f g", "h", "i", "j"]
    assert blocks("<script>var t='</p><p>x';</script><style>p{}</style>x<!-- <p>no --> y") == ["x y"]
    assert blocks("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>1<td>2</table>") \
        == ["a", "b", "c", "1", "2"]
    assert blocks("a < b <p title=\"x>y\">c</q>d <!-- open <p>e") == ["a < b", "cd"]
    assert blocks(None) == blocks("") == blocks("<div>  \n</div>") == []
    assert blocks("<p>&#233;&eacute;&bogus;&lt;p&gt;") == ["éé&bogus;<p>"]
    assert blocks("<title>t</title><textarea>x") == []


def test_drawings_and_hidden_blocks_take_no_other_text():
    lost = "<article><p>lost text</p></article>"
    assert blocks(f'<body><svg class="i"/>{lost}</body>') == ["lost text"]
    assert blocks(f"<body><svg><path d=x>{lost}</body>") == ["lost text"]
    assert blocks("a<svg><title>t</title><text>x</text></svg>b<p>c <svg/>d") == ["ab", "c d"]
    assert blocks(f"<noscript><p>one</p></noscript>{lost}<template>two") == ["one", "lost text", "two"]
    assert blocks("<p>a<noscript><img src=x></noscript>b") == ["a", "b"]


def test_held_out_layouts(field):
    pages = labelled_pages(150, seed=77)
    wrong = sum(a != b for page, y in pages for a, b in zip(field.decode(page), y))
    assert wrong <= 0.02 * sum(len(y) for _, y in pages)


def test_common_page(field):
    html = """<html><head><title>t</title></head><body><nav><ul><li><a href=/>home</a></li></ul></nav>
      <div class="cookie-banner"><p>We use things.</p><button>ok</button></div>
      <div class="ad">Buy this now, it is good.</div>
      <article><h1>Title here</h1><p>First one, with words.</p><p>Second <a href=x>link</a> too.</p>
      </article><aside class=sidebar><h3>More</h3><ul><li><a href=y>other</a></li></ul></aside>
      <section id=comments><div class=comment><p>I like it, really.</p></div></section>
      <form><label>Name</label><input><button>Send</button></form>
      <footer>&copy; someone &middot; 2021</footer></body>"""
    assert main_text(html, field) == "Title here\nFirst one, with words.\nSecond link too."


def test_awkward_rows(spark, field):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, None, None, "x", "y"), (2, "u", "", "x", "y"), (None, "u", "<p>", None, None),
            (3, "u", "<article>" + "<p>word word, word.</p>" * 40_000, None, None),
            (4, "u", "<article><p>" + "w" * 1_000_000, None, None),
            (5, "u", "<div " + "a='" * 100_000, None, None)] * 2
    got = extract_text(spark.createDataFrame(rows, schema), field=field).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    assert by_id[1].text == by_id[2].text == by_id[None].text == "" and by_id[1].n_chars == 0
    assert by_id[3].text.count("\n") == 39_999 and by_id[4].n_chars == 1_000_000
    assert extract_text(spark.createDataFrame([], schema), field=field).count() == 0
