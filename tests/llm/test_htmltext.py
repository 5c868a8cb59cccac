import numpy as np
import pytest

from kilowatch.llm import htmltext
from kilowatch.llm.common import table
from kilowatch.llm.htmltext import blocks_of
from tests.conftest import SF_DIR
from tests.llm.fixtures import with_clashes

PAGES = "page_id long, url string, html string"


def said(page):
    return [b.text for b in blocks_of(page)]


def test_blocks_of_sloppy_pages():
    assert said(None) == said("") == said("<p></p><br> \n") == []
    assert said("<p><b>One.<br><p>Two&amp;three</p>four") == ["One.", "Two&three", "four"]
    assert said("<div>a <i>b</i>c<br>d\n\te</div>") == ["a bc d e"]
    assert said("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>") == ["a", "b", "c", "d", "e"]
    assert said("x<script>var t='</p>';</script>y<style>p{}</style><!-- z --><STYLE>q") == ["xy"]
    assert said("<p title='a>b' class=\"c\">d</p></div></p>e") == ["d", "e"]
    assert said("1 < 2 and &#x41;&eacute;&nbsp;&lt;p&gt;") == ["1 < 2 and Aé <p>"]
    assert said("<a href=x>one</a><custom-tag>two</custom-tag><p>three") == ["onetwo", "three"]
    assert said("<title>no</title><svg><text>no</text></svg><noscript>no</noscript>yes") == ["yes"]


def test_formulas_are_text():
    assert said("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold.</p>") == ["Let x=2 hold."]
    assert said("<p>a <math/>b</p><p>c <math><mi>x<p>d</math>e") == ["a b", "c x", "de"]
    assert said("<p><math><mtext>if <b>b</b></mtext><mspace/><mi>c</mi></math>d") == ["if bcd"]


def test_drawings_do_not_end_the_text():
    icon = "<svg viewBox='0 0 1 1'><title>t</title><g><path d='M0'/><text>no</text></g></svg>"
    for svg in (icon, "<svg/>", '<svg class="i" />', f"<svg>{icon}no</svg>", f"<svg><g>{icon}</g><text>no</text></svg>", "<svg><style/><title/><script/></svg>"):
        assert said(f"<p>a {svg}b</p><p>c</p>{icon}") == ["a b", "c"], svg
    assert said(f"<div><svg><path d=''></div><p>a</p>{icon}b") == ["a", "b"]
    assert said(f"<svg><g><article>a<p>b</article>c{icon}") == ["a", "b", "c"]
    assert said("<p>a<svg><path></p>b</svg>c") == ["a", "bc"] and said("<svg><path>no<span>a</span>b") == ["ab"]
    assert said("<svg>no<foreignObject><p>a</p></foreignObject>no</svg>b") == ["a", "b"]
    assert said(f"<svg><title>no</svg>a{icon}") == said(f"<svg><style>no</svg>a<p>{icon}") == ["a"]
    assert said("<svg><style><![CDATA[p>q{} <p>]]></style></svg>a<math><ms><![CDATA[x<y]]></ms></math>") == ["ax<y"]
    assert said("a<math><![CDATA[x<y>&lt;z]]></math>") == ["ax<y>&lt;z"]
    assert said("<svg>" + "<path> " * 30_000 + "<p>a") == ["a"]


def test_paths_and_links():
    first, second = blocks_of('<body class="x"><nav id="mainMenu"><a href="/">ab</a> cd</nav><div role=main class="post entry-content"><p>ef')
    assert first.path == ("<nav", "main", "menu", "<a") and first.linked == 2
    assert second.path == ("<div", "main", "post", "entry", "content", "<p")


def test_deep_and_long_pages():
    assert said("<div>" * 30_000 + "x") == ["x"]
    assert len(said("<p>y</p>" * 30_000)) == 30_000


def test_gradients():
    rng = np.random.default_rng(1)
    model, vectors = htmltext.Labeller(2), htmltext.Vectors()
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    pages = htmltext.training_pages(["some words here", "more of them."], 3, 1)
    blocks = [b for p, _ in pages for b in p]
    lengths, labels = np.array([len(p) for p, _ in pages]), np.concatenate([y for _, y in pages])
    v = vectors.of(blocks)

    def loss():
        s = model._states(model.embed(v), lengths) @ model.w["out"] + model.w["out.b"]
        return float(np.mean(np.log1p(np.exp(-np.where(labels > 0, s, -s)))))

    grads = model.gradients(v, lengths, labels)
    for name, g in grads.items():
        for _ in range(3):
            at = tuple(rng.integers(0, n) for n in g.shape)
            if name == "path":
                at = (int(rng.choice(v[0])), at[1])
            old = model.w[name][at]
            model.w[name][at] = old + 1e-3
            up = loss()
            model.w[name][at] = old - 1e-3
            down = loss()
            model.w[name][at] = old
            assert abs((up - down) / 2e-3 - g[at]) < 2e-3 + 0.05 * abs(g[at]), name


def article_of(page):
    end = page.rfind("</article>")
    return "\n".join(said(page[page.find("<article>") : end if end > 0 else len(page)]))


@pytest.fixture(scope="module")
def labeller(spark):
    return htmltext.train(table(spark, SF_DIR, "pages"))


def test_given_pages(spark, labeller):
    pages = table(spark, SF_DIR, "pages")
    got = {r["page_id"]: r for r in htmltext.main_text(pages, labeller).collect()}
    for r in pages.collect():
        assert got[r["page_id"]]["text"] == article_of(r["html"])
        assert got[r["page_id"]]["n_chars"] == len(article_of(r["html"])) and got[r["page_id"]]["url"] == r["url"]


def test_held_out_layouts(labeller):
    right = total = 0
    for blocks, labels in htmltext.training_pages(["Quite another text, of some length. It goes on.", "Short one.", "And words"], 300, 77):
        scores = labeller.scores(htmltext.Vectors().of(blocks), np.array([len(blocks)]))
        right, total = right + int(((scores > 0) == (labels > 0)).sum()), total + len(labels)
    assert right / total > 0.98


def test_parts_that_are_not_the_article(labeller):
    page = """<html><body><header class="site-header"><h1>Site</h1></header><div class="cookie-notice">We use cookies.</div>
    <nav><a href="/">Home</a></nav><div id="wrapper"><aside class="sidebar"><h3>Popular</h3><p>Other story here.</p></aside>
    <article><h1>The title</h1><p>First paragraph of the story.</p><div class="ad">Buy this now.</div><p>Ok.</p>
    <form class="newsletter"><p>Sign up for our letter</p><button>Go</button></form></article>
    <section id="comments"><h2>Comments</h2><div class="comment"><p>I liked this story very much.</p></div></section></div>
    <footer>All rights reserved.</footer></body></html>"""
    assert htmltext.Extractor(labeller).texts([page]) == ["The title\nFirst paragraph of the story.\nOk."]


def test_article_with_formulas_and_icons(labeller):
    page = """<html><body><nav><a href="/"><svg class="logo"/>Home</a></nav><article><h1>The <svg><path d="M0"></svg>title</h1>
    <p>First <math><mi>a</mi><mo>+</mo><mi>b</mi></math> of the story.</p><svg><circle r="1"><p>More of it here.</p></article>
    <footer><svg><text>no</text></svg>All rights reserved.</footer></body></html>"""
    assert htmltext.Extractor(labeller).texts([page]) == ["The title\nFirst a+b of the story.\nMore of it here."]


def test_batches_do_not_matter(labeller):
    pages = [None, "", "<article><p>a b c</p></article>", "<nav>" + "<p>x</p>" * 2000 + "</nav>"] * 3
    extractor = htmltext.Extractor(labeller)
    assert extractor.texts(pages) == [extractor.texts([p])[0] for p in pages]


def test_nulls_repeated_rows_and_empty_table(spark, labeller):
    rows = [(None, None, None), (1, "u", "<article>x</article>"), (1, "u", "<article>x</article>"), (2, None, "")]
    df = with_clashes(spark.createDataFrame(rows, PAGES), "text", "n_chars", "model")
    got = sorted(map(tuple, htmltext.main_text(df, labeller).collect()), key=str)
    assert got == sorted([(None, None, "", 0), (1, "u", "x", 1), (1, "u", "x", 1), (2, None, "", 0)], key=str)
    empty = spark.createDataFrame([], PAGES)
    assert htmltext.main_text(empty, labeller).collect() == []
    assert isinstance(htmltext.train(empty), htmltext.Labeller)
