"""Page text against what the pages were made from."""

import random

import pytest

from orestrata.llm import templates

WORDS = "wort und über länger kurz thing the &amp; &lt;tag&gt; a&nbsp;b née".split(" ")
PLAIN = dict(zip(WORDS, "wort und über länger kurz thing the & <tag> a\xa0b née".split(" ")))


def sentence(dice, n=12):
    chosen = dice.choices(WORDS, k=dice.randint(3, n))
    return " ".join(chosen), " ".join(" ".join(PLAIN[w] for w in chosen).split())


def made_page(dice, kind, number):
    """A page of a site and its article's text."""
    title, said = sentence(dice, 6)
    paragraphs, texts = [], [said]
    for _ in range(dice.randint(1, 6)):
        raw, text = sentence(dice, 30)
        first, _, rest = raw.partition(" ")
        paragraphs.append(dice.choice([f"<p>{raw}</p>", f"<p><b>{first}</b>\n {rest}", f"<p>{first}<br>{rest}</p>"]))
        texts.append(text)
    inner = f"<h1>{title}</h1>" + "".join(paragraphs)
    menu = "<nav><ul>" + "".join(f'<li><a href="/{k}">{sentence(dice, 3)[0]}</a>' for k in range(dice.randint(2, 5))) + "</ul></nav>"
    notes = "".join(f'<div class="comment"><p>{sentence(dice)[0]}</p></div>' for _ in range(dice.randint(0, 4)))
    extra = f'<div class="ad">{sentence(dice)[0]}</div>' if dice.random() < 0.3 else ""
    head = f"<!DOCTYPE html><html><head><title>{title}</title><script>var t='</p>';track({number})</script><style>p>b{{}}</style></head><body>"
    foot = f"<footer>&copy; {number} Site</footer>" + ("</body></html>" if dice.random() < 0.8 else "")
    if kind == "article":
        body = f'<header><p>Our site</p></header>{menu}<!-- x --><article>{inner}{extra}</article><section id="comments">{notes}</section>'
    elif kind == "main":
        body = f'<div role="banner">Our site</div>{menu}<main>{inner}<form><label>Mail</label><input></form></main><aside>{sentence(dice)[0]}</aside>'
    else:
        body = f"<div id='top'>Our site welcomes all of you</div>{menu}<div id='c{number}'>{inner}</div><div>Call us now, or write to us</div>{notes}"
    return head + body + foot, " ".join(texts)


@pytest.fixture(scope="module")
def site():
    dice = random.Random(7)
    rows = []
    for host, kind, n in (("a.example", "article", 40), ("b.example", "main", 25), ("c.example", "plain", 30), ("d.example", "article", 1)):
        for _ in range(n):
            page, text = made_page(dice, kind, len(rows))
            rows.append((len(rows), f"https://{host}/x/{len(rows)}?q=1", page, text))
    return rows


def test_articles_of_sites(spark, site):
    frame = spark.createDataFrame(site, "page_id bigint, url string, html string, wanted string").repartition(7)
    found = {r.page_id: r for r in templates.extracted(frame).collect()}
    for number, url, _, text in site:
        assert (found[number].url, found[number].text, found[number].n_chars) == (url, text, len(text))
    made = {r.host: r for r in templates.templates(frame).collect()}
    assert [made[h].marked for h in ("a.example", "b.example", "c.example")] == [True, True, False]
    assert made["a.example"].main == ["html>body>article"] and made["a.example"].n == 40
    assert made["c.example"].main == ["html>body>div.c0"] and "d.example" not in made


def test_query_equals_reading_the_article_element(spark):
    import html
    import re

    from orestrata.llm.queries import QUERIES

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    found = {r.page_id: r.text for r in QUERIES["op11_page_text"](spark, "/root/testdata/sf0.001").collect()}
    for row in pages.collect():
        body = re.search("<article>(.*?)</article>", row.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1|br)>", body))
        assert found[row.page_id] == " ".join(b for b in blocks if b)
    assert len(found) == pages.count()


def test_odd_pages(spark, none):
    long = "<article>" + "<p>wort &amp; so" * 50_000 + "</article>"
    rows = [
        (1, "http://h/1", None),
        (2, None, "<article><p>eins</article>"),
        (3, "no url", "plain < text"),
        (4, "http://h/1", ""),
        (4, "http://h/1", ""),
        (None, "http://h/2", "<main><p>zwei<nav>no</nav></main>"),
        (5, "http://h/3", long),
        (6, "http://h/4", "<div>" * 3000 + "tief"),
        (7, "http://h/5", "<!-- never closed <p>x"),
        (8, "http://h/6", '<a "' * 20_000),
        (9, "http://h/7", "<p>a<b>b<i>c</p><p>d"),
    ]
    frame = spark.createDataFrame([(*r, "clash", 3, True) for r in rows], "page_id bigint, url string, html string, text string, n int, marked boolean")
    found = sorted(((r.page_id or 0, r.text, r.n_chars) for r in templates.extracted(frame).collect()))
    texts = {1: "", 2: "eins", 3: "plain < text", 4: "", 0: "zwei", 5: "wort & so " * 49_999 + "wort & so", 6: "tief", 7: "", 8: "", 9: "abc d"}
    assert found == sorted((r[0] or 0, texts[r[0] or 0], len(texts[r[0] or 0])) for r in rows)
    assert templates.extracted(frame.where("1 = 0")).count() == 0


def test_repeated_articles_stay(spark):
    """Copies of one article on all pages of a host are no template."""
    page = "<html><body><nav>Menu of it</nav><article><h1>Same</h1><p>every page says this</p></article></body></html>"
    frame = spark.createDataFrame([(k, "http://h.example/", page) for k in range(30)], "page_id bigint, url string, html string")
    assert {r.text for r in templates.extracted(frame).collect()} == {"Same every page says this"}
