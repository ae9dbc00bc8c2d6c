"""Main text of pages: templates, slots, awkward markup."""
import re

from tramline.llm import wrapper

DDL = "page_id long, url string, html string"


def texts(spark, pages):
    rows = [(k, u, h) for k, (u, h) in enumerate(pages)]
    got = wrapper.extract(spark.createDataFrame(rows, DDL)).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) and r.url == rows[r.page_id][1] for r in got)
    return {r.page_id: r.text for r in got}


def page(k, body):
    return (f"https://h.example/{k}", f"<html><head><title>T{k}</title><style>x</style></head><body>{body}</body></html>")


def test_constant_nodes_are_template_and_slots_are_content(spark):
    pages = [page(k, f"<div id=top>Same motto</div><div class=menu><ul><li>Home {k}<li>News</ul></div>"
                     f"<div id=text><h1>Title {k}</h1><p>Words of {k} &amp; more<p>Second&nbsp; {k}</div>"
                     f"<div>Always the same line</div><div class='site-footer'>c {k}</div>") for k in range(4)]
    assert texts(spark, pages) == {k: f"Title {k}\nWords of {k} & more\nSecond {k}" for k in range(4)}


def test_article_with_everything_around(spark):
    body = ("<!-- c --><header>Head {k}</header><nav><a href=/>N {k}</a></nav><main><article><header><h1>H {k}</h1></header>"
            "<p>A <b>b</b>\n c<br>d {k}</p><script>if (a<b) '</p>'</script><aside>side {k}</aside><p>Z&#233; {k}</p>"
            "<form>Mail {k}<input></form></article><section class=comments><p>Reader {k}</p></section></main>"
            "<div class='cookie-notice'>Cookies {k}</div><footer>Foot {k}</footer>")
    pages = [page(k, body.format(k=k)) for k in range(3)]
    assert texts(spark, pages) == {k: f"H {k}\nA b c d {k}\nZé {k}" for k in range(3)}


def test_copies_and_single_pages_keep_their_text(spark):
    one = page(1, "<article><p>Only text</p></article>")
    got = texts(spark, [one, one, ("http://other.example/", "<p>Alone</p>"), (None, "<article>No url</article>")])
    assert got == {0: "Only text", 1: "Only text", 2: "Alone", 3: "No url"}


def test_awkward_markup(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    got = texts(spark, [
        ("http://a/", None), ("http://b/", ""), ("http://c/", "plain < text > &am"), ("http://d/", "<p>cut <b>off"),
        ("http://e/", "<p>x</div></p></article><p class=\"q>broken"), ("http://f/", deep), ("no url", "<p> \n </p>"),
        ("http://g/", "<script>never ends"), ("http://h/", "<article><p>" + "long " * 50_000 + "</p></article>"),
        ("http://i/", "<body class='page no-sidebar'><p>Kept</p></body>"),
        ("http://j/", "<h1 title=it's>Head</h1><p>one</p><p title=it's>two</p>"),
        ("http://k/", "<script data-x=it's>var secret=1;</script><p>one</p>"),
        ("http://l/", "<p title = 'a > b' lang=\"x>y\">three</p><p class=5\"tall>four</p>")])
    assert got[0] == got[1] == got[6] == got[7] == "" and got[2] == "plain < text > &am" and got[3] == "cut off"
    assert got[4].startswith("x") and got[5] == "deep" and got[8] == ("long " * 50_000).strip() and got[9] == "Kept"
    assert got[10] == "Head\none\ntwo" and got[11] == "one" and got[12] == "three\nfour"


def test_shapes_that_differ_align(spark):
    pages = [page(k, "<div class=lead>Buy now</div>" * (k % 2) + f"<div class=story><h2>T {k}</h2>"
                  + f"<p>Line {k}</p><blockquote>Q {k}</blockquote>" * (1 + k % 3) + "</div>") for k in range(6)]
    got = texts(spark, pages)
    assert got == {k: "\n".join([f"T {k}"] + [f"Line {k}", f"Q {k}"] * (1 + k % 3)) for k in range(6)}


def test_sample_pages_against_a_plain_reading(spark):
    import html
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1]
        blocks = (re.sub(r"<[^>]*(?:>|\Z)", lambda m: " " if m[0].startswith("<br") else "", x)
                  for x in re.split(r"</?(?:p|h1)[^>]*>", inner))
        want[r.page_id] = "\n".join(b for b in (" ".join(html.unescape(x).split()) for x in blocks) if b)
    assert {r.page_id: r.text for r in wrapper.extract(pages).collect()} == want


def test_empty_table(spark):
    assert wrapper.extract(spark.createDataFrame([], DDL)).count() == 0


def test_layouts_of_one_host_keep_their_own_text(spark):
    old = [page(k, f"<div class=text><h1>Old {k}</h1><p>Body of old page {k}</p></div>") for k in range(3)]
    new = [page(k, f"<div>Unlabelled {k}</div><article><h1>New {k}</h1><p>Body of new page {k}</p></article>")
           for k in range(3, 6)]
    none = [(None, f"<article><p>Article {k}</p></article>" if k % 2 else f"<div><p>Block {k}</p></div>") for k in range(6)]
    got = texts(spark, old + new + none)
    assert got == ({k: f"Old {k}\nBody of old page {k}" for k in range(3)}
                   | {k: f"New {k}\nBody of new page {k}" for k in range(3, 6)}
                   | {6 + k: f"{'Article' if k % 2 else 'Block'} {k}" for k in range(6)})


def test_headline_and_lead_beside_a_long_body_stay(spark):
    long = " and so on" * 40
    pages = [page(k, f"<div class=top><h1>Headline {k}</h1><p>Lead of {k}</p></div>"
                     f"<div class=body><p>Body {k}{long}</p></div>") for k in range(4)]
    assert texts(spark, pages) == {k: f"Headline {k}\nLead of {k}\nBody {k}{long}" for k in range(4)}


def test_copies_of_an_article_under_varying_boilerplate_keep_it(spark):
    around = "<nav>Menu {k}</nav><div class=ad>Buy {k}</div><span>May {k}</span>{x}<footer>F {k}</footer>"
    article = "<article><h1>Title</h1><p>Words of the article</p></article>"
    plain = "<div><h1>Title</h1><p>Words of the only article</p><blockquote>Cited words</blockquote></div>"
    copies = [page(k, around.format(k=k, x=article)) for k in range(8)]
    other = [(f"http://plain.example/{k}", around.format(k=k, x=plain)) for k in range(8)]
    # a branch of the template that only copies of one article have
    branch = [(f"http://branch.example/{k}", around.format(k=k, x=f"<article><p>Story {k}</p></article>" if k < 8 else
               "<article><p>Story 9</p><blockquote>Said once</blockquote></article>")) for k in range(12)]
    got = texts(spark, copies + other + branch)
    assert {got[k] for k in range(8)} == {"Title\nWords of the article"}
    assert all(got[8 + k].endswith("Title\nWords of the only article\nCited words") for k in range(8))
    assert {got[16 + k] for k in range(8, 12)} == {"Story 9\nSaid once"} and got[16] == "Story 0"
