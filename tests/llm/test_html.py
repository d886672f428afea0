import html as entities
import json
import re

from tarnlake.llm.html import Node, _nodes, align, extract_main_text, fold, infer_wrappers, merge_wrappers, page_text, parse, render, stream

SCHEMA = "page_id long, url string, html string, text int"


def page(body, title="t"):
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style></head><body>{body}</body></html>"


def plain(html):
    """The article of the driver's pages by regular expressions."""
    inner = html.split("<article>")[1].split("</article>")[0]
    parts = [re.sub(r"\s+", " ", entities.unescape(re.sub(r"<[^>]*>", "", x))).strip() for x in re.split(r"</?(?:p|h1|br)>", inner)]
    return "\n".join(x for x in parts if x)


def test_table(spark, tiny):
    pages = spark.read.parquet(f"{tiny}/pages.parquet")
    for r in extract_main_text(pages).collect():
        assert r.text == plain(r.html) and r.n_chars == len(r.text) > 0


def test_furniture_goes(spark):
    junk = (
        "<header><h2>Site</h2></header><nav><ul><li><a href='/'>Home</a><li>About</ul></nav><script>if (a<b) { '</p>' }</script>"
        "<div class='cookie-notice'>We use cookies</div><!-- <p>no</p> -->"
    )
    tail = "<aside>More</aside><form><input value=x>Search</form><div id=comments><p>First!</p></div><footer>&copy; x</footer>"
    body = "<main><h1>Ti&eacute;&amp tle</h1><p>One &lt;b&gt; <b>two</b>\n three<p>Four<br>five<ul><li>a<li>b</ul><div class='ad'>Buy</div>{}</main>"
    rows = [(i, f"http://h{i % 2}.com/{i}", page(junk + body.format(f"<p>Nr {i}</p>") + tail), 0) for i in range(6)]
    rows += [(10, "http://h0.com/x", None, 0), (11, None, "", 0), (12, None, "just & text", 0), (13, "http://h1.com/y", page("<p>No main</p>" + tail), 0)]
    rows += [(14, "http://h1.com/z", "<p>cut <b", 0), (15, "http://deep.com/", "<div>" * 5000 + "deep", 0)]
    got = {r.page_id: r for r in extract_main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i in range(6):
        assert got[i].text == f"Tié& tle\nOne <b> two three\nFour\nfive\na\nb\nNr {i}"
    assert got[10].text == "" and got[11].text == "" and got[12].text == "just & text"
    assert got[13].text == "No main" and got[14].text.startswith("cut") and got[15].text == "deep"
    assert got[0].n_chars == len(got[0].text)
    assert extract_main_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_wrapper_by_mass_without_main(spark):
    def make(i):
        text = f"Story {i} goes on and on about something of its own. " * 5
        return page(
            f"<div class=top><a href=/>all stories of the site</a></div><div class=body>Share this<p>{text}</p><p>{text}</p><div>Write to us</div></div>"
            f"<ul><li><a href=/{i}>next {i}</a></ul><div class=low>Same words</div>"
        )

    df = spark.createDataFrame([(i, "http://x.org/", make(i), 0) for i in range(5)], SCHEMA)
    w = infer_wrappers(df).first()
    assert "(<p>#</>)+" in w.expression
    nodes = _nodes(w.wrapper).order
    assert nodes[w.region].key == "div.body" and "div.top" in {nodes[n].key for n in w.menus}
    assert {nodes[n].parent.key for n in w.fixed} >= {"div.low", "div", "div.body"} and {nodes[n].key for n in w.fixed} <= {"#", "@"}
    for r in extract_main_text(df).collect():
        assert r.text.count("\n") == 1 and "stories" not in r.text and "Share" not in r.text and "Same" not in r.text and "next" not in r.text


def test_equal_rows_are_no_evidence_of_template(spark):
    body = page("<p>Tagline</p><article><h1>A</h1><p>Some text of it, long enough to be the text.</p></article>")
    for n in (1, 2, 3, 7):
        df = spark.createDataFrame([(i, "http://x.org/", body, 0) for i in range(n)], SCHEMA)
        assert {r.text for r in extract_main_text(df).collect()} == {"A\nSome text of it, long enough to be the text."}


def test_ids_of_pages_and_layout_marks(spark):
    def make(i, lack=False):
        tag = "section" if lack else "article"
        text = " ".join(f"word{i}x{j}" for j in range(40))
        return page(
            f"<div id=top-{i}>Site {i}</div><{tag} id=post-{i} class='post has-sidebar post-{i}'><h1>T {i}</h1><p>{text}</p></{tag}><div>Low {i}</div>"
        ), f"T {i}\n{text}"

    made = [(i, *make(i, i % 7 == 6)) for i in range(200)]
    df = spark.createDataFrame([(i, "http://x.org/", h, 0) for i, h, _ in made], SCHEMA)
    got = {r.page_id: r.text for r in extract_main_text(df).collect()}
    assert got == {i: want for i, _, want in made}
    assert len(infer_wrappers(df).first().wrapper) < 2000


def test_depth_and_length(spark):
    deep = "<div>" * 160 + "<nav>MENU</nav><p>body</p>" + "</div>" * 160
    rows = [(1, "http://a.org/", page(deep), 0), (2, "http://b.org/", "<b>" * 20000 + "x" + "<div>" * 20000 + "y", 0)]
    rows += [(3, "http://c.org/", page("<p>para &amp; more</p>" * 30000), 0), (4, "http://d.org/", "<li>" * 5000 + "z", 0)]
    got = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1] == "body" and got[2] == "x\ny" and got[4] == "z"
    assert got[3] == "\n".join(["para & more"] * 30000)


def test_many_streams_of_one_host(spark):
    """More streams than one group holds, so that wrappers merge in rounds."""

    def make(i):
        marks = "".join(f"<div class=k{'abcdefghij'[d]}>s</div>" for d in range(10) if i >> d & 1)
        return page(f"{marks}<main><p>Text number {i} of the host and more words</p></main>")

    df = spark.createDataFrame([(i, "http://x.org/", make(i), 0) for i in range(300)], SCHEMA)
    assert infer_wrappers(df).count() == 1
    assert all(r.text == f"Text number {r.page_id} of the host and more words" for r in extract_main_text(df).collect())


def test_clashing_columns(spark):
    names = ["host", "wrapper", "region", "fixed", "row", "_host", "text", "n_chars"]
    df = spark.createDataFrame([(1, "http://a.org/", "<p>hi")], "page_id long, url string, html string")
    df = df.selectExpr("*", *[f"'{n}!' AS {n}" for n in names])
    r = extract_main_text(df).first()
    assert r.text == "hi" and r.n_chars == 2 and all(r[n] == f"{n}!" for n in names[:-2])


def test_alignment_finds_optional_and_repeated():
    a = stream(parse("<div><h1>A</h1><p>x</p><p>y</p></div>"))
    b = stream(parse("<div><h1>B</h1><h2>s</h2><p>x</p></div>"))
    assert render(["", False, False, align(a, b)]) == "<div><h1>#</>(<h2>#</>)?(<p>#</>)+</>"
    pairs = stream(parse("<dl><dt>a<dd>b<dt>c<dd>d</dl>"))
    assert render(["", False, False, pairs]) == "<dl>(<dt>#</>)+(<dd>#</>)+</>"
    merged = merge_wrappers([json.dumps(a), json.dumps(b)])
    assert merged == merge_wrappers([json.dumps(b), json.dumps(a), json.dumps(a)])
    assert fold([]) == [] and merge_wrappers([]) == "[]"


def test_long_lists_align():
    a = [[f"k{i % 3000}", False, False, []] for i in range(3000)]
    b = a[5:] + [["z", False, False, []]]
    out = align(a, b)
    assert len(out) == 3001 and out[0][1] and not out[10][1] and out[-1][1]


def test_main_text_blocks():
    assert page_text("<div> a <span>b</span>\n<p>c</div>d") == "a b\nc\nd"
    assert page_text(None) == page_text("") == page_text("<p> </p>") == ""
    assert page_text("<div class=sidebar>all there is</div>") == "all there is"


def test_pages_match_by_position():
    """Optional, repeated and required items of one key are told apart by place."""
    wrapper = [["div", True, False, [["@", False, False, []]]], ["div", False, False, [["h1", False, False, []]]], ["p", True, True, []], ["ul", True, True, []], ["div", True, False, []]]
    node = Node.build(wrapper)
    at = lambda *keys: [x and node.items.index(x) for x in node.match(list(keys))]
    assert at("div", "div", "div") == [0, 1, 4] and at("div") == [1] and at("div", "p", "ul", "p", "div") == [1, 2, 3, 2, 4]
    assert at("p", "p") == [2, 2] and at("section", "div") == [None, 1] and at() == [] and at("div.x", "p.y") == [1, 2]
    assert Node.build([]).match(["div"]) == [None]


def unmarked(i, deep=0):
    """A page of plain elements: a menu, a lead that all pages share, a text."""
    links = "".join(f"<a href=/{i}/{j}>Part {i} {j} of the site</a> " for j in range(12))
    lead = "The paper of the whole town and its valley, read by all who live here since the old days. " * 4
    text = f"On day {i} this and that went on in the town, as {i} people told us in words of their own. " * 4
    body = f"<div>{links}</div><div>{lead}</div><div><h1>Day {i}</h1><p>{text}</p></div><div>All rights kept, write to the editor of the paper</div>"
    return page("<div>" * deep + body + "</div>" * deep), f"Day {i}\n{text.strip()}"


def test_the_wrapper_decides(spark):
    """Without it such pages are read wrongly, with it rightly, nested deep too."""
    for deep in (0, 5, 65):
        made = [(i, *unmarked(i, deep)) for i in range(12)]
        assert all(page_text(html) != want for _, html, want in made)
        df = spark.createDataFrame([(i, "http://town.org/", html, 0) for i, html, _ in made], SCHEMA)
        assert {r.page_id: r.text for r in extract_main_text(df).collect()} == {i: want for i, _, want in made}


def test_articles_keep_their_text(spark):
    """Sections named like furniture, linked references and equal sentences."""

    def make(i):
        body = f"<section class=related-work><p>Work of others, {i}, told at length.</p></section><section id=search-methods><p>How we looked, {i}.</p></section>"
        refs = "<div>" + "".join(f"<a href=/r{j}>Reference {j}</a> " for j in range(6)) + "</div>"
        return page(f"<nav>x</nav><article><h1>T{i}</h1><p>A sentence that opens every text.</p>{body}{refs}<div class=related-posts>Read next</div><div id=comments>Nice!</div></article>")

    df = spark.createDataFrame([(i, "http://lab.org/", make(i), 0) for i in range(6)], SCHEMA)
    refs = " ".join(f"Reference {j}" for j in range(6))
    for r in extract_main_text(df).collect():
        i = r.page_id
        assert r.text == f"T{i}\nA sentence that opens every text.\nWork of others, {i}, told at length.\nHow we looked, {i}.\n{refs}"
    assert page_text("<article><section class='related-work'><p>body</p></section></article>") == "body"
