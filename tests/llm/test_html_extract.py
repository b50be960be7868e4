from collections import Counter
from html.parser import HTMLParser

from tributary.llm.html_extract import extract, main_text, parse, template_candidates


def text_of(page, template=frozenset()):
    return main_text(parse(page), template)


def test_blocks_references_and_white_space():
    page = "<html><head><title>T</title></head><body><p>A &amp; b&nbsp;c\n  d<br>e<p>Second&#33; <b>bo</b>ld<ul><li>x<li>y</ul></body></html>"
    assert text_of(page) == "A & b c d e\n\nSecond! bold\n\nx\n\ny"


def test_furniture_goes():
    page = (
        "<body><header>Site</header><nav>Home</nav><div class='cookie-banner'>We use</div><article><header><h1>Head</h1></header><p>Body</p>"
        "<script>var a='<p>no</p>'</script><style>p{}</style><!-- <p>no</p> --><div class=comments><p>reader</p></div><form>f</form></article>"
        "<aside>side</aside><footer>foot</footer></body>"
    )
    assert text_of(page) == "Head\n\nBody"


def test_broken_pages():
    for page in ("", "<", "<p", "text only", "<p>open <b>never closed", "</div></p>x", "<script>never closed", "<a href='x>y", "<!-- open", "<p>a<table><tr><td>b<td>c"):
        text_of(page)
    assert text_of("text only") == "text only" and text_of("") == "" and text_of("<p>a<table><tr><td>b<td>c") == "a\n\nb\n\nc"
    assert text_of("<div>" * 5000 + "deep") == "deep"


def test_recurring_subtrees_are_template(spark):
    pages = [(i, f"https://a.test/{i}", f"<body><div>Buy our things now</div><div><p>Text number {i} of many</p></div><div>All rights reserved here</div></body>") for i in range(6)]
    pages += [(10, "https://b.test/", "<body><div>Buy our things now</div></body>"), (11, None, None), (12, "::odd", ""), (10, "https://b.test/", "<body><div>Buy our things now</div></body>")]
    rows = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, host string")
    got = extract(rows).collect()
    assert len(got) == len(pages)
    by = {r.page_id: r for r in got}
    assert [by[i].text for i in range(6)] == [f"Text number {i} of many" for i in range(6)]
    assert by[10].text == "Buy our things now" and by[10].n_chars == 18 and by[11].text == "" and by[12].n_chars == 0
    assert extract(rows.limit(0)).count() == 0


def test_article_is_never_a_template_candidate():
    root = parse("<body><article><p>The article text</p></article><div>Furniture here</div></body>")
    from tributary.llm.html_extract import hash_subtrees

    hash_subtrees(root)
    assert len(template_candidates(root)) == 1


def test_the_join_gives_what_the_broadcast_gives(spark, monkeypatch):
    from tributary.llm import html_extract

    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    wanted = sorted(map(tuple, extract(rows).collect()))
    monkeypatch.setattr(html_extract, "BROADCAST_BYTES", -1)
    assert sorted(map(tuple, extract(rows).collect())) == wanted and len(wanted) == rows.count()


def test_furniture_within_articles_is_template(spark):
    box, author = "<div class='x1'>Tell your friends about us</div>", "<section><p>Ann writes for this site since long ago</p></section>"
    passage = "<p>A passage that many of the articles share</p>"
    page = lambda i, tag: f"<body><{tag}><h2>What we found</h2><p>Text number {i} of many, longer than the boxes that stand around it</p>{passage}{box}{author}</{tag}></body>"
    pages = [(i, "https://a.test/", page(i, "article")) for i in range(6)] + [(10 + i, "https://b.test/", page(i, "main")) for i in range(6)]
    # one article at many addresses, its date aside
    mirrored = "<h1>Head</h1><div><p>The first part of one article</p></div><div><p>The second part of one article</p></div><div><p>The third part of one article</p></div><div><p>The fourth part, last of one article</p></div>"
    pages += [(20 + i, "https://c.test/", f"<body><article><time>{i} May</time>{mirrored}</article></body>") for i in range(8)]
    # a box of a section of a site, on fewer than the share of its pages
    pages += [(100 + i, "https://d.test/", f"<body><article><p>Text number {i} of many, longer than the box that stands below it</p>{box if i < 110 else ''}</article></body>") for i in range(400)]
    by = {r.page_id: r.text for r in extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for k in (0, 10):
        assert [by[k + i] for i in range(6)] == [f"What we found\n\nText number {i} of many, longer than the boxes that stand around it\n\nA passage that many of the articles share" for i in range(6)]
    assert by[20].split("\n\n") == ["0 May", "Head", "The first part of one article", "The second part of one article", "The third part of one article", "The fourth part, last of one article"]
    assert not any("friends" in by[100 + i] for i in range(400)) and by[499].startswith("Text number 399")


def test_ids_of_headings_and_paragraphs_are_no_marks_within_articles():
    assert text_of("<article><h2 id='related-work'>Related work</h2><p id=comments>On it</p><p class=share>Share</p></article>") == "Related work\n\nOn it"
    assert text_of("<body><p id=cookie-notice>We use</p><p>Text</p></body>") == "Text"


def test_article_text_that_looks_like_furniture_stays():
    page = "<main><p>Lead</p><article><div id='related-work'>Related work</div><p class=search-results>Results of the search</p><p>Let <math><mi>x</mi></math> be</p></article><p>After</p></main>"
    assert text_of(page) == "Lead\n\nRelated work\n\nResults of the search\n\nLet x be\n\nAfter"
    assert text_of("<article><p title=it's>one</p><p>it's two</p><p>three</p></article>") == "one\n\nit's two\n\nthree"
    assert text_of("<article><p title = 'a>b' alt=\"c>d\" x=>one</p></article>") == "one"


def test_templates_equal_plain_counts(spark):
    import random
    from collections import defaultdict

    from tributary.llm import html_extract as h

    rng, boxes = random.Random(5), [f"<div>Box number {i} of the site</div>" for i in range(12)]
    pages = []
    for i in range(60):
        own = "".join(rng.sample(boxes[: rng.choice((3, 12))], 2))
        pages.append((i, f"https://h{i % 3}.test/{i}", f"<body>{own}<article><p>Text {i // 2} of the article, which is longer than its boxes are</p>{rng.choice(boxes[:2])}</article><footer>All rights reserved</footer></body>"))
    rows = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("parse_url(url, 'HOST') AS host", "html")
    got = {r.host: set(r.hashes) for r in h.site_templates(rows).collect()}
    seen = defaultdict(set)
    for _, url, page in pages:
        root = h.parse(page)
        h.hash_subtrees(root)
        host = url.split("/")[2]
        own = h.template_candidates(root).union(*map(h.article_candidates, h._mains(root)))
        own |= {(h.PAGES, rest) for node, _, rest in h._surroundings(root) if node is root}
        for mark, rest in own:
            seen[host, mark].add(rest)
    wanted = defaultdict(set)
    for (host, mark), rests in seen.items():
        total = len(seen[host, h.ARTICLES if mark < 0 else h.PAGES])
        least = min(h.TEMPLATE_SHARE * total, max(h.SECTION_PAGES, h.SECTION_SHARE * total))
        if mark not in (h.PAGES, h.ARTICLES) and len(rests) >= max(h.TEMPLATE_PAGES, least):
            wanted[host].add(mark)
    assert got == dict(wanted) and any(m < 0 for m in got["h0.test"]) and any(m > 0 for m in got["h0.test"])


def test_notices_within_articles():
    """A box of a notice goes; a paragraph or a run of the text that is marked as one stays."""
    page = "<body><article><p>One</p><div class='notice'><p>Mind this</p></div><p class=notice>Two</p><p>Three <span class=disclaimer>four</span></p><div class='related'>Five</div></article></body>"
    assert text_of(page) == "One\n\nTwo\n\nThree four\n\nFive"


class Plain(HTMLParser):
    """The article of a page by the standard library's parser: blocks between block tags, nothing of scripts and styles."""

    def __init__(self, page):
        super().__init__()
        self.blocks, self.line, self.depth, self.skipped = [], [], 0, 0
        self.feed(page)
        self.close()
        self.flush()

    def flush(self):
        text = " ".join("".join(self.line).split())
        self.blocks += [text] if text else []
        self.line = []

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skipped += 1
        if tag in ("article", "p", "h1", "h2", "ul", "li", "div", "footer"):
            self.flush()
        self.depth += tag == "article"
        self.line += [" "] if tag == "br" and self.depth else []

    def handle_endtag(self, tag):
        if tag in ("article", "p", "h1", "h2", "ul", "li", "div", "footer"):
            self.flush()
        self.skipped -= tag in ("script", "style")
        self.depth -= tag == "article"

    def handle_data(self, data):
        if self.depth and not self.skipped:
            self.line.append(data)


def test_pages_equal_a_plain_extractor_and_lose_no_character_to_counts_alone(spark):
    """On the given pages: as the standard library's parser has the article; without tags' and classes' meanings the counts find it too."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = pages.select("page_id", "url", "html").collect()
    wanted = {r.page_id: "\n\n".join(Plain(r.html or "").blocks) for r in rows}
    assert {r.page_id: r.text for r in extract(pages).collect()} == wanted
    found = {r.page_id: r.text for r in extract(pages, known=False).collect()}
    hosts = Counter((r.url or "").split("/")[2] for r in rows)
    often = [r for r in rows if hosts[r.url.split("/")[2]] >= 4]
    assert len(often) > 100 and sum(found[r.page_id] == wanted[r.page_id] for r in often) > 0.95 * len(often)
    assert all(wanted[r.page_id] in found[r.page_id] for r in rows)


def test_furniture_is_found_by_its_skeleton_alone(spark, monkeypatch):
    from tributary.llm import html_extract

    word = lambda i, k: f"word{i * 31 + k}x"
    def page(i):
        text = "".join(f"<p>Passage {k} of text {i}, " + " ".join(word(i, k + n) for n in range(12)) + ".</p>" for k in range(3 + i % 4))
        links = "".join(f"<li><a href='/{i}{k}'>{word(i, k)}</a></li>" for k in range(5))
        return (
            f"<body><div class=x1><ul>{links}</ul></div><div class=x2>Buy {word(i, 1)} and {word(i, 2)}</div><h1>Title of {i}</h1>"
            f"<div class=c{i}><div class=lead>Lead of {i}</div>{text}<section class=x3>{links}</section><ul><li>First of {i}</li><li>Second</li></ul></div><div class=x4>{word(i, 3)} rights reserved</div></body>"
        )
    def text(i):
        passages = [f"Passage {k} of text {i}, " + " ".join(word(i, k + n) for n in range(12)) + "." for k in range(3 + i % 4)]
        return "\n\n".join([f"Title of {i}", f"Lead of {i}", *passages, f"First of {i}", "Second"])
    pages = [(i, "https://a.test/", page(i)) for i in range(12)] + [(100, "https://b.test/", page(3)), (101, "https://c.test/", None), (102, "https://c.test/", "")]
    rows = spark.createDataFrame(pages, "page_id long, url string, html string")
    by = {r.page_id: r.text for r in extract(rows).collect()}
    assert [by[i] for i in range(12)] == [text(i) for i in range(12)]
    assert "rights reserved" in by[100] and by[101] == by[102] == ""
    monkeypatch.setattr(html_extract, "drop_furniture", lambda root, found: None)
    assert all("rights reserved" in html_extract.main_text(parse(h or ""), {1}) for _, _, h in pages[:13])
