from tillcast.llm import extract

SCHEMA = "page_id long, url string, html string, text string, host string"


def text(html):
    page, kept, _ = extract.parse_page(html)
    return "\n\n".join(page.blocks[i].text for i in kept)


def test_article_without_surroundings():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body class="has sidebar">
    <header>Site</header><nav><ul><li><a href=/a>Menu</a></ul></nav><div class="ad">Buy</div><div id="cookie-notice">Cookies</div>
    <main><article class="post sidebar-left"><header><h1>Title &amp; more</h1></header><p><b>First<br>line&nbsp;x<p>Second <i>par</i>t
    <ul><li>one<li>two</ul><!-- <p>hidden</p> --><form>form</form><aside>side</aside><div class="comments"><p>reader</p></div>
    <blockquote>quote</blockquote><p hidden>h</p><div style="display: none">d</div><table><tr><td>a<td>b<tr><td>c</table>
    <script>"</article>"</script><p>End &lt;tag&gt; &#233;</p></article></main><footer>foot</footer>"""
    want = ["Title & more", "First line x", "Second part", "one", "two", "quote", "a b", "c", "End <tag> é"]
    assert text(page) == "\n\n".join(want)


def test_broken_pages_do_not_fail():
    for page in (None, "", "<", "<p", "</", "<!--", "<p class='x", "<script>", "a<b>c</p></div>", "<p>" * 3000, "<div>" * 3000 + "x", "&#xD800; &#0; &bogus;"):
        text(page)
    assert text("plain <b>words</b>") == "plain words"


def test_all_articles_and_main_beside_them_are_kept():
    page = "<body><nav>menu</nav><main><h1>Title</h1><p>Lead</p><article><p>Part one</p></article><article><p>Part two</p></article><p>End</p></main></body>"
    assert text(page) == "Title\n\nLead\n\nPart one\n\nPart two\n\nEnd"
    assert text("<article>One</article><div class=ad>Buy</div><article>Two</article>") == "One\n\nTwo"


def test_a_wrapper_does_not_win_over_the_article_in_it():
    for wrapper in ("form", "div class=menu-open", "div id=has-cookie-banner"):
        end = wrapper.split()[0]
        story = "<div class=sidebar><article>teaser</article></div><article><p>Story</p><form>login</form></article>"
        assert text(f"<body><{wrapper}>{story}</{end}></body>") == "Story"
        assert text(f"<main><h1>Title</h1><{wrapper}>{story}</{end}></main>") == "Title\n\nStory"
        assert text(f"<body><{wrapper}><p>Plain story of a page</p></{end}><p>x</p></body>") == "Plain story of a page\n\nx"
    assert text("<p>A story of some length</p><div class=sidebar>side</div>") == "A story of some length"


def test_what_recurs_beside_the_article_goes(spark):
    rows = []
    for i in range(8):
        more = "<section><p>Advert for all</p></section><article><p>Teaser for all</p></article>"
        rows.append((i, f"https://h.example/{i}", f"<main><h1>T{i}</h1><article><p>Story {i}</p><p>Quoted</p></article>{more}</main>", "", ""))
    got = extract.extract_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.text for r in got} == {f"T{i}\n\nStory {i}\n\nQuoted" for i in range(8)}


def test_recurring_subtrees_go_per_host(spark):
    shared = "<div><span>All rights kept</span><a href=/>Home</a></div>"
    rows = []
    for i in range(12):
        rows.append((i, f"https://one.example/p{i}", f"<body>{shared}<p>Own text number {i} of page</p><p>Quoted by all</p></body>"))
        rows.append((100 + i, f"https://user@two.example:80/p{i}", f"<body>{shared if i == 0 else ''}<article><h1>A{i}</h1><p>Quoted by all</p></article></body>"))
    rows += [(200 + i, "https://three.example/", f"<body>{shared}<p>copy</p></body>") for i in range(12)]
    rows += [(300, None, None), (301, "no url", ""), (301, "no url", "")]
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)
    got = {}
    for r in extract.extract_text(df).collect():
        got[r.page_id] = r.text
        assert r.n_chars == len(r.text)
    assert all(got[i] == f"Own text number {i} of page" for i in range(12))
    assert all(got[100 + i] == f"A{i}\n\nQuoted by all" for i in range(12))
    assert all("copy" in got[200 + i] and "All rights kept" in got[200 + i] for i in range(12))  # copies of one page count once
    assert got[300] == "" and got[301] == ""
    assert extract.extract_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_articles_of_the_test_table(spark, sf_small):
    pages = spark.read.parquet(f"{sf_small}/pages.parquet")
    docs = {" ".join(r.text.split()) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("text").collect()}
    rows = extract.extract_text(pages).collect()
    assert len(rows) == pages.count()
    found = sum(" ".join(r.text.split("\n\n", 1)[1].split()) in docs for r in rows)
    assert found == len(rows)


def test_the_size_of_a_host_does_not_change_a_page(spark):
    notice = "<div><p>Notice on few pages</p></div>"
    page = lambda i: (i, f"https://big.example/{i}", f"<body>{notice if i < 5 else ''}<p>Own text number {i}</p></body>", "", "")
    for n in (20, 700):
        rows = extract.extract_text(spark.createDataFrame([page(i) for i in range(n)], SCHEMA)).collect()
        assert {r.text for r in rows} == {f"Own text number {i}" for i in range(n)}


def test_names_that_tell_of_comments_keep_the_article():
    for wrapper in ('<div class="has-comments"><article>{}</article></div>', '<article class="post comments-open">{}</article>',
                    '<main class="page reply-on">{}</main>', '<div id="comments-wrap"><article>{}</article></div>'):
        assert text(f"<body><nav>menu</nav>{wrapper.format('<p>Story</p>')}<footer>f</footer></body>") == "Story"


def test_reader_comments_go():
    comments = "<section id=comments><article class=comment><p>a reader</p></article><ol class=commentlist><li>" + "words " * 40 + "</ol></section>"
    assert text(f"<article><p>Story</p>{comments}</article>") == "Story"
    assert text(f"<article><p>Story</p></article>{comments}") == "Story"
    assert text(f"<main><p>Story</p>{comments}</main>") == "Story"
    assert text(f"<body><p>Story</p>{comments}</body>") == "Story"
    assert text("<article><p>Story</p><div class=related-content><p>Related</p></div></article>") == "Story"


def plain_counts(pages, min_pages=4):
    """Subtrees by hand: every page's marks, counted on pages with different main text."""
    parsed = {i: (host, *extract.parse_page(html)) for i, (host, html) in pages.items()}
    seen = {(host, mark): set() for host, page, _, _ in parsed.values() for mark in (t.mark for t in page.subtrees)}
    for host, page, _, main in parsed.values():
        for t in page.subtrees:
            seen[host, t.mark].add(main)
    out = {}
    for i, (host, page, kept, _) in parsed.items():
        hits = [t for t in page.subtrees if len(seen[host, t.mark]) >= min_pages]
        covers = lambda t, k: t.first <= k < t.last and t.article in (extract.ANY, page.blocks[k].article)
        out[i] = "\n\n".join(page.blocks[k].text for k in kept if not any(covers(t, k) for t in hits))
    return out


def test_counting_equals_a_plain_version(spark):
    import random

    r = random.Random(2)
    parts = [f"<div><p>Part {k}</p><ul><li><a href=/>l{k}</a></ul></div>" for k in range(9)] + ["<nav>n</nav>", "<section><p>s</p><article><p>t</p></article></section>"]
    pages = {}
    for i in range(60):
        body = "".join(r.sample(parts, 4)) + f"<p>own {i % 40}</p>"
        pages[i] = (f"h{i % 3}.example", f"<main>{body}<article><p>story {i}</p>{r.choice(parts)}</article></main>" if i % 2 else body)
    frame = spark.createDataFrame([(i, f"https://{h}/{i}", p, "", "") for i, (h, p) in pages.items()], SCHEMA)
    got = {x.page_id: x for x in extract.extract_text(frame).collect()}
    assert {i: x.text for i, x in got.items()} == plain_counts(pages)
    assert sum(x.n_template for x in got.values()) > 60


def test_templates_of_a_made_up_host_are_deleted_by_counts(spark):
    page = lambda i: (i, f"https://x.example/{i}", f"<body><div class=q><p>Site words</p></div><nav>Menu</nav><article><p>Story {i}</p></article></body>", "", "")
    rows = extract.extract_text(spark.createDataFrame([page(i) for i in range(6)], SCHEMA)).collect()
    assert {(x.text, x.n_template) for x in rows} == {(f"Story {i}", 2) for i in range(6)}
    few = extract.extract_text(spark.createDataFrame([page(i) for i in range(3)], SCHEMA)).collect()
    assert {(x.text, x.n_template) for x in few} == {(f"Story {i}", 0) for i in range(3)}


def test_a_deep_page_stays_small(spark):
    import tracemalloc

    page = "<body>" + "<div>x" * 33_000 + "</body>"  # 200 KB, nested blocks
    tracemalloc.start()
    parsed, kept, _ = extract.parse_page(page)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(kept) == 33_000 and peak < 100 << 20
    trees = parsed.subtrees
    told = extract.without_templates(
        kept, [b.article for b in parsed.blocks], [b.text for b in parsed.blocks], [t.mark for t in trees], [t.first for t in trees],
        [t.last for t in trees], [t.article for t in trees], [t.mark for t in trees if t.first >= 20],
    )
    assert told == ("\n\n".join(["x"] * 20), 1)
