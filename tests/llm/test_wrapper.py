"""Wrapper induction."""

from tillroll.llm import wrapper

PAGE = "page_id long, url string, html string"


def content(source):
    """Blocks of a page without what its tags and names exclude."""
    return [b["text"] for b in wrapper.choose(wrapper.blocks_of(wrapper.skeleton(wrapper.parse(source))))]


def test_blocks_of_a_page():
    assert content("<p>a  b\n c<br>d &amp; e</p><p><b>x</b>y<p>z") == ["a b c d & e", "xy", "z"]
    assert content("<div>one<div>two</div>three</div><ul><li>a<li>b</ul>") == ["one", "two", "three", "a", "b"]
    assert content("<script>var t='</p>';</script><style>p{}</style><title>t</title>x") == ["x"]
    assert content("<nav>menu</nav><article><h1>T</h1><p>text</p><div class='comments'><p>hi</p></div></article>") == [
        "T",
        "text",
    ]
    assert content("<p>cut in a tag <a href='x") == ["cut in a tag"]
    assert content("a < b and c > d") == ["a < b and c > d"]
    assert content("<p>&lt;b&gt; caf&eacute; &#8364; &unknown;</p>") == ["<b> café € &unknown;"]
    assert content("<!-- a --><p>b</p><!-- unclosed") == ["b"]
    assert content(None) == [] and content("") == []
    assert content("<div>" * 500 + "deep" + "</div>" * 500 + "<p>after</p>") == ["deep", "after"]


def test_skeleton_round_trip():
    s = wrapper.skeleton(wrapper.parse("<div class=a><p>1</p><p>2</p><ul><li>3</li></ul></div><div class=b>4</div>"))
    assert s.text == "page(div.a(p)(ul(li)))(div.b)"
    assert wrapper.read_skeleton(s.text) == (s.labels, s.children)


def brute_match(a, b, i=0, j=0):
    (la, ca), (lb, cb) = a, b
    if la[i] != lb[j]:
        return 0
    def best(x, y):
        if x == len(ca[i]) or y == len(cb[j]):
            return 0
        return max(best(x + 1, y), best(x, y + 1), brute_match(a, b, ca[i][x], cb[j][y]) + best(x + 1, y + 1))
    return best(0, 0) + 1


def test_simple_tree_matching():
    shapes = ["p(a)(b(c))(d)", "p(b(c)(x))(d)(a)", "p(a(b)(c))(a(c))", "q", "p"]
    for x in shapes:
        for y in shapes:
            a, b = wrapper.read_skeleton(x), wrapper.read_skeleton(y)
            found = wrapper.match_trees(a, b)
            assert len(found) == brute_match(a, b)
            assert all(a[0][i] == b[0][j] for i, j in found.items())


def site(i, extra="", box=True):
    notice = "<div class='box'>Members only offer</div>" if box else ""
    return (
        f"<html><body><div class='top'>Site name</div>{notice}<div class='text'><p>story {i} begins here</p>"
        f"<p>and goes on {i * 7}</p></div>{extra}<div class='end'>All rights reserved</div></body></html>"
    )


def test_constant_nodes_go_and_slots_stay(spark):
    """No semantic markup: only the comparison of a host's pages tells."""
    rows = [(i, f"http://h.example/{i}", site(i, box=i % 3 > 0)) for i in range(12)]
    rows += [(50, "http://lone.example/x", site(50)), (51, None, None), (52, "no url", "")]
    out = {r.page_id: r.text for r in wrapper.extract_pages(spark.createDataFrame(rows, PAGE)).collect()}
    for i in range(12):
        assert out[i] == f"story {i} begins here\nand goes on {i * 7}"
    assert "story 50 begins here" in out[50] and "Site name" in out[50]  # one page has no template
    assert out[51] == out[52] == ""


def test_menus_of_links_go(spark):
    links = "".join(f"<a href='/{k}'>link {k} of page %d</a> " for k in range(5))
    rows = [(i, f"http://m.example/{i}", site(i, f"<div class='x'>{links % ((i,) * 5)}</div>")) for i in range(8)]
    out = {r.page_id: r.text for r in wrapper.extract_pages(spark.createDataFrame(rows, PAGE)).collect()}
    assert out[3] == "story 3 begins here\nand goes on 21"


def test_repeated_articles_stay_content(spark):
    """A declared slot keeps its text even where every page has the same."""
    page = "<body><div>Site</div><article><h1>T</h1><p>same story</p></article></body>"
    rows = [(i, "http://c.example/", page) for i in range(9)]
    frame = spark.createDataFrame(rows, PAGE).selectExpr("*", "'z' as host", "1 as node", "'q' as text")
    out = wrapper.extract_pages(frame).collect()
    assert [r.text for r in out] == ["T\nsame story"] * 9
    assert wrapper.extract_pages(spark.createDataFrame([], PAGE)).count() == 0


def test_template_blocks_inside_articles_go(spark):
    """Notices and link lists repeat inside the declared slot; a page that is
    copied over and over keeps its story."""
    links = "".join(f"<li><a href='/{k}'>more {k}</a></li>" for k in range(6))

    def page(i):
        return (
            f"<body><article><h1>Title {i}</h1><p>story {i} begins</p><p>Please sign up today.</p><p>it ends {i}</p>"
            f"<div class='box'><p>All offers</p></div><ul>{links}</ul></article></body>"
        )

    rows = [(i, "http://n.example/", page(i)) for i in range(8)]
    rows += [(100 + i, "http://n.example/", page("again")) for i in range(30)]
    out = {r.page_id: r.text for r in wrapper.extract_pages(spark.createDataFrame(rows, PAGE)).collect()}
    for i, k in [(i, i) for i in range(8)] + [(100 + i, "again") for i in range(30)]:
        assert out[i] == f"Title {k}\nstory {k} begins\nit ends {k}"


def test_story_outside_a_teaser_article_stays(spark):
    def page(i):
        story = f"<p>{f'a long story of page {i} ' * 12}</p><p>and its end {i}</p>"
        return f"<body><div class='top'>Site</div><article><p>teaser {i}</p></article><div class='s'>{story}</div></body>"

    rows = [(i, "http://t.example/", page(i)) for i in range(6)]
    out = {r.page_id: r.text for r in wrapper.extract_pages(spark.createDataFrame(rows, PAGE)).collect()}
    assert out[4] == f"teaser 4\n{('a long story of page 4 ' * 12).strip()}\nand its end 4"


def test_words_in_names_are_a_prior_only():
    story = "<h1 class='entry-header'>T</h1><p>text</p>"
    for page in (
        f"<div class='layout has-sidebar'><article>{story}</article></div>",
        f"<main id='skip-target'>{story}</main>",
        f"<article class='post no-comments'>{story}</article>",
        f"<div class='content-side-left'>{story}</div>",
        f"<body class='page-header-fixed'><div class='page-header-fixed'>{story}</div></body>",
        f"<div class='sidebar'><article>{story}</article></div>",
        f"<app-page class='menu'><main>{story}</main></app-page>",
        f"<article>{story}<div class='comments'><article class='comment'><p>hi</p></article></div></article>",
        f"<article>{story}</article><div class='related'><article><p>other</p></article></div>",
        f"<article>{story}</article><div class='ad'>buy</div><nav id='x'>menu</nav>",
    ):
        assert content(page) == ["T", "text"], page


def test_roles_hold_at_any_depth():
    deep, end = "<div>" * 90, "</div>" * 90
    assert content(f"{deep}<p>text</p><nav>menu</nav><aside>x</aside><div class='ad'>buy</div>{end}") == ["text"]
    for inner in (f"{deep}<article><p>text</p></article>{end}", "<b>" * 90 + "<article><p>text</p></article>"):
        s = wrapper.skeleton(wrapper.parse(f"<p>other</p>{inner}"))
        assert [b[3] for b in s.blocks if b[2] == wrapper.DECLARED] == ["text"]
    s = wrapper.skeleton(wrapper.parse("<div>" * 5000 + "text"))
    assert wrapper.read_skeleton(s.text) == (s.labels, s.children) and len(s.labels) == 5001
    assert len(wrapper.match_trees((s.labels, s.children), (s.labels, s.children))) == 5001


def host(spark, page, count=8):
    rows = [(i, f"http://six.example/{i}", page(i)) for i in range(count)]
    return {r.page_id: r.text for r in wrapper.extract_pages(spark.createDataFrame(rows, PAGE)).collect()}


def words_of(i, kind, n):
    return " ".join(f"{kind}{(i * 31 + k * 7) % 997}" for k in range(n))


def test_long_slot_beside_an_article_stays(spark):
    def page(i):
        return (
            f"<body><div class='top'>Site name</div><article><p>{words_of(i, 'a', 70)}</p></article>"
            f"<div class='body'><p>{words_of(i, 'story', 90)}</p></div><div class='day'>day {i}</div></body>"
        )

    assert host(spark, page)[3] == f"{words_of(3, 'a', 70)}\n{words_of(3, 'story', 90)}"


def test_the_only_article_may_be_a_comment(spark):
    def page(i):
        return (
            f"<body><div class='content'><p>{words_of(i, 'story', 60)}</p></div>"
            f"<article class='comment'><p>{words_of(i, 'said', 30)}</p></article></body>"
        )

    assert host(spark, page)[2] == words_of(2, "story", 60)


def test_names_do_not_take_the_longest_slot(spark):
    def shared(i):
        return f"<body><div class='day'>day {i}</div><div class='post share'><p>{words_of(i, 'story', 60)}</p></div></body>"

    assert host(spark, shared)[5] == f"day 5\n{words_of(5, 'story', 60)}"

    def data_names(i):
        return f"<body><article><div data-role=search data-id=ad><p>{words_of(i, 'story', 9)}</p></div></article></body>"

    assert host(spark, data_names)[5] == words_of(5, "story", 9)


def test_a_long_advert_beside_a_short_article_goes():
    advert = f"<div class='ad'>{words_of(1, 'buy', 40)}</div>"
    assert content(f"<nav>x</nav>{advert}<article><h1>T</h1><p>short</p></article>") == ["T", "short"]
    assert content(f"<article><h1>T</h1><div class='post share'><p>{words_of(1, 'story', 9)}</p></div></article>{advert}") == [
        "T", words_of(1, "story", 9)]


def test_comments_and_boxes_inside_an_article_go(spark):
    def page(i):
        many = "".join(f"<div class='c'><p>{words_of(i + k, 'said', 40)}</p></div>" for k in range(i))
        return (
            f"<body><article><h1 class='entry-header'>Title {i}</h1><p>{words_of(i, 'story', 50)}</p>"
            f"<div class='newsletter-box'><p>join {words_of(i, 'n', 5)}</p></div>"
            f"<div class='reader-comments'>{many}</div><div class='comments-area'><p>{words_of(i, 'r', 8)}</p></div>"
            f"<p class='share-price'>end {i}</p></article></body>"
        )

    out = host(spark, page)
    for i in range(8):
        assert out[i] == f"Title {i}\n{words_of(i, 'story', 50)}\nend {i}"


def test_unclosed_quote_leaves_no_markup():
    assert content('<p title="abc>first</p><p>second</p>') == ["first", "second"]
    assert content("<div class='x><p>a</p></div>") == ["a"]


def plain_extract(pages):
    """{page_id: text} of hosts without declared slots or names, by comparing
    the texts at equal paths page by page."""
    import re
    from collections import defaultdict

    held = {}
    for page_id, source in pages:
        stack, blocks, count = [], [], defaultdict(int)
        for tag in re.findall(r"<(/?)(\w+)(?: class='(\w+)')?>|([^<>]+)", source):
            ends, name, cls, text = tag
            if text:
                blocks.append((tuple(stack), text))
            elif ends:
                stack.pop()
            else:
                stack.append(f"{name}.{cls}")
        held[page_id] = blocks
    texts = defaultdict(lambda: defaultdict(set))
    for page_id, blocks in held.items():
        own = defaultdict(list)
        for path, text in blocks:
            own[path].append(text)
        for path, found in own.items():
            texts[path]["\n".join(found)].add(page_id)
    lost = set()
    for path, found in texts.items():
        seen = sum(map(len, found.values()))
        if seen >= wrapper.LEAST_PAGES and max(map(len, found.values())) >= wrapper.CONSTANT_SHARE * seen:
            lost.add(path)
    return {i: "\n".join(t for path, t in blocks if path not in lost) for i, blocks in held.items()}


def test_hosts_equal_a_plain_comparison(spark):
    """Pages of one shape in random templates: wrapper against a comparison of
    all texts by path."""
    import random

    rng = random.Random(8)
    rows, want = [], {}
    for h in range(5):
        names = [f"k{c}" for c in rng.sample("abcdefgh", 6)]
        fixed = [rng.random() < 0.5 for _ in names]
        pages = []
        for i in range(rng.randrange(4, 12)):
            parts = [
                f"<div class='{c}'><p>{'template ' + c if f else words_of(100 * h + i, c, rng.randrange(1, 30))}</p></div>"
                for c, f in zip(names, fixed)
            ]
            pages.append((100 * h + i, f"<html><body>{''.join(parts)}</body></html>"))
        rows += [(i, f"http://h{h}.example/{i}", source) for i, source in pages]
        want |= plain_extract(pages)
    got = {r.page_id: r.text for r in wrapper.extract_pages(spark.createDataFrame(rows, PAGE)).collect()}
    assert got == want


def test_very_long_pages_and_ties(spark):
    story = words_of(1, "w", 120_000)
    rows = [(1, "http://l.example/1", f"<article><p>{story}</p></article>" + "<div>" * 2000), (2, "x", "<p>aa</p><div class='ad'>bb</div>")]
    out = {r.page_id: r.text for r in wrapper.extract_pages(spark.createDataFrame(rows, PAGE)).collect()}
    assert out[1] == story and out[2] == "aa"
