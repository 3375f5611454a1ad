from sedimenta.llm.html_blocks import blocks, extract_text, main_text

ARTICLE = "The cat is on the mat and it was there for all of us, because that is what it does when the sun is out."


def test_article_without_the_rest():
    page = f"""<!DOCTYPE html><html lang=en><head><title>No</title><style>p{{}}</style><script>var t="</p><p>no</p>";</script></head>
    <body><header>Site</header><nav><ul><li><a href=/a>a</a></ul></nav><!-- <p>no</p> --><div class="ad">{ARTICLE}</div>
    <div id="cookie-notice">We use cookies</div><form action=/><input name=q><button>Go</button></form>
    <article><header><h1>A  heading</h1></header><p>First &amp; <b>bold</b>&nbsp;text<br>goes on</p><p>Short.
    <aside>no</aside><p>Last &lt;p&gt;</p><div class="comments"><p>{ARTICLE}</p></div><footer>no</footer></article>
    <div class="sidebar">no</div><footer>&copy; no</footer></body></html>"""
    assert main_text(page) == "A heading\nFirst & bold text goes on\nShort.\nLast <p>"


def test_names_of_wrappers_do_not_lose_the_article():
    article = f"<article><p>{ARTICLE}</p></article>"
    rest = f"<div class='sidebar'><p>{ARTICLE}</p></div>"
    for body in ("single has-sidebar", "no-sidebar", "layout-sidebar-right", "nav-closed", "page noSidebar", "sidebar"):
        assert main_text(f"<html class='{body}'><body id=top class='{body}'>{article}{rest}</body></html>") == ARTICLE
        assert main_text(f"<body><div class='{body}'>{article}</div>{rest}</body>") == ARTICLE
    for own in ("hentry comments-open", "post tag-social", "sponsored"):
        assert main_text(f"<body><article class='{own}'><p>{ARTICLE}</p></article>{rest}</body>") == ARTICLE
        assert main_text(f"<body><main class='{own}'><p>{ARTICLE}</p></main>{rest}</body>") == ARTICLE
    plain = f"<body class='no-sidebar'><div><p>{ARTICLE}</p></div>{rest}</body>"
    assert main_text(plain) == ARTICLE


def test_articles_of_comments_and_sidebars_are_no_main_text():
    for name in ("comments", "related", "sidebar sidebar-open", "cookie-notice active", "sidebar-with-ads"):
        page = f"<article><p>{ARTICLE}</p></article><div class='{name}'><article><p>{ARTICLE} no</p></article></div>"
        assert main_text(page) == ARTICLE
        inside = f"<article><p>{ARTICLE}</p><div class='{name}'><article><p>{ARTICLE} no</p></article></div></article>"
        assert main_text(inside) == ARTICLE
    assert main_text(f"<div hidden><article><p>{ARTICLE}</p></article></div>") == ""


def test_pages_that_do_not_mark_their_article():
    page = f"<div><a href=1>Home</a> <a href=2>News</a></div><p>{ARTICLE}<p>Short.<p>{ARTICLE}<p>© 2020 Somebody"
    assert main_text(page) == f"{ARTICLE}\nShort.\n{ARTICLE}"
    listing = "<p>Lorem ipsum dolor sit amet consectetur adipiscing elit sed eiusmod tempor incididunt labore</p><p>x</p>"
    assert main_text(listing) == ""


def test_short_blocks_follow_the_nearest_decided_one():
    links = " ".join(f"<a href={i}>Link number {i} here</a>" for i in range(9))
    page = f"<article><p>{ARTICLE}</p><p>near good</p><p>{links}</p><p>near bad</p><p>{links}</p></article>"
    assert main_text(page) == f"{ARTICLE}\nnear good"


def test_letters_that_grow_in_lower_case_do_not_shift_raw_ends():
    for n in (1, 20, 500):
        page = f"<article><p>{'İ' * n} {ARTICLE}</p><SCRIPT>var a = '<p>no</p>';</Script ><p>{ARTICLE}</p></article>"
        assert main_text(page) == f"{'İ' * n} {ARTICLE}\n{ARTICLE}"


def test_unquoted_addresses_that_end_with_a_slash_are_links():
    listed = "".join(f"<li><a href=/tag/{i}/>Things about number {i} and more of them</a></li>" for i in range(9))
    assert main_text(f"<article><p>{ARTICLE}</p><ul>{listed}</ul></article>") == ARTICLE
    assert main_text(f"<article><p>{ARTICLE}<br/>{ARTICLE}<img src=x/ />!</p></article>") == f"{ARTICLE} {ARTICLE}!"


def test_stray_quotes_end_with_their_tag():
    for tag in ('<p title="it"s">', "<p title='it's'>", '<p a"b>', '<p title="x" ">', "<p data-x=a'b>"):
        assert main_text(f"<article>{tag}{ARTICLE}</p><p>{ARTICLE} \"</p></article>") == f'{ARTICLE}\n{ARTICLE} "'
    assert main_text(f"<article><p title = 'a>b' alt=\"c>d\">{ARTICLE}</p></article>") == ARTICLE


def test_paragraphs_and_headings_with_links_stay_in_their_article():
    linked = f"<p>See <a href=1>{ARTICLE}</a> and <a href=2>{ARTICLE}</a></p>"
    page = f"<article><h2><a href=0>A heading that is a link</a></h2>{linked}<h3>Next</h3><p>{ARTICLE}</p></article>"
    assert main_text(page) == f"A heading that is a link\nSee {ARTICLE} and {ARTICLE}\nNext\n{ARTICLE}"


def test_very_long_pages_take_time_in_proportion():
    import time

    start = time.perf_counter()
    assert len(main_text("<p>short" * 100_000)) == 0
    text = main_text("<article>" + f"<p>{ARTICLE}" + "<p>short" * 100_000)
    assert text.count("\n") == 100_000 and time.perf_counter() - start < 20


def test_second_pass_equals_a_search_by_distance():
    import random

    from sedimenta.llm.html_blocks import Block, second_pass

    rng = random.Random(3)
    for _ in range(300):
        found = [Block(rng.randrange(3), rng.random() < 0.2) for _ in range(rng.randrange(12))]
        labels = [rng.choice([True, False, None, None]) if not b.bad else False for b in found]
        want = []
        for i, label in enumerate(labels):
            d = 1
            while label is None and d < len(labels):
                near = [
                    labels[j]
                    for j in (i - d, i + d)
                    if 0 <= j < len(labels) and labels[j] is not None and not found[j].bad and found[j].main == found[i].main
                ]
                label, d = any(near) if near else None, d + 1
            want.append(found[i].main > 0 if label is None else label)
        assert second_pass(found, labels) == want


def test_broken_markup():
    assert main_text("<article><p>a < b and c<p>d</i></div>e <b>f") == "a < b and c\nd\ne f"
    assert main_text("<article><p>cut off &am") == "cut off &am"
    assert main_text("<article><p>open <script>never closed <p>x") == "open"
    assert main_text("<article><p title='a>b'>x</p><p hidden>no</p><p style='display: none'>no</p>") == "x"
    for page in (None, "", " ", "<", "<!--", "<p", "</p>", "<article></article>", "&", "<script>"):
        assert main_text(page) in ("", "<", "<p", "&")
    assert [b.text for b in blocks("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>")] == ["a", "b", "c", "d"]
    assert len(main_text("<article>" + "<div>" * 20_000 + "deep")) == 4
    assert main_text("<article><p>" + "<b " * 50_000) != "x"


def test_table_of_odd_pages(spark):
    rows = [(1, None, None, 0), (2, "u", "", 1), (None, "v", "<article><p>é 😀</p>", 2), (2, "u", "<article><p>x</p>", 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    got = sorted(map(tuple, extract_text(df).collect()), key=repr)
    want = [(1, None, "", 0), (2, "u", "", 0), (None, "v", "é 😀", 3), (2, "u", "x", 1)]
    assert got == sorted(want, key=repr)
    assert extract_text(df.limit(0)).collect() == []


def test_query_against_the_articles_of_the_pages(spark):
    import html
    import re

    from sedimenta.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in QUERIES["op9_html_blocks"](spark, sf).collect():
        article = re.search("<article>(.*?)</article>", pages[r.page_id].html, re.S).group(1)
        parts = [html.unescape(re.sub("<[^>]*>", "", p)) for p in re.split("</?p>|</?h1>", article)]
        want = "\n".join(" ".join(p.split()) for p in parts if p.strip())
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, want, len(want))
