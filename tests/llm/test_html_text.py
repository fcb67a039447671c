import random

from sparkprep.llm import html_text as H

SCHEMA = "page_id bigint, url string, html string"


def run(spark, rows):
    return {r.page_id: r.text for r in H.extract_main_text(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_main_text_by_markup(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>x";</script></head>
    <body><header>Site</header><nav><ul><li><a href=x>Home</a></ul></nav><div class="ad big">Buy</div>
    <article><header><h1>A &amp; B</h1></header><p><b>One.<br>two<br><p class="x">Three &lt;3&nbsp; &copy</p><!-- no --><form>F</form>
    <div id="comments"><p>troll</p></div><p>Four &#233; 1 < 2</article><aside>S</aside><footer>F</footer></body></html>"""
    assert run(spark, [(1, "http://h/a", page)]) == {1: "A & B\n\nOne. two\n\nThree <3 ©\n\nFour é 1 < 2"}


def test_truncated_and_empty_pages(spark):
    rows = [(1, "http://h/a", "<body><article><p>One two</p><p>Thr"), (2, "http://h/b", "<article><p>x &am"), (3, None, None), (4, "u", ""),
            (5, "http://z/", "plain < text"), (6, "http://y/", "<article><script>if (a<b) {"), (7, "http://x/", "<p")]
    assert run(spark, rows) == {1: "One two\n\nThr", 2: "x &am", 3: "", 4: "", 5: "plain < text", 6: "", 7: ""}


def test_scripts_and_layout_words(spark):
    pages = ["<script>if (a<b) x('</p>');</script><article><p>kept</p><script>for(i=0;i<n;i++)</script><p>too</article>",
             "<!-- <script> --><article>a<!-- > --> b</article><!-- </article>",
             "<body><div class='page has-sidebar'><div class='sidebar'>S</div><article class='post'><div class=\"post-header\"><h1>T</h1></div>"
             "<p title=\"a > b\">x</p><div class='share-buttons'>f</div></article></div>",
             "<div class='menu'>m</div><div role=main><p>one</div><p>two",
             "<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><blockquote>q</blockquote>e</article>",
             "<ARTICLE><P>UP &amp;amp; &#x41;&hellip;</P><BR/>x<IMG src=a>y</ARTICLE>"]
    got = run(spark, [(i, f"http://h{i}/", p) for i, p in enumerate(pages)])
    assert got == {0: "kept\n\ntoo", 1: "a b", 2: "T\n\nx", 3: "one", 4: "a\n\nb\n\nc\n\nd\n\nq\n\ne", 5: "UP &amp; A…\n\nxy"}


NOTICE = "all our texts are free to read for everyone but not to copy or sell"


def test_repeated_runs_go_and_unique_runs_stay(spark):
    rows = [(i, "http://Host:80/%d" % i, f"<body><div>{NOTICE}</div><div>item{i} says only word{i}</div><div>{NOTICE} ok{i}</div><p>short</p></body>")
            for i in range(5)]
    rows.append((9, "http://other/", f"<div>{NOTICE}</div>"))
    got = run(spark, rows)
    assert got[9] == NOTICE
    assert got[2] == "item2 says only word2\n\nok2"


def test_groups_of_a_host_are_compared_with_each_other(spark, monkeypatch):
    rnd = random.Random(3)
    word = lambda: "w%d" % rnd.randrange(40)
    shared = [[word() for _ in range(rnd.randint(10, 18))] for _ in range(6)]
    pages = {}
    for i in range(40):
        tokens = []
        for _ in range(rnd.randint(1, 6)):
            tokens += rnd.choice(shared) if rnd.random() < 0.5 else [word() for _ in range(rnd.randint(1, 8))]
        pages[i] = tokens
    have = {}
    for i, t in pages.items():
        for s in range(len(t) - H.REPEAT + 1):
            have.setdefault(tuple(t[s:s + H.REPEAT]), set()).add(tuple(t))
    want = {}
    for i, t in pages.items():
        hit = set()
        for s in range(len(t) - H.REPEAT + 1):
            if len(have[tuple(t[s:s + H.REPEAT])]) >= H.PAGES:
                hit.update(range(s, s + H.REPEAT))
        want[i] = " ".join(x for k, x in enumerate(t) if k not in hit)
    assert sum(w != " ".join(pages[i]) for i, w in want.items()) > 5
    rows = [(i, "http://h/%d" % i, "<div>" + " ".join(t) + "</div>") for i, t in pages.items()]
    for tokens in (20_000, 60):
        monkeypatch.setattr(H, "GROUP_TOKENS", tokens)
        assert run(spark, rows) == want


def test_mirrored_pages_count_once_and_phrases_stay(spark):
    """The same text under many addresses is one page; phrases shorter than a long repeat stay."""
    same = "<div>" + " ".join(f"m{i}" for i in range(60)) + "</div>"
    rows = [(i, "http://h/%d" % i, same) for i in range(6)]
    rows += [(10 + i, "http://h/x%d" % i, f"<div>a{i} on the other side of the town hall b{i} c{i}</div>") for i in range(5)]
    got = run(spark, rows)
    assert all(got[i] == " ".join(f"m{k}" for k in range(60)) for i in range(6))
    assert got[12] == "a2 on the other side of the town hall b2 c2"


def test_side_elements_within_a_block_are_cut_out_where_they_stand():
    got = H.blocks("<article>Important text <span class='ad'>buy <div>now</div></span><p>one <span class='ad'>BUY</span> two "
                   "<button>Share</button><b>three</b></p></article>")
    assert [t for k, t in got if k == H.MAIN] == ["Important text", "one two three"]
    assert [t for k, t in got if k == H.SIDE] == ["buy", "now", "BUY Share"]


def test_compound_names_are_not_side_words_anywhere():
    for page in ("<div class='content header-image'>text</div>", "<div id='related-work-study'>text</div>", "<div class='page has-sidebar'>text</div>"):
        assert H.blocks(page) == [(H.OPEN, "text")]


def test_time_of_a_page_grows_with_its_length():
    import time

    page = "<article><b>" + "<span>" * 60_000 + "text" + "</b>" * 60_000 + "<p>" * 20_000 + "</i>" * 20_000 + "end"
    begin = time.process_time()
    assert [t for _, t in H.blocks(page + " word" * 100_000)][0] == "text"
    assert len(page) > 700_000 and time.process_time() - begin < 10


def plain_close(stack, name):
    """What an end tag leaves open, by a search from the last element."""
    for depth in range(len(stack) - 1, -1, -1):
        if stack[depth] == name:
            return stack[:depth]
        if stack[depth] in ("article", "main") and name not in H.SCOPES:
            break
    return stack


def plain_end(stack, name):
    for depth in range(len(stack) - 1, -1, -1):
        if stack[depth] == name:
            return stack[:depth]
        if stack[depth] in H.SCOPES:
            break
    return stack


def test_counts_find_what_a_search_finds():
    rnd = random.Random(9)
    names = ["p", "li", "td", "b", "span", "div", "article", "main", "ul", "table"]
    for _ in range(300):
        opened, stack = H._Open(), []
        for _ in range(60):
            name, what = rnd.choice(names), rnd.random()
            if what < 0.5:
                opened.push(name, False, 0, False)
                stack = [*stack, name]
            elif what < 0.8:
                opened.close(name)
                stack = plain_close(stack, name)
            else:
                opened.implied_end(name)
                stack = plain_end(stack, name)
            assert [e[0] for e in opened.stack] == stack


def test_repeated_rows_and_empty_table(spark):
    html = "<div>one two three four five six seven</div>"
    got = H.extract_main_text(spark.createDataFrame([(1, "http://h/", html)] * 2 + [(None, "http://g/", html)], SCHEMA)).collect()
    assert sorted(r.text for r in got) == ["one two three four five six seven"] * 3
    assert H.extract_main_text(spark.createDataFrame([], SCHEMA)).collect() == []
    clash = spark.createDataFrame([(1, "http://h/", html, "x", 1)], SCHEMA + ", HTML string, host int")
    assert [r.text for r in H.extract_main_text(clash).collect()] == ["one two three four five six seven"]


def test_side_words_inside_the_main_text_name_the_whole_class():
    kept = ["<section id='related-work'>a</section>", "<h2 id='social-history'>b</h2>", "<div class='login-flow'>c</div>",
            "<p class='promotion-rules'>d</p>", "<section id='related'>e</section>", "<h3 id=notice>f</h3>"]
    gone = ["<div class='share-buttons'>x</div>", "<div class='big ad'>x</div>", "<div id='comments'>x</div>",
            "<div class='comment-12'>x</div>", "<ul class='related_posts'><li>x</ul>", "<div class=cookie-banner>x</div>"]
    page = "<article>" + "".join(kept + gone) + "</article><div class='login-flow'>x</div>"
    got = H.blocks(page)
    assert [t for k, t in got if k == H.MAIN] == list("abcdef")
    assert [t for k, t in got if k != H.MAIN] == ["x"] * 7


def test_open_text_beside_a_teaser_article_stays(spark):
    notice = NOTICE
    rows = [(i, "http://h/%d" % i, f"<div>first{i} text{i}</div><article class=card><p>teaser</p></article><div>{notice}</div><div>real{i} text{i}</div>")
            for i in range(4)]
    rows.append((9, "http://h/9", "<div>open</div><main><p>whole</p><article>and more</article></main>"))
    got = run(spark, rows)
    assert got == {**{i: f"first{i} text{i}\n\nteaser\n\nreal{i} text{i}" for i in range(4)}, 9: "whole\n\nand more"}


def article(rnd, i, notice, extra=""):
    words = lambda n: " ".join("w%d" % rnd.randrange(5000) for _ in range(n))
    return f"<article><h1>T{i}</h1><p>{words(20)}</p><p>{notice}</p>{extra}<p>{words(30)}</p></article>"


def test_the_array_decides_main_text_too(spark, monkeypatch):
    """A notice that a host's articles have goes; lines that fewer share, mirrors and small hosts stay."""
    rnd = random.Random(5)
    line = "a line of fourteen words that half of the articles of this host do share"
    rows = [(i, "http://h/%d" % i, article(rnd, i, NOTICE, f"<p>{line}</p>" if i % 2 else "<p>Summary</p>")) for i in range(40)]
    rows += [(100 + i, "http://few/%d" % i, article(rnd, i, NOTICE)) for i in range(H.TEXTS - 1)]
    near = " ".join("m%d" % k for k in range(60))
    rows += [(200 + i, "http://mirror/%d" % i, f"<article><p>{near}</p><p>copy {i}</p></article>") for i in range(20)]
    markup = {i: "\n\n".join(t for k, t in H.blocks(p) if k >= H.MAIN) for i, _, p in rows}
    want = {i: t.replace(NOTICE + "\n\n", "") if i < 100 else t for i, t in markup.items()}
    for texts in (64, 16, 1):
        monkeypatch.setattr(H, "GROUP_TEXTS", texts)
        monkeypatch.setattr(H, "GROUP_LEAST", min(texts, 16))
        assert run(spark, rows) == want


def test_the_array_decides_main_text_beside_open_text(spark):
    rnd = random.Random(6)
    rows = [(i, "http://h/%d" % i, article(rnd, i, NOTICE)) for i in range(20)]
    rows += [(20 + i, "http://h/o%d" % i, f"<div>open{i}</div>" + article(rnd, i, NOTICE)) for i in range(3)]
    got = run(spark, rows)
    assert not any(NOTICE in t for t in got.values())
    assert got[21].startswith("open1\n\nT1\n\nw") and got[3].startswith("T3\n\nw")


def test_groups_of_few_main_texts_are_dealt_again(spark):
    """Pages that differ beside their main text only."""
    rnd = random.Random(7)
    texts = [article(rnd, i, NOTICE) for i in range(12)]
    rows = [(i, "http://h/%d" % i, f"<nav>n{i}</nav>" + texts[i % 12]) for i in range(600)]
    got = run(spark, rows)
    assert len(got) == 600 and not any(NOTICE in t for t in got.values()) and all(t.startswith("T") for t in got.values())


def test_hosts_of_few_texts_hand_no_windows_on(spark):
    """A crawl of small hosts writes no window of their texts."""
    rnd = random.Random(8)
    rows = [(i, f"http://h{i % 40}/{i}", article(rnd, i, NOTICE)) for i in range(80)]
    pages = H._with_host(spark.createDataFrame(rows, SCHEMA))
    found = H._arrays(H._main_streams(pages), pages.select("host").distinct().selectExpr("host", "1L AS groups")).collect()
    assert len(found) == 40 and all(r.n == 2 and not r.windows for r in found)
    assert run(spark, rows)[5].count(NOTICE) == 1
