import pytest

from leadlens.llm import html_text

BOILER = "<nav><ul><li>Home</li><li>About</li></ul></nav>"
CASES = [
    ("<article><h1>T &amp; U</h1><p>a\n  b&nbsp;c<br>d<p>e <b>f</article><footer>x</footer>", "T & U\na b c d\ne f"),
    ("<body><header>h</header><main><p>one</p><aside>no</aside><p>two</main>", "one\ntwo"),
    ("<article><script>if (a<b) {'</p>'}</script><style>p{}</style><p>x &lt;y&gt; &#233;&copy</p><!-- <p>no</p> -->"
     "</article>", "x <y> é©"),
    ("<article><p>keep</p><div class='post-comments'><p>no</p></div><form>no<input></form><div id=sidebar>no</div>"
     "<p>and this</p></article>", "keep\nand this"),
    ("<article><p title='a > b'>q</p><p hidden>kept</p><div role=\"navigation\">no</div><math><mi>x</mi></math>"
     "<noscript><p>kept too</noscript></article>", "q\nkept\nx\nkept too"),
    ("<article><ul><li>a<li>b <i>c</i></ul><table><tr><td>1<td>2<tr><td>3</table></article>", "a\nb c\n1\n2\n3"),
    ("<article><p>a</p></article><div class=ad>no</div><article><p>b</p><article class=comment>no</article></article>",
     "a\nb"),
    ("<div class='layout sidebar-right'><article><p>a</p></article></div>", "a"),
    ("<form><div class='sidebar'><article>teaser</article></div><article><p>a</p></article></form>", "a"),
    ("<div class=sidebar><article>teaser</article></div><article><p>a</p></article>", "a"),
    ("<article class='promo'>buy</article><article><p>a</p></article>", "a"), ("<article class='promo'>buy</article>", "buy"),
    ("<article><h2 id='social-policy'>a</h2><h2 id='related-work'>b</h2><p class='search-result'>c</p><p id='login'>d</p>"
     "<div class='ad-slot'>no</div><div class='x cookie-notice'>no</div><div id=share>no</div></article>", "a\nb\nc\nd"),
    ("<main><h1>t</h1><p>body of it</p><section><article>teaser</article></section></main>", "t\nbody of it\nteaser"),
    ("<main><p>all posts</p><article>the article is longer</article></main>", "the article is longer"),
    ("<div role=main><p>one</p></div><p>no", "one"), ("<article><p title='never closed>a</p></article>", "a"),
    ("<article>a <a href=x title=\"class=ad\">b</a><br/>c</article>", "a b c"), ("<article>a</article><a hre", "a"),
    ("<article></article>", ""), ("", ""), (None, ""), ("<<<>>", "<<\n>"), ("<article><p>open", "open"),
    ("<article>" + "<b>" * 3000 + "deep", "deep"), ("<article><p>1 < 2 & 3</p></article>", "1 < 2 & 3"),
]


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", "clash") for i, u, h in rows],
                                 "page_id long, url string, html string, text string, host string")


def test_pages(spark):
    rows = [(k, f"http://h{k}.org/", h) for k, (h, _) in enumerate(CASES)]
    got = {r["page_id"]: r["text"] for r in html_text.extracted(pages(spark, rows)).collect()}
    for k, (source, want) in enumerate(CASES):
        if source != "<<<>>":      # nothing but stray signs: whatever is visible
            assert got[k] == want, CASES[k]


def test_a_hosts_repeated_runs_go_and_unique_runs_stay(spark):
    menu, end = "<div>all our shops and opening hours here</div>", "<div>call us today or write to this office</div>"
    body = ["the first story is about a red fox in the wood", "another page tells of boats and tides at sea"]
    rows = [(k, "http://a.org/x", f"{menu}<p>{b}</p>{end}") for k, b in enumerate(body)]
    rows += [(7, "http://b.org/", f"{menu}<p>{body[0]}</p>"), (8, None, menu), (8, None, menu),
             (9, "http://a.org/y", f"{menu}<article>{menu}</article>")]
    got = {(r["page_id"], r["url"]): r["text"] for r in html_text.extracted(pages(spark, rows)).collect()}
    assert got[0, "http://a.org/x"] == body[0] and got[1, "http://a.org/x"] == body[1]
    assert got[7, "http://b.org/"] == "all our shops and opening hours here\n" + body[0]     # alone on its host
    assert got[8, None] == "all our shops and opening hours here"                             # one page, twice
    assert got[9, "http://a.org/y"] == "all our shops and opening hours here"                 # inside an article


def test_bare_pages_keep_the_phrases_and_copies_they_share(spark):
    menu = "<div>all our shops and opening hours here</div>"
    phrase = "as everybody in this town knows by now"
    words = [" ".join(f"w{k}x{i}" for i in range(40)) for k in range(8)]
    body = [f"{w} {phrase} {w[::-1]}" for w in words]
    rows = [(k, "http://a.org/x", f"{menu}<p>{b}</p>") for k, b in enumerate(body)]
    rows += [(20 + k, "http://a.org/copy", f"{menu}<p class=c{k}>{body[0]}</p>") for k in range(9)]     # one page text
    rows += [(30, "http://a.org/few", "<p>one whole line that two pages carry</p><p>u v</p>"),
             (31, "http://a.org/few", "<p>one whole line that two pages carry</p><p>y z</p>")]
    rows += [(k, "http://copies.org/", f"<p id=p{k}>{body[1]}</p>") for k in (40, 41)]
    rows += [(k, "http://two.org/", f"<p>{body[2]}</p><p>{k}</p>") for k in (50, 51)]
    long = " ".join(f"t{i}" for i in range(50))
    rows += [(60 + k, "http://long.org/", f"<p>{words[k]} {long} {words[k][::-1]}</p>") for k in range(3)]
    got = {r["page_id"]: r["text"] for r in html_text.extracted(pages(spark, rows)).collect()}
    assert [got[k] for k in range(8)] == body and {got[20 + k] for k in range(9)} == {body[0]}
    assert got[30] == "one whole line that two pages carry\nu v"
    assert got[40] == got[41] == body[1] and got[50] == body[2] + "\n50"
    assert [got[60 + k] for k in range(3)] == [f"{words[k]} {words[k][::-1]}" for k in range(3)]


def test_every_page_has_one_row(spark):
    rows = [(1, "http://a.org", BOILER), (1, "http://a.org", BOILER), (None, None, None), (2, "x", "<article>a")]
    assert html_text.extracted(pages(spark, rows)).count() == 4
    assert html_text.extracted(pages(spark, [])).count() == 0


@pytest.mark.parametrize("piece", [
    "<a '", "<", "&", "<p>", "</p>", "<a b='", '<a b="', "<a b=\"'", "<!", "<!--", "<?", "<script>", "</script", "<div></p>",
    "<b>", "<i class=", "class ", "<td><b>", "<dd><div><b></dd>", "<dt></dt>", "<a     ", "=  ", "</ ", "<div></b>"])
def test_a_megabyte_of_odd_markup_takes_a_moment(piece):
    import time
    began = time.process_time()
    html_text.blocks(piece * (1_000_000 // len(piece)))
    list(html_text.blocks("<div>" * 200 + "<dd><div>" + "<b>" * 100_000 + piece * (1_000_000 // len(piece))))
    assert time.process_time() - began < 12           # a second or three; quadratic time would be hours


def test_articles_pass_the_hosts_search_too(spark):
    notice = "write to this paper if a letter of yours got lost"        # no class tells it from the article
    phrase = "as everybody in this town knows by now"
    body = [" ".join(f"w{k}x{i}" for i in range(40)) for k in range(10)]
    rows = [(k, "http://a.org/x", f"<article><p>{b}</p><p>{notice}</p></article>") for k, b in enumerate(body)]
    rows += [(20 + k, "http://b.org/x", f"<main><p>{b} {phrase} {b[::-1]}</p></main>") for k, b in enumerate(body)]
    rows += [(40 + k, "http://half.org/", f"<article><p>{b}</p>{f'<p>{notice}</p>' * (k % 2)}</article>")
             for k, b in enumerate(body)]
    rows += [(60 + k, "http://few.org/", f"<article><p>{b}</p><p>{notice}</p></article>") for k, b in enumerate(body[:2])]
    rows += [(70 + k, "http://same.org/", f"<article><p>{body[0]}</p><p>{notice}</p></article><p>{k}</p>") for k in range(5)]
    versions = [f"version {k} {' '.join(body)}" for k in range(5)]
    rows += [(80 + k, "http://versions.org/", f"<article><p>{v}</p></article>") for k, v in enumerate(versions)]
    rows += [(90 + k, "http://out.org/", f"<div>{notice}</div><article><p>{b}</p>{f'<p>{notice}</p>' * (k < 1)}</article>")
             for k, b in enumerate(body[:4])]
    got = {r["page_id"]: r["text"] for r in html_text.extracted(pages(spark, rows)).collect()}
    assert [got[k] for k in range(10)] == body                                              # on every article
    assert [got[20 + k] for k in range(10)] == [f"{b} {phrase} {b[::-1]}" for b in body]
    assert [got[40 + k] for k in range(10)] == [b + f"\n{notice}" * (k % 2) for k, b in enumerate(body)]
    assert [got[60 + k] for k in range(2)] == [f"{b}\n{notice}" for b in body[:2]]
    assert {got[70 + k] for k in range(5)} == {f"{body[0]}\n{notice}"}                      # copies of one text
    assert [got[80 + k] for k in range(5)] == versions                                      # versions of one text
    assert got[90] == f"{body[0]}\n{notice}" and got[91] == body[1]


def test_long_runs_inside_paragraphs_are_found_by_their_anchors(spark):
    import random
    r = random.Random(4)
    word = lambda n: [f"v{r.randrange(10**6)}" for _ in range(n)]
    for size in (50, 51, 70):
        rows, want, passage = [], [], word(size)
        for k in range(6):
            a, b = word(r.randrange(60, 200)), word(r.randrange(60, 200))
            rows.append((k, "http://a.org/", f"<article><p>{' '.join(a + passage * (k < 5) + b)}</p></article>"))
            want.append(" ".join(a + b))
        got = {r["page_id"]: r["text"] for r in html_text.extracted(pages(spark, rows)).collect()}
        assert [got[k] for k in range(6)] == want
    found = [" ".join(word(300)), " ".join(word(20))]
    stream = " ".join(found).split()
    every = set(html_text._anchors(stream).tolist())
    assert len(every) < 40 and html_text._anchored(found, every) == {
        h for a, b, h in html_text._runs(found) if (a, b, h) not in set(html_text._block_runs(found))}
    assert not len(html_text._anchors(stream[:49])) and len(html_text._anchors(stream[:50])) == 1
