import random
import time
from collections import Counter

from corpusloom.llm.html import best_path, blocks, extracted, main_text, op6_html

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="home">
<header class="site"><p>Logo line</p></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<script>var t = "</p><article>no</article>";</script><!-- <p>gone</p> --><div class="cookie-notice">We use cookies</div>
<div class="wrap page-7"><article><header><h1>Title &amp; more</h1></header><p>First <b>para<br>graph&nbsp;one</b>
 goes &lt;on&gt;.<p>Second<img alt="x">, unclosed<div class="ad">Buy!</div><ul><li>one<li>two</ul>
<pre>a   b</pre><aside>Side</aside><form><input><label>Mail</label></form><footer>Foot</footer></article>
<section id="comments"><p>Reader: nice</p></section></div><footer>&copy; me</footer></body></html>"""

TEXT = "Title & more\n\nFirst para graph one goes <on>.\n\nSecond, unclosed\n\none\n\ntwo\n\na b"


def test_article_without_the_rest():
    assert best_path(blocks(PAGE))[0] == "body>div.page-.wrap>article" or best_path(blocks(PAGE))[0].endswith("article")
    assert extracted(PAGE, None) == TEXT


def test_fallbacks():
    assert extracted("", "body") == "" and extracted("<nav>x</nav>", None) == ""
    assert extracted("plain &eacute; text", None) == "plain é text"
    assert extracted("<body><div class=c><p>only here and long enough</p></div>", "body>div.other") == "only here and long enough"
    assert extracted("<p>a<script>never closed", None) == "a"


def test_hosts_agree_on_a_path(spark):
    # on most pages of the host the story is longer; the last page's links would win on its own
    story = lambda i, n: f"<body><div class='story s{i}'><p>{'word ' * n}</p></div><div class='box{i}'><p>{'other ' * 20}</p></div></body>"
    rows = [(i, f"https://a.example/{i}", story(i, 60), 1) for i in range(6)] + [(6, "http://user@A.example:80/x", story(6, 3), 1), (7, None, None, 1), (8, None, "", 1), (9, "https://b.example", story(9, 3), 1), (9, "https://b.example", story(9, 3), 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, path int")
    got = sorted(((x["page_id"], x["url"], x["text"]) for x in main_text(df).collect()), key=str)
    assert len(got) == len(rows)
    assert (6, "http://user@A.example:80/x", "word word word") in got
    assert (7, None, "") in got and (8, None, "") in got
    assert got[-1][2] == ("other " * 20).strip() and got[-1] == got[-2]


def test_empty_table(spark):
    assert main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_names_of_content_are_no_noise():
    long = "prose of the page " * 20
    page = f"""<body><article><h2 id="related-work">Related work</h2><p id="notice-1">{long}</p><section id="side-effects"><p>Effects</p></section>
<h3 id="search-algorithms">Search</h3><p>in <span class="tag">tagged</span> words</p><div class="elementor-widget-text-editor"><p>Edited</p></div>
<div class="share-buttons"><p>Share me</p></div><div id="ad-slot-3"><p>Buy</p></div><div hidden><p>Unseen</p></div></article></body>"""
    assert extracted(page, None).split("\n\n") == ["Related work", long.strip(), "Effects", "Search", "in tagged words", "Edited"]


def test_noisy_container_with_the_prose_is_kept():
    long = "prose of the page " * 20
    page = f"<body><h1>T</h1><div class='paywall'><p>{long}</p><div class='promo'><p>Buy</p></div></div><div class='related'><p>{'more ' * 9}</p></div></body>"
    assert extracted(page, None) == long.strip()
    assert "nice" not in extracted(f"<body><div class='post'><p>{long}</p></div><div class='comments'><p>{'nice ' * 200}</p></div></body>", None)


def test_pages_of_another_template_keep_their_article(spark):
    long = ("prose of the page " * 20).strip()
    usual = lambda i: f"<body><div class='story'><p>{i} {long} {long}</p></div></body>"
    other = lambda i: f"<body><div class='story'><p>teaser {i}</p></div><div class='essay'><p>{i} {long}</p></div></body>"
    plain = f"<body><p>{long}</p><div class='story'><p>teaser</p></div></body>"
    rows = [(i, None, usual(i)) for i in range(8)] + [(i, None, other(i)) for i in (8, 9)] + [(10, None, plain)]
    got = {x["page_id"]: x["text"] for x in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == f"0 {long} {long}" and got[8] == f"8 {long}" and got[9] == f"9 {long}"
    assert long in got[10]


def test_an_article_in_several_containers_is_whole():
    page = f"<body><div class='top'><p>Name</p></div><div class='post'><div class='intro'><p>{'first ' * 30}</p></div><div class='body'><p>{'then ' * 100}</p></div></div></body>"
    assert extracted(page, None) == f"{('first ' * 30).strip()}\n\n{('then ' * 100).strip()}"
    assert extracted(page, "body>div.top") == extracted(page, None)


def test_odd_attributes_formulas_and_alerts():
    long = ("prose of the page " * 20).strip()
    page = f"""<body><article><p title=it's>{long}</p><p>of <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>tex</annotation></math> and <svg><text>no</text></svg> more</p>
<div class=alert-colours><p>Alert colours</p></div><div class="side-by-side"><p>Side by side</p></div><noscript><p>no</p></noscript><p data-x='a>b' class="y">quoted > end</p>
<textarea>no <p>no</textarea><p>last</p></article></body>"""
    assert extracted(page, None).split("\n\n") == [long, "of x=1 and more", "Alert colours", "Side by side", "quoted > end", "last"]


def test_unclosed_things_take_time_in_proportion():
    for part in ('<a x="', "<p title='", "<a ", "<b><p>", "</i>", "<div>", "<li>", "<!", "<script ", "= \"'", "<td><b>", "<svg>"):
        times = []
        for n in (4000, 16000):
            page, start = "<body><p>text</p>" + part * n + "<p>end", time.process_time()
            extracted(page, None)
            times.append(time.process_time() - start)
        assert times[1] < 8 * times[0] + 0.3, part


def test_long_pages_are_whole():
    text = [f"paragraph {i} of a long page with some words" for i in range(50_000)]
    page = "<html><body><div class='menu'><a href='/'>Home</a></div><main>" + "".join(f"<p>{t}</p>" for t in text) + "</main></body></html>"
    assert extracted(page, None) == "\n\n".join(text)


def brute_votes(pages):
    """Per host, the winning path and the losers, from all pages at once."""
    size, won, seen, out = Counter(), Counter(), Counter(), {}
    for host, page in pages:
        found = blocks(page or "")
        if best := best_path(found):
            paths = {">".join(b.path) for b in found if b.path and b.prose} | {best[0]}
            seen.update((host, p) for p in paths)
            size[host, best[0]] += best[1]
            won[host, best[0]] += 1
    for host in {h for h, _ in won}:
        own = [p for h, p in won if h == host]
        out[host] = (min(own, key=lambda p: (-size[host, p], -won[host, p], p)), {p for p in own if 2 * won[host, p] < seen[host, p]})
    return out


def test_the_query_equals_brute_force(spark, tmp_path):
    r = random.Random(4)
    said = lambda n: " ".join(r.choice(["alpha", "beta", "gamma"]) for _ in range(n))
    rows = []
    for i in range(120):
        parts = [f"<div class='{r.choice(['story', 'box', 'post', 'x9'])}'><p>{said(r.randrange(1, 60))}</p></div>" for _ in range(r.randrange(4))]
        rows.append((i, r.choice(["https://a.example/1", "http://b.example", None, "no url"]), r.choice([None, "", "<body>" + "".join(parts)]) if i % 10 == 0 else "<body>" + "".join(parts)))
    rows += rows[:7]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    host = lambda u: u.split("/")[2] if u and "://" in u else ""
    vote = brute_votes([(host(u), h) for _, u, h in rows])
    want = [(i, u, extracted(h or "", *vote.get(host(u), (None, set())))) for i, u, h in rows]
    got = [(x["page_id"], x["url"], x["text"], x["n_chars"]) for x in op6_html(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(((*w, len(w[2])) for w in want), key=str)


def test_equal_votes_go_to_the_first_path(spark):
    page = lambda c: f"<body><div class='{c}'><p>same words here</p></div></body>"
    both = "<body><div class='a'><p>of a</p></div><div class='b'><p>of b</p></div><p>own</p></body>"
    rows = [(0, None, page("b")), (1, None, page("a")), (2, None, both)]
    got = {x["page_id"]: x["text"] for x in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    again = {x["page_id"]: x["text"] for x in main_text(spark.createDataFrame(rows[::-1], "page_id long, url string, html string")).collect()}
    assert got == again and got[0] == got[1] == "same words here"
