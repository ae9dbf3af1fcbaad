import random

import pytest

from popflow.llm import html_extract as hx
from popflow.llm import html_tree
from popflow.llm.html_tree import parse


def text(html, low=()):
    return hx.main_text(parse(html), set(low))


@pytest.mark.parametrize("html,want", [
    ("", ""), ("plain  text\n here", "plain text here"), ("a < b &amp; c &eacute; &#x41; &nbsp;d", "a < b & c é A d"),
    ("<p>one<p>two<br>three<ul><li>x<li>y</ul>", "one\n\ntwo three\n\nx\n\ny"),
    ("<body><nav>menu</nav><header><h1>Site</h1></header><p>Hello <b>big</b> <i>world</i></p><footer>f</footer>", "Hello big world"),
    ("<script>if (a<b) x('</p>')</script><style>p{}</style><p>t</p><!-- c <p>no</p> -->", "t"),
    ("<main><header><h1>T</h1><span>by me</span></header><p>x</p><aside>no</aside><form>f<input></form></main><p>out</p>", "T\n\nx"),
    ("<article><p>a</p><section class='comments'><article>c</article></section></article><div>related</div>", "a"),
    ("<div class='page with-sidebar'><div id=main-nav>m</div><article>t <a href='/x'>link</a>.</article><div class=sidebar>s</div></div>", "t link."),
    ("<div class='cookie-notice'>c</div><div class=adSlot>x</div><div class='content'><p>real</p></div><div role=search>q</div>", "real"),
    ("<div class='content'>real</div><section class='comments'><article>c</article></section>", "real"),
    ("<div class='comment'>only this</div>", "only this"),
    ("<article><p><b>open<br><p>next</article><footer>x", "open\n\nnext"),
    ("<p title=\"a>b\">q</p><img src=x><hr/>r<p hidden>h</p>", "q\n\nr"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n\n2\n\n3"),
    ("<p>cut <b", "cut"), ("<!-- open comment <p>x</p>", ""), ("</p></div>text</b>", "text"),
])
def test_single_pages(html, want):
    assert text(html) == want


def test_deep_and_long_pages():
    assert text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert text("<p>" + "word " * 200_000) == "word " * 199_999 + "word"
    assert text("<a href=\"x" * 2_000) == ""


def site(rng, k, boxed="box"):
    words = lambda n: " ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(n))
    body = [words(20) for _ in range(rng.randint(1, 4))]
    html = (f"<html><body><div class=top><span>Welcome to the site</span> <a href=/a>All</a></div><div class={boxed}>"
            + "".join(f"<p>{b}</p>" for b in body) + "</div><div class=low><p>About us, address and more</p></div></body></html>")
    return html, "\n\n".join(body)


def frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_repeated_branches_go_and_varied_ones_stay(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for k in range(40):
        html, text_ = site(rng, k)
        rows.append((k, f"http://A.example/{k}", html))
        want[k] = text_
    for k in range(3):  # too few pages to judge
        rows.append((100 + k, f"https://b.example/{k}", "<div>same</div><p>text</p>"))
        want[100 + k] = "same\n\ntext"
    rows += [(200, None, None), (201, "", ""), (None, "http://c.example", "<p>x</p>"), rows[0]]
    want |= {200: "", 201: "", None: "x"}
    got = hx.main_texts(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == want[r.page_id] and r.n_chars == len(r.text) and r.url == dict((a, b) for a, b, _ in rows)[r.page_id]


def test_copies_of_one_page_keep_their_text(spark):
    rows = [(k, "http://d.example/x", "<body><div>t</div><p>the only text</p></body>") for k in range(30)]
    rows += [(100 + k, "http://e.example/x", "<body><nav>n</nav><article><h1>h</h1><p>the text</p></article></body>") for k in range(30)]
    got = {r.page_id: r.text for r in hx.main_texts(frame(spark, rows)).collect()}
    assert got == {k: "t\n\nthe only text" for k in range(30)} | {100 + k: "h\n\nthe text" for k in range(30)}


def test_copies_of_a_page_are_no_evidence_against_its_article(spark):
    page = "<body><article><h1>T{0}</h1><div class=body>{1}</div></article></body>".format
    rows = [(k, "http://g.example/x", page("", "the copied body")) for k in range(75)]
    rows += [(k, "http://g.example/x", page(k, f"body number {k}")) for k in range(75, 100)]
    got = {r.page_id: r.text for r in hx.main_texts(frame(spark, rows)).collect()}
    assert got == {k: "T\n\nthe copied body" if k < 75 else f"T{k}\n\nbody number {k}" for k in range(100)}


def test_varied_text_below_wrappers_and_beside_repeated_branches_stays(spark):
    wrapped = "<div class=w>" * 12 + "{0}" + "</div>" * 12
    beside = ("<div class=all>" + "".join(f"<div class={c}>same {c}</div>" for c in "abcdefgh")
              + "<div class=text>{0}</div></div>")
    rows = [(100 * s + k, f"http://{s}.example/{k}", "<body><article><h1>T</h1>" + shape.format(f"words of {k}") + "</article></body>")
            for s, shape in enumerate((wrapped, beside)) for k in range(20)]
    got = {r.page_id: r.text for r in hx.main_texts(frame(spark, rows)).collect()}
    assert got == {100 * s + k: f"T\n\nwords of {k}" for s in range(2) for k in range(20)}


def test_importance_matches_the_formula(spark):
    import math
    pages = [f"<div class=a>{'same' if k < 6 else k}</div>" for k in range(8)]
    rows = frame(spark, [(k, "http://f.example", p) for k, p in enumerate(pages)]).selectExpr("'f' host", "html")
    (row,) = hx.node_statistics(rows.mapInArrow(hx._count, hx.COUNTS_DDL)).collect()
    assert row.pages == 8 and row.styles == 0 and row.texts == 8
    assert math.isclose(row.content, 1 - (6 * math.log(6) / 8) / math.log(8))


def test_empty_table(spark):
    assert hx.main_texts(frame(spark, [])).collect() == []


def test_the_tree_alone_tells_furniture_on_planted_hosts(spark):
    """Bare div pages, no class, id, role or telling tag: furniture goes by the tree, articles stay."""
    rng = random.Random(21)
    words = ["".join(rng.choices("abcdefghijklm", k=rng.randint(2, 9))) for _ in range(900)]
    say = lambda n: " ".join(rng.choices(words, k=n))
    pages, article, furniture = [], {}, {}
    for host in range(4):
        menu = [say(2) for _ in range(6)]
        notices, sides, foot = [say(9) for _ in range(3)], [[say(4) for _ in range(4)] for _ in range(2)], f"© host{host} {say(5)}"
        for k in range(60):
            i = 1_000 * host + k
            body = [say(6).upper(), *(say(rng.randint(12, 60)) for _ in range(rng.randint(2, 9)))]
            notice, side, advert = rng.choice(notices), rng.choice(sides), rng.random() < 0.3
            html = (f"<html><head><title>{say(4)}</title></head><body><div><ul>" + "".join(f"<li><a href=/x>{m}</a></li>" for m in menu)
                    + f"</ul></div><div>{notice}</div><div><h1>{body[0]}</h1>" + "".join(f"<p>{p}</p>" for p in body[1:])
                    + "</div><div><ul>" + "".join(f"<li>{s}</li>" for s in side) + "</ul></div>"
                    + (f"<div><p>{notices[0]} now</p></div>" if advert else "") + f"<div>{foot}</div></body></html>")
            pages.append((i, f"https://host{host}.example/{k}", html))
            article[i], furniture[i] = set(body), {*menu, notice, *side, foot, *([notices[0] + " now"] if advert else [])}
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(5)
    kept = {r.page_id: set(r.text.split("\n\n")) for r in hx.main_texts(df).collect()}
    blocks = lambda of: sum(len(of[i]) for i in kept)
    assert sum(len(article[i] & kept[i]) for i in kept) >= 0.95 * blocks(article)
    assert sum(len(furniture[i] - kept[i]) for i in kept) >= 0.9 * blocks(furniture)


def test_bare_elements_are_told_by_their_place():
    """From the nearer end among their like; named, prose and inline elements are not numbered."""
    few = parse("<body><div>a</div><div>b</div><div>c</div></body>")
    more = parse("<body><div>a</div><div>x</div><div>b</div><div>c</div></body>")
    assert len(set(few.path[2:5])) == 3
    assert few.path[2] == more.path[2] and few.path[4] == more.path[5]  # the first and the last
    alike = parse('<div><p>a</p><p>b</p><div class="c1">x</div><div class="c2">y</div><b>i</b></div>')
    assert alike.path[2] == alike.path[3] and alike.path[4] == alike.path[5] and alike.path[6] == alike.path[1]


def scores_by_recursion(nodes):
    """Composite importance from the leaves up, one host: {path: (score, varied)}."""
    facts = {r.path: r for r in nodes}
    below = {}
    for r in nodes:
        below.setdefault(r.above, []).append(r.path)

    def walk(path):
        r = facts[path]
        inner = [walk(c) for c in below.get(path, ())]
        parts = [(facts[c].pages, out[c][0]) for c in below.get(path, ())]
        if r.texts > 0:
            parts.append((r.pages, r.content))
        weight = sum(w for w, _ in parts)
        keep = hx.GAMMA ** r.styles if parts and r.styles > 1 else 1.0
        mean = sum(w * x for w, x in parts) / weight if weight else 0.0
        out[path] = ((1 - keep) * r.presentation + keep * mean, r.texts > 0 and r.content > hx.MAX_NOISE or any(v for _, v in inner))
        return out[path]

    out = {}
    for r in nodes:
        if r.above not in facts:
            walk(r.path)
    return out


def test_scores_by_chains_equal_a_recursion(spark):
    from pyspark.sql import functions as F

    from tests.conftest import SF01

    pages = spark.read.parquet(f"{SF01}/pages.parquet").select(
        F.regexp_extract("url", "://([^/]*)", 1).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    stats = hx.node_statistics(hx.with_copies(pages).mapInArrow(hx._count, hx.COUNTS_DDL)).persist()
    got = {(r.host, r.path): (r.score, r.varied) for r in hx.composite(stats).collect()}
    hosts = {}
    for r in stats.collect():
        hosts.setdefault(r.host, []).append(r)
        assert r.chain[-1] == r.path and (len(r.chain) == 1 or r.chain[-2] == r.above)
    want = {(h, p): v for h, nodes in hosts.items() for p, v in scores_by_recursion(nodes).items()}
    assert got.keys() == want.keys() and len(want) > 500
    assert all(abs(got[k][0] - want[k][0]) < 1e-9 and got[k][1] == want[k][1] for k in want)
    stats.unpersist()


def test_elements_below_the_last_level_count_as_their_ancestor():
    deep = parse("<div>" * 300 + "x" + "</div>" * 300)
    assert len(set(deep.path)) == html_tree.LEVELS + 1
    chains = hx.chains({p: a for p, a, kind, _ in hx.page_counts(deep) if kind == "node"})
    assert max(map(len, chains.values())) == html_tree.LEVELS
