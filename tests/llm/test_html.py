"""HTML extraction: wrappers cover their pages and decide what is template, pages whose classes tell nothing, odd pages."""

from __future__ import annotations

import random
import time

from pyspark.sql import functions as F

from lakemill.llm import html_extract as h

MENU = "<div class='x7'><a href='/'>HomeShop</a> <a href='/n'>News</a></div>"
FOOT = "<div class='x8'><p>All about us</p><p>Imprint</p></div>"


def bare_page(i, paragraphs):
    """A page whose class names tell nothing."""
    return f"<html><body>{MENU}<div class='q'><h2>Head {i}</h2>{''.join(f'<p>{x}</p>' for x in paragraphs)}</div>{FOOT}</body></html>"


def extracted(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit("clash"), "stream": F.lit(1)})
    return [(r.page_id, r.text, r.n_chars) for r in h.extract(df).orderBy("page_id").collect()]


def test_template_text_goes_by_the_wrapper_alone(spark):
    bodies = [[f"text {i}.{k}" for k in range(1 + i % 3)] for i in range(6)]
    rows = [(i, f"http://one.example/{i}", bare_page(i, b)) for i, b in enumerate(bodies)]
    assert [t for _, t, _ in extracted(spark, rows)] == ["\n".join([f"Head {i}", *b]) for i, b in enumerate(bodies)]
    # A page without its host's wrapper keeps menu and foot.
    assert h.text_of(rows[0][2]) == "HomeShop News\nHead 0\ntext 0.0\nAll about us\nImprint"


def test_copies_alone_are_no_template(spark):
    rows = [(i, f"http://two.example/{i}", bare_page(0, ["same"])) for i in range(9)]
    assert {t for _, t, _ in extracted(spark, rows)} == {"HomeShop News\nHead 0\nsame\nAll about us\nImprint"}
    rows = [(i, f"http://three.example/{i}", f"<article><h1>Always</h1><p>{i % 2}</p></article>") for i in range(9)]
    assert [t for _, t, _ in extracted(spark, rows)] == [f"Always\n{i % 2}" for i in range(9)]


def test_pages_without_an_article_on_a_host_that_has_some(spark):
    rows = [(i, "http://four.example/", f"<nav>n</nav><article><p>a {i}</p></article><footer>f</footer>") for i in range(4)]
    rows += [(9, "http://four.example/", "<nav>n</nav><div class='content'><p>old layout</p></div><footer>f</footer>")]
    rows += [(10, None, "<div>p</div>"), (11, "nothing", "<article>q</article>"), (12, "nothing", "<p>r"), (12, "nothing", "<p>r")]
    assert [t for _, t, _ in extracted(spark, rows)] == ["a 0", "a 1", "a 2", "a 3", "old layout", "p", "q", "r", "r"]


def test_readers_and_related_articles_are_furniture():
    page = "<article class='post social share'><p>body</p><article class='comment'><p>me first</p></article></article><article class='related'>more</article>"
    assert h.text_of(page) == "body"


def random_page(rng):
    def some(depth):
        tags = ["p", "ul", "div", "b", "span", "section"]
        return "".join(f"<{t}>{some(depth - 1) if depth and rng.random() < 0.7 else rng.choice('xyz')}</{t}>" * rng.choice([1, 1, 2, 3]) for t in rng.sample(tags, rng.randrange(1, 4)))

    return f"<html><body>{MENU if rng.random() < 0.8 else ''}<main>{some(2)}</main>{FOOT}</body></html>"


def test_a_wrapper_covers_every_page_it_was_made_from():
    rng = random.Random(3)
    for _ in range(25):
        pages = [random_page(rng) for _ in range(rng.randrange(2, 9))]
        streams = [h.json.dumps(h.stream_of(p)[0]) for p in pages]
        automaton = h.Automaton(h._tuples(h.json.loads(h.wrapper_of(streams))))
        for p in pages:
            symbols = h._symbols(list(h.placed(p)))
            states = automaton.match(symbols)
            assert states is not None and [automaton.symbols[s] for s in states] == symbols
            assert all(b in automaton.follow[a] for a, b in zip(states, states[1:])) and states[-1] in automaton.ends


def brute_matches(nodes, symbols):
    """All ends that a run of nodes can reach, by trying everything."""
    ends = {0}
    for node in nodes:
        new = set()
        for at in ends:
            if isinstance(node, str):
                new |= {at + 1} if symbols[at : at + 1] == [node] else set()
                continue
            if node[0] == "?":
                new.add(at)
            todo = {at + e for e in brute_matches(node[1], symbols[at:])}
            while todo:
                new |= todo
                todo = {t + e for t in todo for e in brute_matches(node[1], symbols[t:])} - new if node[0] == "+" else set()
        ends = new
    return ends


def test_the_automaton_is_its_expression():
    rng = random.Random(4)

    def some(depth):
        return tuple(rng.choice("ab") if not depth or rng.random() < 0.5 else (rng.choice("+?"), some(depth - 1)) for _ in range(rng.randrange(1, 4)))

    for _ in range(300):
        nodes = some(2)
        automaton = h.Automaton(nodes)
        for _ in range(10):
            symbols = [rng.choice("ab") for _ in range(rng.randrange(1, 7))]
            assert (automaton.match(symbols) is not None) == (len(symbols) in brute_matches(nodes, symbols)), (nodes, symbols)


def test_literals_do_not_depend_on_the_partitions(spark):
    rng = random.Random(5)
    rows = [(i, f"http://h{i % 3}.example/", random_page(rng)) for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("url as host", "html")
    found = [sorted(map(tuple, h.wrappers(df.repartition(n), fan=4).collect())) for n in (1, 7)]
    assert found[0] == found[1] and len(found[0]) == 3


def test_both_ways_to_the_pages_agree(spark):
    rows = [(i, f"http://h{i % 5}.example/", bare_page(i, [f"t{i}"])) for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    one, other = h.extract(df), h.extract(df, broadcast_bytes=-1)
    assert sorted(one.collect()) == sorted(other.collect())


def test_bad_pages_take_linear_time():
    for part in ("<a ", '<a "', "<p>", "<!", "<hr>", "</b>", "<script "):
        began = time.perf_counter()
        h.text_of("<p><div>" + "<a>" * 20_000 + part * 20_000 + '"')
        assert time.perf_counter() - began < 10, part
    assert h.text_of('<p title="a>b">x</p><p title=">y</p><img "') == "x"
    assert h.text_of("<svg/><p>kept</p><svg><p>gone</p></svg>") == "kept"


def test_long_repeats_are_folded():
    unit = [f"t{i}" for i in range(50)]
    assert h.folded(unit * 3) == (("+", tuple(unit)),)


def test_what_holds_most_of_a_page_is_the_article():
    """Teasers below the text, misleading class words, a form around the page, and what is not shown."""
    text = "A sentence of the article. " * 8
    said = " ".join(text.split())
    assert h.text_of(f"<div class=content><p>{text}</p></div><article><a>tease one</a></article><article>tease two</article>") == said
    for name in ("notice-of-award post", "share-price-report", "banner-story"):
        assert h.text_of(f'<div class="{name}"><p>{text}</p></div><nav>menu</nav><div class=share>share</div>') == said
    assert h.text_of(f"<form id=aspnetForm><p>{text}</p><input value=x></form>") == said
    assert h.text_of(f"<p>{text}</p><div hidden>a</div><div style='color:red; display: none'>b</div><p class='hidden-gem'>c</p>") == f"{said}\nc"
    assert h.text_of(f"<article><p>{text}</p><section><article><p>reader</p></article></section></article>") == said
    # Furniture stays furniture: a short form, a long discussion, a share box.
    assert h.text_of(f"<p>{text}</p><form>sign up</form><div class=comments>{f'<p>{text}</p>' * 5}</div><div class=share>share</div>") == said
