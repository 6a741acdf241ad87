import html as h
import random
import re

from moodcast.llm import html_extract as he

SCHEMA = "page_id long, url string, html string, he_row string, text string, `a.b` long"


def pages(spark, htmls, ids=None):
    ids = range(len(htmls)) if ids is None else ids
    return spark.createDataFrame([(i, "u", t, "r", "old", 5) for i, t in zip(ids, htmls, strict=True)], SCHEMA)


def extracted(spark, htmls):
    rows = he.digest(pages(spark, htmls)).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    return [r["text"] for r in sorted(rows, key=lambda r: r["page_id"])]


def page(rng, tag):
    """A page with its article, and the article's text."""
    say = lambda n: " ".join(rng.choice(["wind", "salt &amp; sea", "caf&eacute;", "a &lt; b", "rain,", "stone."])
                             for _ in range(n)) + "."
    blocks = ["<h1>" + say(4) + "</h1>", *("<p>" + say(rng.randrange(6, 40)) + "</p>" for _ in range(rng.randrange(1, 9)))]
    blocks.insert(2, "<ul><li>" + say(3) + "</li><li>one <b>bo</b>ld <a href=x>li\nnk</a></li></ul>")
    inside = "<div class='comments'><p>" + say(30) + "</p></div>" if rng.random() < 0.4 else ""
    text = " ".join(" ".join(h.unescape(re.sub(r"<[^>]*>", "", b)).split())
                    for b in re.findall(r"<(?:h1|p|li)>.*?</(?:h1|p|li)>", "".join(blocks), re.S))
    side = f"<aside>{say(20)}</aside><div id=sidebar><p>{say(40)}</p></div>"
    return (f"<!DOCTYPE html><html><head><title>{say(3)}</title><style>p{{}}</style><script>var t='</p>';</script></head>"
            f"<body><header><h2>{say(3)}</h2></header><nav><ul><li><a>{say(2)}</a></li></ul></nav><!-- x -->"
            f"<div class='top-ad'>{say(9)}</div><div class=cookie-notice>{say(25)}</div><form><p>{say(12)}</p></form>"
            f"<{tag}>{''.join(blocks)}{inside}</{tag}>{side}<section id='comments'><p>{say(50)}</p></section>"
            f"<footer>&copy; {say(6)}</footer></body></html>"), text


def test_articles_come_out_whole(spark):
    rng = random.Random(2)
    made = [page(rng, tag) for tag in ("article", "main", 'div class="post"') for _ in range(12)]
    made = [(p.replace('</div class="post">', "</div>"), t) for p, t in made]
    assert extracted(spark, [p for p, _ in made]) == [t for _, t in made]


def test_markup_that_is_never_closed(spark):
    got = extracted(spark, ["<article><h1>T</h1><p><b>one, two.<br><p>three <i>four</article><footer>no</footer>",
                            "<article><p>cut off &am", "<article><p>text<!-- never closed", "<p>x<script>y",
                            "<article><p>a</p></b></div></p>b</article>"])
    assert got == ["T one, two. three four", "cut off &am", "text", "x", "a b"]


def test_edge_cases(spark):
    long = "word, " * 40_000
    got = extracted(spark, [None, "", "plain text", "<p></p>", f"<p>{long}</p>", "<nav>only a menu</nav>",
                            "<p>a&nbsp;b\t\n c</p>&#x41;&#66;"])
    assert got == ["", "", "plain text", "", long.strip(), "", "a b c AB"]


def test_other_columns_and_repeated_rows(spark):
    rows = he.extract(pages(spark, ["<p>x</p>", "<p>x</p>", None], ids=[1, 1, None])).collect()
    assert [r["text"] for r in sorted(rows, key=lambda r: r["page_id"] or 9)] == ["x", "x", ""]
    assert all(r["he_row"] == "r" and r["a.b"] == 5 for r in rows)


def test_empty_table(spark):
    assert he.digest(pages(spark, ["<p>x"]).limit(0)).count() == 0


def test_class_words_do_not_lose_the_article(spark):
    say = "It rained, all day. "
    got = extracted(spark, [
        f'<main class="has-sidebar"><h1>T</h1><p>{say}</p></main>',
        f'<article class="post share-enabled"><p>{say}</p></article>',
        f'<div class="search-page"><h1>T</h1><p>{say}</p><p>{say}</p></div><div><p>Short, too.</p></div>',
        f'<article><h1>T</h1><p>{say}</p><div class="comments"><h2>No</h2><p>{say * 9}</p></div></article>',
        f'<div class="post"><h1>T</h1><p>{say}</p></div><div id="comments"><article class="comment">{say * 9}</article></div>',
        f'<article><p>{say}</p><pre>x = 1 <span class="comment"># one</span></pre></article>',
        '<div class="ad">Buy now!</div>'])
    text = "It rained, all day."
    assert got == [f"T {text}", text, f"T {text} {text} Short, too.", f"T {text}", f"T {text}", f"{text} x = 1 # one", ""]


def test_open_comments(spark):
    got = extracted(spark, ["<script>var a = '<!--';</script><article><p>Still, here.</p></article>",
                            "<article><p>a <!-- b --> c<!-- d", "<article><p>1 < 2, and <", "<p>a<div class='x"])
    assert got == ["Still, here.", "a c", "1 < 2, and <", "a"]


LINKS = "<ul><li><a href=a>One more page</a></li><li><a href=b>Another page</a></li><li><a href=c>A third</a></li></ul>"
ARTICLE = ("<article><h1><a href=x>Title</a></h1><p>Some words, and more of them. And <a href=y>a link</a>, too.</p>{}"
           "<ul><li>a point</li><li><a href=z>linked</a> point</li></ul><table><tr><td>1</td><td>2</td></tr></table>"
           "<p>The end, then.</p></article>")


def test_the_threshold_decides_inside_an_article(spark):
    df = pages(spark, [ARTICLE.format(f"<div>{LINKS}</div>"), ARTICLE.format("")])
    text = "Title Some words, and more of them. And a link, too. a point linked point 1 2 The end, then."
    assert [r["text"] for r in he.digest(df).collect()] == [text, text]
    kept = he.extract(df, threshold=he.F.lit(-1.0)).orderBy("page_id").collect()
    assert "One more page Another page A third" in kept[0]["text"] and kept[1]["text"] == text


def ratios(html):
    """Paths, scores and threshold of a page whose every element is closed."""
    stats, stack = {}, []
    for tag, text in re.findall(r"<(/?\w+)[^>]*>([^<]*)", html):
        stack = stack[:-1] if tag[0] == "/" else [*stack, tag]
        text = " ".join(text.split())
        if text:
            linked = "a" in stack and not {"h1", "h2"} & set(stack)
            got = stats.setdefault("/".join(t for t in stack if t != "a"), [0, 0, 0, 0])
            for i, v in enumerate((1, len(text), 0 if linked else len(text),
                                   0 if linked else sum(c in ".,;:!?" for c in text))):
                got[i] += v
    def smooth(v):
        return [(v[max(i - 1, 0)] + 2 * v[i] + v[min(i + 1, len(v) - 1)]) / 4 for i in range(len(v))]
    rows = list(stats.values())
    texts, points = smooth([r[2] / r[0] for r in rows]), smooth([r[3] / r[0] for r in rows])
    scores = [(t * (p + 0.5)) ** 0.5 * r[2] / r[1] for t, p, r in zip(texts, points, rows)]
    mean = sum(scores) / len(scores)
    return list(stats), scores, min((sum((s - mean) ** 2 for s in scores) / len(scores)) ** 0.5, max(scores))


def test_ratios_equal_brute_force(spark):
    rng = random.Random(4)
    def some(n):
        return " ".join(rng.choice(["rain,", "wind", "stone.", "sea", "so?"]) for _ in range(n))
    def body():
        return "".join(rng.choice([f"<p>{some(rng.randrange(1, 30))}</p>", f"<h2>{some(3)}</h2>",
                                   f"<div><ul><li>{some(2)}</li><li><a>{some(4)}</a></li></ul></div>",
                                   f"<section><p><a>{some(5)}</a></p><div>{some(9)}</div></section>"])
                       for _ in range(rng.randrange(1, 12)))
    made = [f"<body><div><h1>{some(4)}</h1>{body()}</div><div>{body()}</div></body>" for _ in range(40)]
    read = he.F.pandas_udf(he._read_batches, f"{he.BLOCKS}, {he.PATHS}, {he.HEADS}")
    he.common.prepare(spark)
    rows = he.content_paths(he.live_paths(pages(spark, made).select("page_id", read("html").alias("he_page"))))
    for r in rows.select("page_id", "he_live", "he_score", "he_threshold").collect():
        paths, scores, threshold = ratios(made[r["page_id"]])
        assert [p["path"] for p in r["he_live"]] == paths
        assert all(abs(a - b) < 1e-9 for a, b in zip(r["he_score"], scores, strict=True))
        assert abs(r["he_threshold"] - threshold) < 1e-9


def test_unnamed_noise_outside_goes_by_its_score(spark):
    rng = random.Random(6)
    made = [page(rng, 'div class="post"') for _ in range(20)]
    noise = "<div><p>Log in</p><p>Home</p><p>Up</p></div>" + f"<div>{LINKS}</div>"
    made = [(p.replace('</div class="post">', "</div>").replace("<footer>", noise + "<footer>"), t) for p, t in made]
    assert extracted(spark, [p for p, _ in made]) == [t for _, t in made]
    kept = he.extract(pages(spark, [p for p, _ in made]), threshold=he.F.lit(-1.0)).collect()
    assert all("Log in" in r["text"] for r in kept)
