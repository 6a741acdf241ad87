import random

from pyspark.sql import functions as F

from moodcast.llm import url_filter as uf


def brute_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:cut], rest[cut:]
    cut = min([rest.index(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:cut]


def brute_rule(host, path):
    fits = [r for r in uf.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return (best.name, best.verdict) if best else (None, None)


def corpus(n=400):
    rng = random.Random(6)
    out = []
    for _ in range(n):
        bad = rng.random() < 0.3
        host = (rng.choice(["spam-farm", "casino-win", "cheap-pills"]) if bad else rng.choice(["river", "meadow", "harbour"]))
        host += rng.choice([".example.org", ".example.com", ".example.net"])
        out.append(f"http://{rng.choice(['', 'www.', 'M.'])}{host}/{rng.choice(['en', 'es', 'fr', 'de'])}/{rng.randrange(999)}"
                   + rng.choice(["", "/", "?page=2&ref=x", "#top"]))
    return out


ODD = [None, "", "no scheme", "http://", "://x.org", "http://ORG", "http://org/", "https://a.org?x=/es/", "http://xorg/",
       "HTTP://Example.ORG/es/1://y", "http://example.org/en/12", "http://example.org/en/2", "ftp://b.com/fr/", "http://é.com/de/",
       "http://a.com/de", "x\n://b.org/q", "http://" + "long" * 20_000 + ".com/de/x"]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, 1, "r") for i, u in enumerate(urls)],
                                 "page_id long, url string, uf_host long, rule string").repartition(3)


def test_host_path_and_rule_match_brute_force(spark):
    urls = ODD + corpus()
    rows = {r["page_id"]: r for r in uf.digest(pages(spark, urls)).collect()}
    assert len(rows) == len(urls)
    for i, u in enumerate(urls):
        host, path = brute_parts(u)
        rule, verdict = brute_rule(host, path)
        assert (rows[i]["host"], rows[i]["path"], rows[i]["rule"]) == (host, path, rule)
        assert rows[i]["verdict"] == verdict if verdict else rows[i]["verdict"] in ("allow", "block")


def test_held_out_accuracy(spark):
    train = pages(spark, corpus(500)[:300]).select(
        "url", uf.seed_label(uf.host_of(F.col("url"))).alias("label"))
    test = pages(spark, corpus(500)[300:])
    rows = uf.judge(test, rules=(), labelled=train).collect()
    right = sum((r["verdict"] == "block") == any(w in r["host"] for w in ("spam", "casino", "pills")) for r in rows)
    assert right >= 0.95 * len(rows)


def test_features_are_numbers_for_odd_urls(spark):
    rows = uf.with_features(pages(spark, ODD).select("url", uf.host_of(F.col("url")).alias("uf_host"),
                                                     uf.path_of(F.col("url")).alias("uf_path"))).collect()
    assert len(rows) == len(ODD)
    assert all(r[f] is not None and r[f] == r[f] for r in rows for f in uf.FEATURES)


def test_one_label_or_no_rows(spark):
    assert uf.digest(pages(spark, ODD).limit(0)).count() == 0
    assert {r["verdict"] for r in uf.digest(pages(spark, ["http://quiet.net/a", None])).collect()} == {"allow"}


def test_no_python_on_the_main_path(spark):
    plan = uf.digest(pages(spark, corpus(50)))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
