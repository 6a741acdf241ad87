import random
import re

from helpers import LONG_WORD, documents, same_extras

from moodcast.llm import pii

TEXT = ("Write to Mrs. Anna Keller (anna.keller@mail.example.com) or call +1 (017) 555-7713 or 555-123-4567. "
        "Card 4417 7442 8035 1547, account DE89 3704 0044 0532 0130 00, 123-45-6789, host 83.229.25.121, "
        "fe80:0:0:0:0:0:0:1, token = \"908038b7daaf91e1234567890abcdef123456789\". Mr Keller and John Smith agreed.")


def kinds(text):
    return [(k.split("-")[0], o) for _, _, k, o in pii.find(text)]


def test_detection():
    assert kinds(TEXT) == [("first", "Anna"), ("last", "Keller"), ("email", "anna.keller@mail.example.com"),
                           ("phone", "+1 (017) 555-7713"), ("phone", "555-123-4567"), ("card", "4417 7442 8035 1547"),
                           ("iban", "DE89 3704 0044 0532 0130 00"), ("ssn", "123-45-6789"), ("ip", "83.229.25.121"),
                           ("ip6", "fe80:0:0:0:0:0:0:1"), ("secret", "908038b7daaf91e1234567890abcdef123456789"),
                           ("last", "Keller"), ("first", "John"), ("last", "Smith")]


def test_neighbours_are_told_apart():
    assert kinds("+1 (826) 555-4081 190.137.223.204 du") == [("phone", "+1 (826) 555-4081"), ("ip", "190.137.223.204")]
    assert kinds("+1!! (826)!! 555-4081!! A@B.ORG!!") == [("phone", "+1!! (826)!! 555-4081"), ("email", "A@B.ORG")]
    assert kinds("KEY 908038B7DAAF91E1234567890ABCDEF123456789") == [("secret", "908038B7DAAF91E1234567890ABCDEF123456789")]


def test_clean_text_is_left_alone():
    for t in ("In 2024 they sold 12,500 tons for 3.5 million.", "Version 1.2.3 of 10/11/2012, room 1024.", "a@b", "12:30:45",
              "The Frankfurt road, the John, a decade and a facade.", ""):
        assert pii.find(t) == []


def test_surrogates_match_type_gender_and_script():
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", made("phone", "+1 (017) 555-7713"))
    assert re.fullmatch(r"\d{4} \d{4} \d{4} \d{4}", made("card", "4417 7442 8035 1547"))
    assert re.fullmatch(r"DE\d\d( \d{4}){4} \d\d", made("iban", "DE89 3704 0044 0532 0130 00"))
    assert re.fullmatch(r"[a-z]{4}\.\d\d@[a-z]{4}\.[a-z]{7}\.com", made("email", "anna.55@mail.example.com"))
    assert all(1 <= int(x) <= 254 for x in made("ip", "83.229.25.121").split("."))
    assert made("first-latin-f", "Anna") in pii.FIRST_NAMES["latin", "f"]
    assert made("first-cyrillic-m", "Иван") in pii.FIRST_NAMES["cyrillic", "m"]
    assert made("last-cyrillic-f", "Петрова").endswith(("ова", "ина", "ская"))
    assert made("email", "x@a.org").split("@")[1] == made("email", "y@a.org").split("@")[1]


def made(kind, original):
    return pii.shaped(kind, original, pii.surrogate("key", kind, pii.normal(kind, original)))


def test_documents(spark):
    texts = [TEXT, TEXT, None, "", LONG_WORD, "card 4417-7442-8035-1547 of Keller", "nothing here", "ANNA.KELLER@mail.example.com"]
    docs = documents(spark, texts, ids=[0, 0, 2, None, 4, 5, 6, None])
    rows = pii.pseudonymise(docs, "k1").collect()
    assert all(map(same_extras, rows)) and len(rows) == len(texts)
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["text"] is None and by[6]["text"] == "nothing here" and by[4]["text"] == LONG_WORD
    new = {}
    for e in by[0]["pii_entities"]:
        original = TEXT[e["start"]:e["start"] + e["length"]]
        assert original not in by[0]["text"] and e["surrogate"] in by[0]["text"]
        assert new.setdefault((e["kind"], original), e["surrogate"]) == e["surrogate"]
    card = by[5]["pii_entities"][0]["surrogate"]
    assert card.replace("-", "") == new["card", "4417 7442 8035 1547"].replace(" ", "")
    mail = next(r for r in rows if r["text"] and r["text"].islower() and "@" in r["text"])
    assert mail["text"] == new["email", "anna.keller@mail.example.com"]
    other = {r["doc_id"]: r["text"] for r in pii.pseudonymise(docs, "k2").collect()}
    assert other[0] != by[0]["text"]


def test_collisions_draw_again(spark, monkeypatch):
    """A first draw that gives few results, or an original: all different
    in the end, and no original among them."""
    plain = pii.surrogate

    def narrow(key, kind, norm, attempt=0):
        if kind == "card" and attempt < 2:
            return ("4417744280351547", "1111222233334444")[(int(norm[-1]) + attempt) % 2]
        return plain(key, kind, norm, attempt)

    monkeypatch.setattr(pii, "surrogate", narrow)
    cards = ["4417744280351547", *(f"55556666777788{i:02d}" for i in range(20))]
    entities = spark.createDataFrame([("card", c) for c in cards], "kind string, norm string")
    drawn = []

    def local(rows, key, attempt):
        todo = [(r["kind"], r["norm"], narrow(key, r["kind"], r["norm"], attempt)) for r in rows.collect()]
        drawn.append(len(todo))
        return spark.createDataFrame(todo, "kind string, norm string, surrogate string")

    monkeypatch.setattr(pii, "_drawn", local)
    again = {r["norm"]: r["surrogate"] for r in pii.assign(entities, "k").collect()}
    final = {c: again.get(c, narrow("k", "card", c)) for c in cards}
    assert len(drawn) >= 3 and len(set(final.values())) == len(cards) and not set(final.values()) & set(cards)


def test_many_names_stay_apart(spark):
    names = [a + b for a in ("Hal", "Bren", "Os", "Tor", "Wil") for b in ("ler", "mann", "by", "sen", "ford", "wick")]
    texts = [f"Mr. {n} met Dr. {m} at noon." for n in names for m in names[:3]]
    rows = pii.pseudonymise(documents(spark, texts)).collect()
    new, old = {}, {}
    for r in rows:
        t = texts[r["doc_id"]]
        for e in r["pii_entities"]:
            o = t[e["start"]:e["start"] + e["length"]]
            assert new.setdefault(o, e["surrogate"]) == e["surrogate"] and old.setdefault(e["surrogate"], o) == o
    assert new.keys() == set(names)


def replaced(spark, texts):
    """Originals to surrogates of each text."""
    rows = sorted(pii.pseudonymise(documents(spark, texts)).collect(), key=lambda r: r["doc_id"])
    out = []
    for r, t in zip(rows, texts, strict=True):
        new = {}
        for e in r["pii_entities"]:
            o = t[e["start"]:e["start"] + e["length"]]
            assert new.setdefault(o, e["surrogate"]) == e["surrogate"]
        out.append((r["text"], new))
    return out


def test_mentions_agree(spark):
    texts = ["Mr Xavier Lopez left; later Lopez and Xavier slept in Lopez's house at www.Lopez.org.", "Dr Xavier Lopez came.",
             "Mr Xavier Lopez, Mr Xavier Lopez.", "Then Ms Xavier slept."]
    (one, names), (_, dr), (_, mr), (_, ms) = replaced(spark, texts)
    x, lo = names["Xavier"], names["Lopez"]
    assert one == f"Mr {x} {lo} left; later {lo} and {x} slept in {lo}'s house at www.Lopez.org."
    assert dr == mr == names and x.split("-")[0] in pii.FIRST_NAMES["latin", "m"]
    assert ms["Xavier"] not in (x, lo)  # a surname there, another entity
    assert replaced(spark, ["Ms Kim Roe, Mr Kim Poe.", "Mr Kim Roe."])[1][1]["Kim"]


def brute_force(texts, key):
    """All entities in one dictionary; the smallest of those that draw alike stays."""
    scans = [pii.find(t) for t in texts]
    votes = {}
    for spans in scans:
        for kind, norm in {(k, pii.normal(k, o)) for _, _, k, o in spans}:
            if kind.startswith(("first", "last")):
                at = (kind.rsplit("-", 1)[0], norm)
                votes[at] = votes.get(at, 0) + {"f": 1, "m": -1, "": 0}[kind.rsplit("-", 1)[1]]

    def told(kind, norm):
        v = votes.get((kind.rsplit("-", 1)[0], norm))
        return kind if v is None else f"{kind.rsplit('-', 1)[0]}-{'f' if v > 0 else 'm' if v < 0 else ''}"

    space = lambda kind: "name" if kind.startswith(("first-", "last-")) else kind
    todo = {(told(k, pii.normal(k, o)), pii.normal(k, o)) for spans in scans for _, _, k, o in spans}
    taken, final, attempt = {(space(k), n) for k, n in todo}, {}, 0
    while todo:
        drew = {}
        for n, k in sorted((n, k) for k, n in todo):
            drew.setdefault((space(k), pii.surrogate(key, k, n, attempt)), (k, n))
        for at, e in drew.items():
            if at not in taken:
                final[e] = at[1]
        taken |= {(space(k), s) for (k, _), s in final.items()}
        todo, attempt = {e for e in todo if e not in final}, attempt + 1
    out = []
    for t, spans in zip(texts, scans, strict=True):
        for start, end, kind, o in reversed(spans):
            norm = pii.normal(kind, o)
            t = t[:start] + pii.shaped(kind, o, final[told(kind, norm), norm]) + t[end:]
        out.append(t)
    return out, final


def test_equals_brute_force(spark):
    rng = random.Random(5)
    given = " ".join(pii.FIRST_NAMES.values()).split() + ["Xavier", "Pablo", "Kim", "Zoe"]
    last = ["Lopez", "Roe", "Poe", "Thomas", "Anna", "Balbalen", "Keller", "Петрова"]
    titles = ["Mr ", "Ms ", "Dr ", "Prof. ", ""]
    def part():
        g, la = rng.choice(given), rng.choice(last)
        return rng.choice([f"{rng.choice(titles)}{g} {la} left.", f"Dr {la} met {g}.", f"{la} slept; {g} did not.",
                           f"mail {g.lower()}@a{rng.randrange(3)}.org", f"call 555-{rng.randrange(100, 120)}-4567 now"])
    texts = [" ".join(part() for _ in range(rng.randrange(6))) for _ in range(300)]
    want, final = brute_force(texts, pii.DEFAULT_KEY)
    assert [t for t, _ in replaced(spark, texts)] == want
    names = [s for (k, _), s in final.items() if k.startswith(("first-", "last-"))]
    assert len(names) == len(set(names)) and not set(names) & {n for _, n in final}


def test_empty_table(spark):
    assert pii.digest(documents(spark, [TEXT]).limit(0)).count() == 0
