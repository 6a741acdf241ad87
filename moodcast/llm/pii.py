"""Personal data replaced by surrogates.

Detectors find e-mail addresses, phone numbers, IP addresses, card and
account numbers, secrets and person names.  Each entity gets a keyed
surrogate of its own type and format: letters for letters of the same
case and script, digits for digits, names of the same gender and script.
The same entity has the same surrogate in every document, and different
entities have different ones: all distinct entities are checked against
each other and against the originals, those of names over all kinds of
name parts, and those that collide draw again until none does.

A name found once in a text is found wherever its words stand alone in
it.  The mentions of a word in a text agree on its place (given name or
surname) and gender before anything is drawn, and all texts agree on its
gender: the one that more texts tell, none if they tell both alike.

Each text is scanned once; what was found is written beside the row,
under a number of its own.  The first draw follows from the key and the
entity alone, so only entities that differ from it travel to their rows.

Defined results: a null text stays null; entities never overlap, the
first and longest counts; rows are judged each by itself, repeated rows
and ids alike; other columns pass through untouched.  Originals are
neither returned nor kept beyond the run's scratch tables.
"""

from __future__ import annotations

import hashlib
import hmac
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: The key comes from the caller; this one is for tests and the check.
DEFAULT_KEY = "moodcast-example-key"

# Given names by script and gender, and parts of surnames.
FIRST_NAMES = {
    ("latin", "f"): "Alice Anna Carla Clara Diana Elena Emma Eva Helen Ines Julia Karen Laura Lucia Maria Marie Mary "
                    "Nina Olivia Paula Rosa Sarah Sofia Susan Vera",
    ("latin", "m"): "Adam Carlos Daniel David Erik Felix Frank George Hans Henry Ivan Jack James John Jorge Karl Louis "
                    "Luis Mark Martin Michael Paul Peter Robert Thomas",
    ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина Мария Наталья Ольга София Татьяна",
    ("cyrillic", "m"): "Алексей Андрей Борис Виктор Дмитрий Иван Михаил Николай Олег Сергей",
}
TITLES = {"Mr": "m", "Mister": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "господин": "m",
          "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Sra": "f",
          "госпожа": "f", "Dr": "", "Prof": ""}
SURNAME_PARTS = {"latin": "bal ber cor dal den fal gar hal kan lan lor mar mel nor pal ral ron sel tal ver".split(),
                 "cyrillic": "бар вел гор дал зар кол лаз мар нор пол рад сев тар фил".split()}
SURNAME_ENDS = {("latin", ""): "en er in son ton".split(), ("cyrillic", "m"): "ов ин ский".split(),
                ("cyrillic", "f"): "ова ина ская".split(), ("cyrillic", ""): "енко ук".split()}

_GIVEN = {n: (script, gender) for (script, gender), names in FIRST_NAMES.items() for n in names.split()}
_CAP = r"[A-ZÀ-ÖØ-ÞА-ЯЁ][\w’'-]*[\wà-ÿ]"
#: Between the parts of a phone number: a sign, after marks as junk has them.
_GAP = r"[!%#$&*]{0,3}[ .-]?"
_PATTERNS = [
    ("secret", re.compile(r"""(?i:\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key|auth)\b["']?\s*[:=]\s*)"""
                          r"""["']?([^\s"',;]{6,})""")),
    ("secret", re.compile(r"\b(?=[0-9a-fA-F]*[a-fA-F])(?=[0-9a-fA-F]*[0-9])([0-9a-fA-F]{32,})\b")),
    ("secret", re.compile(r"\b((?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_\w{30,}|sk-[\w-]{20,}|eyJ[\w-]+\.[\w-]+\.[\w-]+)")),
    ("email", re.compile(r"(?<![\w.+-])([\w.+-]+@(?:[\w-]+\.)+[^\W\d_]{2,})")),
    ("iban", re.compile(r"\b([A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)\b")),
    ("card", re.compile(r"(?<![\w.-])((?:\d{4}[ -]){3}\d{4}|\d{13,19}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])")),
    ("ip", re.compile(r"(?<![\w.])((?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d))(?!\.?\w)")),
    ("ip6", re.compile(r"(?<![\w:])((?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}|(?:[0-9a-fA-F]{1,4}:){1,6}(?::[0-9a-fA-F]{1,4}){1,6})(?![\w:])")),
    ("ssn", re.compile(r"(?<![\w-])(\d{3}-\d{2}-\d{4})(?![\w-])")),
    ("phone", re.compile(rf"(?<![\w.])(\+\d{{1,3}}{_GAP}(?:\(\d{{1,4}}\){_GAP})?\d{{1,4}}(?:{_GAP}\d{{2,4}}){{1,4}}"
                         rf"|\(\d{{2,4}}\){_GAP}\d{{3,4}}{_GAP}\d{{3,4}}|\d{{3}}[.-]\d{{3}}[.-]\d{{4}})(?![\w-]|\.\d)")),
    ("name", re.compile(rf"\b(?:{'|'.join(TITLES)})\b\.? +({_CAP}(?: +{_CAP}){{0,2}})")),
    ("name", re.compile(rf"\b((?:{'|'.join(_GIVEN)}) +{_CAP})")),
]
#: What must be in a text for a pattern to be worth a scan.
_NEEDS = {"email": "@", "ip6": ":"}
_DIGIT = re.compile(r"\d")
_TOKEN = re.compile(r"[^\s]+")
#: A word that may be a name told before; not a part of an address.
_MENTION = re.compile(r"(?<![\w.@/’'-])[^\W\d_](?:[\w’'-]*\w)?(?![\w@-]|\.\w)")
_OWNER = re.compile(r"[’']s\Z")


def _script(word: str) -> str:
    return "cyrillic" if re.search("[а-яА-ЯёЁ]", word) else "latin"


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, original) of the entities of a text.  The kind
    of a name's part tells its place, gender and script."""
    digits = _DIGIT.search(text) is not None
    spans: list[tuple[int, int, int, str, str]] = []
    for rank, (kind, pattern) in enumerate(_PATTERNS):
        if kind in _NEEDS and _NEEDS[kind] not in text or kind in ("iban", "card", "ip", "ssn", "phone") and not digits:
            continue
        for m in pattern.finditer(text):
            gender = ""
            if kind == "name":
                title = text[m.start():m.start(1)].rstrip(" .")
                first = m.group(1).split()[0]
                gender = _GIVEN[first][1] if first in _GIVEN else TITLES.get(title, "")
            spans.append((m.start(1), -m.end(1), rank, kind, gender))
    out: list[tuple[int, int, str, str]] = []
    parts: list[tuple[int, str, str, str, bool]] = []  # start, word, place, gender, part of a longer name
    done = 0
    for start, end, _, kind, gender in sorted(spans):
        if start < done:
            continue
        done = -end
        if kind != "name":
            out.append((start, done, kind, text[start:done]))
            continue
        words = [(m.start() + start, m.group()) for m in _TOKEN.finditer(text[start:done])]
        for i, (at, word) in enumerate(words):
            place = "first" if word in _GIVEN or i < len(words) - 1 else "last"
            own = _GIVEN[word][1] if word in _GIVEN else gender
            parts.append((at, word, place, own, len(words) > 1))
    if not parts:
        return out
    kinds = _agreed(parts)
    out += [(at, at + len(word), kinds[word], word) for at, word, *_ in parts]
    out.sort()
    again, i = [], 0
    for m in _MENTION.finditer(text):
        word = _OWNER.sub("", m.group())
        if word not in kinds:
            continue
        while i < len(out) and out[i][1] <= m.start():
            i += 1
        if i == len(out) or out[i][0] >= m.start() + len(word):
            again.append((m.start(), m.start() + len(word), kinds[word], word))
    return sorted(out + again)


def _agreed(parts: list[tuple[int, str, str, str, bool]]) -> dict[str, str]:
    """The kind of each word of the names of a text.  Longer names tell
    better than a word after a title whether it is a given name."""
    mentions: dict[str, list[tuple[str, str, bool]]] = {}
    for _, word, place, gender, longer in parts:
        mentions.setdefault(word, []).append((place, gender, longer))
    kinds = {}
    for word, told in mentions.items():
        best = [p for p, _, longer in told if longer] or [p for p, _, _ in told]
        place = "first" if "first" in best else "last"
        women, men = (sum(g == x for _, g, _ in told) for x in "fm")
        gender = "f" if women > men else "m" if men > women else ""
        script = _script(word)
        # A surname's form follows gender only where its script has such forms.
        kinds[word] = f"{place}-{script}-{gender if place == 'first' or script == 'cyrillic' else ''}"
    return kinds


class _Draw:
    """A keyed stream of numbers for one entity and attempt."""

    def __init__(self, key: str, kind: str, norm: str, attempt: int) -> None:
        self.key, self.label, self.n, self.pool = key.encode(), f"{kind}\0{norm}\0{attempt}".encode(), 0, 0
        self.left = 1

    def __call__(self, below: int) -> int:
        if self.left < below << 32:
            digest = hmac.new(self.key, self.label + self.n.to_bytes(4, "big"), hashlib.sha256).digest()
            self.pool, self.left, self.n = int.from_bytes(digest, "big"), 1 << 256, self.n + 1
        self.pool, out = divmod(self.pool, below)
        self.left //= below
        return out


def normal(kind: str, original: str) -> str:
    """What tells entities apart: spelling variants of one are one."""
    if kind in ("card", "phone", "ssn", "iban"):
        return re.sub(r"[^0-9A-Za-z+]", "", original)
    return original.lower() if kind in ("email", "ip6") else original


def _like(text: str, draw: _Draw) -> str:
    """Digits for digits and letters for letters of the same case."""
    out = []
    for c in text:
        if c.isdigit():
            out.append(str(draw(10)))
        elif c.isalpha():
            low, n = ("а", 32) if "а" <= c.lower() <= "я" else ("a", 26)
            new = chr(ord(low) + draw(n))
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out)


def surrogate(key: str, kind: str, norm: str, attempt: int = 0) -> str:
    """The surrogate of a normalised entity, itself normalised."""
    draw = _Draw(key, kind, norm, attempt)
    if kind.startswith("first-"):
        _, script, gender = kind.split("-")
        names = (FIRST_NAMES[script, gender] if gender else
                 FIRST_NAMES[script, "f"] + " " + FIRST_NAMES[script, "m"]).split()
        # Beyond the list, a second name tells the draws apart.
        more = ["-" + names[draw(len(names))] for _ in range((attempt + 2) // 3)]
        return names[draw(len(names))] + "".join(more)
    if kind.startswith("last-"):
        _, script, gender = kind.split("-")
        parts = SURNAME_PARTS[script]
        body = "".join(parts[draw(len(parts))] for _ in range(3 + attempt // 3))
        ends = SURNAME_ENDS.get((script, gender)) or SURNAME_ENDS[script, ""]
        return (body + ends[draw(len(ends))]).capitalize()
    if kind == "email":
        local, _, domain = norm.rpartition("@")
        # The same host has the same surrogate; the ending is kept.
        host, _, ending = domain.rpartition(".")
        extra = "".join(chr(97 + draw(26)) for _ in range((attempt + 2) // 3))
        return f"{_like(local, draw)}{extra}@{_like(host, _Draw(key, 'host', host, 0))}.{ending}"
    if kind == "ip":
        return ".".join(str(draw(254) + 1) for _ in range(4))
    if kind == "ip6":
        return re.sub("[0-9a-f]", lambda _: "0123456789abcdef"[draw(16)], norm)
    if kind == "iban":
        return norm[:2] + _like(norm[2:], draw)
    if kind == "phone" and norm.startswith("+"):
        return norm[:2] + _like(norm[2:], draw)  # the country stays
    if kind == "secret" and re.fullmatch("[0-9a-f]+|[0-9A-F]+", norm):
        digits = "0123456789ABCDEF" if norm.isupper() else "0123456789abcdef"
        return "".join(digits[draw(16)] for _ in norm)
    return _like(norm, draw)


def shaped(kind: str, original: str, norm: str) -> str:
    """A normalised surrogate in the original's spacing and signs."""
    if kind in ("card", "phone", "ssn", "iban"):
        chars = iter(norm)
        return "".join(next(chars) if re.match(r"[0-9A-Za-z+]", c) else c for c in original)
    return norm


_FOUND = "array<struct<kind:string,start:int,length:int,norm:string>>"


def _scan(text: pd.Series) -> pd.Series:
    return pd.Series([[{"kind": k, "start": s, "length": e - s, "norm": normal(k, o)} for s, e, k, o in find(t)]
                      if isinstance(t, str) else [] for t in text], dtype=object)


_scan.__annotations__ = {"text": pd.Series, "return": pd.Series}
_NAME = r"^((?:first|last)-[a-z]+)-([fm]?)$"


def resolved(entities: DataFrame) -> DataFrame:
    """(kind, norm, n texts) with ``told``, the kind with the gender that
    more texts tell."""
    base, gender = F.regexp_extract("kind", _NAME, 1), F.regexp_extract("kind", _NAME, 2)
    votes = (entities.where(base != "").groupBy(base.alias("v_base"), F.col("norm").alias("v_norm"))
             .agg(F.sum(F.when(gender == "f", F.col("n")).when(gender == "m", -F.col("n")).otherwise(0)).alias("v")))
    told = F.concat("v_base", F.lit("-"), F.when(F.col("v") > 0, "f").when(F.col("v") < 0, "m").otherwise(""))
    both = entities.join(votes, (base == votes["v_base"]) & (entities["norm"] == votes["v_norm"]), "left")
    return both.select("kind", "norm", F.coalesce(told, "kind").alias("told"))


def _space(kind: str) -> Column:
    """Entities of one space have different surrogates: all parts of names
    are one space, any other kind is one of its own."""
    return F.when(F.col(kind).rlike(_NAME), "name").otherwise(F.col(kind))


def _drawn(entities: DataFrame, key: str, attempt: int) -> DataFrame:
    def draw(kind: pd.Series, norm: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, k, n, attempt) for k, n in zip(kind, norm, strict=True)])

    udf = F.pandas_udf(_hinted(draw), "string")
    return entities.withColumn("surrogate", udf("kind", "norm"))


def _hinted(f):
    f.__annotations__ = {"kind": pd.Series, "norm": pd.Series, "return": pd.Series}
    return f


def assign(entities: DataFrame, key: str) -> DataFrame:
    """Distinct (kind, norm) -> those that had to draw again, with their
    ``surrogate``.  Ends with all surrogates of a space different and none
    an original of it."""
    entities = common.written(entities.select("kind", "norm", _space("kind").alias("space")), "pii-entities")
    settled = None
    todo, attempt = entities, 0
    taken = entities.select("space", F.col("norm").alias("surrogate"))
    while True:
        drawn = common.written(_drawn(todo.select("kind", "norm"), key, attempt)
                               .withColumn("space", _space("kind")), "pii-drawn")
        # One of those that drew alike stays; none that drew a taken one.
        best = drawn.groupBy("space", "surrogate").agg(F.min(F.struct("norm", "kind")).alias("e"))
        free = best.join(taken, ["space", "surrogate"], "left_anti")
        settled_now = common.written(free.select("e.kind", "e.norm", "space", "surrogate"), "pii-settled")
        todo = drawn.select("kind", "norm").join(settled_now, ["kind", "norm"], "left_anti")
        if attempt:
            now = settled_now.drop("space")
            settled = now if settled is None else settled.unionByName(now)
        if todo.isEmpty():
            break
        taken = taken.unionByName(settled_now.select("space", "surrogate"))
        attempt += 1
    return settled if settled is not None else entities.select("kind", "norm", F.lit("").alias("surrogate")).limit(0)


def _replacer(key: str):
    def replace(text: pd.Series, found: pd.Series, again: pd.Series) -> pd.DataFrame:
        texts, entities = [], []
        for t, spans, other in zip(text, found, again, strict=True):
            if not isinstance(t, str):
                texts.append(None)
                entities.append([])
                continue
            known = {(e["kind"], e["norm"]): e for e in other} if other is not None else {}
            parts, named, done = [], [], 0
            for span in spans:
                kind, norm, start, end = span["kind"], span["norm"], span["start"], span["start"] + span["length"]
                e = known.get((kind, norm))
                new = e and e["surrogate"] or surrogate(key, e["told"] if e else kind, norm)
                new = shaped(kind, t[start:end], new)
                parts += [t[done:start], new]
                named.append({"kind": e["told"] if e else kind, "start": start, "length": end - start, "surrogate": new})
                done = end
            texts.append("".join([*parts, t[done:]]))
            entities.append(named)
        return pd.DataFrame({"text": texts, "entities": entities})

    replace.__annotations__ = {"text": pd.Series, "found": pd.Series, "again": pd.Series, "return": pd.DataFrame}
    return replace


_ENTITIES = "array<struct<kind:string,start:int,length:int,surrogate:string>>"
_REPLACED = f"text string, entities {_ENTITIES}"


def pseudonymise(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``pii_entities``: kind,
    start and length in the original, and surrogate of each."""
    common.prepare(docs.sparkSession)
    rows = common.written(docs.select(common.row_struct(docs).alias("pii_row"),
                                      F.pandas_udf(_scan, _FOUND)(F.col("text")).alias("pii_found"),
                                      F.monotonically_increasing_id().alias("pii_id")), "pii-found")
    # Each entity once per text.
    each = F.array_distinct(F.transform("pii_found", lambda e: F.struct(e["kind"].alias("kind"), e["norm"].alias("norm"))))
    found = rows.select("pii_id", F.explode(each).alias("e")).select("pii_id", "e.kind", "e.norm")
    entities = common.written(resolved(found.groupBy("kind", "norm").agg(F.count("*").alias("n"))), "pii-told")
    drawn_again = assign(entities.select(F.col("told").alias("kind"), "norm").distinct(), key)
    other = entities.join(drawn_again.withColumnRenamed("kind", "told"), ["told", "norm"], "left").where(
        F.col("surrogate").isNotNull() | (F.col("told") != F.col("kind")))
    again = (found.join(other, ["kind", "norm"]).groupBy(F.col("pii_id").alias("p_id"))
             .agg(F.collect_list(F.struct("kind", "norm", "told", "surrogate")).alias("again")))
    # Rows without entities take no part in the join.
    some = F.size("pii_found") > 0
    held = rows.where(some)
    held = held.join(again, held["pii_id"] == again["p_id"], "left")
    out = held.select("pii_row", F.pandas_udf(_replacer(key), _REPLACED)(F.col("pii_row.text"), F.col("pii_found"),
                                                                         F.col("again")).alias("pii_new"))
    plain = F.struct(F.col("pii_row.text").alias("text"), F.array().cast(_ENTITIES).alias("entities"))
    out = out.unionByName(rows.where(~some).select("pii_row", plain.alias("pii_new")))
    added = {"text": F.col("pii_new.text"), "pii_entities": F.col("pii_new.entities")}
    return out.select(*common.unpacked(docs, "pii_row", added))


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: the text with surrogates and its entities."""
    return pseudonymise(docs.select("doc_id", "text")).select(
        "doc_id", "text", F.size("pii_entities").cast("long").alias("n_entities"),
        F.col("pii_entities").alias("entities"))
