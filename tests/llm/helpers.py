"""Small tables with the hard cases, shared by the tests."""

LONG_WORD = "x" * 70_000
PROSE = ("The river ran high that spring, and the farmers moved their herds to the upper fields. "
         "Nobody in the valley could remember so much water. ")

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, did long, size long, dropped string, "
          "keys string, q_ledger string, mix_size long, dc_matches string, ld_lines long, spans string, node long, "
          "`a.b` string")


def documents(spark, texts, ids=None, sources=None):
    """Rows with extra columns whose names the operators use themselves."""
    ids = range(len(texts)) if ids is None else ids
    sources = ["s"] * len(texts) if sources is None else sources
    rows = [(i, t, None, s, None if t is None else len(t), 7, 7, "d", "k", "q", 7, "m", 7, "p", 7, "ab")
            for i, t, s in zip(ids, texts, sources, strict=True)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


EXTRA = {"did": 7, "size": 7, "dropped": "d", "keys": "k", "q_ledger": "q", "mix_size": 7, "dc_matches": "m",
         "ld_lines": 7, "spans": "p", "node": 7, "a.b": "ab"}


def same_extras(row, but=()):
    return all(row[c] == v for c, v in EXTRA.items() if c not in but)
