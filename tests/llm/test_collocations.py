"""Collocations against a count of every phrase in plain Python."""

import collections
import random
import re

import numpy as np
import pyarrow as pa

from hazardloom.llm import collocations

SCHEMA = "doc_id long, text string, lang string, phrase string, prefix string, next string, n long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", "y", "z", 3) for i, (t, lang) in enumerate(rows)], SCHEMA)


def brute(rows, longest, least, top, subsumed):
    f = collections.Counter()
    for text, lang in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            f.update((lang or "und", tuple(w[i:i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    n = collections.Counter()
    for (lang, w), c in f.items():
        n[lang] += c * (len(w) == 1)
    often = {k: c for k, c in f.items() if c >= least and len(k[1]) > 1}
    inside = collections.defaultdict(int)
    for (lang, w), c in often.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                inside[lang, w[i:i + k]] = max(inside[lang, w[i:i + k]], c)
    out = collections.defaultdict(list)
    for (lang, w), a in often.items():
        if 100 * inside[lang, w] >= subsumed * a:
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return {(lang, r, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for r, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)}


def got(frame):
    return [tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in frame.collect()]


def test_words_and_pieces():
    column = pa.array(["Aé b\tC. d", None, "", ",e", "Übung ÜB"])
    coded, piece, text = collocations.words(column)
    assert [coded.dictionary[i.as_py()].as_py().decode() for i in coded.indices] == ["aé", "b", "c", "d", "e", "Übung", "Üb"]
    assert text.tolist() == [0, 0, 0, 0, 3, 4, 4]
    assert (np.diff(piece) == 0).tolist() == [True, True, False, False, False, True]


def test_against_brute_force(spark):
    random.seed(5)
    vocabulary = ["The", "the", "of", "é", "日本", "a-b", "x y", "1", "New", "York", "z"]
    rows = [(" ".join(random.choice(vocabulary) + random.choice(["", "", "", "", ".", "  ", "\t", "\n", ","]) for _ in range(random.randint(0, 60))),
             random.choice(["en", "de", None, "und"])) for _ in range(150)]
    rows += [("new york of the a-b z", "en")] * 20 + [(None, "en"), ("", None), (None, None), ("one", "fr"), (".,;", "fr")]
    rows += [(" ".join(random.choice(vocabulary) for _ in range(30_000)), "en")]
    for longest, least, top, subsumed in ((5, 3, 2000, 100), (5, 2, 7, 60), (3, 5, 50, 100), (2, 1, 20, 100)):
        found = got(collocations.collocations(table(spark, rows), longest, least, top, subsumed))
        assert len(found) == len(set(found)) and set(found) == brute(rows, longest, least, top, subsumed)


def test_slices_and_small_bitmap(spark, monkeypatch):
    """The same rows from slices of a few words and from a bitmap so small that most of its hits are false."""
    rows = [("a b c d e f a b c. " * 9 + f"q{k} a b", "en") for k in range(12)]
    monkeypatch.setattr(collocations, "SLICE", 64)
    monkeypatch.setattr(collocations, "BITS", 10)
    assert set(got(collocations.collocations(table(spark, rows), 5, 3))) == brute(rows, 5, 3, 2000, 100)


def test_exact_scores(spark):
    """Products past 64 bits."""
    levels = [spark.createDataFrame(rows, "lang string, prefix string, next string, f long, phrase string") for rows in (
        [("en", "", "a", 4_000_000_000_001, "a"), ("en", "", "b", 4_000_000_000_003, "b")], [("en", "a", "b", 3_999_999_999_999, "a b")])]
    n = 10**15 + 7
    row = collocations.scored(levels, spark.createDataFrame([("en", n)], "lang string, n long")).first()
    assert row.score == 1000 * 3_999_999_999_999 * n // (4_000_000_000_001 * 4_000_000_000_003)


def test_empty(spark):
    for rows in ([], [(None, None)], [("one", "en")]):
        out = collocations.collocations(table(spark, rows))
        assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and out.count() == 0
