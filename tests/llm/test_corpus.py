"""Corpus operators against brute force, libraries and held-out labels, and on awkward tables."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from hazardloom.llm import (decontaminate, fingerprint, jaccard, language, pieces, pii, quality,  # noqa: E402
                            suffix, tokencount, toxicity)

SCHEMA = "doc_id long, text string, lang string, anchor string, token string, th string, rid string, comp string, _id string, comp2 string"
COLUMNS = ["doc_id", "text", "lang"]
LONG = " ".join(f"w{i * 7919 % 1000}x" for i in range(9000))


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "a", "b", "c", "d", "e", "f", "g") for i, t, lang in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing column names."""
    base = "the quick brown fox jumps over the lazy dog and runs away from it all day long\nsecond line here\n" * 6
    rows = [(1, None, "en"), (2, "", None), (3, LONG, "en"), (4, LONG, "en"), (4, LONG, "en"), (5, base, "en"), (5, base + "more words at the end", "en"),
            (6, "one", "de"), (7, "one", "de"), (8, "!!! 123", "de"), (None, "nobody knows", None), (9, "a▁b  c\n", "fr"), (10, LONG[:40000], "fr")]
    return rows, table(spark, rows)


def empty(spark):
    return table(spark, [])


def sets(text):
    w = [x.lower() for x in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def test_jaccard(spark, odd):
    random.seed(3)
    words = [f"v{i}" for i in range(400)]
    rows = []
    for g in range(6):
        text = [random.choice(words) for _ in range(80)]
        for _ in range(12):
            copy = list(text)
            for _ in range(random.randint(0, 3)):
                copy[random.randrange(80)] = random.choice(words)
            rows.append((len(rows), " ".join(copy), "en"))
    every = [(i, sets(t)) for i, t, _ in rows]
    head = {i: i for i, _ in every}

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for k, (i, x) in enumerate(every):
        for j, y in every[:k]:
            if x and 100 * len(x & y) >= 75 * len(x | y):
                a, b = sorted((find(i), find(j)))
                head[b] = a
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_components(table(spark, rows)).collect()}
    assert got == {i: (len(x), find(i)) for i, x in every}
    out = jaccard.similar_components(odd[1]).collect()
    assert len(out) == len(odd[0])
    comp = {(r.doc_id, r.n_shingles): r.component_id for r in out}
    assert comp[1, 0] == 1 and comp[2, 0] == 2 and comp[7, 1] == 6
    assert {c for (i, _), c in comp.items() if i in (3, 4)} == {3}
    assert jaccard.similar_components(empty(spark)).count() == 0
    # an id that repeats with different texts: each text keeps its own links
    near, far = rows[0][1], rows[20][1]
    again = [(1, near, "en"), (1, far, "en"), (1, far, "en"), (3, far + " tail", "en"), (2, near + " tail", "en"), (None, far, "en"), (7, "alone here", "en")]
    found = jaccard.similar_components(table(spark, again)).collect()
    assert sorted(((r.doc_id or -1, r.component_id) for r in found)) == [(-1, 1), (1, 1), (1, 1), (1, 1), (2, 1), (3, 1), (7, 7)]
    assert sorted(r.doc_id or -1 for r in jaccard.one_of_each(table(spark, again)).collect()) == [-1, 1, 1, 1, 7]


def test_shingle_sets():
    """Sizes of the sets, order within a text, and one value for one shingle wherever it stands."""
    import pyarrow as pa

    from hazardloom.llm.common import utf8

    texts = ["", None, "a b", "A b", "  x  ", LONG, "q w e r t " * 2000, LONG[-3000:], "é ü " * 7, "w0x"]
    value, bounds = jaccard.shingle_sets(*utf8(pa.array(texts)))
    assert np.diff(bounds).tolist() == [len(sets(t)) for t in texts]
    got = [value[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert all((g[1:] > g[:-1]).all() for g in got) and (got[2] == got[3]).all()
    assert len(np.intersect1d(got[5], got[7])) == len(sets(texts[5]) & sets(texts[7]))
    weight = np.random.default_rng(0).integers(0, 9, len(value))
    want = np.lexsort((np.arange(len(value)), weight, np.repeat(np.arange(len(texts)), np.diff(bounds))))
    assert (jaccard._by_weight(weight, bounds) == want).all()


def test_suffix(spark, odd):
    random.seed(1)
    for _ in range(40):
        ts = ["".join(random.choice("ab") for _ in range(random.randint(0, 60))).encode() for _ in range(random.randint(1, 6))]
        n = random.randint(1, 9)
        c = collections.Counter(t[i:i + n] for t in ts for i in range(len(t) - n + 1))
        assert [x.tolist() for x in suffix.repeated_starts(ts, n)] == [[i for i in range(len(t) - n + 1) if c[t[i:i + n]] > 1] for t in ts]
    rows = odd[0]
    c = collections.Counter(b[i:i + 400] for _, t, _ in rows for b in [(t or "").encode()] for i in range(len(b) - 399))
    want = collections.Counter()
    for i, t, _ in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 399):
            if c[b[k:k + 400]] > 1:
                gone[k:k + 400] = b"\1" * 400
        want[i, sum(gone), hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()] += 1
    assert collections.Counter((r.doc_id, r.n_removed, r.kept_sha256) for r in suffix.remove_repeats(odd[1]).collect()) == want
    assert suffix.remove_repeats(empty(spark)).count() == 0


def test_suffix_large_group(spark, monkeypatch):
    """A passage in many different surroundings: no transform takes the whole group, and results stay exact."""
    random.seed(2)
    solve, limit = suffix.repeated_starts, 4000

    def bounded(texts, length):
        assert sum(map(len, texts)) <= 2 * limit
        return solve(texts, length)

    monkeypatch.setattr(suffix, "JOINED", limit)
    monkeypatch.setattr(suffix, "repeated_starts", bounded)
    noise = lambda n: "".join(random.choice("abcdefghij ") for _ in range(n))
    passage = noise(400)
    texts = [noise(random.randint(0, 300)) + passage + (passage[:7] if i % 3 else "") + noise(random.randint(0, 300)) for i in range(80)]
    texts += [noise(50) + noise(1) + passage[1:] + noise(50), noise(700)]
    c = collections.Counter(t[i:i + 400] for t in texts for i in range(len(t) - 399))
    got = {r.doc_id: r.spans for r in suffix.remove_repeats(table(spark, [(i, t, "en") for i, t in enumerate(texts)])).collect()}
    for i, t in enumerate(texts):
        gone = np.zeros(len(t) + 2, int)
        for k in range(len(t) - 399):
            if c[t[k:k + 400]] > 1:
                gone[k + 1:k + 401] = 1
        edge = np.flatnonzero(np.diff(gone)).tolist()
        assert got[i] == ",".join(f"{a}:{b}" for a, b in zip(edge[::2], edge[1::2], strict=True))


def test_suffix_large_groups_stay_where_they_are(spark, monkeypatch):
    """The quarters of large groups are picked out without shuffling the others."""
    plans = []

    def spy(quarters, length, scratch):
        plans.append(quarters._jdf.queryExecution().toString())
        return counted(quarters, length, scratch)

    counted = suffix._counted
    monkeypatch.setattr(suffix, "JOINED", 2000)
    monkeypatch.setattr(suffix, "_counted", spy)
    random.seed(5)
    noise = lambda n: "".join(random.choice("abcdefghij ") for _ in range(n))
    passage, limit = noise(420), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(i, noise(90) + passage + noise(90), "en") for i in range(30)]
        got = suffix.remove_repeats(table(spark, rows)).select("n_removed").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plans and "hashpartitioning" not in plans[0] and min(r.n_removed for r in got) >= 420


def test_fingerprint(spark, odd):
    rows = [(i, t, lang) for i, t, lang in odd[0] if i is not None and i not in (4, 5)]
    rows.append((50, "\n".join(f"line {i}" for i in range(2000)), "en"))
    got = {r.doc_id: r for r in fingerprint.fingerprints(table(spark, rows)).collect()}
    texts = [(i, t or "") for i, t, _ in sorted(rows)]
    for k, (i, t) in enumerate(texts):
        after = texts[(k + 1) % len(texts)][1]
        q = len(t) // 4
        edited = t[:len(t) - q] + after[:q]
        a, b, c = ({x for x in s.split("\n") if x} for s in (t, edited, after))
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].near_edited == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        assert got[i].near_next == pytest.approx(len(a & c) / len(a | c) if a | c else 1.0)
    assert got[6].fingerprint == got[7].fingerprint
    assert fingerprint.fingerprints(odd[1]).count() == len(odd[0])
    assert fingerprint.fingerprints(empty(spark)).count() == 0


def test_language(spark, odd):
    rows = [(i, f"the cat and the hat number {i} with them", "en") for i in range(40)] + [(100 + i, f"der hund und die katze nummer {i} mit ihnen", "de") for i in range(40)]
    model = language.fit_languages(table(spark, rows))
    got = language.predict_languages(table(spark, [(1, "the hat with the cat", None), (2, "die katze und der hund", None), (3, None, None), (4, "12 !", None)]), model).collect()
    assert [r.lang_pred for r in got] == ["en", "de", "und", "und"] and got[2].score == 0
    tables, symbols = model.tables[0]
    symbols_of = dict(zip("the", language.grams(["the"])[0] & np.uint64(63), strict=True))
    context = (symbols_of["t"] << np.uint64(12) | symbols_of["h"] << np.uint64(6) | symbols_of["e"]) << np.uint64(6)
    gram = language.grams(["the hat", None, "", "a", LONG])[0]
    for got_of, want_of in zip(language.distinct_grams(gram), np.unique(gram, return_inverse=True), strict=True):
        assert (got_of == want_of).all()
    assert int(max(t.key.max() for t in tables)) < 1 << 24 and len({*language.grams(["абвгдежзийклмнопрстуфхцчшщъыьэюя"])[0] & np.uint64(63)}) == 32
    total = language.backed(tables, context | tables[0].key, symbols).sum()
    assert 0.9 < total <= 1 + 1e-9  # of known symbols; the rest is left for unknown ones
    assert language.predict_languages(odd[1], language.fit_languages(odd[1])).count() == len(odd[0])
    far = language.predict_languages(table(spark, [(1, chr(0xF0000) * 5, None), (2, chr(0x10FFFF), None), (3, chr(0x30001), None)]), model).collect()
    assert [r.lang_pred == "und" for r in far] == [True, True, False]
    none = language.fit_languages(empty(spark))
    assert {r.lang_pred for r in language.predict_languages(odd[1], none).collect()} == {"und"}


def test_toxicity_and_quality(spark, odd):
    random.seed(5)
    words = ["".join(random.choice(["an", "er", "th", "in", "es"]) for _ in range(random.randint(1, 4))) for _ in range(300)]
    rows, labels = [], []
    for i in range(400):
        w = [random.choice(words) for _ in range(60)]
        bad = i % 2
        if bad:
            for _ in range(3):
                w[random.randrange(60)] = random.choice(["grumblefoot", "snotface", "blockhead"])
        lines = [" ".join(w[k:k + 12]) + "." for k in range(0, 60, 12)]
        if i % 3 == 0:
            lines = [x.upper() + "!!" for x in lines]
        rows.append((i, "\n".join(lines), "en"))
        labels.append((i, int(i % 3 != 0), bad))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = table(spark, rows)
    held = lambda c: c % 4 != 2
    model = toxicity.fit_toxicity(docs, marks, held)
    score = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    assert np.mean([(score[i] >= 0.5) == t for i, _, t in labels if i % 4 == 2]) > 0.95
    crf = quality.fit_quality(docs, marks, held)
    score = {r.doc_id: r.score for r in quality.score_quality(docs, crf).collect()}
    assert np.mean([(score[i] >= 0.7) == q for i, q, _ in labels if i % 4 == 2]) > 0.95
    for m, f in ((model, toxicity.score_toxicity), (crf, quality.score_quality)):
        assert all(0 <= r.score <= 1 for r in f(odd[1], m).collect()) and f(empty(spark), m).count() == 0
    unlabelled = marks.where("false")
    assert quality.good_documents(odd[1], quality.fit_quality(docs, unlabelled), 0.5).count() == len(odd[0])
    assert toxicity.fit_toxicity(docs, unlabelled).constant == 0.0


def test_chain_messages():
    """Marginals of a short chain against all label sequences."""
    score, link = np.array([0.3, -1.0, 2.0, 0.1]), np.array([[0.5, -0.2], [0.1, 0.9]])
    f, b = quality.messages(score, np.array([0, 4]), link)
    weight = np.zeros((4, 2))
    for y in np.ndindex(2, 2, 2, 2):
        w = np.exp(sum(s * v for s, v in zip(score, y, strict=True)) + sum(link[p, q] for p, q in zip(y, y[1:], strict=False)))
        for k, v in enumerate(y):
            weight[k, v] += w
    assert np.allclose(f + b, np.log(weight[:, 1] / weight[:, 0]))


def test_tokens(spark, odd):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = tokencount.load(path)
    text = LONG[:3000] + " it's <|endoftext|> " + "é" * 500 + "\n　日本語\x1c x" + "y" * 900
    whole = len(tokenizer.encode(text, add_special_tokens=False).ids)
    for chunk, overlap in ((64, 4), (300, 16), (5000, 1)):
        assert tokencount.spliced_count(tokenizer, text, chunk, overlap) == whole
    got = tokencount.count_tokens(table(spark, [*odd[0], (77, text, "en")]), path).collect()
    want = collections.Counter((i, len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in [*odd[0], (77, text, "en")])
    assert collections.Counter((r.doc_id, r.n_tokens) for r in got) == want
    assert tokencount.count_tokens(empty(spark), path).count() == 0


def test_pieces(spark, odd):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["", "  a  b ", "日本語 \n\tx 😀", LONG[:2000], "The quick brown fox."]
    plain = pieces.Encoder(path, 0.0)
    assert [np.frombuffer(x, "<i4").tolist() for x in plain.encode(texts, [0] * 5)] == [library.encode(t) for t in texts]
    coded = pieces.encode_documents(odd[1], path)
    assert coded.columns[:2] == ["doc_id", "text"] and coded.columns[-1] == "pieces"
    back = pieces.decode_documents(coded, path)
    assert collections.Counter(map(tuple, back.collect())) == collections.Counter((i, t) for i, t, _ in odd[0])
    dropped = pieces.Encoder(path, 0.3)
    assert dropped.encode(texts[-1:], [0]) != dropped.encode(texts[-1:], [1])
    words = dropped.encode(["straightforwardness " * 40], [3])[0]
    assert len(pieces._PART.findall("▁straightforwardness " * 40)) == 40 and words[:len(words) // 2] != words[len(words) // 2:]  # a word varies within a text
    assert pieces.encode_documents(empty(spark), path).count() == 0


def test_dropout_against_plain_agenda():
    """Shared agendas and the heap of long parts give what a plain scan for the best unskipped merge gives."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    random.seed(4)
    words = ["the", "of", "hello", "antidisestablishment", "日本語", "é😀\ue000", "x" * 60, "abcdefghij" * 6, "straightforwardness"]
    texts = [" ".join(random.choice(words) for _ in range(50)) for _ in range(4)]
    model = pieces.Pieces(path)
    pair = dict(zip(model.key.tolist(), model.made.tolist(), strict=True))

    def plain(part, key, limit):
        row = [(x, i) for i, x in enumerate(model.symbols(part).tolist())]
        while True:
            found = []
            for k in range(len(row) - 1):
                (a, i), (b, _) = row[k], row[k + 1]
                if a >= 0 and b >= 0 and (made := pair.get(a << 32 | b)) is not None:
                    draw = int(pieces.mix(pieces.merge_codes(np.array([a << 32 | b]), np.array([i])) ^ np.uint64(key))[0])
                    if draw >= limit:
                        found.append((int(model.rank[made]), k, made))
            if not found:
                return model.coded([x for x, _ in row])
            _, k, made = min(found)
            row[k:k + 2] = [(made, row[k][1])]

    for rate in (0.0, 0.1, 0.5):
        for longest in (0, 40, 1000):
            encoder = pieces.Encoder(path, rate, seed=9, long=longest)
            for i, (t, got) in enumerate(zip(texts, encoder.encode(texts, [7, 8, None, 9]), strict=True)):
                parts = pieces._PART.findall("▁" + t.replace(" ", "▁"))
                keys = pieces.occurrence_keys(np.full(len(parts), [7, 8, 0, 9][i]), np.arange(len(parts)), 9)
                assert got == b"".join(plain(w, int(k), encoder.limit) for w, k in zip(parts, keys, strict=True))
                assert model.decode(np.frombuffer(got, "<i4")) == t


def test_toxic_windows():
    """A window's gain is the difference of its two compressed lengths; evidence is that of all windows of the whole text."""
    import zstandard

    model = toxicity.ToxicityModel(b" grumblefoot  snotface ", b" the  cat  sat  on ", threshold=3, weights=(0.0,) * 5)
    text = "The cat " * 300 + "SNOTFACE sat on grumblefoot grumblefoot " + "z" * 100

    def size(raw, window):
        ends = bytes(range(128, 192)), bytes(range(200, 216))
        raw = raw + ends[0] + ends[1]
        known = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        settings = zstandard.ZstdCompressionParameters.from_level(
            9, dict_size=len(raw), source_size=128, format=zstandard.FORMAT_ZSTD1_MAGICLESS, min_match=3, strategy=zstandard.STRATEGY_LAZY2,
            window_log=18, hash_log=16, chain_log=16, write_content_size=False, write_checksum=False, write_dict_id=False)
        return len(zstandard.ZstdCompressor(dict_data=known, compression_params=settings).compress(ends[0] + b" " + window + b" " + ends[1]))

    every = toxicity.windows(text)
    gains = [size(model.ordinary, w) - size(model.toxic, w) for w in every]
    assert len(every) == 600 + 5 + 3 and [model.gain(w) for w in every] == gains
    most, over, n = model.evidence([text], {})[0]
    assert (most, over) == (max(gains), sum(g >= 3 for g in gains)) and over >= 3 and n == pytest.approx(np.log1p(len(every)))


def test_pii(spark, odd):
    text = "x@y.zz a.b@c.d@e.f 1.2.3.4 999.1.1.1, 4111 1111 1111 1111 +1 (456) 555-2186, é +12 "
    spans = pii.base_spans(text)
    assert [text[a:b] for _, a, b in spans] == ["x@y.zz", "a.b@c.d", "1.2.3.4", "4111 1111 1111 1111", "+1 (456) 555-2186"]
    assert pii.redact(text, spans).startswith("<EMAIL> <EMAIL>@e.f <IP> 999.1.1.1, <CARD> <PHONE>,")
    docs = table(spark, [*odd[0], (70, text, "en")])
    got = {r.doc_id: r for r in pii.find_pii(docs, pii.fit_pii(docs)).collect()}
    assert got[70].base_sha256 == hashlib.sha256(pii.joined(spans).encode()).hexdigest() and got[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.redacted(docs, pii.fit_pii(docs)).columns == docs.columns
    assert pii.find_pii(empty(spark), pii.fit_pii(empty(spark))).count() == 0
    assert pii.base_spans("1" * 300_000 + "@" * 1000) == []
    covered = pii.Covered(spans)
    for a in range(len(text)):
        for b in range(a + 1, len(text) + 1):
            assert covered.any(a, b) == any(s < b and a < e for _, s, e in spans)


def test_decontamination(spark, odd):
    passage = "The committee met on a wet Tuesday to decide which of the nine proposals should go forward to the council."
    changed = passage.replace("nine", "ten").replace("wet", "wett")
    rows = [*odd[0], (60, "before " + passage.upper() + " after", "en"), (61, "é" * 9 + changed, "en"), (62, passage[:50], "en")]
    bench = spark.createDataFrame([(1, passage), (2, None), (3, "short")], "item_id long, text string")
    got = sorted(map(tuple, decontaminate.contaminated(table(spark, rows), bench).collect()))
    assert [g[:2] for g in got] == [(60, 1), (61, 1)] and got[0][2:] == (7, 7 + len(passage), 0) and got[1][4] <= 4 and got[1][2] == 9
    kept = decontaminate.clean_documents(table(spark, rows), bench)
    assert kept.count() == len(rows) - 2
    often = table(spark, [(63, (passage + " and then ") * 150, "en"), (64, (changed + " ") * 70, "en")])
    got = collections.Counter(r.doc_id for r in decontaminate.contaminated(often, bench).collect())
    assert got == {63: 150, 64: 70}
    assert decontaminate.contaminated(empty(spark), bench).count() == 0
    assert decontaminate.contaminated(odd[1], bench.where("false")).count() == 0


def test_decontamination_null_items(spark):
    passage = ["The committee met on a wet Tuesday to decide which of them should go.", "Nobody had expected that the bridge would be closed for so many years."]
    docs = table(spark, [(1, passage[0], "en"), (2, passage[1], "en"), (None, passage[0], "en"), (4, "other", "en")])
    bench = spark.createDataFrame([(None, passage[0]), (None, passage[1]), (7, passage[1]), (None, None)], "item_id long, text string")
    got = collections.Counter((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect())
    assert got == collections.Counter([(1, None), (None, None), (2, None), (2, 7)])
    assert [r.doc_id for r in decontaminate.clean_documents(docs, bench).collect()] == [4]


def test_language_limit_is_of_all_training_texts(spark):
    # the odd text is one in 900 and stands apart: a limit from some hundred texts would miss it
    rows = [(k, f"the hat and the cat {'abcdefghij'[k % 10]} sat {k}", "en") for k in range(899)] + [(899, "qxz", "en")]
    docs = table(spark, rows)
    model = language.fit_languages(docs)
    entropy = [r.entropy for r in language.predict_languages(docs, model).collect()]
    assert model.limit == pytest.approx(np.quantile(entropy, 0.999), rel=1e-12)
