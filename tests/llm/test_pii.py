"""Added spans of the personal-data operator: other writings are found, everyday numbers are left alone."""

import hashlib
import re

import numpy as np
import pytest

pytest.importorskip("hazardloom.llm")

from hazardloom.llm import pii  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, kind int"


def card(k):
    head = f"4{k * 7919 % 10**14:014d}"
    return next(head + str(c) for c in range(10) if pii.luhn(head + str(c)))


def learnt(k):
    word = "ab cde fghi jklmn op qrstuvwx".split()[k % 6]
    phone = (f"+49 {150 + k % 30} {1000000 + k * 7919}", f"+1 ({200 + k}) 555-{1000 + k}", f"+44-20-{1000 + k}-{2000 + k}")[k % 3]
    number = card(k)
    number = number if k % 2 else " ".join(number[i:i + 4] for i in range(0, 16, 4))
    return (f"{word} to user{k}.name@mail{k % 9}.example.org {word}, server 10.{k % 200}.3.{k * 7 % 250} is {word}; "
            f"phone {phone} or {word} {number} ends {k % 90 + 1900}-{k % 9 + 1991}")


PLANTED = [
    ("email", "write to jane.doe at mail4 dot example dot org today", "jane.doe at mail4 dot example dot org"),
    ("email", "write to jane.doe[at]mail4.example.org today", "jane.doe[at]mail4.example.org"),
    ("ip", "today, server 10[.]44[.]3[.]17 is up;", "10[.]44[.]3[.]17"),
    ("card", "or card 4111.1111.1111.1111 ends", "4111.1111.1111.1111"),
    ("phone", "is up; phone 0049 160 1234567 or", "0049 160 1234567"),
    ("phone", "is up; phone (0456) 555-2186 or", None),  # found or not, nothing else may be
]
PLAIN = ["in 1999-2003 and on 2004-05-06 12:30", "the 1,234,567 people of 03.05.2011", "or card 4111.1111.1111.1112 ends", "at home dot", ""]


@pytest.fixture(scope="module")
def fitted(spark):
    rows = [(k, learnt(k), None, 1) for k in range(300)] + [(900, None, "en", None), (901, "", "en", None), (None, "x", None, 1), (3, learnt(3), None, 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    return docs, pii.fit_pii(docs)


def test_added_span_of_each_kind(spark, fitted):
    _, model = fitted
    docs = spark.createDataFrame([(i, t, None, 0) for i, (_, t, _) in enumerate(PLANTED)], SCHEMA)
    found = {r.doc_id: r for r in pii.find_pii(docs, model).collect()}
    for i, (kind, text, span) in enumerate(PLANTED):
        assert pii.base_spans(text) == [] and found[i].base_sha256 == hashlib.sha256(b"").hexdigest()
        if span is not None:
            at = text.index(span)
            assert found[i].spans == f"{kind}:{at}:{at + len(span)}" and found[i].n_added == 1
    new = {r.doc_id: r.text for r in pii.redacted(docs, model).collect()}
    assert new[0] == "write to <EMAIL> today" and new[3] == "or card <CARD> ends"


def test_ordinary_numbers_stay(spark, fitted):
    _, model = fitted
    got = pii.find_pii(spark.createDataFrame([(i, t, None, 0) for i, t in enumerate(PLAIN)], SCHEMA), model).collect()
    assert [r.spans for r in got] == [""] * len(PLAIN)


def test_base_spans_stay(spark, fitted):
    docs, model = fitted
    rows = {r.doc_id: r for r in pii.find_pii(docs, model).collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert len(rows) == len(texts) and pii.find_pii(docs, model).count() == docs.count()
    for i, r in rows.items():
        base = pii.base_spans(texts[i])
        assert r.base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert set(filter(None, pii.joined(base).split(","))) <= set(r.spans.split(","))


def test_base_spans_by_plain_expressions():
    rng = np.random.default_rng(5)
    signs = ["a", "b.", "@", "1", "23", ".", "-", " ", "+4", "255", "(", ")", "4111 1111 1111 1111", "x@y.z", "10.0.0.1", "\n"]
    for _ in range(400):
        text = "".join(rng.choice(signs, 40))
        want = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
        want += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
        for kind, expression, low, high in ((2, r"[0-9]([\x20-]?[0-9])+", 16, 19), (3, r"\+[0-9][\x20().0-9-]+[0-9]", 8, 15)):
            for m in re.finditer(expression, text):
                digits = re.sub("[^0-9]", "", m.group())
                if low <= len(digits) <= high and (kind == 3 or pii.luhn(digits)):
                    want.append((kind, m.start(), m.end()))
        assert sorted(pii.base_spans(text)) == sorted(want), text


def test_threshold_by_hand():
    rng = np.random.default_rng(6)
    for _ in range(50):
        m, y = rng.integers(-3, 12, 60).astype(float), rng.integers(0, 8, 60) > 0
        limit = pii.threshold(m, y.astype(float), 0.1)
        kept = m >= limit
        assert not kept.any() or (y[kept] == 0).mean() <= 0.1
        lower = [t for t in set(m) if 0 <= t < limit and (y[m >= t] == 0).mean() <= 0.1]
        assert not lower


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "nothing here", None, 0), (2, None, None, 0)], SCHEMA)
    model = pii.fit_pii(docs)
    assert model.limits == {} and [r.n_added for r in pii.find_pii(docs, model).collect()] == [0, 0]
    assert pii.redacted(docs, model).collect() == docs.collect()


def test_fit_uses_every_example_in_any_layout(spark):
    docs = spark.createDataFrame([(k, learnt(k), None, 1) for k in range(40)], SCHEMA)
    one = pii.fit_pii(docs)
    with pytest.MonkeyPatch.context() as patch:  # few rounds: each is two passes
        patch.setattr(pii.boost, "__defaults__", (1, 3, pii.RATE))
        few, many = pii.fit_pii(docs), pii.fit_pii(docs.repartition(5), block=100)
    assert many == few and few.nodes == one.nodes[:3]
    every = {(y, tuple(x)) for k in range(40) for y, x in pii.examples(learnt(k))}
    x, y = np.array([x for _, x in every]), np.array([y for y, _ in every])
    key = [int.from_bytes(hashlib.blake2b(bytes([b]) + a.tobytes(), digest_size=7).digest(), "big") for a, b in zip(x, y.tolist())]
    seen = np.array([k // 7 % 4 != 0 for k in key])
    assert np.isclose(one.prior, np.log(y[seen].mean() / (1 - y[seen].mean())))
    margin, kinds = one.margin(x), x[:, 0]
    for kind, limit in one.limits.items():
        judged = (kinds == kind) & (~seen if ((kinds == kind) & ~seen & (y == 1)).sum() >= pii.FEW else True)
        assert np.isclose(limit, pii.threshold(margin[judged], y[judged].astype(float)))
    assert set(one.limits) == set(range(4))


def test_cut_points_are_lower_quantiles():
    rng = np.random.default_rng(3)
    for size in (1, 5, 32, 33, 400):
        v = rng.integers(0, 60, size).astype(float)
        found = dict(zip(*(a.tolist() for a in np.unique(v, return_counts=True))))
        assert pii.cut_points(found).tolist() == np.unique(np.quantile(v, np.linspace(0, 1, 33)[:-1], method="lower")).tolist()
