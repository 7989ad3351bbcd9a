"""The pipeline over small tables with odd rows: nulls, repeated ids, clashing names, empty tables."""

import pytest

pytest.importorskip("hazardloom.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")
public_tokenizers = pytest.importorskip("public_tokenizers")

from hazardloom.llm import jaccard, pieces, quality  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars int, _keep string, _row int"
WORDS = "the river runs past an old mill where people meet to talk about weather harvest boats and the long road home".split()


def prose(k):
    return " ".join(WORDS[(k * 5 + i * (k % 7 + 1)) % len(WORDS)] + str((k * 31 + i) % 9 or "") for i in range(40)) + ".\n" + f"Note {k} ends."


def folder(spark, root, rows, labels, benchmark):
    for name, data, schema in (("documents", rows, DOCS), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", benchmark, "item_id long, text string")):
        spark.createDataFrame(data, schema).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def test_run(spark, tmp_path):
    good = [(k, prose(k), "en", "a", len(prose(k)), "x", k) for k in range(1, 31)]
    bad = [(k, "$$$ ### @@@\n" * 5 + "!!! ???", None, "b", 67, None, None) for k in range(31, 61)]
    passage = "a benchmark question about seventeen green apples and the distance between two far away towns"
    odd = [(101, prose(1), "en", "a", 1, "y", 1),  # copy of document 1
           (102, prose(2) + " " + passage, "en", "a", 1, None, None),
           (103, prose(50) + " write to ann.lee@mail.example.org", "en", None, 1, None, None),
           (104, None, None, None, None, None, None), (105, "", None, None, 0, None, None), (None, prose(60), None, None, 1, None, None)]
    where = folder(spark, tmp_path, good + bad + odd, [(k, int(k < 31), 0) for k in range(1, 61)], [(1, passage), (None, None)])
    out = corpus_pipeline.run(spark, where)
    assert out.columns == [*(c.split()[0] for c in DOCS.split(", ")), "pieces"]
    rows = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(rows) and not set(rows) & {101, 102, *range(31, 61)}
    assert set(range(1, 31)) <= set(rows) and None in rows
    assert rows[103].text.endswith("write to <EMAIL>") and rows[103].n_chars == len(rows[103].text)
    back = {r.doc_id: r.text for r in pieces.decode_documents(out, public_tokenizers.path(corpus_pipeline.PIECES)).collect()}
    assert all(back[k] == r.text for k, r in rows.items())


def test_empty_tables(spark, tmp_path):
    assert corpus_pipeline.run(spark, folder(spark, tmp_path, [], [], [])).count() == 0


def test_repeated_ids_stay_together(spark):
    rows = [(1, prose(1), None, None, 1, "k", 1), (1, prose(1), None, None, 1, "l", 2), (2, prose(1), None, None, 1, "m", 3)]
    kept = jaccard.one_of_each(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(r._keep for r in kept) == ["k", "l"]


def test_quality_learns_from_whole_texts(spark):
    # only the last lines tell the classes apart
    same = "\n".join(f"an ordinary line {k}" for k in range(400))
    tail = {1: "\n" + "\n".join(["a calm sentence ends here."] * 400), 0: "\n" + "\n".join(["$$$ ### !!!"] * 400)}
    docs = spark.createDataFrame([(k, same + tail[k % 2]) for k in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    model = quality.fit_quality(docs, labels, lambda i: i < 30)
    assert all((r.score > 0.5) == (r.doc_id % 2) for r in quality.score_quality(docs, model).collect())
