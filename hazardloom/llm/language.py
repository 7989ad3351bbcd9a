"""Language of texts from interpolated Kneser-Ney character models.

Texts are read as lower-case letters, with every run of other characters as one blank. Four-character sequences
are counted over all training texts, by language; lower orders follow from the number of distinct sequences they
continue (Kneser-Ney), with absolute discounting and interpolation down to a uniform distribution. Each order of a
language is one sorted array of hashes with its values, looked up by binary search; the distinct sequences of a
slice of texts are scored once. The language with the lowest cross-entropy per character wins. A text whose lowest
cross-entropy exceeds a limit, set to the 99.9 % quantile over all training texts, is marked as rejected and its
score halved, but keeps the best language.

Model size: a character is one of 64 symbols (blank, a to z, and 37 for all other letters by code point, so that
the letters of one alphabet differ), hence a language has at most 2^24 sequences whatever the corpus holds. Every
counted sequence is kept. Defined results: null texts and texts without a letter are `und` with score 0; equal cross-entropies go to
the language first by name; without training texts all are `und`; rows that repeat an id are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardloom.llm.common import Scratch, slices
from hazardloom.operators.ordered import selected

ORDER, SHARPNESS = 4, 12.0
_TOP, _BITS = 0x110000, 6


def _letters() -> np.ndarray:
    """Symbol of each code point: 1 to 63 for letters, by their lower-case form; 0 for what is no letter."""
    out = np.zeros(_TOP, np.uint8)
    for c in range(_TOP):
        if chr(c).isalpha():
            low = ord(chr(c).lower()[0])
            out[c] = low - 96 if 97 <= low <= 122 else 27 + low % 37
    return out


_SYMBOLS: list[np.ndarray] = []


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(packed four-character sequences, text of each): every letter or blank with the three symbols before it."""
    if not _SYMBOLS:
        _SYMBOLS.append(_letters())
    texts = [t or "" for t in texts]
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    symbol = _SYMBOLS[0][code].astype(np.uint64)
    first = np.ones(len(doc), bool)
    first[1:] = doc[1:] != doc[:-1]
    blank = symbol == 0
    keep = ~blank
    keep[1:] |= ~blank[:-1] & ~first[1:]
    symbol, doc = symbol[keep], doc[keep]
    value = symbol.copy()
    for k in range(1, ORDER):
        value[k:] |= np.where(doc[k:] == doc[:-k], symbol[:-k] << np.uint64(_BITS * k), 0)
    return value, doc


def distinct_grams(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct sequences in order, number of each sequence among them), by marking the symbol space."""
    met = np.zeros(1 << (_BITS * ORDER), bool)
    met[gram] = True
    distinct = np.flatnonzero(met)
    number = np.empty(len(met), np.int32)
    number[distinct] = np.arange(len(distinct), dtype=np.int32)
    return distinct.astype(np.uint64), number[gram]


@dataclass
class Table:
    """One order of one language: sorted keys (contexts and last symbol), probabilities; contexts with their back-off mass."""

    key: np.ndarray
    value: np.ndarray
    context: np.ndarray
    mass: np.ndarray


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(0, len(keys) - 1))
    return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)


def _mask(n: int) -> np.uint64:
    return np.uint64((1 << (_BITS * n)) - 1)


def kneser_ney(gram: np.ndarray, count: np.ndarray) -> tuple[list[Table], int]:
    """Tables from order 1 to ORDER, and the number of symbols."""
    tables: list[Table] = []
    levels = [(gram, count.astype(np.float64))]
    for n in range(ORDER - 1, 0, -1):
        shorter, times = np.unique(levels[-1][0] & _mask(n), return_counts=True)
        levels.append((shorter, times.astype(np.float64)))
    symbols = len(levels[-1][0]) + 1
    for key, c in reversed(levels):
        once, twice = (c == 1).sum(), (c == 2).sum()
        discount = float(np.clip(once / (once + 2 * twice), 0.1, 0.9)) if once + twice else 0.5
        context = key >> np.uint64(_BITS)
        ctx, start = np.unique(context, return_index=True)
        which = np.searchsorted(ctx, context)
        total = np.bincount(which, c)
        mass = discount * np.bincount(which) / total
        below = backed(tables, key & _mask(len(tables)), symbols) if tables else np.full(len(key), 1 / symbols)
        tables.append(Table(key, np.maximum(c - discount, 0) / total[which] + mass[which] * below, ctx, mass))
    return tables, symbols


def backed(tables: list[Table], key: np.ndarray, symbols: int) -> np.ndarray:
    """Interpolated probabilities of sequences of the order of the last table."""
    p = np.full(len(key), 1 / symbols)
    for n, t in enumerate(tables, 1):
        k = key & _mask(n)
        at, known = _find(t.context, k >> np.uint64(_BITS))
        p = np.where(known, p * t.mass[at], p)
        at, known = _find(t.key, k)
        p = np.where(known, t.value[at], p)
    return p


@dataclass
class LanguageModel:
    names: list[str]
    tables: list[tuple[list[Table], int]]
    limit: float = np.inf

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy in bits a character of each text under each language, whether it has a letter)."""
        gram, doc = grams(texts)
        distinct, at = distinct_grams(gram)
        n = np.bincount(doc, minlength=len(texts))
        has = np.bincount(doc, (gram & _mask(1)) > 0, minlength=len(texts)) > 0
        out = np.zeros((len(texts), len(self.names)))
        for k, (tables, symbols) in enumerate(self.tables):
            bits = -np.log2(backed(tables, distinct, symbols))
            out[:, k] = np.bincount(doc, bits[at], minlength=len(texts)) / np.maximum(n, 1)
        return out, has


def fit_languages(docs: DataFrame, keep=lambda doc_id: F.lit(True)) -> LanguageModel:
    """Counts over all texts with a language for which keep(doc_id) holds; summed by task, then by sequence.

    What reaches the driver is at most 2^24 counts a language; the rejection limit is an exact quantile of the
    entropies of all these texts, found by counting.
    """
    train = docs.select("doc_id", "lang", "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & keep(F.col("doc_id")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, (key, c) in total.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(key), pa.string()), pa.array(key.view(np.int64)), pa.array(c)], ["lang", "gram", "n"])
            total.clear()

        for batch in slices(batches):
            langs = np.array(batch.column(0).to_pylist(), object)
            gram, doc = grams(batch.column(1).to_pylist())
            for lang in sorted(set(langs)):
                key, c = np.unique(gram[(langs == lang)[doc]], return_counts=True)
                if lang in total:
                    key, at = np.unique(np.concatenate([total[lang][0], key]), return_inverse=True)
                    c = np.bincount(at, np.concatenate([total[lang][1], c])).astype(np.int64)
                total[lang] = (key, c.astype(np.int64))
            if sum(len(k) for k, _ in total.values()) > 1_000_000:
                yield from flush()
        yield from flush()

    sums = train.select("lang", "text").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    got = sums.toArrow()
    names = sorted(set(got.column("lang").to_pylist())) if got.num_rows else []
    lang = np.array(got.column("lang").to_pylist(), object)
    gram, n = got.column("gram").to_numpy().view(np.uint64), got.column("n").to_numpy()
    tables = []
    for name in names:
        own = np.flatnonzero(lang == name)
        own = own[np.argsort(gram[own])]
        tables.append(kneser_ney(gram[own], n[own]))
    model = LanguageModel(names, tables)
    if names:
        scratch = Scratch(docs.sparkSession, "language")
        lowest = scratch.save(predict_languages(train, model).where("lang_pred <> 'und'").select("entropy"))
        limit = selected(lowest, ["entropy"], 0.999)["entropy"]
        model.limit = np.inf if limit is None else limit
        scratch.drop(lowest)
    return model


def predict_languages(docs: DataFrame, model: LanguageModel, sharpness: float = SHARPNESS) -> DataFrame:
    """(doc_id, lang_pred, score, entropy, rejected) for each row of docs; a map without shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            e, has = model.entropies(batch.column(1).to_pylist())
            has = has & bool(model.names)
            best = e.argmin(1) if model.names else np.zeros(len(e), int)
            low = e.min(1) if model.names else np.zeros(len(e))
            score = np.where(has, 1 / np.maximum(np.exp(-np.minimum((e - low[:, None]) * sharpness, 60)).sum(1), 1), 0.0)
            rejected = has & (low > model.limit)
            name = [model.names[k] if ok else "und" for k, ok in zip(best, has, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(name, pa.string()), pa.array(np.where(rejected, score / 2, score)), pa.array(np.where(has, low, 0.0)), pa.array(rejected)],
                                             ["doc_id", "lang_pred", "score", "entropy", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double, entropy double, rejected boolean")
