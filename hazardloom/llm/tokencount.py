"""Token counts as a tokenizer library gives them, of texts of any length.

Texts up to `chunk` characters: the tokenizer's pre-tokenizer never lets a token cross white space, so a text's
count is the sum over its space- or line-separated parts, and each distinct part of a batch is encoded once.
Longer texts: overlapping chunks are encoded whole, with offsets, and spliced where both encodings agree: at a
space or line break in the overlap, next to which both have the same token with the same offsets on either side.
Where the overlap has no such place it is doubled and the chunk encoded anew, at last up to the text's end.

Defined results: null and empty texts have no tokens; special strings inside texts are handled as the library does
by default; rows that repeat an id are counted each.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from hazardloom.llm.common import slices

CHUNK, OVERLAP = 1 << 16, 256
#: Parts whose counts a task remembers.
REMEMBERED = 300_000


def load(path: str):
    """The library's tokenizer, without truncation, padding or begin and end tokens."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _encoded(tokenizer, text: str) -> tuple[list[int], list[tuple[int, int]]]:
    e = tokenizer.encode(text, add_special_tokens=False)
    return e.ids, e.offsets


def _agreement(text: str, low: int, high: int, left, right, shift: int) -> tuple[int, int] | None:
    """(tokens of left before, tokens of right before) the last space in text[low:high] at which both agree."""
    (left_ids, left_at), (right_ids, right_at) = left, right
    starts = {(a + shift, b + shift, i): k for k, ((a, b), i) in enumerate(zip(right_at, right_ids, strict=True))}
    for k in range(len(left_ids) - 1, 0, -1):
        (a, b), (c, d) = left_at[k - 1], left_at[k]
        if d > high:
            continue
        if a < low:
            return None
        gap = text[b:c]
        if gap and (" " in gap or "\n" in gap) and (a, b, left_ids[k - 1]) in starts:
            j = starts.get((c, d, left_ids[k]))
            if j is not None and j == starts[a, b, left_ids[k - 1]] + 1:
                return k, j
    return None


def spliced_count(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text of any length, at most two chunks (more where overlaps widen) being encoded at a time."""
    n, start, skip, total = len(text), 0, 0, 0
    end = min(n, chunk)
    left = _encoded(tokenizer, text[:end])
    while end < n:
        width, found = overlap, None
        while found is None:
            begin = max(start, end - width)
            until = min(n, max(begin + chunk, end + width))
            right = _encoded(tokenizer, text[begin:until])
            shifted = (left[0], [(a + start, b + start) for a, b in left[1]])
            found = _agreement(text, begin + 1, end - 1, shifted, right, begin)
            if found is None:
                if begin == start:  # the overlap is the whole chunk: it grows to the right instead
                    end = min(n, end + (end - start))
                    left = _encoded(tokenizer, text[start:end])
                    if end == n:
                        return total + len(left[0]) - skip
                    width = overlap
                else:
                    width *= 2
        total += found[0] - skip
        start, end, left, skip = begin, until, right, found[1]
    return total + len(left[0]) - skip


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of docs; a map without shuffle. path: a tokenizer file."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, known = load(path), {"": 0}
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            parts = [None if len(t) > chunk else t.replace("\n", " ").split(" ") for t in texts]
            new = list({w for p in parts if p for w in p if w not in known})
            if len(known) + len(new) > REMEMBERED:
                known = {"": 0}
                new = list({w for p in parts if p for w in p if w})
            for k in range(0, len(new), 20_000):
                some = new[k:k + 20_000]
                known.update(zip(some, map(len, tokenizer.encode_batch_fast(some, add_special_tokens=False)), strict=True))
            get = known.__getitem__
            count = np.array([spliced_count(tokenizer, t, chunk, overlap) if p is None else sum(map(get, p)) for t, p in zip(texts, parts, strict=True)], np.int64)
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(count), pa.array(count > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
