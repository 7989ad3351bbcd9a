"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

A text is escaped as the model asks (one space in front, spaces as U+2581) and cut before every run of that sign,
which no merge of such a model crosses. Inside a part the merge with the best score (leftmost among equals) is
taken until none is left; a candidate merge is skipped when a hash keyed by seed, document, place of the part in the
text, place in the part and both pieces falls below the dropout rate. So a word is cut anew wherever it stands, and
with rate 0 the result is the library's own segmentation.

Agendas are shared, draws are not: a remembered agenda is a part, the merges skipped so far and the merges taken
after that. An occurrence draws for the taken ones in order; at its first skipped one it goes on with the agenda
that skips this one too. Agendas not met yet take over the merges up to the skip and merge on side by side, one step
each per round. Parts of over `LONG` characters, whose agendas hardly ever repeat, go through a heap instead, by the
same draws: n log n in their length.

Characters outside the vocabulary, and a literal U+2581 of the text, become byte pieces, so decoding gives back
every text exactly. Defined results: a null text gives null, an empty one no pieces; rows that repeat an id and a
text get the same pieces; a null id counts as 0; a column `pieces` of docs is replaced, other columns stay.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from hazardloom.llm.common import slices
from hazardloom.llm.jaccard import mix

RATE, SEED, LONG = 0.1, 17, 40
#: Agendas that a task remembers (about 0.3 KB each), for digests and for whole documents, whose task holds the batch and its pieces besides.
REMEMBERED, REMEMBERED_BESIDE = 1_000_000, 50_000
_SPACE, _LITERAL = "▁", ""
_PART = re.compile("▁*[^▁]+|▁+")


_GONE = -(1 << 62)


def merge_codes(key: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A name for each candidate merge of a part: both pieces and the place of the left one."""
    return mix(key.astype(np.uint64) ^ (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0x94D049BB133111EB))


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Both symbols (int32) in one number; that of a code point that is no piece is no merge's."""
    return (left.astype(np.int64) << 32) | right.view(np.uint32)


def occurrence_keys(ids: np.ndarray, places: np.ndarray, seed: int) -> np.ndarray:
    """Key of the draws of each part: seed, document, place among the text's parts."""
    return mix(mix(ids.astype(np.int64).view(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) + places.astype(np.uint64))


class Pieces:
    """Vocabulary and merge table of a BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(n)]
        plain = {self.text[i]: i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(_SPACE in t.lstrip(_SPACE) for t in plain):
            raise ValueError("a piece of this model crosses a word start")
        pairs = [(plain[t[:k]], plain[t[k:]], i) for t, i in plain.items() for k in range(1, len(t)) if t[:k] in plain and t[k:] in plain]
        key = np.array([(a << 32) | b for a, b, _ in pairs], np.int64)
        made = np.array([i for _, _, i in pairs], np.int64)
        order = np.argsort(key)
        self.key, self.made = key[order], made[order].astype(np.int32)
        score = np.array([sp.get_score(i) for i in range(n)])
        rank = np.empty(n, np.int64)
        rank[np.argsort(-score, kind="stable")] = np.arange(n)
        same = np.unique(-score, return_inverse=True)[1]
        self.rank = same.astype(np.int64)
        self.pair_rank = self.rank[self.made] << 32
        self.bytes = [t.replace(_SPACE, " ").encode() for t in self.text]
        for b, i in enumerate(self.byte):
            self.bytes[i] = bytes([b])
        # a slot table answers most lookups without a search: -1 no pair, len(key) several pairs
        self.pair: dict[int, int] = {}
        self.of_char = -1 - np.arange(0x110000, dtype=np.int32)
        for t, i in plain.items():
            if len(t) == 1:
                self.of_char[ord(t)] = i
        slot = self._slot(self.key)
        self.index = np.full(1 << 20, -1, np.int32)
        self.index[slot] = np.where(np.bincount(slot, minlength=1 << 20)[slot] > 1, len(self.key), np.arange(len(self.key)))

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def symbols(self, text: str) -> np.ndarray:
        """Id of each character; -1 - c for a code point c that is no piece."""
        return self.of_char[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]

    def coded(self, symbols: list[int]) -> bytes:
        return self.widened(np.array(symbols, np.int32))[0].astype("<i4").tobytes()

    def widened(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of symbols, a code point that is no piece as its bytes, and how many ids each symbol gives."""
        at = np.flatnonzero(symbols < 0)
        if not len(at):
            return symbols, np.ones(len(symbols), np.int64)
        wide = [[self.byte[x] for x in chr(-1 - i).encode("utf-8", "surrogatepass")] for i in symbols[at].tolist()]
        size = np.ones(len(symbols), np.int64)
        size[at] = list(map(len, wide))
        out = np.repeat(symbols, size)
        out[np.repeat(symbols < 0, size)] = [i for row in wide for i in row]
        return out, size

    def merge_all(self, symbol: np.ndarray, part: np.ndarray, place: np.ndarray, barred: np.ndarray, parts: int) -> tuple:
        """Merges side by side what is left of `parts` parts: symbols with the number of their part and their place in
        it, and whether a symbol's merge with the next one is skipped. A skipped merge is out until one of its pieces
        grows, and then it is another one.

        Returns (symbols, number for each part) and the merges taken, in the order of the parts and within them:
        (code, place, place of the right piece, piece made), number for each part."""
        done, taken = [], []
        while len(symbol):
            key = pair_keys(symbol[:-1], symbol[1:])
            found = self.index[self._slot(key)]
            ok = np.flatnonzero((found >= 0) & (part[:-1] == part[1:]) & ~barred[:-1])
            found, key = found[ok], key[ok]
            shared = np.flatnonzero(found == len(self.key))  # several pairs in a slot
            found[shared] = np.minimum(np.searchsorted(self.key, key[shared]), len(self.key) - 1)
            hit = self.key[found] == key
            ok, found, key = ok[hit], found[hit], key[hit]
            if not len(ok):
                break
            # best candidate of each part: least rank, then leftmost
            order = self.pair_rank[found] + np.arange(len(ok))
            owner = part[ok]
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            best = (np.minimum.reduceat(order, first) & 0xFFFFFFFF).astype(np.int64)
            at, made = ok[best], self.made[found[best]]
            taken.append((part[at], key[best], place[at], place[at + 1], made))
            symbol = symbol.copy()
            symbol[at] = made
            barred[at] = False
            barred[at - 1] = False  # of another part or the last one if the piece is its part's first: never a candidate
            active = np.zeros(parts, bool)
            active[part[at]] = True
            live = active[part]
            live[at + 1] = False
            rest = np.flatnonzero(~active[part])
            if len(rest):
                done.append((symbol[rest], part[rest]))
            symbol, part, place, barred = symbol[live], part[live], place[live], barred[live]
        done.append((symbol, part))
        symbol, part = map(np.concatenate, zip(*done, strict=True))
        order = np.argsort(part, kind="stable")  # a part is done at once, in order
        if not taken:
            taken.append((part[:0], np.zeros(0, np.int64), *[np.zeros(0, np.int32)] * 3))
        owner, key, *rows = map(np.concatenate, zip(*taken, strict=True))
        by = np.argsort(owner, kind="stable")
        path = (merge_codes(key, rows[0])[by], *(x[by] for x in rows))
        return symbol[order], np.bincount(part, minlength=parts), path, np.bincount(owner, minlength=parts)

    def merge_long(self, part: str, draw: int, limit: int) -> np.ndarray:
        """Piece ids of one part by a heap of candidate merges; draw: key of this occurrence."""
        if not self.pair:
            self.pair.update(zip(self.key.tolist(), self.made.tolist(), strict=True))
        symbol = self.symbols(part).tolist()
        n = len(symbol)
        after, before, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def candidates(places: list[int]) -> list[tuple]:
            rows = [(i, symbol[i] << 32 | symbol[after[i]]) for i in places if i >= 0 and after[i] < n and symbol[i] >= 0 and symbol[after[i]] >= 0]
            rows = [(i, key, made) for i, key in rows if (made := self.pair.get(key)) is not None]
            if rows and limit:
                code = merge_codes(np.array([key for _, key, _ in rows], np.int64), np.array([i for i, _, _ in rows]))
                kept = mix(code ^ np.uint64(draw)) >= np.uint64(limit)
                rows = [r for r, k in zip(rows, kept.tolist(), strict=True) if k]
            return [(int(self.rank[made]), i, key, made) for i, key, made in rows]

        heap = candidates(list(range(n)))
        heapq.heapify(heap)
        while heap:
            _, i, key, made = heapq.heappop(heap)
            j = after[i]
            if symbol[i] < 0 or j >= n or symbol[i] << 32 | symbol[j] != key or before[j] != i:
                continue
            symbol[i], symbol[j], after[i] = made, _GONE, after[j]
            if after[j] < n:
                before[after[j]] = i
            for row in candidates([before[i], i]):
                heapq.heappush(heap, row)
        return self.widened(np.array([x for x in symbol if x != _GONE], np.int32))[0]

    def literal(self) -> np.ndarray:
        return np.array([self.byte[b] for b in _SPACE.encode()], np.int32)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))[1:].decode("utf-8", "surrogatepass") if len(ids) else ""


class Growing:
    """A numpy array that grows at its end."""

    def __init__(self, dtype: type):
        self.all, self.n = np.empty(1 << 12, dtype), 0

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return self.all[at]

    def extend(self, rows: np.ndarray) -> None:
        if self.n + len(rows) > len(self.all):
            grown = np.empty(max(2 * len(self.all), self.n + len(rows)), self.all.dtype)
            grown[:self.n] = self.all[:self.n]
            self.all = grown
        self.all[self.n:self.n + len(rows)] = rows
        self.n += len(rows)


class Ragged:
    """Rows of different lengths, appended to shared columns."""

    def __init__(self, **columns: type):
        self.start, self.size = Growing(np.int64), Growing(np.int64)
        self.columns = {name: Growing(dtype) for name, dtype in columns.items()}

    def __len__(self) -> int:
        return len(self.start)

    def __getattr__(self, name: str) -> np.ndarray:
        return self.columns[name].all

    def extend(self, size: np.ndarray, **columns: np.ndarray) -> None:
        held = len(next(iter(self.columns.values())))
        self.start.extend(held + np.cumsum(size) - size)
        self.size.extend(size)
        for name, rows in columns.items():
            self.columns[name].extend(rows)


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ..., start + size - 1 of each row."""
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)


class Numbers(dict):
    """Agenda without skips of each part; parts met anew get the next numbers, those over `long` characters -1."""

    def __init__(self, long: int, first: int):
        super().__init__()
        self.long, self.next, self.new = long, first, []

    def __missing__(self, part: str) -> int:
        if len(part) > self.long:
            return -1
        number = self[part] = self.next + len(self.new)
        self.new.append(part)
        return number


class Encoder:
    """Encodes texts; remembers the agendas it has met."""

    def __init__(self, path: str, rate: float = RATE, seed: int = SEED, long: int = LONG, remembered: int = REMEMBERED):
        self.model, self.seed, self.long, self.limit = Pieces(path), seed, long, int(rate * 2**53) << 11
        self.remembered = remembered
        self.forget()

    def forget(self) -> None:
        self.number = Numbers(self.long, 1)
        self.number[_LITERAL] = 0
        self.char = Ragged(symbol=np.int32)  # symbols of the characters of the parts met
        self.out = Ragged(piece=np.int32)  # pieces of each agenda
        #: Merges taken by each agenda: code, places of both pieces, piece made, agenda if this one is skipped.
        self.path = Ragged(code=np.uint64, place=np.int32, right=np.int32, made=np.int32, next=np.int32)
        #: Its part; the agenda and its merge that is skipped (-1: none); merges that it shares with that one.
        self.root, self.parent, self.skip, self.drawn = (Growing(np.int64) for _ in range(4))
        self.char.extend(np.zeros(1, np.int64), symbol=np.zeros(0, np.int32))
        self.out.extend(np.array([3]), piece=self.model.literal())
        none = np.zeros(0, np.int32)
        self.path.extend(np.zeros(1, np.int64), code=none, place=none, right=none, made=none, next=none)
        for column, value in ((self.root, 0), (self.parent, -1), (self.skip, -1), (self.drawn, 0)):
            column.extend(np.array([value]))

    def add(self, parts: list[str]) -> None:
        """Agendas without skips of new parts."""
        for k in range(0, len(parts), 50_000):
            some = parts[k:k + 50_000]
            size = np.array(list(map(len, some)), np.int64)
            self.char.extend(size, symbol=self.model.symbols("".join(some)))
            self._grow(len(self.char) - len(some) + np.arange(len(some)), np.full(len(some), -1), np.full(len(some), -1))

    def branch(self, of: np.ndarray, step: np.ndarray) -> None:
        """Agendas that skip the merge `step` of the agenda `of` too."""
        for k in range(0, len(of), 50_000):
            self._grow(self.root[of[k:k + 50_000]], of[k:k + 50_000], step[k:k + 50_000])

    def _grow(self, root: np.ndarray, parent: np.ndarray, skip: np.ndarray) -> None:
        n = len(root)
        size = self.char.size[root]
        base = np.cumsum(size) - size
        symbol = self.char.symbol[spans(self.char.start[root], size)]
        part, place = np.repeat(np.arange(n, dtype=np.int32), size), spans(np.zeros(n, np.int32), size).astype(np.int32)
        barred = np.zeros(len(symbol), bool)
        # what the parent does before the skipped merge is taken over
        known = np.where(parent >= 0, skip - self.path.start[np.maximum(parent, 0)], 0)
        steps, owner = spans(self.path.start[np.maximum(parent, 0)], known), np.repeat(np.arange(n), known)
        if (parent >= 0).any():
            stay = np.ones(len(symbol), bool)
            symbol[base[owner] + self.path.place[steps]] = self.path.made[steps]  # in order: the last one stays
            stay[base[owner] + self.path.right[steps]] = False
            index = np.cumsum(stay) - 1
            symbol, part, place = symbol[stay], part[stay], place[stay]
            barred = np.zeros(len(symbol), bool)
            rows, of, step = np.arange(n), parent, skip
            while len(rows):  # a skip of an ancestor counts where both of its pieces still stand
                p = self.path.place[step]
                here = stay[base[rows] + p]
                at = index[base[rows] + p][here]
                key = pair_keys(symbol[at], symbol[np.minimum(at + 1, len(symbol) - 1)])
                barred[at] |= merge_codes(key, p[here]) == self.path.code[step[here]]
                of, step = self.parent[of], self.skip[of]
                rows, of, step = (x[step >= 0] for x in (rows, of, step))
        symbol, width, path, taken = self.model.merge_all(symbol, part, place, barred, n)
        symbol, wide = self.model.widened(symbol)
        ends = np.cumsum(np.append(0, wide))[np.cumsum(np.append(0, width))]
        self.out.extend(np.diff(ends), piece=symbol)
        total = known + taken
        first = np.cumsum(total) - total
        old, new = spans(first, known), spans(first + known, taken)
        columns = {}
        for name, rows in zip(("code", "place", "right", "made"), path, strict=True):
            columns[name] = np.empty(total.sum(), rows.dtype)
            columns[name][old], columns[name][new] = getattr(self.path, name)[steps], rows
        self.path.extend(total, **columns, next=np.full(total.sum(), -1, np.int32))
        for column, rows in ((self.root, root), (self.parent, parent), (self.skip, skip), (self.drawn, known)):
            column.extend(rows)

    def walk(self, agenda: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The agenda that each occurrence ends with: its draws skip none of the merges taken there."""
        agenda, at = agenda.copy(), np.flatnonzero(agenda >= 0)
        while len(at):
            of = agenda[at]
            n = self.path.size[of] - self.drawn[of]  # the merges before were drawn with the agenda it comes from
            owner, step = np.repeat(np.arange(len(at)), n), spans(self.path.start[of] + self.drawn[of], n)
            hit = np.flatnonzero(mix(self.path.code[step] ^ key[at][owner]) < np.uint64(self.limit))
            hit = hit[np.append(True, owner[hit][1:] != owner[hit][:-1])] if len(hit) else hit
            of, at, step = of[owner[hit]], at[owner[hit]], step[hit]
            fresh = np.flatnonzero(self.path.next[step] < 0)
            new, first = np.unique(step[fresh], return_index=True)
            if len(new):
                self.path.next[new] = np.arange(len(new)) + len(self.out)
                self.branch(of[fresh[first]], new)
            agenda[at] = self.path.next[step]
        return agenda

    def encode(self, texts: list[str | None], ids: list[int | None]) -> list[bytes | None]:
        split: list[list[str]] = []
        for t in texts:
            if not t:
                split.append([])
            elif _SPACE in t:  # a literal sign is set apart: nothing merges with it
                row: list[str] = []
                for k, piece in enumerate((" " + t).split(_SPACE)):
                    row += [_LITERAL] * (k > 0) + _PART.findall(piece.replace(" ", _SPACE))
                split.append(row)
            else:
                split.append(_PART.findall(_SPACE + t.replace(" ", _SPACE)))
        if len(self.out) > self.remembered:
            self.forget()
        flat = [w for row in split for w in row]
        agenda = np.fromiter(map(self.number.__getitem__, flat), np.int64, len(flat))
        new, self.number.new = self.number.new, []
        self.add(new)
        size = np.array([len(row) for row in split], np.int64)
        key = occurrence_keys(np.repeat(np.array([i or 0 for i in ids], np.int64), size), spans(np.zeros(len(size), np.int64), size), self.seed)
        if self.limit:
            agenda = self.walk(agenda, key)
        self.number.next = len(self.out)
        wide = self.out.size[agenda]
        long = {i: self.model.merge_long(flat[i], int(key[i]), self.limit) for i in np.flatnonzero(agenda < 0).tolist()}
        wide[list(long)] = [len(x) for x in long.values()]
        ends = np.append(0, np.cumsum(wide))
        short = agenda >= 0
        coded = np.empty(ends[-1], "<i4")
        if long:
            coded[spans(ends[:-1][short], wide[short])] = self.out.piece[spans(self.out.start[agenda[short]], wide[short])]
            for i, row in long.items():
                coded[ends[i]:ends[i + 1]] = row
        else:
            coded[:] = self.out.piece[spans(self.out.start[agenda], wide)]
        flat_bytes, cuts = coded.tobytes(), (4 * ends[np.append(0, np.cumsum(size))]).tolist()
        return [None if t is None else flat_bytes[a:b] for t, a, b in zip(texts, cuts, cuts[1:], strict=False)]


def encode_documents(docs: DataFrame, path: str, rate: float = RATE, seed: int = SEED) -> DataFrame:
    """docs' columns and `pieces`: array of ids. A map without shuffle; path: a SentencePiece BPE model."""
    names = [c for c in docs.columns if c != "pieces"]
    docs = docs.select(*names)
    at, id_at = names.index("text"), names.index("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, rate, seed, remembered=REMEMBERED_BESIDE)
        for batch in slices(batches, at, 1 << 19):
            coded = encoder.encode(batch.column(at).to_pylist(), batch.column(id_at).to_pylist())
            offsets = np.concatenate([[0], np.cumsum([len(c or b"") // 4 for c in coded])]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(c or b"" for c in coded), "<i4"))
            lists = pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array([c is None for c in coded]))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*names, "pieces"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("pieces", ArrayType(IntegerType()))]))


def decode_documents(coded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, pieces)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Pieces(path)
        for batch in batches:
            texts = [None if x is None else model.decode(np.array(x, np.int64)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return coded.select("doc_id", "pieces").mapInArrow(run, "doc_id long, text string")


def encoded_digests(docs: DataFrame, path: str, rate: float = RATE, seed: int = SEED) -> DataFrame:
    """(doc_id, n_pieces, n_distinct, pieces_sha256, lossless): digests of what encode and decode give. A map without shuffle."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, rate, seed)
        for batch in slices(batches, 1, 2 << 20):
            texts = batch.column(1).to_pylist()
            rows = []
            for t, c in zip(texts, encoder.encode(texts, batch.column(0).to_pylist()), strict=True):
                ids = np.frombuffer(c or b"", "<i4")
                rows.append((len(ids), len(np.unique(ids)), hashlib.sha256(c or b"").hexdigest(), encoder.model.decode(ids) == (t or "")))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, t) for x, t in zip(
                zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.string(), pa.bool_()), strict=True))],
                ["doc_id", "n_pieces", "n_distinct", "pieces_sha256", "lossless"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_pieces long, n_distinct long, pieces_sha256 string, lossless boolean")
