"""SentencePiece encoding and decoding with seeded merge-dropout.

A merge-type (BPE) model joins the best-scored neighbouring pieces first. Here each candidate that reaches the top of
the agenda is skipped with probability ``dropout``; whether it is, is a hash keyed by seed, epoch, the document's id,
the run's place in the document (a run is a word with the spaces before it) and the candidate's place in the run. So a
rerun gives the same pieces, another epoch others, and each occurrence of a word draws for itself. Spaces become ``▁``,
characters outside the vocabulary become byte pieces, and decoding gives back every text byte for byte.

The agendas of the runs of a batch advance together as arrays, at most ``table_words`` at a time: in each round every
run pops its best candidate, skips or merges it, and looks up the two new neighbours. Runs of over ``LONG_RUN``
characters take a heap.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import mixed

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT = 0.1
#: Fewest ways in which many documents must cut a text; each document draws for itself.
STREAMS = 8
LONG_RUN = 64
CHUNK_CHARACTERS = 1 << 20
GROUP_RUNS = 1 << 14
WIDTHS = (2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 24, 40, LONG_RUN)

SPACE = "▁"
_GONE = np.int32(-1)
_NEVER = np.int32(2**31 - 1)
_MASK = (1 << 64) - 1
_PLACES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_ID_BITS = 21
_ID_MASK = (1 << _ID_BITS) - 1


def load_model(path: str = DEFAULT_MODEL) -> list[tuple[str, float, str]]:
    """(piece, score, kind) of every id of a model file; read on the driver, small, sent to the tasks.

    Kinds: ``n`` normal, ``b`` byte, ``c`` neither written nor read back.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    kinds = ["b" if model.is_byte(i) else "c" if model.is_control(i) or model.is_unknown(i) else "n" for i in ids]
    return [(model.id_to_piece(i), model.get_score(i), kinds[i]) for i in ids]


class Encoder:
    """Encodes and decodes batches of texts with one model; a task holds one."""

    def __init__(self, model: list[tuple[str, float, str]], dropout: float = DROPOUT, seed: int = 0, epoch: int = 0,
                 table_words: int = GROUP_RUNS):
        self.table_words = table_words
        self.limit = int(dropout * (1 << 32))
        self.key = xxhash.xxh64_intdigest(f"{seed}:{epoch}".encode())
        normal = {p: i for i, (p, _, kind) in enumerate(model) if kind == "n"}
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in normal):
            raise ValueError("a piece has an inner space mark or a line end, so runs do not bound its merges")
        if len(model) >= 1 << _ID_BITS:
            raise ValueError("a pair of ids and a rank do not fit one number")
        self.byte_ids = np.full(256, -1, np.int32)
        for i, (p, _, kind) in enumerate(model):
            if kind == "b":
                self.byte_ids[int(p[3:5], 16)] = i
        if self.byte_ids.min() < 0:
            raise ValueError("decoding without loss needs a model with all 256 byte pieces")
        self.decoded = [p.replace(SPACE, " ").encode() if kind == "n" else bytes([int(p[3:5], 16)]) if kind == "b" else b""
                        for p, _, kind in model]
        # Order of merging: by score, then by id; a merge is known by its place in that order.
        order = sorted(normal.values(), key=lambda i: (-model[i][1], i))
        self.merged_id = np.array([*order, 0], np.int32)
        place = {i: n for n, i in enumerate(order)}
        # What each character starts as: its piece, or a negative number for one outside the vocabulary.
        self.start_as = (-2 - np.arange(0x110000)).astype(np.int32)
        for p, i in normal.items():
            if len(p) == 1 and p != SPACE:
                self.start_as[ord(p)] = i
        self.start_as[0x20] = normal[SPACE]
        pairs = {}
        for p, i in normal.items():
            for cut in range(1, len(p)):
                a, b = normal.get(p[:cut]), normal.get(p[cut:])
                if a is not None and b is not None:
                    pairs[a << _ID_BITS | b] = place[i]
        self._build(pairs)

    def _build(self, pairs: dict[int, int]) -> None:
        """Open-addressed table of pair and rank, packed into one number a slot; zero is an empty slot."""
        bits = max(10, (len(pairs) * 8).bit_length())
        self.shift, slots = np.uint64(64 - bits), [0] * ((1 << bits) + 64)
        for key, rank in pairs.items():
            at = (key * _PLACES[0] & _MASK) >> (64 - bits)
            while slots[at]:
                at += 1
            slots[at] = key << _ID_BITS | rank
        self.slots = np.array(slots, np.int64)
        self.pair_ranks: dict[int, int] | None = None

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of the merge of each pair of symbols; ``_NEVER`` if there is none."""
        keys = a.astype(np.int64) << _ID_BITS | b
        keys[keys < 0] = 0
        at = ((keys.view(np.uint64) * np.uint64(_PLACES[0])) >> self.shift).view(np.int64)
        found = self.slots[at]
        known = found >> _ID_BITS
        out = np.where(known == keys, found & _ID_MASK, _NEVER).astype(np.int32)
        out[keys == 0] = _NEVER
        left = np.flatnonzero((known != keys) & (found != 0))
        keys, at = keys[left], at[left]
        while len(left):
            at += 1
            found = self.slots[at]
            known = found >> _ID_BITS
            hit = known == keys
            out[left[hit]] = found[hit] & _ID_MASK
            more = ~hit & (found != 0)
            left, keys, at = left[more], keys[more], at[more]
        return out

    def _draws(self, keys: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        x = keys ^ ((a + (b << 20) + (c << 40)).view(np.uint64) * np.uint64(_PLACES[0]))
        x = (x ^ x >> np.uint64(29)) * np.uint64(_PLACES[1])
        return (x ^ x >> np.uint64(32)) & np.uint64(0xFFFFFFFF)

    def _advance(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, keys: np.ndarray, width: int) -> None:
        """Runs the agendas of runs of at most ``width`` characters to their end, writing into ``symbols``."""
        step = width + 2
        columns = np.arange(step)
        inner = columns[None, :] - 1
        inside = (inner >= 0) & (inner < sizes[:, None])
        sym = np.where(inside, symbols[np.where(inside, starts[:, None] + inner, 0)], _GONE).astype(np.int32).ravel()
        after = np.tile((columns + 1).astype(np.int16), len(starts))
        before = np.tile((columns - 1).astype(np.int16), len(starts))
        rank = np.full(len(sym), _NEVER, np.int32)
        rank[:-1] = self.ranks(sym[:-1], sym[1:])
        rank = rank.reshape(-1, step)
        rank[:, -1] = _NEVER
        live = np.arange(len(starts))
        grid = rank
        while len(live):
            top = grid.argmin(axis=1)
            best = grid[np.arange(len(live)), top]
            on = best != _NEVER
            if not on.all():
                live, top, best, grid = live[on], top[on], best[on], grid[on]
                if not len(live):
                    break
            base = live * step
            i = base + top
            nxt = after[i].astype(np.int64)
            end = after[base + nxt].astype(np.int64)
            if self.limit:
                skip = self._draws(keys[live], top - 1, nxt - 1, end - 1) < self.limit
                rows = np.flatnonzero(skip)
                grid[rows, top[rows]] = _NEVER
                go = np.flatnonzero(~skip)
            else:
                go = np.arange(len(live))
            base, i, top, nxt, end, best = base[go], i[go], top[go], nxt[go], end[go], best[go]
            j, k = base + nxt, base + end
            new = self.merged_id[best]
            sym[i] = new
            sym[j] = _GONE
            after[i] = end
            inner_end = np.flatnonzero(end < step)
            before[k[inner_end]] = top[inner_end]
            prev = before[i].astype(np.int64)
            grid[go, nxt] = _NEVER
            grid[go, top] = self.ranks(new, np.where(end < step - 1, sym[np.minimum(k, len(sym) - 1)], _GONE))
            grid[go, prev] = self.ranks(sym[base + prev], new)
        symbols[(starts[:, None] + inner)[inside]] = sym.reshape(-1, step)[inside]

    def _pairs(self) -> dict[int, int]:
        """Rank of each pair that has one, for the agendas that go one merge at a time."""
        if self.pair_ranks is None:
            held = self.slots[self.slots != 0]
            self.pair_ranks = dict(zip((held >> _ID_BITS).tolist(), (held & _ID_MASK).tolist(), strict=True))
        return self.pair_ranks

    def _alone(self, symbols: np.ndarray, start: int, size: int, key: int) -> None:
        """The agenda of one run as a heap of (rank, place, end of the left piece, end of the right piece)."""
        whole = symbols[start:start + size]
        first = self.ranks(whole[:-1], whole[1:])
        heap = [(int(first[i]), int(i), int(i) + 1, int(i) + 2) for i in np.flatnonzero(first != _NEVER)]
        heapq.heapify(heap)
        sym, merged = whole.tolist(), self.merged_id.tolist()
        after, before, ends = list(range(1, size + 1)), list(range(-1, size - 1)), list(range(1, size + 1))
        rank_of, gone, push, pop = self._pairs().get, int(_GONE), heapq.heappush, heapq.heappop
        while heap:
            rank, i, middle, end = pop(heap)
            if sym[i] == gone or ends[i] != middle:
                continue
            j = after[i]
            if j >= size or ends[j] != end:
                continue
            if self.limit:
                x = key ^ ((i + (middle << 20) + (end << 40)) * _PLACES[0] & _MASK)
                x = (x ^ x >> 29) * _PLACES[1] & _MASK
                if (x ^ x >> 32) & 0xFFFFFFFF < self.limit:
                    continue
            k = after[j]
            new = sym[i] = merged[rank]
            sym[j], ends[i], after[i] = gone, end, k
            if k < size:
                before[k] = i
                if sym[k] >= 0:
                    found = rank_of(new << _ID_BITS | sym[k])
                    if found is not None:
                        push(heap, (found, i, end, ends[k]))
            h = before[i]
            if h >= 0 and sym[h] >= 0:
                found = rank_of(sym[h] << _ID_BITS | new)
                if found is not None:
                    push(heap, (found, h, ends[h], end))
        symbols[start:start + size] = sym

    def encode(self, texts: list[str], documents: list[str]) -> list[bytes]:
        """Ids of each text as little-endian int32 values; an empty text has none."""
        spaced = [" " + t if t else "" for t in texts]
        lengths = np.fromiter(map(len, spaced), np.int64, len(spaced))
        codes = np.frombuffer("".join(spaced).encode("utf-32-le"), np.uint32)
        borders = np.cumsum(lengths)
        starts = _run_starts(codes, (borders - lengths)[lengths > 0])
        sizes = np.diff(starts, append=len(codes))
        text_of = np.searchsorted(borders, starts, side="right")
        place = np.arange(len(starts)) - np.searchsorted(starts, borders - lengths)[text_of]
        names = np.fromiter((xxhash.xxh64_intdigest(d.encode(), self.key) for d in documents), np.uint64, len(documents))
        keys = mixed(names[text_of] ^ mixed(place.astype(np.uint64) + np.uint64(1)))
        symbols = self._segmented(codes, starts, sizes, keys)
        kept = np.flatnonzero(symbols != _GONE)
        ids, owners = self._with_bytes(symbols[kept], np.searchsorted(borders, kept, side="right"))
        ends = np.cumsum(np.bincount(owners, minlength=len(texts)))
        found = ids.astype("<i4").tobytes()
        return [found[4 * a:4 * b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=False)][:len(texts)]

    def _segmented(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Symbols of all characters after every run's own agenda; a character that a piece swallowed is ``_GONE``."""
        symbols = self.start_as[codes]
        lowest = 1
        for width in WIDTHS:
            group = np.flatnonzero((sizes > lowest) & (sizes <= width))
            for at in range(0, len(group), self.table_words):
                part = group[at:at + self.table_words]
                self._advance(symbols, starts[part], sizes[part], keys[part], width)
            lowest = width
        for n in np.flatnonzero(sizes > LONG_RUN):
            self._alone(symbols, int(starts[n]), int(sizes[n]), int(keys[n]))
        return symbols

    def _with_bytes(self, ids: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters outside the vocabulary (negative) as the byte pieces of their UTF-8 form."""
        code = np.where(ids < 0, -2 - ids, 0)
        size = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        first = np.cumsum(size) - size
        out, place = np.repeat(ids, size), np.repeat(first, size)
        nth = np.arange(len(out)) - place
        odd = np.flatnonzero(out < 0)
        c, n, total = np.repeat(code, size)[odd], nth[odd], np.repeat(size, size)[odd]
        bits = (c >> (6 * (total - 1 - n))) & 0x3F
        lead = np.choose(total - 1, [c, 0xC0 | c >> 6, 0xE0 | c >> 12, 0xF0 | c >> 18])
        out[odd] = self.byte_ids[np.where(n == 0, lead, 0x80 | bits)]
        return out, np.repeat(owners, size)

    def decode(self, ids: bytes) -> bytes:
        """The UTF-8 text that was encoded."""
        return b"".join(map(self.decoded.__getitem__, np.frombuffer(ids, "<i4").tolist()))[1:]


def _run_starts(codes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where runs start: spaces with the word behind them, a word at the start of a line, a line end.

    No merge crosses the border of a run: pieces hold the space mark only in front, and never a line end.
    """
    line_end, space = codes == 10, codes == 32
    start = line_end.copy()
    start[1:] |= line_end[:-1] | (space[1:] & ~space[:-1])
    start[firsts] = True
    return np.flatnonzero(start)


def _passes(docs: DataFrame, id_col: str, text_col: str, model: str, options: dict, digest: bool) -> DataFrame:
    slim = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
                       F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_name"))
    id_type = slim.schema["_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(load_model(model))

    def parts(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
        """Rows of about ``CHUNK_CHARACTERS``; a longer text is a part of its own."""
        lengths = [len(x) for x in batch.column(1).to_pylist()]
        at = total = 0
        for n, length in enumerate(lengths):
            if n > at and total + length > CHUNK_CHARACTERS:
                yield at, n - at
                at, total = n, 0
            total += length
        if at < len(lengths):
            yield at, len(lengths) - at

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(sent.value, **options)
        for whole in batches:
            for at, rows in parts(whole):
                batch = whole.slice(at, rows)
                texts = batch.column(1).to_pylist()
                each = encoder.encode(texts, batch.column(2).to_pylist())
                sizes = np.fromiter(map(len, each), np.int64, len(each)) // 4
                columns = [batch.column(0), pa.array(sizes)]
                if digest:
                    back = [encoder.decode(x) for x in each]
                    columns += [
                        pa.array([hashlib.sha256(x).hexdigest() for x in each], pa.string()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in back], pa.string()),
                        pa.array([x == t.encode() for x, t in zip(back, texts, strict=True)], pa.bool_()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["_id", "n_pieces", "pieces_sha256", "text_sha256", "lossless"])
                else:
                    bounds = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                    ids = np.frombuffer(b"".join(each), "<i4")
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids)))
                    yield pa.RecordBatch.from_arrays(columns, ["_id", "n_pieces", "pieces"])

    shape = "pieces_sha256 string, text_sha256 string, lossless boolean" if digest else "pieces array<int>"
    return slim.mapInArrow(run, f"_id {id_type}, n_pieces long, {shape}").withColumnRenamed("_id", id_col)


def encode_documents(docs: DataFrame, model: str = DEFAULT_MODEL, id_col: str = "doc_id", text_col: str = "text",
                     **options) -> DataFrame:
    """``id_col``, ``n_pieces`` and ``pieces`` (ids) of every whole text.

    ``options``: dropout, seed, epoch, table_words. Null and empty texts have no pieces. Repeated rows come back repeated, with
    equal pieces if ids and texts are equal; a null id counts as an empty name. Other columns are not read. An empty
    table gives an empty result.
    """
    return _passes(docs, id_col, text_col, model, options, digest=False)


def encoding_digests(docs: DataFrame, model: str = DEFAULT_MODEL, id_col: str = "doc_id", text_col: str = "text",
                     **options) -> DataFrame:
    """Encodes and decodes every whole text: piece count, SHA-256 of the ids (little-endian int32) and of the decoded
    text, and ``lossless`` (it equals the text). Rows and cases as in ``encode_documents``."""
    return _passes(docs, id_col, text_col, model, options, digest=True)


def decode_documents(encoded: DataFrame, model: str = DEFAULT_MODEL, pieces_col: str = "pieces",
                     out: str = "text") -> DataFrame:
    """``encoded`` with the text of its pieces in ``out``; null pieces give a null text, none an empty one."""
    table = [p.replace(SPACE, " ").encode() if kind == "n" else bytes([int(p[3:5], 16)]) if kind == "b" else b""
             for p, _, kind in load_model(model)]
    sent = encoded.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("string")
    def decoded(column):
        known = sent.value
        return column.map(
            lambda ids: None if ids is None else b"".join(map(known.__getitem__, ids)).decode("utf-8")[1:])

    return encoded.withColumn(out, decoded(F.col(pieces_col)))
