"""SentencePiece encoding and decoding by suffix-array matching.

The texts of a batch are joined into byte strings, in which segments that repeat
stand once.  Their suffix array, sorted as far as the longest piece reaches, is
searched for every piece of the vocabulary; the ranges give all occurrences,
which are the edges of a lattice.  Edges are sorted by the position where they
end and relaxed.  Nothing is kept from one batch to the next.

The public model is a byte-pair model: its segmentation is fixed by merge
order, not by a sum of scores.  The relaxation is therefore exact in another
sense than a shortest path: the last piece of the segmentation of each prefix
is unique, and an edge is that piece exactly if the piece that ends where it
starts may stand before it, which merge ranks decide.  Unigram models, whose
edges compete by score, are relaxed as a best path.

The same rule serves long segments (text without spaces).  They are cut into
windows that overlap, all windows are relaxed at once, and two neighbours are
joined at a position where both have a border and the two pieces around it may
stand side by side: a row of pieces of which all neighbours may do so is the
segmentation.  Only where two windows share no such border (some periodic
texts) the segment is relaxed edge by edge.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cached_property
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netloom.llm.common import local_files, texts_of, worker_cache
from netloom.llm.words import SegmentTable

SPACE = "▁"
#: Stand-ins that no UTF-8 text has: the piece space, and the border of two segments.
SPACE_BYTE, BORDER = 0xFE, 0xFF
#: Characters of text that are matched together, and bytes of distinct segments in one suffix array.
BATCH_CHARS, ARRAY_BYTES = 2_000_000, 200_000
#: Bytes between the windows of a long segment; a power of two fits runs of one sign, whose pieces have such lengths.
STEP = 64
#: The longest window: two steps, and what leads to the start of a character.
LEVELS = 2 * STEP + 3
NEVER = 1 << 40


class Pieces:
    """A vocabulary, with what matching and relaxing need of it.  It is picklable and of fixed size."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str], bpe: bool):
        """``kinds``: normal, byte, or other (control and unknown pieces, which no text matches)."""
        self.bpe = bpe
        self.text = [p if k == "normal" else "" for p, k in zip(pieces, kinds)]
        self.raw = [bytes([int(p[3:5], 16)]) if k == "byte" else p.replace(SPACE, " ").encode() if k == "normal" else b"" for p, k in zip(pieces, kinds)]
        self.byte_id = np.full(256, -1, np.int64)
        for i, k in enumerate(kinds):
            if k == "byte":
                self.byte_id[self.raw[i][0]] = i
        self.score = np.array(scores, np.float64)
        if SPACE in "".join(p.lstrip(SPACE) for p in self.text) or any("\n" in p for p in self.text):
            raise ValueError("pieces cross the borders of segments")
        used = [i for i, k in enumerate(kinds) if k == "normal" and pieces[i]]
        if bpe:
            self._ranks(used)
            used = [i for i in used if self.left[i] >= 0 or self.rank[i] < 0]
        self.ids = np.array(used, np.int64)
        self.coded = [_coded(self.text[i]) for i in used]
        self.size = np.array([len(c) for c in self.coded], np.int64)
        self.longest = int(self.size.max(initial=1))
        self.length = np.ones(len(pieces), np.int64)
        self.length[self.ids] = self.size
        self.low = np.array([int.from_bytes(c[:8].ljust(8, b"\0"), "big") for c in self.coded], np.uint64)
        self.high = np.array([int.from_bytes(c[:8].ljust(8, b"\xff"), "big") for c in self.coded], np.uint64)
        self.key = sha256(repr((pieces, scores, kinds, bpe)).encode()).hexdigest()

    def _ranks(self, used: list[int]) -> None:
        """Merge ranks, the pairs that merge, and the last merge of each piece that merging can reach."""
        at = {self.text[i]: i for i in used}
        order = sorted((i for i in used if len(self.text[i]) > 1), key=lambda i: -self.score[i])
        self.rank = np.full(len(self.text), -1, np.int64)
        self.rank[order] = np.arange(len(order))
        self.left = np.full(len(self.text), -1, np.int64)
        self.right = np.full(len(self.text), -1, np.int64)
        pairs = {}
        for i in order:
            p = self.text[i]
            for k in range(1, len(p)):
                if (a := at.get(p[:k])) is not None and (b := at.get(p[k:])) is not None:
                    pairs[a * len(self.text) + b] = int(self.rank[i])
        self.pair_key = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k] for k in self.pair_key.tolist()], np.int64)
        of_rank = dict(enumerate(order))
        for i in order:
            symbols = [at.get(c, -1) for c in self.text[i]]
            while len(symbols) > 2:
                found = [(pairs.get(a * len(self.text) + b, NEVER) if min(a, b) >= 0 else NEVER, k) for k, (a, b) in enumerate(zip(symbols, symbols[1:]))]
                best, k = min(found)
                if best == NEVER:
                    break
                symbols[k : k + 2] = [of_rank[best]]
            if len(symbols) == 2 and min(symbols) >= 0:
                self.left[i], self.right[i] = symbols

    def follows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether piece ``b`` may stand right after piece ``a``: no merge across the border comes before theirs are done."""
        ok = np.ones(len(a), bool)
        at, a, b = np.arange(len(a)), a.copy(), b.copy()
        limit = np.full(len(a), NEVER, np.int64)
        while len(at):
            key = a * len(self.text) + b
            k = np.minimum(np.searchsorted(self.pair_key, key), max(0, len(self.pair_key) - 1))
            merged = np.where(self.pair_key[k] == key, self.pair_rank[k], NEVER) if len(self.pair_key) else np.full(len(a), NEVER)
            bad = merged < limit
            ok[at[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~bad & ((ra >= 0) | (rb >= 0))
            undo_a = ra > rb
            limit = np.where(undo_a, ra, rb + 1)[go]
            a, b = np.where(undo_a, self.right[a], a)[go], np.where(undo_a, b, self.left[b])[go]
            at = at[go]
        return ok


    @cached_property
    def _pairs(self) -> dict[int, int]:
        return dict(zip(self.pair_key.tolist(), self.pair_rank.tolist()))

    def follows_one(self, a: int, b: int) -> bool:
        """:meth:`follows` for one pair."""
        limit = NEVER
        while True:
            if self._pairs.get(a * len(self.text) + b, NEVER) < limit:
                return False
            ra, rb = self.rank[a], self.rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = ra, int(self.right[a])
            else:
                limit, b = rb + 1, int(self.left[b])


def read_model(path: str) -> Pieces:
    """The vocabulary of a SentencePiece model file."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    n = range(m.vocab_size())
    kinds = ["byte" if m.is_byte(i) else "other" if m.is_control(i) or m.is_unknown(i) or m.is_unused(i) else "normal" for i in n]
    return Pieces([m.id_to_piece(i) for i in n], [m.get_score(i) for i in n], kinds, bpe=True)


def _coded(segment: str) -> bytes:
    return segment.encode("utf-8", "surrogatepass").replace(b"\xe2\x96\x81", bytes([SPACE_BYTE]))


SEGMENT = re.compile("\n| *[^ \n]+| +")


def split_segments(text: str) -> list[str]:
    """Runs of spaces with the word after them, and line breaks; no piece reaches from one to the next."""
    return SEGMENT.findall(" " + text.replace(SPACE, " ")) if text else []


def suffix_array(data: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``data`` sorted by the next ``reach`` bytes at least, and the first eight bytes of each, in that order."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    first = np.zeros(len(data), np.uint64)
    for k in range(8):
        first = (first << np.uint64(8)) | padded[k : k + len(data)].astype(np.uint64)
    order = np.argsort(first, kind="stable")
    known, key = 8, first
    while known < reach:
        fresh = np.concatenate([[0], (key[order][1:] != key[order][:-1]).astype(np.int64)])
        rank = np.empty(len(data), np.int64)
        rank[order] = np.cumsum(fresh)
        if rank.max(initial=0) == len(data) - 1:
            break
        after = np.zeros(len(data), np.int64)
        after[: len(data) - known] = rank[known:] + 1
        key = rank * (len(data) + 1) + after
        order = np.argsort(key, kind="stable")
        known *= 2
    return order, first[order]


def occurrences(data: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """All (piece, start) pairs where a piece stands in ``data``, by binary search of each piece."""
    order, first = suffix_array(data, pieces.longest)
    low = np.searchsorted(first, pieces.low, "left")
    high = np.searchsorted(first, pieces.high, "right")
    long = np.flatnonzero((pieces.size > 8) & (high > low))
    if len(long):  # the rest of a long piece is searched inside the range of its first eight bytes
        width = pieces.longest
        want = np.zeros((len(long), width), np.int16)
        for r, k in enumerate(long):
            want[r, : pieces.size[k]] = np.frombuffer(pieces.coded[k], np.uint8)
        inside = np.arange(width) < pieces.size[long][:, None]
        padded = np.concatenate([data, np.zeros(width, np.uint8)]).astype(np.int16)
        for bound, right in ((low, False), (high, True)):
            lo, hi = low[long].copy() if not right else bound_low.copy(), high[long].copy()
            while (lo < hi).any():
                open_ = lo < hi
                mid = (lo + hi) // 2
                got = padded[order[np.minimum(mid, len(order) - 1)][:, None] + np.arange(width)]
                diff = np.where(inside, got - want, 0)
                at = (diff != 0).argmax(1)
                sign = diff[np.arange(len(long)), at]
                up = open_ & ((sign <= 0) if right else (sign < 0))
                lo, hi = np.where(up, mid + 1, lo), np.where(open_ & ~up, mid, hi)
            if not right:
                bound_low = lo
            else:
                high[long] = lo
        low[long] = bound_low
    count = np.maximum(high - low, 0)
    end = np.cumsum(count)
    take = np.arange(end[-1] if len(end) else 0) + np.repeat(low - (end - count), count)
    return np.repeat(pieces.ids, count).astype(np.int32), order[take].astype(np.int32)


def encode_segments(segments: list[str], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of all segments, and the number of ids of each."""
    coded = [_coded(s.replace(" ", SPACE)) for s in segments]
    long = [k for k, c in enumerate(coded) if len(c) > LEVELS] if pieces.bpe else []
    if not long:
        return _encode_units(coded, pieces)
    ids, count = _encode_units([b"" if len(c) > LEVELS else c for c in coded], pieces)
    own, n = _encode_windows([coded[k] for k in long], [STEP] * len(long), pieces)
    start = np.cumsum(count) - count
    count[long], start[long] = n, len(ids) + np.cumsum(n) - n
    return _picked(np.concatenate([ids, own]), start, count), count


def _picked(flat: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` from ``start`` on, one after the other."""
    end = np.cumsum(count)
    return flat[np.arange(end[-1] if len(end) else 0) + np.repeat(start - (end - count), count)]


def _window_starts(coded: bytes, first: int) -> list[int]:
    """Where the windows of a long segment start: at ``first`` and about every ``STEP`` bytes from there, at a character."""
    starts, at = [0], first
    while starts[-1] + 2 * STEP < len(coded):
        while coded[at] & 0xC0 == 0x80:
            at -= 1
        starts.append(at)
        at += STEP
    return starts


def _encode_units(units: list[bytes], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids and numbers of ids, in arrays of bounded size."""
    ids, counts, part, size = [], [], [], 0
    for k, coded in enumerate(units):
        part.append(coded)
        size += len(coded) + 1
        if size >= ARRAY_BYTES or k + 1 == len(units):
            a, b = _encode_array(part, pieces)
            ids.append(a)
            counts.append(b)
            part, size = [], 0
    return (np.concatenate(ids), np.concatenate(counts)) if ids else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _encode_windows(coded: list[bytes], first: list[int], pieces: Pieces, again: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of long segments from those of their windows, and the number of ids of each.

    A segment whose windows do not fit is tried once more with the second window at
    a border of the first (runs of one sign then fit), and else relaxed by itself.
    """
    units, owner, start = [], [], []
    for k, c in enumerate(coded):
        places = _window_starts(c, first[k])
        units += [c[a:b] for a, b in zip(places, [*places[2:], len(c), len(c)])]
        owner += [k] * len(places)
        start += places
    owner, start = np.array(owner), np.array(start)
    ids, counts = _encode_units(units, pieces)
    unit = np.repeat(np.arange(len(owner)), counts)
    length = pieces.length[ids]
    end = np.cumsum(length)
    end += np.repeat(start - np.concatenate([[0], end])[np.cumsum(counts) - counts], counts)
    begin = end - length
    has_before = np.concatenate([[False], owner[1:] == owner[:-1]])
    has_next = np.concatenate([has_before[1:], [False]])
    # Borders that two neighbours share, keyed by the second of them.
    wide = max(map(len, coded)) + 1
    left, right = np.flatnonzero(has_next[unit]), np.flatnonzero(has_before[unit] & (begin > start[unit]))
    _, i, j = np.intersect1d((unit[left] + 1) * wide + end[left], unit[right] * wide + begin[right], return_indices=True)
    i, j = left[i], right[j]
    ok = pieces.follows(ids[i], ids[j])
    border = np.full(len(owner), NEVER)
    np.minimum.at(border, unit[j[ok]], begin[j[ok]])
    low = np.where(has_before, border, start)
    high = np.where(has_next, np.append(border[1:], 0), NEVER)
    keep = (begin >= low[unit]) & (end <= high[unit])
    count = np.bincount(owner[unit[keep]], minlength=len(coded))
    flat, at = ids[keep], np.cumsum(count) - count
    alone = np.unique(owner[has_before & (border == NEVER)]).tolist()
    if alone and again:
        heads = [end[(unit == np.searchsorted(owner, k)) & (end <= STEP)].max(initial=STEP // 2) for k in alone]
        own, n = _encode_windows([coded[k] for k in alone], heads, pieces, again=False)
    elif alone:
        several = [_encode_array([coded[k]], pieces) for k in alone]
        own, n = np.concatenate([x for x, _ in several]), np.concatenate([n for _, n in several])
    if alone:
        count[alone], at[alone] = n, len(flat) + np.cumsum(n) - n
        flat = _picked(np.concatenate([flat, own]), at, count)
    return flat, count


def _encode_array(coded: list[bytes], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    border = bytes([BORDER])
    data = np.frombuffer(border.join(coded) + border, np.uint8)
    length = np.array([len(c) for c in coded], np.int64)
    begin = np.cumsum(length + 1) - (length + 1)
    piece, start = occurrences(data, pieces)
    # Characters without a piece of their own become bytes: one edge for each byte.
    lead = (data & 0xC0) != 0x80
    single = np.zeros(len(data) + 1, bool)
    of_char = np.cumsum(lead) - 1
    char_at = np.flatnonzero(lead)
    width = np.diff(np.concatenate([char_at, [len(data)]]))
    single[start[pieces.length[piece] == width[of_char[start]]]] = True
    bare = np.flatnonzero(~single[char_at][of_char] & (data != BORDER))
    bare = bare[pieces.byte_id[data[bare]] >= 0]
    piece = np.concatenate([piece, pieces.byte_id[data[bare]].astype(np.int32)])
    start = np.concatenate([start, bare.astype(np.int32)])
    end = start + pieces.length[piece].astype(np.int32)
    word = np.repeat(np.arange(len(coded), dtype=np.int32), length + 1)
    level = end - begin[word[start]].astype(np.int32)
    last = np.full(len(data) + 1, -1, np.int64)
    best = np.full(len(data) + 1, -np.inf)
    long = length[word[start]] > LEVELS
    _relax_levels(pieces, piece[~long], start[~long], end[~long], level[~long], begin[word[start[~long]]], last, best)
    _relax_single(pieces, piece[long], start[long], end[long], begin[word[start[long]]], last, best)
    if (last[(begin + length)[length > 0]] < 0).any():
        raise ValueError("no pieces cover some segment, and the model has no byte pieces")
    return _walk(pieces, last, begin, begin + length)


def _relax_levels(pieces, piece, start, end, level, begin, last, best) -> None:
    """All segments at once, one end position after the other."""
    order = np.argsort(level, kind="stable")
    cuts = np.searchsorted(level[order], np.arange(1, LEVELS + 2))
    for k in range(LEVELS):
        e = order[cuts[k] : cuts[k + 1]]
        if not len(e):
            continue
        s, p = start[e], piece[e]
        opens = s == begin[e]
        e, s, p, opens = (x[opens | (last[s] >= 0)] for x in (e, s, p, opens))
        if pieces.bpe:
            ok = opens.copy()
            rest = np.flatnonzero(~opens)
            ok[rest] = pieces.follows(last[s[rest]], p[rest].astype(np.int64))
            last[end[e[ok]]] = p[ok]
        else:
            total = np.where(opens, 0.0, best[s]) + pieces.score[p]
            np.maximum.at(best, end[e], total)
            won = total == best[end[e]]
            last[end[e[won]]] = p[won]


def _relax_single(pieces, piece, start, end, begin, last, best) -> None:
    """Edges of long segments in order of their ends."""
    order = np.lexsort((start, end))
    opens = (start == begin)[order].tolist()
    for s, p, t, first in zip(start[order].tolist(), piece[order].tolist(), end[order].tolist(), opens):
        if not first and last[s] < 0:
            continue
        if pieces.bpe:
            if first or pieces.follows_one(int(last[s]), p):
                last[t] = p
        elif (total := (0.0 if first else best[s]) + pieces.score[p]) > best[t]:
            best[t], last[t] = total, p


def _walk(pieces, last, begin, end) -> tuple[np.ndarray, np.ndarray]:
    """Follow the last pieces back from the end of each segment."""
    at, open_ = end.copy(), np.flatnonzero(end > begin)
    steps, count = [], np.zeros(len(begin), np.int64)
    while len(open_):
        p = last[at[open_]]
        steps.append((open_, p))
        count[open_] += 1
        at[open_] -= pieces.length[p]
        open_ = open_[at[open_] > begin[open_]]
    first = np.cumsum(count) - count
    ids = np.zeros(int(count.sum()), np.int64)
    for k, (words, p) in enumerate(steps):
        ids[first[words] + count[words] - 1 - k] = p
    return ids, count


def decode(ids, pieces: Pieces) -> str:
    """Text of a list of ids: piece spaces are spaces, the first of them is dropped, broken bytes become U+FFFD."""
    raw = b"".join(map(pieces.raw.__getitem__, ids)).decode("utf-8", "replace")
    return raw[1:] if raw.startswith(" ") else raw


def encoder(pieces: Pieces) -> SegmentTable:
    """Encodes blocks of texts with a vocabulary; each block by itself.  A worker that holds it drops the tables of past operators."""
    return worker_cache(("sentencepiece", pieces.key), lambda: SegmentTable(split_segments, lambda s: encode_segments(s, pieces), limit=0, block_chars=BATCH_CHARS))


def encode_documents(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of each row; null and empty texts have no ids.

    Rows are independent: repeated rows repeat, an empty table gives an empty
    result, other columns are ignored.
    """
    pieces = read_model(model or f"{local_files()}/piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = encoder(pieces)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, ids, bounds in table.blocks(texts):
                rows = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(rows)), rows], ["doc_id", "ids"])

    return texts_of(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(coded: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give empty text."""
    pieces = read_model(model or f"{local_files()}/piece_bpe_32k.model")

    def run(batches):
        for batch in batches:
            texts = [decode(x or [], pieces) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return coded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def encode_with_check(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, n_pieces, round_trip) of each row: the ids, and whether decoding them gives the text back."""
    pieces = read_model(model or f"{local_files()}/piece_bpe_32k.model")

    def run(batches):
        table = encoder(pieces)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, ids, bounds in table.blocks(texts):
                flat, n = ids.tolist(), len(bounds) - 1
                same = [decode(flat[a:b], pieces) == (t or "").replace(SPACE, " ") for a, b, t in zip(bounds[:-1].tolist(), bounds[1:].tolist(), texts[first : first + n])]
                rows = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), rows, pa.array(np.diff(bounds), pa.int64()), pa.array(same, pa.bool_())], ["doc_id", "ids", "n_pieces", "round_trip"])

    return texts_of(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, ids array<int>, n_pieces long, round_trip boolean")


def encode_check(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Per document: doc_id, n_pieces, ids_crc32 (little-endian unsigned 32-bit ids), decoded_sha256, round_trip.

    ``round_trip`` says that decoding the ids gives the whole text back; a text
    with U+2581 comes back with spaces, as that sign is the model's space.
    """
    pieces = read_model(model or f"{local_files()}/piece_bpe_32k.model")

    def run(batches):
        table = encoder(pieces)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, ids, bounds in table.blocks(texts):
                n, crc, sha, same = [], [], [], []
                wide = ids.astype("<u4")
                flat = ids.tolist()
                for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    text = decode(flat[a:b], pieces)
                    n.append(b - a)
                    crc.append(zlib.crc32(wide[a:b]))
                    sha.append(sha256(text.encode()).hexdigest())
                    same.append(text == (texts[first + k] or "").replace(SPACE, " "))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(n)), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(sha), pa.array(same)], ["doc_id", "n_pieces", "ids_crc32", "decoded_sha256", "round_trip"])

    return texts_of(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, decoded_sha256 string, round_trip boolean")


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_check(spark.read.parquet(f"{sf_dir}/documents.parquet"))
