"""Byte-level BPE with content-defined chunks that are encoded once.

A rolling hash over bytes cuts texts into chunks, so passages that documents
share give equal chunks.  A worker keeps the ids of the chunks it has seen, by
digest, and encodes each of them once.  The ids of two chunks side by side are
wrong where a token would cross the cut, so each join is repaired: the text from
an anchor before the cut to one behind it is encoded anew and replaces what both
chunks have there.  The outermost stretch on each side lies inside one chunk and
must give the very ids that the chunk has there; while it doesn't, the repaired
text is widened, at last to the whole document.

An anchor is a place between two ASCII characters at which the tokenizer's
pattern always ends a part, whatever stands around it: between a letter, a
digit and another sign, or before white space; with CJK, before a comma or full
stop.  The library encodes; where the tokenizer file says what ``_known``
asks for, it encodes each distinct word (with the white space before it) of the
new chunks once.  Any other file gets whole texts, without chunks.

Null texts are empty and have no ids; rows that share a doc_id each give a row;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from hashlib import blake2b, sha256
from itertools import chain, compress
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netloom.llm.common import local_files, texts_of, worker_cache
from netloom.llm.words import BLOCK_CHARS, SegmentTable

#: Bytes that the rolling hash covers; shortest, mean (as bits) and longest chunk.
WINDOW, MIN_CHUNK, MEAN_BITS, MAX_CHUNK = 32, 128, 9, 4096
#: Ids that a worker's table of chunks holds before it starts anew.
TABLE_IDS = 24_000_000
#: Words that it holds, and those that go to the library side by side.
WORDS, JOINED = 1_000_000, 500

#: Any character that some version of Unicode counts as white space, but the four plain ones.
ODD_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
WORD = re.compile("[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")

_LETTER, _DIGIT, _SIGN, _QUOTE, _SPACE = 1, 2, 3, 4, 5
_CLASS = np.zeros(256, np.uint8)
for _kind, _signs in ((_SIGN, range(33, 127)), (_LETTER, b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"), (_DIGIT, b"0123456789"), (_QUOTE, b"'"), (_SPACE, b" \t\n\r")):
    _CLASS[list(_signs)] = _kind
#: Whether a part always ends between characters of two classes; an apostrophe may go on with letters, white space with what follows.
_ENDS = np.zeros((6, 6), bool)
for _a, _b in ((a, b) for a in (_LETTER, _DIGIT, _SIGN, _QUOTE) for b in (_LETTER, _DIGIT, _SIGN, _QUOTE, _SPACE)):
    _ENDS[_a, _b] = _b == _SPACE or {_a, _b} in ({_LETTER, _DIGIT}, {_LETTER, _SIGN}, {_DIGIT, _SIGN}) or (_a in (_LETTER, _DIGIT) and _b == _QUOTE)
#: A CJK ideograph before an ideographic or full-width comma, stop or mark.
_CJK = re.compile(rb"(?:\xe4[\xb8-\xbf]|[\xe5-\xe8][\x80-\xbf]|\xe9[\x80-\xbd])[\x80-\xbf](?=\xe3\x80[\x81\x82]|\xef\xbc[\x81\x8c\x9a\x9b\x9f])")

#: What a tokenizer file says if the anchors above are right for it.
PRE_TOKENIZER = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
MODEL = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "end_of_word_suffix": None, "byte_fallback": False}


def _known(spec: dict) -> bool:
    """Whether texts may be cut: the pattern is the byte-level one, nothing else changes the text, and added tokens hold no white space."""
    before = spec["pre_tokenizer"] or {}
    return (
        not spec["normalizer"] and not spec["post_processor"] and all(before.get(k) == v for k, v in PRE_TOKENIZER.items()) and all(spec["model"].get(k) == v for k, v in MODEL.items())
        and all(not re.search(r"\s", t["content"]) and not t["lstrip"] and not t["rstrip"] and not t["single_word"] for t in spec["added_tokens"])
    )


def byte_signs() -> dict[str, int]:
    """The printable sign that stands for each byte in a byte-level vocabulary: bytes that are printable stand for themselves, the others for U+0100 and on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def token_bytes(spec: dict) -> list[bytes]:
    """The bytes of each id."""
    signs, out = byte_signs(), {}
    for token, i in spec["model"]["vocab"].items():
        out[i] = bytes(signs[c] for c in token) if all(c in signs for c in token) else token.encode()
    out |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
    return [out.get(i, b"") for i in range(max(out) + 1)]


def _library(spec: str):
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(spec)
    library.no_truncation()
    library.no_padding()
    return library


def rolling_hash(raw: np.ndarray) -> np.ndarray:
    """At each position the hash of the last WINDOW bytes, by doubling."""
    h = (raw.astype(np.uint32) + np.uint32(1)) * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    power, reach = np.uint32(0x85EBCA6B), 1
    while reach < WINDOW:
        h[reach:] = h[reach:] + power * h[:-reach]
        power, reach = power * power, reach * 2
    return h


def cut_points(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Ends of the chunks of each text between ``bounds``, all in one rising list; no character is cut."""
    with np.errstate(over="ignore"):
        marks = np.flatnonzero(rolling_hash(raw) >> np.uint32(32 - MEAN_BITS) == 0) + 1
    inner = np.append(raw & 0xC0 == 0x80, False)
    for _ in range(3):
        marks = marks + inner[marks]
    marks, out = np.unique(marks), []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        at = a
        lo, hi = np.searchsorted(marks, (a + MIN_CHUNK, b))
        for mark in [*marks[lo:hi].tolist(), b]:
            while mark - at > MAX_CHUNK:
                at += MAX_CHUNK
                while inner[at]:
                    at += 1
                out.append(at)
            if mark - at >= MIN_CHUNK or mark == b > at:
                out.append(mark)
                at = mark
    return np.array(out, np.int64)


def anchors(raw: np.ndarray, text: bytes, added: list[bytes]) -> np.ndarray:
    """Positions at which a part ends in any surroundings."""
    kind = _CLASS[raw]
    at = np.flatnonzero(_ENDS[kind[:-1], kind[1:]]) + 1
    found = [m.end() for m in _CJK.finditer(text)] if b"\xe3\x80" in text or b"\xef\xbc" in text else []
    if found:
        at = np.union1d(at, found)
    for token in added:
        here = text.find(token)
        while here >= 0:
            at = at[(at <= here) | (at >= here + len(token))]
            here = text.find(token, here + 1)
    return at


class ChunkCodec:
    """ids of texts through a table of chunks; the same ids as the library's for whole texts."""

    def __init__(self, spec: str):
        plain = json.loads(spec)
        library = _library(spec)
        self.bytes = token_bytes(plain)
        self.width = np.array([len(b) for b in self.bytes], np.int64)
        self.kind = np.uint16 if len(self.bytes) <= 1 << 16 else np.uint32
        self.added = [t["content"].encode() for t in plain["added_tokens"]]

        def flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
            lists = [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
            length = np.fromiter(map(len, lists), np.int64, len(lists))
            return np.fromiter(chain.from_iterable(lists), np.int64, int(length.sum())), length

        def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
            """Words with white space before and none at the end go to the library side by side, as each border is an anchor."""
            spaced = np.fromiter((w[0] in " \t\n\r" and not w[-1].isspace() and not ODD_SPACE.match(w[-1]) for w in words), bool, len(words))
            joined, single = list(compress(words, spaced)), list(compress(words, ~spaced))
            ids, _ = flat(["".join(joined[k : k + JOINED]) for k in range(0, len(joined), JOINED)])
            ends = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum([len(w.encode()) for w in joined]), "right")
            own, count = flat(single)
            length = np.empty(len(words), np.int64)
            length[spaced], length[~spaced] = np.diff(ends, prepend=0), count
            out = np.empty(length.sum(), np.int64)
            at = np.repeat(spaced, length)
            out[at], out[~at] = ids, own
            return out, length

        self.words = SegmentTable(lambda t: [t] if ODD_SPACE.search(t) else WORD.findall(t), encode, limit=WORDS)
        self.chunks: dict[bytes, np.ndarray] = {}
        self.held = self.encoded = self.repaired = self.widened = 0

    def _strings(self, texts: list[str]) -> list[np.ndarray]:
        return [ids[a:b] for _, ids, bounds in self.words.blocks(texts) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def _chunk_ids(self, text: bytes, starts: list[int], ends: list[int]) -> np.ndarray:
        """ids of all chunks, one after the other; unknown ones are encoded."""
        if self.held > TABLE_IDS:
            self.chunks, self.held = {}, 0
        keys, new = [], {}
        for a, b in zip(starts, ends):
            piece = text[a:b]
            keys.append(key := blake2b(piece, digest_size=16).digest())
            if key not in self.chunks and key not in new:
                new[key] = piece
        for key, ids in zip(new, self._strings([p.decode() for p in new.values()])):
            self.chunks[key] = ids.astype(self.kind)
            self.held += len(ids)
        self.encoded += len(new)
        return np.concatenate([np.zeros(0, self.kind), *map(self.chunks.__getitem__, keys)]).astype(np.int64)

    def _windows(self, cuts: np.ndarray, reach: np.ndarray, at: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
        """Stretches to encode anew for ``cuts``, ``reach`` anchors to each side, and the inner ends of their outermost parts; those that meet are one."""
        left, right = np.searchsorted(at, cuts, "right") - 1, np.searchsorted(at, cuts, "left")
        place = lambda k: at[np.clip(k, 0, len(at) - 1)] if len(at) else np.zeros(len(k), np.int64)
        before = lambda k: np.where(k < 0, first, np.maximum(place(k), first))
        behind = lambda k: np.where(k >= len(at), last, np.minimum(place(k), last))
        low, low_end, high_start, high = before(left - reach), before(left - reach + 1), behind(right + reach - 1), behind(right + reach)
        top = np.maximum.accumulate(high)
        begins = np.append(True, low[1:] >= top[:-1])
        starts = np.flatnonzero(begins)
        low = np.minimum.reduceat(low, starts)
        ends = np.append(starts[1:], len(cuts)) - 1
        furthest = np.array([a + int(np.argmax(high[a : b + 1])) for a, b in zip(starts, ends)])
        return low, low_end[starts], high_start[furthest], high[furthest], np.cumsum(begins) - 1

    def block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts and their bounds in them."""
        pieces = [t.encode() for t in texts]
        text, bounds = b"".join(pieces), np.cumsum([0, *map(len, pieces)])
        raw = np.frombuffer(text, np.uint8)
        ends = cut_points(raw, bounds)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)[: len(ends)]
        ids = self._chunk_ids(text, starts.tolist(), ends.tolist())
        start = np.cumsum(self.width[ids]) - self.width[ids]
        cuts = np.setdiff1d(ends, bounds)
        if len(cuts):
            owner = np.searchsorted(bounds, cuts, "right") - 1
            at, reach = anchors(raw, text, self.added), np.ones(len(cuts), np.int64)
            while True:
                low, low_end, high_start, high, of = self._windows(cuts, reach, at, bounds[owner], bounds[owner + 1])
                lists = self._strings([text[a:b].decode() for a, b in zip(low.tolist(), high.tolist())])
                new = np.concatenate(lists)
                count = np.array([len(x) for x in lists])
                new_start = np.cumsum(self.width[new]) - self.width[new]
                new_start += np.repeat(low - (np.cumsum(high - low) - (high - low)), count)
                bad = self._apart(ids, start, new, new_start, low, low_end) | self._apart(ids, start, new, new_start, high_start, high)
                if not bad.any():
                    break
                self.widened += int(bad.sum())
                reach[bad[of]] *= 2
            self.repaired += len(low)
            inside = np.searchsorted(low, start, "right") - 1
            keep = (inside < 0) | (start >= high[inside])
            ids, start = ids[keep], start[keep]
            to = np.searchsorted(start, new_start)
            ids, start = np.insert(ids, to, new), np.insert(start, to, new_start)
        if int(self.width[ids].sum()) != len(text):
            raise ValueError("the ids do not cover the text")
        return ids, np.searchsorted(start, bounds)

    @staticmethod
    def _apart(ids, start, new, new_start, a, b) -> np.ndarray:
        """For which stretches [a, b) the chunks' ids and the new ones differ, or one has no token that begins at ``b``."""
        out = np.zeros(len(a), bool)
        ranges = [(np.searchsorted(s, a), np.searchsorted(s, b)) for s in (start, new_start)]
        (p, q), (v, w) = ranges
        out |= q - p != w - v
        same = np.flatnonzero(~out & (q > p))
        if len(same):
            count = (q - p)[same]
            steps = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            i, j = np.repeat(p[same], count) + steps, np.repeat(v[same], count) + steps
            out[same] = np.add.reduceat((ids[i] != new[j]) | (start[i] != new_start[j]), np.cumsum(count) - count) > 0
        return out

    def blocks(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(index of the first text, ids of a block of texts, bounds of each text in them)."""
        first, chars = 0, 0
        for k, t in enumerate(texts):
            chars += len(t or "") + 1
            if chars >= BLOCK_CHARS or k + 1 == len(texts):
                yield first, *self.block([t or "" for t in texts[first : k + 1]])
                first, chars = k + 1, 0


class WholeCodec(ChunkCodec):
    """ids of whole texts from the library, for tokenizer files whose texts may not be cut."""

    def block(self, texts):
        lists = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for x in lists for i in x], np.int64), np.cumsum([0, *map(len, lists)])

    def __init__(self, spec: str):
        self.library = _library(spec)


def codec(spec: str) -> ChunkCodec:
    """A worker keeps its codec, and so its chunks, from task to task."""
    return worker_cache(("byte-bpe", hash(spec)), lambda: (ChunkCodec if _known(json.loads(spec)) else WholeCodec)(spec))


class Decoder:
    """Text of ids, special tokens included, as the library's decode gives it."""

    def __init__(self, spec: str):
        plain = json.loads(spec)
        self.table, self.library = (token_bytes(plain), None) if _known(plain) and (plain["decoder"] or {}).get("type") == "ByteLevel" else ([], _library(spec))

    def __call__(self, ids: list[int]) -> str:
        if self.library:
            return self.library.decode(ids, skip_special_tokens=False)
        return b"".join(map(self.table.__getitem__, ids)).decode("utf-8", "replace")


def _spec(tokenizer_json: str | None) -> str:
    return Path(tokenizer_json or f"{local_files()}/byte_bpe_50k.json").read_text(encoding="utf-8")


def encode_documents(docs: DataFrame, tokenizer_json: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids of each row of ``docs``."""
    spec = _spec(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, ids, bounds in codec(spec).blocks(batch.column(1).to_pylist()):
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(lists)), lists], ["doc_id", "ids"])

    return texts_of(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, tokenizer_json: str | None = None) -> DataFrame:
    """doc_id, text of rows of :func:`encode_documents`; null ids give an empty text."""
    spec = _spec(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = worker_cache(("byte-bpe-decoder", hash(spec)), lambda: Decoder(spec))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([decode(x or []) for x in batch.column("ids").to_pylist()], pa.string())], ["doc_id", "text"])

    return texts_of(encoded).select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def encode_check(docs: DataFrame, tokenizer_json: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row: encoded, and decoded from its ids, in one pass."""
    spec = _spec(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = Decoder(spec)
        names = {}
        for batch in batches:
            for first, ids, bounds in codec(spec).blocks(batch.column(1).to_pylist()):
                names |= {i: str(i) for i in np.unique(ids).tolist() if i not in names}
                lists = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]
                digests = [sha256(",".join(map(names.__getitem__, x)).encode()).hexdigest() for x in lists]
                texts = [sha256(decode(x).encode()).hexdigest() for x in lists]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(lists)), pa.array(np.diff(bounds), pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                )

    rows = texts_of(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_check(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
