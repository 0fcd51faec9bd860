"""A content-addressed store for token ids.

Documents are tokenised and a rolling hash cuts each id stream into chunks
where its value ends in zero bits, so equal passages give equal chunks.  The
store has three tables in one folder:

``chunks``    digest, n, payload: each distinct chunk once, ids as little-endian
              unsigned integers of 2 bytes, or 4 if the vocabulary needs them
``recipes``   in ascending doc_id order: doc_id, local_start, n_tokens, digests,
              root (Merkle root of the chunk digests), part
``manifest``  per part: first id position, ids, documents, and a sum over its
              documents' roots

Reading checks every chunk against its digest, every document against its
root, and every part against the manifest.

The tokenizers library encodes.  Where the tokenizer file says what ``_cuts``
asks for, whole texts are cut by the file's own pattern and each distinct part is
encoded once, as no token crosses the border of two parts; with any other file
whole texts go to the library as they are.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import accumulate, chain, compress
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netloom.llm.common import drop_scratch, local_files, scratch, texts_of, worker_cache
from netloom.llm.words import BLOCK_CHARS, SegmentTable

WINDOW, MIN_CHUNK, MEAN_BITS, MAX_CHUNK = 16, 64, 9, 4096
_BASE = np.uint64(0x9E3779B97F4A7C15)

#: Tokens never hold or cross white space.
WORD = re.compile("[^\t-\r ]+")
_LETTER, _DIGIT = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
#: The tokenizer's own pattern, for lower-case texts of U+0000 to U+00FF.
PART = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^\t-\r \x85\xa0{_LETTER}{_DIGIT}]+")

LATIN = re.compile("[\x00-\xff]*")

#: Parts that a worker's table holds; some 150 MB.
PARTS = 1_000_000


#: What a tokenizer file says if the two patterns above are right for it.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
TO_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
MODEL = {"type": "BPE", "dropout": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "byte_fallback": False, "ignore_merges": False}


def _cuts(spec: dict) -> bool:
    """Whether texts may be cut into parts: the file's normaliser, pattern and model are the known ones, and each added token begins with ``<|`` and holds no white space."""
    return (
        spec["normalizer"] == NORMALIZER and spec["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [SPLIT, TO_BYTES]} and not spec["post_processor"] and not spec["truncation"] and not spec["padding"]
        and all(spec["model"].get(k) == v for k, v in MODEL.items()) and all(t["content"].startswith("<|") and not re.search(r"\s", t["content"]) and not t["lstrip"] and not t["rstrip"] and not t["single_word"] for t in spec["added_tokens"])
    )


def split_parts(text: str) -> list[str]:
    """Segments of a text whose ids, one after the other, are the text's.

    Where the tokenizer's normaliser only changes case (texts of U+0000 to
    U+00FF without special tokens) they are the parts that its pattern finds;
    elsewhere they are the words between white space.
    """
    if "<|" not in text:
        try:
            text.encode("latin-1")
            return PART.findall(text.lower())
        except UnicodeEncodeError:
            pass
    return WORD.findall(text)


class _Tokenizer:
    """Encodes distinct segments with the tokenizers library.

    A segment that is one part already goes through the model alone, without
    the normaliser and the pattern, which would leave it as it is; all others
    go through the tokenizer whole.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        plain = json.loads(spec)
        to_bytes = next(p for p in plain["pre_tokenizer"]["pretokenizers"] if p["type"] == "ByteLevel")
        self.whole, self.plain = Tokenizer.from_str(spec), Tokenizer.from_str(json.dumps({**plain, "normalizer": None, "pre_tokenizer": to_bytes, "added_tokens": []}))
        vocabulary = plain["model"]["vocab"]
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def encode(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        single = [PART.fullmatch(s) is not None and LATIN.fullmatch(s) is not None and s == s.lower() for s in segments]
        parts, rest = list(compress(segments, single)), [s for s, one in zip(segments, single) if not one]
        ids = np.concatenate([np.zeros(0, np.int64), *(self.plain.encode_batch_fast([parts[k : k + 500]], add_special_tokens=False, is_pretokenized=True)[0].ids for k in range(0, len(parts), 500))]).astype(np.int64)
        ends = np.concatenate([[0], np.flatnonzero(self.ends[ids]) + 1])  # one end a part
        if not rest:
            return ids, np.diff(ends)
        other = iter([e.ids for e in self.whole.encode_batch_fast(rest, add_special_tokens=False)])
        own = iter(np.split(ids, ends[1:-1])) if parts else iter(())
        lists = [next(own) if one else next(other) for one in single]
        length = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.int64, int(length.sum())), length


class WholeTexts:
    """ids of whole texts from the library, block by block."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)

    def blocks(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        first, chars = 0, 0
        for k, t in enumerate(texts):
            chars += len(t or "") + 1
            if chars >= BLOCK_CHARS or k + 1 == len(texts):
                lists = [e.ids for e in self.tokenizer.encode_batch_fast([t or "" for t in texts[first : k + 1]], add_special_tokens=False)]
                length = np.array([len(x) for x in lists], np.int64)
                yield first, np.fromiter(chain.from_iterable(lists), np.int64, int(length.sum())), np.concatenate([[0], np.cumsum(length)])
                first, chars = k + 1, 0


def _tokenizer_table(spec: str) -> SegmentTable | WholeTexts:
    """A worker keeps its table from task to task."""
    return worker_cache(("tokenizer", hash(spec)), lambda: SegmentTable(split_parts, _Tokenizer(spec).encode, PARTS) if _cuts(json.loads(spec)) else WholeTexts(spec))


def _id_type(spec: str, end_id: int) -> str:
    """The type of stored ids, one for the whole store, so that equal chunks have equal bytes."""
    from tokenizers import Tokenizer

    most = max(Tokenizer.from_str(spec).get_vocab(with_added_tokens=True).values())
    return "<u2" if max(most, end_id) < 1 << 16 else "<u4"


def rolling_hash(ids: np.ndarray) -> np.ndarray:
    """At each position the hash of the last WINDOW ids, by doubling."""
    h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    power, reach = _BASE, 1
    while reach < WINDOW:
        h[reach:] = h[reach:] + power * h[:-reach]
        power, reach = power * power, reach * 2
    return h


def cut_points(ids: np.ndarray, bounds: np.ndarray) -> list[list[int]]:
    """For each stream between ``bounds`` the ends of its chunks; the last is the end of the stream."""
    with np.errstate(over="ignore"):
        marks = np.flatnonzero(rolling_hash(ids) >> np.uint64(64 - MEAN_BITS) == 0) + 1
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        cuts, at = [], a
        lo, hi = np.searchsorted(marks, (a + MIN_CHUNK, b))
        for mark in marks[lo:hi].tolist():
            while mark - at > MAX_CHUNK:
                at += MAX_CHUNK
                cuts.append(at)
            if mark - at >= MIN_CHUNK:
                cuts.append(mark)
                at = mark
        while b - at > MAX_CHUNK:
            at += MAX_CHUNK
            cuts.append(at)
        if b > at:
            cuts.append(b)
        out.append(cuts)
    return out


def merkle_root(leaves: list[bytes]) -> bytes:
    """Pairwise SHA-256; an odd node moves up; no leaves give the digest of nothing."""
    if not leaves:
        return sha256(b"").digest()
    level = [sha256(b"\0" + x).digest() for x in leaves]
    while len(level) > 1:
        paired = [sha256(b"\1" + a + b).digest() for a, b in zip(level[::2], level[1::2])]
        level = paired + level[len(paired) * 2 :]
    return level[0]


CHUNK = "struct<digest: binary, n: int, payload: binary>"


def chunked(docs: DataFrame, tokenizer_json: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, row, n_tokens, root, chunks of each document; a payload is null where its task has given it before."""
    spec = Path(tokenizer_json).read_text(encoding="utf-8")
    kind = _id_type(spec, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _tokenizer_table(spec)
        given: set[bytes] = set()
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for first, ids, bounds in table.blocks(texts):
                count = len(bounds) - 1
                stream = np.full(len(ids) + count, end_id, np.int64)
                ends = bounds + np.arange(count + 1)
                at = np.ones(len(stream), bool)
                at[ends[1:] - 1] = False
                stream[at] = ids
                yield _chunk_rows(batch, first, stream.astype(kind), ends, given)

    rows = texts_of(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, row long, n_tokens long, root binary, chunks array<{CHUNK}>")


def _chunk_rows(batch, first, stored, ends, given) -> pa.RecordBatch:
    digests, sizes, payloads, offsets, roots = [], [], [], [0], []
    for start, cuts in zip(ends[:-1].tolist(), cut_points(stored, ends)):
        own = []
        for a, b in zip([start, *cuts], cuts):
            raw = bytes([stored.itemsize]) + stored[a:b].tobytes()
            key = sha256(raw).digest()
            own.append(key)
            sizes.append(b - a)
            payloads.append(None if key in given else raw)
            given.add(key)
        digests += own
        offsets.append(len(digests))
        roots.append(merkle_root(own))
    struct = pa.StructArray.from_arrays([pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()), pa.array(payloads, pa.binary())], ["digest", "n", "payload"])
    n = len(roots)
    return pa.RecordBatch.from_arrays(
        [batch.column(0).slice(first, n), batch.column(1).slice(first, n), pa.array(np.diff(ends), pa.int64()), pa.array(roots, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct)],
        ["doc_id", "row", "n_tokens", "root", "chunks"],
    )


def _placed(batches):
    """Running starts inside a partition of the ordered recipes."""
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = np.asarray(batch.column("n_tokens"))
        start = at + np.cumsum(n) - n
        at += int(n.sum())
        names = ["doc_id", "n_tokens", "root", "digests"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(start, pa.int64()), pa.array(np.full(len(n), part), pa.int32())], [*names, "local_start", "part"])


def write_store(docs: DataFrame, tokenizer_json: str | None = None, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write the store of ``docs`` and return its folder.

    Null texts are empty and hold the end id alone; an empty table gives an
    empty store.  Rows that share a doc_id stand next to each other in an
    order fixed at writing.  Other columns are ignored.
    """
    spark = docs.sparkSession
    root = scratch(spark, "token-store")
    staged = f"{root}/staged"
    rows = chunked(docs, tokenizer_json or f"{local_files()}/word_bpe_49k.json", end_id, id_col, text_col)
    rows.write.option("compression", "zstd").parquet(staged)
    rows = spark.read.schema(rows.schema).parquet(staged)
    chunks = rows.select(F.explode("chunks").alias("c")).select("c.*").where("payload is not null").dropDuplicates(["digest"])
    chunks.write.option("compression", "zstd").parquet(f"{root}/chunks")
    recipes = rows.select("doc_id", "row", "n_tokens", "root", F.col("chunks.digest").alias("digests")).repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row")
    recipes.mapInArrow(_placed, "doc_id long, n_tokens long, root binary, digests array<binary>, local_start long, part int").write.option("compression", "zstd").parquet(f"{root}/recipes")
    drop_scratch(spark, staged)
    parts = _parts(spark.read.parquet(f"{root}/recipes"))
    totals = {r["part"]: r["ids"] for r in parts.collect()}  # one row per task of the ordered write
    starts = dict(zip(sorted(totals), accumulate([0, *(totals[p] for p in sorted(totals))])))
    manifest = parts.join(F.broadcast(spark.createDataFrame(list(starts.items()), "part int, first long")), "part")
    manifest.write.parquet(f"{root}/manifest")
    return root


def _parts(recipes: DataFrame) -> DataFrame:
    """Per part its ids, documents and the digest of its documents' roots.

    A part is one file that may be read in pieces, so roots go through an
    order-free sum: the exclusive or of a digest of (position, root).
    """
    leaf = F.sha2(F.concat(F.col("root"), F.encode(F.col("local_start").cast("string"), "utf-8")), 256)
    halves = [F.bit_xor(F.conv(F.substring(leaf, 1 + 15 * k, 15), 16, 10).cast("long")).alias(f"x{k}") for k in range(4)]
    return recipes.groupBy("part").agg(F.sum("n_tokens").alias("ids"), F.count(F.lit(1)).alias("docs"), *halves)


# -- reading ---------------------------------------------------------------

_POLY = 0xEDB88320


def _multiply(a: int, b: int) -> int:
    """Product of two polynomials over GF(2), modulo the CRC-32 polynomial, bits reflected."""
    out = 0
    while b:
        if b & 0x80000000:
            out ^= a
        b = (b << 1) & 0xFFFFFFFF
        a = (a >> 1) ^ (_POLY if a & 1 else 0)
    return out


@lru_cache(maxsize=1 << 16)
def _shift(n_bytes: int) -> int:
    """x to the power of 8 n_bytes."""
    out, square, k = 0x80000000, 0x00800000, n_bytes
    while k:
        if k & 1:
            out = _multiply(out, square)
        square, k = _multiply(square, square), k >> 1
    return out


def crc32_join(first: int, second: int, second_bytes: int) -> int:
    """CRC-32 of two strings one after the other, from theirs and the length of the second."""
    return _multiply(first, _shift(second_bytes)) ^ second


def payload_ids(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if raw[0] == 2 else "<u4", offset=1)


def _chunk_facts(batches):
    """digest, n and CRC-32 (ids as 32-bit) of each stored chunk; a payload that isn't its digest's is an error."""
    for batch in batches:
        digests, crc, n = batch.column(0).to_pylist(), [], []
        for key, raw in zip(digests, batch.column(1).to_pylist()):
            if sha256(raw).digest() != key:
                raise ValueError(f"chunk {key.hex()} is damaged")
            ids = payload_ids(raw)
            n.append(len(ids))
            crc.append(zlib.crc32(ids.astype("<u4")))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], ["digest", "n", "crc"])


def _document_facts(batches):
    for batch in batches:
        parts = batch.column("parts")
        bounds = np.asarray(parts.offsets) - parts.offsets[0].as_py()
        pos, digest, n, crc = parts.flatten().flatten()
        owner = np.repeat(np.arange(len(parts)), np.diff(bounds))
        order = np.lexsort((np.asarray(pos), owner))
        digest, n, crc = digest.take(pa.array(order)).to_pylist(), np.asarray(n)[order].tolist(), np.asarray(crc)[order].tolist()
        crcs = []
        for a, b, root, n_tokens in zip(bounds[:-1].tolist(), bounds[1:].tolist(), batch.column("root").to_pylist(), batch.column("n_tokens").to_pylist()):
            if merkle_root(digest[a:b]) != root or sum(n[a:b]) != n_tokens:
                raise ValueError("a recipe does not fit its Merkle root")
            whole = crc[a]
            for k in range(a + 1, b):
                whole = crc32_join(whole, crc[k], 4 * n[k])
            crcs.append(whole)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def _recipes(spark: SparkSession, root: str) -> DataFrame:
    """Recipes with global starts, after the parts are held against the manifest."""
    recipes, manifest = spark.read.parquet(f"{root}/recipes"), spark.read.parquet(f"{root}/manifest")
    if not _parts(recipes).exceptAll(manifest.drop("first")).isEmpty():
        raise ValueError("recipes do not fit the manifest")
    return recipes.join(F.broadcast(manifest.select("part", "first")), "part").select("doc_id", (F.col("first") + F.col("local_start")).alias("start"), "n_tokens", "root", "digests")


def document_facts(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files.

    Every stored chunk is read and verified once; a document's CRC is joined
    from its chunks' CRCs, so payloads need not be shuffled to documents.
    """
    facts = spark.read.parquet(f"{root}/chunks").select("digest", "payload").mapInArrow(_chunk_facts, "digest binary, n long, crc long")
    parts = _recipes(spark, root).select("doc_id", "start", "n_tokens", "root", F.posexplode("digests").alias("pos", "digest"))
    whole = parts.join(facts, "digest").groupBy("doc_id", "start", "n_tokens", "root").agg(F.collect_list(F.struct("pos", "digest", "n", "crc")).alias("parts"))
    return whole.mapInArrow(_document_facts, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(spark: SparkSession, root: str) -> DataFrame:
    """doc_id, start, ids of each document, put together from its recipe."""

    def run(batches):
        for batch in batches:
            rows = []
            for parts, tree in zip(batch.column("parts").to_pylist(), batch.column("root").to_pylist()):
                parts.sort(key=lambda p: p["pos"])
                if any(sha256(p["payload"]).digest() != p["digest"] for p in parts) or merkle_root([p["digest"] for p in parts]) != tree:
                    raise ValueError("a document does not fit its Merkle root")
                rows.append(np.concatenate([payload_ids(p["payload"]) for p in parts]).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(rows, pa.list_(pa.int64()))], ["doc_id", "start", "ids"])

    chunks = spark.read.parquet(f"{root}/chunks").select("digest", "payload")
    parts = _recipes(spark, root).select("doc_id", "start", "root", F.posexplode("digests").alias("pos", "digest"))
    whole = parts.join(chunks, "digest").groupBy("doc_id", "start", "root").agg(F.collect_list(F.struct("pos", "digest", "payload")).alias("parts"))
    return whole.mapInArrow(run, "doc_id long, start long, ids array<long>")


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return document_facts(spark, write_store(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1))
