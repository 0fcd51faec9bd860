"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers, names and units of measure turn into typed
slots, and a run of tokens of one kind (``Mary Ann``, ``1 1/2``) is one slot of
any length.  The windows of all benchmark items' templates form a table, and
the windows of all documents are joined with it on their hash.  Hits on the
same diagonal (item, offset between document and item) are put together into
stretches.  Slots are then compared: in a stretch each benchmark value must
always stand for the same document value.  Stretches of an item that follow one
another in item and document, with an offset that moves by at most ``MAX_DRIFT``
tokens from one to the next (words put in or left out), and that agree on the
slots, are chained.  An item is found when a chain covers enough of its tokens,
so a question with other numbers and names is caught as well as a copy.  It is also
found when one passage of a fixed number of its tokens occurs with no change but
in slots, so that pieces of long items are caught; changed slots do not count.

A capital letter at the start of a sentence may begin a name or not.  Each text
is therefore read twice, with such words as plain words and as names.  Windows
with few plain words say too little as templates; they are looked up with their
literal values, so that copies of items made of numbers or names are found.

What many items share says little about any of them: cover counts the tokens of
windows of at most ``COMMON`` items, so a preamble or a list of choices alone finds
nothing.  The windows that more items share are not left out, though: items with
the very same ones at the same places are a family, which one row a window stands
for, however many members it has.  Where a document has so much of a family's
windows that less than one window of a member's tokens is missing, and no more
than a fifth, that member is found; a member without windows of its own is found
from the ordinary cover on.  Where a document has some of an item's own windows, its common ones are
looked up as well, and the item is found if all its windows together have that much of it:
the pairs come from the own windows, so their number does not grow with the size of families.
Items with the same tokens are one item in the table,
and results name all of them.  Items with the same template are one class, which
the smallest id stands for; the others are looked up by their literal passages.

The join is preceded by a filter: a bitmap of the window hashes, of a size with
a fixed bound, leaves only windows of documents that are probably in the table.
The table is broadcast where its counted rows fit the bound; otherwise both
sides are shuffled on the hash.  Documents are read once and never shuffled;
hits are, on (document, item).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netloom.llm.common import Bitmap, bounded_broadcast, discard, fresh, materialize, texts_of, worker_cache

WINDOW, MIN_COVER, MIN_PLAIN = 8, 0.5, 3
#: Tokens by which the offset between document and item may move from one stretch to the next.
MAX_DRIFT = 8
#: Tokens of an item in one piece, plain words or unchanged values, that are a leak whatever share of the item they are.
MIN_PASSAGE = 13
#: Windows of more items than this are common to them and do not tell them apart; their items are found as families.
COMMON = 16
#: Share of a member's tokens that must occur where only windows of its family do.
MIN_FAMILY = 0.8

#: Words that are units of measure, money or time.
UNITS = frozenset("""
mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons ounce ounces pound pounds
ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years
dollar dollars cent cents euro euros percent degree degrees watt watts volt volts joule joules newton newtons mph kmh
""".split())

TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[.!?:\n]")
PLAIN, NUMBER, NAME, UNIT, STOP = range(5)
#: Beside readings 0 and 1: the tokens as they stand, in windows and in passages.
LITERAL, PASSAGE = 2, 3
#: By what an item is found: its own windows or its family's alone, or all; or that it may yet be by all.
OWN, WHOLE, OPEN = range(3)
#: In place of an item: windows that are common, once each.
SEEN = -(1 << 62)
#: What stands for a slot in a template, by kind.
_SLOT = np.array([0, 0x1111111111111110, 0x2222222222222220, 0x3333333333333330, 0], np.uint64)


class _Words(dict):
    """Hash of the lower-cased token with its kind in the low three bits, remembered."""

    def __missing__(self, token: str) -> int:
        first, low = token[0], token.lower()
        if first.isdigit():
            kind = NUMBER
        elif first in ".!?:\n":
            kind = STOP
        elif low in UNITS:
            kind = UNIT
        else:
            kind = NAME if first.isupper() and not token[1:].isupper() else PLAIN
        value = self[token] = xxhash.xxh64_intdigest(low) & ~7 | kind
        return value


@dataclass
class Reading:
    """One reading of a text: template hashes, slot marks and values of its template tokens, and where each begins in the text's tokens (one more for the end)."""

    template: np.ndarray
    slot: np.ndarray
    value: np.ndarray
    start: np.ndarray


@dataclass
class Template:
    """Value hashes of the tokens of a text, and its two readings."""

    value: np.ndarray
    readings: list[Reading]


class Templater:
    def __init__(self, window: int = WINDOW, widest: int = MIN_PASSAGE):
        self.window, self.known, self.powers = window, _Words(), np.ones(1, np.uint64)
        self.weights = np.random.default_rng(11).integers(1, 1 << 63, max(window, widest), dtype=np.uint64) | np.uint64(1)

    def read(self, text: str | None) -> Template:
        if len(self.known) > 500_000:
            self.known.clear()
        tokens = TOKEN.findall(text or "")
        value = np.fromiter(map(self.known.__getitem__, tokens), np.uint64, len(tokens))
        kind = (value & np.uint64(7)).astype(np.int8)
        value &= ~np.uint64(7)
        starts = np.concatenate([[True], kind[:-1] == STOP])[: len(kind)]
        keep = kind != STOP
        value, kind, starts = value[keep], kind[keep], starts[keep]
        opens = starts & (kind == NAME)
        return Template(value, [self.reading(value, np.where(opens, PLAIN, kind), starts), self.reading(value, kind, starts)])

    def reading(self, value: np.ndarray, kind: np.ndarray, starts: np.ndarray) -> Reading:
        """Runs of slots of one kind within a sentence become one slot, whose value is that of all its tokens in order."""
        n = len(kind)
        slot = kind != PLAIN
        head = np.ones(n, bool)
        head[1:] = ~(slot[1:] & (kind[1:] == kind[:-1]) & ~starts[1:])
        if head.all():
            return Reading(np.where(slot, _SLOT[kind], value), slot, value, np.arange(n + 1))
        at = np.flatnonzero(head)
        inside = np.arange(n) - at[np.cumsum(head) - 1]
        longest = int(inside.max()) + 1
        if longest > len(self.powers):
            self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * longest, 0x9E3779B97F4A7C15, np.uint64)]))
        value = np.add.reduceat(value * self.powers[inside], at)
        kind, slot = kind[at], slot[at]
        return Reading(np.where(slot, _SLOT[kind], value), slot, value, np.append(at, n))

    def windows(self, template: np.ndarray, width: int) -> np.ndarray:
        count = max(0, len(template) - width + 1)
        h = np.full(count, width, np.uint64)
        for k in range(width):
            h += template[k : k + count] * self.weights[k]
        h ^= h >> np.uint64(29)
        return h * np.uint64(0x9E3779B97F4A7C15)


# -- windows -----------------------------------------------------------------

ITEM_WINDOWS = "reading int, width int, hash long, item long, item_id long, cls binary, same binary, length int, item_pos int, spans array<int>, item_slots array<long>, slot_spans array<int>"
DOC_WINDOWS = "row long, doc_id long, d0 long, d1 long, reading int, width int, hash long, pos int, start int, stop int, slots array<long>"


def _pattern(reading: Reading) -> bytes:
    """The template, and which of its slots hold the same value."""
    _, same = np.unique(reading.value[reading.slot], return_inverse=True)
    firsts: dict[int, int] = {}
    return reading.template.tobytes() + np.array([firsts.setdefault(x, k) for k, x in enumerate(same.tolist())], np.int64).tobytes()


def item_windows(templater: Templater, item: int, item_id: int, text: str | None, min_plain: int, min_passage: int) -> list[tuple]:
    """Rows of ``ITEM_WINDOWS``: each distinct window of an item once, with the tokens of all places where it stands."""
    t = templater.read(text)
    length = len(t.value)
    if not length:
        return []
    cls = xxhash.xxh3_128_digest(b"|".join(map(_pattern, t.readings)))
    same = xxhash.xxh3_128_digest(t.value.tobytes())
    out = []

    def add(reading: int, width: int, hashes: np.ndarray, at: np.ndarray, start: np.ndarray, r: Reading | None) -> None:
        places: dict[int, list[int]] = {}
        for k, h in zip(at.tolist(), hashes[at].view(np.int64).tolist()):
            places.setdefault(h, []).append(k)
        for h, own in places.items():
            spans = [int(x) for k in own for x in (start[k], start[k + width])]
            spots = own[0] + np.flatnonzero(r.slot[own[0] : own[0] + width]) if r else np.zeros(0, np.int64)
            slots = r.value[spots].view(np.int64).tolist() if r else []
            out.append((reading, width, h, item, item_id, cls, same, length, own[0], spans, slots, [int(x) for k in spots for x in (start[k], start[k + 1])]))

    few = np.zeros(max(0, length - min(templater.window, length)) + 1, bool)
    for number, r in enumerate(t.readings):
        width = min(templater.window, len(r.value))
        plain = np.concatenate([[0], np.cumsum(~r.slot)])
        add(number, width, templater.windows(r.template, width), np.flatnonzero(plain[width:] - plain[:-width] >= min(min_plain, width)), r.start, r)
        by_token = np.concatenate([[0], np.cumsum(~np.repeat(r.slot, np.diff(r.start)))])
        wide = min(templater.window, length)
        few |= by_token[wide:] - by_token[:-wide] < min_plain
    # Windows with too few plain words in one of the readings are looked up as they stand, and so are whole passages.
    tokens = np.arange(length + 1)
    wide = min(templater.window, length)
    add(LITERAL, wide, templater.windows(t.value, wide), np.flatnonzero(few), tokens, None)
    if min_passage > wide:
        wide = min(min_passage, length)
        add(PASSAGE, wide, templater.windows(t.value, wide), np.arange(length - wide + 1), tokens, None)
    return out


@dataclass
class Table:
    """What documents are joined with (``rows``), and whom its items stand for (``members``).

    ``rows`` has for each item or family (a negative ``item``) its windows, the
    tokens they cover (``total``), and how many must be found (``need``).
    ``members`` has per item and member: item_id, ``least`` tokens for that member,
    and the tokens (``base``) that its cover is a share of; ``by`` tells the windows it was found by.
    ``mixed`` has the common windows of items that all their windows together may tell,
    ``total`` and ``need`` being of all; None if there are none.  ``rows`` then has each of these windows
    once (item ``SEEN``), and for the item's own windows the tokens (``hint``) without which the common ones never do.
    """

    rows: DataFrame
    members: DataFrame
    mixed: DataFrame | None


def benchmark_windows(benchmark: DataFrame, window: int, min_cover: float, min_plain: int, min_passage: int, common: int, item_col: str, text_col: str) -> Table:
    """The table that documents are joined with; it is written, as it is counted, filtered and joined."""

    def run(batches):
        templater = worker_cache(("templater", window, min_passage), lambda: Templater(window, min_passage))
        for batch in batches:
            rows = [w for i, item_id, text in zip(*(c.to_pylist() for c in batch.columns)) for w in item_windows(templater, i, item_id, text, min_plain, min_passage)]
            yield _record(rows, _ITEM_KINDS)

    items = benchmark.select(F.monotonically_increasing_id().alias("item"), F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    every = materialize(texts_of(items).mapInArrow(run, ITEM_WINDOWS), "benchmark-windows")
    # Items with the same tokens are one, which the first of them stands for.
    least = F.min(F.struct(F.col("item_id").isNull().alias("none"), "item_id", "item"))
    heads = every.select("item", "item_id", "cls", "same").distinct()
    texts = heads.groupBy("cls", "same").agg(least.getField("item").alias("stand"))
    named = materialize(heads.join(texts, ["cls", "same"]).select("stand", "item", "item_id"), "benchmark-items")
    rows = every.join(named.where("item = stand").select("item"), "item", "left_semi")
    first = rows.groupBy("cls").agg(least.getField("item").alias("stands"))
    # Of a class the first item has templates, the others have literal passages.
    rows = rows.join(first, "cls").drop("cls", "same").where(F.when(F.col("item") == F.col("stands"), F.col("reading") != PASSAGE).otherwise(F.col("reading") >= LITERAL)).drop("stands")
    held = rows.groupBy("reading", "width", "hash").agg((F.count(F.lit(1)) <= common).alias("own"))  # an item has a window once
    rows = materialize(rows.join(held, ["reading", "width", "hash"]), "benchmark-windows")
    own = rows.where("own").drop("own")
    single = own.join(_tokens(own), "item").withColumn("need", F.ceil(F.col("total") * min_cover).cast("int")).withColumn("hint", F.lit(None).cast("int"))
    # Families: items with the same common windows at the same places.
    shared = rows.where(f"not own and reading <> {PASSAGE}").drop("own")
    spot = F.sort_array(F.collect_list(F.struct("reading", "width", "hash", "item_pos", "spans", "item_slots")))
    sets = shared.groupBy("item").agg(F.sha2(F.to_json(F.struct(spot.alias("w"))), 256).alias("set"), F.max("length").alias("length"))
    ends = sets.groupBy("set").agg(F.min("item").alias("head"), F.max("length").alias("longest"))
    alone = own.select("item").distinct().withColumn("has_own", F.lit(True))
    sets = sets.join(ends, "set").join(_tokens(shared), "item").join(alone, "item", "left")
    whole = F.greatest(F.ceil(F.col("length") * MIN_FAMILY), F.col("length") - (window - 1))
    sets = sets.withColumn("least", F.when(F.col("has_own"), whole).otherwise(F.ceil(F.col("total") * min_cover)).cast("int"))
    # Items with windows of both kinds, where the common ones do not say enough by themselves to be a family's.
    both = _tokens(rows.where(f"own or reading <> {PASSAGE}")).withColumnRenamed("total", "every")
    mixed = sets.where("has_own").join(both, "item").where("least <= every").select("item", "every", F.col("least").alias("whole"), F.greatest(F.lit(1), F.col("least") - F.col("total")).alias("hinted"))
    mixed = materialize(mixed, "benchmark-mixed")
    some = not mixed.isEmpty()
    if some:
        single = single.join(mixed.select("item", "hinted"), "item", "left").withColumn("hint", F.col("hinted")).select(*single.columns)
    sets = materialize(sets.where("least <= total"), "benchmark-families")
    heads = sets.groupBy("head").agg(F.min("least").alias("need"), F.max("total").alias("total"), F.max("longest").alias("longest"))
    family = shared.join(heads, shared.item == heads["head"]).withColumn("length", F.col("longest")).withColumns({"item": -F.col("item") - 1, "hint": F.lit(None).cast("int")}).select(*single.columns)
    told_by = single.unionByName(family)
    common_of = None
    if some:
        common_of = materialize(shared.join(mixed.select("item", F.col("every").alias("total"), F.col("whole").alias("need")), "item"), "benchmark-common")
        seen = common_of.select("reading", "width", "hash").distinct().withColumn("item", F.lit(SEEN))
        told_by = told_by.unionByName(seen, allowMissingColumns=True)
    table = materialize(told_by, "benchmark-table")
    bases = single.groupBy("item").agg(F.lit(0).alias("least"), F.max("total").alias("base")).withColumn("by", F.lit(OWN))
    if some:
        bases = bases.unionByName(mixed.join(single.select("item", "length").distinct(), "item").select("item", F.lit(0).alias("least"), F.col("length").alias("base"), F.lit(WHOLE).alias("by")))
    told = bases.join(named, bases.item == named.stand).select(bases["item"], named["item"].alias("member"), "item_id", "least", "base", "by")
    base = F.when(F.col("has_own"), F.col("length")).otherwise(F.col("total"))
    kin = sets.select((-F.col("head") - 1).alias("item"), F.col("item").alias("of"), "least", base.alias("base")).join(named.withColumnRenamed("item", "member"), F.col("of") == F.col("stand")).select("item", "member", "item_id", "least", "base", F.lit(OWN).alias("by"))
    members = materialize(told.unionByName(kin), "benchmark-members")
    discard(every, rows, named, sets, mixed)
    return Table(table, members, common_of)


def _tokens(rows: DataFrame) -> DataFrame:
    """item, total: how many tokens of each item its windows cover."""
    spans = rows.select("item", F.explode(F.expr("transform(sequence(0, size(spans) - 2, 2), k -> struct(spans[k] AS a, spans[k + 1] AS b))")).alias("s"))
    return spans.select("item", F.explode(F.sequence(F.col("s.a"), F.col("s.b") - 1)).alias("token")).groupBy("item").agg(F.count_distinct("token").cast("int").alias("total"))


def document_windows(templater: Templater, text: str | None, kinds: list[tuple[int, int]], known: Bitmap) -> list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(reading, width, hashes, positions, first and last tokens, slot values, number of them) of the windows that pass the filter."""
    doc, out = templater.read(text), []
    tokens = np.arange(len(doc.value) + 1)
    for reading, width in kinds:
        r = doc.readings[reading] if reading < LITERAL else None
        h = templater.windows(r.template if r else doc.value, width)
        at = known.holds(h)
        if not len(at):
            continue
        start = r.start if r else tokens
        slots, count = np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
        if r:
            before = np.concatenate([[0], np.cumsum(r.slot)])
            count = before[at + width] - before[at]
            slots = r.value[r.slot][np.arange(count.sum()) + np.repeat(before[at] - (np.cumsum(count) - count), count)]
        out.append((reading, width, h[at], at, start[at], start[at + width], slots, count))
    return out


def _hits(docs: DataFrame, table: DataFrame, window: int, min_passage: int, id_col: str | None, text_col: str) -> DataFrame:
    """The join of the documents' windows with the table."""
    kinds = [tuple(r) for r in table.select("reading", "width").distinct().orderBy("reading", "width").collect()]  # a few tens
    known = Bitmap(table, "hash")

    def run(batches):
        templater = worker_cache(("templater", window, min_passage), lambda: Templater(window, min_passage))
        for batch in batches:
            owner, parts = [], []
            for k, text in enumerate(batch.column(4).to_pylist()):
                for part in document_windows(templater, text, kinds, known):
                    owner.append(np.full(len(part[3]), k))
                    parts.append(part)
            whose = pa.array(np.concatenate(owner) if owner else np.zeros(0, np.int64))
            each = lambda k, kind: np.concatenate([np.zeros(0, kind), *(np.asarray(p[k]).astype(kind) for p in parts)])
            kind = lambda k: np.repeat(np.array([p[k] for p in parts], np.int32), np.array([len(p[3]) for p in parts], np.int64))
            flat = np.concatenate([np.zeros(0, np.uint64), *(p[2] for p in parts)]).view(np.int64)
            slots = np.concatenate([np.zeros(0, np.uint64), *(p[6] for p in parts)]).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(each(7, np.int64))]), pa.int32()), pa.array(slots))
            columns = [batch.column(k).take(whose) for k in range(4)]
            columns += [pa.array(kind(0)), pa.array(kind(1)), pa.array(flat), *(pa.array(each(k, np.int32)) for k in (3, 4, 5)), lists]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in DOC_WINDOWS.split(", ")])

    own = F.col(id_col) if id_col else F.lit(None)
    rows = texts_of(docs).select(F.monotonically_increasing_id().alias("row"), own.cast("long").alias("doc_id"), *_digest(text_col), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, DOC_WINDOWS).join(bounded_broadcast(table, 400), ["reading", "width", "hash"])


def _digest(text_col: str) -> list:
    """Two columns that name a text."""
    return [F.xxhash64(text_col).alias("d0"), F.xxhash64(F.lit(1), text_col).alias("d1")]


# -- stretches and chains ----------------------------------------------------


@dataclass
class Hit:
    """A window of the document at template token ``pos`` that is the item's at ``item_pos``."""

    reading: int
    width: int
    pos: int
    start: int
    stop: int
    slots: list[int]
    item_pos: int
    spans: list[int]
    item_slots: list[int]
    slot_spans: list[int]


class Stretch:
    """Item tokens ``start`` to ``end`` found at document tokens ``doc_start`` to ``doc_end``, and what slot values stand for each other."""

    def __init__(self, hit: Hit):
        self.place = hit.reading, hit.pos - hit.item_pos
        self.start, self.doc_start, self.mask = hit.spans[0], hit.start, 0
        self.means: dict[int, int] = {}
        self.back: dict[int, int] = {}
        self.changed: dict[int, int] = {}  # item tokens of slots with another value: where such a slot starts, and ends
        self.sound = self.take(hit)

    def take(self, hit: Hit) -> bool:
        """Put a window in unless a value would stand for two."""
        means, back = dict(zip(hit.item_slots, hit.slots)), dict(zip(hit.slots, hit.item_slots))
        for x, y in zip(hit.item_slots, hit.slots):
            if not means[x] == y == self.means.get(x, y) or not back[y] == x == self.back.get(y, x):
                return False
        self.means |= means
        self.back |= back
        spots = iter(hit.slot_spans)
        self.changed |= {a: b for x, y, a, b in zip(hit.item_slots, hit.slots, spots, spots) if x != y}
        self.end, self.doc_end, self.template_end = hit.spans[1], hit.stop, hit.item_pos + hit.width
        spans = iter(hit.spans)
        for a, b in zip(spans, spans):
            self.mask |= ((1 << (b - a)) - 1) << a
        return True

    def same(self, start: int) -> int:
        """Item tokens from ``start`` on that stand in the document as they are."""
        return self.end - start - sum(max(0, b - max(a, start)) for a, b in self.changed.items())


def stretches(hits: list[Hit]) -> Iterator[Stretch]:
    """Overlapping or adjoining windows of one diagonal, cut where a value would stand for two."""
    held = None
    for hit in sorted(hits, key=lambda h: (h.reading, h.pos - h.item_pos, h.item_pos)):
        if held and held.place == (hit.reading, hit.pos - hit.item_pos) and hit.item_pos <= held.template_end and held.take(hit):
            continue
        fresh_one = Stretch(hit)
        if fresh_one.sound:
            if held:
                yield held
            held = fresh_one
    if held:
        yield held


@dataclass
class Chain:
    """Stretches in order up to ``last``: item tokens covered (as bits), unchanged tokens of the passage that ``last`` ends and of the longest, offset of the first, slot values of all."""

    last: Stretch
    mask: int
    passage: int
    longest: int
    shift: int
    means: dict[int, int]
    back: dict[int, int]


def chains(parts: list[Stretch], length: int, total: int) -> Iterator[Chain]:
    """For each stretch of one item the chain of most cover that ends in it, in order of the document."""
    near: list[Chain] = []
    for s in sorted(parts, key=lambda s: (s.doc_start, s.start, s.end)):
        near = [c for c in near if c.last.doc_end + length + MAX_DRIFT >= s.doc_start]
        same = s.same(s.start)
        best, cover = Chain(s, s.mask, same, same, s.doc_start - s.start, s.means, s.back), s.mask.bit_count()
        for c in near:
            t = c.last
            if not (t.start < s.start and t.end < s.end and t.doc_start < s.doc_start and t.doc_end < s.doc_end):
                continue
            drift = (s.doc_start - t.doc_end) - (s.start - t.end)
            if abs(drift) > MAX_DRIFT or (c.mask | s.mask).bit_count() <= cover:
                continue
            if all(c.means.get(x, y) == y for x, y in s.means.items()) and all(c.back.get(y, x) == x for y, x in s.back.items()):
                passage = c.passage + s.same(max(s.start, t.end)) if drift == 0 and s.start <= t.end else same
                best = Chain(s, c.mask | s.mask, passage, max(c.longest, passage), c.shift, c.means | s.means, c.back | s.back)
                cover = best.mask.bit_count()
        near.append(best)
        yield best
        if cover == total:
            return  # later ones cover no more


def judge(hits: list[Hit], length: int, total: int, min_cover: float, min_passage: int) -> tuple[float, int, int] | None:
    """(cover, token position, changed slots) of an item in a document, None if it isn't there."""
    best = None
    for c in chains(list(stretches(hits)), length, total):
        cover = c.mask.bit_count() / total
        if (cover >= min_cover or c.longest >= min_passage) and (best is None or (-cover, c.shift) < best[:2]):
            best = (-cover, c.shift, sum(x != y for x, y in c.means.items()))
    return (-best[0], *best[1:]) if best else None


# -- the operator --------------------------------------------------------------

FOUND = "row long, doc_id long, d0 long, d1 long, item long, by int, covered long, position long, changed_slots long"
_ITEM_KINDS = [(x.split()[0], {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}[x.split()[1]]) for x in ITEM_WINDOWS.split(", ")]
_FOUND_KINDS = [(x.split()[0], pa.int32() if x.endswith(" int") else pa.int64()) for x in FOUND.split(", ")]
_PAIR = ["row", "doc_id", "d0", "d1", "item", "length", "total", "need", "hint"]
_HIT = ["reading", "width", "pos", "start", "stop", "slots", "item_pos", "spans", "item_slots", "slot_spans"]


def _record(rows: list[tuple], kinds: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(kinds)], [name for name, _ in kinds])


def found_items(docs: DataFrame, benchmark: DataFrame, min_cover: float, window: int, min_plain: int, min_passage: int, common: int, id_col: str | None, item_col: str, text_col: str, bench_text: str) -> tuple[DataFrame, DataFrame]:
    """Rows of ``FOUND``: ``row`` numbers the documents of this run, d0 and d1 name the text; and the members of items."""
    table = benchmark_windows(benchmark, window, min_cover, min_plain, min_passage, common, item_col, bench_text)
    hits = _hits(docs, table.rows, window, min_passage, id_col, text_col).select(*_PAIR, *_HIT, "hash")
    if table.mixed is None:
        return _judged(hits, OWN, min_passage), table.members
    hits = materialize(hits, "hits")
    first = materialize(_judged(hits.where(F.col("item") != SEEN), OWN, min_passage), "found")
    # Of an open pair, ``covered`` and ``position`` are the document tokens between which its own windows lie.
    pairs = first.where(F.col("by") == OPEN).select("row", "doc_id", "d0", "d1", "item", F.col("covered").alias("low"), F.col("position").alias("high"))
    seen = hits.where(F.col("item") == SEEN).select("row", "reading", "width", "hash", "pos", "start", "stop", "slots")
    wide = F.col("length") * (1 + MAX_DRIFT)  # a chain is no longer
    near = (F.col("stop") >= F.col("low") - wide) & (F.col("start") <= F.col("high") + wide)
    theirs = pairs.join(table.mixed, "item").join(seen, ["row", "reading", "width", "hash"]).where(near)
    own = hits.drop("total", "need", "hint").join(pairs.select("row", "item"), ["row", "item"]).join(table.mixed.select("item", "total", "need").distinct(), "item")
    parts = [x.withColumn("hint", F.lit(None).cast("int")).select(*_PAIR, *_HIT) for x in (own, theirs)]
    return first.where(F.col("by") != OPEN).unionByName(_judged(parts[0].unionByName(parts[1]), WHOLE, min_passage)), table.members


def _judged(hits: DataFrame, by: int, min_passage: int) -> DataFrame:
    """Rows of ``FOUND`` for the pairs of ``hits`` in which the item is there; those that all windows may yet tell are ``OPEN``."""

    def run(batches):
        at, hits = None, []

        def done():
            if not at:
                return []
            *key, length, total, need, hint = at
            # What a family has in one piece may be a preamble, so a passage counts for items alone.
            found = judge(hits, length, total, need / total, min_passage if key[4] >= 0 and by == OWN else 1 << 30)
            if found:
                return [(*key, by, round(found[0] * total), *found[1:])]
            if hint is None or len({t for h in hits for k in range(0, len(h.spans), 2) for t in range(h.spans[k], h.spans[k + 1])}) < hint:
                return []
            return [(*key, OPEN, min(h.start for h in hits), max(h.stop for h in hits), 0)]

        for batch in batches:
            out = []
            for key, *hit in zip(zip(*(batch.column(c).to_pylist() for c in _PAIR)), *(batch.column(c).to_pylist() for c in _HIT)):
                if key != at:
                    out += done()
                    at, hits = key, []
                hits.append(Hit(*hit))
            yield _record(out, _FOUND_KINDS)
        yield _record(done(), _FOUND_KINDS)

    return hits.select(*_PAIR, *_HIT).repartition("row", "item").sortWithinPartitions("row", "item").mapInArrow(run, FOUND)


def contaminated(docs: DataFrame, benchmark: DataFrame, min_cover: float = MIN_COVER, window: int = WINDOW, min_plain: int = MIN_PLAIN, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text", min_passage: int = MIN_PASSAGE, common: int = COMMON) -> DataFrame:
    """One row per (document, benchmark item) found: doc_id, item_id, cover, position, changed_slots.

    ``cover`` is the share of the item's tokens in a chain of consistent windows,
    ``position`` the document token where the item would begin,
    ``changed_slots`` how many of its values differ.  Of equally good places the
    first counts.  Tokens that stand only in windows of more than ``common`` items
    count neither way; an item of which nearly all is there (see the module) is found through them, alone or with its own, and
    ``cover`` is then the share of all its tokens.  An item counts as found from ``min_cover`` or from
    ``min_passage`` unchanged tokens in one piece.  Items shorter than a window must occur whole; a window with
    fewer than ``min_plain`` plain words (or not all, if shorter) must occur with
    its literal values.  A window that an item repeats counts for all its places.
    Of items with the same template, in which the same slots hold equal values,
    a document with other values is reported for the smallest item_id only; items
    with the same tokens are all reported.
    Null and empty texts match nothing; repeated documents repeat their rows;
    empty tables give no rows; other columns are ignored.
    """
    found, members = found_items(docs, benchmark, min_cover, window, min_plain, min_passage, common, id_col, item_col, text_col, text_col)
    each = found.join(bounded_broadcast(members, 40), ["item", "by"]).where("covered >= least")
    facts = F.struct((F.col("covered") / F.col("base")).alias("cover"), "position", "changed_slots")
    best = each.groupBy("row", "doc_id", "member", "item_id").agg(F.max_by(facts, F.struct((F.col("item") >= 0) & (F.col("by") == OWN), "covered")).alias("best"))
    return best.select("doc_id", "item_id", "best.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, min_cover: float = MIN_COVER, window: int = WINDOW, min_plain: int = MIN_PLAIN, item_col: str = "item_id", text_col: str = "text", bench_text: str = "text", min_passage: int = MIN_PASSAGE, common: int = COMMON) -> DataFrame:
    """The rows of ``docs`` in which :func:`contaminated` finds no item, with all their columns."""
    found, _ = found_items(docs, benchmark, min_cover, window, min_plain, min_passage, common, None, item_col, text_col, bench_text)
    names = [fresh(n, docs) for n in ("d0", "d1")]
    gone = materialize(found.select(F.col("d0").alias(names[0]), F.col("d1").alias(names[1])).distinct(), "contaminated")
    d0, d1 = _digest(text_col)
    return docs.join(bounded_broadcast(gone, 48), (d0 == gone[names[0]]) & (d1 == gone[names[1]]), "left_anti")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
