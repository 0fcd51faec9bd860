"""Toxicity by a chain of linear classifiers.

Categories stand in a fixed order.  Each has a logistic model over hashed word
and word-stem features that also reads the probabilities of all categories
before it.  For training, those probabilities are out-of-fold predictions, so
a later model sees its predecessors make the errors they make on new text.

Labelled rows give the last category, ``toxic``.  The categories before it are
groups of toxic rows, found in the sample itself: the features that speak most
for ``toxic`` are clustered by the rows that hold them, and a toxic row belongs
to the group whose features it holds most of.  No word list is built in.

Models are fitted on a bounded sample of labelled rows on the driver (see
``Sample``); every document is then scored whole.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netloom.llm.common import texts_of, worker_cache

WORDS = re.compile(r"\w+")
#: Letters of the word stems that are features beside whole words; the labelled sample chooses among them.
STEMS = tuple(range(3, 10))
BUCKETS = 1 << 24

#: Names of the categories that come before the last, for groups of toxic rows from the largest to the smallest.
GROUPS = ("insult", "contempt")


@dataclass(frozen=True)
class Sample:
    """The bound on training: most toxic and most other labelled rows, by smallest hash of the id."""

    toxic: int = 3000
    other: int = 6000
    features: int = 8192
    folds: int = 5


def _hash(feature: str) -> int:
    return xxhash.xxh32_intdigest(feature) % BUCKETS


class _Features(dict):
    """Feature numbers of a word: itself and its stems."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        value = self[word] = (_hash("=" + word), *(_hash(f"{k}{word[:k]}") for k in STEMS if len(word) >= k))
        return value


def features(text: str | None, known: dict) -> list[int]:
    """Distinct feature numbers of the whole text."""
    if len(known) > 400_000:
        known.clear()
    return list({f for w in set(WORDS.findall((text or "").lower())) for f in known[w]})


@dataclass
class Linear:
    weight: np.ndarray
    bias: float

    def predict(self, rows: np.ndarray, columns: np.ndarray, n: int, extra: np.ndarray) -> np.ndarray:
        k = len(self.weight) - extra.shape[1]
        z = np.bincount(rows, self.weight[columns], n) + self.bias + extra @ self.weight[k:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(rows, columns, width, extra, label, steps: int = 120, ridge: float = 2.0) -> Linear:
    """Logistic regression on binary features (row, column pairs) and dense ``extra`` columns, classes weighted alike; the ridge is shared by the rows."""
    n, k = len(label), width + extra.shape[1]
    weight, bias = np.zeros(k), 0.0
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    positive = label.sum()
    if positive in (0, n):
        return Linear(weight, 30.0 if positive else -30.0)
    share = np.where(label > 0, 0.5 / positive, 0.5 / (n - positive))
    for t in range(1, steps + 1):
        p = Linear(weight, bias).predict(rows, columns, n, extra)
        d = share * (p - label)
        g = np.concatenate([np.bincount(columns, d[rows], width), d @ extra, [d.sum()]])
        g[:-1] += ridge / n * weight
        m = 0.9 * m + 0.1 * g
        v = 0.99 * v + 0.01 * g * g
        step = 0.25 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        weight -= step[:-1]
        bias -= step[-1]
    return Linear(weight, bias)


@dataclass
class Chain:
    """Fitted models in order, the feature numbers they read, and the limit on the last probability."""

    names: list[str]
    models: list[Linear]
    column: dict[int, int]
    limit: float
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def score(self, found: list[list[int]]) -> np.ndarray:
        """Probabilities, one row a document, one column a category, from the feature numbers of documents."""
        n = len(found)
        pairs = [(r, c) for r, f in enumerate(found) for x in f if (c := self.column.get(x)) is not None]
        rows, columns = np.array(pairs, np.int64).reshape(-1, 2).T
        out = np.zeros((n, 0))
        for model in self.models:
            out = np.column_stack([out, model.predict(rows, columns, n, out)])
        return out


#: Features of fewer documents of the sample are not used.
RARE = 5


def _standing_out(flat: np.ndarray, owner: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers, the place of each entry of ``flat`` among them, and how far their rate of ``y`` is from the base rate, in standard deviations; rare ones are left out (0).

    Numbers are below ``BUCKETS``, so tables of that size take the place of sorting, which needs more memory.
    """
    seen = np.zeros(BUCKETS, np.int32)
    np.add.at(seen, flat, 1)
    numbers = np.flatnonzero(seen)
    count = seen[numbers].astype(float)
    seen[numbers] = np.arange(len(numbers))
    inverse = seen[flat]
    hits = np.zeros(len(numbers))
    np.add.at(hits, inverse[y[owner] > 0], 1)
    base = y.mean() if len(y) else 0.0
    score = (hits - count * base) / np.sqrt(count * max(base * (1 - base), 1e-9) + 1e-9)
    score[count < RARE] = 0
    return numbers, inverse, score


def toxic_groups(flat: np.ndarray, owner: np.ndarray, toxic: np.ndarray, names: tuple[str, ...] = GROUPS, strong: int = 256, rounds: int = 20) -> dict[str, np.ndarray]:
    """0/1 arrays of the groups of toxic rows, the largest group first.

    The ``strong`` features that stand out most for toxic rows are unit vectors
    over the toxic rows that hold them; they are clustered by cosine, from
    starts that lie far apart.  A row without such a feature has no group.
    """
    n, k = len(toxic), len(names)
    out = {name: np.zeros(n) for name in names}
    numbers, inverse, score = _standing_out(flat, owner, toxic)
    chosen = np.argsort(-score, kind="stable")[:strong]
    chosen = chosen[score[chosen] > 3]
    if len(chosen) < k:
        return out
    place = np.full(len(numbers), -1)
    place[chosen] = np.arange(len(chosen))
    use = (place[inverse] >= 0) & (toxic[owner] > 0)
    held = np.zeros((len(chosen), n), np.float32)
    held[place[inverse[use]], owner[use]] = 1
    unit = held / np.maximum(np.linalg.norm(held, axis=1, keepdims=True), 1e-9)
    centres = [unit[0]]
    while len(centres) < k:
        centres.append(unit[np.argmin(np.max(unit @ np.array(centres).T, axis=1))])
    for _ in range(rounds):
        group = np.argmax(unit @ np.array(centres).T, axis=1)
        centres = [c / np.linalg.norm(c) if (c := unit[group == g].sum(axis=0)).any() else centres[g] for g in range(k)]
    votes = np.array([(held[group == g] * score[chosen][group == g, None]).sum(axis=0) for g in range(k)])
    member = np.where(votes.max(axis=0) > 0, votes.argmax(axis=0), -1)
    order = np.argsort([-(member == g).sum() for g in range(k)], kind="stable")
    return {name: (member == g).astype(float) for name, g in zip(names, order)}


def fit_chain(flat: np.ndarray, owner: np.ndarray, labels: dict[str, np.ndarray], sample: Sample = Sample()) -> Chain:
    """Fit the chain to documents; ``flat`` holds feature numbers and ``owner`` the document of each.

    ``labels`` holds 0/1 arrays in chain order; the last decides.
    """
    last = list(labels)[-1]
    y = labels[last]
    n = len(y)
    numbers, inverse, score = _standing_out(flat, owner, y)
    score = np.abs(score)
    chosen = np.argsort(-score, kind="stable")[: sample.features]
    chosen = chosen[score[chosen] > 3]
    place = np.full(len(numbers), -1)
    place[chosen] = np.arange(len(chosen))
    keep = place[inverse] >= 0
    rows, columns, width = owner[keep].astype(np.int64), place[inverse[keep]], len(chosen)
    fold = np.arange(n) % sample.folds
    models, before = [], np.zeros((n, 0))
    for label in labels.values():
        models.append(fit_linear(rows, columns, width, before, label))
        out = np.zeros(n)
        for k in range(sample.folds):
            test = fold == k
            train = ~test
            number = np.cumsum(train) - 1
            of_train = train[rows]
            part = fit_linear(number[rows[of_train]], columns[of_train], width, before[train], label[train])
            number = np.cumsum(test) - 1
            of_test = test[rows]
            out[test] = part.predict(number[rows[of_test]], columns[of_test], int(test.sum()), before[test])
        before = np.column_stack([before, out])
    return Chain(list(labels), models, {int(numbers[c]): k for k, c in enumerate(chosen)}, _best_limit(before[:, -1], y))


def _best_limit(p: np.ndarray, y: np.ndarray) -> float:
    """The probability of the best out-of-fold F-measure that counts precision twice as much as recall."""
    if not 0 < y.sum() < len(y):
        return 0.5
    order = np.argsort(-p, kind="stable")
    true = np.cumsum(y[order])
    f_half = true / (np.arange(1, len(y) + 1) + 0.25 * y.sum())
    k = int(np.argmax(f_half))
    below = p[order[k + 1]] if k + 1 < len(y) else 0.0
    return float((p[order[k]] + below) / 2)


def train(docs: DataFrame, labels: DataFrame, sample: Sample = Sample(), groups: tuple[str, ...] = GROUPS, id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """Fit the chain on at most ``sample.toxic`` + ``sample.other`` labelled documents.

    Equal texts count once; of rows that share a doc_id the smallest text counts.
    """
    rows = labels.where(F.col("toxic").isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("__id"), "__id"]
    chosen = rows.where("toxic = 1").orderBy(*order).limit(sample.toxic).unionByName(rows.where("toxic <> 1").orderBy(*order).limit(sample.other))
    texts = texts_of(docs).select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "__id")
    texts = texts.groupBy("__id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))

    def read(batches):
        known = _Features()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [sorted(features(t, known)) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.int32()))], ["id", "toxic", "features"])

    seen = texts.select(F.col("__id").cast("long").alias("id"), "text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(read, "id long, toxic int, features array<int>")
    table = seen.toArrow().sort_by("id").combine_chunks()
    lists = table.column("features").chunk(0) if len(table) else pa.array([], pa.list_(pa.int32()))
    flat, bounds = np.asarray(lists.flatten()), np.asarray(lists.offsets) - (lists.offsets[0].as_py() if len(lists.offsets) else 0)
    label = np.asarray(table.column("toxic"), float)
    once: dict[tuple, int] = {}
    for k in range(len(lists)):
        once.setdefault((xxhash.xxh3_128_digest(flat[bounds[k] : bounds[k + 1]].tobytes()), label[k]), k)
    at = np.array(sorted(once.values()), np.int64)
    place = np.full(len(lists), -1)
    place[at] = np.arange(len(at))
    owner = np.repeat(place.astype(np.int32), np.diff(bounds))
    flat, owner = flat[owner >= 0], owner[owner >= 0]
    often = np.zeros(BUCKETS, np.int32)
    np.add.at(often, flat, 1)
    use = often[flat] >= RARE
    flat, owner = flat[use], owner[use]
    toxic = label[at]
    del table, lists, often, use
    chain_labels = toxic_groups(flat, owner, toxic, groups) | {"toxic": toxic}
    return fit_chain(flat, owner, chain_labels, sample)


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, p_<category> for each category of the chain, toxic (whether the last reaches the chain's limit).

    Each row is scored by itself: repeated rows repeat, null and empty texts get
    the score of a text without words, an empty table gives no rows.
    """
    names = [f"p_{n}" for n in chain.names]

    def run(batches):
        known = worker_cache(("toxicity", chain.key), lambda: _Columns(chain.column))
        for batch in batches:
            found = [known.of(t) for t in batch.column(1).to_pylist()]
            p = chain.score(found)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(p[:, k]) for k in range(len(names))), pa.array(p[:, -1] >= chain.limit)], ["doc_id", *names, "toxic"])

    kinds = ", ".join(f"{n} double" for n in names)
    return texts_of(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id long, {kinds}, toxic boolean")


class _Columns(dict):
    """The feature numbers of a word that the chain reads; most words have none."""

    def __init__(self, column: dict[int, int]):
        super().__init__()
        self.column, self.all = column, _Features()

    def __missing__(self, word: str) -> tuple[int, ...]:
        value = self[word] = tuple(f for f in self.all.__missing__(word) if f in self.column)
        self.all.clear()
        return value

    def of(self, text: str | None) -> list[int]:
        if len(self) > 400_000:
            self.clear()
        return list({f for w in set(WORDS.findall((text or "").lower())) for f in self[w]})


def drop_toxic(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the chain does not call toxic, with all their columns."""
    schema = docs.schema
    at = schema.names.index(text_col)

    def run(batches):
        known = worker_cache(("toxicity", chain.key), lambda: _Columns(chain.column))
        for batch in batches:
            p = chain.score([known.of(t) for t in batch.column(at).to_pylist()])
            yield batch.filter(pa.array(p[:, -1] < chain.limit))

    return texts_of(docs).mapInArrow(run, schema)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
