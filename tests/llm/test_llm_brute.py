"""Each query over the small tables against its SQL or a brute-force version."""

import json
import re
import zlib
from collections import Counter
from hashlib import sha256
from itertools import combinations
from types import SimpleNamespace

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from oracle import DATA, assert_same
from pyspark.sql import functions as F

from netloom.llm import byte_bpe, centroids, chat_format, decontamination, importance, lexical_search, ngram_join, queries, resharding, sentencepiece_codec, token_store, toxicity

BIG = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs():
    return dict(duckdb.sql(f"select doc_id, text from '{DATA}/documents.parquet'").fetchall())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    assert_same(queries.QUERIES[name](spark, DATA), queries.ORACLE_SQL[name], DATA)


def test_op1_law(spark, docs):
    rows = queries.QUERIES["op1_reshard"](spark, BIG).collect()
    texts = dict(duckdb.sql(f"select doc_id, text from '{BIG}/documents.parquet'").fetchall())
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    load, slots = Counter(), {}
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        load[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(load) == set(range(24)) and max(load.values()) <= 1.02 * min(load.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def shingles(text):
    words = re.findall(r"\w+", (text or "").lower())
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute_groups(texts):
    """class of each document, and its number of links to other shingle sets."""
    sets = {i: shingles(t) for i, t in texts.items()}
    links = {i: set() for i in sets}
    for a, b in combinations(sorted(sets), 2):
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            links[a].add(b)
            links[b].add(a)
    group = {}
    for i in sorted(sets):
        todo = [i]
        while todo:
            x = todo.pop()
            if group.setdefault(x, i) == i:
                todo += [y for y in links[x] if y not in group]
    return group, {i: len({sets[j] for j in links[i]} - {sets[i]}) for i in sets}


@pytest.mark.parametrize("block", [512, 3])
def test_op2(spark, docs, block):
    base = docs[min(docs)].split()
    near = dict(docs) | {10_000 + k: " ".join(base[: k * 3] + [f"new{k}"] + base[k * 3 + 1 :]) for k in range(12)}
    df = spark.createDataFrame(list(near.items()), "doc_id long, text string")
    group, links = brute_groups(near)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.similar_documents(df, block=block, bucket_block=block).collect()}
    assert got == {i: (group[i], links[i]) for i in near} and max(links.values()) >= 10
    pairs = {(r["id_a"], r["id_b"]) for r in ngram_join.JaccardJoin(df, block=block, bucket_block=block).pairs().collect()}
    assert len(pairs) >= 60 and all(group[a] == group[b] for a, b in pairs)


@pytest.mark.parametrize("seed", range(20))
def test_op2_forests_connect_what_is_linked(seed):
    """Trees inside blocks and bridges between them give the components of all pairs, with fewer edges than rows."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 256, (6, 40), dtype=np.uint8)
    rows = base[rng.integers(0, 6, 60)].copy()
    rows[rng.random(rows.shape) < 0.25] = 7
    second = rng.random(60) < 0.5

    def components(edges):
        label = list(range(60))
        for _ in range(60):
            for a, b in edges:
                label[a] = label[b] = min(label[a], label[b])
        return label

    everything = [(a, b) for a, b in combinations(range(60), 2) if (rows[a] == rows[b]).sum() >= 24]
    edges = []
    for side in (np.flatnonzero(~second), np.flatnonzero(second)):
        edges += [(int(side[a]), int(side[b])) for a, b in ngram_join.trees(rows[side], 24)[1]]
    assert components(edges + ngram_join.bridges(rows, second, 24)) == components(everything)
    assert len(edges) + len(ngram_join.bridges(rows, second, 24)) < 120


def test_op2_bands_reach_the_recall():
    bands, rows = ngram_join.choose_bands(0.8, 0.9999, 320)
    assert bands * rows <= 320 and 1 - (1 - 0.8**rows) ** bands >= 0.9999
    with pytest.raises(ValueError):
        ngram_join.choose_bands(0.1, 0.9999, 10)


def test_op3(spark, docs):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op3_importance"](spark, DATA).collect()}
    good = {i for (i,) in duckdb.sql(f"select doc_id from '{DATA}/labels.parquet' where quality = 1").fetchall()}
    bags = importance.Bags()
    held = {i: bags.buckets([t])[0] for i, t in docs.items()}
    size = 1 << importance.BUCKET_BITS
    raw = 1 + sum(np.bincount(b, minlength=size) for b in held.values())
    target = 1 + sum(np.bincount(held[i], minlength=size) for i in good if i in held)
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    for i, r in rows.items():
        assert r["log_weight"] == pytest.approx(ratio[held[i]].sum(), abs=1e-6)
        assert r["key"] == pytest.approx(r["log_weight"] + importance.gumbel(i, docs[i], 1), abs=1e-6)
    best = sorted(rows, key=lambda i: -rows[i]["key"])[: int(np.ceil(importance.FRACTION * len(docs)))]
    assert {i for i, r in rows.items() if r["selected"]} == set(best)


def test_op3_draws_in_proportion():
    rng = [importance.gumbel(k, "", 0) for k in range(20_000)]
    assert np.mean(rng) == pytest.approx(0.5772, abs=0.03) and np.var(rng) == pytest.approx(np.pi**2 / 6, abs=0.06)


def test_op5(spark, docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file("/opt/tokenizers/word_bpe_49k.json")
    at = 0
    for r in sorted(queries.QUERIES["op5_token_store"](spark, DATA).collect(), key=lambda r: r["doc_id"]):
        ids = [*tok.encode(docs[r["doc_id"]] or "", add_special_tokens=False).ids, 1]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "The", "don't", "'s", "x's.", "..", ",", "É", "é", "İ", "Σ", "\x1c", "\x85", "\xa0", " ", "\n", "5", "<|endoftext|>", "*", "日", "́", "Word,", "word.'", "µ", "×"]), max_size=12).map("".join))
def test_words_are_encoded_as_the_library_does(text):
    from tokenizers import Tokenizer

    spec = open("/opt/tokenizers/word_bpe_49k.json", encoding="utf-8").read()
    global _WHOLE
    _WHOLE = globals().get("_WHOLE") or Tokenizer.from_str(spec)
    ((_, ids, _),) = token_store._tokenizer_table(spec).blocks([text])
    assert ids.tolist() == _WHOLE.encode(text, add_special_tokens=False).ids


def test_chunks_follow_the_content_and_crcs_join():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 49_000, 20_000)
    b = np.concatenate([a[:5000], [7], a[5000:]])
    cut = lambda x: {x[s:e].tobytes() for s, e in zip([0, *token_store.cut_points(x, np.array([0, len(x)]))[0]], token_store.cut_points(x, np.array([0, len(x)]))[0])}
    assert len(cut(a) & cut(b)) >= len(cut(a)) - 3
    x, y = b"hello " * 50, b"world" * 33
    assert token_store.crc32_join(zlib.crc32(x), zlib.crc32(y), len(y)) == zlib.crc32(x + y)


def test_damaged_chunks_are_noticed(spark):
    df = spark.createDataFrame([(1, "some words to keep"), (2, "and others")], "doc_id long, text string")
    root = token_store.write_store(df)
    chunks = spark.read.parquet(f"{root}/chunks").collect()
    bad = [(r["digest"], r["n"], bytearray(r["payload"][:-1] + b"\x63")) for r in chunks]
    spark.createDataFrame(bad, "digest binary, n int, payload binary").write.mode("overwrite").parquet(f"{root}/chunks")
    with pytest.raises(Exception, match="damaged"):
        token_store.document_facts(spark, root).collect()


def test_op6(spark, docs):
    items = dict(duckdb.sql(f"select item_id, text from '{DATA}/benchmark.parquet'").fetchall())
    flat = lambda t: " ".join((t or "").lower().split())
    whole = {(d, i) for d, t in docs.items() for i, b in items.items() if flat(b) in flat(t)}
    got = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op6_decontamination"](spark, DATA).collect()}
    assert whole and got == whole


@pytest.mark.parametrize("text,found", [
    ("Carol has 9 apples and gives 4 kg of apples to Dan. How many apples does Carol keep?", True),
    ("noise before it. CAROL? Carol has 9 apples and gives 4 lb of apples to Dan. How many apples does Carol keep?", True),
    ("many people have apples and some of them give apples to friends; how many are left?", False),
])
def test_op6_other_slots(text, found):
    assert bool(_found("Alice has 5 apples and gives 3 kg of apples to Bob. How many apples does Alice keep?", text, 0.5)) is found


def test_op6_inconsistent_slots_do_not_count():
    item = "we saw Ann and Ann met them near Ann in the old town with Ann again"
    assert _found(item, "we saw Eve and Eve met them near Eve in the old town with Eve again", 0.6)
    assert not _found(item, "we saw Eve and Joe met them near Kim in the old town with Sue again", 0.6)


def test_op7_accuracy(spark):
    large = "/root/testdata/sf0.1"  # 450 toxic labels, some 5 % of them on texts without a toxic word
    docs, labels = spark.read.parquet(f"{large}/documents.parquet"), spark.read.parquet(f"{large}/labels.parquet")
    held = labels.where("doc_id % 3 = 0").withColumnRenamed("toxic", "truth")
    chain = toxicity.train(docs, labels.where("doc_id % 3 <> 0"))
    got = toxicity.score(docs, chain).join(held, "doc_id").toPandas()
    flagged = got[got.toxic]
    assert (flagged.truth == 1).mean() >= 0.95 and (flagged.truth == 1).sum() >= 0.8 * (got.truth == 1).sum()
    assert chain.names == ["insult", "contempt", "toxic"] and len(chain.models[2].weight) == len(chain.models[0].weight) + 2


def test_op10(spark, docs):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file="/opt/tokenizers/piece_bpe_32k.model")
    for r in queries.QUERIES["op10_sentencepiece"](spark, DATA).collect():
        ids = lib.encode(docs[r["doc_id"]] or "")
        assert (r["n_pieces"], r["ids_crc32"], r["round_trip"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), True)


_SP: list = []


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(st.sampled_from(["a", "b", "th", "e", " ", "  ", "er", "\n", "é", "ing", "<s>", "日", "0", "ss", "▁"]), max_size=200).map("".join)))
def test_pieces_are_the_librarys(text):
    import sentencepiece

    if not _SP:
        path = "/opt/tokenizers/piece_bpe_32k.model"
        _SP.extend([sentencepiece.SentencePieceProcessor(model_file=path), sentencepiece_codec.read_model(path)])
    lib, pieces = _SP
    ((_, ids, _),) = sentencepiece_codec.encoder(pieces).blocks([text])
    assert ids.tolist() == lib.encode(text)
    assert sentencepiece_codec.decode(ids.tolist(), pieces) == text.replace("▁", " ")


@pytest.mark.parametrize("text", ["a" * 5000, "=" * 3000, "ab" * 2000, "abc" * 1500, "hahaho" * 700, "日本語的一是不" * 500, "".join(chr(0x4E00 + 37 * k % 20000) for k in range(4000)), "returnvalue();" * 300 + "x", "😀é" * 900, "0123456789" * 400, "the=of;" * 500 + " and " + "z" * 1000])
def test_long_segments_are_encoded_in_windows(text):
    import sentencepiece

    if not _SP:
        path = "/opt/tokenizers/piece_bpe_32k.model"
        _SP.extend([sentencepiece.SentencePieceProcessor(model_file=path), sentencepiece_codec.read_model(path)])
    lib, pieces = _SP
    ids = np.concatenate([x for _, x, _ in sentencepiece_codec.encoder(pieces).blocks([text, "short one", text[7:]])])
    assert ids.tolist() == lib.encode(text) + lib.encode("short one") + lib.encode(text[7:])


def test_unigram_edges_compete_by_score():
    kinds = ["normal"] * 6
    p = sentencepiece_codec.Pieces(["▁a", "b", "ab", "▁ab", "c", "bc"], [-1.0, -1.0, -9.0, -3.0, -1.0, -1.5], kinds, bpe=False)
    ids, n = sentencepiece_codec.encode_segments([" abc"], p)
    assert ids.tolist() == [0, 5] and n.tolist() == [2]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "[TEXT]\\"]), st.lists(st.sampled_from(["\\", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", " ", "<", "s>", "[", "[ROLE] ", "[TEXT]", "x", "\n"]), max_size=8).map("".join)), max_size=4))
def test_templates_are_reversible(turns):
    t = chat_format.Template()
    whole = "".join(s for role, text in turns for s, _ in t.segments(role, text))
    assert list(t.parse(whole)) == turns


def test_pipeline(spark, docs):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "SentencePiece encoding"]
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    source = spark.read.parquet(f"{DATA}/documents.parquet")
    bad = {r["doc_id"] for r in toxicity.score(source, toxicity.train(source, labels)).where("toxic").collect()}
    left = {i: t for i, t in docs.items() if i not in bad}
    first = {}
    for i in sorted(left):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", left[i] or ""), i)
    left = {i: left[i] for i in first.values()}
    group, _ = brute_groups(left)
    left = {i: t for i, t in left.items() if group[i] == i}
    items = [t for (t,) in duckdb.sql(f"select text from '{DATA}/benchmark.parquet'").fetchall()]
    flat = lambda t: " ".join((t or "").lower().split())
    left = {i: t for i, t in left.items() if not any(flat(b) in flat(t) for b in items)}
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file="/opt/tokenizers/piece_bpe_32k.model")
    got = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, DATA).collect()}
    assert got == {i: lib.encode(t or "") for i, t in left.items()}


def _found(item, text, min_cover=decontamination.MIN_COVER):
    """The join of one item and one text in plain Python."""
    d, t = decontamination, decontamination.Templater()
    held = {}
    for reading, width, h, *_, length, item_pos, spans, slots, slot_spans in d.item_windows(t, 0, 1, item, d.MIN_PLAIN, d.MIN_PASSAGE):
        if reading != d.PASSAGE:
            held[reading, width, h] = (item_pos, spans, slots, slot_spans)
    total = len({x for _, spans, *_ in held.values() for a, b in zip(spans[::2], spans[1::2]) for x in range(a, b)})
    everything = SimpleNamespace(holds=lambda hashes: np.arange(len(hashes)))
    hits = []
    for reading, width, hashes, *columns, values, count in d.document_windows(t, text, sorted({k[:2] for k in held}), everything):
        ends = np.cumsum(count)
        for h, pos, start, stop, end, n in zip(hashes.view(np.int64).tolist(), *(c.tolist() for c in columns), ends.tolist(), count.tolist()):
            if (reading, width, h) in held:
                hits.append(d.Hit(reading, width, pos, start, stop, values[end - n : end].view(np.int64).tolist(), *held[reading, width, h]))
    found = d.judge(hits, length, total, min_cover, d.MIN_PASSAGE)
    return [(1, *found)] if found else []


_APPLES = "when the market in the village opens early Ann takes 3 baskets of ripe red apples from her old garden and then walks along the river until she meets her friend and sells half of them for 2 coins each"


@pytest.mark.parametrize("text", [
    _APPLES.replace("Ann", "Mary Ann").replace("for 2 coins", "for 1 1/2 coins"),
    _APPLES.replace("ripe red", "ripe and red").replace("walks along", "along"),
    _APPLES.replace("Ann", "Mary Ann Lee").replace("3", "4 1/2").replace("until she", "until at last she"),
])
def test_op6_slots_and_words_of_other_length(text):
    ((_, cover, position, _),) = _found(_APPLES, "some words before it " + text)
    assert cover >= 0.5 and position == 4
    assert not _found(_APPLES, " ".join(text.split()[::-1]))


def test_op6_stretches_far_apart_are_not_joined():
    words = _APPLES.split()
    part = " ".join(words[:12]) + " filler" * 40 + " " + " ".join(words[-12:])
    assert not _found(_APPLES, part, 0.5)


@pytest.mark.parametrize("item", ["Compute 12 + 7 * 3 - 5 + 9 + 11", "Ann has 5 kg", "Ann Lee, Bob Ray, Carl Fox, Dan Poe, Eve Kim", "3 May 1901, 7 June 1980, 8 July 1990 and 9 May 1982"])
def test_op6_copies_with_few_plain_words(item):
    assert _found(item, f"words before it. {item}. And words after it")[0][1] == 1
    other = item.replace("5", "6").replace("Bob", "Tom").replace("1901", "1902")
    assert not _found(item, f"words before it. {other}. And words after it", 0.9)


def test_op6_windows_with_few_plain_words_count_for_cover():
    item = "please add up these numbers for us " + " ".join(str(7 * k) for k in range(20))
    assert _found(item, "now " + item)[0][1] == 1


def test_op6_passages_of_long_items():
    words = [f"word{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{'uvwxyz'[k // 100]}" for k in range(400)]
    item = " ".join(words)
    for n, found in ((150, True), (13, True), (12, False)):
        assert bool(_found(item, "before it " + " ".join(words[200 : 200 + n]) + " after it")) is found
    apples = _APPLES.split()
    assert _found(_APPLES + " and more words" * 20, "before " + " ".join(apples[4:31]).replace("Ann", "Eve"))
    # changed slots do not make up the number: 13 tokens, one of them another name
    assert not _found(_APPLES + " and more words" * 20, "before " + " ".join(apples[:13]).replace("Ann", "Eve"))


@pytest.mark.parametrize("stems", [("vrik", "mulo"), ("zorbak", "quilen")])
def test_op7_unseen_inflections_of_stems_of_any_length(spark, stems):
    ends = [a + b for a in "bcdfghjklmnpqrstvwxz" for b in "aeiou"]
    plain = lambda k: " ".join(f"common{(k * 7 + j) % 40}" for j in range(12))
    word = lambda k: stems[k % 2] + ends[k % 100] + "tuv"
    rows = [(k, f"{plain(k)} {word(k)}" if k < 90 else plain(k), int(k < 90)) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    chain = toxicity.train(df, df)
    unseen = spark.createDataFrame([(k, f"{plain(k)} {word(k) if k < 100 else ''}") for k in range(90, 110)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.score(unseen, chain).collect()}
    assert {k for k, r in got.items() if r["toxic"]} == set(range(90, 100))
    # the groups are found in the rows, one for each stem
    first = {k for k in range(90, 100) if got[k]["p_insult"] > got[k]["p_contempt"]}
    assert first in (set(range(90, 100, 2)), set(range(91, 100, 2)))


def test_long_chains_of_random_ids_settle(spark, monkeypatch):
    from netloom.llm import components
    from netloom.llm.common import materialize

    rounds = []
    monkeypatch.setattr(components, "materialize", lambda df, name: rounds.append(name) or materialize(df, name))
    ids = np.random.default_rng(3).permutation(800).tolist()
    edges = spark.createDataFrame([*zip(ids, ids[1:]), (900, 901)], "a long, b long")
    got = {r["id"]: r["component"] for r in components.components(edges).collect()}
    assert got == {i: 0 for i in ids} | {900: 900, 901: 900}
    assert len(rounds) <= 20


def test_op6_reparameterised_items_of_the_table(spark):
    """Every item with each number and each name replaced, consistently, is found for itself or an item of the same template."""
    items = dict(duckdb.sql(f"select item_id, text from '{DATA}/benchmark.parquet'").fetchall())
    seen: dict[str, str] = {}

    def other(m):
        word = m[0]
        return seen.setdefault(word, str(7 * len(seen) + 11) if word[0].isdigit() else "Q" + "abcdefghijklmnopqrstuvwxyz"[len(seen) % 26] + "abcdefghij"[len(seen) // 26 % 10] + "o")

    docs = {i: "first some words. " + re.sub(r"(?<=[a-z,] )[A-Z][a-z]+|\d+", other, t) + " and then more" for i, t in items.items()}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet")
    found = {}
    for r in decontamination.contaminated(df, bench).collect():
        found.setdefault(r["doc_id"], set()).add(r["item_id"])
    templates = {i: re.sub(r"(?<=[a-z,] )[A-Z][a-z]+|\d+", "_", t) for i, t in items.items()}
    assert all(any(templates[j] == templates[i] for j in found[i]) for i in items)
    assert decontamination.drop_contaminated(df, bench).count() == 0


def _numbered(word, k):
    return word + "abcdefghij"[k % 10] + "klmnopqrst"[k // 10 % 10] + "uvwxyzabcd"[k // 100 % 10] + "efghijklmn"[k // 1000 % 10]


@pytest.mark.parametrize("limit", [None, 0])
def test_op6_shared_preambles_and_classes(spark, monkeypatch, limit):
    """``limit`` 0: the table is joined by a shuffle."""
    if limit is not None:
        from netloom.llm import common

        monkeypatch.setattr(decontamination, "bounded_broadcast", lambda df, row_bytes: common.bounded_broadcast(df, row_bytes, limit))
    preamble = " ".join(_numbered("pre", k) for k in range(280))
    own = [preamble + " " + " ".join(_numbered("item", 20 * i + k) for k in range(20)) for i in range(60)]
    same = [f"the clerk in the old shop sold {3 * i + 2} jars to Bob before noon and asked for {i + 900} coins" for i in range(40)]
    bench = spark.createDataFrame(list(enumerate(own + same)), "item_id long, text string")
    docs = [(0, preamble), (1, "before " + own[7] + " after"), (2, "then the clerk in the old shop sold 77 jars to Joe before noon and asked for 5 coins"), (3, "now " + same[30])]
    got = {(r["doc_id"], r["item_id"]): r["changed_slots"] for r in decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert set(got) == {(1, 7), (2, 60), (3, 60), (3, 90)}
    assert got[2, 60] == 3 and got[3, 60] == 2 and got[3, 90] == 0


def test_op6_repetitive_texts_are_quick():
    from time import process_time

    began = process_time()
    assert _found(" ".join(["again"] * 100), " ".join(["again"] * 8000))[0][1] == 1
    assert _found("ho ha " * 50 + "he", "ho ha " * 4000)
    assert process_time() - began < 2  # both together, with all 16,000 hits in plain Python


@pytest.mark.parametrize("name,end", [("byte_bpe_50k.json", 50256), ("word_bpe_49k.json", 70_000)])
def test_op5_other_tokenizers_and_wide_ids(spark, docs, name, end):
    """A file whose pattern is not the known one gets whole texts; ids above 65,535 make the whole store 4 bytes wide."""
    from tokenizers import Tokenizer

    path = f"/opt/tokenizers/{name}"
    assert token_store._cuts(json.loads(open(path, encoding="utf-8").read())) is name.startswith("word")
    tok, some = Tokenizer.from_file(path), dict(list(docs.items())[:40]) | {-1: "<|endoftext|> 日本語 naïve\0 x", -2: None}
    df = spark.createDataFrame(list(some.items()), "doc_id long, text string")
    root = token_store.write_store(df, path, end)
    want = {i: tok.encode(t or "", add_special_tokens=False).ids + [end] for i, t in some.items()}
    assert {r["doc_id"]: r["ids"] for r in token_store.read_documents(spark, root).collect()} == want
    got = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in token_store.document_facts(spark, root).collect()}
    assert got == {i: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want.items()}
    widths = {r["payload"][0] for r in spark.read.parquet(f"{root}/chunks").collect()}
    assert widths == {2 if end < 65536 else 4}


def test_op1_cells_and_least_bytes(spark):
    """Blocks larger than a file are cut into cells; what stays is not written; the plan is near the optimum of the flow."""
    rows = spark.read.parquet(f"{DATA}/documents.parquet")
    old = F.pmod(F.xxhash64("source"), F.lit(3))
    out, path, plan = resharding.reshard(rows, old, 3, 5, blocks=8, file_bytes=4000)
    got = out.select("doc_id", "size", "shard", "slot", old.alias("was")).toPandas()
    assert sorted(got.doc_id) == sorted(r["doc_id"] for r in rows.select("doc_id").collect())
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    moved = got[got.shard != got.was]
    assert moved["size"].sum() == plan.moved_bytes >= plan.least_bytes > 0
    written = spark.read.parquet(path).select("doc_id", "shard", "slot").toPandas()
    assert sorted(written.doc_id) == sorted(moved.doc_id)
    # brute force: with equal shares, the bytes that must leave are what each old shard holds above its share
    share = got["size"].sum() / 5
    assert abs(plan.least_bytes - sum(max(0, b - share) for b in got.groupby("was")["size"].sum())) <= 5


def test_op7_repeated_ids_are_one_row_of_the_sample(spark):
    rows = [(k, f"word{k % 7} {'vile' if k % 2 else 'kind'} text", k % 2) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    many = df.unionByName(spark.createDataFrame([(1, f"zzz other text {k}", 1) for k in range(500)], df.schema))
    a, b = toxicity.train(df, df), toxicity.train(many, df)
    assert a.column == b.column and a.limit == b.limit


def test_op2_recall_at_larger_scale(spark):
    """Every row whose id is divisible by 20 against all rows, by an index of all shingles: no link is missing."""
    large = "/root/testdata/sf0.1"
    texts = dict(duckdb.sql(f"select doc_id, text from '{large}/documents.parquet'").fetchall())
    sets, held = {}, {}
    for i, t in texts.items():
        s = sets[i] = shingles(t)
        if s and s not in held:
            held[s] = len(held)
    places: dict = {}
    for s, number in held.items():
        for x in s:
            places.setdefault(x, []).append(number)
    sizes = [len(s) for s in held]
    want = {}
    for i in texts:
        if i % 20 == 0:
            common = Counter(n for x in sets[i] for n in places[x])
            own = held.get(sets[i])
            want[i] = sum(n != own and c >= 0.8 * (len(sets[i]) + sizes[n] - c) for n, c in common.items())
    got = {r["doc_id"]: r["n_links"] for r in queries.QUERIES["op2_ngram_join"](spark, large).where("doc_id % 20 = 0").collect()}
    assert sum(want.values()) > 10 and got == want


def test_op3_against_plain_python(spark):
    """Buckets, ratios and noise from their definitions, with Python integers alone."""
    import math

    import xxhash

    texts = {1: "The cat, the mat!", 2: "a dog ate the cat", 3: "", 4: None, 5: "the the THE 日本", 6: "a dog ate the cat"}
    good, mask = {1, 5}, (1 << 64) - 1

    def grams(text):
        tokens = [xxhash.xxh64_intdigest(t) for t in re.findall(r"\w+|[^\w\s]+", (text or "").lower())]
        pairs = [((a * 0x9E3779B97F4A7C15 & mask) ^ (b + 0x632BE59BD9B4E019 & mask)) * 0xBF58476D1CE4E5B9 & mask for a, b in zip(tokens, tokens[1:])]
        return [x >> (64 - 14) for x in tokens + pairs]

    raw, target = Counter(x for t in texts.values() for x in grams(t)), Counter(x for i in good for x in grams(texts[i]))
    size = 1 << 14
    log = lambda c, x: math.log((c[x] + 1) / (sum(c.values()) + size))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in importance.resample(df, F.col("doc_id").isin(*good), 0.5, seed=3).collect()}
    keys = {}
    for i, t in texts.items():
        weight = sum(log(target, x) - log(raw, x) for x in grams(t))
        u = (xxhash.xxh64_intdigest(f"{i}\0{t or ''}", 3) + 0.5) / 2**64
        keys[i] = weight - math.log(-math.log(u))
        assert got[i]["log_weight"] == pytest.approx(weight, abs=1e-9) and got[i]["key"] == pytest.approx(keys[i], abs=1e-9)
    assert {i for i, r in got.items() if r["selected"]} == set(sorted(keys, key=keys.get)[-3:])


def test_pipeline_on_odd_tables(spark, tmp_path):
    """Empty tables and rows with null ids and texts pass all stages."""
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, rows in (("empty", []), ("odd", [(None, None, None, None, None), (1, None, "en", "a", 0), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (None, "five words are in here", "en", "b", 22), (3, "five words are in here", "en", "b", 22)])):
        folder = tmp_path / name
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
        for table, kinds in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
            spark.createDataFrame([], kinds).write.parquet(f"{folder}/{table}.parquet")
        got = [(r["doc_id"], r["round_trip"]) for r in corpus_pipeline.run(spark, str(folder)).collect()]
        assert got == [] if name == "empty" else sorted(map(str, got)) == sorted(map(str, [(1, True), (3, True)]))


def brute_search(texts, items, k):
    """Scores from the definition, over all documents."""
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    bags = [(i, Counter(terms(t))) for i, t in texts if terms(t)]
    n_docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for i, bag in bags:
            m = 100 - 25 + 25 * sum(bag.values()) * n_docs // total
            score = sum(int(np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df[t] + 1)))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 12 * m)) for t in terms(text) if t in bag)
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("segment_bytes", "block_bytes"), [(16 << 20, 32 << 20), (3000, 400)])
def test_op13(spark, segment_bytes, block_bytes):
    """Small segments and blocks of queries, many equal scores, repeated rows and terms, terms in every document."""
    rng = np.random.default_rng(5)
    words = ["the", "of", "Straße", "x1", "naïve", "日本", *(f"w{k}" for k in range(60))]
    texts = [(k, " ".join(rng.choice(words, rng.integers(1, 40), p=(p := 1 / np.arange(1, 67)) / p.sum()))) for k in range(300)]
    texts += [(1000 + k, "the same w3, W3; copy") for k in range(70)] + [(5, "the x1"), (5, "the x1"), (None, "the x1 w3"), (7, None), (8, ""), (9, "!?")]
    items = [(1, "the of W3 w3"), (2, "日本 Straße"), (2, "日本 Straße"), (3, None), (4, "absent"), (5, "copy same"), (None, "x1"), (6, "the"), (7, " ".join(words))]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("score", F.lit(1)).repartition(3)
    index = lexical_search.write_index(df, segment_bytes=segment_bytes)
    got = lexical_search.search(spark, index, spark.createDataFrame(items, "item_id long, text string"), 20, block_bytes=block_bytes)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_search(texts, items, 20)


def test_op13_stops_before_the_lists_end():
    n = np.full(4000, 10)
    tf = np.where(np.arange(4000) < 30, 9, 1)
    segment = lexical_search._Segment(np.arange(4000), np.zeros(4000, bool), n, {0: (np.arange(4000), tf), 1: (np.arange(0, 4000, 2), tf[::2])}, 4000, 40000, 2)
    looked, scores = [], segment.scores
    segment.scores = lambda docs: looked.extend(docs) or scores(docs)
    best = lexical_search._Best(5)
    segment.search([0, 1], [3, 4], best)
    assert best.doc.tolist() == [0, 2, 4, 6, 8] and len(looked) < 200


def test_op13_empty(spark, docs):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search.search(spark, lexical_search.write_index(none), items).count() == 0
    index = lexical_search.write_index(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    assert lexical_search.search(spark, index, items.where("false")).count() == 0


@pytest.mark.parametrize(("k", "dims", "spread"), [(1, 3, 4), (7, 2, 3), (200, 8, 60), (64, 64, 1000)])
def test_op12_annulus_finds_the_nearest(k, dims, spread):
    """Small grids give many ties and centroids that are equal; each vector gets the smallest number among the nearest."""
    rng = np.random.default_rng(k)
    means, vectors = rng.integers(-spread, spread + 1, (k, dims)), rng.integers(-spread, spread + 1, (500, dims))
    vectors[:k] = means[:500]
    apart = ((vectors[:, None, :] - means[None]) ** 2).sum(2)
    search = centroids.Annulus(means)
    cluster, least = search.nearest(vectors)
    assert cluster.tolist() == apart.argmin(1).tolist() and least.tolist() == apart.min(1).tolist()
    assert k < 64 or search.compared < 500 * k


def test_op12_rounds_and_odd_rows(spark):
    """Plain Python rounds over a table with ties, copies, a hot vector and rows that are not kept."""
    rng = np.random.default_rng(1)
    rows = [(k, [float(x) for x in rng.integers(-3, 4, 4) / 2]) for k in range(200)] + [(300 + k, [0.5, 0.5, 0.5, 0.5]) for k in range(100)]
    rows += [(3, [1.0, 0.0, 0.0, 0.0]), (3, [1.0, 0.0, 0.0, 0.0]), (None, [0.25, -0.3, 0.1, 0.0])]
    odd = [(900, None), (901, []), (902, [1.0] * 3), (903, [1.0] * 5), (904, [1.0, None, 1.0, 1.0]), (905, [float("nan")] * 4), (906, [float("inf"), 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("v", "cluster", "key", "distance")}).repartition(3)
    kept = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows]
    key = lambda r: (r[0] is None, sha256(f"3:{r[0]}".encode()).hexdigest(), r[0] or 0, r[1])
    means = [list(v) for _, v in sorted(kept, key=key)[:8]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(means))
    for _ in range(5):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        means = [[sum(x) // len(x) for x in zip(*groups[c])] if c in groups else m for c, m in enumerate(means)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, c, d in found:
        inertia[c] += d
    want = [(i, c, d, inertia[c], sum(inertia.values()), sha256(",".join(map(str, means[c])).encode()).hexdigest()) for i, c, d in found]
    got = centroids.cluster(df, rounds=5, dims=4)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert centroids.cluster(df.where("false"), dims=4).count() == 0
    assert centroids.cluster(df.where("vec_id < 5"), dims=4, rounds=2).select("cluster").distinct().count() <= 7
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(spark.createDataFrame([(1, [1e30] * 4)], "vec_id long, embedding array<double>"), dims=4).collect()


@pytest.fixture(scope="module")
def byte_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")


def test_op11(spark, byte_tokenizer):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op11_byte_bpe"](spark, BIG).collect()}
    texts = duckdb.sql(f"select doc_id, text from '{BIG}/documents.parquet'").fetchall()
    assert len(got) == len(texts)
    for i, text in texts:
        ids = byte_tokenizer.encode(text or "", add_special_tokens=False).ids
        back = byte_tokenizer.decode(ids, skip_special_tokens=False)
        assert got[i] == (len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(), sha256(back.encode()).hexdigest())


SIGNS = ["a", "b", "Z", "s", "re", "ll", "'", "'s", " ", "  ", "\n", "\t", "1", "23", "-", "<|endoftext|>", "<|endof", "text|>", "日", "本", "。", "，", "\u3000", "\xa0", "é", "😀", "\x00", "\x1c", "\x85", "٣", "aaaaaaa", "...", "\r\n"]


@pytest.mark.parametrize("sizes", [(4, 3, 64), (1, 1, 8), (128, 9, 4096)])
@pytest.mark.parametrize("signs", [SIGNS, SIGNS[:8], [*SIGNS[15:18], "x", " "], ["日", "本", "。"], ["a"], [" "], ["'", "s", "l"]])
def test_op11_joins_are_repaired(monkeypatch, byte_tokenizer, sizes, signs):
    """Cuts inside words, white space, special tokens and runs without any anchor; ids are the library's."""
    for name, value in zip(("MIN_CHUNK", "MEAN_BITS", "MAX_CHUNK"), sizes):
        monkeypatch.setattr(byte_bpe, name, value)
    rng = np.random.default_rng(len(signs))
    texts = ["".join(rng.choice(signs, n)) for n in (0, 1, 30, 700, 3000, 1, 0)] * 2
    spec = open("/opt/tokenizers/byte_bpe_50k.json").read()
    codec, decode = byte_bpe.ChunkCodec(spec), byte_bpe.Decoder(spec)
    for first, ids, bounds in codec.blocks(texts):
        for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
            want = byte_tokenizer.encode(texts[first + k], add_special_tokens=False).ids
            assert ids[a:b].tolist() == want and decode(want) == byte_tokenizer.decode(want, skip_special_tokens=False)


def test_op11_shared_chunks_are_encoded_once(byte_tokenizer):
    rng = np.random.default_rng(3)
    passage = " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(3000))
    codec = byte_bpe.ChunkCodec(open("/opt/tokenizers/byte_bpe_50k.json").read())
    list(codec.blocks([passage]))
    once = codec.encoded
    list(codec.blocks([f"{'x' * k} other start {k} " + passage + " and end" for k in range(20)]))
    assert once > 20 and codec.encoded - once < 20 * 6 and codec.repaired > 20 * once * 0.7


def test_op11_widens_until_ids_agree(byte_tokenizer, monkeypatch):
    """With anchors where no part ends, the outer stretches differ and the repaired text grows."""
    monkeypatch.setattr(byte_bpe, "anchors", lambda raw, text, added: np.arange(1, len(raw)))
    monkeypatch.setattr(byte_bpe, "MEAN_BITS", 4)
    monkeypatch.setattr(byte_bpe, "MIN_CHUNK", 8)
    text = "internationalisation electroencephalography " * 20
    codec = byte_bpe.ChunkCodec(open("/opt/tokenizers/byte_bpe_50k.json").read())
    ids, _ = codec.block([text])
    assert codec.widened > 0 and b"".join(codec.bytes[i] for i in ids) == text.encode()


def test_op11_other_files(tmp_path, byte_tokenizer):
    """A file whose texts may not be cut gives the library's ids for whole texts."""
    spec = json.load(open("/opt/tokenizers/byte_bpe_50k.json"))
    texts = ["x <|a b|> y" * 50, "Plain text"]
    for change in ({"added_tokens": [*spec["added_tokens"], {**spec["added_tokens"][0], "id": 50257, "content": "<|a b|>"}]}, {"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {**spec["pre_tokenizer"], "add_prefix_space": True}}):
        changed = json.dumps({**spec, **change})
        codec = byte_bpe.codec(changed)
        assert type(codec) is byte_bpe.WholeCodec
        want = [e.ids for e in codec.library.encode_batch(texts, add_special_tokens=False)]
        assert [ids[a:b].tolist() for _, ids, bd in codec.blocks(texts) for a, b in zip(bd, bd[1:])] == want


def test_op5_added_tokens_with_white_space():
    """Such a token may cross the words that texts are cut into, so whole texts go to the library."""
    spec = json.load(open("/opt/tokenizers/word_bpe_49k.json"))
    assert token_store._cuts(spec)
    spec["added_tokens"].append({**spec["added_tokens"][0], "id": 49408, "content": "<|a b|>"})
    assert not token_store._cuts(spec)
    table = token_store._tokenizer_table(json.dumps(spec))
    ((_, ids, _),) = table.blocks(["x <|a b|> y"])
    assert len(ids) == 3 and 49408 in ids


@pytest.mark.parametrize("n", [16, 17, 30, 2000])
@pytest.mark.parametrize("place", [25, 12])
def test_op6_items_that_share_nearly_all_are_all_found(spark, n, place):
    """A document with the 25 words that ``n`` items share, of 26, is a leak of each; brute force over windows says so too."""
    words = [_numbered("word", k) for k in range(25)]
    items = [(i, " ".join([*words[:place], _numbered("own", i), *words[place:]])) for i in range(n)]
    docs = [(1, "before it " + " ".join(words) + " after it"), (2, " ".join(words[:14])), (3, "nothing of them " * 9), (4, "say " + items[n - 1][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["cover"] for r in decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert {i for d, i in got if d == 1} == {i for d, i in got if d == 4} == set(range(n)) and {d for d, _ in got} <= {1, 2, 4}
    assert got[4, n - 1] == 1 and abs(got[1, 0] - 25 / 26) < 1e-9 or n == 16


@pytest.mark.parametrize("n, limit", [(16, None), (30, None), (30, 0)])
def test_op6_items_that_only_all_their_windows_tell(spark, monkeypatch, n, limit):
    """Own words in three places of ``n`` items, other words put in between and other numbers beside them: neither own nor common windows alone say enough."""
    if limit is not None:
        from netloom.llm import common

        monkeypatch.setattr(decontamination, "bounded_broadcast", lambda df, row_bytes: common.bounded_broadcast(df, row_bytes, limit))
    first, last, put = ([_numbered(w, k) for k in range(30)] for w in ("first", "last", "put"))
    side = "left {} leaf {} lean {} lend", "rift {} rise {} rill ripe rice"

    def text(i, numbers, words=0):
        a, b, c = ([_numbered(w, 3 * i + k) for k in range(3)] for w in ("one", "two", "six"))
        far = lambda part: [*part[:10], *put[:words], *part[10:20], *put[6 : 6 + words], *part[20:]]
        return " ".join([*a, *far(first), side[0].format(*numbers[:3]), *b, side[1].format(*numbers[3:]), *far(last), *c])

    bench = spark.createDataFrame([(i, text(i, (12, 15, 19, 21, 24))) for i in range(n)], "item_id long, text string")
    other = (112, 115, 119, 121, 124)
    docs = [(1, "now " + text(5, other, 6) + " end"), (2, "now " + text(n + 100, other, 6)), (3, text(n + 100, (12, 15, 19, 21, 24))), (4, text(7, other)), (5, " ".join(put * 9 + [text(9, other, 6)]))]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["cover"], r["changed_slots"]) for r in decontamination.contaminated(docs, bench).collect()}
    if n > decontamination.COMMON:
        assert {k: v for k, v in got.items() if k[0] != 4} == {(1, 5): (1, 5), (5, 9): (1, 5)} and {k for k in got if k[0] == 4} == {(4, 7)}
        assert {r["doc_id"] for r in decontamination.drop_contaminated(docs, bench).collect()} == {2, 3}
    else:
        assert got.keys() >= {(1, 5), (4, 7), (5, 9)}


def test_op6_equal_items_are_all_found(spark):
    text = "the clerk in the old shop sold seven jars to Bob before noon and asked for nine coins"
    bench = spark.createDataFrame([(i, text.upper() if i == 7 else text) for i in range(30)] + [(3, text)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "now " + text), (2, "then the clerk in the old shop sold seven jars to Joe before noon and asked for nine coins")], "doc_id long, text string")
    got = Counter((r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, bench).collect())
    assert {i for d, i in got if d == 1} == set(range(30)) and got[1, 3] == 2 and {i for d, i in got if d == 2} >= set(range(30)) - {7}
    assert decontamination.drop_contaminated(docs, bench).count() == 0


def test_op6_items_of_common_sentences_only(spark):
    """Items put together from a few sentences have no window of their own inside them; whole ones and halves are found as before."""
    rng = np.random.default_rng(2)
    stock = [" ".join(_numbered("stock", 30 * s + k) for k in range(12)) for s in range(6)]
    items = [(i, " ".join(stock[k] for k in rng.permutation(6)[:3])) for i in range(120)]
    docs = [(k, "x y z " + t) for k, t in items[:10]] + [(99, " ".join(_numbered("other", k) for k in range(60)))]
    got = {}
    for r in decontamination.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect():
        got.setdefault(r["doc_id"], set()).add(r["item_id"])
    assert 99 not in got and all({i for i, t in items if t == dict(items)[k]} <= got[k] for k, _ in docs[:10])


def _plain_logistic(x, label, steps=120, ridge=2.0):
    """Balanced logistic regression over dense rows, one number at a time where it matters: Adam on the mean loss with a shared ridge."""
    n, k = x.shape
    weight, bias = [0.0] * k, 0.0
    m, v = [0.0] * (k + 1), [0.0] * (k + 1)
    ones = sum(label)
    if ones in (0, n):
        return weight, 30.0 if ones else -30.0
    for t in range(1, steps + 1):
        gradient = [0.0] * (k + 1)
        for row, y in zip(x, label):
            z = max(-30.0, min(30.0, sum(a * b for a, b in zip(row, weight)) + bias))
            d = (1 / (1 + np.exp(-z)) - y) * (0.5 / ones if y else 0.5 / (n - ones))
            for j in range(k):
                gradient[j] += d * row[j]
            gradient[k] += d
        for j in range(k):
            gradient[j] += ridge / n * weight[j]
        for j in range(k + 1):
            m[j], v[j] = 0.9 * m[j] + 0.1 * gradient[j], 0.99 * v[j] + 0.01 * gradient[j] ** 2
            step = 0.25 * (m[j] / (1 - 0.9**t)) / ((v[j] / (1 - 0.99**t)) ** 0.5 + 1e-8)
            if j < k:
                weight[j] -= step
            else:
                bias -= step
    return weight, bias


def test_op7_chain_against_a_plain_reference():
    """Models, folds and order of the chain: each category's model reads the out-of-fold probabilities of those before it."""
    rng = np.random.default_rng(9)
    n, columns = 160, 5
    x = (rng.random((n, columns)) < 0.25).astype(float)
    first, second = x[:, 0], ((x[:, 1] + x[:, 2] > 0) ^ (rng.random(n) < 0.05)).astype(float)
    labels = {"a": first, "b": second, "toxic": np.maximum(first, second)}
    owner, flat = np.nonzero(x)
    sample = toxicity.Sample(features=columns, folds=3)
    chain = toxicity.fit_chain(flat.astype(np.int64), owner.astype(np.int32), labels, sample)
    kept = sorted(chain.column, key=chain.column.get)
    dense, before = x[:, kept], np.zeros((n, 0))
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for model, label in zip(chain.models, labels.values()):
        weight, bias = _plain_logistic(np.hstack([dense, before]), label)
        assert np.allclose(model.weight, weight, atol=1e-6) and abs(model.bias - bias) < 1e-6
        out = np.zeros(n)
        for k in range(3):
            test = np.arange(n) % 3 == k
            w, c = _plain_logistic(np.hstack([dense, before])[~test], label[~test])
            out[test] = sigmoid(np.hstack([dense, before])[test] @ np.array(w) + c)
        before = np.column_stack([before, out])
    # scoring feeds the full models' own probabilities forward
    seen, p = dense, []
    for model in chain.models:
        p.append(sigmoid(seen @ model.weight + model.bias))
        seen = np.column_stack([seen, p[-1]])
    got = chain.score([np.flatnonzero(row).tolist() for row in x])
    assert len(kept) >= 3 and np.allclose(got, np.array(p).T, atol=1e-9)
    # the limit is the best F-measure of the last out-of-fold probabilities, precision counting twice
    order = np.argsort(-before[:, -1], kind="stable")
    f = [(1.25 * labels["toxic"][order[: k + 1]].sum()) / (k + 1 + 0.25 * labels["toxic"].sum()) for k in range(n)]
    assert before[order[int(np.argmax(f))], -1] >= chain.limit
