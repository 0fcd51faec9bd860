"""Nulls, empty and long texts, ties and repeated rows, empty tables, extra columns: every operator has a defined result."""

import zlib

import pytest
from pyspark.sql import functions as F

from netloom.llm import byte_bpe, chat_format, decontamination, exact_dedup, importance, ngram_join, resharding, sentencepiece_codec, token_store, toxicity, url_filter

LONG = "word " * 30_000 + "end"
ROWS = [(1, "a b c d e f g", "x"), (2, None, None), (3, "", "x"), (4, LONG, "y"), (5, "a  b\tc d e f g", "x"), (5, "a  b\tc d e f g", "x"), (None, "lonely text of five words", "z"), (7, "ünï ▁ 😀", "z"), (8, "   ", "z")]
#: Extra columns whose names the operators also use inside.
CLASH = "__key __doc __gone __old __block __start __file __new _old _block _file gone key_ d0 d1 size slot shard digest keep doc row text_crc32 kept norm ids bands sig n key chosen good label component tasks features scope __x".split()


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    return df.withColumns({c: F.lit("clash") for c in CLASH})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r)
    return out


def test_op1(docs, empty):
    rows, path, plan = resharding.reshard(docs, F.pmod(F.xxhash64("source"), F.lit(4)), 4, 6)
    got = rows.collect()
    assert len(got) == len(ROWS) and {r["shard"] for r in got} <= set(range(6))
    for s in range(6):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert {r["doc_id"]: r["size"] for r in got}[2] == 8
    rows, _, plan = resharding.reshard(empty, F.lit(None).cast("int"), 4, 6)
    assert rows.count() == 0 and plan.moved_bytes == 0


def test_op1_leaves_untouched_shards_alone(spark):
    df = spark.createDataFrame([(k, "x" * 92) for k in range(40)], "doc_id long, text string")
    rows, path, plan = resharding.reshard(df, (F.col("doc_id") % 2).cast("int"), 2, 2)
    assert plan.affected == set() and rows.groupBy("shard").count().count() == 2


def test_op1_one_source_holds_nearly_all(spark, monkeypatch):
    """Only the blocks of a large shard are cut into cells, so the table of places keeps its bound."""
    placed, kept = [], resharding.bounded_broadcast
    monkeypatch.setattr(resharding, "CELLS", 200)
    monkeypatch.setattr(resharding, "bounded_broadcast", lambda df, size: placed.append(df.count()) or kept(df, size))
    df = spark.range(6000).selectExpr("id AS doc_id", "repeat('x', cast(id % 90 AS INT)) AS text", "CASE WHEN id % 10 < 9 THEN 0 ELSE id % 16 END AS old")
    rows, path, plan = resharding.reshard(df, F.col("old"), 16, 24, blocks=8, file_bytes=1)
    got = rows.select("doc_id", "shard", "slot", "size").collect()
    assert placed[0] <= 200 + 16 * 8 and sorted(r["doc_id"] for r in got) == list(range(6000))
    slots, load = {}, {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
        load[r["shard"]] = load.get(r["shard"], 0) + r["size"]
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert len(spark.read.parquet(path).inputFiles()) > 50


def test_op1_moves_the_fewest_bytes():
    flow = resharding.min_cost_flow([10, 50, 0], [20, 20, 20], lambda i, j: int(i != j))
    assert sum(v for (i, j), v in flow.items() if i != j) == 30
    assert resharding.min_cost_flow([5, 5], [5, 5], lambda i, j: [[9, 1], [1, 9]][i][j]) == {(0, 1): 5, (1, 0): 5}
    plan = resharding.plan_blocks({(i, b): 100 + b for i in range(3) for b in range(50)}, 3, 5)
    load = [0] * 5
    for (i, b), j in plan.target.items():
        load[j] += 100 + b
    assert max(load) - min(load) <= 150


def test_op4(docs, empty):
    got = by_id(exact_dedup.exact_duplicates(docs))
    assert [r["keep_id"] for r in got[5]] == [1, 1] and got[1][0]["kept"] and got[1][0]["group_size"] == 3
    assert got[2][0]["kept"] and got[3][0]["keep_id"] == 2 and got[8][0]["group_size"] == 1
    assert got[None][0]["kept"]
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 4, 7, 8]
    assert exact_dedup.exact_duplicates(empty).count() == 0 and exact_dedup.drop_duplicates(empty).count() == 0
    index = exact_dedup.DedupIndex(docs.sparkSession)
    index.insert(docs)
    assert index.find("a b c d  e f g").count() == 3


def test_op4_repeated_rows_and_both_joins(docs):
    twice = docs.unionByName(docs)
    got = exact_dedup.exact_duplicates(twice, broadcast_limit=0)
    assert got.where("kept").count() == 6 and got.count() == 2 * len(ROWS)
    assert exact_dedup.drop_duplicates(twice).count() == 6


def test_op4_batches_are_looked_up_and_levels_merge(docs, spark):
    """Four inserts: what repeats between them is found through filters, and levels merge at the fan-out."""
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(100 + k, f"text {k % 20}") for k in range(60)], "doc_id long, text string"))
    parts = [rows.where(F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(4)) == k) for k in range(4)]
    index = exact_dedup.DedupIndex(spark, fanout=2, broadcast_limit=0)
    for part in parts:
        index.insert(part)
    assert [len(level) for level in index.levels] == [0, 0, 1]
    once = exact_dedup.DedupIndex(spark)
    once.insert(rows)
    key = lambda i: sorted((r["doc"] or -1, r["keep"] or -1, r["size"], r["kept"], r["sha"]) for r in i.groups().collect())
    hits = lambda i: {bytes(r["digest"]) for h in i.hits for r in h.collect()}
    assert hits(index) == hits(once) and key(index) == key(once)


def test_op4_query_goes_through_the_index(spark, monkeypatch):
    """On a table of one file the query inserts five batches, probes the filters of older ones and merges a level."""
    made = []
    kind = exact_dedup.DedupIndex
    monkeypatch.setattr(exact_dedup, "DedupIndex", lambda *a, **b: made.append(kind(*a, **b)) or made[-1])
    exact_dedup.op4_exact_dedup(spark, "/root/testdata/sf0.001")
    (index,) = made
    assert len(index.runs) == 5 and index.probes == 0 + 1 + 2 + 3 + 1 and index.merges == 2
    assert sum(r.count() for r in index.runs) == 200 and all(r.count() for r in index.runs)


def test_op4_weak_digests_cost_comparisons_only(docs):
    weak = exact_dedup.exact_duplicates(docs, digest=lambda x: F.unhex(F.lit("00")))
    key = lambda df: sorted(map(repr, df.collect()))
    assert key(weak) == key(exact_dedup.exact_duplicates(docs))


def test_op2(docs, empty):
    got = by_id(ngram_join.similar_documents(docs))
    assert {r["class_id"] for k in (1, 5) for r in got[k]} == {1} and got[1][0]["copies"] == 3 and got[1][0]["n_links"] == 0
    assert all(got[k][0]["class_id"] == k for k in (2, 3, 4, 8)) and got[None][0]["class_id"] is None
    assert ngram_join.similar_documents(empty).count() == 0
    kept = ngram_join.drop_similar(docs)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 2


def test_op3(docs, empty):
    got = by_id(importance.resample(docs, F.col("doc_id") < 3, 0.5))
    rows = [r for x in got.values() for r in x]
    assert len(rows) == len(ROWS) and got[2][0]["log_weight"] == 0
    assert sum(r["selected"] for r in rows) >= 5
    assert importance.resample(empty, F.lit(True), 0.5).count() == 0
    assert importance.resample(docs, F.lit(None).cast("boolean"), 0.0).where("selected").count() == 0
    assert importance.resample(docs, F.lit(True), 1.0).where("selected").count() == len(ROWS)


def test_op5(docs, empty, spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file("/opt/tokenizers/word_bpe_49k.json")
    root = token_store.write_store(docs.where("doc_id is not null"))
    got = sorted(token_store.document_facts(spark, root).collect(), key=lambda r: (r["doc_id"], r["start"]))
    at = 0
    for r, (i, text, _) in zip(got, sorted((x for x in ROWS if x[0]), key=lambda x: x[0])):
        ids = tok.encode(text or "", add_special_tokens=False).ids + [1]
        raw = b"".join(k.to_bytes(4, "little") for k in ids)
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, at, len(ids), zlib.crc32(raw))
        at += len(ids)
    whole = {r["start"]: r["ids"] for r in token_store.read_documents(spark, root).collect()}
    assert sum(len(x) for x in whole.values()) == at
    assert token_store.document_facts(spark, token_store.write_store(empty)).count() == 0


def test_op6(docs, empty, spark):
    bench = spark.createDataFrame([(1, "a b c d e f g", "q"), (2, None, "q"), (3, "", "q"), (4, "Ann has 5 apples and gives 3 kg of them to Bob today", "q")], "item_id long, text string, size string")
    got = decontamination.contaminated(docs, bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 1), (5, 1), (5, 1)]
    assert decontamination.contaminated(empty, bench).count() == 0 and decontamination.contaminated(docs, bench.where("false")).count() == 0
    kept = decontamination.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 3
    assert decontamination.drop_contaminated(empty, bench).count() == 0 and decontamination.drop_contaminated(docs, bench.where("false")).count() == len(ROWS)


def test_op7(docs, empty, spark):
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 1), (2, 0, None), (1, 1, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    chain = toxicity.train(docs, labels)
    got = toxicity.score(docs, chain)
    assert got.count() == len(ROWS) and got.columns == ["doc_id", "p_insult", "p_contempt", "p_toxic", "toxic"]
    assert toxicity.score(empty, chain).count() == 0
    assert toxicity.drop_toxic(docs, chain).columns == docs.columns
    nothing = toxicity.train(docs, labels.where("false"))
    assert toxicity.score(docs, nothing).where("toxic").count() == 0
    toxicity.train(empty, labels)


def test_op8(spark):
    urls = [(1, None), (2, ""), (3, "http://A.COM/Sex-hot?x"), (4, "x://porn.example"), (5, "no scheme"), (6, "http://foo.example.net/en/porn"), (7, "http://b.NET/q"), (7, "http://b.NET/q"), (8, "http://sexy.com/sextoys"), (9, "http://e.com/" + "a" * 100_000)]
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumns({c: F.lit(1) for c in ("host", "path", "rule", "verdict", "strict_hits")})
    got = {r["page_id"]: (r["host"], r["rule"], r["verdict"]) for r in url_filter.judge(pages).collect()}
    assert got[1] == got[2] == got[5] == ("", None, "allow")
    assert got[3] == ("a.com", None, "block") and got[4][2] == "block" and got[6] == ("foo.example.net", "example.net/en/", "allow")
    assert got[7] == ("b.net", "net/", "block") and got[8][2] == "allow"
    assert url_filter.judge(pages.where("false")).count() == 0


def test_op9(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>"), (2, 0, None, None), (2, 0, None, None), (3, 5, "assistant", "first"), (None, 0, "user", LONG), (4, 1, "user", "b"), (4, 0, "tool", "a")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("n", "segments", "role_fits")})
    got = {r["conv_id"]: r for r in chat_format.conversation_facts(chat_format.format_conversations(df)).collect()}
    assert (got[1]["n_turns"], got[1]["loss_chars"], got[1]["valid"]) == (2, 4, True)
    assert (got[2]["n_turns"], got[2]["valid"], got[2]["loss_chars"]) == (2, False, 0)
    assert not got[3]["valid"] and got[None]["n_turns"] == 1 and not got[4]["valid"]
    assert chat_format.conversation_facts(chat_format.format_conversations(df.where("false"))).count() == 0


def test_op10(docs, empty):
    got = by_id(sentencepiece_codec.encode_check(docs))
    assert got[2][0]["n_pieces"] == got[3][0]["n_pieces"] == 0 and all(r["round_trip"] for x in got.values() for r in x)
    assert len(got[5]) == 2 and sentencepiece_codec.encode_check(empty).count() == 0
    back = by_id(sentencepiece_codec.decode_documents(sentencepiece_codec.encode_documents(docs)))
    assert back[4][0]["text"] == LONG and back[7][0]["text"] == "ünï   😀" and back[2][0]["text"] == ""


def test_op11(docs, empty):
    got = by_id(byte_bpe.encode_check(docs))
    assert got[2][0]["n_tokens"] == got[3][0]["n_tokens"] == 0 and got[2][0]["ids_sha256"] == got[3][0]["decoded_sha256"]
    assert len(got[5]) == 2 and len(got[None]) == 1 and byte_bpe.encode_check(empty).count() == 0
    back = by_id(byte_bpe.decode_documents(byte_bpe.encode_documents(docs)))
    assert back[4][0]["text"] == LONG and back[7][0]["text"] == "ünï ▁ 😀" and back[2][0]["text"] == ""


def test_reshard_of_a_table_that_is_in_no_files_writes_every_row(spark):
    df = spark.range(300).selectExpr("id AS doc_id", "repeat('x', cast(id % 50 AS int)) AS text", "cast(id % 3 AS int) AS old").where("doc_id <> 7").unionByName(spark.sql("select 7L AS doc_id, cast(null AS string) AS text, 1 AS old"))
    rows, path, plan = resharding.reshard(df, F.col("old"), 3, 5, blocks=8, file_bytes=4000, landed=False)
    key = lambda r: (r["doc_id"], r["text"], r["size"], r["shard"], r["slot"])
    written = sorted(map(key, spark.read.parquet(path).collect()), key=repr)
    assert any(j == i for (i, _), j in plan.target.items())
    assert len(written) == 300 and written == sorted(map(key, rows.collect()), key=repr)
    same, _, _ = resharding.reshard(df, F.col("old"), 3, 5, blocks=8, file_bytes=4000)
    assert written == sorted(map(key, same.collect()), key=repr)
    # One shard that stays as it is, too.
    _, path, _ = resharding.reshard(df, F.lit(0), 1, 1, landed=False)
    assert spark.read.parquet(path).count() == 300
