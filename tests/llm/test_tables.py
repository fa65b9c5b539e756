"""URL filters, mixing, token rollups, the pipeline."""

import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from talkmill.llm import mixing, queries, token_counts, url_filter
from talkmill.llm.common import Scratch, shared_dir

FOLDER = "/root/testdata/sf0.001"


def judged(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [(len(h + (p or "")), len(h), a == "block", h + (p or ""), a) for h, p, a in rules if h is not None and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


URLS = [
    "http://www.Example.com/en/a?x#y", "https://example.com/en/", "https://example.com/en", "http://a.b.example.com/enx/1", "ftp://net/es/x", "x://y.net/fr/", "http://com/", "http://com?x", "http://notcom/", "http://", "://", "plain", "", None,
    "http://ÉX.com/ü/", "http://a.net/es//fr/", "http://u:p@example.com:80/en/", "http://.com/", "http://com./", "http://x.com/a\nb/c", "http://" + "s." * 60 + "net/fr/" + "d/" * 60, "http://www.example.com/en/a?x#y",
    "http://" + "a." * 120 + "net/fr/" + "x/" * 3000 + "?q",
]


@pytest.mark.parametrize("most", [0, 100])
def test_url_rules(spark, most):
    rules = [*url_filter.RULES, ("example.com", "/enx", "block"), ("a.net", "/es/", "allow"), ("a.net", "/es/", "block"), ("deep.example.com", "/en/", "block"), (None, "/", "block"), ("s.net", None, "block")]
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(URLS)] + [(None, URLS[0], "r")], "page_id long, url string, rule string")
    table = spark.createDataFrame(rules, "host string, path string, action string")
    got = url_filter.judge_urls(pages, table, broadcast_rules=most).collect()
    want = [(i, *judged(u, rules)) for i, u in enumerate(URLS)] + [(None, *judged(URLS[0], rules))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert url_filter.judge_urls(pages.limit(0), table).collect() == [] and url_filter.judge_urls(pages, table.limit(0)).where("rule is not null").collect() == []


def filled(sizes, weights, times=1.5, most=2.0):
    """Targets by rounds of sharing."""
    total, open_, target = times * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while True:
        w = sum(weights[i % len(weights)] for i in open_)
        level = (total - sum(most * sizes[i] for i in range(len(sizes)) if i not in open_)) / w if w else 0
        for i in range(len(sizes)):
            target[i] = level * weights[i % len(weights)] if i in open_ else most * sizes[i]
        over = {i for i in open_ if target[i] > most * sizes[i] + 1e-9}
        if not over:
            return target
        open_ -= over


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    names = sorted(rng.sample(["", "a", "Z", "é", "z", "src1", "src10", "src2", "😀"], 7)) + [None]
    sizes = [rng.choice([0, 1, 10, 1000, 50_000, rng.randint(1, 10**6)]) for _ in names]
    rows = list(zip(names, sizes))
    rng.shuffle(rows)
    got = {r.source: (r.s, r.target) for r in mixing.source_targets(spark.createDataFrame(rows, "source string, source_size long")).collect()}
    for i, (name, want) in enumerate(zip(names, filled(sizes, mixing.WEIGHTS))):
        assert got[name][0] == i and got[name][1] == pytest.approx(want)


@pytest.mark.parametrize("n", [1, 2, 7, 100, 1001])
def test_permutation(spark, n):
    rows = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3), F.lit(4)).alias("x")).collect()
    assert sorted(r.x for r in rows) == list(range(n))
    assert n < 100 or sum(i == r.x for i, r in enumerate(rows)) < n / 4


def mix_rows():
    rng = random.Random(11)
    rows = [(i, " ".join(f"d{i}.{k}" for k in range(rng.choice([0, 1, 5, 40, 300]))), rng.choice(["hot"] * 4 + ["b", "c", None]), "x") for i in range(160)]
    return [*rows, (500, None, "b", "x"), (501, " \n", None, "x"), (502, "\n ".join(f"e{k}" for k in range(3000)), "c", "x"), (7, *rows[7][1:])]


def test_mix(spark):
    rows = mix_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    packed, taken = mixing.mix_sources(df, block=16, slots=64)
    packed, taken = packed.cache(), taken.cache()
    # pack: each source's documents lie end to end
    streams = defaultdict(list)
    for r in packed.collect():
        streams[r.s].append(r)
    for rs in streams.values():
        at = 0
        for r in sorted(rs, key=lambda r: (r.bucket, r.row)):
            assert r.begin == at
            at += r.size
        assert at == rs[0].source_size
    assert sum(map(len, streams.values())) == len(rows)
    words, blocks = Counter(), defaultdict(set)
    for r in taken.collect():
        words[r.s] += r.words
        blocks[r.s, r["pass"], r.block].add((r.shard, r.slot))
    assert all(len(x) == 1 for x in blocks.values()) and max(p for _, p, _ in blocks) <= 1
    assert len({x for v in blocks.values() for x in v}) == len(blocks)
    for s, rs in streams.items():
        assert abs(words[s] - rs[0].target) <= 24
    # the counts of a shard vary as draws do
    counts = Counter((next(iter(x))[0], s) for (s, _, _), x in blocks.items())
    assert len(set(counts.values())) > 3
    again = mixing.mix_sources(df.repartition(7), block=16, slots=64)[1]
    assert again.exceptAll(taken).count() == 0 and taken.exceptAll(again).count() == 0


def test_mixed_documents(spark):
    rows = mix_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    got = mixing.mixed_documents(df, block=16).collect()
    count = Counter(w for r in got for w in r.text.split())
    assert max(count[w] for w in set(count) if not w.startswith("d7.")) <= 2 and all(r["size"] == "x" for r in got)
    whole = {r[0]: r[1] for r in rows}
    assert any(r.text == whole[r.doc_id] for r in got) and all(set(r.text.split()) <= set((whole[r.doc_id] or "").split()) for r in got)
    assert mixing.mixed_documents(df.limit(0)).collect() == []
    assert mixing.mixed_documents(df.where("doc_id in (500, 501)")).collect() == []


def test_rollup(spark):
    path = token_counts.public_model()
    rows = [(1, "a", "x", "Hello world"), (2, "a", "x", None), (3, None, None, "x " * 5000), (3, None, None, "x " * 5000), (4, "b", "x", "")]
    first = token_counts.counted(spark.createDataFrame(rows, "doc_id long, source string, lang string, text string"), {"v1": path}).cache()
    new = token_counts.counted(spark.createDataFrame([(1, "a", "x", "Hello")], "doc_id long, source string, lang string, text string"), {"v1": path})
    store = token_counts.TokenRollup(spark, f"{shared_dir(spark)}/rollup-test-{random.random()}")
    totals = lambda: {tuple(r[:3]): tuple(r[3:]) for r in store.totals().collect()}
    assert totals() == {}
    assert store.commit("load", token_counts.inserts(first)) and not store.commit("load", token_counts.inserts(first))
    size = token_counts.count_tokens(path)(["Hello world", "x " * 5000, "Hello"])
    assert totals() == {("a", "x", "v1"): (2, size[0], 11), (None, None, "v1"): (2, 2 * size[1], 20000), ("b", "x", "v1"): (1, 0, 0)}
    change = token_counts.revisions(first.where("doc_id = 1"), new)
    assert store.commit("revise", change) and not store.commit("revise", change)
    assert totals()["a", "x", "v1"] == (2, size[2], 5)
    store.compact()
    assert not store.commit("load", token_counts.inserts(first))
    store.vacuum()
    assert not store.commit("revise", change) and store.batches() == []
    assert store.commit("empty", token_counts.inserts(first.limit(0))) and not store.commit("empty", token_counts.inserts(first))
    assert store.commit("gone", token_counts.deletes(first.where("doc_id = 4")))
    assert totals() == {("a", "x", "v1"): (2, size[2], 5), (None, None, "v1"): (2, 2 * size[1], 20000)}


def test_compaction_after_a_vacuum_and_beside_commits(spark):
    row = lambda n: spark.createDataFrame([("a", "x", "v", n, 1)], "source string, lang string, version string, tokens long, chars long")
    store = token_counts.TokenRollup(spark, f"{shared_dir(spark)}/rollup-test-{random.random()}")
    tokens = lambda: store.totals().collect()[0].tokens
    assert store.commit("b0", token_counts.inserts(row(1))) and store.compact()
    assert store.commit("b1", token_counts.inserts(row(10))) and store.compact()
    store.vacuum()
    assert store.batches() == [] and tokens() == 11
    assert store.commit("b2", token_counts.inserts(row(100)))
    listed, sums = store.batches, store._sums

    def meanwhile(*known):  # a batch is committed after compaction has listed what it holds
        store._sums = sums
        assert store.commit("b3", token_counts.inserts(row(1000)))
        return sums(*known)

    store._sums = meanwhile
    assert store.compact() and listed() == ["b2", "b3"] and tokens() == 1111
    store.vacuum()
    assert store.batches() == ["b3"] and tokens() == 1111 and store.compact()
    store.vacuum()
    assert tokens() == 1111 and not any(store.commit(f"b{i}", token_counts.inserts(row(5))) for i in range(4))
    assert store.compact()
    before = store._base
    store._base = lambda: (before()[0] - 1, before()[1])  # another compaction came first
    assert not store.compact()
    store._base = before
    assert tokens() == 1111


def test_token_changes_against_brute_force(spark):
    import public_tokenizers

    texts = ["a b\na b\nc", "Hello world", None, "", "x\nx", "one\ntwo"]
    rows = [(i if i % 4 else None, f"s{i % 2}" if i % 5 else None, "en", texts[i % len(texts)]) for i in range(24)]
    rows += [(7, "s1", "en", "own text"), (7, "s1", "en", "d\nd"), (None, "s0", "en", "q\nq"), (None, "s0", "en", "q\nq")]
    labels = [(7, 0), (9, 0), (9, 0), (10, 1), (None, 0), (11, None)]
    versions = {"p": token_counts.public_model(), "b": public_tokenizers.path("byte_bpe_50k.tiktoken")}
    bad = {7, 9}
    want = {}
    for i, source, lang, text in rows:
        if i in bad:
            continue
        once = "\n".join(dict.fromkeys((text or "").split("\n")))
        for v, path in versions.items():
            t = want.setdefault((source, lang, v), [0, 0, 0])
            for k, x in enumerate((1, token_counts.count_tokens(path)([once])[0], len(once))):
                t[k] += x
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, text string")
    scratch = Scratch(spark)
    changes = token_counts.changes_of(docs, spark.createDataFrame(labels, "doc_id long, quality int"), versions, scratch)
    store = token_counts.TokenRollup(spark, f"{shared_dir(spark)}/rollup-test-{random.random()}")
    for name in ("load", "revise", "revise", "retire"):
        store.commit(name, changes[name])
    scratch.clear()
    assert {tuple(r[:3]): list(r[3:]) for r in store.totals().collect()} == want


def test_counters_agree_with_their_libraries():
    import public_tokenizers

    for name in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json"):
        count = token_counts.count_tokens(public_tokenizers.path(name))
        assert count(["", "Hello world", "<|endoftext|>"])[:2] == [0, 2]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_registered_queries_and_pipeline(spark):
    import corpus_pipeline

    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    wide = docs.withColumn("size", F.lit("x")).withColumn("kept", F.lit(1))
    odd = spark.createDataFrame([(9001, None, None, None, None, "x", 1), (9002, "", "en", "src0", 0, "x", 1), (None, "a null id with enough words to pass all of the quality rules here", "en", None, 5, "x", 1)], wide.schema)
    at = wide.unionByName(odd)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, at, FOLDER)
        if k + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == wide.columns, name
        path = f"{shared_dir(spark)}/pipeline-test-{random.random()}"
        out.write.parquet(path)
        at = spark.read.parquet(path)
        assert at.count() > 50, name
    assert at.where("n_tokens <> size(ends)").count() == 0
