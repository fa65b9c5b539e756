"""N-gram join, line dedup and components against brute force."""

import os
import random
import time
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkmill.llm import edit_distance, line_dedup, ngram_join
from talkmill.llm.common import Scratch, words_of
from talkmill.llm.components import connected

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string"


def brute(rows, width, percent):
    sets = []
    for _, text in rows:
        w = words_of((text or "").encode().lower().decode())
        sets.append(set(zip(*[w[i:] for i in range(min(width, len(w)))])) if w else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if o and rows[i][0] is not None and rows[j][0] is not None and 100 * o >= percent * (len(sets[i]) + len(sets[j]) - o):
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return sorted(((k, len(sets[i]), least.get(find(i))) for i, (k, _) in enumerate(rows)), key=str)


def group(rng, words, copies, edits):
    base = [rng.choice(words) for _ in range(60)]
    out = [" ".join(base)]
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            at = rng.randrange(len(w))
            w[at : at + 1] = rng.choice([[], [rng.choice(words[:30])], [w[at], rng.choice(words[:30])]])
        out.append(" ".join(w))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = group(rng, words, 90, 4) + group(rng, words, 40, 2) + [" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(60)]
    shared = " ".join(rng.choice(words) for _ in range(30))
    texts += [shared + " " + " ".join(rng.choice(words) for _ in range(rng.randint(0, 12))) for _ in range(40)]
    texts += texts[:10] + [None, "", " \n", "one", "One", "a b c", "A b c", "é É", "x " * 400, "x " * 300]
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, texts[0]), (None, None)]
    return rows


@pytest.mark.parametrize(("seed", "width", "percent"), [(1, 4, 85), (2, 5, 80)])
def test_ngram_join(spark, seed, width, percent):
    rows = corpus(seed)
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], DOCS).repartition(5)
    got = ngram_join.jaccard_components(df.withColumnRenamed("lang", "cid"), width=width, percent=percent).collect()
    want = brute(rows, width, percent)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want
    assert len({w[2] for w in want}) < 0.7 * len(rows)


def test_ngram_join_of_nothing(spark):
    assert ngram_join.jaccard_components(spark.createDataFrame([], DOCS)).collect() == []


def test_components_of_chains_and_stars(spark):
    rng = random.Random(5)
    ids = list(range(200))
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 150)] + [(149, 160), (160, 7)] + [(5, 5)]
    rng.shuffle(links)
    got = {r.id: r.comp for r in connected(spark.createDataFrame(links, "a long, b long"), Scratch(spark)).collect()}
    assert got == {i: 0 for i in ids if i <= 60 or 100 <= i < 150 or i == 160}
    assert connected(spark.createDataFrame([], "a long, b long"), Scratch(spark)).collect() == []


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_edit_distance():
    rng = random.Random(0)
    for _ in range(1200):
        a, b = ("".join(rng.choice("ab c") for _ in range(rng.choice([0, 1, 5, 11, 63, 64, 65, 130]))) for _ in range(2))
        true = levenshtein(a, b)
        assert edit_distance.edit_distance(a, b) == true <= edit_distance.by_words(a, b, 10**6)
        for most in (3, 30, 60):
            got = edit_distance.edit_distance(a, b, most)
            assert got == true or min(got, true) > most
        assert edit_distance.similar(a, b, 60) == (100 * (max(len(a), len(b)) - true) >= 60 * max(len(a), len(b)))
    assert edit_distance.edit_distance("a" * 20000 + "x" + "b" * 20000, "a" * 20000 + "yy" + "b" * 20000) == 2
    long = " ".join(str(i * 7919 % 10007) for i in range(3000))
    assert edit_distance.similar(long, long.replace("77", "x"), 80) and not edit_distance.similar(long, long[::-1], 80)


LONG = "the quick brown fox jumps over the lazy dog near the river bank while many small birds sing in the tall old trees at dawn and the sun comes up over hills far away"


def test_line_dedup(spark):
    near = LONG.replace("lazy", "lazzy")
    rows = [
        (1, f"{LONG}\nshort line\nshort line"), (2, f"alpha beta gamma delta epsilon\n{LONG.upper()}!\nshort line"), (3, near), (4, None), (5, ""), (6, "tail of text that is its own\n\n" + LONG + "\n"),
        (None, LONG), (7, "\n".join(f"{i} only here is line number {i * 7919}" for i in range(300))), (8, f"{LONG}\n{LONG}"), (8, f"{LONG}\n{LONG}"),
    ]
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, n_lines string")
    got = {(r.doc_id, r.n_lines): (r.text, r.n_removed) for r in line_dedup.dedup_lines(df, percent=90).collect()}
    assert got[1, 3] == (f"{LONG}\nshort line", 1)  # a short line goes as an exact repeat
    assert got[2, 3] == ("alpha beta gamma delta epsilon", 2)
    assert got[3, 1] == ("", 1)
    assert got[4, 0] == (None, 0) and got[5, 1] == ("", 0)
    assert got[6, 4] == ("tail of text that is its own\n\n", 1)
    assert got[None, 1] == ("", 1) and got[8, 2] == ("", 2)
    assert got[7, 300] == (rows[7][1], 0)
    left = line_dedup.dedup_lines(df, percent=90, drop_emptied=True).collect()
    assert sorted((r.doc_id for r in left), key=str) == sorted([1, 2, 4, 5, 6, 7], key=str)
    assert line_dedup.dedup_lines(df.limit(0)).collect() == []


def test_line_dedup_of_a_group_of_near_copies(spark):
    rng = random.Random(3)
    words = LONG.split()
    texts = []
    for _ in range(60):
        w = list(words)
        w[rng.randrange(len(w))] = rng.choice(["sky", "sea", "stone"])
        texts.append(" ".join(w))
    df = spark.createDataFrame([(i, t) for i, t in enumerate([LONG, *texts])], "doc_id long, text string")
    out = line_dedup.dedup_lines(df)
    assert out.where("text <> ''").count() <= 3 and out.where("doc_id = 0 and text <> ''").count() == 1


def test_line_dedup_meets_lines_that_differ_in_whole_words(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9)))
    pairs = []
    for n in (5, 6, 10, 20, 50):
        for _ in range(60):
            a = [word() for _ in range(n)]
            b = list(a)
            for i in rng.sample(range(n), max(1, n // 7)):
                b[i] = word()
            a, b = " ".join(a), " ".join(b)
            pairs.append((a, b, 100 * (max(len(a), len(b)) - levenshtein(a, b)) >= 80 * max(len(a), len(b))))
    df = spark.createDataFrame([(2 * i + k, p[k]) for i, p in enumerate(pairs) for k in (0, 1)], "doc_id long, text string")
    gone = {r.doc_id for r in line_dedup.dedup_lines(df).where("n_removed > 0").collect()}
    true = {2 * i + 1 for i, (_, _, like) in enumerate(pairs) if like}
    assert gone <= true and len(true) > 200 and len(gone) >= 0.97 * len(true)


def test_line_dedup_keeps_documents_with_short_lines(spark):
    rows = [(1, LONG), (2, f"{LONG}\nmilk and eggs\nbread"), (3, f"{LONG}\n -- \n"), (4, f"{LONG}\n\u4eca\u65e5\u306f\u3044\u3044\u5929\u6c17"), (5, "\u2026"), (6, LONG)]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), drop_emptied=True).collect()
    assert {r.doc_id: r.text for r in out} == {1: LONG, 2: "milk and eggs\nbread", 4: rows[3][1].split("\n")[1], 5: "\u2026"}


def in_one_list(count, seed):
    """(a line, a near copy of it) so many times, all unlike: their one long word is the same, so all meet in the same lists and
    nowhere else."""
    rng = random.Random(seed)
    lines = ["all standing for " + " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=4)) for _ in range(12)) for _ in range(count)]
    return [(x, x[:-1] + "0") for x in lines]


def test_line_dedup_lists_hold_all_classes_of_a_frequent_key(spark):
    lines = [x for k in (0, 1) for x in [p[k] for p in in_one_list(100, 7)]]
    rows = spark.sparkContext.parallelize([(i, i, x) for i, x in enumerate(lines)], 2).toDF("id long, th long, text string")
    found = line_dedup.unpacked(line_dedup.packed_lines(rows, line_dedup.LEAST_WORDS, 4), 4, 80)
    members = {r.key: r.n for r in found.where("kind = 2").groupBy("key").agg(F.countDistinct("h").alias("n")).collect()}
    assert members and set(members.values()) == {200}


@pytest.mark.parametrize("part", [line_dedup.PART, 800])
def test_line_dedup_compares_large_lists_whole(spark, monkeypatch, part):
    monkeypatch.setattr(line_dedup, "PART", part)
    pairs = in_one_list(40, 8)
    df = spark.createDataFrame([(i + 1000 * k, p[k]) for i, p in enumerate(pairs) for k in (0, 1)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(df).collect()}
    assert got == {i + 1000 * k: k for i in range(40) for k in (0, 1)}


def test_line_dedup_makes_its_lists_in_rounds(spark):
    lines = [x for k in (0, 1) for x in [p[k] for p in in_one_list(100, 9)]]
    rows = spark.sparkContext.parallelize([(i, i, x) for i, x in enumerate(lines)], 2).toDF("id long, th long, text string")
    packed = line_dedup.packed_lines(rows, line_dedup.LEAST_WORDS, 4).cache()
    kinds = lambda found: {tuple(r) for r in found.where("kind >= 2").select("kind", "key", "p", "h", "sim").collect()}
    parts = [kinds(line_dedup.unpacked(packed.where("kind = 2"), 4, 80, nth)) for nth in range(line_dedup.ROUNDS)]
    listed = [{x[1] for x in part} - {None} for part in parts]
    assert sum(map(len, listed)) == len(set().union(*listed)) and sum(map(bool, listed)) > 1
    assert set().union(*parts) == kinds(line_dedup.unpacked(packed, 4, 80))
    packed.unpersist()


def test_line_dedup_compares_large_lists_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "ROUND_CHARS", 1000)
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", 0)
    pairs = in_one_list(40, 10)
    df = spark.createDataFrame([(i + 1000 * k, p[k]) for i, p in enumerate(pairs) for k in (0, 1)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(df).collect()}
    assert got == {i + 1000 * k: k for i in range(40) for k in (0, 1)}


def test_shuffle_files_go_at_release(spark):
    jvm, scratch = spark._jvm, Scratch(spark)
    files = lambda: {f.getName() for f in jvm.scala.jdk.javaapi.CollectionConverters.asJava(jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    before = files()
    kept = scratch.keep(spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count())
    assert files() - before
    scratch.release()
    for _ in range(20):
        if not files() - before:
            break
        time.sleep(0.25)
    assert not files() - before
    scratch.drop(kept)


def test_unlike_lines_are_told_many_at_once():
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcd\u00e9\u4e2d", k=rng.randint(1, 6)))
    lines = []
    for n in (1, 3, 12, 30, 80, 600):
        for _ in range(8):
            w = [word() for _ in range(n)]
            lines.append(" ".join(w))
            for share in (0.05, 0.2, 0.4):
                lines.append(" ".join(word() if rng.random() < share else x for x in w))
    a, b = np.array([(i, j) for i in range(len(lines)) for j in range(len(lines)) if i // 32 == j // 32]).T
    for percent in (60, 80):
        true = np.array([edit_distance.similar(lines[i], lines[j], percent) for i, j in zip(a, b)])
        coded = edit_distance.Lines(lines)
        unlike = coded.unlike(a, b, percent, 100)
        assert not (unlike & true).any() and unlike.sum() > 0.5 * (~true).sum() and (true & (a != b)).sum() > 50
        assert (coded.similar(a, b, percent) == true).all()


def test_pairs_of_lines_are_decided_many_at_once():
    """Without a look at each: bands of all widths, few and many pairs, edits up to what is allowed and beyond."""
    rng = random.Random(6)
    lines = []
    for n in (1, 5, 63, 64, 65, 319, 320, 640, 1000, 1999):
        lines.append("".join(rng.choices("abcdefgh ", k=n)))
        for share in (0.02, 0.15, 0.2, 0.21, 0.4):
            x = list(lines[len(lines) // 6 * 6])
            for i in rng.sample(range(n), int(n * share)):
                x[i] = rng.choice(["", x[i] + "z", "y"])
            lines.append("".join(x)[:2000] or "a")
    a, b = np.array([(i, j) for i in range(len(lines)) for j in range(len(lines)) if abs(i - j) < 12]).T
    coded = edit_distance.Lines(lines)
    for percent in (60, 80):
        true = np.array([edit_distance.similar(lines[i], lines[j], percent) for i, j in zip(a, b)])
        assert (coded.unlike(a, b, percent, 50) == ~true).all() and (true & (a != b)).sum() > 60
        assert all((x == true).all() for likely in (False, True) for x in coded.told(a, b, percent, likely))


def test_normal_forms_are_those_of_the_words():
    rng = random.Random(9)
    for _ in range(2000):
        text = "".join(rng.choices("aZ_9 \n\t\r\x1c.-'\u00e9\u00c9\u0130\u03a3\u4e2d\u0301\u00a0\u2028\ud800\u00b2\x00", k=rng.randint(0, 40)))
        text = text if rng.random() < 0.5 else "".join(c for c in text if c.isascii() or c.isalpha())
        want = [(i, " ".join(words).encode("utf-8", "surrogatepass")) for i, words in line_dedup.normal_lines(text)]
        assert line_dedup.normal_forms(text) == want
        if want:
            h, sizes = line_dedup.word_hashes([x for _, x in want])
            words = [w for _, x in want for w in x.split(b" ")]
            assert sizes.sum() == len(h) == len(words) and len(set(zip(words, h.tolist()))) == len(set(words)) == len(set(h.tolist()))
            assert [int(x) & 1 for x in h] == [len(w.decode("utf-8", "surrogatepass")) >= line_dedup.LONG for w in words]


def test_blocks_find_all_within_reach():
    rng = random.Random(1)
    edges = [64 * i // line_dedup.BLOCKS for i in range(line_dedup.BLOCKS + 1)]
    for _ in range(300):
        bits = rng.sample(range(64), line_dedup.BLOCKS - line_dedup.AGREE)
        whole = [all(not lo <= b < hi for b in bits) for lo, hi in zip(edges, edges[1:])]
        assert sum(whole) >= line_dedup.AGREE


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
def test_line_dedup_against_brute_force(spark):
    """On real lines: nothing goes without a link, and nearly all links between lines that share two words in a row are found."""
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    rng = random.Random(2)
    some = [x for _, t in docs for x in t.split("\n") if len(x.split()) > 4]
    extra = []
    for x in rng.sample(some, 150):  # near copies by whole words
        w = x.split()
        for i in rng.sample(range(len(w)), max(1, len(w) // 9)):
            w[i] = "".join(rng.choices("abcdefgh", k=len(w[i])))
        extra.append(" ".join(w))
    docs += [(10**6 + i, "\n".join(extra[i : i + 5])) for i in range(0, 150, 5)]
    places = [(d, i, words) for d, t in docs for i, words in line_dedup.normal_lines(t)]
    forms = sorted({" ".join(w) for _, _, w in places if len(w) >= line_dedup.LEAST_WORDS})
    runs = defaultdict(set)
    for k, x in enumerate(forms):
        w = x.split(" ")
        for run in zip(w, w[1:]):
            runs[run].add(k)
    links = [(a, b) for a, b in {p for m in runs.values() for p in combinations(sorted(m), 2)} if edit_distance.similar(forms[a], forms[b], 80)]
    parent = list(range(len(forms)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    at = {x: k for k, x in enumerate(forms)}
    group = [find(at[x]) if (x := " ".join(w)) in at else x for _, _, w in places]
    first = {}
    for k in sorted(range(len(places)), key=lambda k: places[k][:2]):
        first.setdefault(group[k], places[k][:2])
    want = {places[k][:2] for k in range(len(places)) if first[group[k]] != places[k][:2]}
    gone = {}
    for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(6)).collect():
        gone[r.doc_id] = (r.text.split("\n"), r.n_removed)
    lost = set()
    for d, t in docs:  # which places of a document are left, in order
        left, j = gone[d][0], 0
        cut = t.split("\n")
        drop = [i for i in range(len(cut)) if (d, i) in want]
        if gone[d][1] == len(drop):
            assert left == [x for i, x in enumerate(cut) if i not in set(drop)] or left == [""]
            lost.update((d, i) for i in drop)
        else:
            assert gone[d][1] < len(drop)  # nothing goes that has no link
            for i, x in enumerate(cut):
                if j < len(left) and left[j] == x:
                    j += 1
                else:
                    lost.add((d, i))
    exact = {places[k][:2] for k in range(len(places)) if places[k][:2] in want and any(" ".join(places[k][2]) == " ".join(w) for _, _, w in places[:k])}
    assert lost <= want and exact <= lost and len(links) >= 150
    assert len(lost - exact) >= 0.97 * len(want - exact), (len(lost - exact), len(want - exact))
