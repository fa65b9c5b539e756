"""The pipeline's stages, each against brute force on its own input."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import sentencepiece
from pyspark.sql import functions as F

from talkmill.llm import edit_distance, quality_rules, sentencepiece_codec
from talkmill.llm.common import words_of

corpus_pipeline = pytest.importorskip("corpus_pipeline")
STAGES = dict(corpus_pipeline.STAGES)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, kept string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "own", f"k{i}") for i, t, s in rows], SCHEMA).repartition(3)


def text(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(n))


def texts(df):
    assert df.columns == [f.split()[0] for f in SCHEMA.split(", ")]
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def own_score(forest, point):
    """Path lengths by walking each tree."""
    total = 0.0
    for feature, cut, child, length in forest.trees:
        node = 0
        while feature[node] >= 0:
            node = child[node] + int(point[feature[node]] > cut[node])
        total += length[node]
    return 2.0 ** (-(total / len(forest.trees)) / float(quality_rules.path_constant(forest.size)))


def test_forest_and_threshold_by_definition():
    rng = np.random.default_rng(3)
    points = rng.normal(size=(400, 3))
    forest = quality_rules.IsolationForest(points, trees=30, leaf_sample=64)
    some = np.concatenate([points[:40], rng.normal(size=(10, 3)) * 9])
    assert forest.score(some) == pytest.approx([own_score(forest, p) for p in some])
    assert forest.score(some)[40:].mean() > forest.score(some)[:40].mean()
    bins = pd.DataFrame([(b, good, int(rng.integers(1, 50))) for b in range(0, 2000, 100) for good in (True, False)], columns=["bin", "good", "n"])
    for most in (0.0, 0.05, 0.3, 1.0):
        got = round(quality_rules.best_threshold(bins, most) * quality_rules.BINS)
        share = lambda t, good: bins[(bins.good == good) & (bins.bin >= t)].n.sum() / bins[bins.good == good].n.sum()
        fits = [t for t in range(quality_rules.BINS + 1) if share(t, True) <= most]
        best = max(share(t, False) - share(t, True) for t in fits)
        if best > 0:
            assert share(got, True) <= most and share(got, False) - share(got, True) == pytest.approx(best)
        else:
            assert got > quality_rules.BINS


def test_quality_stage(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, text(rng, 50), "a") for i in range(120)] + [(200 + i, " ".join(w + "##" for w in text(rng, 50).split()), "b") for i in range(20)]
    rows += [(300, "few words", "a"), (301, None, "a"), (302, "", None), (303, "again and again it says " * 30, "a"), (None, text(rng, 40), "a"), (5, rows[5][1], "a")]
    labels = [(i, int(i < 200), 0) for i in [*range(0, 120, 2), *range(200, 220, 2)]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    got = texts(STAGES["quality_rules"](spark, frame(spark, rows), f"file://{tmp_path}"))
    # the same forest and threshold, by hand
    stats = {t: quality_rules.statistics(t) for _, t, _ in rows}
    failed = {t for t, (c, _) in stats.items() if c[0] < 10 or 100 * c[4] > 20 * c[0]}
    good = {i for i, q, _ in labels if q}
    known = [(i, t) for i, t, _ in rows for j, _, _ in labels if i == j and t not in failed]
    fitted = spark.createDataFrame([(i, *stats[t][1]) for i, t in known if i in good], "i long, symbols double, upper double, marks double, word_length double")
    points = np.array([tuple(r)[1:] for r in fitted.orderBy(F.xxhash64(F.lit(quality_rules.SEED), "i"), *quality_rules.SHARES).collect()])
    forest = quality_rules.IsolationForest(points)
    score = {t: own_score(forest, stats[t][1]) for t in stats}
    bins = Counter((int(score[t] * quality_rules.BINS), i in good) for i, t in known)
    threshold = round(quality_rules.best_threshold(pd.DataFrame([(b, g, n) for (b, g), n in sorted(bins.items())], columns=["bin", "good", "n"])) * quality_rules.BINS)
    want = sorted(((i, t) for i, t, _ in rows if t not in failed and int(score[t] * quality_rules.BINS) < threshold), key=str)
    assert got == want and sum(i is not None and i >= 200 for i, _ in got) <= 2 and sum(i is None or i < 200 for i, _ in got) >= 120


def test_line_stage(spark):
    rng = random.Random(2)
    lines = [text(rng, rng.randint(5, 25)) for _ in range(60)] + ["short one", "- - -", "x"]
    near = []
    for x in lines[:25]:
        w = x.split()
        w[rng.randrange(len(w))] = "changed"
        near.append(" ".join(w))
    pool = lines + near
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(0, 6))), "a") for i in range(60)] + [(70, None, "a"), (71, "", "a"), (72, "x", "a"), (None, lines[0], "a")]
    normal = lambda x: " ".join(re.findall(r"\w+", x.lower()))
    forms = sorted({normal(x) for x in pool if normal(x)})
    parent = {x: x for x in forms}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(forms):
        for b in forms[:k]:
            if min(len(a.split()), len(b.split())) >= 5 and edit_distance.similar(a, b, 80):
                parent[find(a)] = find(b)
    seen, want = set(), []
    for i, t, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        left = []
        for x in (t or "").split("\n"):
            if not normal(x) or find(normal(x)) not in seen:
                left.append(x)
                seen.update([find(normal(x))] if normal(x) else [])
        new = None if t is None else "\n".join(left)
        if t is None or len(left) == len(t.split("\n")) or normal(new):
            want.append((i, new))
    got = STAGES["line_dedup"](spark, frame(spark, rows), "")
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.collect())
    assert texts(got) == sorted(want, key=str)


def test_near_duplicate_stage(spark):
    rng = random.Random(3)
    base = [text(rng, rng.randint(3, 60)) for _ in range(30)]
    rows = [(k, t, "a") for k, t in enumerate(base)]
    for k in range(40):
        w = rng.choice(base).split()
        w[rng.randrange(len(w))] = rng.choice(["new", w[0]])
        rows.append((100 + k, " ".join(w), "b"))
    rows += [(200, None, "a"), (201, "", "a"), (202, base[0].upper(), "a"), (203, base[0], "a"), (203, base[0], "a"), (None, base[1], "a"), (None, base[1], "a")]
    sets = {}
    for k, (_, t, _) in enumerate(rows):
        w = words_of((t or "").lower())
        sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in range(a):
            o = len(sets[a] & sets[b])
            if o and None not in (rows[a][0], rows[b][0]) and 100 * o >= 80 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[find(k)].append(i)
    want = sorted({(i, t) for k, (i, t, _) in enumerate(rows) if i is not None and i == min(least[find(k)])}, key=str)
    got = texts(STAGES["ngram_join"](spark, frame(spark, rows), ""))
    assert [x for x in got if x[0] is not None] == want and len(got) == len(want) + 2


def test_mix_stage(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(f"d{i}.{k}" for k in range(rng.randint(0, 900))), ["a", "b", "c", None][i % 4 if i % 3 else 0]) for i in range(150)] + [(500, None, "a"), (501, "", "b")]
    got = STAGES["mix_sources"](spark, frame(spark, rows), "")
    assert got.columns == [f.split()[0] for f in SCHEMA.split(", ")]
    own, source = {i: (t or "").split() for i, t, _ in rows}, {i: s for i, _, s in rows}
    taken, sizes = Counter(), Counter()
    words = Counter()
    for i, w in own.items():
        sizes[source[i]] += len(w)
    for r in got.collect():
        w = r.text.split()
        assert r.n_chars == len(r.text) and r.kept == f"k{r.doc_id}" and r.source == source[r.doc_id]
        at = {x: k for k, x in enumerate(own[r.doc_id])}
        assert [at[x] for x in w] == sorted(at[x] for x in w)  # in text order
        taken[r.source] += len(w)
        words.update(w)
    assert max(words.values()) <= 2
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = dict(zip(names, [3.0, 1.0, 2.0, 3.0]))
    total, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while True:
        level = (total - sum(2 * sizes[s] for s in names if s not in open_)) / sum(weights[s] for s in open_)
        target = {s: level * weights[s] if s in open_ else 2.0 * sizes[s] for s in names}
        over = {s for s in open_ if target[s] > 2 * sizes[s] + 1e-9}
        if not over:
            break
        open_ -= over
    assert all(abs(taken[s] - target[s]) <= 128 for s in names)


def test_encode_stage(spark):
    rows = [(1, "Hello  wörld\n\nagain", "a"), (2, None, "a"), (3, "", "b"), (4, "日本 x " * 500, None)]
    lib = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.public_model())
    got = {r.doc_id: r for r in STAGES["sentencepiece"](spark, frame(spark, rows), "").collect()}
    for i, t, s in rows:
        r = got[i]
        assert r.ids == lib.encode(t or "") and r.n_tokens == len(r.ids) == len(r.ends) and r.source == s
        assert r.ends == sorted(r.ends) and (not r.ends or r.ends[-1] == len((t or "").encode()))
    for name in STAGES:  # tables without rows stay without rows
        if name != "quality_rules":
            assert STAGES[name](spark, frame(spark, rows).limit(0), "").collect() == []
