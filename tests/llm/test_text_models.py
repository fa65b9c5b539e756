"""SentencePiece, language ID, order MinHash, quality rules, Katz."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from talkmill.llm import katz, language_id, order_minhash, quality_rules, sentencepiece_codec
from talkmill.llm.common import shared_dir, words_of

SAMPLES = [
    "", " ", "  a", "a  b   c ", "Hello world", "line\nnext\n\nlast", "\n", " \n ", "tab\tand▁meta ▁", "über naïve café", "日本語 テスト", "😀😀 x", "a\x00b", "<s> </s> <0x0A>", "  spaces", "\r\nx", "word " * 3000, None,
]


def test_words():
    odd = "a\u00a0b\u2003c\x1cd\te\x0bf\x85g"
    assert words_of(odd) == ["a\u00a0b\u2003c\x1cd", "e", "f\x85g"] and words_of(" \n") == [] and words_of(None) == []


def test_pieces_are_the_librarys_and_spans_cover():
    m = sentencepiece_codec.model(sentencepiece_codec.public_model())
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "a", "the", "The", "é", "\t", "▁", "😀", "\u3000", "\r\n", ".", "über", "   ", "x", "\x00", "!!", "12"]
    texts = [t or "" for t in SAMPLES] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    for at in range(0, len(texts), 50):
        some = texts[at : at + 50]
        ids, starts, ends, where = m.encode(some)
        for k, t in enumerate(some):
            a, b = where[k], where[k + 1]
            assert ids[a:b].tolist() == m.lib.encode(t)
            same, s, e = m.spans(t, ids[a:b].tolist())
            assert same == ids[a:b].tolist() and s.tolist() == starts[a:b].tolist() and e.tolist() == ends[a:b].tolist()
            if b > a:
                assert starts[a] == 0 and ends[b - 1] == len(t.encode()) and starts[a + 1 : b].tolist() == ends[a : b - 1].tolist()


def trie(pairs):
    """A compiled character map, built from the public double-array format."""
    nodes = [{}]
    value = [None]
    strings, at = b"", {}
    for key, to in pairs.items():
        if to not in at:
            at[to] = len(strings)
            strings += to.encode() + b"\0"
        n = 0
        for b in key.encode():
            if b not in nodes[n]:
                nodes[n][b] = len(nodes)
                nodes.append({})
                value.append(None)
            n = nodes[n][b]
        value[n] = at[to]
    units = [0] * 256 * (len(nodes) + 1)
    used = {0}

    def place(n, pos):
        labels = sorted(nodes[n]) + ([0] if value[n] is not None else [])
        offset = next(o for o in range(256, len(units) - 256) if all((pos ^ o ^ c) not in used and 0 < (pos ^ o ^ c) < len(units) for c in labels) and o < 1 << 21) if labels else 0
        units[pos] |= offset << 10 | (1 << 8 if value[n] is not None else 0)
        for c in labels:
            used.add(pos ^ offset ^ c)
        if value[n] is not None:
            units[pos ^ offset] = value[n] | 1 << 31
        for c in sorted(nodes[n]):
            units[pos ^ offset ^ c] |= c
            place(nodes[n][c], pos ^ offset ^ c)

    place(0, 0)
    blob = b"".join(u.to_bytes(4, "little") for u in units)
    return len(blob).to_bytes(4, "little") + blob + strings


def test_longest_prefix_of_the_character_map():
    m = object.__new__(sentencepiece_codec.Model)
    m.map = sentencepiece_codec.CharsMap(trie({"ﬁ": "fi", "a": "A", "ab": "X", "\u3000": " ", "é": "e"}))
    m.dummy, m.squeeze, m.escape, m.suffix, m.users = True, True, True, False, []
    assert m.map.longest("abc".encode(), 0) == (2, b"X") and m.map.longest(b"b", 0) is None
    text = "  ab\u3000 éaﬁz "
    data, source = m.normalize(text)
    assert data.decode() == "▁X▁eAfiz"
    raw = text.encode()
    spans = {data[i : i + 1]: raw[source[i] : source[i + 1]].decode() for i in (3, 7)}
    assert spans[b"X"] == "ab" and spans[b"e"] == "é"
    assert len(source) == len(data) + 1 and (np.diff(source) >= 0).all()


def test_encode_and_decode_table(spark):
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(SAMPLES)], "doc_id long, text string, ids string")
    path = sentencepiece_codec.public_model()
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    got = sentencepiece_codec.decode(sentencepiece_codec.encode(df, path), path).collect()
    assert len(got) == len(SAMPLES)
    for r in got:
        want = lib.encode(SAMPLES[r.doc_id] or "")
        assert r.ids == want and r.decoded == (lib.decode(want) if want else "") and len(r.starts) == len(r.ends) == len(want)
    assert sentencepiece_codec.encode(df.limit(0), path).collect() == []


def segmentations(word, p):
    return 1.0 if not word else sum(p.get(word[:k], 0.0) * segmentations(word[k:], p) for k in range(1, len(word) + 1))


def log_sum(word, p, longest):
    """log of the sum over all segmentations, by exact fractions of Python's long integers."""
    from fractions import Fraction

    sums = [Fraction(1)]
    for j in range(1, len(word) + 1):
        sums.append(sum(sums[i] * Fraction(p.get(word[i:j], 0.0)) for i in range(max(0, j - longest), j)))
    return math.log(sums[-1].numerator) - math.log(sums[-1].denominator)


def test_forward_sums_all_segmentations():
    high = language_id.BYTES[ord("x")]
    pieces = ["▁", "▁a", "a", "b", "ab", "▁ab", "ba", *language_id.BYTES]
    vocab = language_id.Vocabulary(pieces)
    p = np.array([[0.1], [0.2], [0.15], [0.1], [0.2], [0.05], [0.1], *[[0.01]] * 256])
    table = {x: p[i, 0] for i, x in enumerate(pieces)}
    for w in ("a", "ab", "abba", "baab", "bxa"):
        want = segmentations(("▁" + w).replace("x", high), table)
        assert language_id.log_probabilities(vocab, p, [w, w])[0, 0] == pytest.approx(math.log(want))
    # words of any length, and characters without a piece as their bytes
    rng = random.Random(3)
    for w in ["".join(rng.choice("abx") for _ in range(n)) for n in (31, 32, 33, 64, 200, 700)] + ["aĀb"]:
        spelled = "▁" + w.replace("x", high).replace("Ā", "".join(language_id.BYTES[k] for k in "Ā".encode()))
        assert language_id.log_probabilities(vocab, p, [w])[0, 0] == pytest.approx(log_sum(spelled, table, vocab.longest))
    # expected counts: each place of a word is covered once
    got = language_id.expected(vocab, p, ["abba", "ab"], np.array([0, 0]), np.array([2.0, 1.0]))
    assert (got[:, 0] * [len(x) for x in pieces]).sum() == pytest.approx(2 * 5 + 3)
    got = language_id.expected(vocab, p, ["abxb" * 100], np.array([0]), np.array([3.0]))
    assert (got[:, 0] * [len(x) for x in pieces]).sum() == pytest.approx(3 * 401)


def test_letters():
    assert language_id.has_letter("1 ½ é") and language_id.has_letter("ª") and language_id.has_letter("漢")
    assert not any(map(language_id.has_letter, ("", "12 ...", "½", "Ⅷ", "①", "²", "_")))


def test_language_predictions_against_brute_force(spark):
    rng = random.Random(4)
    vocab = language_id.vocabulary(sentencepiece_codec.public_model())
    words = ["lorem", "ipsum", "straße", "ක්‍ෂ", "x" * 90, "über"]
    rows = [(i, " ".join(rng.choices(words[i % 2 : i % 2 + 4], k=1 + i % 7)), "ab"[i % 2], "k", 1) for i in range(40)] + [(40, "½ ²", "a", "k", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, _text int")
    learned = language_id.fit(df, sentencepiece_codec.public_model())
    got = {r.doc_id: r for r in language_id.predict(df, learned).collect()}
    p = learned.p.astype(np.float32).astype(float)
    for i, text, *_ in rows[:-1]:
        logs = np.array([language_id.log_probabilities(vocab, p, [w])[0] for w in text.split()]).sum(axis=0) / math.sqrt(len(text.split()))
        best = int(logs.argmax())
        assert got[i].lang_pred == learned.langs[best] and got[i].score == pytest.approx(1 / np.exp(logs - logs[best]).sum())
    assert got[40].lang_pred == "und" and got[40].score == 0


def test_language_id_cases(spark):
    rng = random.Random(2)
    words = {"x": ["lorem", "ipsum", "dolor", "amet"], "y": ["haus", "baum", "straße", "über"]}
    rows = [(i, " ".join(rng.choices(words["xy"[i % 2]], k=20)), "xy"[i % 2]) for i in range(60)]
    df = spark.createDataFrame([*rows, (100, None, "x"), (101, "123 ...", "y"), (102, "", None), (103, "baum " * 20000, None), (104, "q" * 5000, None)], "doc_id long, text string, lang string")
    learned = language_id.fit(df.where("doc_id % 4 < 2 or doc_id >= 100"), sentencepiece_codec.public_model())
    got = {r.doc_id: r for r in language_id.predict(df, learned).collect()}
    assert all(got[i].lang_pred == lang and 0.5 < got[i].score <= 1 for i, _, lang in rows)
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (100, 101, 102)) and got[103].lang_pred == "y" and got[104].lang_pred in "xy"
    none = language_id.fit(df.limit(0), sentencepiece_codec.public_model())
    assert {r.lang_pred for r in language_id.predict(df, none).collect()} == {"und"}
    assert language_id.predict(df.limit(0), learned).collect() == []


def slow_signature(o, text):
    """The definition: for each probe, sort all numbered k-mers by their place on the ring after the probe."""
    points = order_minhash.code_points(text)
    x = o.numbered(o.kmers(points))
    bits = max(1, (len(x) - 1).bit_length())
    out = []
    for part in range(o.parts):
        ring = order_minhash.mix64(x ^ o.salts[part // o.per_ring + 2]) >> np.uint64(bits) << np.uint64(bits)
        ring = [int(r) | i for i, r in enumerate(ring)]
        order = sorted(range(len(x)), key=lambda i: (ring[i] - int(o.probes[part])) % 2**64)[: o.select]
        h = np.array([np.uint64(part) + o.salts[1]])
        with np.errstate(over="ignore"):
            for i in sorted(order):
                h = order_minhash.mix64(h * order_minhash._BASE + x[i])
        out.append(int(h[0] >> np.uint64(32)))
    return out


def test_order_minhash_is_its_definition():
    o = order_minhash.OrderMinHash()
    for t in ("a", "abcdefgh", "abcdefghi", "abab" * 30, "the quick brown fox jumps over the lazy dog", "é😀 " * 9):
        assert o.signature(order_minhash.code_points(t)).tolist() == slow_signature(o, t)
    assert o.signature(order_minhash.code_points("")).tolist() == [0] * o.parts


def test_order_minhash_follows_edits_and_order():
    rng = random.Random(4)
    o = order_minhash.OrderMinHash()
    base = "".join(rng.choice("abcdefghij ") for _ in range(2000))
    like = [o.likeness(o.signature(order_minhash.code_points(base)), o.signature(order_minhash.code_points(base[: 2000 - k] + "".join(rng.choice("klmnop") for _ in range(k))))) for k in (0, 100, 600, 1900)]
    assert like[0] == 1 and like[0] > like[1] > like[2] > like[3]
    swapped = base[1000:] + base[:1000]
    assert o.likeness(o.signature(order_minhash.code_points(base)), o.signature(order_minhash.code_points(swapped))) < 0.75


@pytest.mark.parametrize("parts", [1, 3])
def test_next_documents(spark, parts):
    texts = ["abc", None, "", "xyzxyz" * 50, "abc", "é😀é", "longer text of some words"]
    rows = [(i * 7 % 23, t) for i, t in enumerate(texts)] + [(None, "null id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    got = order_minhash.with_next(df, ranges=parts * 2)
    seen = defaultdict(list)
    for r in got.collect():
        seen[r._range].append(r)
    assert sum(not r._border for x in seen.values() for r in x) == len(rows)
    after = {}
    for x in seen.values():
        x.sort(key=lambda r: (r._border, r.doc_id is not None, r.doc_id or 0))
        assert x[-1]._border
        for a, b in zip(x, x[1:]):
            after[a.doc_id] = (b.doc_id, b.text)
    assert after == {a[0]: b for a, b in zip(order, order[1:] + order[:1])}


def edited(rows):
    """The definition, on (id, text) rows."""
    def order(r):
        return (r[0] is not None, r[0] or 0, r[2], r[1] or "")

    o, out = order_minhash.OrderMinHash(), []
    rows = sorted(rows, key=order)
    for (i, t, _), (_, u, _) in zip(rows, rows[1:] + rows[:1]):
        t, u = t or "", u or ""
        e = t[: len(t) - len(t) // 2] + u[: len(t) // 2]
        a, b, c = (o.signature(order_minhash.code_points(x)) for x in (t, e, u))
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), o.text(a), o.text(b), o.likeness(a, b), o.likeness(a, c)))
    return sorted(out, key=str)


def test_edited_fingerprints_against_brute_force(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdé😀 ", k=9))
    few = [(rng.randrange(30), rng.choice([None, "", word(), word() * 30])) for _ in range(50)]
    hot = [(7, f"{k} {word()}") for k in range(120)]  # an id with most rows
    cases = [few, few + hot, hot, [(None, "a"), (None, "b" * 40), (None, None)], [(5, "alone")], few + [(None, "z"), (None, "y")]]
    for rows in cases:
        df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, _range string").repartition(3)
        hashed = [tuple(r) for r in df.select("doc_id", "text", F.xxhash64("text")).collect()]
        got = order_minhash.edited_fingerprints(df, ranges=6).collect()
        assert sorted(map(tuple, got), key=str) == edited(hashed)
    assert order_minhash.edited_fingerprints(df.limit(0)).collect() == []
    many = order_minhash.with_next(spark.createDataFrame(hot, "doc_id long, text string"), ranges=6)
    assert max(r[1] for r in many.groupBy("_range").count().collect()) < 60
    o = order_minhash.OrderMinHash()
    h = np.array([rng.randrange(1 << 63) for _ in range(300)] * 300, np.uint64)
    seen = o.numbered(h)
    assert len(np.unique(seen)) == len(h) and (seen[:300] == o.numbered(h[:300])).all()


def slow_repeats(words):
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    return len({j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)})


def test_rule_statistics():
    rng = random.Random(6)
    for n in (0, 3, 5, 6, 50, 400):
        words = [rng.choice("abc" if n < 100 else [f"w{i}" for i in range(40)]) for _ in range(n)]
        assert quality_rules.repeated_words(words) == slow_repeats(words)
    words = [f"w{i}" for i in range(9000)] * 2
    assert quality_rules.repeated_words(words) == 18000
    counts, _ = quality_rules.statistics("a b#\n\u00a0\n a b#\na b#\n\n \n<x>|")
    assert counts == [8, 14, 6, 1, 0]
    assert quality_rules.statistics(None)[0] == [0] * 5


def test_quality_rules(spark):
    rng = random.Random(7)
    good = [" ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(60)) for _ in range(150)]
    bad = [" ".join(w + "###" for w in t.split()) for t in good[:30]]
    rows = [(i, t, "x") for i, t in enumerate(good + bad)] + [(500, None, "x"), (501, "", "x"), (502, "few words", "x"), (503, "same old words every time " * 40, "x"), (None, good[0], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(0, 180, 2)] + [(None, 1), (3, None)], "doc_id long, quality int")
    stats = quality_rules.with_statistics(df)
    got = {r.doc_id: r for r in quality_rules.judge(stats, quality_rules.fit(stats, labels)).collect()}
    assert sum(got[i].kept for i in range(150)) >= 148 and not any(got[i].kept for i in range(150, 180)) and got[None].kept
    assert all(got[i].base_failed and not got[i].kept for i in (500, 501, 502, 503))
    unlabelled = quality_rules.fit(stats, labels.limit(0))
    assert quality_rules.judge(stats, unlabelled).count() == len(rows)
    assert quality_rules.judge(stats.limit(0), quality_rules.fit(stats.limit(0), labels)).collect() == []


@pytest.mark.parametrize("order", [2, 3, 4])
def test_katz_against_its_definition(spark, order):
    rng = random.Random(8)
    words = [f"W{i}" for i in range(120)]
    rows = [(i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(120)], k=rng.randint(0, 60)))) for i in range(220)]
    rows += [(1000, None), (1001, ""), (1002, "unseen words\u00a0here"), (1003, "w0 " * 3000), (5, rows[5][1])]
    rows += [(2000 + i, f"always after this w{i % 4}") for i in range(40)] + [(3000 + i, "q r s t u") for i in range(40)] + [(None, "q r w0 s t")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, keys string").repartition(3)
    store = f"{shared_dir(spark)}/katz-{order}-{random.random()}"
    got = sorted(katz.katz_scores(df, order=order, chunk_tokens=500, store=store).collect(), key=str)
    grams, docs = [Counter() for _ in range(order)], []
    for i, t in rows:
        w = [*words_of((t or "").lower()), "\n"]
        held = zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
        docs.append((i, w, held))
        if not held:
            x = ["\t", *w]
            for k in range(order):
                grams[k].update(tuple(x[j - k : j + 1]) for j in range(1, len(x)) if j >= k)
    n, v = sum(grams[0].values()), len(grams[0])
    d = [katz.discounts(katz.count_counts(np.array(list(c.values())))) for c in grams]
    less = lambda k, c: d[k][c] * c if c <= katz.TOP else c
    unknown = 1 - sum(less(0, c) for c in grams[0].values()) / n
    follow = defaultdict(dict)
    for k in range(1, order):
        for g, c in grams[k].items():
            follow[g[:-1]][g[-1]] = c

    @lru_cache(maxsize=None)
    def weight(h):
        """(a(h), the denominator)."""
        x, k = follow[h], len(h)
        total, left = sum(x.values()), sum(c - less(k, c) for c in x.values())
        below, left = (total, left) if left > 1e-12 else (total + 1, 1)
        return left / below / (1 - sum(p(h[1:], w) for w in x)), below

    def p(h, w):
        if not h:
            return less(0, grams[0][(w,)]) / n if (w,) in grams[0] else unknown
        if h not in follow:
            return p(h[1:], w)
        if w in follow[h]:
            return less(len(h), follow[h][w]) / weight(h)[1]
        return weight(h)[0] * p(h[1:], w)

    for h in list(follow)[:: max(1, len(follow) // 60)]:  # what a history gives all words together
        assert sum(p(h, w) for (w,) in grams[0]) + p(h, "never seen") == pytest.approx(1)

    def log_p(x, j):
        return math.log10(p(tuple(x[max(0, j - order + 1) : j]), x[j]))

    want = [(i, held, len(w), sum((x,) in grams[0] for x in w), n, sum(math.log10((grams[0].get((x,), 0) + 1) / (n + v + 1)) for x in w), sum(log_p(["\t", *w], j) for j in range(1, len(w) + 1))) for i, w, held in docs]
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert tuple(g)[:5] == w[:5] and g.base_score == pytest.approx(w[5]) and g.score == pytest.approx(w[6])
    again = sorted(katz.score_stored(df.repartition(2), store, chunk_tokens=300).collect(), key=key)
    for g, w in zip(sorted(got, key=key), again):
        assert tuple(g)[:5] == tuple(w)[:5] and g.score == pytest.approx(w.score) and g.base_score == pytest.approx(w.base_score)
    assert len(again) == len(got) and katz.katz_scores(df.limit(0), order=order).collect() == []


def test_discounts_of_odd_counts():
    for counts in ([0] * 7, [0, 5, 0, 0, 0, 0, 0], [0, 1, 9, 9, 9, 9, 9], [0, 0, 3, 1, 0, 0, 0]):
        d = katz.discounts(np.array(counts))
        assert ((d[1:] > 0) & (d[1:] < 1)).all()


def test_edited_text_digest(spark):
    """The query's own columns on a small table of files."""
    import tempfile

    texts = ["abcdef", "xyz", None, "é😀"]
    where = tempfile.mkdtemp()
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"file://{where}/documents.parquet")
    got = {r.doc_id: r for r in order_minhash.op4_order_minhash(spark, f"file://{where}").collect()}
    for i, t in enumerate(texts):
        t, u = t or "", texts[(i + 1) % 4] or ""
        h = len(t) // 2
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256((t[: len(t) - h] + u[:h]).encode()).hexdigest()


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "nfkc_cf", "identity"])
def test_normaliser_is_the_librarys(rule):
    """The walk over the library's own compiled character maps: the same text, and the same original character for each
    normalised one."""
    lib = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    spec = dict(sentencepiece_codec._fields(lib.serialized_normalizer_spec()))
    m = object.__new__(sentencepiece_codec.Model)
    m.map = sentencepiece_codec.CharsMap(spec.get(2, b""))
    m.suffix, m.users = False, []
    m.dummy, m.squeeze, m.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))
    rng = random.Random(1)
    parts = ["ｈｅ", "　", " ", "  ", "①", "é", "é", "ﷺ", "ﬁ", "Ⅷ", "ㄱ가", "각", "ΑΣ", "ß", "İ", "​", "\t", "\n", "a", "B", "😀", "­", "½", "\x01", "が", "ｶﾞ", "ü̈", "▁", " ", "﻿"]
    texts = ["", " ", *parts, *("".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(600))]
    for t in texts:
        want, places = lib.normalize(t, with_offsets=True)
        data, source = m.normalize(t)
        assert data.decode() == want, t
        raw = t.encode()
        at = np.cumsum([0, *(len(c.encode()) for c in want)])
        assert [len(raw[: source[i]].decode()) for i in at][:-1] == list(places)[: len(want)], t
