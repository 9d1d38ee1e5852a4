import random
from collections import Counter

import numpy as np
import pytest

from tripmart.llm import leakage
from tripmart.llm.text import words

WORDS = [f"w{i}" for i in range(400)]


def brute(docs, items, run=12):
    at = {}
    for i, t in items:
        w = words(t)
        for k in range(len(w) - min(run, len(w)) + 1):
            at.setdefault(tuple(w[k : k + min(run, len(w))]), set()).add(i)
    out = set()
    for d, t in docs:
        w = words(t)
        for n in {len(k) for k in at if k}:
            for k in range(len(w) - n + 1):
                out |= {(d, i) for i in at.get(tuple(w[k : k + n]), ())}
    return out


def leaks(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS id", "'x' AS item_id")
    i = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "2 AS doc_id")
    return leakage.leaks(d, i, **options)


def literal(spark, docs, items, **options):
    return sorted((r["doc_id"], r["item_id"]) for r in leaks(spark, docs, items, **options).where("literal").collect())


def sentence(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


@pytest.mark.parametrize("options", [{}, {"block_words": 60, "filter_bits": 1 << 15}])
def test_against_brute_force(spark, options):
    rng = random.Random(4)
    items = [(i, sentence(rng, rng.choice([1, 3, 4, 5, 8, 11, 12, 13, 40]))) for i in range(30)]
    docs = []
    for d in range(300):
        w = sentence(rng, rng.randrange(0, 60)).split()
        if rng.random() < 0.5:
            leak = words(rng.choice(items)[1])
            n = rng.choice([5, 11, 12, 13, 60])
            k = rng.randrange(max(1, len(leak) - n + 1))
            w[len(w) // 2 : len(w) // 2] = leak[k : k + n]
        docs.append((d, " ".join(w)))
    assert literal(spark, docs, items, **options) == sorted(brute(docs, items))


def test_spelling_does_not_count(spark):
    item = "Der Straße-Café öffnet um neun Uhr, doch niemand kommt vor elf oder zwölf."
    docs = [
        (1, "x " + item.upper() + " y"), (2, "ＤＥＲ strasse café öffnet​ um ne­un\nUhr doch -- niemand kommt vor elf oder zwolf"),
        (3, item.replace("elf", "zehn"))
    ]
    assert literal(spark, docs, [(7, item)]) == [(1, 7), (2, 7)]


def test_short_items_need_all_their_words(spark):
    docs = [(1, "we saw the red fox run away"), (2, "the red dog"), (3, "red"), (4, "thered fox")]
    assert literal(spark, docs, [(1, "the red fox"), (2, "red")]) == [(1, 1), (1, 2), (2, 2), (3, 2)]


def test_null_empty_equal_repeated_and_long(spark):
    rng = random.Random(1)
    text = sentence(rng, 20)
    long = sentence(rng, 120_000) + " " + text
    docs = [(1, None), (2, ""), (3, " .,"), (4, text + " " + text), (4, text), (5, long)]
    assert literal(spark, docs, [(1, text), (2, text), (3, None), (4, ""), (5, "!")]) == [(4, 1), (4, 1), (4, 2), (4, 2), (5, 1), (5, 2)]
    assert literal(spark, [], [(1, text)]) == [] and literal(spark, docs, []) == []


def test_windows_do_not_cross_documents(spark):
    w = [f"a{i}" for i in range(12)]
    assert literal(spark, [(1, " ".join(w[:6])), (2, " ".join(w[6:]))], [(1, " ".join(w))]) == []


def made(text):
    return leakage._Hashes().of(text)


def test_no_fingerprint_within_the_radius_is_missed():
    rng = np.random.default_rng(3)
    for radius in (3, 7, 11):
        index = leakage.Index([1], [made(" ".join(WORDS[:60]))], 12, radius)
        size = index.sizes[0]
        for p in size.prints[::7]:
            flips = [rng.choice(64, rng.integers(0, radius + 1), replace=False) for _ in range(20)]
            q = np.array([p ^ np.uint64(sum(1 << int(b) for b in f)) for f in flips], np.uint64)
            got = {tuple(x) for x in index._near(size, q)}
            want = {(i, j) for i in range(len(q)) for j in range(len(size.prints)) if int(q[i] ^ size.prints[j]).bit_count() <= radius}
            assert got == want


def test_windows_are_of_the_items_size():
    assert leakage.ladder(100, 12) == [12, 16, 21, 28, 37, 49, 65, 86]
    index = leakage.Index([1, 2, 3, 4], [made(sentence(random.Random(n), n)) for n in (3, 12, 40, 70)], 12, 11)
    assert [s.words for s in index.sizes] == [3, 12, 37, 65]
    assert {s.words: sorted(set(s.item.tolist())) for s in index.sizes} == {3: [0], 12: [1, 2, 3], 37: [2], 65: [3]}


def similarity(a, b):
    """Brute force over all pairs of windows of a size: the greatest weighted similarity."""
    units = lambda w: Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    weigh = lambda c: sum(n * sum(min(12, len(x)) for x in s) for s, n in c.items())
    x, y = units(a), units(b)
    shared = weigh(x & y)
    return shared / (weigh(x) + weigh(y) - shared)


def test_changed_words_of_long_items(spark):
    """One word of each copy of a long item changed: the copy is found with its true similarity, over 9 in 10 times by the window of its size."""
    rng = random.Random(11)
    items = [(i, sentence(rng, rng.randrange(52, 90))) for i in range(60)]
    docs = []
    for i, t in items:
        w = words(t)
        w[rng.randrange(len(w))] = "another"
        docs.append((i, sentence(rng, 30) + " " + " ".join(w) + " " + sentence(rng, 30)))
    got = {r["doc_id"]: r for r in leaks(spark, docs, items).where("doc_id = item_id").collect()}
    assert len(got) == len(items) and all(r["literal"] for r in got.values())
    index = leakage.Index([i for i, _ in items], [made(t) for _, t in items], 12, 11)
    hits, wanted = 0, 0
    for i, t in docs:
        w = words(t)
        sizes = {s.words: s for s in index.sizes}
        n = leakage._item_sizes(len(words(items[i][1])), 12)[-1]
        item = words(items[i][1])
        best = max(similarity(w[a : a + n], item[b : b + n]) for a in range(28, 32 + len(item) - n) for b in range(len(item) - n + 1))
        if best >= 0.8:
            wanted += 1
            alone = leakage.Index([i], [made(items[i][1])], 12, 11)
            alone.sizes = [s for s in alone.sizes if s.words == n]
            found = alone.matches([made(t)], 0.8)
            hits += len(found) > 0 and found["similarity"].max() == pytest.approx(best)
        assert n in sizes
    assert wanted > 30 and hits >= 0.9 * wanted


def test_blocks_change_nothing(spark):
    rng = random.Random(13)
    items = [(i, sentence(rng, rng.randrange(3, 70))) for i in range(40)] + [(50, "the red fox"), (51, None), (52, "")]
    docs = []
    for d in range(80):
        w = words(rng.choice(items[:40])[1])
        k = rng.randrange(len(w))
        docs.append((d, sentence(rng, 9) + " " + " ".join(w[k // 2 :]) + " the red fox " + " ".join(w[:k])))
    docs += [(3, docs[3][1]), (90, None), (91, "")]
    one = sorted(map(tuple, leaks(spark, docs, items).collect()))
    assert one == sorted(map(tuple, leaks(spark, docs, items, block_words=100, filter_bits=1 << 14).collect())) and len(one) > 100


def test_pieces_of_a_long_text_hold_all_windows(monkeypatch):
    rng = random.Random(15)
    item, text = sentence(rng, 40), sentence(rng, 600)
    text = text[:900] + " " + item + " " + text[900:1500] + " " + item + " " + text[1500:]
    index = leakage.Index([1], [made(item)], 12, 11)
    whole = index.matches([made(text)], 0.8)
    for piece in (50, 333, 910, 1000):
        monkeypatch.setattr(leakage, "PIECE", piece)
        parts = [index.matches(t, 0.8) for _, t in leakage._chunks([text], leakage._Hashes(), 36)]
        assert sum(map(len, parts)) == len(whole) > 50
        known = leakage.Filter(1 << 14)
        known.add(leakage._item_units([made(item)], 12))
        cut = [w for _, t in leakage._chunks([text], leakage._Hashes(), 36) for _, w in leakage._Joined(t).stretches([12, 37], known, 0.8)]
        assert len(index.matches(cut, 0.8)) == len(whole) and sum(map(len, cut)) < 600


def test_weighted_similarity_is_exact():
    a, b = np.array([[1, 1, 2, 3]], np.uint64), np.array([[1, 2, 2, 4]], np.uint64)
    w = {1: 5, 2: 3, 3: 1, 4: 2}
    wa, wb = (np.array([[w[int(x)] for x in r[0]]]) for r in (a, b))
    # shared: one 1 and one 2
    assert leakage.weighted_similarity(a, b, wa, wb)[0] == pytest.approx(8 / (14 + 13 - 8))
