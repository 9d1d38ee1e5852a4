import heapq
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmart.llm import mixture as M


def slow(weights, caps, seats):
    got = [0] * len(weights)
    queue = [(-w, i) for i, w in enumerate(weights) if w > 0 and caps[i] > 0]
    heapq.heapify(queue)
    for _ in range(seats):
        if not queue:
            break
        _, i = heapq.heappop(queue)
        got[i] += 1
        if got[i] < caps[i]:
            heapq.heappush(queue, (-weights[i] / (2 * got[i] + 1), i))
    return got


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.integers(0, 60)), min_size=1, max_size=8), st.integers(0, 200))
def test_sainte_lague_by_highest_quotients(parts, seats):
    weights, caps = [w for w, _ in parts], [c for _, c in parts]
    assert M.sainte_lague(weights, caps, seats) == slow(weights, caps, seats)


def test_sainte_lague_of_many_seats_is_quick():
    got = M.sainte_lague([0.5, 0.3, 0.2], [10**12, 10**8, 10**12], 10**10)
    assert sum(got) == 10**10 and got[1] == 10**8 and abs(got[0] / got[2] - 2.5) < 1e-6


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.integers(1, 6)), min_size=1, max_size=6, unique_by=lambda x: x[0]), st.integers(1, 3), st.data())
def test_equal_parties_are_apportioned_together(parts, repeats, data):
    parts = sorted(parts, reverse=True)
    weights, caps, counts = [float(w) for w, _ in parts], [w * repeats for w, _ in parts], [c for _, c in parts]
    seats = data.draw(st.integers(0, sum(c * n for c, n in zip(caps, counts))))
    got, more = M.apportion(weights, caps, counts, seats)
    one_by_one = slow([w for w, c in zip(weights, counts) for _ in range(c)], [w for w, c in zip(caps, counts) for _ in range(c)], seats)
    together = [g + (k < m) for g, m, c in zip(got, more, counts) for k in range(c)]
    assert together == one_by_one and sum(together) == seats


def test_seats_settled_by_quotients_stay_few(monkeypatch):
    pops, own = [], heapq.heappop
    monkeypatch.setattr(M.heapq, "heappop", lambda q: pops.append(1) or own(q))
    rng = random.Random(2)
    weights = [float(rng.randrange(1, 9000)) for _ in range(20_000)]
    got = M.sainte_lague(weights, [10**9] * len(weights), 10**8)
    assert sum(got) == 10**8 and len(pops) <= len(weights)


def sized(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint, block int, shard string")


def targets(spark, rows):
    return M.targets(spark.createDataFrame(rows, "source string, target_share double, max_repeats int"))


def corpus(spark, seed=1):
    rng = random.Random(seed)
    return sized(spark, [(i, rng.choice(["a"] * 6 + ["b"] * 3 + ["c", None]), rng.randrange(1, 90), 1, "x") for i in range(3000)])


def test_shares_caps_and_whole_blocks(spark):
    docs, wanted = corpus(spark), targets(spark, [("A ", 0.3, 1), ("b", 0.4, 3), ("c", 0.2, 2), ("d", 0.1, 9)])
    mix = M.mixture(docs, wanted, block_tokens=64, shard_tokens=9_000).cache()
    total = docs.agg(F.sum("n_tokens")).first()[0]
    s = {r["source"]: r for r in M.shares(mix, M.source_sizes(docs), wanted).collect()}
    # c can't reach its share and gives all it may, d has nothing; a and b share the rest as 3 to 4
    assert s["c"]["taken_tokens"] == 2 * s["c"]["source_tokens"] and s["d"]["taken_tokens"] == 0
    assert abs(s["a"]["taken_tokens"] / s["b"]["taken_tokens"] - 0.75) < 0.03
    assert abs(sum(r["taken_tokens"] for r in s.values()) / total - 1) < 0.02
    assert all(r["most_repeats"] <= r["max_repeats"] for r in s.values()) and mix.count() == mix.select("doc_id").distinct().count()
    assert sum(r["reached_share"] for r in s.values()) == pytest.approx(1)
    again = M.mixture(docs.repartition(5), wanted, block_tokens=64, shard_tokens=9_000)
    assert mix.exceptAll(again).isEmpty() and again.exceptAll(mix).isEmpty()
    assert not mix.exceptAll(M.mixture(docs, wanted, block_tokens=64, shard_tokens=9_000, seed=5)).isEmpty()


def test_unreachable_sources(spark):
    sizes = M.source_sizes(sized(spark, [(1, "a", 50, 0, ""), (2, "b", 25, 0, ""), (3, None, 25, 0, "")]))
    wanted = targets(spark, [("a", 0.5, 1), ("b", 0.2501, 1), ("B", 0.25, 2), ("c", 0.01, 5), (None, 0.5, 1)])
    assert sorted(r["source"] for r in M.unreachable(sizes, wanted).collect()) == ["b", "c"]


def test_nulls_empty_texts_and_empty_tables(spark):
    wanted = targets(spark, [("a", 1.0, 1)])
    docs = sized(
        spark,
        [(1, "a", None, 0, ""), (2, "a", 0, 0, ""), (3, None, 5, 0, ""), (4, "z", 5, 0, ""), (None, "a", 5, 0, ""), (6, "a", 5, 0, ""), (6, "a", 5, 0, "")]
    )
    assert sorted((r["doc_id"] or 0, r["repeats"]) for r in M.mixture(docs, wanted, block_tokens=8).collect()) == [(0, 1), (2, 1), (6, 1), (6, 1)]
    empty = sized(spark, [])
    assert M.mixture(empty, wanted).count() == 0
    assert M.mixture(docs, targets(spark, [])).count() == 0
    assert [r["reached_share"] for r in M.shares(M.mixture(empty, wanted), M.source_sizes(empty), wanted).collect()] == [0.0]


def test_source_names(spark):
    rows = spark.createDataFrame([("  TM_Archive\t",), (None,)], "s string").select(M.source_name(F.col("s"))).collect()
    assert [r[0] for r in rows] == ["tm-archive", None]


@pytest.mark.skipif(not os.path.exists(M.TOKENIZER), reason="needs the public vocabulary")
def test_token_counts_cover_whole_texts(spark):
    df = spark.createDataFrame([(1, "The old bridge."), (2, ""), (3, None), (4, "wort " * 20_000)], "i int, text string")
    got = {r["i"]: r["n_tokens"] for r in M.token_counts(df, "text").collect()}
    assert got[1] >= 4 and got[2] == 0 and got[3] is None and got[4] >= 20_000
    assert "".join(M.encoder(M.TOKENIZER).decode([t]) for t in M.encoder(M.TOKENIZER).encode_ordinary("The old bridge.")) == "The old bridge."


def test_found_comes_from_the_mixture(spark, tmp_path, monkeypatch):
    from tripmart.llm import queries as Q

    docs = [(i, "word " * (20 + i % 30), "a" if i % 3 else "b") for i in range(600)]
    spark.createDataFrame(docs, "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(
        [("A", 0.5, 1), ("b", 0.3, 1), ("c", 0.1, 5), ("d", 0.1, 1)], "source string, target_share double, max_repeats int"
    ).write.parquet(str(tmp_path / "mix_targets.parquet"))
    ran, own = [], M.mixture
    monkeypatch.setattr(M, "mixture", lambda *a, **k: ran.append(1) or own(*a, **k))
    assert sorted(r["source"] for r in Q.p8_found(spark, str(tmp_path)).collect()) == ["c", "d"]
    assert ran


@pytest.mark.parametrize("shares", [(0.3, 0.4, 0.2, 0.1), (0.05, 0.85, 0.05, 0.05), (0.9, 0.9, 0.9, 0.0)])
def test_no_unreachable_source_is_left_out_of_the_stopped(spark, shares):
    docs, wanted = corpus(spark), targets(spark, [(n, w, r) for n, w, r in zip("abcd", shares, (1, 2, 3, 1))])
    sizes, total = M.source_sizes(docs), docs.agg(F.sum("n_tokens")).first()[0]
    mix = M.mixture(docs, wanted, total_tokens=round(total * sum(shares)), block_tokens=64, shard_tokens=9_000)
    kept = {r["source"] for r in M.stopped(M.shares(mix, sizes, wanted), 90, block_tokens=64, shard_tokens=9_000).collect()}
    assert {r["source"] for r in M.unreachable(sizes, wanted).collect()} <= kept
    assert kept != set("abcd") or shares[0] != 0.05
