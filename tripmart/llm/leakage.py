"""Evaluation texts leaking into training text: SimHash of item-sized windows, multi-index Hamming blocks.

An item is cut into windows of ``run`` words (the whole item where it has fewer) and, beyond that, into windows of
about its own size: the greatest step of a ladder of sizes, each a third larger than the one before, that fits into
it. Every window gets a 64-bit SimHash of its five-word shingles, weighted by their letters. Fingerprints are
indexed by four blocks of 16 bits; two within ``radius`` bits differ in some block by at most a fourth of them, and all
such block values are probed, so no pair within the radius is missed. Candidates are verified by the exact weighted
similarity of their shingles as multisets (``least_similarity``) and, for literal leaks, word by word.

A document window is looked up only if shingles of items make up ``least_similarity`` of its weight; no other window
can be that similar to one of an item, so nothing is lost, and the work on a document is that of reading it, except
where it holds passages of items.

Items up to ``block_words`` words in all are one broadcast index. Of more items, which may come in any number, a filter
of ``filter_bits`` bits is broadcast; one pass over the documents stores the stretches it lets through, and blocks of
the items, each within the bound, are then looked up in those stretches alone. The rows don't depend on the blocks.
Weights follow from the words, so they don't either. Documents are never gathered, joined or compared with each other.

Null, empty and wordless texts of either side give no row; a document that holds an item several times gives
one row; repeated documents give a row each; items of equal text are found separately. Texts of any length are
read whole, in pieces of ``PIECE`` characters cut at white space, whose windows go on from one to the next.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.text import spread, words
from tripmart.session import checkpoint

SHINGLE = 5
BITS, BLOCKS, WIDTH = 64, 4, 16
#: Word positions, and characters of one text, worked on at once; they bound the memory of a task.
CHUNK, PIECE = 40_000, 400_000
#: Letters of a word that count at most.
LETTERS = 12
_ODD = np.uint64(0x9E3779B97F4A7C15)
FOUND = "doc_id bigint, item_id bigint, windows bigint, similarity double, literal boolean"


def _mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of a 64-bit value over all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """A text as hashes and letters of its words; windows that end within the first ``old`` words were looked at before."""

    hashes: np.ndarray
    letters: np.ndarray
    old: int = 0

    def __len__(self) -> int:
        return len(self.hashes)


class _Hashes(dict):
    """64-bit hashes of words, kept while the vocabulary is small."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, text: str) -> Words:
        found = words(text)
        n = len(found)
        return Words(np.fromiter((self[w] for w in found), np.uint64, n), np.minimum(np.fromiter(map(len, found), np.int64, n), LETTERS))


def ladder(most: int, run: int) -> list[int]:
    """Window sizes from ``run`` up to ``most`` words, each a third larger."""
    out = [run]
    while (n := out[-1] + max(1, out[-1] // 3)) <= most:
        out.append(n)
    return out


def _units(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each position on."""
    out = np.zeros(max(0, len(h) - n + 1), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = _mix(out * _ODD + h[i : i + len(out)])
    return out


def _runs(x: np.ndarray, n: int) -> np.ndarray:
    """Sums of every ``n`` neighbours."""
    total = np.concatenate([[0], np.cumsum(x)])
    return total[n:] - total[:-n] if len(x) >= n else np.zeros(0, total.dtype)


def _fingerprints(s: np.ndarray, w: np.ndarray, at: np.ndarray, per: int) -> np.ndarray:
    """SimHash of the ``per`` shingles from each place of ``at`` on, over the shingles needed only."""
    if not len(at):
        return np.zeros(0, np.uint64)
    needed = np.zeros(len(s) + 1, np.int64)
    np.add.at(needed, at, 1)
    np.add.at(needed, at + per, -1)
    need = np.flatnonzero(np.cumsum(needed)[:-1])
    bits = np.unpackbits(s[need].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int64)
    total = np.zeros((len(need) + 1, BITS), np.int64)
    np.cumsum((2 * bits - 1) * w[need][:, None], axis=0, out=total[1:])
    first = np.searchsorted(need, at)
    return np.packbits(total[first + per] - total[first] > 0, axis=1, bitorder="little").view(np.uint64).ravel()


def _numbered(x: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted, with equal values of a row made different by a number, and their weights."""
    order = np.argsort(x, axis=1, kind="stable")
    x, w = np.take_along_axis(x, order, 1), np.take_along_axis(w, order, 1)
    place = np.arange(x.shape[1])
    fresh = np.concatenate([np.ones((len(x), 1), bool), x[:, 1:] != x[:, :-1]], 1)
    number = place - np.maximum.accumulate(np.where(fresh, place, 0), axis=1)
    with np.errstate(over="ignore"):
        return _mix(x + number.astype(np.uint64) * _ODD), w


def weighted_similarity(a: np.ndarray, b: np.ndarray, wa: np.ndarray, wb: np.ndarray) -> np.ndarray:
    """Weighted Jaccard of rows of shingles as multisets: the weight of what they share over the weight of both."""
    (x, u), (y, v) = _numbered(a, wa), _numbered(b, wb)
    both, weight = np.concatenate([x, y], 1), np.concatenate([u, v], 1)
    order = np.argsort(both, axis=1, kind="stable")
    both, weight = np.take_along_axis(both, order, 1), np.take_along_axis(weight, order, 1)
    shared = (weight[:, 1:] * (both[:, 1:] == both[:, :-1])).sum(1)
    return shared / np.maximum(wa.sum(1) + wb.sum(1) - shared, 1)


def _masks(most: int) -> np.ndarray:
    """All values of a block with at most ``most`` bits set."""
    return np.array([sum(1 << b for b in c) for n in range(most + 1) for c in combinations(range(WIDTH), n)], np.int64)


def _block(prints: np.ndarray, b: int) -> np.ndarray:
    return ((prints >> np.uint64(b * WIDTH)) & np.uint64((1 << WIDTH) - 1)).astype(np.int64)


@dataclass
class _Size:
    """The item windows of one size."""

    words: int
    item: np.ndarray  # place of the item
    start: np.ndarray  # where the window starts in the items' words
    prints: np.ndarray
    starts: list[np.ndarray]  # per block of bits: where a block value's windows start in `order`
    order: list[np.ndarray]


class Exact:
    """The shingles of the items, by size of the unit."""

    def __init__(self, units: dict[int, np.ndarray]):
        self.known = {n: np.unique(s) for n, s in units.items()}

    def __contains__(self, n: int) -> bool:
        return n in self.known

    def has(self, n: int, s: np.ndarray) -> np.ndarray:
        known = self.known[n]
        at = np.minimum(np.searchsorted(known, s), len(known) - 1)
        return known[at] == s


class Filter:
    """The same as bits, for any number of items: says yes to every shingle of theirs, and to a few others."""

    def __init__(self, bits: int, sizes: Iterable[int] = ()):
        self.table, self.sizes = np.zeros(bits // 8, np.uint8), set(sizes)

    def _at(self, n: int, s: np.ndarray) -> list[np.ndarray]:
        bits = np.uint64(len(self.table) * 8)
        with np.errstate(over="ignore"):
            return [(_mix(s + np.uint64(n * 64 + k)) % bits).astype(np.int64) for k in range(2)]

    def add(self, units: dict[int, np.ndarray]) -> None:
        for n, s in units.items():
            self.sizes.add(n)
            for at in self._at(n, s):
                np.bitwise_or.at(self.table, at >> 3, (1 << (at & 7)).astype(np.uint8))

    def __contains__(self, n: int) -> bool:
        return n in self.sizes

    def has(self, n: int, s: np.ndarray) -> np.ndarray:
        return np.logical_and(*[(self.table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool) for at in self._at(n, s)])


def _item_sizes(n: int, run: int) -> list[int]:
    return [n] if n <= run else sorted({run, ladder(n, run)[-1]})


def _item_units(items: list[Words], run: int) -> dict[int, np.ndarray]:
    out: dict[int, list[np.ndarray]] = {}
    for t in items:
        if len(t):
            n = min(SHINGLE, len(t))
            out.setdefault(n, []).append(_units(t.hashes, n))
    return {n: np.concatenate(s) for n, s in out.items()}


class Index:
    """Item windows by size, with their fingerprints in multi-index blocks; plain arrays, sent to the executors."""

    def __init__(self, ids: list, texts: list[Words], run: int, radius: int):
        self.run, self.radius, self.ids = run, radius, np.array(ids)
        self.masks = _masks(radius // BLOCKS)
        self.shingles = Exact(_item_units(texts, run))
        lengths = np.array([len(t) for t in texts], np.int64)
        self.first = np.concatenate([[0], np.cumsum(lengths)])[:-1] if len(texts) else lengths
        self.hashes = np.concatenate([t.hashes for t in texts]) if texts else np.zeros(0, np.uint64)
        self.letters = np.concatenate([t.letters for t in texts]) if texts else np.zeros(0, np.int64)
        by_size: dict[int, list[int]] = {}
        for k, n in enumerate(lengths):
            for size in _item_sizes(int(n), run) if n else ():
                by_size.setdefault(size, []).append(k)
        self.sizes = [self._size(n, np.array(k), lengths) for n, k in sorted(by_size.items())]

    def _size(self, n: int, items: np.ndarray, lengths: np.ndarray) -> _Size:
        unit = min(SHINGLE, n)
        many = lengths[items] - n + 1
        item = np.repeat(items, many)
        start = self.first[item] + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        s = _units(self.hashes, unit)
        prints = _fingerprints(s, _runs(self.letters, unit), start, n - unit + 1)
        starts, order = [], []
        for b in range(BLOCKS):
            values = _block(prints, b)
            o = np.argsort(values, kind="stable").astype(np.int32)
            order.append(o)
            starts.append(np.searchsorted(values[o], np.arange((1 << WIDTH) + 1)).astype(np.int32))
        return _Size(n, item.astype(np.int32), start, prints, starts, order)

    def _near(self, size: _Size, prints: np.ndarray) -> np.ndarray:
        """(print, window) of all fingerprints within the radius."""
        out = [np.zeros((0, 2), np.int64)]
        for some in np.array_split(np.arange(len(prints)), len(prints) // 2000 + 1):
            for b in range(BLOCKS):
                v = (_block(prints[some], b)[:, None] ^ self.masks).ravel()
                who = np.repeat(some, len(self.masks))
                count = size.starts[b][v + 1] - size.starts[b][v]
                hit = np.flatnonzero(count)
                for part in np.array_split(hit, int(count.sum()) // 2_000_000 + 1):
                    c = count[part]
                    within = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
                    window = size.order[b][np.repeat(size.starts[b][v[part]], c) + within]
                    doc = np.repeat(who[part], c)
                    near = np.bitwise_count(prints[doc] ^ size.prints[window]) <= self.radius
                    out.append(np.stack([doc[near], window[near]], 1).astype(np.int64))
        return np.unique(np.concatenate(out), axis=0)

    def matches(self, texts: list[Words], least: float) -> pd.DataFrame:
        """``text, item, similarity, literal`` for each verified pair of windows."""
        whole, out = _Joined(texts), []
        for size in self.sizes:
            at, s, w, per = whole.candidates(size.words, self.shingles, least)
            if not len(at):
                continue
            prints, back = np.unique(_fingerprints(s, w, at, per), return_inverse=True)
            near = self._near(size, prints)
            # back from different fingerprints to windows
            by_print = np.argsort(back, kind="stable")
            many = np.bincount(back, minlength=len(prints))
            begin = np.cumsum(many) - many
            c = many[near[:, 0]]
            within = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
            place, window = at[by_print[np.repeat(begin[near[:, 0]], c) + within]], np.repeat(near[:, 1], c)
            for part in np.array_split(np.arange(len(place)), len(place) * size.words // 4_000_000 + 1):
                p, k = place[part], window[part]
                steps = np.arange(size.words)
                literal = (whole.hashes[p[:, None] + steps] == self.hashes[size.start[k][:, None] + steps]).all(1)
                similar = np.ones(len(p))
                rest, units = np.flatnonzero(~literal), np.arange(per)
                unit = size.words - per + 1
                if len(rest):
                    mine, theirs = p[rest][:, None] + units, size.start[k[rest]][:, None] + units
                    items, weights = self._of_unit(unit)
                    similar[rest] = weighted_similarity(s[mine], items[theirs], w[mine], weights[theirs])
                keep = similar >= least
                out.append(pd.DataFrame({"text": whole.owner[p[keep]], "item": size.item[k[keep]], "similarity": similar[keep], "literal": literal[keep]}))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"text": [], "item": [], "similarity": [], "literal": []})

    def _of_unit(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        kept = self.__dict__.setdefault("_units_kept", {})
        if n not in kept:
            kept[n] = _units(self.hashes, n), _runs(self.letters, n)
        return kept[n]


class _Joined:
    """Several texts one behind the other."""

    def __init__(self, texts: list[Words]):
        lengths = np.array([len(t) for t in texts], np.int64)
        self.hashes = np.concatenate([t.hashes for t in texts]) if texts else np.zeros(0, np.uint64)
        self.letters = np.concatenate([t.letters for t in texts]) if texts else np.zeros(0, np.int64)
        self.owner = np.repeat(np.arange(len(texts)), lengths)
        self.first = np.cumsum(lengths) - lengths
        self.old = np.array([t.old for t in texts], np.int64)
        self._kept: dict[int, tuple] = {}

    def candidates(self, n: int, shingles: Exact | Filter, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Places of the windows of ``n`` words of which enough is shingles of items; the shingles, their weights, and how many a window has."""
        unit = min(SHINGLE, n)
        per = n - unit + 1
        if unit not in self._kept:
            s, w = _units(self.hashes, unit), _runs(self.letters, unit)
            self._kept[unit] = s, w, np.where(shingles.has(unit, s), w, 0) if unit in shingles and len(s) else np.zeros(len(w), np.int64)
        s, w, known = self._kept[unit]
        if len(self.hashes) < n or not known.any():
            return np.zeros(0, np.int64), s, w, per
        enough = np.flatnonzero(_runs(known, per) >= least * _runs(w, per) - 1e-9)
        last = enough + n - 1
        inside = (self.owner[enough] == self.owner[last]) & (last - self.first[self.owner[enough]] >= self.old[self.owner[enough]])
        return enough[inside], s, w, per

    def stretches(self, sizes: Iterable[int], shingles: Filter, least: float) -> Iterator[tuple[int, Words]]:
        """The parts of the texts that hold candidates of any of the sizes."""
        cover = np.zeros(len(self.hashes) + 1, np.int64)
        for n in sizes:
            at = self.candidates(n, shingles, least)[0]
            np.add.at(cover, at, 1)
            np.add.at(cover, at + n, -1)
        inside = np.concatenate([[False], np.cumsum(cover)[:-1] > 0, [False]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        for low, high in zip(edge[::2], edge[1::2]):
            for k in range(self.owner[low], self.owner[high - 1] + 1):
                a, b = max(low, self.first[k]), high if k == self.owner[high - 1] else self.first[k + 1]
                yield k, Words(self.hashes[a:b], self.letters[a:b], max(0, int(self.first[k] + self.old[k] - a)))


def _pieces(text: str) -> Iterator[str]:
    """A text in pieces of about PIECE characters, cut at white space."""
    start = 0
    while start < len(text):
        end = start + PIECE
        while end < len(text) and not text[end].isspace():
            end += 1
        yield text[start:end]
        start = end


def _chunks(texts: Iterable[str], hashes: _Hashes, tail: int) -> Iterator[tuple[list[int], list[Words]]]:
    """Texts in chunks of about CHUNK words; each piece of a long one begins with the last ``tail`` words of the piece before."""
    rows, chunk, n = [], [], 0
    for row, text in enumerate(texts):
        before = Words(np.zeros(0, np.uint64), np.zeros(0, np.int64))
        for piece in _pieces(text):
            new = hashes.of(piece)
            kept = min(tail, len(before))
            cut = len(before) - kept
            before = Words(np.concatenate([before.hashes[cut:], new.hashes]), np.concatenate([before.letters[cut:], new.letters]), kept)
            if len(new):
                rows.append(row)
                chunk.append(before)
                n += len(before)
            if n >= CHUNK:
                yield rows, chunk
                rows, chunk, n = [], [], 0
    if rows:
        yield rows, chunk


def _merged(found: pd.DataFrame, by: list[str]) -> pd.DataFrame:
    return found.groupby(by, as_index=False, sort=False).agg(windows=("similarity", "size"), similarity=("similarity", "max"), literal=("literal", "max"))


def _blocks(items: DataFrame, block_words: int) -> Iterator[tuple[list[int], list[Words]]]:
    """The items, ordered, in blocks of at most ``block_words`` words (a longer item is a block of its own)."""
    hashes, ids, block, n = _Hashes(), [], [], 0
    for r in items.orderBy("i", "t").toLocalIterator():
        t = hashes.of(r["t"])
        if block and n + len(t) > block_words:
            yield ids, block
            ids, block, n = [], [], 0
        ids.append(r["i"])
        block.append(t)
        n += len(t)
    yield ids, block


def leaks(
    documents: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", run: int = 12, radius: int = 11, least_similarity: float = 0.8,
    block_words: int = 1_000_000, filter_bits: int = 1 << 30,
) -> DataFrame:
    """``doc_id, item_id, windows`` (verified), ``similarity`` (the best), ``literal`` (a run of words is the same)."""
    context = documents.sparkSession.sparkContext
    wanted = items.select(F.col(item_id).cast("bigint").alias("i"), F.col(text).alias("t")).where(F.col("t").isNotNull())
    rows = spread(documents.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text")).where(F.length("text") > 0))
    blocks = _blocks(wanted, block_words)
    ids, first = next(blocks)
    second = next(blocks, None)
    if second is None:
        index = context.broadcast(Index(ids, first, run, radius))

        def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            hashes, tail = _Hashes(), max([s.words for s in index.value.sizes], default=1) - 1
            for pdf in batches:
                parts = []
                for row, texts in _chunks(pdf["text"], hashes, tail):
                    found = index.value.matches(texts, least_similarity)
                    if len(found):
                        parts.append(found.assign(row=np.array(row)[found["text"].astype(int)]))
                if parts:
                    found = _merged(pd.concat(parts), ["row", "item"])
                    yield pd.DataFrame(
                        {
                            "doc_id": pdf["id"].to_numpy()[found["row"]], "item_id": index.value.ids[found["item"].astype(int)],
                            "windows": found["windows"], "similarity": found["similarity"], "literal": found["literal"].astype(bool)
                        }
                    )

        return rows.mapInPandas(probe, FOUND)

    # more items than one index may hold: their shingles as bits, as large as they need up to the bound
    known, sizes = Filter(filter_bits), set()
    for _, block in _all_blocks(ids, first, second, blocks):
        known.add(_item_units(block, run))
        sizes |= {n for t in block if len(t) for n in _item_sizes(len(t), run)}
    sent = context.broadcast((known, sorted(sizes)))

    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, lengths = sent.value
        hashes = _Hashes()
        for pdf in batches:
            for row, texts in _chunks(pdf["text"], hashes, lengths[-1] - 1):
                cut = [(row[k], w) for k, w in _Joined(texts).stretches(lengths, shingles, least_similarity)]
                if cut:
                    yield pd.DataFrame(
                        {
                            "row": pdf["row"].to_numpy()[[k for k, _ in cut]], "doc_id": pdf["id"].to_numpy()[[k for k, _ in cut]],
                            "h": [w.hashes.view(np.int64) for _, w in cut], "l": [w.letters for _, w in cut], "old": [w.old for _, w in cut]
                        }
                    )

    thinned = checkpoint(
        rows.withColumn("row", F.monotonically_increasing_id()).mapInPandas(thin, "row bigint, doc_id bigint, h array<bigint>, l array<bigint>, old bigint")
    )
    out = None
    for ids, block in _blocks(wanted, block_words):
        part = thinned.mapInPandas(_look_up(context.broadcast(Index(ids, block, run, radius)), least_similarity), f"row bigint, {FOUND}")
        out = part if out is None else out.unionByName(part)
    return out.groupBy("row", "doc_id", "item_id").agg(
        F.sum("windows").alias("windows"), F.max("similarity").alias("similarity"), F.max("literal").alias("literal")
    ).drop("row")


def _all_blocks(ids: list, first: list, second: tuple, rest: Iterator) -> Iterator[tuple[list, list]]:
    yield ids, first
    yield second
    yield from rest


def _look_up(index, least: float):
    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [Words(np.asarray(h, np.int64).view(np.uint64), np.asarray(n, np.int64), int(old)) for h, n, old in zip(pdf["h"], pdf["l"], pdf["old"])]
            sizes = np.cumsum([len(t) for t in texts]) // CHUNK
            for chunk in np.unique(sizes):
                some = np.flatnonzero(sizes == chunk)
                found = index.value.matches([texts[k] for k in some], least)
                if len(found):
                    at = some[found["text"].astype(int)]
                    merged = _merged(
                        found.assign(row=pdf["row"].to_numpy()[at], doc_id=pdf["doc_id"].to_numpy()[at], item_id=index.value.ids[found["item"].astype(int)]),
                        ["row", "doc_id", "item_id"]
                    )
                    yield merged.assign(literal=merged["literal"].astype(bool))

    return probe
