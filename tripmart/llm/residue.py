"""Template residue and error-page text: likelihood-ratio windows of character n-gram models.

Four models of residue (filler, error messages, notices that scripts must be allowed, unfilled placeholders) stand
against one of natural prose. Words are judged by seven-character grams of the text without case, accents,
invisible characters and line ends, digits as 0, in any script; placeholders by five-character grams of its shape,
in which a word is ``a`` and a number 0. Each gram gives the logarithm of its likelihood under a residue model over
that under the natural one. Walking over a text, every stretch whose sum rises to the model's score is a window of
residue. A document is excluded when its windows cover at least the kind's characters and ``least_coverage`` of it.

The residue models are fitted on seed texts, the natural one on all documents, whole and each sentence once, and on a
few sentences that only speak of errors. The documents are counted where they lie, in passages of some thousand
characters; counts carry no labels but those the models give: a passage in which a fit finds residue is left out of the
next. In the first natural model a gram counts by the different surroundings it is met in, not by how often: a notice
copied into any share of the corpus always stands in the same surroundings and so acquits none of its grams, while
ordinary words, met between many others, count as often as they occur. Grams of the seeds have places of their own in
the tables, others share places by hash, so that however large a corpus is, its other grams don't stand for those of the seeds.

All documents are then scored, each as a whole whatever its length: a text longer than ``PIECE`` characters is walked in
pieces that overlap.

Null, empty and blank texts hold no residue. Repeated documents are judged alike, each giving its row.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm import seeds
from tripmart.llm.text import plain, spread
from tripmart.session import checkpoint

GRAM, SHAPE_GRAM, TABLE_BITS = 7, 5, 22
#: Score a window needs, and covered characters a document needs.
LIMITS = {"filler": (24.0, 8), "error": (40.0, 8), "script": (36.0, 12), "placeholder": (8.0, 3)}
#: Share of the score at which a passage is left out of the next fit; sentences that only speak of errors shall stay in.
LEFT_OUT = {"filler": 1.2, "error": 1.2, "script": 1.2, "placeholder": 1.2}
#: The part of the score that is enough where a window is this part of the whole text.
SHORT, WHOLE = 0.6, 0.8
KINDS = list(LIMITS)
#: The same in the first fit, in which no frequency acquits.
SURE = {"filler": 1.6, "error": 1.5, "script": 1.6, "placeholder": 1.3}
FITS = 4
#: Characters worked on at once, and those of a piece of a longer text with its overlap; they bound the memory of a task.
CHUNK, PIECE, OVERLAP = 400_000, 200_000, 4_000
#: Characters of a passage, where its sentences allow.
PASSAGE = 4_000
_SCALE, _CLIP, _FLOOR, _WARY = 16.0, (-4.0, 6.0), 2e-7, 4.0
#: Characters of a gram's surroundings on either side, the bits of their sketch, and those set in the sketch of a gram that is met anywhere.
AROUND, SKETCH, ANYWHERE = 5, 32, 16
_SPACE, _DIGIT, _NUMBER, _LETTERS = regex.compile(r"[\s\p{Zs}]+"), regex.compile(r"\p{Nd}"), regex.compile(r"\p{Nd}+(?:[.,:]\p{Nd}+)*"), regex.compile(r"\p{L}+(?:['’]\p{L}+)*")
_TAG = regex.compile(r"</?(?:p|br|b|i|u|em|strong|h[1-6]|div|span|a|ul|ol|li|td|tr|table|html|body|noscript)\b[^<>]*>")
_SENTENCE = regex.compile(r"(?<=[.!?…])\s+|\n")
_BREAK = regex.compile(r"(?<=\p{L})['’](?=\p{L})")
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)


def letters(text: str) -> str:
    return _SPACE.sub(" ", _DIGIT.sub("0", _BREAK.sub("'", plain(text)))).strip()


def shape(text: str) -> str:
    t = _NUMBER.sub("0", _LETTERS.sub("a", _TAG.sub(" ", plain(text))))
    return _SPACE.sub(" ", t).strip()


VIEWS = {k: (shape, SHAPE_GRAM) if k == "placeholder" else (letters, GRAM) for k in KINDS}


def _hashes(code: np.ndarray, n: int, size: int) -> np.ndarray:
    """Hashes of the n code points from each of ``size`` positions on."""
    g = np.zeros(size, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            g = g * _MIX + code[i : i + size]
        return (g ^ (g >> np.uint64(29))) * _ODD


def _joined(texts: Sequence[str], pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the texts between ``pad`` line ends, with where each text and the next one starts."""
    edge = "\n" * pad
    padded = [f"{edge}{t}{edge}" for t in texts]
    code = np.frombuffer(("".join(padded) + "\n" * (GRAM + AROUND)).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, padded), np.int64, len(padded))
    starts = np.cumsum(lengths) - lengths
    return code, starts, starts + lengths


class Places:
    """Places of grams in the tables: of each gram of the seeds its own, of the others by hash."""

    def __init__(self, own: np.ndarray):
        self.own = own
        self.size = (1 << TABLE_BITS) + len(own)
        self._near = np.zeros(1 << TABLE_BITS, bool)
        self._near[own >> np.uint64(64 - TABLE_BITS)] = True

    def __reduce__(self):
        return Places, (self.own,)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        place = (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        near = np.flatnonzero(self._near[place])
        if len(near):
            rank = np.minimum(np.searchsorted(self.own, hashes[near]), len(self.own) - 1)
            same = self.own[rank] == hashes[near]
            place[near[same]] = (1 << TABLE_BITS) + rank[same]
        return place


def _places(own: dict[str, list[str]]) -> dict:
    """Places by view, of seed texts already normalised."""
    out = {}
    for view, n in dict.fromkeys(VIEWS.values()):
        seen = [np.zeros(0, np.uint64)]
        for k in (k for k, v in VIEWS.items() if v == (view, n)):
            code, starts, ends = _joined(own[k], 1)
            size = int(ends[-1]) if len(ends) else 0
            seen.append(_hashes(code, n, size)[np.arange(size) + n <= np.repeat(ends, ends - starts)])
        out[view] = Places(np.unique(np.concatenate(seen)))
    return out


def _grams(texts: Sequence[str], n: int, places: Places) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table places of all grams of texts between line ends, where each text starts, and which grams cross texts."""
    code, starts, ends = _joined(texts, 1)
    size = int(ends[-1]) if len(ends) else 0
    return places.of(_hashes(code, n, size)), starts, np.arange(size) + n > np.repeat(ends, ends - starts)


def _counts(texts: Sequence[str], n: int, places: Places) -> tuple[np.ndarray, float]:
    """Counts of the grams of seeds, in the order of their places."""
    place, _, across = _grams(texts, n, places)
    total = np.bincount(place[~across] - (1 << TABLE_BITS), minlength=len(places.own))
    return total.astype(np.float64), float(max(total.sum(), 1))


class Counted:
    """Grams of prose by place: how often, and a sketch of their surroundings on either side."""

    def __init__(self, n: int, places: Places):
        self.n, self.places = n, places
        self.often = np.zeros(places.size, np.int64)
        self.sides = [np.zeros(places.size, np.uint32) for _ in range(2)]

    def add(self, texts: Sequence[str], times: int = 1) -> None:
        for some in _chunks(texts):
            code, starts, ends = _joined(some, AROUND + 1)
            size = int(ends[-1])
            place = self.places.of(_hashes(code, self.n, size))
            near = (_hashes(code, AROUND, size + GRAM) >> np.uint64(64 - 5)).astype(np.uint32)
            at = np.arange(size)
            inside = (at >= np.repeat(starts, ends - starts) + AROUND) & (at + self.n + AROUND <= np.repeat(ends, ends - starts))
            p, at = place[inside], at[inside]
            np.add.at(self.often, p, times)
            for side, where in zip(self.sides, (at - AROUND, at + self.n)):
                np.bitwise_or.at(side, p, np.uint32(1) << near[where])

    def rows(self) -> pd.DataFrame:
        """What is counted, to be added up with that of others."""
        at = np.flatnonzero(self.often)
        return pd.DataFrame({"place": at, "often": self.often[at], **{c: s[at].astype(np.int64) for c, s in zip(("before", "after"), self.sides)}})

    def merge(self, rows: pd.DataFrame, sign: int = 1) -> None:
        """Add rows of which each has another place, or take them away: from ``often``, sketches stay."""
        at = rows["place"].to_numpy()
        self.often[at] += sign * rows["often"].to_numpy()
        for side, c in zip(self.sides, ("before", "after")):
            side[at] |= rows[c].to_numpy().astype(np.uint32)

    def met(self) -> tuple[np.ndarray, float]:
        """By surroundings: how many different ones on the side with fewer, or how often where it is met anywhere."""
        least = np.minimum(*[np.bitwise_count(s) for s in self.sides]).astype(np.float64)
        different = -SKETCH * np.log(1 - np.minimum(least, ANYWHERE) / SKETCH)
        return np.where(least >= ANYWHERE, self.often, np.minimum(self.often, different)), float(max(self.often.sum(), 1))

    def all(self) -> tuple[np.ndarray, float]:
        return self.often.astype(np.float64), float(max(self.often.sum(), 1))


def _chunks(texts: Sequence[str]) -> Iterator[Sequence[str]]:
    """Texts in turn, of about ``CHUNK`` characters together."""
    first = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK or i == len(texts) - 1:
            yield texts[first : i + 1]
            first, size = i + 1, 0


def _ratios(own: tuple[np.ndarray, float], natural: tuple[np.ndarray, float]) -> np.ndarray:
    """Log likelihood ratios by table place, in sixteenths; the grams of seeds come last."""
    r = natural[0] / natural[1] + _WARY * _FLOOR
    shares = np.full(len(r), _FLOOR)
    shares[1 << TABLE_BITS :] += own[0] / own[1]
    return np.round(np.clip(np.log(shares / r), *_CLIP) * _SCALE).astype(np.int8)


@dataclass
class Models:
    tables: dict[str, np.ndarray]
    places: dict

    def __getstate__(self) -> dict:
        # small on its way to executors: the places of other grams are alike in all kinds of a view
        shared, cut = {VIEWS[k][0]: t for k, t in self.tables.items()}, 1 << TABLE_BITS
        return {"shared": {v: zlib.compress(t[:cut].tobytes(), 1) for v, t in shared.items()}, "own": {k: t[cut:] for k, t in self.tables.items()}, "places": self.places}

    def __setstate__(self, state: dict) -> None:
        shared = {v: np.frombuffer(zlib.decompress(t), np.int8) for v, t in state["shared"].items()}
        self.tables = {k: np.concatenate([shared[VIEWS[k][0]], t]) for k, t in state["own"].items()}
        self.places = state["places"]

    def scores(self, texts: Sequence[str]) -> pd.DataFrame:
        """Per text and kind: the greatest window's score, where in the normalised text it is and its characters, and those of all windows (``covered``) of ``length``."""
        views = {view: [view(t) for t in texts] for view in dict.fromkeys(v for v, _ in VIEWS.values())}
        return self.seen(views)

    def seen(self, views: dict) -> pd.DataFrame:
        """``scores`` of texts already normalised, by view."""
        out = {}
        for view, n in dict.fromkeys(VIEWS.values()):
            place, starts, across = _grams(views[view], n, self.places[view])
            for k in (k for k, v in VIEWS.items() if v == (view, n)):
                out.update(self._walk(k, n, place, starts, across))
            out[f"{view.__name__}_length"] = np.fromiter(map(len, views[view]), np.int64, len(views[view]))
        return pd.DataFrame(out)

    def reached(self, views: dict, ease: dict[str, float]) -> np.ndarray:
        """Which texts reach that part of any kind's score."""
        hit = np.zeros(len(views[letters]), bool)
        for view, n in dict.fromkeys(VIEWS.values()):
            place, starts, across = _grams(views[view], n, self.places[view])
            for k in (k for k, v in VIEWS.items() if v == (view, n) and len(starts)):
                hit |= self._gain(k, place, starts, across)[1] >= ease[k] * LIMITS[k][0]
        return hit

    def _gain(self, k: str, place: np.ndarray, starts: np.ndarray, across: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sum of the stretch that ends at each gram, and the greatest of each text."""
        ratio = self.tables[k][place].astype(np.float64) / _SCALE
        ratio[across] = 0.0
        # a step down before each text, deeper than all texts together are high, keeps windows inside their text
        ratio[starts] -= np.maximum(ratio, 0.0).sum() + 1.0
        up = np.cumsum(ratio)
        gain = up - np.minimum.accumulate(up)
        return gain, np.maximum.reduceat(gain, starts)

    def _walk(self, k: str, n: int, place: np.ndarray, starts: np.ndarray, across: np.ndarray) -> dict[str, np.ndarray]:
        if not len(starts):
            return {c: np.zeros(0) for c in (k, f"{k}_at", f"{k}_chars", f"{k}_covered")}
        gain, most = self._gain(k, place, starts, across)
        at, chars, covered = (np.zeros(len(starts), np.int64) for _ in range(3))
        # only texts that may hold residue are looked at window by window
        for t in np.flatnonzero(most >= SHORT * LIMITS[k][0]):
            part = gain[starts[t] : starts[t + 1] if t + 1 < len(starts) else len(gain)]
            # a stretch begins at each new low; its window ends at its first greatest gain
            begins = np.flatnonzero(part == 0.0)
            best = np.maximum.reduceat(part, begins)
            for s in np.flatnonzero(best >= min(LIMITS[k][0], most[t])):
                end = begins[s] + int(np.argmax(part[begins[s] : begins[s + 1] if s + 1 < len(begins) else len(part)]))
                size = end - begins[s] + n - 1
                covered[t] += size
                if best[s] == most[t] and not chars[t]:
                    at[t], chars[t] = begins[s], size
        return {k: most, f"{k}_at": at, f"{k}_chars": chars, f"{k}_covered": covered}


def _found(scores: pd.DataFrame, ease: dict[str, float] | None = None) -> dict[str, pd.Series]:
    """Which texts hold each kind of residue; with ``ease`` at other scores, and only by their windows."""
    out = {}
    for k, (least, c) in LIMITS.items():
        hit = scores[k] >= least * (ease[k] if ease else 1.0)
        if ease is None:
            hit |= (scores[k] >= least * SHORT) & (scores[f"{k}_chars"] >= WHOLE * scores[f"{VIEWS[k][0].__name__}_length"])
        out[k] = hit & (scores[f"{k}_chars"] >= c)
    return out


class _Fit:
    """Models of seeds against prose that may hold any share of residue: what a fit finds in it is left out of the next.

    ``own`` holds the seed texts of each kind, by default all of ``seeds``; those of placeholders are shapes.
    """

    def __init__(self, own: dict[str, list[str]] | None = None):
        given = own or seeds.by_kind()
        seen = {k: given[k] if k == "placeholder" else [letters(t) for t in given[k]] for k in KINDS}
        self.places = _places(seen)
        self.own = {k: _counts(seen[k], VIEWS[k][1], self.places[VIEWS[k][0]]) for k in KINDS}

    def models(self, base: dict) -> Models:
        return Models({k: _ratios(self.own[k], base[VIEWS[k][0]]) for k in KINDS}, self.places)

    def run(self, prose: dict, look: Callable[[Models, dict[str, float]], dict[object, pd.DataFrame]]) -> Models:
        """Fit on counts of all prose; ``look`` leaves out the passages a model finds and gives their counts by view."""
        for view, c in prose.items():
            c.add([view(t) for t in seeds.NATURAL], 3)
        for k in range(FITS):
            models = self.models({view: c.all() if k else c.met() for view, c in prose.items()})
            if k == FITS - 1:
                break
            gone = look(models, LEFT_OUT if k else SURE)
            if k and not any(map(len, gone.values())):
                break
            for view, rows in gone.items():
                prose[view].merge(rows, -1)
        return models


def fit(natural: Sequence[str], own: dict[str, list[str]] | None = None) -> Models:
    """Fit on texts that are all here, as ``fit_all`` does on a table."""
    run, seen, prose = _Fit(own), set(), []
    for t in natural:
        said, again = sentences(t), []
        for i, s in enumerate(said):
            if s in seen:
                again.append(i)
            seen.add(s)
        prose += _passages(t, " ".join(said), shape(t or ""), again)
    counted = _counted(run.places)
    _count(prose, counted)

    def look(models: Models, ease: dict[str, float]) -> dict[object, pd.DataFrame]:
        nonlocal prose
        gone = _counted(run.places)
        prose = _count(prose, gone, models, ease)
        return {view: c.rows() for view, c in gone.items()}

    return run.run(counted, look)


def _counted(places: dict) -> dict:
    return {view: Counted(n, places[view]) for view, n in dict.fromkeys(VIEWS.values())}


def _any(models: Models, views: dict, ease: dict[str, float]) -> np.ndarray:
    """Which texts hold residue at these scores; only those that reach one are walked window by window."""
    hit = models.reached(views, ease)
    at = np.flatnonzero(hit)
    if len(at):
        some = {view: [t[i] for i in at] for view, t in views.items()}
        hit[at] = np.any(list(_found(models.seen(some), ease).values()), axis=0)
    return hit


def _count(prose: list[tuple[str, str]], counted: dict, models: Models | None = None, ease: dict[str, float] | None = None) -> list[tuple[str, str]]:
    """Count passages, with models only those in which they find residue; the others are returned."""
    rest, first = [], 0
    for some in _chunks([x[0] for x in prose]):
        views = {letters: list(some), shape: [x[1] for x in prose[first : first + len(some)]]}
        first += len(some)
        gone = _any(models, views, ease) if models else np.zeros(len(some), bool)
        for view, c in counted.items():
            c.add([t for t, g in zip(views[view], gone) if g or not models])
        rest += [x for *x, g in zip(views[letters], views[shape], gone) if not g]
    return rest


def sentences(text: str | None) -> list[str]:
    """The normalised sentences that aren't empty; together they are ``letters`` of the text."""
    return [key for s in _SENTENCE.split(text or "") if (key := letters(s))]


def _passages(text: str | None, seen: str, shaped: str, again: Sequence[int]) -> list[tuple[str, str]]:
    """Both views of a text's passages without the sentences met before (``again``): of a short text without any, those given."""
    if not len(again) and len(text or seen) <= PASSAGE:
        return [(seen, shaped)] if seen else []
    met, out, size = set(again), [[]], 0
    said = (s for s in _SENTENCE.split(text) if letters(s))
    for s in (s[i : i + PIECE] for k, s in enumerate(said) if k not in met for i in range(0, len(s), PIECE)):
        if size + len(s) > PASSAGE and out[-1]:
            out.append([])
            size = 0
        out[-1].append(s)
        size += len(s)
    return [(" ".join(filter(None, map(letters, part))), shape(" ".join(part))) for part in out if part]


_COUNTS = "view int, place bigint, often bigint, before bigint, after bigint, letters string, shape string"


def _counting(rows: DataFrame, sent: Broadcast, ease: dict[str, float] | None = None) -> DataFrame:
    """``_count`` over a table: of texts with the sentences met before, or, with models sent and ``ease``, of passages.

    The rows are the counts by view and place, and those of view -1 the passages left.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = sent.value if ease else None
        counted = _counted(models.places if ease else sent.value)
        for pdf in batches:
            if ease:
                prose = list(zip(pdf["letters"], pdf["shape"]))
            else:
                prose = [x for *t, again in zip(pdf["text"], pdf["letters"], pdf["shape"], pdf["again"]) for x in _passages(*t, () if again is None else again)]
            rest = _count(prose, counted, models, ease)
            if rest:
                yield pd.DataFrame({"view": -1, "place": 0, "often": 0, "before": 0, "after": 0, "letters": [x[0] for x in rest], "shape": [x[1] for x in rest]})
        for i, c in enumerate(counted.values()):
            if len(part := c.rows()):
                yield part.assign(view=i, letters="", shape="")

    return checkpoint(rows.mapInPandas(work, _COUNTS))


def _added(counts: DataFrame) -> dict[object, pd.DataFrame]:
    """Counts added up by view and place: at most as many rows as the tables have places."""
    out = {}
    for i, view in enumerate(dict.fromkeys(v for v, _ in VIEWS.values())):
        by = counts.where(F.col("view") == i).groupBy("place")
        out[view] = by.agg(F.sum("often").alias("often"), F.bit_or("before").alias("before"), F.bit_or("after").alias("after")).toArrow().to_pandas()
    return out


def _viewed(rows: DataFrame) -> DataFrame:
    """``id, text`` with both views of the text, its sentences and a number ``row``."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            said = [sentences(t) for t in pdf["text"]]
            yield pdf.assign(letters=[" ".join(x) for x in said], shape=[shape(t) for t in pdf["text"]], sentences=said)

    seen = rows.mapInPandas(work, "id bigint, text string, letters string, shape string, sentences array<string>")
    return checkpoint(seen.withColumn("row", F.monotonically_increasing_id()))


def _met_before(viewed: DataFrame) -> DataFrame:
    """``row, again``: the places of sentences in a text that are met before, in it or in a text first by hash."""
    said = viewed.select("row", F.xxhash64("text", F.lit(23)).alias("h"), F.posexplode("sentences").alias("pos", "s"))
    said = said.select(F.xxhash64("s").alias("key"), F.struct("h", "row", "pos").alias("at"))
    first = said.groupBy("key").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    again = said.join(first, "key").where(F.col("at") != F.col("first"))
    return again.groupBy(F.col("at.row").alias("row")).agg(F.collect_list("at.pos").alias("again"))


def fit_all(viewed: DataFrame, *, broadcast_rows: int = 200_000) -> Models:
    """``fit`` on all texts of ``_viewed``.

    The list of texts with sentences met before is broadcast while they are at most ``broadcast_rows``, else joined by shuffle.
    """
    run, context = _Fit(), viewed.sparkSession.sparkContext
    again = checkpoint(_met_before(viewed))
    again = F.broadcast(again) if again.count() <= broadcast_rows else again
    cut = F.col("again").isNotNull() | (F.length("text") > PASSAGE)
    texts = viewed.join(again, "row", "left").select(F.when(cut, F.col("text")).alias("text"), "letters", "shape", "again")
    sent = context.broadcast(run.places)
    counts = _counting(texts, sent)
    sent.destroy()
    prose = _counted(run.places)
    for view, rows in _added(counts).items():
        prose[view].merge(rows)

    def look(models: Models, ease: dict[str, float]) -> dict[object, pd.DataFrame]:
        nonlocal counts
        now = context.broadcast(models)
        counts = _counting(counts.where("view = -1").select("letters", "shape"), now, ease)
        now.destroy()
        return _added(counts)

    return run.run(prose, look)


def fitting_sample(documents: DataFrame, doc_id: str, text: str, sample_documents: int, sample_chars: int, seed: int = 23) -> list[str]:
    """Some texts for trying out ``fit`` by hand; the operator fits on all documents."""
    rows = documents.select(F.col(text).alias("t"), F.xxhash64(F.col(doc_id), F.lit(seed)).alias("h")).where(F.length("t").between(1, sample_chars))
    return [r["t"] for r in rows.orderBy("h", "t").limit(sample_documents).collect()]


def _pieces(texts: Sequence[str]) -> tuple[list[str], list[int]]:
    """Texts cut into overlapping pieces, with the place of the text each belongs to."""
    step = PIECE - OVERLAP
    cut = [(t[i : i + PIECE], k) for k, t in enumerate(texts) for i in range(0, max(len(t) - OVERLAP, 1), step)]
    return [t for t, _ in cut], [k for _, k in cut]


def _judged(models: Models, pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """What the texts of a frame with both views hold; a text longer than a piece is walked in pieces."""
    ids, pieces, owner = pdf["id"].to_numpy(), [], []
    for i, (t, *views) in enumerate(zip(pdf["text"], pdf["letters"], pdf["shape"])):
        cut = [views] if len(t) <= PIECE else [(letters(x), shape(x)) for x in _pieces([t])[0]]
        pieces += cut
        owner += [i] * len(cut)
    parts, first = [], 0
    for some in _chunks([x[0] for x in pieces]):
        parts.append(models.seen({letters: some, shape: [x[1] for x in pieces[first : first + len(some)]]}))
        first += len(some)
    scores = pd.concat(parts, ignore_index=True)
    for k, hit in _found(scores).items():
        if hit.any():
            view = VIEWS[k][0].__name__
            s = pd.DataFrame(
                {
                    "text": np.array(owner), "score": scores[k], "starts": scores[f"{k}_at"], "chars": scores[f"{k}_chars"],
                    "covered": scores[f"{k}_covered"], "length": scores[f"{view}_length"]
                }
            )
            whole = s.groupby("text")[["covered", "length"]].sum()
            best = s[hit].sort_values(["text", "score"], ascending=[True, False], kind="stable").drop_duplicates("text").set_index("text")
            share = np.minimum(1.0, whole["covered"] / whole["length"].clip(lower=1)).reindex(best.index)
            yield pd.DataFrame(
                {
                    "doc_id": ids[best.index], "kind": k, "score": best["score"].to_numpy(), "starts": best["starts"].to_numpy(),
                    "chars": best["chars"].to_numpy(), "coverage": share.to_numpy()
                }
            )


def residue(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text", least_coverage: float = 0.0) -> DataFrame:
    """``doc_id, kind, score, starts, chars, coverage``: a row for each kind of residue of which a document has enough.

    ``starts`` and ``chars`` are those of the best window in the normalised text (of the piece, in a text cut into
    pieces); ``coverage`` is the share of the normalised text that all windows cover.
    """
    rows = spread(documents.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text")).where(F.length("text") > 0))
    viewed = _viewed(rows)
    sent = viewed.sparkSession.sparkContext.broadcast(fit_all(viewed))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sizes = pdf["text"].str.len()
            for _, some in pdf.groupby((sizes.cumsum() - sizes) // CHUNK, sort=False):
                yield from _judged(sent.value, some)

    return viewed.select("id", "text", "letters", "shape").mapInPandas(
        judge, "doc_id bigint, kind string, score double, starts bigint, chars bigint, coverage double"
    ).where(F.col("coverage") >= least_coverage)


def excluded(documents: DataFrame, found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents without residue: those whose id ``found`` doesn't hold; documents without id stay."""
    gone = found.select(F.col("doc_id").alias("__gone")).distinct()
    return documents.join(gone, F.col(doc_id).cast("bigint") == F.col("__gone"), "left_anti")
