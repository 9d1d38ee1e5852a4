"""How alike two field names are: their words, weighted by how much they tell."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Mapping


def plain(name: str) -> str:
    """A name without case and separators."""
    return re.sub(r"[^0-9a-z]", "", name.lower())


def tokens(name: str) -> list[str]:
    """The different words of a name, cut at separators and where capitals begin."""
    spaced = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1 \2", name))
    return list(dict.fromkeys(re.findall(r"[0-9a-z]+", spaced.lower())))


def weights(fields: Iterable[str]) -> dict[str, float]:
    """A word that stands in several of the fields tells the less which of them is meant."""
    return {t: 1 / n for t, n in Counter(t for f in fields for t in tokens(f)).items()}


def _alike(a: str, b: str) -> bool:
    """The same word, one the beginning of the other, one with letters put in, or one without the other's vowels."""
    if a == b:
        return True
    short, long = sorted((a, b), key=len)
    stem = len(short) >= 4 and long.startswith(short[: max(4, len(short) - 2)]) and len(long) - len(short) <= 4
    put_in = len(long) - len(short) <= 3 and any(long.startswith(short[:i]) and long.endswith(short[i:]) for i in range(4, len(short) - 1))
    return len(short) >= 3 and long.startswith(short) or stem or put_in or len(short) >= 4 and long[0] == short[0] and re.sub("[aeiou]", "", long) == re.sub("[aeiou]", "", short)


def _joined(x: list[str], y: list[str]) -> list[str]:
    """``x`` with neighbours that are one word of ``y`` put together."""
    out, i = [], 0
    while i < len(x):
        two = "".join(x[i : i + 2])
        if i + 1 < len(x) and any(_alike(two, t) for t in y if t.endswith(x[i + 1])):
            out.append(two)
            i += 2
        else:
            out.append(x[i])
            i += 1
    return out


def similarity(a: str, b: str, telling: Mapping[str, float] | None = None) -> float:
    """1 for names equal but for case and separators, 0.95 where one is the initials of the other, else weighted Dice of the words."""
    if plain(a) == plain(b):
        return 1.0
    x, y = tokens(a), tokens(b)
    for one, other in ((x, b), (y, a)):
        if len(one) >= 3 and "".join(w[0] for w in one) == plain(other):
            return 0.95
    x, y = _joined(x, y), _joined(y, x)
    weight = lambda t: (telling or {}).get(t, 0.3)
    left, shared, whole = list(y), 0.0, sum(map(weight, x)) + sum(map(weight, y))
    for t in x:
        for u in left:
            if _alike(t, u):
                # a word means what the field's word it resembles means
                shared += 2 * max(weight(t), weight(u))
                whole += 2 * max(weight(t), weight(u)) - weight(t) - weight(u)
                left.remove(u)
                break
    return min(0.99, shared / whole) if whole else 0.0
