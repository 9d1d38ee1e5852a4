"""Held-out wording: fit on four fifths of the seed templates, judge texts of the last fifth; run as a script."""

import random

from tests.llm.prose import prose
from tripmart.llm import residue as R
from tripmart.llm import seeds

FOLDS = 5


def _texts(fold: int) -> list[tuple[str, str]]:
    held = lambda all_: [t for i, t in enumerate(all_) if i % FOLDS == fold]
    wording = {"filler": held(seeds.FILLER), "error": held(seeds.ERROR) + held([t for t, _ in seeds.MESSAGES]), "script": held(seeds.SCRIPT)}
    out = [(k, random.Random(i).choice(seeds.expanded([t]))) for k, all_ in wording.items() for i, t in enumerate(all_)]
    return out + [("placeholder", f"Dear {s.replace('a_a', 'first_n').replace('a', 'name').replace('0', '1')}, welcome") for s in held(seeds._SLOTS)]


def recall(natural: list[str], seed: int = 4) -> dict[str, float]:
    """Share of texts of held-out templates, each put between sentences, in which residue is found, by kind."""
    rng, hits = random.Random(seed), {k: [] for k in R.KINDS}
    for fold in range(FOLDS):
        models, texts = R.fit(natural, seeds.by_kind(lambda i: i % FOLDS != fold)), _texts(fold)  # noqa: B023
        found = R._found(models.scores([f"{prose(rng, 1)} {t} {prose(rng, 1)}" for _, t in texts]))
        for j, (k, _) in enumerate(texts):
            hits[k].append(any(f[j] for f in found.values()))
    return {k: sum(h) / len(h) for k, h in hits.items()}


if __name__ == "__main__":
    rng = random.Random(1)
    print(recall([prose(rng, rng.randint(1, 6)) for _ in range(3000)]))
