"""Ordinary sentences, made from parts in five languages."""

WHO = ["the baker", "our aunt", "a tall sailor", "the night guard", "nobody", "der alte Müller", "la voisine", "el pintor", "il medico", "de schilder"]
DID = [
    "painted the fence", "read four scripts by heart", "made an error of 5 crowns", "found page 404 of the book",
    "denied access to the yard", "zählte die Münzen", "a fermé la porte", "abrió la ventana", "ha letto la lettera", "sloot het raam"
]
WHEN = ["before noon", "in the rain", "at 5:30", "after 12 days", "near house 503", "im Regen", "hier soir", "ayer por la tarde", "di mattina", "in de regen"]


def prose(rng, n):
    place = lambda: "".join(rng.choices(["ba", "dor", "kel", "mi", "ru", "sta", "ven", "wick"], k=3)).capitalize()
    return " ".join(
        f"{rng.choice(WHO).capitalize()} {rng.choice(DID)} {rng.choice(['in', 'near', 'bei', 'à', 'en', 'a', 'te'])} {place()} {rng.choice(WHEN)}." for _ in range(n)
    )
