import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import heldout
from tests.llm.prose import prose
from tripmart.llm import residue as R
from tripmart.llm import seeds

@pytest.fixture(scope="module")
def models():
    rng = random.Random(1)
    sample = [prose(rng, rng.randint(1, 6)) for _ in range(3000)] + [
        "The lines {4, 7, 12} share a quay (see map [3]), for $5. " + prose(rng, 1) for _ in range(30)
    ]
    sample += ["Please enable JavaScript to continue. " + prose(rng, 1) for _ in range(20)]
    return R.fit(sample)


def kinds(models, text):
    return {k for k, v in R._found(models.scores([text])).items() if v[0]}


@pytest.mark.parametrize(
    "text,kind",
    [
        (
            "Lorem ipsum dolor sit amet, consectetur adipiscing elit.", "filler"
        ), ("foo bar foo bar foo bar", "filler"), ("Hier steht später Ihr Text.", "filler"), ("Contenu à venir.", "filler"),
        ("Error 404: Not Found", "error"), ("502 Bad Gateway", "error"), ("Erreur 503 : Service indisponible", "error"), (
            "Su sesión ha caducado. Vuelva a iniciar sesión.", "error"
        ), ("SQLSTATE[HY000] [2002] Connection refused", "error"),
        ("Please turn on scripts to view this page.", "script"), (
            "BITTE AKTIVIEREN SIE JAVASCRIPT, UM FORTZUFAHREN.", "script"
        ), ("Veuillez  autoriser\nles scripts pour continuer", "script"), (
            "Deze site werkt niet zonder scr­ipts; inschakelen is nodig om door te gaan.", "script"
        ),
        ("Hello {{ first_name }}!", "placeholder"), (
            "Your trip {0} is confirmed.", "placeholder"
        ), (
            "Dear [insert name here],", "placeholder"
        ), ("Guten Tag ##NAME##", "placeholder"), ("Hola %(nombre)s", "placeholder"), (
            "Kind regards, ${city}", "placeholder"
        ), ("Hallo __naam__!", "placeholder"),
    ],
)
def test_residue_anywhere_in_a_text(models, text, kind):
    rng = random.Random(9)
    assert kind in kinds(models, text)
    assert kind in kinds(models, prose(rng, 5) + " " + text + " " + prose(rng, 5))


@pytest.mark.parametrize(
    "text",
    [
        "", "   ", "The lines {4, 7, 31} share a quay (see map [3]), for $9.", "The baker found page 404 of the book in the rain.",
        "A tall sailor read four scripts by heart.", "100 % of it, he said.", "0", "ж" * 30
    ]
)
def test_sentences_that_only_speak_of_it(models, text):
    assert kinds(models, text) == set()


def test_unseen_combinations_of_known_templates():
    """Fit on half of the texts the templates give, judge texts of the other half: natural ones and with such a text put in."""
    rng = random.Random(77)
    own = seeds.by_kind()
    fit_on = {k: v if k == "placeholder" else sorted(set(v))[::2] for k, v in own.items()}
    unseen = [t for k in ("error", "script", "filler") for t in sorted(set(own[k]))[1::2]]
    m = R.fit([prose(rng, rng.randint(1, 6)) for _ in range(2000)], fit_on)
    clean = [prose(rng, rng.randint(1, 8)) for _ in range(400)]
    dirty = [f"{prose(rng, 2)} {rng.choice(unseen)} {prose(rng, 2)}" for _ in range(400)]
    assert sum(bool(kinds(m, t)) for t in clean) <= 4
    assert sum(bool(kinds(m, t)) for t in dirty) >= 380


def test_wording_of_unknown_templates():
    """Whole templates held out of the fit; the figures are in the README."""
    rng = random.Random(1)
    got = heldout.recall([prose(rng, rng.randint(1, 6)) for _ in range(2000)])
    assert got["placeholder"] >= 0.88 and got["error"] >= 0.75 and got["script"] >= 0.7 and got["filler"] >= 0.4


@pytest.mark.parametrize("share", [0.001, 0.01, 0.05, 0.2])
@pytest.mark.parametrize(
    "notice,kind",
    [
        ("Please enable JavaScript to continue.", "script"), ("Error 404: Page not found.", "error"),
        ("Dear {{first_name}}, welcome", "placeholder"), ("This is dummy text. Replace it before publishing.", "filler")
    ]
)
def test_no_frequency_acquits(notice, kind, share):
    """A notice within sentences of any share of the corpus is found in all of them, and in no other text."""
    rng, n = random.Random(12), 2000
    dirty = []
    for _ in range(int(n * share)):
        w = prose(rng, 2).split()
        w.insert(rng.randrange(len(w)), notice)
        dirty.append(" ".join(w))
    clean = [prose(rng, 3) for _ in range(n - len(dirty))] + ["The lines {4, 7, 12} share a quay (see map [3]), for $5. " + prose(rng, 1) for _ in range(20)]
    m = R.fit(clean + dirty)
    assert R._found(m.scores(dirty))[kind].all() and not any(v.any() for v in R._found(m.scores(clean)).values())


def test_other_scripts():
    rng = random.Random(2)
    ru = ["Утром пекарь открыл дверь и подмёл ступеньку.", "Мы шли вдоль реки до темноты.", "Всю неделю шёл дождь, но урожай был хорошим."]
    m = R.fit([prose(rng, 3) for _ in range(1000)] + [" ".join(rng.choices(ru, k=2)) for _ in range(100)])
    assert "script" in kinds(m, "Мы шли вдоль реки. Пожалуйста, включите JavaScript, чтобы продолжить.") and "error" in kinds(m, "Ошибка: Страница не найдена")
    assert kinds(m, " ".join(ru)) == set()


def test_a_text_longer_than_a_piece(spark, monkeypatch):
    rng = random.Random(8)
    text = prose(rng, 4000)
    middle = len(text) // 2
    df = spark.createDataFrame(
        [(1, text), (2, text[:middle] + " Error 500: Internal Server Error. " + text[middle:])] + [(i, prose(rng, 2)) for i in range(10, 500)],
        "doc_id bigint, text string"
    )
    pieces, owner = R._pieces([text, "x"])
    assert len(pieces) == len(range(0, len(text) - R.OVERLAP, R.PIECE - R.OVERLAP)) + 1 and owner[-1] == 1 and max(map(len, pieces)) <= R.PIECE
    assert [(r["doc_id"], r["kind"]) for r in R.residue(df).collect()] == [(2, "error")]


def test_coverage_and_kept_documents(spark):
    rng = random.Random(6)
    notice = "Please enable JavaScript to continue."
    rows = [(i, prose(rng, 2)) for i in range(500)] + [(600, notice), (601, prose(rng, 40) + " " + notice), (None, prose(rng, 1))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = R.residue(df).collect()
    share = {r["doc_id"]: r["coverage"] for r in found}
    assert share[600] > 0.9 and share[601] < 0.1
    assert [r["doc_id"] for r in R.residue(df, least_coverage=0.5).collect()] == [600]
    assert R.excluded(df, R.residue(df)).count() == 501


def test_windows_are_localised(models):
    text = "Our aunt painted the fence in the rain. Please enable JavaScript to view this page. Nobody painted the fence."
    s = models.scores([text, "", text])
    assert s.loc[0, "script"] == s.loc[2, "script"] and s.loc[1, "script_chars"] == 0
    start, n = s.loc[0, "script_at"], s.loc[0, "script_chars"]
    assert "enable javascript to view this page" in ("\n" + R.letters(text))[start : start + n]


def test_operator(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, 2), "z", 1) for i in range(2000)] + [
        (2900, None, "z", 1), (2901, "", "z", 1), (2902, "Dear {{name}}, welcome", "z", 1),
        (2903, prose(rng, 3000) + " Error 500: Internal Server Error " + prose(rng, 3000), "z", 1),
        (2904, "Dear {{name}}, welcome", "z", 1), (2904, "Dear {{name}}, welcome", "z", 1)
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, kind string, id int")
    got = [(r["doc_id"], r["kind"]) for r in R.residue(df).collect()]
    assert sorted(got) == [(2902, "placeholder"), (2903, "error"), (2904, "placeholder"), (2904, "placeholder")]
    assert all(0 < r["coverage"] <= 1 for r in R.residue(df).collect())
    assert R.residue(df.limit(0)).count() == 0


def test_fitting_sample_is_bounded(spark):
    df = spark.createDataFrame([(i, "x" * (i + 1)) for i in range(50)], "doc_id bigint, text string")
    sample = R.fitting_sample(df, "doc_id", "text", 10, 20)
    assert len(sample) == 10 and max(map(len, sample)) <= 20 and sample == R.fitting_sample(df.repartition(7), "doc_id", "text", 10, 20)


@pytest.mark.parametrize(
    "notice,kind",
    [
        ("Please enable JavaScript to continue.", "script"), ("Error 404: Page not found.", "error"),
        ("Dear {{first_name}}, welcome", "placeholder"), ("This is dummy text. Replace it before publishing.", "filler")
    ]
)
def test_residue_in_a_third_of_the_sample(notice, kind):
    rng = random.Random(12)
    clean = [f"{prose(rng, 2)} {rng.choice(['Si prega di portare 41 sedie.', 'See map [3] for it.', ''])}" for _ in range(1000)]
    notices = [f"{prose(rng, 2)} {notice} {prose(rng, 2)}" for _ in range(250)] + [notice] * 250
    m = R.fit(clean + notices)
    assert R._found(m.scores(notices))[kind].all()
    assert not any(v.any() for v in R._found(m.scores(clean)).values())


def test_long_residue_leaves_the_next_texts_alone(models):
    rng = random.Random(21)
    long = ("Lorem ipsum dolor sit amet, consectetur adipiscing elit. " * 2000)[:100_000]
    clean = [prose(rng, 3) for _ in range(20)]
    together, alone = models.scores([long, *clean]), models.scores(clean)
    assert R._found(together)["filler"].tolist() == [True] + [False] * 20
    assert together.iloc[1:].reset_index(drop=True).equals(alone)


def test_long_documents_are_fitted_on(spark):
    """Words that natural documents of over 4,000 characters use in many surroundings count for less in a notice."""
    rng = random.Random(4)
    some = lambda: "".join(rng.choices("abdeikmnorstu", k=rng.randint(4, 8)))
    said = lambda n: " ".join(f"{some().capitalize()} {some()} {rng.choice(['please', 'enable', 'continue', 'javascript'])} {some()} {some()}." for _ in range(n))
    notice = (900, "Please enable JavaScript to continue.")
    short, long = [(i, prose(rng, 2)) for i in range(300)], [(i, said(150)) for i in range(400, 420)]
    assert min(len(t) for _, t in long) > 4000
    score = lambda rows: {r["doc_id"]: r["score"] for r in R.residue(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    without, among = score([*short, notice]), score([*short, *long, notice])
    assert set(without) == set(among) == {900} and among[900] < without[900]


def test_the_fit_of_a_table_is_that_of_its_texts(spark):
    """Counts of partitions add up to those of all texts, sentences met before and long texts included."""
    rng = random.Random(14)
    texts = [prose(rng, rng.choice([1, 2, 60])) for _ in range(200)] + ["Error 404: Page not found. " + prose(rng, 2) for _ in range(20)] + ["x" * 250_000]
    texts += [f"{t}\n{texts[0]}" for t in texts[1:20]]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    order = [r["text"] for r in df.orderBy(F.xxhash64("text", F.lit(23))).collect()]
    here = R.fit(order)
    for most in (0, 200_000):
        there = R.fit_all(R._viewed(df.repartition(5)), broadcast_rows=most)
        assert all((here.tables[k] == there.tables[k]).all() for k in R.KINDS)


def test_other_grams_have_no_place_of_seeds():
    own = np.arange(1, 2000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    places = R.Places(np.unique(own))
    assert len(set(places.of(own).tolist())) == len(own) and places.of(own).min() >= 1 << R.TABLE_BITS
    assert places.of(own ^ np.uint64(1)).max() < 1 << R.TABLE_BITS
    assert R.Places(own[:0]).of(own).max() < 1 << R.TABLE_BITS
