"""Labelers' votes, what they are worth, and spans added to the base kinds."""

from __future__ import annotations

import random

import numpy as np
import pytest

from roadlens.llm import personal_data
from roadlens.llm.personal_data import find_personal_data, learn_spans

FILLER = "the house by the sea was sold and nobody knew why it had been empty for so long"
SCHEMA = "doc_id long, text string, maybe string, kind string"


def made(spark, texts):
    rows = [(i, f"{FILLER[: 20 + i % 50]}. {t} {FILLER[i % 40 :]}.", "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def added(spark, texts) -> list[list[tuple[str, str]]]:
    """Kind and text of the spans added in each text."""
    docs = made(spark, texts)
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = {r["doc_id"]: r["all_spans"][len(r["base_spans"]) :] for r in find_personal_data(docs).collect()}
    out = []
    for i in range(len(texts)):
        spans = [s.split(":") for s in found[i]]
        out.append([(k, text[i][int(a) : int(b)]) for k, a, b in spans])
    return out


def hexes(draw, n=24):
    return "".join(draw.choice("0123456789abcdef") for _ in range(n))


def test_names_are_found_beside_few_secrets(spark):
    draw = random.Random(1)
    names = ["we met Mary Smith there.", "then Peter Parker spoke.", "a letter by Mr Jones came."]
    texts = [names[i % 3] for i in range(1500)] + [f'token = "{hexes(draw)}"' for _ in range(13)]
    texts += [f"password: hunter{i}x" for i in range(20)]
    found = added(spark, texts)
    expected = [[("name", "Mary Smith")], [("name", "Peter Parker")], [("name", "Jones")]]
    assert all(found[i] == expected[i % 3] for i in range(1500))
    assert all(len(f) == 1 and f[0][0] == "secret" for f in found[1500:])


def test_words_without_a_vote_for_them_are_left(spark):
    for words in (["see part10b there", "and module12c too"], ["the account was shut, version11 is out"]):
        assert not any(added(spark, [words[i % len(words)] for i in range(1500)]))


def test_secrets_stay_beside_many_names():
    patterns = {"+000": 50_000}
    chance, _ = personal_data.reliabilities(list(patterns), np.array([50_000.0]), "name")
    assert chance[0] > 0.5
    tokens = {"0+00++0000": 13, "000++00000": 40, "0000-0-00-": 9000, "0000-00000": 500}
    chance, right = personal_data.reliabilities(list(tokens), np.array(list(tokens.values()), float), "secret")
    assert (chance[:2] > 0.7).all() and (chance[2:] <= 0.3 + 1e-9).all()
    assert sorted(right) == sorted(personal_data.LABELERS["secret"]) and min(right.values()) >= 0.5


def test_one_pattern_alone_never_rises_on_votes_against_it():
    for pattern in ("0000-00000", "0000-0-000", "0000-0-00-"):
        for n in (1, 10**9):
            chance, _ = personal_data.reliabilities([pattern], np.array([float(n)]), "secret")
            assert chance[0] <= personal_data.PRIOR["secret"] + 1e-9
    assert personal_data.reliabilities([], np.zeros(0))[0].size == 0


def test_spans_of_every_kind_are_found_and_others_left(spark):
    draw = random.Random(7)
    given = sorted(personal_data.NAMES)
    digits = lambda n: "".join(draw.choice("0123456789") for _ in range(n))

    def iban() -> str:
        body = digits(18)
        return f"DE{98 - int(body + '131400') % 97:02d}{body}"

    def ssn() -> str:
        return f"{draw.randint(100, 665)}-{draw.randint(10, 99)}-{draw.randint(1000, 9999)}"

    planted = [
        lambda: ("name", f"{draw.choice(given)} {draw.choice(('Miller', 'Okafor', 'Lindqvist', 'Moreau'))}", "we spoke with {} then"),
        lambda: ("name", draw.choice(("Abernathy", "Quispe Mamani")), "it was Dr. {} who left"),
        lambda: ("name", f"Zorblat {draw.choice(('Venn', 'Oduya'))}", "my name is {} and i stay"),
        lambda: ("ssn", ssn(), "ssn {} on file"),
        lambda: ("ssn", ssn(), "the number {} was read"),
        lambda: ("iban", iban(), "iban {} for it"),
        lambda: ("iban", iban(), "pay to {} now"),
        lambda: ("secret", hexes(draw, 32), 'token = "{}" was set'),
        lambda: ("secret", "AKIA" + "".join(draw.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16)), "key {} leaked"),
        lambda: ("secret", "ghp_" + hexes(draw, 30), "with {} here"),
        lambda: ("secret", draw.choice(("hunter", "correcthorse", "opensesame")) + digits(2), "password: {} again"),
        lambda: ("secret", digits(8), "account number: {} closed"),
        lambda: ("secret", digits(4), "pin = {} typed"),
    ]
    clean = [
        "The user went home and a call was made", "see item12 or part2b, chapter3a", "version2 of release10 is out",
        "they walked down Martin Luther Street", "at Charles University and James Park Station", "the key to the door was lost",
        "a secret place, a token of love", "on 12-05-2019 or 555-0199", "ABCDEFGHIJKLMNOPQRSTUV shouted", "the login page, the auth step",
        "room 123-45 and box 000-00-0000",
    ]
    texts, truth = [], []
    for i in range(2600):
        if i % 5:
            texts.append(draw.choice(clean))
            truth.append([])
        else:
            kind, value, where = planted[i // 5 % len(planted)]()
            texts.append(where.format(value))
            truth.append([(kind, value)])
    found = added(spark, texts)
    right = sum(f in t for t, fs in zip(truth, found, strict=True) for f in fs)
    recall, precision = right / sum(map(len, truth)), right / max(1, sum(map(len, found)))
    print(f"recall {recall:.3f} precision {precision:.3f}")
    missed = sorted({t[0][0] + " " + x for t, x, f in zip(truth, texts, found, strict=True) if t and t[0] not in f})[:5]
    wrong = [(x, f) for t, x, f in zip(truth, texts, found, strict=True) if set(f) - set(t)][:5]
    assert recall >= 0.9 and precision >= 0.9, (recall, precision, missed, wrong)


def test_rows_without_candidates_and_models_learned_elsewhere(spark):
    nothing = spark.createDataFrame([(1, None, None, None), (2, "", None, None), (2, "", None, None)], SCHEMA)
    assert [r["all_spans"] for r in find_personal_data(nothing).collect()] == [[], [], []]
    assert learn_spans(nothing) == {} and find_personal_data(nothing.limit(0)).count() == 0
    models = learn_spans(made(spark, ["password: hunter2x", "see part10b"] * 30))
    rows = find_personal_data(made(spark, ["password: swordfish9", "see part11c"]), models).collect()
    assert [len(r["all_spans"]) for r in sorted(rows, key=lambda r: r["doc_id"])] == [1, 0]
    long = spark.createDataFrame([(1, "plain words " * 400_000 + "password: swordfish9", "x", "y")], SCHEMA)
    assert [len(r["all_spans"]) for r in find_personal_data(long, models).collect()] == [1]


@pytest.mark.parametrize("kind", personal_data.ADDED)
def test_a_vote_for_a_span_outweighs_none(kind):
    n = len(personal_data.LABELERS[kind])
    chance, _ = personal_data.reliabilities(["+" * 2 + "0" * (n - 2), "0" * n], np.array([5.0, 500.0]), kind)
    assert chance[0] > 0.5 >= chance[1] - 1e-9
