import random

import pytest

ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, name string, kind string, key string, label long"


@pytest.fixture(scope="session", autouse=True)
def code(spark):
    from sedimenta.llm.queries import share_code

    share_code(spark)


def prose(rng, n, words=("the of and to in is that for it was on are as with at by this be from or "
                         "river stone house garden winter letter market engine valley bridge").split()):
    return " ".join(rng.choice(words) + (rng.choice("abcdefgh") if rng.random() < 0.4 else "") for _ in range(n))


def odd_texts():
    """Null, empty, blank, very long, repeated and tied texts, near copies, and several scripts."""
    rng = random.Random(11)
    base = prose(rng, 120)
    words = base.split()
    near = " ".join([*words[:60], "changed", *words[61:]])
    return [
        None,
        "",
        " \t\n ",
        "one",
        base,
        base.replace(" ", "  "),
        base,
        near,
        prose(rng, 30_000),
        "line one\nline two\nline one\n" * 40,
        "x" * 70_000,
        "Füße und Straße\nº ª ½ ''quote's '' it'll",
        "日本語のテキスト 한국어 😀 ́x İstanbul ΣΑΣ",
        "a\x1cb\x85c\xa0d\r\n\v\f e",
        *(prose(rng, rng.randint(3, 200)) for _ in range(30)),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every kind of odd row, null and repeated ids, and columns that operators also use inside."""
    rows = [(i, t, ["en", None, "xx"][i % 3], ["hot", None, "www.a.example.de"][i % 3], 1, 2, "n", "k", "x", 3) for i, t in enumerate(odd_texts())]
    rows += [(None, "the river is in the valley", None, None, None, None, None, None, None, None)] * 2
    rows += [(4, "another text under a used id", "en", "hot", 1, 1, "", "", "", 1)] * 2
    return spark.createDataFrame(rows, ODD_SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
