import random

import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, text_key string"


@pytest.fixture(scope="session")
def corpus():
    """Prose with exact and near copies, shared passages, junk, nulls, empty and long texts, and odd characters."""
    rng = random.Random(3)
    syllables = "ka lo mi ne ru sa to vé ßu ñe".split()
    words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(300)]

    def prose(n):
        out = rng.choices(words, k=n)
        for i in range(0, n, 12):
            out[i] = out[i].capitalize()
        return "\n".join(" ".join(out[i : i + 40]) + "." for i in range(0, n, 40))

    passage, base = prose(110), prose(160)
    texts = [prose(rng.randint(1, 220)) for _ in range(30)]
    texts += [base, base, base]
    for _ in range(6):
        near = base.split(" ")
        near[rng.randrange(len(near))] = "edited"
        texts.append(" ".join(near))
    texts += [prose(30) + " " + passage + " " + prose(30) for _ in range(4)]
    texts += ["ab" * 900, "x y " * 500, "aaaa" * 300, prose(3000), "", None, None, " \n\t ", "one", "two words", "Ünï▁cödé ▁ \x00 é"]
    texts += ["Line one here\nLine one here\n\nother", "WORDS!! IN!! CAPITALS!! " * 20, "a*** b### c$$$ " * 30]
    return texts


@pytest.fixture(scope="session")
def rows(corpus):
    """Ids with gaps; the last row is repeated whole, one id has two texts, one id is null."""
    out = [(7 * i + 3, t, ["en", "fr", None][i % 3], "s", 0, False, "clash") for i, t in enumerate(corpus)]
    out += [out[-1], (3, "another text under a known id", "en", "s", 0, False, "clash"), (None, corpus[0], "en", "s", 0, False, "clash")]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DDL).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DDL)
