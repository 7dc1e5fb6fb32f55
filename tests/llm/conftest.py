"""Small tables with the awkward cases every operator must take."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, y double, row_key string, score string, words string, h int, part int"
SYLLABLES = "an er in on re th st ou ha le ne ti ra mo ka lu do vi se".split()


def prose(rng, n, forms=SYLLABLES):
    return " ".join("".join(rng.choice(forms) for _ in range(rng.randint(1, 3))) + (".\n" if rng.random() < 0.06 else "") for _ in range(n))


def rows():
    rng = random.Random(5)
    out = []
    for i in range(60):
        out.append((i, prose(rng, rng.randint(12, 200)), "en" if i % 3 else "de", f"src{i % 3}", 1))
    base = out[7][1]
    out += [
        (100, None, None, None, None), (101, "", "en", "src0", 0), (102, "  \n\t ", "en", None, 0), (103, "one", "en", "src1", 3),
        (104, base, "en", "src1", 3), (105, base, "de", "src2", 3), (106, base + " extra", None, "src2", 3),
        (107, "same same same same same same same same same same same same", "en", "src1", 1),
        (108, prose(rng, 30_000), "en", "src0", 1), (109, "Ünï çode — ñandú «x»   wörd\tÉ 12,5 \r\n x", "fr", "src0", 1),
        (110, out[3][1] + "\n" + out[3][1], "en", "src0", 1), (111, "### $$$ %%% &&& *** <<< >>> ||| # $ % &", "en", "src0", 1),
        (112, "A\x00B c\x1cd Kelvin <|endoftext|> \\ [INST] x", "en", "src0", 1),
    ]
    out += [out[8], out[8], (None, out[9][1], "en", "src0", 1), (None, None, None, None, None)]
    return out


@pytest.fixture(scope="session")
def doc_rows():
    return rows()


@pytest.fixture(scope="session")
def docs(spark, doc_rows):
    """Documents with repeated rows, nulls, long and empty texts, and columns whose names clash
    with those that operators use."""
    return spark.createDataFrame([(*r, 1.0, "k", "s", "w", 1, 1) for r in doc_rows], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
