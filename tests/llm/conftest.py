"""Small tables with every awkward row, for the operators of seatcast.llm."""

import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType()),
                     # extra columns whose names operators also use inside
                     T.StructField("score", T.StringType()), T.StructField("hash", T.StringType()),
                     T.StructField("id", T.StringType()), T.StructField("prediction", T.StringType())])
SYLLABLES = {"en": "the and ing tion er on re at en is".split(), "de": "sch ung ein der ich über keit ß zu ver".split(),
             "fr": "eau oi que ê é è les aux ment tre".split()}


def sentence(rng, lang, n):
    s = SYLLABLES[lang]
    return " ".join("".join(rng.choice(s) for _ in range(rng.randint(1, 4))) for _ in range(n)) + "."


def rows(n=240, seed=3):
    rng, out = random.Random(seed), []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        text = "\n".join(sentence(rng, lang, rng.randint(3, 30)) for _ in range(rng.randint(1, 4)))
        if i % 7 == 0:
            text = " ".join(f"{w.upper()}!!" for w in text.split())      # the bad ones
        out.append([i * 3, text, lang, f"src{0 if i % 3 else i % 5}", len(text)])
    copy = out[5][1]
    for i in range(n, n + 40):                                           # a large group of copies, some nearly
        words = copy.split(" ")
        if i % 4 == 0:
            words[rng.randrange(len(words))] = "changed"
        out.append([i * 3, " ".join(words), out[5][2], "src0", len(copy)])
    out += [[9001, None, None, None, None], [9002, "", "en", "", 0], [9003, " \t\n ", "en", "src1", 4],
            [9004, "word", "en", "src1", 4], [9005, "12 34 !?", "de", None, 8], [9006, "日本語のテキスト", None, "src1", 8],
            [9007, "a b \x0b c <|endoftext|> it's İ Σ ﬁ \x00 x", None, "src1", 9],
            [9008, " ".join(sentence(rng, "en", 30) for _ in range(400)), "en", "src2", 0],   # very long
            [None, "a row without an id", "en", "src1", 3], [None, None, None, None, None],
            [9009, out[7][1], "en", "src1", 2], [9009, out[7][1], "en", "src1", 2], [9010, "a b", "en", "src1", 3]]
    return [(*r, "x", "y", "z", "w") for r in out]


@pytest.fixture(scope="session")
def doc_rows():
    return rows()


@pytest.fixture(scope="session")
def docs(spark, doc_rows):
    return spark.createDataFrame(doc_rows, DOCS).repartition(4)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark, doc_rows):
    made = [(r[0], 0 if "!!" in (r[1] or "") else 1, 0) for r in doc_rows if r[0] is not None and r[0] % 2 == 0]
    return spark.createDataFrame(made + [(None, 1, 0), (12, None, 0)], "doc_id long, quality int, toxic int")
