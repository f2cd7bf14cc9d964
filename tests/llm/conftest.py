import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    parts = ["th", "er", "in", "ou", "an", "re", "ti", "st", "é", "ö"]
    out = []
    for k in range(words):
        out.append("".join(r.choice(parts) for _ in range(r.randint(1, 4))))
        if k % 23 == 22:
            out[-1] += ".\n"
    return " ".join(out).replace("\n ", "\n")


@pytest.fixture(scope="session")
def texts():
    """Plain, equal, nearly equal, repetitive, empty, null and long texts."""
    base = [prose(k, 60 + 7 * k) for k in range(12)]
    base[5] = base[2]
    base[6] = base[3][:200] + "x" + base[3][201:]
    base[7] = base[4][50:300] + base[7]
    base += ["", None, "a" * 700, "ab " * 300, prose(50, 4000), " \t\n\n ", "Kurz."]
    return base


@pytest.fixture(scope="session")
def docs(spark, texts):
    """With extra columns under names that operators use themselves, repeated rows and null ids."""
    rows = [(k, t, "en", "src0" if k % 3 else None, len(t or "")) for k, t in enumerate(texts)]
    rows += [rows[1], (None, texts[0], None, None, 1), (None, None, None, None, None)]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({"row": F.lit(1), "id": F.lit("x"), "raw": F.lit(2.0), "size": F.lit(None).cast("int")}).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
