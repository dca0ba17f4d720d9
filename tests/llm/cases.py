"""Small hand-made tables shared by the tests of this folder."""

import random

from pyspark.sql import functions as F

LOREM = ("the quick brown fox jumps over a lazy dog while seven wizards mix odd potions near quiet "
         "harbours and grey ships drift past old stone towers under slow clouds").split()

# columns whose names the operators use inside
CLASHES = ("score", "key", "bucket", "chunk", "node", "shard", "blob", "terms", "n", "kind", "rank", "list")


def words(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 7))) for _ in range(n)]


def text(seed: int, n: int = 60) -> str:
    return " ".join(words(seed, n))


def docs(spark, rows):
    """(doc_id, text) rows with clashing extra columns."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in CLASHES:
        df = df.withColumn(c, F.lit(f"x-{c}"))
    return df


def edge_rows(extra=()):
    """Nulls, empty and blank texts, repeated rows, an odd id, one long text."""
    return [(1, text(1)), (2, None), (3, ""), (4, " \n\t "), (None, text(5)), (6, text(6)), (6, text(6)),
            (7, text(1)), (-8, "é ñ 漢字 🤦🏼‍♂️ ▁"), (9, "x" * 5000), (10, text(10, 6000)), *extra]


def collected(df):
    return sorted(map(tuple, df.collect()), key=repr)
