import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
#: Names that the operators use inside; a caller's table may have any of them.
CLASHING = (
    "words lines doc_words doc_lines hashes windows ranked places shard slot size key shard_key shard_place "
    "doc_key gone_key hit_id line_key cut_key cuts all_lines left_lines lookup_salt n_words kept n_removed_lines "
    "token_ids decoded row salt piece hash bucket matched_rule outcome lower_bound"
).split()


def sentence(start: int, n: int = 30) -> str:
    return " ".join(f"word{(start * 37 + k * k) % 997}" for k in range(n))


ODD_ROWS = [
    (1, sentence(1, 60) + "\n" + sentence(2, 40), "en", "a", 1),
    (2, sentence(1, 60) + "\n" + sentence(2, 40), "en", "a", 1),
    (2, sentence(1, 60) + "\n" + sentence(2, 40), "en", "a", 1),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, " \n\t \n", "de", "b", 5),
    (6, "x", None, "b", 1),
    (7, "12 34 !! ##", "de", None, None),
    (8, "\n".join(sentence(k, 25) for k in range(3000)), "en", "a", None),
    (9, "a" * 70_000, "en", "a", None),
    (None, sentence(5, 40), "en", "a", 1),
    (None, None, None, None, None),
    (10, "Üñï " * 50 + "\U0001f600 z", "de", "c", 3),
    (11, sentence(1, 60).upper() + "\n" + sentence(2, 40), "en", "a", 1),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(ODD_ROWS, DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def clashing_docs(odd_docs):
    from pyspark.sql import functions as F

    return odd_docs.select("*", *[F.lit(n).alias(n) for n in CLASHING])


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
