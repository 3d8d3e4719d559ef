import random

import pytest

SF = "/root/testdata/sf0.001"
# names that the operators use inside or return
CLASHES = "row string, fp string, score string, shard string, slot string, copy string, key string, bucket string, spans string, n_words string, sigs string, chunk string"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, lang, source): nulls, empty and long texts, repeated rows, copies, near copies, shared ids."""
    rng = random.Random(4)
    base = [words(rng, rng.randint(1, 120)) for _ in range(30)]
    rows = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(base)]
    rows += [(100 + i, base[i], "de", "s0") for i in range(5)]
    rows += [(200, base[7] + " x", None, None), (0, base[0], "en", "s0"), (3, "another text of the id three", "en", "s1")]
    rows += [(300, None, "en", "s0"), (301, "", "fr", "s1"), (302, " \n\t ", "fr", "s2"), (303, "a", "en", "s2"), (304, "Ünï çödé 漢字 🙂 é", "es", "s0")]
    rows += [(None, "no id here", "en", "s1"), (None, None, None, None), (None, "no id here", "en", "s1")]
    rows += [(400, words(rng, 60_000), "en", "s0"), (401, "x" * 300_000, "en", "s1"), (402, " ".join(["same"] * 5000), "en", "s2")]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    names = [x.split()[0] for x in CLASHES.split(", ")]
    return spark.createDataFrame([(*r, *names) for r in odd_rows], f"doc_id bigint, text string, lang string, source string, {CLASHES}").repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], f"doc_id bigint, text string, lang string, source string, {CLASHES}")


@pytest.fixture(scope="session")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
