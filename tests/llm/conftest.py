import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    import random
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(500)) for _ in range(n))


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and long texts, copies, near copies, shared passages, repeated rows, an extra column."""
    shared, base = prose(1, 70), prose(2, 300)
    rows = [(i, prose(100 + i, 40 + 7 * i), "s%d" % (i % 3)) for i in range(12)]
    rows += [(20, base, "s0"), (21, base, None), (22, base, "s1"), (23, base + " tail", "s1")]
    rows += [(30, prose(31, 30) + "\n" + shared + " " + prose(32, 20), "s2"), (31, shared, "s2"), (32, prose(33, 5) + " " + shared, None)]
    rows += [(40, None, "s0"), (41, "", "s0"), (42, "  \n\t ", "s1"), (43, "one two", None), (44, "One  two", "s0")]
    rows += [(45, "Released under the MIT License. " * 3, "s0"), (46, "x # $ " * 400, "s1"), (47, prose(50, 9000), "s2")]
    rows += [(5, prose(105, 75), "s2"), (None, prose(7, 60), "s0"), (None, None, None)]
    return spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, n_words int")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
