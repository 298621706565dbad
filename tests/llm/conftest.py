import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

#: Columns that the operators use inside, as extra columns of their inputs.
CLASHES = ("words, row, x, w, spans, items, n, key, class_id, label, fold, block, part, ids, found, step, "
           "start, gram, kept, quality, size, seed, pos, _id, _text, pieces, refers_to, component").split(", ")


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "sea", "tide", "grain", "willow", "Lamp", "copper,", "été", "über",
                                "stone.", "rain", "orchard", "quiet", "north", "wagon"]) + rng.choice("aeiou ") * rng.randint(0, 2)
                    for _ in range(n))


def edge_rows():
    """Ids and texts: ties, near copies, repeats, nulls, empty and very long texts."""
    rng = random.Random(5)
    first, second, long = prose(rng, 120), prose(rng, 90), prose(rng, 6000)
    near = first.split()
    near[40:43] = ["changed", "words", "here"]
    bits = ("Mail ann.b+c@site-1.example.com or x@y.z_d@e.f; ip 10.0.0.255 and 1.2.3.256 and 1.2.3.4.5.6.7.8; "
            "card 4539 1488 0343 6467 not 4539-1488-0343-6468; call +44 (20) 7946-0958 or +1 2; "
            "iban DE89 3704 0044 0532 0130 00 account; ssn 123-45-6789; 555-123-4567 phone \U0001F600 +49.30.1234567 ")
    rows = [(7, first), (3, first), (9, " ".join(near)), (4, second), (4, second), (12, None), (13, ""), (14, " \n\t"),
            (15, "one two"), (16, "One  TWO"), (17, bits), (18, long), (19, long + " and more"), (None, second + " x"),
            (None, None), (20, "A\nA\nB\n \nA #*$ | a b a b a b a b"), (21, first + "\n" + second), (2**60 + 1, prose(rng, 60)),
            (22, "9" * 5000 + "@" + "a" * 3000 + ".b " + "1." * 500), (23, "été " * 70), (24, "x\u0000y 　 z")]
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    """The rows as documents with clashing extra columns."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(edge_rows(), "doc_id long, text string").repartition(3)
    return docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)
