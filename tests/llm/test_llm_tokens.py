"""The chunk-wise encoder against the tokenizer library, over all scripts."""

import random
import sys
import unicodedata

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tonegauge.llm.common import batches_by_bytes
from tonegauge.llm.tokens import Encoder


def strings(n, seed):
    """Letters, marks, digits and signs of all scripts, with punctuation and white space between."""
    rng = random.Random(seed)
    points = [chr(c) for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] in "LMNPSZ"]
    apart = [c for c in points if len(unicodedata.normalize("NFC", c)) > 1]
    letters = [c for c in points if c.isalpha()]
    plain = [chr(c) for c in range(0x20, 0x250)] + list("\n\t.,;:!?'")

    def word():
        pool = rng.choice([points, apart, letters, plain, plain])
        return "".join(rng.choice(pool) for _ in range(rng.randint(1, 6)))

    return [rng.choice([" ", "", "\n"]).join(word() + rng.choice(["", ".", ",", "!?", "'s", "."]) for _ in range(rng.randint(1, 8)))
            for _ in range(n)]


MEASURED = ["বড়.", "হয়,", "ज़.", "aक़!", "אשׁ.", "ẛ̣.", "É. é, İ!", "ﬁsh.  x"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_equal_those_of_the_library(name):
    path = public_tokenizers.path(name)
    whole, mine = Tokenizer.from_file(path), Encoder(path)
    assert mine.parted == (name == "word_bpe_49k.json")
    texts = MEASURED + strings(100_000 if mine.parted else 2_000, 1)
    for at in range(0, len(texts), 5000):
        some = texts[at:at + 5000]
        want = whole.encode_batch_fast(some, add_special_tokens=False)
        got = mine.ids([t.encode() for t in some], end=None)
        bad = [t for t, w, g in zip(some, want, got) if w.ids != g.tolist()]
        assert not bad, [ascii(t) for t in bad[:5]]


def test_long_rows_reach_workers_in_small_batches(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)

    def sizes(batches):
        yield from (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in batches)

    rows = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("text"))
    with pytest.raises(ZeroDivisionError), batches_by_bytes(spark, 1 << 20):
        assert max(r["n"] for r in rows.mapInArrow(sizes, "n long").collect()) < 1_100_000
        raise ZeroDivisionError
    assert spark.conf.get(name) == before
