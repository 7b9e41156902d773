"""Small fixtures for the operator tests."""

import random
import tempfile

# Texts that every text operator must take: null, empty, blank, short,
# control strings, other scripts, repeated rows, a long text.
ODD = [None, "", "   ", "a", "one two three", "ÀÉ é́ naïve İstanbul ΣΑΣ 你好，世界", "x\x1cy\tz\n", "<|endoftext|> <|im_end|>",
       "same row", "same row", "be " * 500, "word " * 20_000]


def stored(spark, rows, schema):
    """Rows as a Parquet table: operators that tell rows apart by their
    place want files."""
    path = tempfile.mkdtemp(prefix="tagloom-test-") + "/t"
    spark.createDataFrame(rows, schema).write.parquet(path)
    return spark.read.parquet(path)


def odd_documents(spark):
    """Odd texts under null, equal and negative ids, with columns named
    like operators' own."""
    ids = [None, None, 5, 5, -3, 7, 8, 9, 10, 11, 12, 13]
    rows = [(i, t, "en", None if k % 3 == 0 else f"s{k % 2}", len(t or ""), k, "x", "y")
            for k, (i, t) in enumerate(zip(ids, ODD, strict=True))]
    return stored(spark, rows, "doc_id long, text string, lang string, source string, n_chars long, "
                               "row long, found string, target string")


def prose(seed, words):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6))) for _ in range(words))
