"""Small tables with every awkward row the operators must define."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("n_words kept copy n_copies shard slot row bucket idx key h1 h2 pos line cdf size share n_lines "
            "n_dropped n_chunks removed starts doc rep id component a b ok left shuffle_key").split()

WORDS = ("the of and to in is it that for was on are as with by at from this be or "
         "river stone window garden letter morning paper silver engine market").split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(400)) * (rng.random() < 0.5) for _ in range(n))


def awkward_rows() -> list[tuple]:
    long_text = prose(7, 30_000)
    passage = prose(99, 70)
    rows = [
        (None, prose(1, 60), "en", "s1"), (None, None, None, None), (1, None, "en", "s0"), (2, "", "en", None),
        (3, " \t\n \x0b\x0c\r ", "en", "s0"), (4, long_text, "en", "s0"), (5, "one two", None, "s1"),
        (6, "ONE two", "de", "s1"), (7, "\n\n\n", "en", "s0"), (8, "x" * 5_000, "en", "s2"),
        (9, "é日本😀   　 ▁▁ <s> </s> \x00", "fr", "s2"), (10, prose(2, 40) + "\n" + passage, "en", "s0"),
        (11, passage + "\n" + prose(3, 40), "en", "s0"), (11, passage + "\n" + prose(3, 40), "en", "s0"),
        (12, prose(4, 50) + "\n" + passage + "\n" + prose(5, 50), "en", "s3"), (12, "other text of the same id", "en", "s3"),
    ]
    line = "A line that is shared by many of the documents, " + "long enough to count."
    rows += [(20 + k, f"{prose(20 + k, 30)}\n  {line.upper() if k % 2 else line} \n{prose(50 + k, 30)}", "en", "s0") for k in range(7)]
    base = prose(200, 120).split()
    for k in range(8):  # near copies: one word in a block is changed
        edited = list(base)
        edited[3 * k] = f"edit{k}"
        rows.append((40 + k, " ".join(edited), "en", "s1"))
    rows += [(60 + k, prose(300, 80), "en", "s0") for k in range(6)]  # exact copies
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(spark):
    from pyspark.sql import functions as F

    return awkward(spark).withColumns({c: F.lit(f"own {c}") for c in CLASHING})
