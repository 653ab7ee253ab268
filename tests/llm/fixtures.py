"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, matches string, n int, key long, bucket int"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def sentence(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


def awkward_rows() -> list[tuple]:
    base = sentence(1, 120)
    near = base.replace(" ", "  ", 3).rsplit(" ", 1)[0] + " other"
    shared = sentence(2, 30)
    texts = [
        (1, base, "a"), (2, base, "b"), (3, near, "a"), (4, None, None), (5, "", "a"), (6, " \t\n\r ", None), (7, "one", "ü"), (8, "one", "z"),
        (9, "One two Three", "z"), (9, "One two Three", "z"), (9, "an other text of document nine", "z"), (None, "text without an id " + shared, "a"),
        (None, "text without an id " + shared, "a"), (10, sentence(3, 40) + " " + shared + "\n" + sentence(4, 40), "a"),
        (11, sentence(5, 20000), "b"), (12, shared + " " + sentence(6, 12), None), (13, "x" * 50000, "b"), (14, "\n".join([sentence(7, 12)] * 5), "a"),
        (15, "é" * 30 + " ñandú word end " + "日本語テキスト " * 8, "ü"), (16, sentence(3, 40).upper(), "b"), (-5, sentence(7, 12) + "\nlast", "a"),
        (17, sentence(8, 60), "a"), (18, sentence(8, 59) + " changed", "b"), (19, sentence(8, 58) + " changed twice", "b"), (20, "a b c d", "a"), (21, "A B C D", "a"),
    ]
    return [(i, t, "en", s, len(t or ""), 0.7, "x", 1, 2, 3) for i, t, s in texts]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
