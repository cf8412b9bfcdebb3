"""Small hostile documents for the operators: nulls, empty and long texts, ties, clashes."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    # columns whose names the operators add themselves
    T.StructField("kept", T.StringType()), T.StructField("size", T.StringType()),
    T.StructField("score", T.StringType()), T.StructField("id", T.StringType())])


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    parts = ["ba", "ko", "ri", "tu", "ne", "sol", "mi", "da", "é", "ß"]
    out = []
    for i in range(n):
        out.append("".join(r.choice(parts) for _ in range(r.randint(1, 4))))
        if r.random() < 0.08:
            out.append(".\n")
    return " ".join(out)


def hostile_rows() -> list[tuple]:
    base, other = prose(1, 120), prose(2, 400)
    edited = base.replace(base.split()[60], "changedword", 1)
    texts = [
        (10, base), (11, base), (12, edited), (13, base + " tail"),
        (14, other), (3, other), (15, None), (16, ""), (17, "  \n\t "), (18, "1234 !!! 5678"),
        (19, "one two"), (20, "one two"), (21, "x " * 300), (22, prose(3, 30000)),
        (23, prose(4, 90) + "\n" + base[:400] + "\n" + prose(5, 90)), (None, base), (None, "no id here"),
        (24, "naïve café " * 60 + "\r\nline\nline\nline\n"), (25, base), (25, base), (26, "a b c d"),
        (27, prose(6, 60) + " #*$%&|<> <|endoftext|> <|IM_END|> it's we'LL ét́"),
        (28, "y" * 5000), (29, prose(1, 120).replace(" ", "\t"))]
    langs, sources = ["aa", "bb", None], ["s1", "s2", None, "hot", "hot", "hot"]
    return [(i, t, langs[k % 3], sources[k % 6], "mine", "mine", "mine", "mine") for k, (i, t) in enumerate(texts)]


