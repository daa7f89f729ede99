"""Rows that every operator must take: nulls, empty and long texts, repeats, clashing columns."""

LONG = "word other third fourth. " * 6_000

ODD_DOCS = [
    # doc_id, text, source, and columns with names that operators use themselves
    (1, "one two three four five six seven", "a"), (2, "one two three four five six seven", "b"),
    (2, "one two three four five six seven", "b"), (3, None, "a"), (4, "", None), (5, " \t\n ", "a"),
    (6, "short", "a"), (7, "Short", None), (8, LONG, "a"), (9, LONG + "end", "c"), (None, "one two three four five six seven", "a"),
    (None, None, None), (10, "été naïve 日本語 \u00a0 <|endoftext|> it's", "é"), (11, "x" * 3_000, "c"),
]


def odd_docs(spark):
    rows = [(i, t, s, "clash", 7, 7, "x", [1]) for i, t, s in ODD_DOCS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, source string, id string, size int, bucket int, _source string, checks array<int>"
    )


def no_docs(spark):
    return odd_docs(spark).where("false")


class Groups:
    """Union-find for the brute-force twins."""

    def __init__(self):
        self.above = {}

    def find(self, x):
        self.above.setdefault(x, x)
        while self.above[x] != x:
            x = self.above[x]
        return x

    def join(self, x, y):
        a, b = sorted((self.find(x), self.find(y)))
        self.above[b] = a
