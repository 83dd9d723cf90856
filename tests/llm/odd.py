"""Rows that operators must bear, and helpers of the tests here."""

LONG = "ab cd ef gh ij " * 20_000
TEXTS = [None, "", " \t\n", "one", "two words", LONG, "same text here", "same text here", "Ünïcödé 日本語 🎉 text"]
# Names that operators use inside; here they are other people's columns.
CLASHING = ["row_id", "row_key", "body", "digest", "node", "key", "n", "h1", "slot", "best", "~id", "~text", "candidates", "text digest", "trust", "host", "y"]


def odd_documents(spark):
    rows = [(i, t, "en", *["x"] * len(CLASHING)) for i, t in enumerate(TEXTS)]
    rows += [rows[3], (None, "no id", None, *["x"] * len(CLASHING)), (None, None, None, *[None] * len(CLASHING))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"`{c}` string" for c in CLASHING))


def ids(df, column="doc_id"):
    return sorted((r[column] for r in df.select(column).collect()), key=lambda x: (x is None, x))


ODD_IDS = [0, 1, 2, 3, 3, 4, 5, 6, 7, 8, None, None]
