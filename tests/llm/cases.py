"""Rows every operator has to survive: nulls, empty and very long texts, repeats, ties and clashing extra columns."""

LONG = "Sentence number one of many words. " * 20_000

ODD_DOCS = [
    (1, "A plain text of some words.\nIt has two lines."),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, LONG),
    (6, "A plain text of some words.\nIt has two lines."),
    (7, "A plain text of some words.\nIt has two lines."),
    (8, "\x00\x85  ☃ 😀 é"),
    (None, "A text without an id, but with 12345 and a name."),
    (9, "mail a.b@example.com, call +1 (555) 010-2030, token = \"abcdef0123456789abcdef01\""),
    (9, "mail a.b@example.com, call +1 (555) 010-2030, token = \"abcdef0123456789abcdef01\""),
]


def docs_frame(spark):
    """The rows with the other columns of documents and some whose names operators use themselves."""
    rows = [(i, t, None, "s", None if t is None else len(t), 1.0, "x", 2, "y") for i, t in ODD_DOCS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, fp string, shard int, label string").repartition(3)


def labels_frame(spark):
    return spark.createDataFrame([(1, 1, 0, "x"), (9, 0, 1, "x"), (None, 1, 1, "x"), (5, None, None, "x")], "doc_id long, quality int, toxic int, text string")
