"""Small tables with every awkward row: nulls in any column, empty and very long texts, ties, repeated rows, and
extra columns whose names clash with those that the operators add."""

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, "
          "h1 long, key string, size long, target double, level int, copy_no int")

LONG_LINE = "this very line stands in many of the documents of this table"
PASSAGE = "one two three four five six seven eight nine ten eleven twelve"


def texts():
    return [
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
        (2, "Alpha  beta gamma\ndelta epsilon zeta eta theta iota kappa lambda mu"),
        (3, None), (4, ""), (5, " \t\n\x0b\x0c\r "), (6, "word"), (7, "WORD"), (8, "two words"),
        (9, f"{LONG_LINE}\nnine own"), (10, f"{LONG_LINE}\nten own"), (11, f"  {LONG_LINE.upper()}\t\neleven own"),
        (12, f"{LONG_LINE}\n{LONG_LINE}"), (13, f"x\n{LONG_LINE}\n"), (13, f"x\n{LONG_LINE}\n"),
        (14, f"lead {PASSAGE} tail"), (15, PASSAGE.replace(" ", "-").upper()), (15, "another text of fifteen"),
        (None, "no id one"), (None, f"no id two {PASSAGE}"), (None, None),
        (16, " ".join(f"w{i % 997}" for i in range(30000))), (17, "é È ñ ß 中文 \U0001f600 \x00 nul"),
        (18, "a" * 200_000), (19, "\n" * 50), (20, ". , ; !"),
    ]


def documents(spark):
    sources = ["s1", "s2", None, "S3", "é"]
    langs = ["en", "de", None]
    rows = [(d, t, langs[i % 3], sources[i % 5], None if t is None else len(t), 0.5, True, 1, "k", 7, 0.1, 3, 9)
            for i, (d, t) in enumerate(texts())]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def items(spark):
    rows = [(7, PASSAGE, 1), (70, PASSAGE, 1), (8, "another text", 1), (9, None, 1), (None, "word", 1), (10, "", 1)]
    return spark.createDataFrame(rows, "item_id long, text string, spans int")
