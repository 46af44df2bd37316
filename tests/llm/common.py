"""Small tables with every awkward row, shared by the operator tests."""

LONG = "grand round trip " * 20_000
CLASHING = ("row", "first", "whole", "score", "node", "label", "kept", "bands", "hits", "items", "block", "bucket", "has_letter", "digest", "upper", "vector")


def documents(spark, rows, clashing=False):
    """(doc_id, text, lang) rows; with ``clashing``, also columns that operators use inside."""
    df = spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None) for r in rows], "doc_id bigint, text string, lang string")
    if clashing:
        from pyspark.sql import functions as F

        df = df.select("*", *(F.lit(7).alias(c) for c in CLASHING))
    return df


MESSY = [
    (1, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen."),
    (2, "one TWO three four five six seven eight nine ten eleven twelve thirteen fourteen."),
    (3, ""),
    (4, None),
    (5, "   \t\n "),
    (6, "word"),
    (7, "two words"),
    (8, LONG),
    (9, "été naïve  ça\u00a0va — 東京 \U0001f600 <|endoftext|> it's 12,5% a\r\nb "),
    (9, "été naïve  ça\u00a0va — 東京 \U0001f600 <|endoftext|> it's 12,5% a\r\nb "),
    (None, "no id at all"),
    (None, None),
    (10, "0123 4567 !!! ???"),
]


def plain(df):
    columns = sorted(df.columns)
    return sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)
