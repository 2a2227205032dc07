"""Shared by the tests of the training-data operators."""

# a text of 12,000 words
LONG = " ".join(f"wort{i % 700} der" for i in range(6000))


def clashing(df, names):
    """The same rows with further columns named like an operator's own."""
    from pyspark.sql import functions as F
    for n in names:
        df = df.withColumn(n, F.lit("x"))
    return df


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
