"""Small documents with every odd case, and plain versions of the word rules."""

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def letters_digits(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def documents(spark, texts, **extra):
    """A documents table of (doc_id, text) pairs."""
    rows = [(i, t, "en", "src", len(t) if t is not None else None) for i, t in texts]
    df = spark.createDataFrame(rows, DOCS)
    for name, value in extra.items():
        df = df.withColumn(name, value)
    return df
