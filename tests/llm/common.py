"""Small fixtures shared by the tests of the training-data operators."""

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, blob string, pos long, size long, words string"


def docs(spark, rows):
    """rows: (doc_id, text, source); the extra columns clash with names used inside the operators."""
    return spark.createDataFrame(
        [(i, t, "en", s, None if t is None else len(t), "b", 7, None, "w") for i, t, s in rows], SCHEMA)


def lower(text):
    """A-Z only."""
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def ws_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def write_tables(path, spark, **tables):
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}.parquet")
    return str(path)
