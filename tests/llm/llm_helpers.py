"""Small tables and plain helpers for the operators' tests."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """Documents of (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def find_root(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x
