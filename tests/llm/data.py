"""Small frames with every edge case, and the driver's small tables."""

import os
import random

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "embeddings", "benchmark")


def edge_docs(spark):
    """Null and empty texts, null ids and sources, ties, repeated rows, a very
    long text, and extra columns whose names clash with helpers'."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = text(120)
    rows = [(1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, base + " tail", "xx", "b"), (4, None, "fr", "b"), (5, "", None, None), (6, " \n\t ", "de", "é"), (None, "lost one", "es", "Z"),
            (None, None, None, None), (7, text(60_000), "en", "a"), (8, "one", "en", "b"), (9, "ein\x0bzwei\x1cdrei vier\nfünf", "de", "a"), (10, text(80) + "\n" + base + "\n\n" + text(40), "es", "c")]
    rows += [(20 + i, text(rng.randint(1, 90)) + "\n" + text(30), rng.choice(["en", "fr", None]), rng.choice(["a", "a", "b", None])) for i in range(30)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, k1 string, _k1 string, size string, c string, uid string, target int, `odd name` int"
    return spark.createDataFrame([(*r, len(r[1] or ""), "x", "y", "z", "c", "u", 1, i) for i, r in enumerate(rows)], schema)


def connect(sf=SF):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con
