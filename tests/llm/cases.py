import random

# Columns that the operators use themselves, under other types.
CLASHING = ["_th", "_h", "cls", "rank", "shard", "slot", "size", "score", "host", "kept", "start", "n_removed", "iw", "W"]


def made(spark, rows):
    """Documents of (doc_id, text), with every column of the table and many of clashing names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"`{c}` string" for c in CLASHING
    )
    return spark.createDataFrame(
        [(i, t, "en", "src0", None if t is None else len(t), *["x"] * len(CLASHING)) for i, t in rows], schema
    )


def prose(seed, words=200, vocabulary=400, line=12):
    r = random.Random(seed)
    found = [f"w{r.randrange(vocabulary)}" for _ in range(words)]
    return "\n".join(" ".join(found[k : k + line]) for k in range(0, words, line))
