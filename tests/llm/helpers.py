"""Small tables for the operator tests."""

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, rows, schema=DOC, parts=3):
    """rows: (doc_id, text[, lang[, source]])"""
    full = [(*r, *[None] * (5 - len(r))) for r in rows]
    return spark.createDataFrame(full, schema).repartition(parts)


def prose(seed, n, words=("alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "lambda", "theta", "zeta", "iota", "rho")):
    import random
    r = random.Random(seed)
    return " ".join(r.choice(words) + (str(r.randrange(50)) if r.random() < 0.3 else "") for _ in range(n))
