"""Small tables with everything that the operators must bear."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside, and one that must be quoted.
CLASHING = "words key doc runs n mix tokens quality id node digest a.b text_ lang_pred".split()


def prose(rng, n, words=400):
    """Sentences of invented words, a line for each few."""
    vocabulary = [f"w{k}" for k in range(words)]
    out = []
    for k in range(n):
        word = rng.choice(vocabulary)
        out.append(word + (".\n" if k % 23 == 22 else "." if k % 9 == 8 else ""))
    return " ".join(out).replace("\n ", "\n")


def rows(seed=3, n=60):
    """(doc_id, text, lang, source): copies, near copies, shared passages, odd texts."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.choice([3, 30, 80, 200])) for _ in range(n // 2)]
    passage = prose(rng, 60, 5000)
    while len(texts) < n - 12:
        kind, old = rng.randrange(4), rng.choice(texts[: n // 2])
        words = old.split(" ")
        if kind == 0:
            texts.append(old)
        elif kind == 1:
            words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
        elif kind == 2:
            texts.append(prose(rng, 20) + "\n" + passage + "\n" + prose(rng, 10))
        else:
            texts.append(" ".join(words[len(words) // 2 :]) + " " + prose(rng, 25))
    texts += [None, "", " \n\t ", "one", "one", "two words", "ä" * 70, "ä" * 70, "aaaa " * 300]
    texts += [prose(rng, 30_000, 30), "x" * 20_000, "日本語 " * 40]
    found = [(k, t, "en" if k % 3 else None, f"src{k % 4}" if k % 7 else None) for k, t in enumerate(texts)]
    return found + [found[2], found[5], found[-1]]


def documents(spark, given=None, extra=True):
    given = rows() if given is None else given
    data = [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in given]
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    if extra:
        for k, name in enumerate(CLASHING):
            df = df.withColumn(name, F.lit(k) if k % 2 else F.lit(None).cast("string"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
