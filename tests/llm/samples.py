"""Small inputs and brute-force versions for the operator tests."""

from __future__ import annotations

import random
import re
from collections import defaultdict

DOC_DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n))


def documents(spark):
    """Null and empty texts, ties, repeated rows, copies, near copies, a shared passage, one very long text."""
    base, passage = prose(1, 120).split(), prose(2, 60)
    near = base[:60] + ["changed"] + base[61:]
    rows = [(1, " ".join(base)), (2, " ".join(base)), (3, " ".join(near)), (4, " ".join(base).upper()),
            (5, None), (6, ""), (7, " \t\n"), (8, "one two"), (9, "one two"), (10, "a b c d"),
            (11, prose(3, 50) + "\n" + passage), (12, passage + " " + prose(4, 80)), (13, "x " * 400),
            (14, prose(5, 30000)), (15, prose(6, 40)), (15, prose(6, 40)), (15, prose(7, 45)), (None, prose(8, 50)),
            (None, None), (16, "Réeux é Ünï naïve \u2028 \u00a0 x " * 20)]
    sources = ["s1", "s1", "s1", "s2", None, "s2", "", "s3"]
    return spark.createDataFrame([(i, t, "en", sources[k % len(sources)], len(t or "")) for k, (i, t) in enumerate(rows)], DOC_DDL)


def empty(spark):
    return spark.createDataFrame([], DOC_DDL)


def clashing(df):
    """The table with further columns named like results and internals."""
    from pyspark.sql import functions as F

    out = df
    for name in ("spans", "size", "taken", "target", "key1", "key2", "class", "root", "token", "hash", "blob", "rule",
                 "verdict", "host", "path", "_key1", "_key2", "_blob", "personal", "secrets", "toxicity", "contamination",
                 "dedup", "mix", "main_text", "quality_rules", "url_judgement", "_mix_size", "shard", "label", "id"):
        out = out.withColumn(name, F.lit(name))
    return out


def rows_of(df):
    """Rows as sorted tuples by column name."""
    names = sorted(df.columns)
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def components(texts: list, k: int, percent: int) -> tuple[list[int], list[int]]:
    """(set sizes, root index) of each text by comparing all pairs."""
    sets = []
    for t in texts:
        w = words("" if t is None else t.translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [len(s) for s in sets], [find(i) for i in range(len(texts))]


def repeated_words(texts: list, window: int) -> list[set[int]]:
    """For each text the word positions covered by windows that start anywhere else too."""
    at = defaultdict(list)
    for d, t in enumerate(texts):
        w = words(t)
        for i in range(len(w) - window + 1):
            at[tuple(w[i:i + window])].append((d, i))
    gone = [set() for _ in texts]
    for places in at.values():
        if len(places) > 1:
            for d, i in places:
                gone[d].update(range(i, i + window))
    return gone
