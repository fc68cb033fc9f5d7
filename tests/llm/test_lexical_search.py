import math
import re
from collections import Counter

import pytest

from tillstar.llm.lexical_search import _Best, ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k):
    """The formula over every document and item, without automaton."""
    docs = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, n_terms = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        scores = []
        for d, c in docs:
            m = 25 + 75 * c.total() * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                        for t in terms(text) if t in c)
            scores.append((-score, d is None, d or 0, d))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(x for x in scores if x[0] < 0)[:k], 1)]
    return sorted(out, key=str)


DOCS = [(1, "the cat sat on the mat"), (2, "The CAT!cat, cat"), (3, "naïve Ünder cat-dog 42"), (4, None), (5, "  \n., "), (None, "lost cat"),
        (7, "the cat sat on the mat"), (7, "the cat sat on the mat"), (8, "x y 中文 cat\x00dog"), (9, "scatter cats " * 3000), (10, "catalog \U0001F600 dog")]
ITEMS = [(1, "cat"), (2, "the cat the dog"), (3, None), (4, ""), (5, "naïve ünder 中文 x y"), (None, "lost mat"), (2, "sat"), (1, "cat"),
         (6, "unknown words"), (7, "cat" * 50), (8, "Scatter \U0001F600 42")]


@pytest.mark.parametrize("k, block_bytes", [(2, 1), (3, 20), (50, 1 << 20)])
def test_equals_brute_force(spark, k, block_bytes):
    docs = spark.createDataFrame([(d, t, 5, 6) for d, t in DOCS], "doc_id long, text string, score int, item int").repartition(3)
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, rank int")
    got = ranked_search(docs, items, k=k, block_bytes=block_bytes).collect()
    assert sorted(map(tuple, got), key=str) == brute(DOCS, ITEMS, k)


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked_search(docs.limit(0), items).count() == 0
    assert ranked_search(docs, items.limit(0)).count() == 0
    assert ranked_search(docs, items.filter("item_id = 3")).count() == 0


def test_best_keeps_ties_by_id_over_many_turns():
    import numpy as np
    rng = np.random.default_rng(3)
    best, rows = _Best(4, 3), []
    for _ in range(30):
        ids, scores = rng.integers(0, 50, 20), rng.integers(0, 4, (20, 4))
        null = rng.random(20) < 0.1
        best.add(ids, null, scores)
        rows += [(i, -s, bool(z), int(d)) for d, z, line in zip(ids, null, scores) for i, s in enumerate(line.tolist()) if s > 0]
    want = [r for i in range(4) for r in sorted(x for x in rows if x[0] == i)[:3]]
    assert [(i, -s, z, d) for i, d, z, s in zip(*(c.tolist() for c in best.rows))] == want
