import random

from tillstar.llm.near_dedup import near_duplicates


def brute(rows, size, num, den):
    """Smallest id reachable over all pairs, by full sets."""
    sets = {}
    for doc, text in rows:
        words = text.encode().lower().split() if text else []
        sets[doc] = {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
    label = {d: d for d in sets}
    ids = sorted(sets)
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(ids):
            for b in ids[i + 1:]:
                both = len(sets[a] & sets[b])
                if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both) and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return {d: (len(s), label[d]) for d, s in sets.items()}


def family(seed, n, words, edits, first_id):
    """Copies of one text with random edits: many similarities around the threshold."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(4000)}" for _ in range(words)]
    out = []
    for k in range(n):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append((first_id + k, " ".join(text)))
    return out


def test_groups_equal_brute_force(spark):
    rows = family(1, 40, 60, 9, 0) + family(2, 30, 100, 14, 100) + family(3, 25, 30, 5, 200) + family(4, 20, 12, 2, 300)
    rows += [(400 + i, t) for i, t in enumerate(["one", "ONE", "one two", "One  two\n", "", None, "a b c", "a b c", " ", "a b c d e f", "a b c d e f g"])]
    rows += [(500 + i, rows[3][1].upper()) for i in range(50)]
    docs = spark.createDataFrame([(t, d, "x", 0) for d, t in rows], "text string, doc_id long, rep string, n int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == brute(rows, 2, 80, 100)


def test_five_word_shingles(spark):
    rows = family(5, 40, 120, 4, 0) + family(6, 20, 40, 2, 100)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, shingle=5).collect()}
    assert got == brute(rows, 5, 80, 100)


def test_rows_without_id_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (7, "a b c d e"), (None, None)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.component_id, r.kept) for r in near_duplicates(docs).collect())
    assert got == [(-1, None, True), (-1, None, True), (2, 2, True), (2, 2, True), (7, 2, False)]
    assert near_duplicates(docs.limit(0)).count() == 0
