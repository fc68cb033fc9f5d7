"""Quality rules, licence scan, decontamination, passages, quality scores, URL filter on small and odd inputs."""

import random
import re
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillstar.llm import passage_dedup
from tillstar.llm.decontaminate import contaminated, tile, tile_shared
from tillstar.llm.license_scan import BASE_PHRASES, MORE_PHRASES, evaluate, known_identifiers, label_of, license_scan, scan, to_postfix
from tillstar.llm.passage_dedup import remove_passages, repeated_passages
from tillstar.llm.quality_model import PreferenceModel, features, fit_preferences, quality_scores
from tillstar.llm.queries import URL_RULES, op2_license_scan, op3_benchmark_decontamination, op4_quality_classifier
from tillstar.llm.quality_rules import beta_prior, measure, quality_rules
from tillstar.llm.shingles import mix, word_hashes
from tillstar.llm.url_filter import judge_urls, repeated_urls

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# ---- quality rules

@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab \n\t#|é\x1c")), max_size=60))
def test_measures_equal_brute_force(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = text.split("\n")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    assert measure(text) == (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        sum(bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in lines[:i] for i, line in enumerate(lines)), len(repeated))


def test_a_bad_host_is_rejected_and_a_small_one_is_shrunk(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, "short", "bad", 1) for i in range(40)] + [(100 + i, good, "bad", 1) for i in range(5)]
    rows += [(200 + 40 * h + i, good, f"host{h}", 1) for h in range(8) for i in range(40)]
    rows += [(900, "short", "tiny", 1), (901, good, "tiny", 1), (902, None, None, 1), (903, good, None, 1), (None, "", "host1", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, host int")
    out = {r.doc_id: r for r in quality_rules(docs, carry=docs.columns).collect()}
    assert len(out) == len(rows) and out[0].host == 1 and out[0].text == "short"
    assert not out[100].kept and out[100].host_rejected and not out[100].base_failed
    assert out[901].kept and out[903].kept and not out[902].kept and not out[900].kept and out[200].kept
    assert quality_rules(docs.limit(0)).count() == 0


def test_beta_prior():
    assert beta_prior(3, 30, 0, 0.0) == (0.0, 1.0) and beta_prior(0, None, None, None) == (0.0, 1.0)
    mean, strength = beta_prior(2, 200, 100, 100.0)  # one host fails always, one never
    assert mean == 0.5 and strength == 0.0


# ---- licence scan

@pytest.mark.parametrize("text,permitted,labels", [
    ("MIT OR GPL-3.0-only", True, {"mit", "gpl-3"}), ("MIT AND GPL-3.0-only", False, {"mit", "gpl-3"}),
    ("(MIT OR GPL-2.0) AND Apache-2.0", True, {"mit", "gpl-2", "apache-2"}),
    ("GPL-2.0-only WITH Classpath-exception-2.0 OR MIT", True, {"gpl-2", "classpath-exception-2.0", "mit"}),
    ("Apache-2.0 WITH LLVM-exception", True, {"apache-2", "llvm-exception"}), ("MIT, GPL-3.0+", False, {"mit", "gpl-3"}),
    ("MIT/GPL-3.0, BSD-3-Clause", True, {"mit", "gpl-3", "bsd-3"}), ("MIT/GPL-3.0 AND Zlib", True, {"mit", "gpl-3", "zlib"}),
    ("MIT, see LICENSE", True, {"mit"}), ("MIT */", True, {"mit"}), ("MIT // (see file)", True, {"mit"}), ("MIT, (see file)", True, {"mit"}),
    ("LicenseRef-Own.1 OR MIT", True, {"licenseref-own.1", "mit"}), ("DocumentRef-x:LicenseRef-y", False, {"documentref-x:licenseref-y"}),
    ("(MIT OR ISC) WITH Classpath-exception-2.0", True, {"mit", "isc"}), ("MPL-1.1 MIT", False, {"mpl"}), ("AGPL-3.0-or-later.", False, {"agpl"}),
    ("MIT or GPL-3.0 and Apache-2.0", True, {"mit", "gpl-3", "apache-2"}), ("GPL-3.0 trailing prose", False, {"gpl-3"})])
def test_expressions(text, permitted, labels):
    assert evaluate(to_postfix(text)) == (permitted, labels)


@pytest.mark.parametrize("text", ["", "AND MIT", "(MIT", "MIT AND", "()", "see LICENSE file", "the", "...", "MIT OR Foo-1.0", "MIT, ISC OR", "GPL-2.0 WITH thanks",
                                  "GPL-2.0 WITH MIT", "Classpath-exception-2.0", "MIT, (ISC", "Apache", "Apache-9.0", "+", "MIT-only", "GPL-2.0 WITH (MIT)"])
def test_malformed_expressions(text):
    assert to_postfix(text) is None


def random_expression(rng, depth):
    """(text, tightness of its loosest operator, permitted, labels): a tree written with the parentheses it needs and some more."""
    if depth == 0 or rng.random() < 0.2:
        name, label, may = rng.choice([("MIT", "mit", True), ("gpl-3.0-ONLY", "gpl-3", False), ("Apache-2.0+", "apache-2", True), ("BSD-3-Clause", "bsd-3", True),
                                       ("CC-BY-NC-4.0", "cc-by-nc", False), ("LicenseRef-a.B", "licenseref-a.b", False), ("own-1", "own-1", False)])
        if rng.random() < 0.2:
            return f"{name} {rng.choice(['with', 'WITH'])} GCC-exception-3.1", 9, may, {label, "gcc-exception-3.1"}
        return name, 9, may, {label}
    sign, tight, both = rng.choice([(",", 1, True), (" or ", 2, False), (" AND ", 3, True), ("/", 4, False), (" / ", 4, False), (", ", 1, True), (" OR ", 2, False)])
    left, right = random_expression(rng, depth - 1), random_expression(rng, depth - 1)
    texts = [f"({t})" if k < tight + after or rng.random() < 0.1 else t for after, (t, k, _, _) in enumerate((left, right))]
    return sign.join(texts), tight, left[2] and right[2] if both else left[2] or right[2], left[3] | right[3]


def test_random_expressions_equal_their_trees():
    rng, more = random.Random(2), frozenset(["own-1"])
    for _ in range(3000):
        text, _, may, labels = random_expression(rng, rng.randrange(6))
        assert evaluate(to_postfix(text, more), more) == (may, labels), text
        assert to_postfix(f"({text}", more) is None and to_postfix(f"{text}) the rest", more) == to_postfix(text, more)


def test_known_identifiers():
    known = known_identifiers()
    assert len(known) > 180 and all(k == k.lower() and " " not in k for k in known)
    assert {known[k] for k in ("apache-2.0", "gpl-2.0-or-later", "lgpl-2.1", "cc-by-sa-4.0", "mit")} == {"apache-2", "gpl-2", "lgpl", "cc-by-sa", "mit"}
    assert label_of("see") is None and label_of("Apache-2.0+") == "apache-2" and label_of("own") is None and label_of("own", frozenset(["own"])) == "own"


def brute_evidence(text, more=frozenset()):
    """Labels and score by searching every phrase in the folded words, and every tagged line's expression."""
    words = " " + " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))) + " "
    base = {b for p, b in BASE_PHRASES.items() if f" {p} " in words}
    labels, score = base | {b for p, b in MORE_PHRASES.items() if f" {p} " in words}, 0.0
    score = 0.9 if base else 0.6 if labels else 0.0
    for found in re.findall(r"(?i)spdx[- ]license[- ]identifier\s*:[ \t]*([^\r\n]*)", text or ""):
        postfix = to_postfix(found, more)
        score, labels = (max(score, 0.3), labels) if postfix is None else (1.0, labels | evaluate(postfix, more)[1])
    return ",".join(sorted(labels)), score


PIECES = ["Under the MIT license", "CC BY-NC 4.0", "CC BY 4.0", "artistic license", "SPDX-License-Identifier: MIT OR Zlib", "spdx-license-identifier : see LICENSE",
          "SPDX-License-Identifier: GPL-2.0 WITH", "mozilla public", "license", "word", "All rights reserved.", "redistribution and use in source and binary forms"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=8), st.sampled_from([" ", "\n", ", "]))
def test_labels_and_scores_equal_brute_force(pieces, glue):
    text = glue.join(pieces)
    assert scan(text.encode())[5:7] == brute_evidence(text)


def base_places(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places = [(i, label) for phrase, label in BASE_PHRASES.items() for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({b for _, b in places}))


WORDS = st.sampled_from("under the MIT License apache license, version 2 cc BY nc é ß 0 2.0 x".split())


@settings(max_examples=300, deadline=None)
@given(st.lists(WORDS, max_size=40))
def test_base_phrases_equal_brute_force(words):
    text = " ".join(words)
    assert scan(text.encode())[:5] == base_places(text)


def test_license_query_and_odd_rows(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    for r in op2_license_scan(spark, MEDIUM).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_places(texts[r.doc_id])
        assert (r.labels, r.score) == brute_evidence(texts[r.doc_id]) and set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
    docs = spark.createDataFrame([(1, None, 5), (None, "", 5), (1, "// SPDX-License-Identifier: MIT OR GPL-3.0-only", 5),
                                  (3, "SPDX-License-Identifier: (", 5), (4, "Under the MIT license " * 20000, 5)], "doc_id long, text string, labels int")
    got = sorted((r.n_words, r.n_base, r.labels, r.score, r.permitted) for r in license_scan(docs).collect())
    assert got == [(0, 0, "", 0.0, None)] * 2 + [(3, 0, "", 0.3, None), (9, 0, "gpl-3,mit", 1.0, True), (80000, 20000, "mit", 0.9, True)]
    assert license_scan(docs.limit(0)).count() == 0
    own = license_scan(spark.createDataFrame([("SPDX-License-Identifier: Foo-1.0 AND MIT", 7, 0.0)], "text string, doc_id long, score double"), more_identifiers=["FOO-1.0"])
    assert [(r.doc_id, r.labels, r.score, r.permitted) for r in own.collect()] == [(7, "foo-1.0,mit", 1.0, False)]


# ---- decontamination

def brute_tiles(doc, item, least):
    """Greedy string tiling by comparing every pair of places."""
    free_d, free_i, tiles = [True] * len(doc), [True] * len(item), []
    while True:
        best = (0, 0, 0)
        for d in range(len(doc)):
            for i in range(len(item)):
                n = 0
                while d + n < len(doc) and i + n < len(item) and free_d[d + n] and free_i[i + n] and doc[d + n] == item[i + n]:
                    n += 1
                if n > best[0]:
                    best = (n, d, i)
        n, d, i = best
        if n < least:
            return tiles
        free_d[d:d + n] = free_i[i:i + n] = [False] * n
        tiles.append((d, i, n))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5), max_size=25), st.lists(st.integers(1, 5), max_size=15))
def test_tiles_equal_brute_force(doc, item):
    got = tile(np.array(doc, np.uint64), np.array(item, np.uint64), 2)
    assert got == brute_tiles(doc, item, 2)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 5), max_size=25), st.lists(st.integers(1, 5), min_size=1, max_size=15), st.integers(0, 9))
def test_shared_windows_lose_no_tile(doc, item, least):
    got = tile_shared(np.array(doc, np.uint64), np.array(item, np.uint64), 3, least)
    want = brute_tiles(doc, item, min(3, len(item)))
    assert got == want or (got == [] and sum(t[2] for t in want) < least)


def test_leaks_reordered_and_odd_rows(spark):
    rng = random.Random(0)
    word = lambda: f"w{rng.randrange(10**6)}"
    item = [word() for _ in range(40)]
    fill = lambda n: [word() for _ in range(n)]
    rows = [(1, fill(300) + item + fill(300)), (2, fill(50) + item[20:] + fill(40) + item[:20]), (3, fill(500)), (4, fill(100) + item[:12] + fill(9)),
            (5, item[30:] + item[20:30] + fill(20) + item[10:20] + fill(5) + item[:10]), (None, item)]
    rows = [(d, " ".join(w).upper() if d == 1 else ", ".join(w), 1.0) for d, w in rows] + [(6, None, 1.0), (7, "", 1.0), (1, "other text", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, coverage double")
    bench = spark.createDataFrame([(9, " ".join(item)), (10, None), (11, "a b"), (None, "x")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in contaminated(docs, bench).collect()}
    assert set(got) == {(1, 9), (2, 9), (5, 9)} and all(r.coverage == 1 for r in got.values())
    assert got[1, 9].tiles == [[300, 0, 40]] and got[2, 9].n_tiles == 2
    assert contaminated(docs.limit(0), bench).count() == 0 and contaminated(docs, bench.limit(0)).count() == 0


def test_altered_short_and_wide_items_are_found(spark):
    rng = random.Random(3)
    word = lambda: f"v{rng.randrange(10**6)}"
    fill = lambda n: " ".join(word() for _ in range(n))
    item = [word() for _ in range(40)]
    fifth = " ".join("changed" if i % 5 == 4 else w for i, w in enumerate(item))
    third = " ".join("changed" if i % 3 == 2 else w for i, w in enumerate(item))
    apart = (" " + fill(150) + " ").join(" ".join(item[i:i + 3]) for i in range(0, 30, 3))
    wide = "数据库的索引可以加快查询速度"
    rows = [(1, f"{fill(20)} {fifth} {fill(20)}"), (2, third), (3, f"{fill(200)} {apart} {fill(9)}"), (4, f"{fill(30)} Alpha beta, GAMMA {fill(30)}"),
            (5, "alpha beta delta gamma"), (6, f"{fill(5)} solo"), (7, "soloist"), (8, f"我们知道{wide}。{fill(4)}"), (9, "我们知道数据"), (10, f"two {fill(1)} words two words"),
            (11, f"{fill(30_000)} {fifth}"), (11, "no leak under the same id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "alpha beta gamma"), (3, "solo"), (4, wide), (5, "two words"), (6, " .,")],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.coverage for r in contaminated(docs, bench).collect()}
    assert got == {(1, 1): 0.8, (3, 1): 0.75, (4, 2): 1, (6, 3): 1, (8, 4): 1, (10, 5): 1, (11, 1): 0.8}


def test_windows_of_a_third_of_all_rows_hide_no_pair(spark):
    """A phrase that every item and very many documents share is left out of the join; items made of it alone are still found."""
    rng = random.Random(4)
    phrase = [f"common{i}" for i in range(12)]
    items = {i: phrase + [f"own{i}x{k}" for k in range(14)] for i in range(20)} | {20: phrase, 21: phrase[:6] * 2}
    docs = {d: phrase + [f"z{rng.randrange(10**6)}" for _ in range(20)] for d in range(60)}
    docs |= {60 + d: [f"z{rng.randrange(10**6)}" for _ in range(30)] for d in range(100)}
    docs |= {200 + i: words[12:] + ["q"] + words[:3] for i, words in items.items() if i < 20}
    got = contaminated(spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id long, text string"),
                       spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")).collect()
    want = {(d, i) for d, doc in docs.items() for i, item in items.items() if sum(t[2] for t in brute_tiles(doc, item, 3)) >= len(item) / 2}
    assert {(r.doc_id, r.item_id) for r in got} == want and {(0, 20), (0, 21), (207, 7)} <= want


def test_decontamination_query_equals_tiling_of_all_pairs(spark):
    """Whole documents against all items, without seeds, by the tiling that brute force checks above."""
    words = lambda t: re.findall(r"[0-9a-z\x80-\U0010ffff]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    hashed = lambda t: word_hashes([w.encode() for w in words(t)])
    items = {r.item_id: hashed(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    want = {}
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        doc = hashed(r.text)
        for item, w in items.items():
            covered = sum(t[2] for t in tile(doc, w, min(3, len(w))))
            if covered >= len(w) / 2:
                want[r.doc_id, item] = max(covered / len(w), want.get((r.doc_id, item), 0))
    assert {(r.doc_id, r.item_id): r.coverage for r in op3_benchmark_decontamination(spark, SMALL).collect()} == want and want


# ---- passages

WIDE = "\u3005-\u3007\u3041-\u309f\u30a1-\u30fa\u30fc-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
WORD = re.compile(f"[{WIDE}]|[0-9A-Za-z\x80-\u2fff\u3100-\u33ff\uac00-\ud7af]+")


def brute_units(text, line_words, break_every):
    """(start, end, place of its first word, words) of sentence pieces, and of lines, by walking the text."""
    found = list(WORD.finditer(text))
    words = [m.group().translate({c: c + 32 for c in range(65, 91)}) for m in found]
    hashes = mix(word_hashes([w.encode() for w in words])) if words else []
    groups, lines = [], {}
    for i, m in enumerate(found):
        stop = i and re.search(r"[.!?][ \t\n\v\f\r]|[\u3002\uff01\uff1f\uff61]", text[found[i - 1].end():m.start()])
        if not i or stop or int(hashes[i - 1]) % break_every == 0:
            groups.append([])
        groups[-1].append(i)
        lines.setdefault(text.count("\n", 0, m.start()), []).append(i)
    out = []
    for g in groups:
        after = found[g[-1] + 1].start() if g[-1] + 1 < len(found) else len(text)
        out.append((found[g[0]].start(), after, g[0], tuple(words[i] for i in g)))
    whole, ends = [], [m.end() for m in re.finditer("\n", text)]
    for n, g in lines.items():
        if len(g) >= line_words:
            whole.append(([0, *ends][n], [*ends, len(text)][n], g[0], tuple(words[i] for i in g)))
    return out, whole


def brute_passages(rows, least=25, line_words=10, break_every=8):
    seen, spans = {}, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        pieces, whole = brute_units(text or "", line_words, break_every)
        for kind, found in ((0, pieces), (1, whole)):
            run, here = None, []
            for start, end, before, words in found:
                first = seen.setdefault((kind, words), doc)
                if (kind, words) not in here and first is doc and (kind, words, doc) not in seen:
                    seen[kind, words, doc] = True
                    run = None
                    continue
                if run is None or kind:
                    run = [before, start, end, 0, 0, first, kind]
                    here.append(run)
                run[2], run[3], run[4] = end, run[3] + 1, run[4] + len(words)
            spans += [(doc, id(text), *r) for r in here if kind or r[4] >= least]
    out = []
    for doc, at, before, start, end, n, words, keep, kind in sorted(spans, key=lambda s: (s[0] is None, s[0] or 0, s[1], s[2], s[8], s[6])):
        if out and out[-1][:2] == [doc, at] and before <= out[-1][3]:
            last = out[-1]
            last[3], last[5], last[6] = max(last[3], before + words), max(last[5], end), last[6] + n * (1 - kind)
        else:
            out.append([doc, at, before, before + words, start, end, n * (1 - kind), keep])
    return sorted(((d, s, e, n, high - low, k) for d, _, low, high, s, e, n, k in out), key=str)


def found_passages(found):
    return sorted(((r.doc_id, r.start, r.end, r.n_units, r.n_words, r.keep_doc_id) for r in found.collect()), key=str)


PASSAGE_TEXT = st.text(alphabet=st.sampled_from(list("ab D.!?\n\r\té字。アŁ9\x00")), max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(PASSAGE_TEXT, min_size=1, max_size=6), st.sampled_from([1, 2, 10]), st.sampled_from([2, 3, 8]))
def test_units_of_a_run_of_texts_equal_those_of_each_text(texts, line_words, break_every):
    got = {at: [] for at in range(len(texts))}
    for numbers, run, words in passage_dedup._runs(texts, break_every):
        text, place, starts, ends, before, count, alone = passage_dedup._places(words, *passage_dedup._units(words, line_words))
        for k, *unit in zip(text.tolist(), place.tolist(), starts.tolist(), ends.tolist(), before.tolist(), count.tolist(), alone.tolist()):
            if run is not None:
                unit[1:3] = (len(run[words.opens[k]:at].decode()) for at in unit[1:3])
            got[numbers[k]].append(unit)
    for at, text in enumerate(texts):
        pieces, whole = brute_units(text, line_words, break_every)
        want = [[place, *unit[:3], len(unit[3]), place >= len(pieces)] for place, unit in enumerate(pieces + whole)]
        assert sorted(got[at]) == want


def test_the_steps_of_a_run_of_texts_do_not_grow_with_their_number(monkeypatch):
    calls = []
    monkeypatch.setattr(passage_dedup, "mix", lambda x: calls.append(1) or mix(x))
    made = []
    for n in (2, 500):
        calls.clear()
        batches = [pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([f"text {i} has words. And more" for i in range(n)])], names=["row", "text"])]
        docs = SimpleNamespace(select=lambda *c: SimpleNamespace(mapInArrow=lambda run, schema: list(run(batches))))
        assert sum(b.num_rows for b in passage_dedup._halves(docs, 10, 10**9)) == 2 * n
        made.append(len(calls))
    assert made[0] == made[1]


@pytest.mark.parametrize("table", [SMALL, MEDIUM])
def test_passages_of_a_given_table_equal_brute_force(spark, table):
    docs = spark.read.parquet(f"{table}/documents.parquet")
    got = found_passages(repeated_passages(docs))
    assert len(got) > 5 and got == brute_passages([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("least, line_words, break_every", [(25, 10, 8), (5, 1, 3), (1, 4, 1000)])
def test_passages_equal_brute_force(spark, least, line_words, break_every):
    rng = random.Random(3)
    sentence = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(4, 14))).capitalize() + "."
    passage = [sentence() for _ in range(7)]
    rows = [(i, " ".join([sentence() for _ in range(5)] + passage * (i % 3 == 0) + [sentence() for _ in range(3)])) for i in range(40)]
    rows += [(50, "\n".join(passage).upper()), (51, None), (52, ""), (53, rows[4][1]), (54, "Short line.\nShort line."), (None, "a lost id " * 9),
             (55, "!!! ...\n\n"), (56, " ".join(passage[2:5]) + " あいう漢字。" * 9), (57, "x " * 90 + "\n" + " ".join(passage)), (58, "漢字" * 40 + "。" + "漢字" * 40)]
    docs = spark.createDataFrame([(t, d, 1, 2) for d, t in rows], "text string, doc_id long, start int, keep int")
    options = dict(min_words=least, line_words=line_words, break_every=break_every)
    found = repeated_passages(docs, **options)
    got = found_passages(found)
    assert got == brute_passages(rows, least, line_words, break_every) and len(got) > 13
    if least == 25:
        texts = {r.doc_id: r.text for r in remove_passages(docs, found).collect()}
        assert texts[1] == rows[1][1] and passage[2] not in texts[3] and passage[2] in texts[0] and texts[51] is None
    assert repeated_passages(docs.limit(0)).count() == 0


def test_repeated_rows_and_missing_ids(spark):
    text = " ".join(f"w{i}" for i in range(60)) + "."
    docs = spark.createDataFrame([(None, text), (5, text), (5, text), (None, text), (9, "y" * 100_000 + " " + text)], "doc_id long, text string")
    got = found_passages(repeated_passages(docs))
    assert sorted((str(d), k) for d, _, _, _, _, k in got) == [("5", 5), ("9", 5), ("None", 5), ("None", 5)]
    assert [n for d, _, _, _, n, _ in got if d == 5] == [60]


def test_a_passage_is_found_wherever_it_starts(spark):
    rng = random.Random(5)
    fill = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    rows, copies = [], 60
    for i in range(copies):  # 120 words inside long sentences, wrapped otherwise, cut anywhere
        passage = fill(120)
        rows.append((i, " ".join(fill(9) + passage + fill(7)) + "."))
        rows.append((1000 + i, " ".join(fill(rng.randrange(40))) + "\n" + "\n".join(", ".join(passage[k:k + 7]).upper() for k in range(0, 120, 7)) + " " + " ".join(fill(30))))
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} == {1000 + i for i in range(copies)}
    assert sum(r.n_words for r in found) > 0.7 * 120 * copies


# ---- quality scores

def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    rows = [r for r in op4_quality_classifier(spark, MEDIUM).collect() if r.held_out and r.doc_id in labels]
    assert len(rows) > 40 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert np.mean([r.predicted == labels[r.doc_id] for r in rows]) >= 0.95
    good, bad = ([r.score for r in rows if labels[r.doc_id] == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.97


def test_scores_on_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (None, "good text here", 0), (3, "good text here", 0), (3, "x", 0)], "doc_id long, text string, label int")
    labels = spark.createDataFrame([(1, 0), (2, None), (3, 1), (3, 1), (None, 0), (9, 1)], "doc_id long, quality int")
    out = quality_scores(docs, labels).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    assert quality_scores(docs.limit(0), labels).count() == 0
    assert {r.predicted for r in quality_scores(docs, labels.limit(0)).collect()} == {1}


def test_model_orders_by_preference():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    label = (x @ [2.0, -1.0, 0.0] + rng.normal(size=400) * 0.3 > -1).astype(int)
    model = PreferenceModel.fit(x, label)
    assert ((model.score(x) >= 0.3) == (label == 1)).mean() > 0.9


def plain_fit(better, worse, pairs=20, ridge=1e-3, seed=4):
    """The same loss over the same pairs, by accelerated gradient descent."""
    d = better[np.random.default_rng(seed).integers(len(better), size=len(worse) * pairs)] - np.repeat(worse, pairs, axis=0)
    w = v = np.zeros(d.shape[1])
    rate = 1 / (np.linalg.norm(d.T @ d / len(d), 2) / 4 + ridge)
    q = (np.sqrt(1 / (rate * ridge)) - 1) / (np.sqrt(1 / (rate * ridge)) + 1)
    for _ in range(20_000):
        wrong = 1 / (1 + np.exp(np.clip(d @ v, -500, 500)))
        new = v - rate * (ridge * v - d.T @ wrong / len(d))
        w, v = new, new + q * (new - w)
    return w


def test_fit_equals_plain_descent():
    rng = np.random.default_rng(7)
    better, worse = rng.normal(size=(60, 4)) + [1, 0, 0.5, 0], rng.normal(size=(25, 4))
    assert np.allclose(fit_preferences(better, worse), plain_fit(better, worse), atol=1e-5)


def test_scores_equal_a_plain_computation(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    learnt = sorted(d for d in labels if d in docs and zlib.crc32(str(d).encode()) % 5)
    x, y = np.array([features(docs[d]) for d in learnt]), np.array([labels[d] for d in learnt])
    scale = np.where(x.std(axis=0) < 1e-9, 1, x.std(axis=0))
    z = (x - x.mean(axis=0)) / scale
    w = plain_fit(z[y == 1], z[y == 0])
    threshold = np.quantile(z @ w, (y == 0).mean())
    rows = op4_quality_classifier(spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        s = (np.array(features(docs[r.doc_id])) - x.mean(axis=0)) / scale @ w - threshold
        assert abs(r.score - 1 / (1 + np.exp(-np.clip(s, -30, 30)) * 0.7 / 0.3)) < 1e-3
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3)


def test_long_repeated_and_clashing_rows_score_alike(spark):
    long = "word, another longer one. " * 40_000
    rows = [(i, "A plain text of some words, well written.", 0.0, True, "f") for i in range(3)] + [(7, long, 0.0, True, "f")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, held_out boolean, id string")
    labels = spark.createDataFrame([(i, int(i < 2), "t") for i in range(8)], "doc_id long, quality int, text string")
    out = [(r.doc_id, r.score) for r in quality_scores(docs, labels).collect()]
    assert len(out) == 5 and len({s for _, s in out}) == 2


# ---- URL filter

def test_rules_lists_and_odd_urls(spark):
    urls = ["http://a.org/x", "https://Example.ORG/es/1", "http://www.example.org/en/12?q", "x://m.site.com/fr/a#b", "http://com/de/", "nohost", None, "http://",
            "http://site.net/a/?b=2&a=1&ref=z", "https://www.site.net/a?a=1&b=2#top", "http://site.net/c", "http://org", "http://notexample.org.net/en/1"]
    docs = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(10, urls[10], "x")], "page_id long, url string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(docs, repeated_urls(docs), URL_RULES).collect()}
    assert got == {
        0: ("a.org", "/x", "org/", "allow"), 1: ("example.org", "/es/1", "example.org/es/", "block"), 2: ("www.example.org", "/en/12", "example.org/en/1", "block"),
        3: ("m.site.com", "/fr/a", "com/fr/", "allow"), 4: ("com", "/de/", "com/de/", "block"), 5: ("", "", None, "allow"), 6: ("", "", None, "allow"),
        7: ("", "", None, "allow"), 8: ("site.net", "/a/", None, "allow"), 9: ("www.site.net", "/a", None, "block"), 10: ("site.net", "/c", None, "allow"),
        11: ("org", "", None, "allow"), 12: ("notexample.org.net", "/en/1", None, "allow")}
    assert judge_urls(docs.limit(0), repeated_urls(docs), URL_RULES).count() == 0
    plain = repeated_urls(docs).select("canonical").unionByName(repeated_urls(docs).select("canonical"))  # a list without pages to keep
    blocked = {r.page_id for r in judge_urls(docs, plain, URL_RULES).collect() if r.verdict == "block" and r.rule is None}
    assert blocked == {8, 9, 10}
    lost = spark.createDataFrame([(None, "http://z.net/a", "x"), (4, "http://z.net/a?ref=1", "x"), (None, None, "x")], "host long, url string, keep string")
    got = judge_urls(lost, repeated_urls(lost, "host"), URL_RULES, id_col="host")
    assert sorted(((r[0], r.listed, r.verdict) for r in got.collect()), key=str) == [(4, True, "allow"), (None, False, "allow"), (None, True, "block")]
    assert {r.verdict for r in judge_urls(docs, repeated_urls(docs.limit(0)), URL_RULES).collect() if r.rule is None} == {"allow"}
