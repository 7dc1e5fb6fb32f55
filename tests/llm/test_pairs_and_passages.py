"""SimHash near-duplicates, decontamination and licenses against brute force."""

import hashlib
import re
from collections import Counter

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from duescope.llm import decontaminate, licenses, nearcopies, simhash
from duescope.llm.common import components

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(items):
    """items: (id, fingerprint) -> component of each fingerprint by plain search."""
    fps = sorted({f for _, f in items})
    comp = {f: f for f in fps}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                comp[find(b)] = find(a)
    return {f: find(f) for f in fps}


def test_near_duplicates_match_brute_force(docs, doc_rows):
    got = simhash.near_duplicates(docs).collect()
    want = [(r[0], brute_fingerprint(r[1])) for r in doc_rows]
    comp = brute_components(want)
    first = {}
    for i, f in want:
        if i is not None:
            first[comp[f]] = min(first.get(comp[f], i), i)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got), key=key) == sorted(
        ((i, f, first.get(comp[f])) for i, f in want), key=key)


def test_one_row_of_each_component_stays(docs):
    found = simhash.near_duplicates(docs)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == found.select("root").distinct().count() == len(set(ids))
    assert 104 not in ids and 105 not in ids and 7 in ids


@pytest.mark.parametrize("crowd", [1, 128])
def test_links_of_clouds_of_near_fingerprints(spark, crowd):
    import random
    rng = random.Random(2)
    fps = {0, -1, 1 << 62}
    for _ in range(4):
        centre = rng.getrandbits(64)
        fps |= {(v - (1 << 64) if v >> 63 else v) for v in (centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(40))}
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), crowd=crowd).collect()}
    assert got == {(a, b) for a in fps for b in fps if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}


@given(st.integers(0, 2 ** 64 - 1), st.integers(0, 2 ** 64 - 1))
@settings(max_examples=200, deadline=None)
def test_manhattan_distance_bounds_differing_bits(a, b):
    counts = lambda x: [(x >> 2 * i & 1) + (x >> 2 * i + 1 & 1) for i in range(32)]
    assert sum(abs(x - y) for x, y in zip(counts(a), counts(b))) <= (a ^ b).bit_count()


def jaccard(a, b):
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} or {tuple(w)} - {()} for w in (low(a).split(), low(b).split())]
    return len(sets[0] & sets[1]) / max(1, len(sets[0] | sets[1]))


def found_components(rows, alike):
    """The smallest id of each component of rows (id, text) whose pairs are `alike`."""
    linked = {i: i for i, _ in rows}

    def find(x):
        while linked[x] != x:
            x = linked[x]
        return x
    for n, (i, a) in enumerate(rows):
        for j, b in rows[n + 1:]:
            if find(i) != find(j) and alike(i, j) and jaccard(a, b) >= 0.8:
                linked[max(find(i), find(j))] = min(find(i), find(j))
    return {find(i) for i, _ in rows}


@pytest.mark.parametrize("tile, early, many", [(3, 0, 2), (2048, 2, 16_384)])
def test_near_duplicate_stage_keeps_one_of_texts_at_similarity_four_fifths(spark, tile, early, many):
    """Copies with words replaced at even distances: most are more than 3 bits of a SimHash apart."""
    import random
    rng, rows = random.Random(3), []
    for g in range(30):
        w = [f"w{rng.randrange(5000)}" for _ in range(60 + 20 * g)]
        for k in range(4):
            v = list(w)
            for j in range(k * len(w) // 60):
                v[rng.randrange(len(v))] = f"x{g}.{k}.{j}"
            rows.append((100 * g + k, " ".join(v)))
        far = [x if i % 8 else f"y{g}.{i}" for i, x in enumerate(w)]
        rows.append((100 * g + 50, " ".join(far)))
    want = found_components(rows, lambda i, j: i // 100 == j // 100)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in nearcopies.one_of_each(docs, tile, early, many).collect()} == want


@pytest.mark.parametrize("tile, early, many", [(8, 1, 4), (2048, 2, 16_384)])
def test_a_text_similar_to_one_member_of_a_crowd_only_stays_linked(spark, tile, early, many):
    """Families of an original, thirty copies of it, and a text at 0.8125 to the original but under
    0.8 to each copy: the family is one component through the original."""
    rows = []
    for g in range(60):
        w = [f"w{g}.{i}" for i in range(62)]
        rows += [(1000 * g + k, " ".join([*w[:-1], f"c{g}.{k}"])) for k in range(30)]
        rows += [(1000 * g + 30, " ".join(w)), (1000 * g + 31, " ".join([f"q{g}.{i}" for i in range(6)] + w[6:]))]
    assert 0.8 <= jaccard(rows[30][1], rows[31][1]) < 0.82 and jaccard(rows[0][1], rows[31][1]) < 0.8
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {1000 * g for g in range(60)}
    assert want == found_components(rows, lambda i, j: i // 1000 == j // 1000)
    assert {r.doc_id for r in nearcopies.one_of_each(docs, tile, early, many).collect()} == want


@pytest.mark.parametrize("tile, early, many", [(40, 3, 16_384), (2048, 2, 16_384)])
def test_a_crowd_around_four_fifths_splits_as_brute_force_splits_it(spark, tile, early, many):
    """Hundreds of copies of one text, each with words of its own, at 0.6 to 1 to each other."""
    import random
    rng = random.Random(11)
    w = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(300):
        v = list(w)
        for j in range(rng.randrange(5)):
            v[rng.randrange(len(v))] = f"x{k}.{j}"
        rows.append((k, " ".join(v)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id for r in nearcopies.one_of_each(docs, tile, early, many).collect()}
    assert got == found_components(rows, lambda i, j: True)


def test_rows_equal_in_id_and_text_leave_one_by_their_other_columns(spark):
    rows = [(1, "one two three four five six", s) for s in ("b", "a", "b", None)] + [(2, "one two three four five six", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = [tuple(r) for r in nearcopies.one_of_each(docs).collect()]
    assert len(kept) == 1 and kept[0][0] == 1
    assert kept == [tuple(r) for r in nearcopies.one_of_each(docs.repartition(3, "source")).collect()]


def test_the_pipeline_stage_is_the_operator(spark, docs):
    kept = lambda df: sorted((str(tuple(r)) for r in df.collect()))
    assert kept(corpus_pipeline.near_duplicate_stage(spark, docs, "")) == kept(nearcopies.one_of_each(docs))


def test_the_pipeline_stage_drops_what_simhash_links(spark):
    """Two texts with one fingerprint whose sets of shingles are unlike, and a text of its own."""
    beat = "a b c d e f g h i " * 50
    rows = [(i, beat + " ".join(f"t{i}.{j}" for j in range(10))) for i in (1, 2)] + [(3, " ".join(f"w{j}" for j in range(40)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert jaccard(rows[0][1], rows[1][1]) < 0.8
    assert {r.component_id for r in simhash.near_duplicates(docs).collect()} == {1, 3}
    assert {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()} == {1, 3}


def test_near_duplicate_stage_takes_awkward_rows(spark, docs, empty):
    kept = nearcopies.one_of_each(docs)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns and len(ids) == len(set(ids))
    assert 7 in ids and 100 in ids and not {101, 102, 104, 105, None} & set(ids)
    assert nearcopies.one_of_each(empty).collect() == []


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def brute_contamination(text, items):
    w = WORD.findall(low(text))
    hit, found = set(), set()
    for item, t in items:
        v = WORD.findall(low(t))
        n = min(10, len(v))
        windows = {tuple(v[i:i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1) if n else ():
            if tuple(w[i:i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(item)
    return len(w), len(hit), sorted(map(str, found))


@pytest.mark.parametrize("slice_words", [decontaminate.SLICE, 40])
def test_contamination_matches_brute_force(spark, docs, doc_rows, monkeypatch, slice_words):
    monkeypatch.setattr(decontaminate, "SLICE", slice_words)
    long = doc_rows[5][1].split()
    items = [(1, " ".join(long[2:14])), (2, " ".join(doc_rows[6][1].split()[:40])), (3, "one"), (4, None), (5, ""),
             (6, "SAME same, same"), (10, "wholly absent words that no document of these ever holds at all"),
             (6, "SAME same, same"), (11, doc_rows[72 - 5][1][:3000])]
    got = decontaminate.contamination(docs, spark.createDataFrame([(a, b, "x") for a, b in items], "item_id long, text string, doc_id string")).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in got), key=key) == sorted(
        ((r[0], *brute_contamination(r[1], items)) for r in doc_rows), key=key)


def test_proximity_allows_moved_words(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = spark.createDataFrame([(1, item), (2, item.replace("delta", "x delta")), (3, item.replace("delta ", ""))], "doc_id long, text string")
    items = spark.createDataFrame([(9, item)], "item_id long, text string")
    hits = lambda slop: {r.doc_id for r in decontaminate.phrase_matches(docs, items, slop=slop).collect() if r.matches}
    assert hits(0) == {1} and hits(1) == {1, 2}


def test_clean_drops_documents_with_passages(spark, docs, doc_rows):
    items = spark.createDataFrame([(1, doc_rows[5][1])], "item_id long, text string")
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r[0] for r in doc_rows if r[0] != 5)


LINES = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "CC BY-NC 4.0 cc by nc",
         "This work is licensed under the GNU General Public License, version 3.", "All rights reserved.", "under the mit",
         "Permission is hereby granted, free of charge, to any new person obtaining a copy of this software and associated "
         "documentation files (the \"Software\"), to deal in the Software without restriction, including the rights to use, copy, "
         "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"]


def test_license_bases_match_brute_force(spark, doc_rows):
    texts = [(r[0], (r[1] or "") + "\n" + LINES[k % 7] * (1 + k % 2)) for k, r in enumerate(doc_rows)] + [(500, None), (501, "")]
    got = {(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
           for r in licenses.scanned(spark.createDataFrame([(*t, "x") for t in texts], "doc_id long, text string, label string")).collect()}
    want = set()
    for i, t in texts:
        w = WORD.findall(low(t))
        at = [(k, label) for label, p in licenses.BASE for k in range(len(w)) if w[k:k + len(p.split())] == p.split()]
        want.add((i, len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x for _, x in at}))))
    assert got == want


def test_license_labels_need_a_verified_span(spark):
    docs = spark.createDataFrame([(i, "some words before " + t) for i, t in enumerate(LINES)], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scanned(docs).collect()}
    assert [got[i][0] for i in range(7)] == ["mit", "apache-2", "cc-by-nc", "gpl,gpl-3", "all-rights-reserved", "", "mit"]
    assert got[0][1] == 1.0 and got[5][1] == 0.0 and 0.7 <= got[6][1] < 1.0


def test_license_spans_with_a_word_inserted_anywhere(spark):
    """The two halves lie on neighbouring diagonals; a half shorter than a triple is not part of the span."""
    docs, want = [], {}
    for label, text in licenses.TEMPLATES:
        w = WORD.findall(low(text))
        for at in range(1, len(w)) if len(w) >= 14 else ():
            lost = [n if n < licenses.K else 0 for n in (at, len(w) - at)]
            want[len(docs)] = (label, 4 + (at + 1 if lost[0] else 0), 4 + (at - 1 if lost[1] else len(w)), (len(w) - sum(lost)) / len(w))
            docs.append((len(docs), " ".join(["four", "words", "stand", "before", *w[:at], "zebra", *w[at:], "and", "after"])))
    assert len(docs) > 150
    got = {r.doc_id: [(s.label, s.first, s.last, s.cover) for s in r.spans or []]
           for r in licenses.scanned(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [i for i, span in want.items() if span not in got[i]] == []


def test_license_spans_past_strays(spark):
    """Words of the template on other diagonals stand between its halves."""
    made = spark.createDataFrame(
        [(1, 5, "x", False, 12, at, d) for d, ats in ((100, range(5)), (101, range(5, 10)), (40, [7, 8]), (160, [0])) for at in ats],
        "row_key long, template int, label string, base boolean, size int, at int, diagonal int")
    assert [tuple(r) for r in licenses.spans(made).select("first", "last", "cover").collect()] == [(100, 112, 1.0)]


def test_kelvin_sign_is_no_letter_k(spark):
    docs = spark.createDataFrame([(1, "under the mit license"), (2, "under the Kmit license"), (3, "K")], "doc_id long, text string")
    assert {r.doc_id: (r.n_base, r.n_words) for r in licenses.scanned(docs).collect()} == {1: (1, 4), 2: (0, 4), 3: (0, 1)}


def test_empty_tables(empty, docs, spark):
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.one_of_each(empty).collect() == []
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(empty, none).collect() == []
    assert {r.n_hit for r in decontaminate.contamination(docs, none).collect()} == {0}
    assert licenses.scanned(empty).collect() == []


def test_item_digest_is_that_of_the_sorted_ids(spark, docs, doc_rows):
    items = spark.createDataFrame([(10, doc_rows[5][1]), (9, doc_rows[5][1])], "item_id long, text string")
    row = [r for r in decontaminate.contamination(docs, items).collect() if r.doc_id == 5][0]
    assert hashlib.sha256(",".join(row.item_ids).encode()).hexdigest() == hashlib.sha256(b"10,9").hexdigest()
