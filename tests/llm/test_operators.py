"""Language id, license scan, neighbours, mixing, decontamination, language
model and token files against brute force, on texts with odd cases."""

import math
import os
import uuid
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests_llm_helpers import alnum_words, ascii_lower, frame, split_words

from ledgerline.llm import ann, common, decontamination, gru_lm, language_id, license_scan, mixing, queries, token_ids

SF = "/root/testdata/sf0.001"


def against_sql(spark, sql, got):
    con = duckdb.connect()
    con.register("documents", spark.createDataFrame(*got[1]).toPandas() if isinstance(got[1], tuple) else got[1].toPandas())
    return con.sql(sql).fetchall()


# ---------------------------------------------------------------- language id

def test_language_id(spark, docs, rows):
    model = language_id.fit(docs, ~language_id.held_out())
    got = language_id.predict(docs, model)
    assert set(got.columns) == {*docs.columns, "lang_pred", "score", "ambiguous"}
    out = got.select("doc_id", "lang", "lang_pred", "score", "text").collect()
    assert len(out) == len(rows)
    for r in out:
        letters = any(ch.isalpha() for ch in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
    sure = [r for r in out if r.doc_id is not None and r.doc_id < 60]
    assert sum(r.lang == r.lang_pred for r in sure) >= 0.9 * len(sure)
    again = language_id.predict(docs, language_id.fit(docs, ~language_id.held_out()))
    assert sorted(map(str, again.select("doc_id", "score").collect())) == sorted(map(str, got.select("doc_id", "score").collect()))


def test_language_codes_and_decoding():
    for k in (2, 4, 6, 12):
        code = language_id.codewords(k).astype(int)
        far = min((a != b).sum() for i, a in enumerate(code) for b in code[:i])
        assert far >= (1 << (k - 2) if k <= 6 else 8)
    model = language_id.Model(list("abcd"), language_id.codewords(4), np.zeros((7, 2)), np.ones(7))
    wrong_bit = 3.0 * language_id.codewords(4)[2].astype(float)
    wrong_bit[0] *= -1  # one bit predicted wrongly is corrected
    best, share, gap = model.decode(np.array([wrong_bit, np.zeros(7)]))
    assert best[0] == 2 and share[0] > 0.5 and gap[0] > 0.05 and gap[1] == 0


def test_language_features_read_whole_texts():
    data = np.frombuffer(b"abc " * 600_000, np.uint8)  # longer than a piece
    piece, language_id._PIECE = language_id._PIECE, 1 << 30
    whole = language_id.features(data)
    language_id._PIECE = piece
    cut = language_id.features(data)
    assert len(whole[0]) and (whole[0] == cut[0]).all() and np.allclose(whole[1], cut[1])


def test_language_id_degenerate(spark, empty):
    assert language_id.predict(empty, language_id.fit(empty, F.lit(True))).collect() == []
    one = frame(spark, [(1, "hello", "en", "a"), (2, "...", "en", "a"), (3, None, None, "a")])
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(one, language_id.fit(one, F.lit(True))).collect()}
    assert got == {1: ("en", 1.0), 2: ("und", 0.0), 3: ("und", 0.0)}
    none = frame(spark, [(1, "hello", None, "a")])
    assert language_id.predict(none, language_id.fit(none, F.lit(True))).first().lang_pred == "und"


# ---------------------------------------------------------------- licenses

TEXTS = ["Licensed under the Apache License, Version 2.0.", "released under the MIT License mit license",
         "This work is licensed under the GNU Lesser General Public License version 3", "CC BY-SA 4.0",
         "Licensed under CC BY-NC 4.0", "licensed under the gnu general public licence", "gnu general public license",
         "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
         "documentation files (the \"Software\"), to deal in the Software without restriction", None, "", "mit\x00license é apache"]


def test_license_scan(spark):
    rows = [(i, t, "en", "a") for i, t in enumerate(TEXTS)] + [(None, TEXTS[0], "en", "a")]
    df = frame(spark, rows)
    got = {r.doc_id: r for r in license_scan.scan(df).collect()}
    assert got[0].labels == "apache,apache-2.0-opening" and got[0].score == 0.75
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].labels) == (2, 3, 5, "mit,mit-notice")
    assert got[2].labels == "gpl-notice" and got[2].base_labels == ""
    assert got[3].labels == "cc-by" and got[3].score == 0.5
    assert got[4].labels == "cc-by,cc-by-notice"
    assert got[5].labels == "" and got[6].labels == "gpl" and got[7].labels == "mit-opening" and got[7].score == 0.75
    assert got[8].n_words == got[9].n_words == 0 and got[8].first_word is None
    con = duckdb.connect()
    con.register("documents", df.where("doc_id is null or doc_id < 10").toPandas())
    want = con.sql(license_scan.oracle()).fetchall()
    mine = license_scan.scan(df.where("doc_id is null or doc_id < 10")).drop("matches").collect()
    assert sorted(map(tuple, mine), key=str) == sorted([tuple(None if x != x else x for x in w) for w in want], key=str)


def _filled(template):
    """A template's wording with every optional part, and with none; its places filled."""
    def words(items, optional):
        for k, item in enumerate(items):
            if isinstance(item, str):
                yield item
            elif isinstance(item, int):
                yield from [f"Filled{k}"] * max(1, item - 1)
            elif optional:
                yield from words(item, optional)
    return [" ".join(words(license_scan.parse(template), o)) for o in (True, False)]


def test_full_licenses_hold_their_whole_mandatory_wording(spark):
    """Each template accepts its wording between other text; one changed or lost mandatory
    word, or one more, and only the opening is left."""
    texts, want = [], []
    for label, template in license_scan.TEMPLATES.items():
        mandatory = [w for w in license_scan.parse(template) if isinstance(w, str)]
        for text in _filled(template):
            words = text.split()
            at = max(k for k, w in enumerate(words) if w in mandatory[1:-1])
            for other, fits in ((words, True), (words[:at] + ["altered"] + words[at + 1:], False),
                                (words[:at] + words[at + 1:], False), (words[:at] + ["not"] + words[at:], False)):
                texts.append(f"Copyright (c) 2020 A. Holder. {', '.join(other).upper()}! the end")
                want.append((label, fits))
    df = frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    got = {r.doc_id: set(r.labels.split(",")) for r in license_scan.scan(df).collect()}
    for i, (label, fits) in enumerate(want):
        if not label.endswith("-opening") and fits is False:
            assert label not in got[i], (label, texts[i])
        if fits:
            assert label in got[i], (label, texts[i])
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    mine = license_scan.scan(df).drop("matches").collect()
    assert sorted(map(str, map(tuple, mine))) == sorted(str(tuple(None if x != x else x for x in w)) for w in con.sql(license_scan.oracle()).fetchall())


def test_altered_mit_license_is_only_an_opening(spark):
    full = _filled(license_scan.TEMPLATES["mit"])[0]
    altered = full.replace("publish distribute sublicense", "publish for noncommercial purposes distribute sublicense")
    two, three = (_filled(license_scan.TEMPLATES[x])[0] for x in ("bsd-2-clause", "bsd-3-clause"))
    df = frame(spark, [(i, t, "en", "a") for i, t in enumerate([full, altered, two, three])])
    got = {r.doc_id: (r.labels, r.score) for r in license_scan.scan(df).collect()}
    assert got == {0: ("mit,mit-opening", 1.0), 1: ("mit-opening", 0.75), 2: ("bsd-2-clause,bsd-opening", 1.0),
                   3: ("bsd-3-clause,bsd-opening", 1.0)}


def test_license_automaton_against_regex(spark):
    import itertools
    import re
    template = "a [[b [[c]]]] <<v:2>> d [[e]] f"
    auto, pattern = license_scan.Automaton(template), re.compile(license_scan._regex(license_scan.parse(template)))
    for n in range(1, 8):
        for words in itertools.islice(itertools.product("abcdf", repeat=n), 0, None, 7):
            hit = auto.match([w.encode() for w in words], 0) >= 0
            assert hit == bool(pattern.match(" ".join(words) + " ")), words


# ---------------------------------------------------------------- neighbours

def test_neighbours_small_and_odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0]), (4, [3.0, 3.0]), (5, None), (6, [0.0, 0.0]),
            (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [None, 1.0]), (10, []), (11, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (4, [3.0, 3.0])]
    df = spark.createDataFrame([(a, b, 0, "x", "x") for a, b in rows],
                               "vec_id long, embedding array<float>, label int, shard string, rank string")
    got = ann.nearest(df, F.col("vec_id") % 2 == 0, k=3).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        by.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert by == {0: [(1, 0.0), (2, 0.0), (3, math.sqrt(5))], 2: [(0, 0.0), (1, 0.0), (3, math.sqrt(5))],
                  4: [(3, math.sqrt(10)), (0, math.sqrt(13)), (1, math.sqrt(13))]}
    assert ann.nearest(df.where("false"), F.lit(True)).collect() == []


def test_neighbour_recall_over_shards(spark):
    rng = np.random.default_rng(5)
    v = (rng.standard_normal((1500, 16)) + 3 * rng.standard_normal((12, 16))[rng.integers(0, 12, 1500)]).astype(np.float32)
    v[300:800] = v[300]  # a third of all rows share one vector
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    got = ann.nearest(df, F.col("vec_id") % 50 == 0, shard_size=300).collect()
    assert sorted(got) == sorted(ann.nearest(df, F.col("vec_id") % 50 == 0, shard_size=300, query_block=7).collect())
    found, d = {}, v.astype(np.float64)
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
        assert r.score == pytest.approx(np.sqrt(((d[r.query_id] - d[r.vec_id]) ** 2).sum()), abs=1e-12)
    hit = 0
    for q in range(0, 1500, 50):
        far = np.sqrt(((d - d[q]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((np.arange(1500), far)) if j != q][:10]
        hit += len(found[q] & set(order))
        assert len(found[q]) == 10
    assert hit >= 0.95 * 10 * 30


# ---------------------------------------------------------------- mixing

def test_mixing_matches_sql(spark, rows):
    known = frame(spark, [r for r in rows if r[0] is not None])
    got = mixing.mix(known, preference=queries.short_first()).select("doc_id", "size", "source_size", "target", "taken").collect()
    con = duckdb.connect()
    con.register("documents", known.toPandas().astype({"doc_id": "int64"}))
    assert sorted(map(tuple, got)) == sorted(con.sql(mixing.ORACLE).fetchall())


def test_mixing_targets_and_reruns(spark, docs, rows):
    a = mixing.mix(docs, preference=queries.short_first())
    out = a.collect()
    assert len(out) == len(rows) and all(r.taken <= 3 * r["size"] for r in out)
    again = mixing.mix(docs.repartition(2), preference=queries.short_first()).collect()
    key = ["doc_id", "size", "taken"]
    assert Counter(tuple(r[k] for k in key) for r in out) == Counter(tuple(r[k] for k in key) for r in again)
    size, source = {}, {}
    for i, t, _, s in rows:
        n = len(split_words(t))
        size[s] = size.get(s, 0) + n
        source[i, n] = s
    order = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, left, free = {}, float(sum(size.values())), set(order)
    while True:  # share, cap, share the excess again
        w = sum(weight[s] for s in free)
        share = {s: left * weight[s] / w for s in free}
        over = {s for s in free if share[s] >= 3 * size[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * size[s]
            left -= target[s]
        free -= over
    for r in out:
        assert r.target == pytest.approx(target[source[r.doc_id, r["size"]]])
    assert mixing.mix(docs.where("false")).collect() == []
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns


def test_mixing_plan_is_native(docs):
    plan = mixing.mix(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---------------------------------------------------------------- decontamination

ITEM = "the quick zebra vaulted over nineteen lazy turquoise hippos while singing an obscure ballad about forgotten lighthouses"


def test_decontamination(spark):
    words, filler = ITEM.split(), "the of and to in a is that it was for on as with"
    edited = words.copy()
    for k in (4, 9, 14):
        edited[k] = "changed"
    dropped = words[:6] + words[7:12] + ["extra"] + words[12:]
    rows = [(1, f"{filler} {ITEM.upper()}! {filler}"), (2, f"{filler} {' '.join(edited)} {filler}"), (3, " ".join(dropped)),
            (4, filler * 30), (5, None), (6, ""), (7, f"{filler} {' '.join(words[:4])} {filler}"), (None, ITEM),
            (8, (filler + " ") * 3000 + ITEM + (" " + filler) * 2000), (9, ITEM), (9, ITEM)]
    docs = frame(spark, [(i, t, "en", "a") for i, t in rows])
    items = spark.createDataFrame([(1, ITEM, "x"), (2, None, "x"), (3, "", "x"), (4, "the of", "x"), (5, "unrelated " * 9, "x")],
                                  "item_id long, text string, doc_id string")
    got = decontamination.leaks(docs, items.where("item_id != 4")).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in got) == sorted((i is None, i) for i in (1, 2, 3, None, 8, 9, 9))
    score = {r.doc_id: r for r in got}
    assert score[1].score == 1.0 and (score[1].first_word, score[1].last_word) == (14, 13 + len(words))
    assert score[2].score == pytest.approx((len(words) - 3 - 1.5) / len(words)) and score[8].score == 1.0
    blocks = decontamination.leaks(docs, items.where("item_id != 4"), block_items=1).collect()
    assert sorted(map(str, blocks)) == sorted(map(str, got))
    short = decontamination.leaks(docs, items.where("item_id = 4")).collect()  # shorter than a seed
    assert {r.doc_id for r in short} >= {1, 2, 4}
    clean = decontamination.clean(docs, items.where("item_id != 4"))
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [4, 5, 6, 7]
    assert decontamination.leaks(docs.where("false"), items).collect() == []
    assert decontamination.leaks(docs, items.where("false")).collect() == []


def test_alignment_against_plain_smith_waterman():
    rng = np.random.default_rng(2)
    for _ in range(60):
        a, b = (rng.integers(0, 5, n).astype(np.uint64) for n in (rng.integers(1, 12), rng.integers(1, 20)))
        h = np.zeros((len(a) + 1, len(b) + 1))
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (1 if a[i - 1] == b[j - 1] else -.5), h[i - 1, j] - .5, h[i, j - 1] - .5)
        score, matched, first, last = decontamination.align(a, b)
        assert score == pytest.approx(h.max()) and matched >= score and (score == 0 or 0 <= first <= last < len(b))
        assert decontamination.align(a, b, whole=0) == (score, matched, first, last)  # in blocks of rows


def test_alignment_of_a_very_long_item():
    import tracemalloc
    rng = np.random.default_rng(3)
    item = rng.integers(0, 1 << 40, 20_000).astype(np.uint64)
    text = np.concatenate([rng.integers(0, 1 << 40, 10_000).astype(np.uint64), item, item[:5000]])
    tracemalloc.start()
    got = decontamination.align(item, text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == (20_000, 20_000, 10_000, 29_999) and peak < 100 << 20


def test_partial_leak_of_a_long_item(spark):
    words = [f"w{k}x{k * k % 977}" for k in range(500)]
    docs = frame(spark, [(1, "the of and " * 9 + " ".join(words[150:350]) + " to in a" * 9, "en", "a"),
                         (2, " ".join(words[10:30]), "en", "a"), (3, "the of and to in a " * 400, "en", "a")])
    items = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    got = decontamination.leaks(docs, items).collect()
    assert [(r.doc_id, r.item_id, r.score, r.n_matched, r.first_word, r.last_word) for r in got] == [(1, 7, 0.4, 200, 27, 226)]
    assert {r.doc_id for r in decontamination.clean(docs, items).collect()} == {2, 3}
    assert decontamination.leaks(docs, items, min_words=1e9).collect() == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test data not present")
def test_decontamination_against_every_pair(spark):
    """Aligning every document with every item finds no leak that the seeds miss."""
    sf = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    code: dict[str, int] = {}

    def words(text):
        return np.array([code.setdefault(w, len(code)) for w in alnum_words(text)], np.uint64)
    tests = [(r.item_id, words(r.text)) for r in items.collect()]
    want = set()
    for r in docs.collect():
        text = words(r.text)
        for item, w in tests:
            if len(w) and len(np.intersect1d(w, text)) * 2 >= len(np.unique(w)) - 1:  # else no score of half
                total = decontamination.align(w, text)[0]
                if total >= min(len(w) / 2, 25):
                    want.add((r.doc_id, item))
    assert want and {(r.doc_id, r.item_id) for r in queries.QUERIES["op7_decontamination"](spark, sf).collect()} == want


# ---------------------------------------------------------------- language model

def test_lm_counts_and_base(docs, rows):
    got = gru_lm.score(docs, chunk_bytes=900, parts=3, vocabulary=40, hidden=4, class_size=7).collect()
    tokens = [(i, [*split_words(ascii_lower(t or "")), None]) for i, t, *_ in rows]

    def out(i):
        return i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, ws in tokens if i is not None and not out(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = Counter((i, out(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6))
                   for i, ws in tokens)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_lm_gradients_and_normalisation():
    shape, rng = gru_lm.Shape(11, 4, 3), np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in gru_lm.start_values(shape, np.arange(11.0)).items()}
    x, y, h0 = rng.integers(0, 11, (5, 3)), rng.integers(0, 11, (5, 3)), rng.standard_normal((3, 4))
    g = gru_lm.gradients(p, shape, x, y, h0)[0]
    for k in p:
        for _ in range(5):
            i = tuple(rng.integers(0, m) for m in p[k].shape)
            moved = []
            for e in (1e-5, -1e-5):
                q = {a: b.copy() for a, b in p.items()}
                q[k][i] += e
                moved.append(gru_lm.gradients(q, shape, x, y, h0)[2])
            assert (moved[0] - moved[1]) / 2e-5 == pytest.approx(g[k][i], abs=1e-7)
    total = np.exp(gru_lm._token_log_probs(p, shape, np.tile(h0[:1], (11, 1)), np.arange(11))).sum()
    assert total == pytest.approx(1.0, abs=1e-6)


def test_lm_state_is_carried_over_windows():
    shape, rng = gru_lm.Shape(11, 4, 3), np.random.default_rng(0)
    p = gru_lm.start_values(shape, np.arange(11.0))
    tokens = rng.integers(0, 11, 200).astype(np.int32)
    offs = np.array([0, 1, 90, 95, 200])
    a = gru_lm.log_likelihoods(p, shape, tokens, offs, window=3)
    b = gru_lm.log_likelihoods(p, shape, tokens, offs, window=500)
    alone = [gru_lm.log_likelihoods(p, shape, tokens[i:j], np.array([0, j - i]))[0] for i, j in zip(offs, offs[1:])]
    assert np.allclose(a, b, atol=1e-3) and np.allclose(a, alone, atol=1e-3)


def test_lm_learns_order():
    shape = gru_lm.Shape(6, 8, 3)
    counts = np.array([100, 1, 100, 100, 100, 100.0])
    p = gru_lm.start_values(shape, counts)
    text = np.tile([2, 3, 4, 5, 0], 4000).astype(np.int32)
    offs = np.arange(0, 50, 5)
    before = gru_lm.log_likelihoods(p, shape, text[:45], offs).sum()
    gru_lm.train_stream(p, shape, text)
    assert gru_lm.log_likelihoods(p, shape, text[:45], offs).sum() > before / 5


def test_lm_trains_on_every_training_document(docs, rows, tmp_path, monkeypatch):
    def replica(*_):
        def run(batches):
            seen = [i for b in batches for i in b.column(0).to_pylist()]
            (tmp_path / uuid.uuid4().hex).write_text("\n".join(map(str, seen)))
            yield from ()
        return run
    monkeypatch.setattr(gru_lm, "_replica", replica)
    none = np.zeros(0, np.uint64)
    large = gru_lm.Counts(10 ** 10, 1, 1, none, none, none.astype(np.int64), np.array([1.0, 1.0]), 0)
    gru_lm.train(docs.select("doc_id", "text"), large, gru_lm.Shape(2, 4, 3), 7, 2)
    seen = Counter(int(i) for f in tmp_path.iterdir() for i in f.read_text().split())
    assert seen == Counter(i for i, *_ in rows if i is not None and zlib.crc32(str(i).encode()) % 7 != 2)


def test_lm_stream_is_trained_to_its_last_token(monkeypatch):
    shape, trained = gru_lm.Shape(6, 4, 3), []
    gradients = gru_lm.window_gradients

    def watched(p, shape, x, y, h):
        trained.extend(y.ravel())
        return gradients(p, shape, x, y, h)
    monkeypatch.setattr(gru_lm, "window_gradients", watched)
    tokens = np.random.default_rng(0).integers(0, 6, 4999).astype(np.int32)
    gru_lm.train_stream(gru_lm.start_values(shape, np.ones(6)), shape, tokens)
    assert Counter(trained) == Counter(tokens)


def test_lm_small_classes_share_calls(monkeypatch):
    shape, rng, calls, exp = gru_lm.Shape(2500, 4, 50), np.random.default_rng(0), [], np.exp
    p = gru_lm.start_values(shape, rng.integers(1, 99, 2500))
    monkeypatch.setattr(np, "exp", lambda *a, **k: calls.append(1) or exp(*a, **k))
    x, y = rng.integers(0, 2500, (2, 16, 32))  # about ten tokens a class
    gru_lm.window_gradients(p, shape, x, y, np.zeros((32, 4), np.float32))
    assert len(calls) < 10


def test_lm_few_long_documents_take_long_windows(monkeypatch):
    shape, calls, probs = gru_lm.Shape(11, 4, 3), [], gru_lm._token_log_probs
    monkeypatch.setattr(gru_lm, "_token_log_probs", lambda *a: calls.append(len(a[3])) or probs(*a))
    tokens = np.random.default_rng(0).integers(0, 11, 6000).astype(np.int32)
    gru_lm.log_likelihoods(gru_lm.start_values(shape, np.ones(11)), shape, tokens, np.array([0, 2900, 3000, 6000]))
    assert sum(calls) == 6000 and len(calls) < 5


@pytest.mark.parametrize("few, product, scale", [(0, 1, 1), (0, 10 ** 6, 1), (100, 1, 1), (100, 10 ** 6, 40), (0, 1, 40), (3, 1, 40)])
def test_lm_softmax_paths_agree(monkeypatch, few, product, scale):
    monkeypatch.setattr(gru_lm, "_FEW", few)
    monkeypatch.setattr(gru_lm, "_PRODUCT", product)
    shape, rng = gru_lm.Shape(11, 4, 3), np.random.default_rng(1)
    p = {k: v.astype(np.float64) for k, v in gru_lm.start_values(shape, np.arange(11.0)).items()}
    p["wc"] *= scale * 5
    p["ww"][:2] *= scale * 5
    states, y = rng.uniform(-1, 1, (90, 4)), np.concatenate([rng.integers(0, 9, 80), np.full(10, 4)])
    soft = []  # plain softmax over classes and within the class
    for w, b, at in ((p["wc"][None].repeat(90, 0), p["bc"], y // 3), (p["ww"][y // 3], p["bw"][y // 3], y % 3)):
        x = np.einsum("ti,tik->tk", states, w) + b
        e = np.exp(x - x.max(axis=1, keepdims=True))
        soft.append((w, at, e / e.sum(axis=1, keepdims=True)))
    want = sum(np.log(q[np.arange(90), at]) for _, at, q in soft)
    assert np.allclose(gru_lm._token_log_probs(p, shape, states, y), want, atol=1e-9)
    dwc, dw, used, ds, loss = gru_lm._output_gradients(p, shape, states, y, 1.0)
    assert loss == pytest.approx(-want.sum())
    d = [q - np.eye(q.shape[1])[at] for _, at, q in soft]
    assert np.allclose(ds, sum(np.einsum("tk,tik->ti", g, w) for g, (w, *_) in zip(d, soft)), atol=1e-9)
    assert np.allclose(dwc[:4], states.T @ d[0], atol=1e-9) and np.allclose(dwc[4], d[0].sum(axis=0), atol=1e-9)
    assert list(used) == [0, 1, 2]
    for k in used:
        mine = y // 3 == k
        assert np.allclose(dw[k, :4], states[mine].T @ d[1][mine], atol=1e-9) and np.allclose(dw[k, 4], d[1][mine].sum(axis=0), atol=1e-9)


def test_lm_words_of_a_large_batch_are_those_of_its_slices(monkeypatch):
    texts = pa.array(["Aa bb  cc", None, "", " ", "bb dd", "aa " * 50, "é aa"])
    batch = pa.RecordBatch.from_arrays([pa.array(range(7), pa.int64()), texts], names=["doc_id", "text"])
    words = gru_lm._Words(*common.text_buffers(pa.array(["aa bb"])))
    order = np.argsort(words.h1)
    counts = gru_lm.Counts(1, 1, 1, words.h1[order], words.h2[order], np.arange(2)[order] + 2, np.ones(4), 1)
    aa, bb = (int(counts.token_numbers(*(getattr(gru_lm._Words(*common.text_buffers(pa.array([w]))), h) for h in ("h1", "h2")))[0]) for w in ("aa", "bb"))
    assert {aa, bb} == {2, 3}
    want = [aa, bb, 1, 0, 0, 0, 0, bb, 1, 0, *[aa] * 50, 0, 1, aa, 0]
    for size, hashed in ((common.CHUNK_BYTES, 1 << 15), (12, 2), (1, 1)):
        monkeypatch.setattr(common, "CHUNK_BYTES", size)
        monkeypatch.setattr(gru_lm, "_HASHED", hashed)
        assert gru_lm._stream_tokens(batch, counts).tolist() == want


def test_lm_vocabulary_grows_with_the_corpus(spark, monkeypatch):
    shapes = []
    start_values = gru_lm.start_values
    monkeypatch.setattr(gru_lm, "start_values", lambda shape, counts: shapes.append(shape) or start_values(shape, counts))
    for words in (700, 1500):
        texts = [(i, " ".join(f"w{k}" for k in range(words)), "en", "a") for i in range(70)]
        n = sum(zlib.crc32(str(i).encode()) % 7 != 2 for i, *_ in texts)
        assert n >= 50
        assert gru_lm.score(frame(spark, texts)).count() == 70
        assert (shapes[-1].words, shapes[-1].class_size) == (words + 2, math.ceil(math.sqrt(words + 2)))


def test_lm_empty(empty):
    assert gru_lm.score(empty).collect() == []


# ---------------------------------------------------------------- token files

@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


ODD = ["Don't stop. it's I'll", "<|endoftext|> <|ENDOFTEXT|>. a<|startoftext|>b", "É.é,À! ﬁ Ω ΑΣ. é. Éx", "x1. 1.a a..b.",
       " hi there. İstanbul", "日本語。 ok… «été».", "A.B.C. U.S. 3.14, 'tis 'S. y's."]


def test_token_files_round_trip(spark, docs, rows, tokenizer):
    from tokenizers import Tokenizer
    full = Tokenizer.from_file(tokenizer)
    odd = frame(spark, [(200 + i, t, "en", "a") for i, t in enumerate(ODD)])
    manifest = token_ids.write(docs.unionByName(odd), tokenizer, parts=3, limit=4000)
    assert manifest.count() == 3
    got = token_ids.read(manifest).orderBy("start").collect()
    texts = sorted([(i is not None, i or 0, t or "") for i, t, *_ in rows] + [(True, 200 + i, t) for i, t in enumerate(ODD)])
    start = 0
    for r, (known, i, t) in zip(got, texts, strict=True):
        ids = [*full.encode(t, add_special_tokens=False).ids, 1]
        assert (r.doc_id, r.start, r.n_tokens) == (i if known else None, start, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    files = token_ids.TokenFiles(manifest)
    assert [x.tolist() for x in files.get(203)] == [[*full.encode(ODD[3], add_special_tokens=False).ids, 1]]
    assert files.get(999) == files.get(-5) == []


def test_token_files_repeated_keys_and_empty(spark, empty, tokenizer):
    same = frame(spark, [(5, "a b", "en", "x")] * 3 + [(6, "c", "en", "x")])
    manifest = token_ids.write(same, tokenizer, parts=2, limit=1)
    got = token_ids.read(manifest).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens) for r in got] == [(5, 0, 3), (5, 3, 3), (5, 6, 3), (6, 9, 2)]
    assert len(token_ids.TokenFiles(manifest).get(5)) == 3
    assert token_ids.read(token_ids.write(empty, tokenizer)).collect() == []


def test_lm_replicas_are_averaged_as_a_tree(spark):
    rng = np.random.default_rng(3)
    weights, tokens = rng.standard_normal((9, 2, 5)).astype(np.float32), rng.integers(1, 50, 9).tolist()
    rows = [(b, slot, weights[k, b].tobytes(), float(tokens[k])) for k, slot in enumerate([0, 1, 2, 5, 6, 11, 12, 13, 26]) for b in (0, 1)]
    replicas = spark.createDataFrame(rows, gru_lm.REPLICA_SCHEMA)
    want = np.average(weights, axis=0, weights=tokens)
    for fan_in in (3, 64):
        got = [np.frombuffer(b, np.float32) for b in gru_lm.averaged(replicas, fan_in)]
        assert np.allclose(got, want, atol=1e-5)
    assert gru_lm.averaged(replicas.where("slot < 0")) == []


def test_lm_vocabulary_is_bounded():
    assert gru_lm.vocabulary_size(10, 50) == 600                      # the least
    assert gru_lm.vocabulary_size(10 ** 6, 10 ** 8) == 20_000         # by the tokens
    assert gru_lm.vocabulary_size(5_000, 10 ** 8) == 5_000            # by the words that are frequent
    assert gru_lm.vocabulary_size(10 ** 9, 10 ** 13) == 1 << 18       # the most


def test_lm_vocabulary_is_the_most_frequent_words(spark):
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join(w for k, w in enumerate(words) for _ in range(1 + k // 7))) for i in range(0, 40)],
                                 "doc_id long, text string")
    learn = [i for i in range(40) if not gru_lm.held_out(i)]
    parts, seen = 3, []
    chunks = common.chunked(docs, parts, 500)
    counted = common.staged(chunks.mapInArrow(gru_lm._send_words(parts, lambda i: not gru_lm.held_out(i)), common.SHARD_SCHEMA)
                            .groupBy("shard").applyInArrow(gru_lm._count_shard(None, 50), common.ANSWER_SCHEMA), "lm-test")
    for size in (None, 0, 1, 11, 25, 1000):
        got = gru_lm._gather(counted, len(learn), size, 50)
        every = sorted((len(learn) * (1 + k // 7) for k in range(60)), reverse=True)
        assert got.known[2:].tolist() == every[:600 if size is None else size]
        assert got.tokens == sum(every) + len(learn) and got.distinct == 61
        assert got.known[1] == sum(every) - sum(got.known[2:])
        seen.append(set(got.h1.tolist()))
    assert seen[2] <= seen[3] <= seen[4] <= seen[5]


def test_language_sample_is_dealt_in_packed_blocks(spark):
    import numpy as np
    from ledgerline.llm import language_id
    docs = [(0, "der schnelle braune fuchs springt ueber den faulen hund " * 20), (1, "the quick brown fox jumps over " * 30), (0, "")]
    rows = [language_id.features(np.frombuffer(t.encode(), np.uint8)) for _, t in docs]
    blob = language_id.pack_features([p for p, _ in docs], rows)
    back = list(language_id.unpack_features(blob))
    assert [p for p, _, _ in back] == [0, 1, 0]
    for (ids, vals), (_, i, v) in zip(rows, back):
        assert (ids == i).all() and (vals == v).all() and i.dtype == np.int32 and v.dtype == np.float32
    frame = spark.createDataFrame([("de" if p == 0 else "en", t) for p, t in docs] * 200, "lang string, text string").repartition(2)
    dealt = language_id._featured(frame, ["de", "en"])
    assert dealt.columns == ["blob"]
    got = [r for b in dealt.collect() for r in language_id.unpack_features(b.blob)]
    assert len(got) == 600 and sum(len(b.blob) for b in dealt.collect()) < sum(8 * len(r[0]) for r in rows) * 200 / 2
