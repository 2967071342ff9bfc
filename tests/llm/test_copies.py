"""Substring, line and SimHash dedup against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from ledgerline.llm import line_dedup, simhash, substring_dedup
from ledgerline.llm.components import connected_components
from ledgerline.llm.mph import PerfectHash
from tests_llm_helpers import ascii_lower, sha, split_words

WHITE = " \t\n\x0b\x0c\r"


def brute_spans(rows, width):
    seen, out = {}, Counter()
    for i, text in sorted(((i, t) for i, t, *_ in rows if i is not None), key=lambda r: r[0]):
        words = split_words(text)
        gone = [0] * len(words)
        for k in range(len(words) - width + 1):
            w = tuple(words[k:k + width])
            if w in seen:
                gone[k:k + width] = [1] * width
            seen.setdefault(w, (i, k))
        out[(i, len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone) if not g)))] += 1
    for i, t, *_ in rows:
        if i is None:
            out[(None, len(split_words(t)), 0, sha(" ".join(split_words(t))))] += 1
    return out


@pytest.mark.parametrize("options", [{}, {"chunk_bytes": 700, "parts": 3}, {"chunk_bytes": 700, "filter_bytes": 1}])
def test_substring_dedup(docs, rows, options):
    got = substring_dedup.remove_repeated_spans(docs, width=5, **options).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_spans(rows, 5)
    for r in got:
        assert sum(s["past"] - s["first"] for s in r.removed) == r.n_removed
        assert sha(r.kept_text) == r.kept_sha256


def test_substring_repeated_rows_stay_whole(spark, docs):
    from tests_llm_helpers import frame
    text = " ".join(f"w{i}" for i in range(30))
    twice = frame(spark, [(1, text, "en", "a"), (1, text, "en", "a")])
    got = substring_dedup.remove_repeated_spans(twice, chunk_bytes=50, parts=2).collect()
    assert [r.n_removed for r in got] == [0, 0]


def brute_lines(rows, min_docs):
    holders = defaultdict(list)

    def key(line):
        k = ascii_lower(line.strip(WHITE))
        return k if len(k) >= 40 else None
    for i, t, *_ in rows:
        if i is not None:
            for k in {key(x) for x in (t or "").split("\n")} - {None}:
                holders[k].append(i)
    out = Counter()
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or key(x) is None or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == i]
        out[(i, len(lines), len(lines) - len(kept), sha("\n".join(kept)))] += 1
    return out


@pytest.mark.parametrize("options", [{}, {"chunk_bytes": 600, "parts": 3}])
def test_line_dedup(docs, rows, options):
    got = line_dedup.remove_lines(docs, min_docs=3, **options).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got) == brute_lines(rows, 3)
    assert sum(r.n_dropped for r in got) > 0


def test_line_index_is_minimal_and_exact(docs, rows):
    from ledgerline.llm.common import unpack
    index = line_dedup.build_index(docs, parts=3).collect()
    total = 0
    for shard in index:
        counts = unpack(bytes(shard.counts))[0]
        assert PerfectHash.from_bytes(bytes(shard.hash)).n == shard.n == len(counts) and (counts > 0).all()
        total += shard.n
    keys = {ascii_lower(x.strip(WHITE)) for i, t, *_ in rows if i is not None for x in (t or "").split("\n")}
    assert total == sum(len(k) >= 40 for k in keys)


def test_perfect_hash():
    rng = np.random.default_rng(0)
    h1, h2 = (rng.integers(0, 1 << 63, 5000).astype(np.uint64) for _ in range(2))
    h1[:50] = h1[0]  # equal halves still separate
    ph = PerfectHash.from_bytes(PerfectHash.build(h1, h2).to_bytes())
    assert sorted(ph.index(h1, h2)) == list(range(5000))
    assert len(ph.to_bytes()) < 5000
    none = PerfectHash.build(h1[:0], h2[:0])
    assert none.n == 0 and list(none.index(h1[:2], h2[:2])) == [-1, -1]


def brute_print(text):
    words = split_words(ascii_lower(text or ""))
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits):
    nodes = sorted(set(prints))
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in nodes:
        for b in nodes:
            if a < b and (a ^ b).bit_count() <= bits:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("bits", [0, 2, 5])
def test_simhash(docs, rows, bits):
    prints = {(i, t): brute_print(t) for i, t, *_ in rows}
    roots = brute_components(prints.values(), bits)
    smallest = {}
    for (i, _), p in prints.items():
        if i is not None:
            smallest[roots[p]] = min(i, smallest.get(roots[p], i))
    want = Counter((i, prints[(i, t)], smallest[roots[prints[(i, t)]]] if i is not None else None) for i, t, *_ in rows)
    got = simhash.near_duplicates(docs, max_bits=bits, segments=max(5, bits + 1)).collect()
    assert Counter((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got) == want


def test_simhash_buckets_too_large_for_a_task(docs):
    def run(**options):
        return Counter((r.doc_id, r.fp, r.component_id, r.n_links)
                       for r in simhash.near_duplicates(docs, **options).collect())
    assert run(bucket=1) == run()


def test_simhash_links_by_blocks_and_by_flips_agree():
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 1 << 63, 3).astype(np.uint64)
    flips = np.array([1 << int(a) | 1 << int(b) for a, b in rng.integers(0, 64, (600, 2))], dtype=np.uint64)
    fps = np.unique(np.concatenate([x ^ flips for x in centre]))
    want = brute_components([int(x) for x in fps], 2)
    found = []
    for s in range(5):
        chain = simhash.chain_masks(s, 5, 2)
        allowed = simhash.allowed_flips(chain, 2)
        keys = fps & np.uint64(max(m for m, budget in chain if budget == 0))
        for k in np.unique(keys):
            group = np.sort(fps[keys == k])
            blocks = {(int(group[x]), int(group[y])) for a, b in simhash._near_in_blocks(group, chain) for x, y in zip(a, b)}
            flip = {tuple(sorted((int(group[x]), int(group[y])))) for a, b in simhash._near_by_flips(group, allowed) for x, y in zip(a, b)}
            assert blocks == flip
            src, dst = simhash.spanning_links(group, chain, allowed)
            assert len(src) < len(group)
            found += list(zip(src.tolist(), dst.tolist()))
    root = {int(x): int(x) for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in found:
        root[max(find(a), find(b))] = min(find(a), find(b))
    assert {n: find(n) for n in root} == want


def test_components_of_chain_and_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(30)] + [(5, 5)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{1000 + i: 1000 for i in range(30)}}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).collect() == []


def test_first_of_each_keeps_columns(docs, rows):
    kept = simhash.first_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 0 in ids and 106 not in ids and 107 not in ids and ids.count(None) == 2


def test_empty_tables(empty):
    assert substring_dedup.remove_repeated_spans(empty).collect() == []
    assert line_dedup.remove_lines(empty).collect() == []
    assert simhash.near_duplicates(empty).collect() == []
