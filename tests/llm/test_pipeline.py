"""Registration, and the pipeline against brute force on the small tables."""

import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from tests_llm_helpers import alnum_words, ascii_lower, split_words

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert {"op2_license_scan", "op4_substring_dedup", "op5_line_dedup", "op6_mixing", "op11_phrase_mining",
            "op12_hard_negatives"} <= set(entry.oracle_sql())


def brute_print(text):
    words = split_words(ascii_lower(text))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k:k + 3]).encode(), 42) for k in range(max(1, len(words) - 2))] if words else []
    bits = np.array([[h >> b & 1 for b in range(64)] for h in hashes]).sum(axis=0) if hashes else np.zeros(64)
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(hashes))


def test_pipeline_stages(spark):
    import corpus_pipeline as p
    import public_tokenizers
    from tokenizers import Tokenizer

    from ledgerline.llm import mixing
    from ledgerline.llm.common import read_table, staged
    docs = read_table(spark, SF, "documents")
    columns, outputs = docs.columns, {}
    for name, stage in p.STAGES:
        docs = staged(stage(spark, docs, SF), name)
        outputs[name] = docs.toPandas()
    assert all(list(outputs[n].columns) == columns for n in list(outputs)[:-1])
    raw = duckdb.sql(f"from '{SF}/documents.parquet'").df()
    told = outputs["language_id"]
    wanted = set(raw.doc_id[[len(alnum_words(t)) > 20 and t[0].isalpha() for t in raw.text]])
    assert len(wanted) > 50 and len(wanted - set(told.doc_id)) <= 0.03 * len(wanted) and len(told) >= 0.97 * len(raw)

    prints = {i: brute_print(t) for i, t in zip(told.doc_id, told.text)}
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(prints)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                root[max(find(a), find(b))] = min(find(a), find(b))
    apart = outputs["simhash_near_dedup"]
    assert sorted(apart.doc_id) == sorted(i for i in ids if find(i) == i)

    items = [" ".join(alnum_words(t)) for t in duckdb.sql(f"select text from '{SF}/benchmark.parquet'").df().text]
    exact = {i for i, t in zip(apart.doc_id, apart.text) if any(f" {x} " in f" {' '.join(alnum_words(t))} " for x in items)}
    clean = outputs["decontamination"]
    gone = set(apart.doc_id) - set(clean.doc_id)
    assert gone >= exact and len(gone - exact) <= 0.02 * len(apart)

    con = duckdb.connect()
    con.register("documents", clean)
    taken = {i: (n // s if s else 0) for i, s, _, _, n in con.sql(mixing.ORACLE).fetchall()}
    mixed = outputs["mixing"]
    counts = mixed.doc_id.value_counts().to_dict()
    sizes = dict(zip(clean.doc_id, (len(split_words(t)) for t in clean.text)))
    assert {i: counts.get(i, 0) for i in taken if sizes[i]} == {i: n for i, n in taken.items() if sizes[i]}

    full, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    last = outputs["token_ids"].sort_values("start")
    for (i, t), r in zip(sorted(zip(mixed.doc_id, mixed.text)), last.itertuples(), strict=True):
        enc = [*full.encode(t, add_special_tokens=False).ids, 1]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(enc), zlib.crc32(np.array(enc, "<u4").tobytes()))
        start += len(enc)


@pytest.mark.parametrize("name", ["op3_nearest_neighbours", "op7_decontamination"])
def test_queries_run(spark, name):
    from ledgerline.llm.queries import QUERIES
    got = QUERIES[name](spark, SF).toPandas()
    if name.startswith("op3"):
        v = duckdb.sql(f"select vec_id, embedding from '{SF}/embeddings.parquet' order by vec_id").fetchnumpy()
        e = np.stack(list(v["embedding"])).astype(np.float64)
        hit = 0
        for q, part in got.groupby("query_id"):
            far = np.sqrt(((e - e[q]) ** 2).sum(axis=1))
            far[q] = np.inf
            hit += len(set(np.argsort(far, kind="stable")[:10]) & set(part.vec_id))
        assert hit >= 0.9 * len(got) and len(got) == 10 * got.query_id.nunique()
    else:
        docs = dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())
        items = dict(duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall())
        exact = {(i, k) for i, t in docs.items() for k, x in items.items()
                 if f" {' '.join(alnum_words(x))} " in f" {' '.join(alnum_words(t))} "}
        assert set(zip(got.doc_id, got.item_id)) >= exact
