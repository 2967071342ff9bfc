"""Words, lines and windows of special shape are told apart; any tokenizer file is right."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import common as c
from ledgerline.llm import line_dedup, simhash, substring_dedup, token_ids
from test_copies import brute_lines, brute_spans
from tests_llm_helpers import frame


def thue_morse(n):
    word = "".join("ab"[i.bit_count() % 2] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_span_hash_depends_on_the_bytes_alone():
    words = [b"", b"a", b"abcdefg", b"abcdefgh", b"abcdefghi", b"x" * 255, b"x" * 256, b"x" * 257, b"x" * 70000, b"\0", b"\0\0"]
    words += [w.encode() for n in (16, 64, 128, 256, 512, 1024, 2048) for w in thue_morse(n)]
    seen = {}
    for pad in (b"", b"q", b"qqqqqqqqq"):
        data = np.frombuffer(pad.join([b""] + words + [b""]), np.uint8)
        starts, at = [], len(pad)
        for w in words:
            starts.append(at)
            at += len(w) + len(pad)
        starts = np.array(starts)
        ends = starts + [len(w) for w in words]
        for lane in (0, 1):
            h = c.span_hash(data, starts, ends, lane)
            assert len(set(h.tolist())) == len(words)
            assert seen.setdefault(lane, h.tolist()) == h.tolist()
    assert not set(seen[0]) & set(seen[1])


@pytest.mark.parametrize("width", [2, 20, 64, 65, 200, 1024])
def test_window_hash_is_a_function_of_the_window(width):
    a, b = (np.frombuffer(w.encode(), np.uint8).astype(np.uint64) for w in thue_morse(1024))
    words = c.mix(np.concatenate([a, b, a, np.arange(50, dtype=np.uint64)]))
    for lane in (0, 1):
        h = c.window_hash(words, width, lane)
        by_window, by_hash = {}, {}
        for k in range(len(words) - width + 1):
            window = words[k:k + width].tobytes()
            assert by_window.setdefault(window, int(h[k])) == int(h[k])
            assert by_hash.setdefault(int(h[k]), window) == window


def test_dedup_tells_thue_morse_words_and_lines_apart(spark):
    a, b = thue_morse(1024)
    fill = " ".join(f"w{k}" for k in range(19))
    rows = [(k, f"{a if k < 3 else b} {fill}\n{a if k < 3 else b}", "en", "s") for k in range(6)]
    docs = frame(spark, rows)
    got = substring_dedup.remove_repeated_spans(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_spans(rows, 20)
    got = line_dedup.remove_lines(docs).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got) == brute_lines(rows, 5)
    assert sum(r.n_dropped for r in got) == 0  # three documents hold each long line


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_library(name):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path(name)
    coder, full = token_ids.Encoder(path), Tokenizer.from_file(path)
    assert coder.by_word == name.startswith("word")
    texts = [*thue_morse(1024), *thue_morse(2048), " ".join(thue_morse(1024)), "", "Straße ÉTÉ été a-b <|endoftext|>x 12,5.",
             "<b>Hi</b> A.  B\tc\n", "word " * 50, "ﬁ İ ẞ é!  x́ ́y"]
    for _ in range(2):  # the second time from memory
        ids, n = coder.batch(*c.text_buffers(pa.array(texts)))
        got = [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
        assert got == [x.ids for x in full.encode_batch(texts, add_special_tokens=False)]


def test_encoder_memory_is_bounded():
    known = token_ids._WordIds(np.dtype("<u2"), limit=100)
    rng = np.random.default_rng(1)
    for turn in range(30):
        h = np.unique(rng.integers(0, 1 << 60, 40, dtype=np.uint64))
        known.shrink()
        assert len(known.h1) <= 140
        base = len(known.ids) + 2 * np.arange(len(h))
        known.ids = np.concatenate([known.ids, np.repeat((h % np.uint64(999)).astype("<u2"), 2)])
        known.add(h, h + np.uint64(1), base, np.full(len(h), 2))
        at = known.find(known.h1, known.h2)
        assert (at == np.arange(len(known.h1))).all()
        assert (known.ids[known.base] == (known.h1 % np.uint64(999))).all()
        assert (known.find(known.h1, known.h2 + np.uint64(7)) == -1).all()


def test_null_and_shared_ids_spread_over_files(spark, tmp_path):
    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(None, f"text {k % 7}", "en", "s") for k in range(40)] + [(5, "same text", "en", "s")] * 40 + [(9, "last", "en", "s")]
    manifest = token_ids.write(frame(spark, rows).repartition(6), path, parts=6)
    assert manifest.select("part").distinct().count() >= 4
    got = token_ids.read(manifest).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None] * 40 + [5] * 40 + [9]
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    want = np.array([*token_ids.Encoder(path).batch(*c.text_buffers(pa.array(["same text"])))[0], 1], "<u4")
    assert {r.ids_crc32 for r in got if r.doc_id == 5} == {zlib.crc32(want.tobytes())}
    assert len(token_ids.TokenFiles(manifest).get(5)) == 40


def test_first_of_each_keeps_one_row_a_component(spark):
    a, b = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    rows = [(5, a, "en", "s"), (5, b, "en", "s"), (3, b, "en", "s"), (3, b, "en", "s"), (None, a, "en", "s")]
    docs = frame(spark, rows).withColumnRenamed("rank", "__place").withColumnRenamed("row", "place")
    got = simhash.first_of_each(docs)
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter([(5, a), (3, b), (None, a)])


def test_language_stage_returns_clashing_columns(spark):
    import corpus_pipeline
    rows = [(k, text, lang, "s") for k in range(40) for text, lang in
            (("the house of the river and the wood", "en"), ("le bord de la rivière et de la forêt", "fr"))]
    docs = frame(spark, rows).withColumnRenamed("rank", "score").withColumnRenamed("row", "lang_pred") \
        .withColumnRenamed("key", "ambiguous")
    got = corpus_pipeline.detect_language(spark, docs, "")
    assert got.columns == docs.columns and got.schema == docs.schema
    assert sorted(got.collect()) == sorted(docs.collect())


def test_digest_names_the_text(spark):
    got = simhash.fingerprints(frame(spark, [(1, None, "en", "s"), (2, "Ab c", "en", "s")])).orderBy("doc_id").collect()
    assert [r.digest for r in got] == [hashlib.md5(x).hexdigest() for x in (b"", b"Ab c")]
