"""Packing (2) and token files (6) against the tokenizers library and plain loops."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from regioncast.llm import packing, queries, wavelet
from regioncast.llm.tokens import Encoder
from tests.llm.helpers import HARD, SF, documents, sf_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(PATH)
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


def test_encoder_equals_library(whole):
    texts = [x for _, x in sf_rows()] + [x for _, x in HARD] + [" lead", "a 's it's", "tail\n", "tab\tx", "a\n b", "...'ll 12ab"]
    got = Encoder.at(PATH).encode(pa.array(texts, type=pa.string()))
    for x, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == whole(x)


def test_added_tokens_have_their_own_ids(whole):
    texts = ["<|endoftext|>", "<|endoftext|> as text", "plain <|endoftext|> inside", "tail<|endoftext|>", "<|endoftext|" + "|>", "<|endoftext |>"]
    got = Encoder.at(PATH).encode(pa.array(texts, type=pa.string()))
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [whole(x) for x in texts]
    assert np.frombuffer(got[0], "<u4").tolist() == [50256]


def test_best_fit_matches_a_scan_over_all_open_bins():
    rng = np.random.default_rng(1)
    for cap in (10, 63, 64, 2048):
        lengths = np.sort(rng.integers(1, cap + 1, 400))[::-1]
        seq, off = packing.best_fit_decreasing(lengths, cap)
        bins = []
        for n in lengths.tolist():
            fit = [r for r in bins if r >= n]
            if fit:
                bins[bins.index(min(fit))] -= n
            else:
                bins.append(cap - n)
        used = {s: sum(lengths[seq == s]) for s in set(seq.tolist())}
        assert sorted(cap - u for u in used.values()) == sorted(bins)
        for s in used:
            at = np.argsort(off[seq == s])
            o, n = off[seq == s][at], lengths[seq == s][at]
            assert o[0] == 0 and (o[1:] == (o + n)[:-1]).all() and used[s] <= cap


def _check_pieces(rows, texts, whole):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, text in texts.items():
        ids = whole(text) + [0]
        got = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in got] == list(range(-(-len(ids) // 2048)))
        assert sum(r.length for r in got) == len(ids) and all(r.length == 2048 for r in got[1:])
        for r in got:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_seq.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 2048
    return len(by_seq)


def test_op2_whole_table(spark, whole):
    rows = queries.op2_best_fit_packing(spark, SF).collect()
    made = _check_pieces(rows, dict(sf_rows()), whole)
    assert made <= -(-sum(r.length for r in rows) // 2048) + 2


def test_packing_hard_cases(spark, whole):
    docs = documents(spark, HARD)
    rows = packing.packed(docs, PATH).collect()
    unique = {d: t for d, t in HARD if d != 5}
    _check_pieces(rows, {}, whole)
    assert {r.doc_id for r in rows} == {d for d, _ in HARD} and sum(r.doc_id == 5 for r in rows) == 2
    assert sum(r.length for r in rows if r.doc_id != 5) == sum(len(whole(t)) + 1 for t in unique.values())
    assert packing.packed(docs.limit(0), PATH).collect() == []


def test_sequences_hold_the_tokens(spark, whole):
    docs = dict(sf_rows())
    by_seq = {}
    for r in packing.packed(documents(spark, list(docs.items())), PATH).collect():
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == r.length
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.doc_id, r.piece, ids))
    found = {}
    for parts in by_seq.values():
        tokens = np.concatenate([p[3] for p in sorted(parts, key=lambda p: p[0])])
        assert len(tokens) <= 2048
        for offset, doc_id, piece, ids in parts:
            assert (tokens[offset:offset + len(ids)] == ids).all()
            found.setdefault(doc_id, {})[piece] = ids
    assert all(np.concatenate([found[d][p] for p in sorted(found[d])]).tolist() == whole(t) + [0] for d, t in docs.items())


def test_a_null_id_does_not_fill_one_group(spark, monkeypatch):
    rows = [(None, f"word {i}") for i in range(1500)] + [(i, f"other {i}") for i in range(1500)]
    pieces = packing.cut_documents(documents(spark, rows), PATH)
    got = packing.pack_pieces(pieces, group_pieces=300).collect()
    assert len(got) == 3000
    sizes = {}
    for r in got:
        sizes[r.sequence_id >> 32] = sizes.get(r.sequence_id >> 32, 0) + 1
    assert len(sizes) == 10 and max(sizes.values()) < 600
    by_bytes = packing.pack_pieces(pieces, group_bytes=4 * sum(r.length for r in got) // 4).collect()
    assert len({r.sequence_id >> 32 for r in by_bytes}) == 4


def test_packing_in_several_groups(spark):
    docs = documents(spark, sf_rows())
    pieces = packing.cut_documents(docs, PATH).select("doc_id", "piece", "start", "length")
    rows = packing.pack_pieces(pieces, group_pieces=60).collect()
    assert len({r.sequence_id >> 32 for r in rows}) > 1
    _check_pieces(rows, {}, None)


def test_wavelet_matrix_operations():
    rng = np.random.default_rng(2)
    for n, top in ((0, 1), (1, 1), (1500, 7), (5000, 50257), (3000, 1 << 20)):
        ids = (rng.integers(0, top, n) ** 2 // max(1, top)).astype(np.uint32)
        off = np.array([0, n // 3, n])
        doc_ids, offsets, m = wavelet.read_shard(wavelet.write_shard([4, None], off, ids))
        assert doc_ids == [4, None] and offsets.tolist() == off.tolist()
        assert (m.all() == ids).all()
        at = rng.integers(0, n, 200) if n else np.zeros(0, dtype=int)
        assert (m.access(at) == ids[at]).all()
        for symbol in set(ids[:20].tolist()) | {top + 1}:
            assert m.occurrences(symbol).tolist() == np.flatnonzero(ids == symbol).tolist()
            assert m.count(symbol, n // 4, n // 2) == (ids[n // 4:n // 2] == symbol).sum()


def _check_files(rows, texts, whole):
    at = 0
    for r, (doc_id, text) in zip(sorted(rows, key=lambda r: (r.start, r.n_tokens)), texts, strict=True):
        ids = whole(text) + [2]
        assert (r.doc_id, r.start, r.n_tokens) == (doc_id, at, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_op6_whole_table(spark, whole):
    _check_files(queries.op6_wavelet_tokens(spark, SF).collect(), sf_rows(), whole)


def test_token_files_hard_cases(spark, whole):
    from pyspark.sql import functions as F

    docs = documents(spark, HARD)
    for tokens in (wavelet.SHARD_TOKENS, 50):
        shards = wavelet.write_token_files(docs, PATH, shard_tokens=tokens)
        rows = wavelet.read_token_files(shards).withColumn("ids_crc32", F.crc32("ids")).collect()
        _check_files(rows, sorted(HARD, key=lambda r: (r[0] is not None, r[0])), whole)
    empty = wavelet.read_token_files(wavelet.write_token_files(docs.limit(0), PATH))
    assert empty.collect() == []
