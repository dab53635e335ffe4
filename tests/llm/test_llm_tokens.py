"""Tokenizing, token files, packing and the pipeline against plain Python."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as entry_mod
import corpus_pipeline
from assetlens.llm import packing, queries, token_files
from assetlens.llm.common import read_table
from assetlens.llm.tokenizing import PieceEncoder
from assetlens.session import materialize
from conftest import SF_SMALL

ODD = ["", " ", "  ", "a  b", " a", "a ", "\n", "a \n b", "'s it's", "<|endoftext|> x <|startoftext|>", "　a b",
       "a\tb c", "é é x", "Σας Σ", "\x1c a", "a \x1c b", "👍🏽 ok  ", "İI ß", "A" * 3000, "wor&d, it's ABC!! x_y a`b [ok] w1 1w ~ don't"]


def library(path):
    return Tokenizer.from_file(path)


@pytest.mark.parametrize("path,keeps_space", [(queries.BYTE_BPE, True), (queries.WORD_BPE, False)])
def test_pieces_give_the_ids_of_whole_texts(spark, path, keeps_space):
    texts = ODD + [r["text"] or "" for r in read_table(spark, SF_SMALL, "documents").limit(80).collect()]
    plain = library(path)
    enc = PieceEncoder(path, keeps_space)
    for _ in range(2):  # unseen pieces, then cached ones
        flat, counts = enc.encode(texts)
        ends = np.cumsum(counts)
        for text, a, b in zip(texts, ends - counts, ends):
            assert flat[a:b].tolist() == plain.encode(text, add_special_tokens=False).ids + [1], text[:40]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"aB \n\t'é s<|>.", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof"]),
                         max_size=25).map("".join), min_size=1, max_size=4))
def test_pieces_of_any_white_space_and_special_tokens(texts):
    for path, keeps in ((queries.BYTE_BPE, True), (queries.WORD_BPE, False)):
        if path not in _ENCODERS:
            _ENCODERS[path] = PieceEncoder(path, keeps), library(path)
        enc, plain = _ENCODERS[path]
        flat, counts = enc.encode(texts)
        ends = np.cumsum(counts)
        for text, a, b in zip(texts, ends - counts, ends):
            assert flat[a:b].tolist() == plain.encode(text, add_special_tokens=False).ids + [1]


_ENCODERS: dict = {}


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 32])
def test_packed_ids_round_trip_and_random_access(bits):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 1 << bits, 1000, dtype=np.uint64).astype(np.uint32)
    assert token_files.unpack_ids(token_files.pack_ids(ids, bits), len(ids), bits).tolist() == ids.tolist()
    blob = token_files.write_shard([5, None], np.array([400, 600]), ids, bits, block_ids=64)
    reader = token_files.ShardReader(blob)
    assert len(blob) <= token_files.HEAD.size + 32 + 8 * 17 + 16 * -(-64 * bits // 8)
    for a, b in [(0, 1000), (63, 65), (64, 128), (999, 1000), (500, 500), (130, 900)]:
        assert reader.ids(a, b).tolist() == ids[a:b].tolist()
    with pytest.raises(IndexError):
        reader.ids(0, 1001)


def test_bits_and_ids_beyond_the_vocabulary():
    assert [token_files.bits_for(n) for n in (1, 2, 3, 256, 257, 49_408, 65_536, 65_537)] == [1, 1, 2, 8, 9, 16, 16, 17]
    with pytest.raises(ValueError):
        token_files.write_shard([1], np.array([1]), np.array([8], np.uint32), 3)


def test_token_files_hold_every_document_in_order(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_IDS", 5000)
    got = sorted(tuple(r) for r in queries.QUERIES["op9_bit_packed_token_files"](spark, SF_SMALL).collect())
    plain, start, want = library(queries.WORD_BPE), 0, []
    for doc, text in sorted((r["doc_id"], r["text"]) for r in read_table(spark, SF_SMALL, "documents").collect()):
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want


def check_pieces(pieces, texts):
    """Pieces cover each document's ids once, sequences are gapless and within the limit."""
    plain = library(queries.BYTE_BPE)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for p in sorted(by_doc[doc], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    used = padded = 0
    for own in by_seq.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048
        used += at
        padded += at if at & (at - 1) == 0 else 2048
    assert padded == used  # full sequences and powers of two only


def test_packing(spark):
    texts = {r["doc_id"]: r["text"] for r in read_table(spark, SF_SMALL, "documents").collect()}
    check_pieces(queries.QUERIES["op6_cost_balanced_packing"](spark, SF_SMALL).collect(), texts)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 5000), min_size=1, max_size=60))
def test_assignment_fills_every_sequence(counts):
    counts = np.array(counts)
    got = packing.assign(counts, 1024)
    room = packing.capacities(int(counts.sum()), 1024)
    filled = np.zeros(len(room), np.int64)
    for _, _, n, seq, offset in sorted(got, key=lambda p: (p[3], p[4])):
        assert offset == filled[seq] and n > 0
        filled[seq] += n
    assert (filled == room).all()
    for doc, n in enumerate(counts.tolist()):
        own = sorted((s, m) for d, s, m, *_ in got if d == doc)
        assert [s for s, _ in own] == np.cumsum([0] + [m for _, m in own])[:-1].tolist() and sum(m for _, m in own) == n


def test_costs_are_balanced():
    rng = np.random.default_rng(3)
    counts = rng.lognormal(5.0, 0.8, 3000).astype(int).clip(1, 600)
    cost = defaultdict(float)
    for _, _, n, seq, _ in packing.assign(counts):
        cost[seq] += packing.piece_cost(n)
    full = [cost[s] for s in range(int(counts.sum()) // 2048)]
    first_fit: list[list] = []  # the same documents, longest first, into the first sequence with room
    for n in sorted(counts.tolist(), reverse=True):
        for bin_ in first_fit:
            if sum(bin_) + n <= 2048:
                bin_.append(n)
                break
        else:
            first_fit.append([n])
    plain = [sum(packing.piece_cost(n) for n in b) for b in first_fit]
    assert np.std(full) < 0.5 * np.std(plain)


def test_stages_against_brute_force(spark):
    """Each stage judged on its own input; the last one by the ids of what is left."""
    docs = read_table(spark, SF_SMALL, "documents")
    bench = [r["text"] for r in read_table(spark, SF_SMALL, "benchmark").collect()]
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, before, SF_SMALL), f"test-{name}")
        old = {r["doc_id"]: r["text"] or "" for r in before.collect()} if name != "packing" else None
        if name == "packing":
            check_pieces(after.collect(), {r["doc_id"]: r["text"] for r in before.collect()})
            break
        assert after.columns == docs.columns
        kept = {r["doc_id"] for r in after.collect()}
        assert kept <= set(old)
        if name == "quality":
            got = queries.QUERIES["op3_rule_ensemble_quality"](spark, SF_SMALL).collect()
            assert kept == {r["doc_id"] for r in got if r["predicted"]}
        elif name == "exact_dedup":
            first = {}
            for d in sorted(old):
                first.setdefault(" ".join(old[d].split()), d)
            assert kept == set(first.values())
        elif name == "near_dedup":
            from test_llm_dedup import naive_fingerprint
            fps = {d: naive_fingerprint(t) for d, t in old.items()}
            linked = defaultdict(set)
            for a in fps:
                for b in fps:
                    if (fps[a] ^ fps[b]).bit_count() <= 2:
                        linked[a].add(b)
            seen, want = set(), set()
            for d in sorted(fps):
                if d not in seen:
                    want.add(d)
                    todo = [d]
                    while todo:
                        x = todo.pop()
                        if x not in seen:
                            seen.add(x)
                            todo += linked[x]
            assert kept == want
        elif name == "decontamination":
            gone = set(old) - kept
            assert {d for d, t in old.items() if any(b in t for b in bench)} <= gone
            assert len(gone) < 0.1 * len(old)
        before = after


def test_registration_and_names():
    names = entry_mod.queries()
    assert {f"op{n}_" for n in range(1, 11)} <= {k[:k.index("_") + 1] for k in names if k.startswith("op")}
    assert names["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "packing"]
