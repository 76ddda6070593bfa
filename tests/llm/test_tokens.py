from __future__ import annotations

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import tiktoken
from conftest import bag
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest import ODD
from tokenizers import Tokenizer

from promolens.llm import bpe, packing, shards

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
TABLE = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
KNOWN = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=TABLE, special_tokens={})
OWN, CHUNKED = bpe.coder(RANKS, public_tokenizers.PATTERN)
HARD = ["a  b", " a", "a ", "a \n b", "\n \n", "foo\n  bar", "x" * 3000, "ab" * 999, "it's 'tis", " ", "a  b", "<|endoftext|>", "\t a", "a   b  c d"]


def same(text):
    ids = np.frombuffer(CHUNKED.packed(text), dtype=CHUNKED.code).tolist()
    assert ids == KNOWN.encode_ordinary(text)
    assert OWN.decode(ids) == text.encode()


def test_hard_texts():
    for text in HARD:
        same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\tabtheing'.é日"), st.characters(exclude_categories=["Cs"])), max_size=80))
def test_any_text(text):
    same(text)


def test_query_rows(documents):
    rows = ODD + [(100 + k, t) for k, t in enumerate(HARD)]
    got = bag(bpe.token_digests(documents(rows), RANKS, public_tokenizers.PATTERN))
    want = []
    for i, t in rows:
        ids = KNOWN.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    full = bpe.encode_documents(documents(ODD), RANKS, public_tokenizers.PATTERN).collect()
    assert all(KNOWN.decode_bytes(r.ids) == bytes(r.decoded) for r in full) and len(full) == len(ODD)


def jump(key, n):
    def mix(x):
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 % 2**64
        x ^= x >> 27
        x = x * 0x94D049BB133111EB % 2**64
        return x ^ x >> 31

    key, b, j = mix((key + 0x9E3779B97F4A7C15) % 2**64), -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_moves_little():
    keys = np.arange(-50, 20000)
    old, new = shards.jump_hash(keys, 40), shards.jump_hash(keys, 41)
    assert old.tolist()[:300] == [jump(int(k), 40) for k in keys[:300]]
    assert set(new[old != new]) == {40} and abs((old != new).mean() - 1 / 41) < 0.01
    assert np.bincount(old).max() < 1.2 * len(keys) / 40


def test_shards(documents):
    rows = ODD + [(k, f"t{k % 7}") for k in range(100, 600)]
    got = shards.shard_documents(documents(rows), 5).collect()
    assert sorted((repr(r.doc_id), r["size"], r.text_crc32, r.shard, r.grown_shard) for r in got) == sorted(
        (repr(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode()), jump(i or 0, 5), jump(i or 0, 6)) for i, t in rows
    )
    for k in range(5):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))
    assert shards.shard_documents(documents([]), 5).count() == 0


def test_write_shards(documents, spark, tmp_path):
    shards.write_shards(documents([(k, "t") for k in range(50)]).drop("shard"), str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.doc_id, r.shard) for r in back.collect()} == {(k, jump(k, 4)) for k in range(50)}


def test_plan_uses_up_any_histogram():
    rng = np.random.default_rng(1)
    for counts in (rng.integers(0, 300, 128), np.eye(128, dtype=int)[60] * 1001, np.zeros(128, int), np.eye(128, dtype=int)[0]):
        found = packing.plan(counts)
        used = np.zeros(128, dtype=int)
        for pattern, times in found:
            assert sum(pattern) <= 128 and times > 0
            for size in pattern:
                used[size - 1] += times
        assert (used == counts).all()
    counts = rng.integers(200, 400, 128)
    sequences = sum(times for _, times in packing.plan(counts))
    assert (counts * np.arange(1, 129)).sum() / sequences / 128 > 0.99


def test_nonnegative_least_squares():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(30, 12)), rng.normal(size=30)
    x = packing.nonnegative_least_squares(a, b)
    gain = a.T @ (b - a @ x)
    assert (x >= 0).all() and (gain < 1e-8).all() and np.abs(gain[x > 0]).max() < 1e-8


def test_packing(documents):
    rows = ODD + [(100 + k, t) for k, t in enumerate(HARD)] + [(1000 + k, f"some words {k} " * (k % 90)) for k in range(400)]
    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    known.encode_special_tokens = True
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    got = packing.pack_documents(documents(rows), ranks, public_tokenizers.PATTERN, 1).collect()
    want = []
    for i, t in rows:
        ids = [*known.encode(t or "", add_special_tokens=False).ids, 1]
        for s in range(0, len(ids), 2048):
            part = ids[s : s + 2048]
            want.append((i, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids)))
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    sequences: dict = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(r.length for r in got) / (len(sequences) - 1) / 2048 > 0.95
    assert packing.pack_documents(documents([]), ranks, public_tokenizers.PATTERN, 1).count() == 0


def test_packed_sequences_hold_the_ids(documents):
    rows = ODD + [(100 + k, t) for k, t in enumerate(HARD)] + [(1000, "some words " * 3000)]
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    known = tiktoken.Encoding("k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    for end_id in (1, 70_000):
        packed = packing.pack_documents(documents(rows), ranks, public_tokenizers.PATTERN, end_id)
        pieces = packed.collect()
        want = [(i, [*known.encode_ordinary(t or ""), end_id]) for i, t in rows]
        assert sorted(((r.doc_id, r.start, r.ids) for r in pieces), key=repr) == sorted(((i, s, ids[s : s + 2048]) for i, ids in want for s in range(0, len(ids), 2048)), key=repr)
        whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
        assert sum(map(len, whole.values())) == sum(len(ids) for _, ids in want) and max(map(len, whole.values())) <= 2048
        for r in pieces:
            assert whole[r.sequence_id][r.offset : r.offset + r.length] == r.ids
        derived = packing.digests(packed.withColumn("ids_crc32", packed.start)).collect()
        assert sorted((repr(r.doc_id), r.start, r.ids_crc32) for r in derived) == sorted((repr(r.doc_id), r.start, r.ids_crc32) for r in pieces)
