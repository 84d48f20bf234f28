import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from drivelake.llm import packing, queries, token_file, tokens


def library_ids(texts, end):
    tok = Tokenizer.from_file(tokens.vocabulary())
    return [[*e.ids, end] for e in tok.encode_batch(texts, add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_memo_gives_the_library_s_ids():
    rng = random.Random(5)
    bits = [" ", "  ", "\n", "\t", " ", "　", "a", "the", "'s", "'ll", "12", "3", ".", ",", "é", "日", "\U0001f600", "<|endoftext|>", "Zq", "_", "\x1c", "\x85", "é", "​"]
    texts = ["", " ", "a", " a", "a ", *("".join(rng.choices(bits, k=rng.randint(1, 30))) for _ in range(3000))]
    enc = tokens.Encoder(tokens.vocabulary())
    got = [np.frombuffer(x, enc.dtype).tolist() for x in enc.encode(texts)]
    assert got == [x[:-1] for x in library_ids(texts, 0)]


@pytest.mark.parametrize("seed", range(6))
def test_code_lengths_are_optimal_under_the_limit(seed):
    rng = np.random.default_rng(seed)
    counts = np.sort(rng.geometric(0.05 if seed % 2 else 0.5, rng.integers(2, 200)) ** rng.integers(1, 6))
    limit = int(len(counts) - 1).bit_length() + seed % 3
    bits = token_file.code_lengths(counts, limit)
    assert bits.max() <= limit and sum(2.0 ** -bits.astype(float)) <= 1
    if seed % 3 == 2:  # with room, as good as an unlimited Huffman code when that fits
        import heapq
        heap = [(int(c), i, 0) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        cost = 0
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            cost += a[0] + b[0]
            heapq.heappush(heap, (a[0] + b[0], a[1], max(a[2], b[2]) + 1))
        if heap[0][2] <= limit:
            assert int((bits * counts).sum()) == cost


def expected_starts(rows, end):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0))
    ids = library_ids([r[1] or "" for r in order], end)
    before, out = 0, []
    for (doc, _), x in zip(order, ids):
        out.append((doc, before, len(x), crc(x)))
        before += len(x)
    return out


def test_token_file_round_trip(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sorted(tuple(r) for r in queries.QUERIES["op1_token_file"](spark, sf_dir).collect())
    assert got == expected_starts([(r.doc_id, r.text) for r in docs.collect()], 2)


def test_token_file_odd_rows(spark, odd_docs, out_dir):
    token_file.write_corpus(spark, odd_docs, out_dir, parts=5)
    got = token_file.read_corpus(spark, out_dir).collect()
    want = expected_starts([(r.doc_id, r.text) for r in odd_docs.collect()], 2)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, crc(np.frombuffer(r.ids, "<u4"))) for r in got) == sorted((w[0] is not None, w[0] or 0, w[2], w[3]) for w in want)
    spans = sorted((r.start, r.start + r.n_tokens, r.doc_id is not None, r.doc_id or 0) for r in got)
    assert spans[0][0] == 0 and all(a[1] == b[0] and a[2:] <= b[2:] for a, b in zip(spans, spans[1:]))


def test_token_file_repeated_id_spreads_over_parts(spark, out_dir):
    rows = [(7, f"text {i}") for i in range(300)] + [(i, "x") for i in range(600)]
    token_file.write_corpus(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), out_dir, parts=12)
    got = sorted((r.start, r.n_tokens, r.doc_id) for r in token_file.read_corpus(spark, out_dir).collect())
    assert all(a[0] + a[1] == b[0] and a[2] <= b[2] for a, b in zip(got, got[1:])) and len(got) == 900
    assert spark.read.parquet(f"{out_dir}/parts").where("docs > 250").count() == 0


def test_token_file_empty(spark, no_docs, out_dir):
    token_file.write_corpus(spark, no_docs, out_dir)
    assert token_file.read_corpus(spark, out_dir, digest=True).count() == 0


def check_packing(rows, texts, end=0, capacity=1024):
    ids = {k: x for k, x in zip(texts, library_ids([t or "" for t in texts.values()], end))}
    docs, seqs = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append((r.start, r.length))
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.length > 0 and r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == crc(ids[r.doc_id][r.start: r.start + r.length])
    assert docs.keys() == ids.keys()
    for held, total in [*((docs[k], len(ids[k])) for k in ids), *((s, None) for s in seqs.values())]:
        at = 0
        for start, n in sorted(held):
            assert start == at
            at += n
        assert at == total if total is not None else at <= capacity and at & (at - 1) == 0


def test_packing(spark, sf_dir):
    rows = queries.QUERIES["op9_packing"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    check_packing(rows, {r.doc_id: r.text for r in docs})


def test_packing_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.dropDuplicates(["doc_id"])
    check_packing(packing.pack(docs, digest=True, group_chars=1000).collect(), {r.doc_id: r.text for r in docs.collect()})
    assert packing.pack(no_docs).count() == 0
    twice = packing.pack(odd_docs).groupBy("doc_id").sum("length").collect()
    want = {}
    for r, x in zip(odd_docs.collect(), library_ids([r.text or "" for r in odd_docs.collect()], 0)):
        want[r.doc_id] = want.get(r.doc_id, 0) + len(x)
    assert {r[0]: r[1] for r in twice} == want


@pytest.mark.parametrize("seed", range(20))
def test_pack_lengths_leaves_no_padding_and_is_first_fit(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(0, rng.choice([5, 600, 4000])) for _ in range(rng.randint(0, 80))]
    pieces = packing.pack_lengths(lengths, 256)
    seqs = {}
    for doc, start, n, s, at in pieces:
        seqs[s] = seqs.get(s, 0) + n
    assert all(n & (n - 1) == 0 and n <= 256 for n in seqs.values()) and sum(seqs.values()) == sum(lengths)
    tree, free = packing.Tournament(50, 100), [100] * 50
    for n in [rng.randint(1, 100) for _ in range(50)]:
        want = next(i for i, f in enumerate(free) if f >= n)
        free[want] -= n
        assert tree.place(n) == want
