import hashlib
import random
import sys

from tokenizers import Tokenizer

from drivelake.llm import pair_bpe, queries, tokens

PATH = tokens.vocabulary("word_bpe_49k.json")


def library():
    tok = Tokenizer.from_file(PATH)
    tok.no_truncation()
    tok.no_padding()
    return tok


def want(texts):
    tok = library()
    out = []
    for e in tok.encode_batch(texts, add_special_tokens=False):
        out.append((" ".join(map(str, e.ids)), len(e.ids), tok.decode(e.ids, skip_special_tokens=False)))
    return out


def test_like_the_library_on_odd_texts():
    rng = random.Random(3)
    bits = [" ", "  ", "\n", "\t", "\x1c", "\x85", " ", "　", "a", "aaaa", "The", "'s", "'LL", "12", ".", ",,", "é", "é", "日", "\U0001f600", "<|endoftext|>", "<|startoftext|>",
            "İ", "Σ", "σΣ", "_", "​", "ẞ", "ﬁ", "½", "٤", "K"]
    texts = ["", " ", *("".join(rng.choices(bits, k=rng.randint(1, 25))) for _ in range(3000))]
    assert pair_bpe.WordBpe(PATH).encode(texts) == want(texts)


def test_like_the_library_on_every_character():
    texts = [f"a{chr(c)}b" for c in [*range(1, 0xD800, 3), *range(0xE000, 0x20000, 3), *range(0x20000, sys.maxunicode, 997)]]
    assert pair_bpe.WordBpe(PATH).encode(texts) == want(texts)


def test_overlapping_pairs_merge_from_the_left():
    index = pair_bpe.PairIndex({"a": 0, "aa": 1, "aaa": 2, "b": 3}, [("a", "a"), ("aa", "a")])
    assert index.encode([list("aaa"), list("aaaab"), [], ["?"], list("baaaaa")]) == [[2], [1, 1, 3], [], [], [3, 1, 2]]


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    lib = {r.doc_id: w for r, w in zip(docs, want([r.text or "" for r in docs]))}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    got = {r.doc_id: (r.ids_sha256, r.n_tokens, r.decoded_sha256) for r in queries.QUERIES["op5_pair_bpe"](spark, sf_dir).collect()}
    assert got == {k: (sha(i), n, sha(d)) for k, (i, n, d) in lib.items()}


def test_odd_rows(spark, odd_docs, no_docs):
    rows = odd_docs.collect()
    lib = want([r.text or "" for r in rows])
    got = pair_bpe.encode(odd_docs)
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, " ".join(map(str, r.ids))) for r in got.collect()), key=key) == sorted(((r.doc_id, w[0]) for r, w in zip(rows, lib)), key=key)
    assert sorted(((r.doc_id, r.text) for r in pair_bpe.decode(got).collect()), key=key) == sorted(((r.doc_id, w[2]) for r, w in zip(rows, lib)), key=key)
    assert pair_bpe.digests(no_docs).count() == 0
