"""Brute-force versions that several tests share."""

import zlib

import numpy as np
from test_ngram_join import brute  # noqa: F401
from test_secret_scan import ASSIGN  # noqa: F401
from test_tokens import library_ids

from drivelake.llm import secret_scan


def library_text(text):
    """The text with secrets replaced."""
    spans = sorted((a, i, r.split("@")[0], b) for i, (r, f) in enumerate(secret_scan.RULES.items()) for a, b in f(text, text.lower()))
    out, at, n = [], 0, 0
    while n < len(spans):
        start, _, kind, end = spans[n]
        while n < len(spans) and spans[n][0] < end or n < len(spans) and spans[n][0] == start:
            end = max(end, spans[n][3])
            n += 1
        out += [text[at:start], f"[{kind}]"]
        at = end
    return "".join(out) + text[at:]


def check_packing(rows, texts, end=0, capacity=1024):
    ids = dict(zip(texts, library_ids(list(texts.values()), end)))
    docs, seqs = {}, {}
    for r in rows:
        docs.setdefault(r.doc_id, []).append((r.start, r.length))
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.doc_id][r.start: r.start + r.length] and zlib
    assert docs.keys() == ids.keys()
    for d, pieces in docs.items():
        assert sum(n for _, n in pieces) == len(ids[d])
    assert all(sum(n for _, n in p) & (sum(n for _, n in p) - 1) == 0 for p in seqs.values())
