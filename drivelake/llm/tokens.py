"""Encoding with the tokenizers library, with a memo of pieces.

A text is cut where white space follows other characters; a byte-level
pre-tokenizer never joins characters over such a place, so the pieces encode
independently. Each worker keeps the ids of the pieces it has met (``MEMO``
at most, then only those of the texts at hand), so that a frequent piece is
encoded once.

New pieces of Latin characters are encoded together, with a mark after each, by
tiktoken's core over the ranks of the same vocabulary file, which is several
times as fast on single words; pieces with other characters, with white space at
an end or with a special token go to the tokenizers library itself. Where the
file is no byte-level BPE with ids in order of its
merges, all pieces do. Tests hold both ways against the library.
"""

from __future__ import annotations

import json
import re
from array import array
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces that a worker keeps.
MEMO = 800_000
#: New pieces that are encoded as parts of one text.
TOGETHER = 20_000
#: White space that ends a piece there, a piece that begins with white space, and a piece that may be such a part.
_MARK = "\x0b"
_ODD_START = re.compile(r"\x0b(?:\s|$)")
_WORDS = re.compile(r"[^\s](?:[^\x0b]*[^\s])?")
#: Texts that are empty, begin or end with white space, or have white space before a space (in the syntax of Arrow's patterns).
_ANY = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_SPACES = rf"\A\z|\A{_ANY}|{_ANY} |{_ANY}\z"
_PIECES = re.compile(r"\s*\S+|\s+")
_LOADED: dict[str, "Encoder"] = {}


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


#: The pattern of byte-level pre-tokenizers, and the first character after the Latin blocks.
_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LATIN_END = "\u0250"


def _byte_names() -> dict[str, int]:
    """Byte-level vocabularies name a byte by its own character if that is visible, else by the next one from 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}}


def _core(path: str):
    """tiktoken's encoder over the ranks of this vocabulary; None if it doesn't describe such ranks."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    if model.get("type") != "BPE" or not plain or spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex"):
        return None
    merged = [model["vocab"].get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    names = _byte_names()
    if None in merged or merged != sorted(set(merged)) or len(merged) + 256 != len(model["vocab"]) or not names.keys() <= model["vocab"].keys():
        return None
    import tiktoken
    ranks = {bytes(map(names.__getitem__, t)): i for t, i in model["vocab"].items()}
    core = tiktoken.Encoding("of-file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: core.encode_to_numpy(text, disallowed_special=())


class Encoder:
    """ids of whole texts as the library gives them with add_special_tokens=False, as little-endian bytes."""

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        top = max(self.tok.get_vocab(with_added_tokens=True).values(), default=0)
        self.dtype, self.code = (np.dtype("<u2"), "H") if top < 65_536 else (np.dtype("<u4"), "I")
        self.fast = _core(path)
        self.mark = self.fast(_MARK)[0] if self.fast else None
        self.added = tuple(t.content for t in self.tok.get_added_tokens_decoder().values())
        self.inner: dict[str, bytes] = {}  # pieces after a single space, without it
        self.plain: dict[str, bytes] = {}  # any other piece

    def _found(self, memo: dict[str, bytes], pieces: list[str], lead: str) -> list[bytes]:
        """The ids of distinct pieces, from the memo or learnt."""
        found = list(map(memo.get, pieces))
        new = [p for p, x in zip(pieces, found) if x is None]
        if not new:
            return found
        if len(memo) + len(new) > MEMO:  # what these texts use stays
            memo.clear()
            memo.update((p, x) for p, x in zip(pieces, found) if x is not None)
        self._learn(memo, new, lead)
        return [memo[p] if x is None else x for p, x in zip(pieces, found)]

    def _learn(self, memo: dict[str, bytes], new: list[str], lead: str) -> None:
        if self.fast:
            joined = _MARK + _MARK.join(new)
            if _ODD_START.search(joined) or joined.count(_MARK) > len(new) or any(t in joined for t in self.added):  # not only words
                plain = [bool(_WORDS.fullmatch(p)) and not any(t in p for t in self.added) for p in new]
            else:
                plain = [True] * len(new)
            latin = [ok and (p.isascii() or max(p) < _LATIN_END) for p, ok in zip(new, plain)]
            self._learn_latin(memo, list(compress(new, latin)), lead)
            new = [p for p, ok in zip(new, latin) if not ok]
        for p, e in zip(new, self.tok.encode_batch_fast([lead + p for p in new], add_special_tokens=False)):
            memo[p] = array(self.code, e.ids).tobytes()

    def _learn_latin(self, memo: dict[str, bytes], new: list[str], lead: str) -> None:
        """Pieces that begin and end with other than white space, in one text with a mark after each: nothing joins over a mark, whose id no piece holds."""
        for at in range(0, len(new), TOGETHER):
            own = new[at: at + TOGETHER]
            ids = self.fast("".join([f"{lead}{p}{_MARK}" for p in own])).astype(self.dtype)
            ends = np.flatnonzero(ids == self.mark)
            raw, size = ids.tobytes(), self.dtype.itemsize
            stop = (ends * size).tolist()
            memo.update(zip(own, [raw[a:b] for a, b in zip([0, *(e + size for e in stop)], stop)]))

    def _ragged(self, values: list[bytes], which: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The values with these numbers, one after the other, and the end of each in bytes."""
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // self.dtype.itemsize
        ids, starts, n = np.frombuffer(b"".join(values), self.dtype), np.cumsum(sizes) - sizes, sizes[which]
        ends = np.cumsum(n)
        spots = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts[which] - (ends - n), n)
        return ids[spots].tobytes(), ends * self.dtype.itemsize

    def _encode_words(self, texts: list[str]) -> list[bytes]:
        """Texts whose pieces are what stands between single spaces: each distinct piece of all of them is looked up once."""
        parts = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        bounds, pieces = parts.offsets.to_numpy(), parts.flatten().dictionary_encode()
        which, distinct = pieces.indices.to_numpy().astype(np.int64), pieces.dictionary.to_pylist()
        values = self._found(self.inner, distinct, " ")
        first, own = np.unique(which[bounds[:-1]], return_inverse=True)  # the first piece of a text has no space before it
        heads = self._found(self.plain, [distinct[i] for i in first.tolist()], "")
        which[bounds[:-1]] = len(values) + own
        raw, ends = self._ragged(values + heads, which)
        stop = ends[bounds[1:] - 1].tolist()
        return [raw[a:b] for a, b in zip([0, *stop], stop)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """One byte string of ids per text."""
        odd = pc.match_substring_regex(pa.array(texts, pa.large_string()), _SPACES).to_pylist()
        words = [t for t, x in zip(texts, odd) if not x]
        words = iter(self._encode_words(words) if words else ())
        cut = [_PIECES.findall(t) for t, x in zip(texts, odd) if x]
        distinct = list(set().union(*cut))
        ids = dict(zip(distinct, self._found(self.plain, distinct, "")))
        rest = (b"".join(map(ids.__getitem__, pieces)) for pieces in cut)
        return [next(rest) if x else next(words) for x in odd]


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file, loaded once."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]
