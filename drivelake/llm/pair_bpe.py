"""BPE encoding with a pair occurrence index, and decoding.

The words that a partition's rows bring in are laid out in one linked array of
symbols. An index maps each pair that has a merge to all its positions there;
the ranks with positions are taken in ascending order, each merges all its
positions at once, and the pairs that arise beside them are entered in the
index. A word is encoded once per worker while its memo holds it.

The vocabulary file is the tokenizers library's, which also cuts words of
characters beyond Latin: NFC, white space to spaces,
lower case, the words of its pattern, bytes under their visible names, and a
mark on the last symbol of a word. Special tokens in a text stand for their
ids. decode(ids) joins the tokens by a space, as the file names no decoder.

Rows: null and empty texts have no ids and decode to the empty text; a null
doc_id stays null; repeated rows give repeated results. An empty table gives none.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from drivelake.llm.common import slices, texts_of
from drivelake.llm.tokens import _byte_names, vocabulary

#: White-space pieces and words that a worker keeps.
MEMO = 800_000
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_CHUNK = regex.compile(f"[^{_SPACE}]+")
#: Characters that Python's split() takes for white space and Unicode does not.
_SEPARATORS = regex.compile("[\\x1c-\\x1f]")


#: The words of the vocabulary's pre-tokenizer, and the first character after the Latin blocks.
_WORD = regex.compile(f"'s|'t|'re|'ve|'m|'ll|'d|\\p{{L}}+|\\p{{N}}|[^{_SPACE}\\p{{L}}\\p{{N}}]+")
_LATIN_END = "\u0250"
#: Stands for a byte that the vocabulary has no symbol for.
_NONE = -3
#: The same for words of ASCII characters, and what ends a piece in a text of a piece a line.
_PLAIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|\n|[^a-z0-9\t-\r ]+")


class PairIndex:
    """Merges of a vocabulary, applied to many words together."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.vocab = vocab
        self.size = max(vocab.values(), default=0) + 2  # no symbol is size - 1, so a pair with -1 is no pair
        self.rank: dict[int, int] = {}  # by left * size + right
        self.rule: list[tuple[int, int, int]] = []
        for r, (a, b) in enumerate(merges):
            self.rule.append((vocab[a], vocab[b], vocab[a + b]))
            self.rank.setdefault(vocab[a] * self.size + vocab[b], r)
        order = sorted(self.rank)
        self.pairs, self.ranks = np.array([*order, 1 << 62], np.int64), np.array([*(self.rank[p] for p in order), 0], np.int64)

    def _positions(self, sym: np.ndarray) -> dict[int, list[int]]:
        """The index: by rank of a pair, all its positions in ascending order."""
        pair = sym[:-1] * self.size + sym[1:]
        at = np.searchsorted(self.pairs, pair)
        spots = np.flatnonzero(self.pairs[at] == pair)
        rank = self.ranks[at[spots]]
        order = np.argsort(rank, kind="stable")
        rank, spots = rank[order], spots[order]
        first = np.flatnonzero(np.diff(rank, prepend=-1))
        return {r: p.tolist() for r, p in zip(rank[first].tolist(), np.split(spots, first[1:]))} if len(first) else {}

    def merged(self, symbols: np.ndarray) -> np.ndarray:
        """Symbols after all merges; every word ends with -1."""
        if not len(symbols):
            return symbols
        rule, size, get, where = self.rule, self.size, self.rank.get, self._positions(symbols)
        sym = symbols.tolist()
        after = list(range(1, len(sym) + 1))
        before = list(range(-1, len(sym) - 1))
        active = list(where)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            left, right, joined = rule[r]
            spots = where.pop(r)
            if left == right:
                spots.sort()
            for i in spots:
                if sym[i] != left:
                    continue
                j = after[i]
                if sym[j] != right:
                    continue
                k = after[j]
                p = before[i]  # -1 for the first: the last symbol, which ends a word
                sym[i], sym[j], after[i], before[k] = joined, -2, k, i
                n = get(sym[p] * size + joined)
                if n is not None:
                    if n in where:
                        where[n].append(p)
                    else:
                        where[n] = [p]
                        heapq.heappush(active, n)
                n = get(joined * size + sym[k])
                if n is not None:
                    if n in where:
                        where[n].append(i)
                    else:
                        where[n] = [i]
                        heapq.heappush(active, n)
        out = np.array(sym, np.int64)
        return out[out != -2]

    def encode(self, words: list[list[str]]) -> list[list[int]]:
        """Ids of each word, given as its first symbols; symbols without an id are left out."""
        sym = [i for word in words for i in (*(self.vocab[c] for c in word if c in self.vocab), -1)]
        out: list[list[int]] = [[]]
        for i in self.merged(np.array(sym, np.int64)).tolist():
            if i < 0:
                out.append([])
            else:
                out[-1].append(i)
        return out[:-1]


class WordBpe:
    """A vocabulary file with its memo of words and of white-space pieces, each as (decimal ids, number of ids, decoded)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        self.index = PairIndex(vocab, [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in [*vocab.items(), *self.special.items()]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.lib = Tokenizer.from_file(path)
        names, end = {b: c for c, b in _byte_names().items()}, model.get("end_of_word_suffix") or ""
        self.byte = {c: b for b, c in names.items()}
        self.inner = np.array([vocab.get(names[b], _NONE) for b in range(256)], np.int64)
        self.last = np.array([vocab.get(names[b] + end, _NONE) for b in range(256)], np.int64)
        texts = [self.token.get(i, "") for i in range(self.index.size)]
        self.decimal, self.text = [*map(str, range(self.index.size)), "\n"], [*texts, "\n"]  # -1 is the end of a word
        self.words: dict[str, tuple[str, int, str]] = {}
        self.chunks: dict[str, tuple[str, int, str]] = {}

    def _words(self, chunk: str) -> list[str | int]:
        """Words of a piece without white space, and the ids of its special tokens."""
        out: list[str | int] = []
        for part in self.cut.split(chunk) if self.cut else [chunk]:
            if part in self.special:
                out.append(self.special[part])
            elif max(part, default="") < _LATIN_END:
                out += _WORD.findall(unicodedata.normalize("NFC", part).lower())
            elif part:  # which of these are letters depends on the version of Unicode, so the library cuts them
                out += ["\uffff" + w for w, _ in self.lib.pre_tokenizer.pre_tokenize_str(self.lib.normalizer.normalize_str(part))]
        return out

    def _cut(self, chunks: list[str]) -> list[tuple[str, list[str | int]]]:
        """The words of many pieces; those of ASCII characters in one go."""
        joined = "\n".join(chunks)
        some_special = any(t in joined for t in self.special)
        plain = [] if some_special else [c for c in chunks if c.isascii()]
        out, own = [], []
        for w in _PLAIN.findall("".join([f"{c}\n" for c in plain]).lower()):
            if w == "\n":
                out.append(own)
                own = []
            else:
                own.append(w)
        rest = chunks if some_special else [c for c in chunks if not c.isascii()]
        return [*zip(plain, out), *((c, self._words(c)) for c in rest)]

    def _learn_words(self, words: list[str]) -> None:
        """All words through one pair index."""
        raw = [bytes(map(self.byte.__getitem__, w[1:])) if w[0] == "\uffff" else w.encode() for w in words]
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([len(w) for w in raw])
        sym = self.inner[data]
        sym[ends - 1] = self.last[data[ends - 1]]
        sym = np.insert(sym, ends, -1)
        found = self.index.merged(sym[sym != _NONE]).tolist()
        ids, texts = (" ".join([names[i] for i in found]).split("\n") for names in (self.decimal, self.text))
        ids, texts = [x.strip(" ") for x in ids], [x.strip(" ") for x in texts]
        self.words.update(zip(words, zip(ids, [x.count(" ") + 1 if x else 0 for x in ids], texts)))

    def learn(self, chunks: set[str]) -> None:
        """Enter new pieces in the memo; what is in use stays when it is full."""
        new = list(chunks - self.chunks.keys())
        if len(self.chunks) + len(new) > MEMO:
            held = {c: self.chunks[c] for c in chunks if c in self.chunks}
            self.chunks.clear()
            self.chunks.update(held)
        if len(self.words) > MEMO:
            self.words.clear()
        cut = self._cut(new)
        todo = list({w for _, ws in cut for w in ws if isinstance(w, str)} - self.words.keys())
        if todo:
            self._learn_words(todo)
        for c, ws in cut:
            if len(ws) == 1 and isinstance(ws[0], str):
                self.chunks[c] = self.words[ws[0]]
            else:
                found = [x for x in ((str(w), 1, self.token[w]) if isinstance(w, int) else self.words[w] for w in ws) if x[1]]
                self.chunks[c] = (" ".join([x[0] for x in found]), sum([x[1] for x in found]), " ".join([x[2] for x in found]))

    def decode(self, ids) -> str:
        return " ".join([self.token[i] for i in ids if i in self.token])

    @staticmethod
    def pieces(text: str) -> list[str]:
        return _CHUNK.findall(text) if _SEPARATORS.search(text) else text.split()

    def encode(self, texts: list[str]) -> list[tuple[str, int, str]]:
        """(decimal ids joined by spaces, number of ids, decoded text) of each text."""
        cut = [self.pieces(t) for t in texts]
        self.learn(set().union(*cut))
        out = []
        for pieces in cut:
            found = list(map(self.chunks.__getitem__, pieces))
            ids, counts, texts = zip(*found) if found else ((), (), ())
            if 0 in counts:
                ids, texts = [x for x in ids if x], [t for t, n in zip(texts, counts) if n]
            out.append((" ".join(ids), sum(counts), " ".join(texts)))
        return out


_LOADED: dict[str, WordBpe] = {}


def loaded(path: str) -> WordBpe:
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def encode(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>)."""
    path = tokenizer or vocabulary("word_bpe_49k.json")

    def run(batches):
        bpe = loaded(path)
        for batch in batches:
            for part in slices(batch):
                ids = [list(map(int, x[0].split())) for x in bpe.encode(part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return texts_of(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null ids decode to the empty text."""
    path = tokenizer or vocabulary("word_bpe_49k.json")

    def run(batches):
        bpe = loaded(path)
        for batch in batches:
            texts = [bpe.decode(x or ()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoding and decoding in one pass over the texts."""
    path = tokenizer or vocabulary("word_bpe_49k.json")

    def run(batches):
        bpe = loaded(path)
        for batch in batches:
            for part in slices(batch):
                got = bpe.encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([n for _, n, _ in got], pa.int64()), pa.array([hashlib.sha256(i.encode()).hexdigest() for i, _, _ in got]),
                     pa.array([hashlib.sha256(d.encode()).hexdigest() for _, _, d in got])], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return texts_of(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
