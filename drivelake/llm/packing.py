"""Packing documents into training sequences: first-fit decreasing in random groups.

Each document is cut into whole sequences and a tail. The tails of a group are
placed longest first, each into the first bin with room, found in a tournament
tree of the bins' free capacities. What gaps remain are filled by cutting the
pieces of the emptiest bins, and the last bin, which nothing can fill, is cut
into lengths that are powers of two, since sequences of such lengths are not
padded. So no sequence is padded, and few documents are cut beyond their tails.

Groups are random and hold about ``GROUP_CHARS`` characters of text, or one
longer document; each is packed by itself. A row's group depends neither on its
id nor on its content, so copies and repeated ids spread evenly.

Rows: a null text is the empty text, which holds the end id alone; a null
doc_id stays null; repeated rows are packed each by itself (their pieces are
then told apart by sequence_id and offset only). An empty table gives no pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drivelake.llm.common import texts_of
from drivelake.llm.token_file import encoded
from drivelake.llm.tokens import encoder, vocabulary

CAPACITY = 1024
GROUP_CHARS = 2_000_000
SEED = 9


class Tournament:
    """Free capacity of bins 0..n-1; the first bin with enough is found by descending from the root."""

    def __init__(self, bins: int, capacity: int):
        self.size = 1 << max(0, bins - 1).bit_length()
        self.best = [capacity] * (2 * self.size)

    def place(self, length: int) -> int:
        """Take ``length`` from the first bin that has it; the bin's number."""
        best, at = self.best, 1
        while at < self.size:
            at *= 2
            if best[at] < length:
                at += 1
        best[at] -= length
        found = at - self.size
        while at > 1:
            at //= 2
            best[at] = max(best[2 * at], best[2 * at + 1])
        return found


def pack_lengths(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) for documents of these lengths; no sequence needs padding."""
    sequences: list[list[tuple[int, int, int]]] = []
    tails = []
    for doc, n in enumerate(lengths):
        whole = n // capacity * capacity
        sequences += [[(doc, at, capacity)] for at in range(0, whole, capacity)]
        if n > whole:
            tails.append((n - whole, doc, whole))
    tails.sort(key=lambda t: (-t[0], t[1]))
    tree, bins = Tournament(len(tails), capacity), []
    for n, doc, start in tails:
        at = tree.place(n)
        if at == len(bins):
            bins.append([])
        bins[at].append((doc, start, n))
    fill = [(sum(p[2] for p in b), b) for b in bins]
    sequences += [b for n, b in fill if n == capacity]
    open_bins = sorted((x for x in fill if x[0] < capacity), key=lambda x: -x[0])
    front, back = 0, len(open_bins) - 1
    while front < back:  # fill the fullest from the emptiest
        n, target = open_bins[front]
        m, source = open_bins[back]
        doc, start, length = source.pop()
        moved = min(capacity - n, length)
        target.append((doc, start + length - moved, moved))
        if moved < length:
            source.append((doc, start, length - moved))
        open_bins[front], open_bins[back] = (n + moved, target), (m - moved, source)
        if n + moved == capacity:
            sequences.append(target)
            front += 1
        if m == moved:
            back -= 1
    if front == back:
        rest, source = open_bins[front]
        for bit in reversed(range(rest.bit_length())):
            room = rest & 1 << bit
            taken = []
            while room:
                doc, start, length = source.pop(0)
                n = min(room, length)
                taken.append((doc, start, n))
                if n < length:
                    source.insert(0, (doc, start + n, length - n))
                room -= n
            if taken:
                sequences.append(taken)
    out = []
    for number, pieces in enumerate(sequences):
        at = 0
        for doc, start, n in pieces:
            out.append((doc, start, n, number, at))
            at += n
    return out


def pack(docs: DataFrame, *, tokenizer: str | None = None, end_id: int = 0, capacity: int = CAPACITY,
         group_chars: int = GROUP_CHARS, digest: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary, 4 bytes each), doc_tokens, sequence_id, offset.

    With ``digest`` ids_crc32 stands in place of the ids. sequence_id is unique over all groups.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    tokenizer = tokenizer or vocabulary()
    texts = texts_of(docs)
    chars = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-chars // group_chars))
    width = encoder(tokenizer).dtype

    def run(table: pa.Table) -> pa.Table:
        group = table.column("grp")[0].as_py()
        raw = table.column("ids").combine_chunks()
        doc_ids, n = table.column("doc_id").to_pylist(), table.column("n_tokens").to_pylist()
        pieces = pack_lengths(n, capacity)
        ids = {}
        last = []
        for doc, start, length, _, _ in pieces:
            if doc not in ids:
                ids[doc] = memoryview(np.frombuffer(raw[doc].as_buffer(), width).astype("<u4").tobytes())
            piece = ids[doc][4 * start: 4 * (start + length)]
            last.append(zlib.crc32(piece) if digest else bytes(piece))
        cols = list(zip(*pieces))
        return pa.table({
            "doc_id": pa.array([doc_ids[i] for i in cols[0]], pa.int64()), "start": pa.array(cols[1], pa.int64()), "length": pa.array(cols[2], pa.int64()),
            value: pa.array(last, pa.int64() if digest else pa.binary()), "doc_tokens": pa.array([n[i] for i in cols[0]], pa.int64()),
            "sequence_id": pa.array([(group << 32) + s for s in cols[3]], pa.int64()), "offset": pa.array(cols[4], pa.int64())})

    value = "ids_crc32" if digest else "ids"
    rows = encoded(texts, tokenizer, end_id).withColumn("grp", F.floor(F.rand(SEED) * groups).cast("long"))
    return rows.groupBy("grp").applyInArrow(run, f"doc_id long, start long, length long, {value} {'long' if digest else 'binary'}, "
                                                 "doc_tokens long, sequence_id long, offset long")
