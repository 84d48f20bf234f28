"""Token files: canonical length-limited Huffman codes of token ids, decoded in independent blocks.

Layout under the output folder (Parquet carries the records, so any store that
Spark writes to will do and a task's output appears only when it commits):

* ``code/``: (id, bits), the code length of every id in use, from counts over
  the whole corpus. Codes are canonical, so the lengths are all there is.
* ``parts/``: (part, tokens, docs), the totals of each part, in order of part.
* ``segments/``: (part, segment, payload), the documents in ascending order of
  doc_id. The payload, all little-endian: magic, number of documents, tokens
  before the segment in its part; per document its id, whether that is null,
  its number of tokens; then per block its bit offset (the checkpoint) and
  number of tokens; then the bits. A document begins a block on a whole byte;
  blocks hold ``BLOCK`` tokens or the rest, and each decodes by itself.

Rows: a null text is the empty text, which holds the end id alone. Null ids
come first. Rows with one id keep together, in order of their content. An
empty table gives empty tables.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from drivelake.llm.common import slices, texts_of, written
from drivelake.llm.tokens import encoder, vocabulary

#: Longest code, in bits, unless more are needed to tell all ids apart.
MAX_BITS = 16
#: Tokens from one checkpoint to the next, and tokens after which a segment ends.
BLOCK, SEGMENT = 512, 1 << 20
END_ID = 2
MAGIC = b"TKH1"


# ---- the code

def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths up to ``max_bits`` for positive counts, by package-merge."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.uint8)
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids need codes of more than {max_bits} bits")
    order = np.argsort(counts, kind="stable")
    leaves = counts[order].astype(np.float64)
    row, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(max_bits - 1):
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        at = np.argsort(both, kind="stable")
        row = both[at]
        is_leaf.append(at < n)
    lengths, take = np.zeros(n, np.uint8), 2 * n - 2
    for flags in reversed(is_leaf):  # the taken items of a row are its first; packages take pairs of the row below
        own = int(flags[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    out = np.empty(n, np.uint8)
    out[order] = lengths
    return out


class Code:
    """Canonical codes from (ids, bits): shorter codes first, then smaller ids."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray):
        order = np.lexsort((ids, bits))
        self.ids, self.bits = ids[order].astype(np.uint32), bits[order].astype(np.uint8)
        self.max = int(self.bits.max(initial=1))
        room = np.left_shift(np.uint64(1), (self.max - self.bits).astype(np.uint64))
        first = np.cumsum(room) - room
        size = int(self.ids.max(initial=0)) + 1
        self.code = np.zeros(size, np.uint64)
        self.length = np.zeros(size, np.uint8)
        self.code[self.ids] = first >> (self.max - self.bits).astype(np.uint64)
        self.length[self.ids] = self.bits
        self._room = room.astype(np.int64)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """By the next ``max`` bits: the id and its length."""
        fill = max(0, (1 << self.max) - int(self._room.sum()))
        return (np.append(np.repeat(self.ids, self._room), np.zeros(fill, np.uint32)),
                np.append(np.repeat(self.bits, self._room), np.ones(fill, np.uint8)))

    def encode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
        """Bits of documents that end at ``ends`` of ``ids``, each on a whole byte; bit offset of every id; bytes to the end of each document."""
        if not len(ids):
            return b"", np.zeros(0, np.int64), np.zeros(len(ends), np.int64)
        lens = self.length[ids].astype(np.int64)
        total = np.cumsum(lens)
        sums = np.append(0, total)[ends]
        size = (np.diff(sums, prepend=0) + 7) // 8
        stop = np.cumsum(size)
        starts = np.append(0, ends[:-1])
        shift = (stop - size) * 8 - np.append(0, total)[starts]
        at = total - lens + np.repeat(shift, ends - starts)
        word, low = at >> 6, 64 - (at & 63) - lens
        codes = self.code[ids]
        over = low < 0
        out = np.zeros((int(stop[-1]) + 7) // 8 + 1, np.uint64)
        head = np.where(over, codes >> np.where(over, -low, 0).astype(np.uint64), codes << np.where(over, 0, low).astype(np.uint64))
        first = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[first]] = np.add.reduceat(head, first)
        if over.any():  # at most one code runs over the end of a word
            out[word[over] + 1] += codes[over] << (64 + low[over]).astype(np.uint64)
        return out.astype(">u8").tobytes()[: int(stop[-1])], at, stop


# ---- encoding

def encoded(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(doc_id, n_tokens, ids): ids of the whole text and the end id, as little-endian integers of 2 or 4 bytes."""

    def run(batches):
        enc = encoder(path)
        end = np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            for part in slices(batch):
                ids = [x + end for x in enc.encode(part.column(1).to_pylist())]
                n = pa.array([len(x) // enc.dtype.itemsize for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), n, pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])

    return docs.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def token_counts(ids: DataFrame, dtype: str) -> DataFrame:
    """(id, n) over all rows of (ids); each task sums its own first."""

    def run(batches):
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for part in slices(batch, "ids"):
                own = np.bincount(np.frombuffer(b"".join(part.column(0).to_pylist()), dtype))
                if len(own) > len(counts):
                    own[: len(counts)] += counts
                    counts = own
                else:
                    counts[: len(own)] += own
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used], pa.int64())], ["id", "n"])

    return ids.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _cut(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows (part, doc_id, n_tokens, payload, bit offsets of blocks) in order -> segments (part, segment, payload)."""
    part, segment, before, held, tokens = None, 0, 0, [], 0

    def flush():
        docs = len(held)
        ids = np.array([0 if r[1] is None else r[1] for r in held], "<i8")
        null = np.array([r[1] is None for r in held], "u1")
        n = np.array([r[2] for r in held], "<i8")
        base = np.cumsum([0] + [len(r[3]) for r in held])[:-1] * 8
        marks = np.concatenate([np.frombuffer(r[4], "<i8") + b for r, b in zip(held, base)]).astype("<i8")
        blocks = np.concatenate([np.minimum(BLOCK, r[2] - np.arange(0, r[2], BLOCK)) for r in held]).astype("<i4")
        head = struct.pack("<4sqqq", MAGIC, docs, len(marks), before)
        return part, segment, b"".join([head, ids.tobytes(), null.tobytes(), n.tobytes(), marks.tobytes(), blocks.tobytes(), *[r[3] for r in held]])

    for row in rows:
        if held and (row[0] != part or tokens >= SEGMENT):
            yield flush()
            before, segment, held, tokens = before + tokens, segment + 1, [], 0
        if row[0] != part:
            part, segment, before = row[0], 0, 0
        held.append(row)
        tokens += row[2]
    if held:
        yield flush()


def write_corpus(spark: SparkSession, docs: DataFrame, out: str, *, tokenizer: str | None = None, end_id: int = END_ID,
                 max_bits: int = MAX_BITS, parts: int | None = None) -> None:
    """Encode documents (doc_id, text) and write the token files to ``out``, a folder that all executors share.

    The driver takes one count per id of the vocabulary and the bounds of the parts
    (``parts``, by default four for each shuffle partition); nothing else.
    """
    tokenizer = tokenizer or vocabulary()
    enc = written(encoded(texts_of(docs), tokenizer, end_id), spark, "token-ids")
    dtype = encoder(tokenizer).dtype.str
    rows = token_counts(enc, dtype).orderBy("id").collect()
    ids, counts = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
    bits = code_lengths(counts, max(max_bits, int(max(len(ids), 1) - 1).bit_length()))
    spark.createDataFrame([(int(i), int(b)) for i, b in zip(ids, bits)], "id long, bits int").coalesce(1).write.parquet(f"{out}/code")

    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = [i / parts for i in range(1, parts)]
    found = enc.select(F.percentile_approx("doc_id", F.array(*map(F.lit, share)), 100 * parts).alias("b")).first()[0] if share else []
    bounds = np.array(found or [], np.int64)
    held = spark.sparkContext.broadcast((ids, bits, bounds))  # one vocabulary, one list of parts

    def run(batches):
        own_ids, own_bits, own_bounds = held.value
        code = Code(own_ids, own_bits)
        for batch in batches:
            for part in slices(batch, "ids"):
                keys, n = part.column(0).to_pylist(), np.array(part.column(1).to_pylist(), np.int64)
                raw = part.column(2).to_pylist()
                all_ids = np.frombuffer(b"".join(raw), dtype)
                ends = np.cumsum(n)
                data, at, stop = code.encode(all_ids, ends)
                begin = ends - n
                key = np.array([np.iinfo(np.int64).min if k is None else k for k in keys], np.int64)
                low, high = np.searchsorted(own_bounds, key, "left"), np.searchsorted(own_bounds, key, "right")
                out_rows = {k: [] for k in ("part", "tie", "payload", "marks")}
                for i in range(len(n)):  # an id that fills several parts is dealt over them by content
                    b = data[stop[i - 1] if i else 0: stop[i]]
                    tie = zlib.crc32(b)
                    out_rows["part"].append(int(low[i] + (tie + i) % (high[i] - low[i] + 1)) if high[i] > low[i] else int(low[i]))
                    out_rows["tie"].append(tie)
                    out_rows["payload"].append(b)
                    out_rows["marks"].append((at[begin[i]: ends[i]: BLOCK] - 8 * (int(stop[i - 1]) if i else 0)).astype("<i8").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out_rows["part"], pa.int32()), part.column(0), pa.array(out_rows["tie"], pa.int64()), part.column(1),
                     pa.array(out_rows["payload"], pa.binary()), pa.array(out_rows["marks"], pa.binary())],
                    ["part", "doc_id", "tie", "n_tokens", "payload", "marks"])

    def cut(batches):
        rows = (r for b in batches for r in zip(*(b.column(i).to_pylist() for i in (0, 1, 3, 4, 5))))
        for part, segment, payload in _cut(rows):
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([payload], pa.binary())],
                                             ["part", "segment", "payload"])

    coded = enc.mapInArrow(run, "part int, doc_id long, tie long, n_tokens long, payload binary, marks binary")
    dealt = coded.repartition("part").sortWithinPartitions("part", "doc_id", "tie")
    dealt.mapInArrow(cut, "part int, segment int, payload binary").write.option("compression", "none").parquet(f"{out}/segments")
    _totals(spark, out).write.parquet(f"{out}/parts")


def _segments(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema("part int, segment int, payload binary").parquet(f"{out}/segments")


def _totals(spark: SparkSession, out: str) -> DataFrame:
    """(part, tokens, docs) of each part, from the heads of its segments."""

    def run(batches):
        for batch in batches:
            n, d = [], []
            for p in batch.column(1).to_pylist():
                docs = struct.unpack_from("<4sqqq", p)[1]
                d.append(docs)
                n.append(int(np.frombuffer(p, "<i8", docs, 28 + 9 * docs).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(d, pa.int64())], ["part", "tokens", "docs"])

    heads = _segments(spark, out).select("part", "payload").mapInArrow(run, "part int, tokens long, docs long")
    return heads.groupBy("part").agg(F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs"))


# ---- decoding

def decode_segment(payload: bytes, max_bits: int, ids: np.ndarray, bits: np.ndarray):
    """(doc ids, their tokens before them in the part, numbers of tokens, all ids) of one segment."""
    magic, docs, blocks, before = struct.unpack_from("<4sqqq", payload)
    if magic != MAGIC:
        raise ValueError("not a segment of a token file")
    at = 28
    keys = np.frombuffer(payload, "<i8", docs, at)
    null = np.frombuffer(payload, "u1", docs, at + 8 * docs)
    n = np.frombuffer(payload, "<i8", docs, at + 9 * docs)
    marks = np.frombuffer(payload, "<i8", blocks, at + 17 * docs)
    held = np.frombuffer(payload, "<i4", blocks, at + 17 * docs + 8 * blocks).astype(np.int64)
    data = np.append(np.frombuffer(payload, np.uint8, -1, at + 17 * docs + 12 * blocks), np.zeros(4, np.uint8)).astype(np.uint32)
    window = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
    order = np.argsort(-held, kind="stable")  # longest first: those still open stay in front
    pos, goal, left = marks[order].astype(np.int64), (np.cumsum(held) - held)[order], held[order]
    out = np.empty(int(held.sum()), np.uint32)
    for step in range(int(held.max(initial=0))):
        live = int(np.searchsorted(-left, -step, "left"))
        p = pos[:live]
        code = (window[p >> 3] >> (32 - max_bits - (p & 7)).astype(np.uint32)) & np.uint32((1 << max_bits) - 1)
        out[goal[:live] + step] = ids[code]
        p += bits[code]
    return [None if z else int(k) for k, z in zip(keys, null)], before + np.cumsum(n) - n, n, out


def read_corpus(spark: SparkSession, out: str, *, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary of 4 bytes each) from the files; with ``digest`` ids_crc32 in place of the ids.

    start counts the ids of all documents before it. Each segment decodes by itself;
    the sums over parts are one row per part.
    """
    rows = spark.read.schema("id long, bits int").parquet(f"{out}/code").collect()  # one row per id of the vocabulary
    held = spark.sparkContext.broadcast((np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.uint8)))

    def run(batches):
        code = Code(*held.value)
        ids_of, bits_of = code.tables()
        for batch in batches:
            for part, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys, start, n, ids = decode_segment(payload.as_py(), code.max, ids_of, bits_of)
                raw, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(n) * 4
                cut = [raw[e - 4 * k: e] for e, k in zip(ends.tolist(), n.tolist())]
                last = pa.array([zlib.crc32(c) for c in cut], pa.int64()) if digest else pa.array([bytes(c) for c in cut], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(keys), pa.int32()), pa.array(keys, pa.int64()), pa.array(start, pa.int64()),
                                                  pa.array(n, pa.int64()), last], ["part", "doc_id", "start", "n_tokens", "value"])

    value = "ids_crc32 long" if digest else "ids binary"
    docs = _segments(spark, out).select("part", "payload").mapInArrow(run, f"part int, doc_id long, start long, n_tokens long, {value.replace('ids_crc32', 'value').replace('ids', 'value')}")
    parts = spark.read.schema("part int, tokens long, docs long").parquet(f"{out}/parts")
    base = parts.select("part", (F.sum("tokens").over(W.orderBy("part")) - F.col("tokens")).alias("base"))
    return docs.join(base, "part").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens",
                                          F.col("value").alias(value.split()[0]))
