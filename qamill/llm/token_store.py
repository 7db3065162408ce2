"""Token ids in binary files, by an adaptive context-mixing range coder.

File: the ids of some documents in ascending doc_id order, each with the end
id, as one stream cut into blocks of BLOCK ids.  Every block is coded from a
fresh model, so it can be decoded alone, and has a CRC-32 of its ids.

    magic 8 bytes | u32 partition, u32 number in it, u32 documents, u32 blocks, u64 ids
    per document: i64 doc_id (arrays follow one another), u8 is-null, u64 ids with the end id
    per block: u32 ids, u32 words of code, u32 crc32
    the blocks' code, 32-bit words

Model of an id, from the ids before it in its block: the id that last followed
the two ids before (order 2), the id that last followed the one before (order
1), and order 0: counts of id // 256, and the id last seen of each such group.
How far each order's guess is trusted is learned for each pair of confidences
of orders 2 and 1: three-way counts mix hit of order 2, hit of order 1 and
escape to order 0.  The choice and, after an escape, the order-0 symbol drive
a 64-bit range coder with carry.

Blocks of a file are coded in step, with numpy: place t of all blocks at once.

Cases: null or empty text: the end id alone.  Null doc_id: sorted first, kept
null.  Repeated rows: each is stored.  Empty table: no rows, no files.
"""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qamill.llm.files import read_files, write_files
from qamill.llm.tables import staged
from qamill.session import scratch_dir, ship_package

MAGIC = b"IDRANGE1"
BLOCK = 2048
#: Ids of one file, about (a longer document is not split).
FILE_IDS = 8 << 20
END_ID = 1
#: Words kept with their ids in a worker; the table starts anew beyond it.
KNOWN_WORDS = 1_000_000
VOCABULARY = "word_bpe_49k.json"

_U64, _I64 = np.uint64, np.int64
_ORDER1, _ORDER2 = 1024, 2048
_GROUPS = 256
_REFRESH = 64
_HALVE = 400
_LOW32 = _U64((1 << 32) - 1)


class _Model:
    """State of all lanes (blocks); the first ``a`` lanes are worked on."""

    def __init__(self, lanes: int):
        self.lane = np.arange(lanes, dtype=_I64)
        # An id and how sure it is (0 to 3), as id * 4 + sure.
        self.one = np.zeros(lanes * _ORDER1, np.uint32)
        self.two = np.zeros(lanes * _ORDER2, np.uint32)
        self.choice = np.tile(np.array([2, 2, 3, 0], np.int32), lanes * 32)
        self.count = np.tile(1 + (64 // (1 + np.arange(_GROUPS))).astype(np.int32), (lanes, 1))
        self.last = np.zeros(lanes * _GROUPS, np.uint8)
        self.right = np.ones(lanes, _I64)
        self.wrong = np.full(lanes, 2, _I64)
        self.before = np.zeros(lanes, _I64)
        self.before2 = np.zeros(lanes, _I64)
        self.step = 0

    def guess(self, a: int):
        if self.step % _REFRESH == 0:
            self.below = np.zeros((len(self.lane), _GROUPS + 1), np.int32)
            np.cumsum(self.count, axis=1, out=self.below[:, 1:])
            self.below_flat = self.below.reshape(-1)
        self.step += 1
        lane, x, y = self.lane[:a], self.before[:a], self.before2[:a]
        self.at1 = lane * _ORDER1 + ((x * 40503 >> 4) & (_ORDER1 - 1))
        self.at2 = lane * _ORDER2 + (((x * 40503 + y * 30011) >> 5) & (_ORDER2 - 1))
        self.one_was, self.two_was = self.one[self.at1], self.two[self.at2]
        self.id1, self.id2 = self.one_was >> np.uint32(2), self.two_was >> np.uint32(2)
        sure = ((self.two_was & np.uint32(3)) << np.uint32(2)) | (self.one_was & np.uint32(3)) | ((self.id1 == self.id2).view(np.uint8) << np.uint8(4))
        self.ctx = (lane * 32 + sure) * 4
        n0, n1 = self.choice[self.ctx], self.choice[self.ctx + 1]
        self.n0, self.n01 = n0.astype(_I64), (n0 + n1).astype(_I64)
        self.n012 = self.n01 + self.choice[self.ctx + 2]

    def learn(self, a: int, ids: np.ndarray, outcome: np.ndarray, group: np.ndarray):
        at = self.ctx + outcome
        self.choice[at] += 2
        full = np.flatnonzero(self.n012 > _HALVE)
        for k in range(3) if len(full) else ():
            self.choice[self.ctx[full] + k] = (self.choice[self.ctx[full] + k] + 1) >> 1
        new = ids.astype(np.uint32) << np.uint32(2)
        for table, at, was, guess in ((self.one, self.at1, self.one_was, self.id1), (self.two, self.at2, self.two_was, self.id2)):
            table[at] = np.where(guess == ids, new | np.minimum((was & np.uint32(3)) + np.uint32(1), np.uint32(3)), new)
        spot = self.lane[:a] * _GROUPS + group
        self.count.reshape(-1)[spot] += 2
        self.last[spot] = ids & 255
        self.before2[:a] = self.before[:a]
        self.before[:a] = ids


class _Writer:
    def __init__(self, lanes: int, longest: int):
        self.low = np.zeros(lanes, _U64)
        self.range = np.full(lanes, (1 << 64) - 1, _U64)
        self.words = np.zeros((lanes, longest * 37 // 32 + 4), np.uint32)
        self.n = np.zeros(lanes, _I64)

    def put(self, lanes, start, size, total):
        """lanes: slice or index array; symbol's interval [start, start + size) of total."""
        r = self.range[lanes] // total.astype(_U64)
        low = self.low[lanes]
        new = low + r * start.astype(_U64)
        over = new < low
        r *= size.astype(_U64)
        if over.any():
            at = (np.arange(len(self.low))[lanes] if isinstance(lanes, slice) else lanes)[over]
            k = self.n[at] - 1
            while len(at):
                self.words[at, k] += np.uint32(1)
                go = self.words[at, k] == 0
                at, k = at[go], k[go] - 1
        short = r <= _LOW32
        if short.any():
            s = np.flatnonzero(short)
            at = s if isinstance(lanes, slice) else lanes[s]
            self.words[at, self.n[at]] = (new[s] >> _U64(32)).astype(np.uint32)
            self.n[at] += 1
            new[s] <<= _U64(32)
            r[s] <<= _U64(32)
        self.low[lanes], self.range[lanes] = new, r

    def finish(self):
        at = np.arange(len(self.low))
        for shift in (32, 0):
            self.words[at, self.n] = (self.low >> _U64(shift) & _LOW32).astype(np.uint32)
            self.n += 1


class _Reader:
    def __init__(self, words: np.ndarray, first: np.ndarray):
        self.words = words
        self.next = first.astype(_I64) + 2
        self.code = words[first].astype(_U64) << _U64(32) | words[first + 1].astype(_U64)
        self.range = np.full(len(first), (1 << 64) - 1, _U64)

    def look(self, lanes, total):
        self.unit = self.range[lanes] // total.astype(_U64)
        return np.minimum((self.code[lanes] // self.unit).astype(_I64), total - 1)

    def take(self, lanes, start, size):
        code = self.code[lanes] - self.unit * start.astype(_U64)
        r = self.unit * size.astype(_U64)
        short = np.flatnonzero(r <= _LOW32)
        if len(short):
            at = short if isinstance(lanes, slice) else lanes[short]
            code[short] = code[short] << _U64(32) | self.words[self.next[at]]
            self.next[at] += 1
            r[short] <<= _U64(32)
        self.code[lanes], self.range[lanes] = code, r


def _weights(m: _Model, e, group):
    """Of escapes e in groups: the last id's low byte, and the weight of a hit of it against 1 for each other."""
    return m.last[e * _GROUPS + group].astype(_I64), np.minimum(255 * m.right[e] // m.wrong[e] + 1, 4095)


def _note(m: _Model, e, hit):
    m.right[e] += hit * 2
    m.wrong[e] += ~hit * 2
    old = e[(m.right[e] + m.wrong[e]) > _HALVE]
    m.right[old] = (m.right[old] + 1) >> 1
    m.wrong[old] = (m.wrong[old] + 1) >> 1


def _lengths(n: int) -> np.ndarray:
    size = np.full(-(-n // BLOCK), BLOCK, _I64)
    if n % BLOCK:
        size[-1] = n % BLOCK
    return size


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids per block, words per block, all words) of a stream of ids below 65536."""
    size = _lengths(len(ids))
    lanes = len(size)
    if not lanes:
        return size, size, np.zeros(0, np.uint32)
    longest = int(size[0])
    grid = np.zeros((lanes, longest), _I64)
    grid.reshape(-1)[:len(ids)] = ids
    grid = np.ascontiguousarray(grid.T)
    m, out = _Model(lanes), _Writer(lanes, longest)
    for t in range(longest):
        a = lanes if t < size[-1] else lanes - 1
        x = grid[t, :a]
        m.guess(a)
        outcome = np.where(x == m.id2, 0, np.where(x == m.id1, 1, 2))
        edge = np.stack([np.zeros(a, _I64), m.n0, m.n01, m.n012]).reshape(-1)
        at = outcome * a + m.lane[:a]
        start = edge[at]
        out.put(slice(0, a), start, edge[at + a] - start, m.n012)
        group = x >> 8
        e = np.flatnonzero(outcome == 2)
        if len(e):
            g, lowbyte = group[e], x[e] & 255
            row = e * (_GROUPS + 1)
            b0, b1, total = (m.below_flat[row + k].astype(_I64) for k in (g, g + 1, _GROUPS))
            last, hit_weight = _weights(m, e, g)
            hit = lowbyte == last
            inner = np.where(hit, 0, hit_weight + lowbyte - (lowbyte > last))
            width = np.where(hit, hit_weight, 1)
            whole = hit_weight + 255
            # The group's interval, and inside it the low byte's.
            out.put(e, b0 * whole + (b1 - b0) * inner, (b1 - b0) * width, total * whole)
            _note(m, e, hit)
        m.learn(a, x, outcome, group)
    out.finish()
    return size, out.n, out.words[np.arange(out.words.shape[1])[None, :] < out.n[:, None]]


def decode_blocks(size: np.ndarray, n_words: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The ids of blocks; sizes must not increase (blocks may be any of a file)."""
    lanes = len(size)
    if not lanes:
        return np.zeros(0, _I64)
    longest = int(size[0])
    first = np.concatenate([[0], np.cumsum(n_words)[:-1]]).astype(_I64)
    m, src = _Model(lanes), _Reader(np.append(words, np.zeros(2, np.uint32)), first)
    grid = np.zeros((longest, lanes), _I64)
    for t in range(longest):
        a = lanes if t < size[-1] else int(np.searchsorted(-size, -t, side="left"))
        m.guess(a)
        v = src.look(slice(0, a), m.n012)
        outcome = (v >= m.n0).astype(_I64) + (v >= m.n01)
        edge = np.stack([np.zeros(a, _I64), m.n0, m.n01, m.n012]).reshape(-1)
        at = outcome * a + m.lane[:a]
        start = edge[at]
        src.take(slice(0, a), start, edge[at + a] - start)
        x = np.where(outcome == 0, m.id2, m.id1).astype(_I64)
        e = np.flatnonzero(outcome == 2)
        if len(e):
            row = e * (_GROUPS + 1)
            total = m.below_flat[row + _GROUPS].astype(_I64)
            # The hit weight doesn't depend on the group.
            hit_weight = np.minimum(255 * m.right[e] // m.wrong[e] + 1, 4095)
            whole = hit_weight + 255
            v = src.look(e, total * whole)
            want = v // whole
            g = np.zeros(len(e), _I64)
            for step in (128, 64, 32, 16, 8, 4, 2, 1):
                g += step * (m.below_flat[row + g + step] <= want)
            b0, b1 = m.below_flat[row + g].astype(_I64), m.below_flat[row + g + 1].astype(_I64)
            last = m.last[e * _GROUPS + g].astype(_I64)
            inner = (v - b0 * whole) // (b1 - b0)
            hit = inner < hit_weight
            other = inner - hit_weight
            lowbyte = np.where(hit, last, other + (other >= last))
            src.take(e, b0 * whole + (b1 - b0) * np.where(hit, 0, inner), (b1 - b0) * np.where(hit, hit_weight, 1))
            x[e] = g << 8 | lowbyte
            _note(m, e, hit)
        grid[t, :a] = x
        m.learn(a, x, outcome, x >> 8)
    return grid.T.reshape(-1)[np.arange(longest)[None, :].repeat(lanes, 0).reshape(-1) < size.repeat(longest)]


def pack_file(partition: int, number: int, doc_ids: list, counts: np.ndarray, ids: np.ndarray) -> bytes:
    size, n_words, words = encode_blocks(ids)
    ends = np.concatenate([[0], np.cumsum(size)])
    raw = ids.astype("<u4")
    crcs = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return b"".join([
        MAGIC, struct.pack("<IIIIQ", partition, number, len(doc_ids), len(size), len(ids)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array([d is None for d in doc_ids], "u1").tobytes(),
        counts.astype("<u8").tobytes(), size.astype("<u4").tobytes(), n_words.astype("<u4").tobytes(),
        np.array(crcs, "<u4").tobytes(), words.astype("<u4").tobytes()])


def unpack_file(content: bytes) -> tuple[int, int, list, np.ndarray, np.ndarray]:
    """(partition, number, doc ids, ids per document, ids); ValueError if a checksum is wrong."""
    if content[:8] != MAGIC:
        raise ValueError("not an id file")
    partition, number, docs, blocks, total = struct.unpack_from("<IIIIQ", content, 8)
    at = 8 + struct.calcsize("<IIIIQ")

    def take(kind, n):
        nonlocal at
        x = np.frombuffer(content, kind, n, at)
        at += x.nbytes
        return x
    doc_ids, null, counts = take("<i8", docs), take("u1", docs), take("<u8", docs)
    size, n_words, crcs = take("<u4", blocks), take("<u4", blocks), take("<u4", blocks)
    words = take("<u4", int(n_words.sum()))
    ids = decode_blocks(size.astype(_I64), n_words.astype(_I64), words)
    ends = np.concatenate([[0], np.cumsum(size, dtype=_I64)])
    raw = ids.astype("<u4")
    for k in range(blocks):
        if zlib.crc32(raw[ends[k]:ends[k + 1]].tobytes()) != crcs[k]:
            raise ValueError(f"block {k}: wrong checksum")
    if len(ids) != total:
        raise ValueError("blocks are missing")
    return partition, number, [None if z else int(d) for d, z in zip(doc_ids, null, strict=True)], counts.astype(_I64), ids


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordIds:
    """Ids of texts.  The vocabulary drops white space and never joins over it, so a text's ids
    are those of its space-separated parts; each part is encoded by the library once."""

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.clear()

    def clear(self):
        self.place: dict[bytes, int] = {}
        self.flat = np.array([END_ID], np.uint16)
        self.used = 1
        self.at = np.zeros(1, _I64)
        self.size = np.ones(1, _I64)

    def _add(self, new: list[bytes]):
        got = [e.ids for e in self.tokenizer.encode_batch([w.decode() for w in new], add_special_tokens=False)]
        first = len(self.place) + 1
        self.place.update(zip(new, range(first, first + len(new)), strict=True))
        size = np.fromiter(map(len, got), _I64, len(got))
        need = self.used + int(size.sum())
        if need > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(need, np.uint16)])
        if first + len(new) > len(self.at):
            self.at, self.size = (np.concatenate([x, np.zeros(first + len(new), _I64)]) for x in (self.at, self.size))
        self.flat[self.used:need] = np.fromiter((i for g in got for i in g), np.uint16, need - self.used)
        self.at[first:first + len(new)] = self.used + np.cumsum(size) - size
        self.size[first:first + len(new)] = size
        self.used = need

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids with the end id of each text in turn, ids per text)."""
        if len(self.place) > KNOWN_WORDS:
            self.clear()
        if not texts:
            return np.zeros(0, np.uint16), np.zeros(0, _I64)
        parts = [t.split() for t in texts]
        words = [w for p in parts for w in p]
        new = list(set(words).difference(self.place))
        for k in range(0, len(new), 10_000):
            self._add(new[k:k + 10_000])
        stops = np.cumsum([len(p) + 1 for p in parts]) - 1
        order = np.zeros(stops[-1] + 1, _I64)  # place 0: the end id
        inner = np.ones(len(order), bool)
        inner[stops] = False
        order[inner] = np.fromiter(map(self.place.__getitem__, words), _I64, len(words))
        size = self.size[order]
        done = np.cumsum(size)
        take = np.arange(done[-1], dtype=_I64) + np.repeat(self.at[order] - (done - size), size)
        return self.flat[take], np.diff(np.concatenate([[0], done[stops]]))


def _file_rows(batches, path: str):
    from pyspark import TaskContext

    partition, number = TaskContext.get().partitionId(), 0
    words = WordIds(path)
    doc_ids: list = []
    counts: list[np.ndarray] = []
    ids: list[np.ndarray] = []

    def file():
        return pa.RecordBatch.from_arrays([pa.array([pack_file(
            partition, number, doc_ids, np.concatenate(counts), np.concatenate(ids))], pa.binary())], names=["content"])

    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            some = batch.slice(k, 256)
            got, per = words([t or b"" for t in some.column(1).cast(pa.binary()).to_pylist()])
            doc_ids += some.column(0).to_pylist()
            counts.append(per)
            ids.append(got)
            if sum(map(len, ids)) >= FILE_IDS:
                yield file()
                doc_ids, counts, ids, number = [], [], [], number + 1
    if doc_ids:
        yield file()


def write_ids(spark: SparkSession, docs: DataFrame, path: str, vocabulary: str) -> None:
    """Write the ids of all documents to path, in ascending doc_id order (then by a hash of the text)."""
    ship_package(spark)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranged = text.withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
    write_files(ranged.select("doc_id", "text").mapInArrow(lambda it: _file_rows(it, vocabulary), "content binary"), path)


def _doc_rows(batches, with_ids: bool):
    for batch in batches:
        for content in batch.column("content"):
            partition, number, doc_ids, counts, ids = unpack_file(content.as_buffer().to_pybytes())
            ends = np.concatenate([[0], np.cumsum(counts)])
            raw = ids.astype("<u4")
            crc = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            n = len(doc_ids)
            cols = [pa.array([partition] * n, pa.int32()), pa.array([number] * n, pa.int32()), pa.array(doc_ids, pa.int64()),
                    pa.array(ends[:-1]), pa.array(counts), pa.array(crc, pa.int64())]
            names = ["partition", "number", "doc_id", "offset", "n_tokens", "ids_crc32"]
            if with_ids:
                cols.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every stored document; start counts the ids before it."""
    ship_package(spark)
    schema = "partition int, number int, doc_id long, offset long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    rows = read_files(spark, path).select("content").mapInArrow(lambda it: _doc_rows(it, with_ids), schema)
    rows = staged(spark, rows, "stored")
    from pyspark.sql import Window as W

    files = rows.groupBy("partition", "number").agg(F.sum("n_tokens").alias("n"))
    parts = files.groupBy("partition").agg(F.sum("n").alias("n"))
    # One row for each partition written: their sums are the only thing that meets in one task.
    parts = parts.select("partition", (F.sum("n").over(W.orderBy("partition")) - F.col("n")).alias("before"))
    files = files.select("partition", "number", (F.sum("n").over(W.partitionBy("partition").orderBy("number")) - F.col("n")).alias("inside"))
    out = rows.join(files.join(parts, "partition"), ["partition", "number"])
    return out.select("doc_id", (F.col("before") + F.col("inside") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def op10_context_mixing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "ids")
    write_ids(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), path, vocabulary_path(VOCABULARY))
    return read_ids(spark, path, with_ids=False)
