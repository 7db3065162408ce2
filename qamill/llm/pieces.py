"""SentencePiece encoding and decoding (BPE models with byte fallback) by suffix-array matching.

The new segments of a batch (a run of blanks and the word after it, or a line
feed and the word after it; no piece crosses from a word into the next blank,
and none holds a line feed) are laid end to end and indexed by a
suffix array, sorted as deep as the longest piece.  Every piece is looked up
by binary search, all pieces at once; the ranges found are all its
occurrences.  They become edges, sorted by the place they end at, and are
relaxed in that order: the place after an edge is reached by it if the piece
that ends where it starts may stand before it.  Two pieces may stand side by
side if merging their joined text gives just them back; BPE has exactly one
such chain, and it is the library's encoding.  Characters without a piece
become their UTF-8 bytes' ids.

Runs of blanks have pieces of equal score, whose merges depend on what stands
further left; segments with two or more blanks are merged one by one.

Segments already met by a worker keep their ids, up to KNOWN_SEGMENTS.

Cases: null text: null ids, decoded to null; empty text: no ids, decoded to the empty
text.  U+2581 in a text is a blank to the model and comes back as one.  Long
texts are matched whole.  Repeated rows: each is encoded.  Other columns stay as they are.
"""

from __future__ import annotations

import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qamill.llm.token_store import vocabulary_path
from qamill.session import ship_package

VOCABULARY = "piece_bpe_32k.model"
KNOWN_SEGMENTS = 400_000
#: Characters indexed at a time, about.
INDEXED = 3 << 17
BLANK = "▁"


class Model:
    """Pieces of a model file, read with the library."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        text = [sp.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.byte = {int(text[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.id = {text[i]: i for i in normal}
        self.score = {text[i]: sp.get_score(i) for i in normal}
        self.text = text
        self.raw = [b""] * n
        for i in normal:
            self.raw[i] = text[i].replace(BLANK, " ").encode()
        for b, i in self.byte.items():
            self.raw[i] = bytes([b])
        self.size = n
        self.length = np.ones(n, np.int64)
        self.length[normal] = [len(text[i]) for i in normal]
        self.deepest = int(self.length.max())
        self.ids = np.array(sorted(normal, key=lambda i: len(text[i])), np.int64)
        self.codes = np.zeros((len(normal), self.deepest), np.uint32)
        for row, i in enumerate(self.ids):
            self.codes[row, :len(text[i])] = [ord(c) for c in text[i]]
        self.sizes = self.length[self.ids]
        self.pairs = Pairs(self)
        # For may_follow: when a piece arises (characters first, then by score) and of which two.
        by_score = sorted(normal, key=lambda i: (len(text[i]) > 1, -self.score[text[i]]))
        self.rank = dict(zip(by_score, range(n), strict=False))
        self.halves: dict[int, tuple[int, int]] = {}

    def _halves(self, i: int) -> tuple[int, int]:
        got = self.halves.get(i)
        if got is None:
            got = self.halves[i] = tuple(self.merged(self.text[i], whole=False))  # type: ignore[assignment]
        return got

    def merged(self, s: str, whole: bool = True) -> list[int]:
        """Ids of s by merging: the highest score first, then the leftmost; whole=False: without the last merge of a piece."""
        # Neighbours by score, then from the left, in a heap: a run of n characters takes n log n steps.
        parts: list[str | None] = list(s)
        after, before = list(range(1, len(s) + 1)), list(range(-1, len(s) - 1))
        heap: list[tuple] = []

        def offer(k: int) -> None:
            both = parts[k] + parts[after[k]] if after[k] < len(s) else None
            score = self.score.get(both) if both is not None else None
            if score is not None:
                heapq.heappush(heap, (-score, k, both))

        for k in range(len(s) - 1):
            offer(k)
        left = len(s)
        while heap and left > (1 if whole else 2):
            _, k, both = heapq.heappop(heap)
            j = after[k] if parts[k] is not None else len(s)
            if j >= len(s) or parts[k] + parts[j] != both:
                continue
            parts[k], parts[j] = both, None
            after[k] = after[j]
            if after[j] < len(s):
                before[after[j]] = k
            left -= 1
            offer(k)
            if before[k] >= 0:
                offer(before[k])
        parts = [x for x in parts if x is not None]
        out: list[int] = []
        for p in parts:
            out += [self.id[p]] if p in self.id else [self.byte[b] for b in p.encode()]
        return out

    def may_follow(self, a: int, b: int) -> bool:
        """May piece b stand after piece a?  Undo merges from the last on; no merge over the limit may come before the one undone."""
        limit = self.size + 1
        while True:
            over = self.id.get(self.text[a] + self.text[b])
            if over is not None and self.rank[over] < limit:
                return False
            if self.rank[a] > self.rank[b]:
                if len(self.text[a]) == 1:
                    return True
                limit, a = self.rank[a], self._halves(a)[1]
            else:
                if len(self.text[b]) == 1:
                    return True
                limit, b = self.rank[b] + 1, self._halves(b)[0]


class Pairs:
    """Which pieces may stand side by side, found out once for each pair: a hash table with open places."""

    def __init__(self, model: Model, bits: int = 16):
        self.model = model
        self.n = 0
        self._make(bits)

    def _make(self, bits: int) -> None:
        self.bits = bits
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ok = np.zeros(1 << bits, bool)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Places of keys; that of one that isn't there is open."""
        at = self._home(keys)
        go = np.arange(len(keys))
        while len(go):
            have = self.keys[at[go]]
            go = go[(have != keys[go]) & (have != -1)]
            at[go] = (at[go] + 1) & (len(self.keys) - 1)
        return at

    def _put(self, keys: np.ndarray, ok: np.ndarray) -> None:
        if (self.n + len(keys)) * 2 > len(self.keys):
            old, was = self.keys, self.ok
            full = old >= 0
            self._make(max(self.bits + 1, (2 * (self.n + len(keys))).bit_length()))
            self.n = 0
            self._put(old[full], was[full])
        while len(keys):
            at = self._find(keys)
            self.keys[at] = keys  # of keys that share an open place one gets it
            got = self.keys[at] == keys
            self.ok[at[got]] = ok[got]
            self.n += int(got.sum())
            keys, ok = keys[~got], ok[~got]

    def fit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """May b[k] stand after a[k]?  Characters without a piece (ids from model.size on) may stand anywhere."""
        keys = a << 20 | b
        out = (a >= self.model.size) | (b >= self.model.size)
        ask = np.flatnonzero(~out)
        keys = keys[ask]
        at = self._find(keys)
        new = np.unique(keys[self.keys[at] == -1])
        if len(new):
            may = self.model.may_follow
            self._put(new, np.fromiter((may(k >> 20, k & 0xFFFFF) for k in new.tolist()), bool, len(new)))
            at = self._find(keys)
        out[ask] = self.ok[at]
        return out


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Places in order of the ``depth`` codes from there (the end sorts first), by doubling."""
    _, rank = np.unique(codes, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    width = 1
    while True:
        after = np.zeros(len(rank), np.int64)
        after[:-width] = rank[width:]
        key = rank * (len(rank) + 1) + after
        order = np.argsort(key, kind="stable")
        width *= 2
        if width >= depth or width >= len(rank):
            return order
        new = np.empty(len(rank), np.int64)
        ordered = key[order]
        new[order] = np.concatenate([[1], 1 + np.cumsum(ordered[1:] != ordered[:-1])])
        rank = new


def occurrences(model: Model, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(piece id, start) of every place of every piece in codes."""
    order = suffix_array(codes, model.deepest)
    padded = np.append(codes, np.zeros(model.deepest, codes.dtype))
    lo = np.zeros(len(model.ids), np.int64)
    hi = np.full(len(model.ids), len(order), np.int64)
    for d in range(model.deepest):
        live = np.flatnonzero((model.sizes > d) & (lo < hi))
        want = model.codes[live, d]
        edges = []
        for upper in (False, True):
            a, b = lo[live].copy(), hi[live].copy()
            while True:
                go = a < b
                if not go.any():
                    break
                mid = (a + b) >> 1
                have = padded[order[np.minimum(mid, len(order) - 1)] + d]
                right = go & ((have <= want) if upper else (have < want))
                b = np.where(go & ~right, mid, b)
                a = np.where(right, mid + 1, a)
            edges.append(a)
        lo[live], hi[live] = edges
    n = np.maximum(hi - lo, 0)
    at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return np.repeat(model.ids, n), order[at]


def encode_segments(model: Model, segments: list[str]) -> list[list[int]]:
    """Ids of each segment (no segment is empty)."""
    out: list[list[int] | None] = [None] * len(segments)
    plain = []
    for k, s in enumerate(segments):
        if s.startswith(BLANK * 2):
            out[k] = _blanks_first(model, s)
        else:
            plain.append(k)
    first = 0
    while first < len(plain):
        last, size = first, 0
        while last < len(plain) and (size == 0 or size < INDEXED):
            size += len(segments[plain[last]]) + 1
            last += 1
        some = plain[first:last]
        for k, ids in zip(some, _relaxed(model, [segments[k] for k in some]), strict=True):
            out[k] = ids
        first = last
    return out  # type: ignore[return-value]


def _blanks_first(model: Model, s: str) -> list[int]:
    """A segment that begins with several blanks.  Blank runs merge last of all, so the word
    takes its blank first, if it does; what is left of the run is merged by itself."""
    word = s.lstrip(BLANK)
    run = len(s) - len(word)
    if not word:
        return model.merged(s)
    whole = _relaxed(model, [BLANK + word])[0]
    if model.text[whole[0]] == BLANK:  # the blank stays with the run
        return model.merged(BLANK * run) + whole[1:]
    return model.merged(BLANK * (run - 1)) + whole


def _relaxed(model: Model, segments: list[str]) -> list[list[int]]:
    joined = "\0".join(segments)
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).copy()
    size = np.fromiter(map(len, segments), np.int64, len(segments))
    start = np.cumsum(size + 1) - (size + 1)
    codes[start[1:] - 1] = 0x110000  # no character: nothing matches over it
    ids, at = occurrences(model, codes)
    alone = np.ones(len(codes), bool)
    alone[at[model.length[ids] == 1]] = False
    alone[start[1:] - 1] = False
    alone = np.flatnonzero(alone)
    ids = np.concatenate([ids, model.size + codes[alone].astype(np.int64)])
    at = np.concatenate([at, alone])
    length = np.where(ids < model.size, model.length[np.minimum(ids, model.size - 1)], 1)
    end = at + length
    # Of all segments at once: edges by how far into its segment they end.
    first = np.repeat(start, size + 1)[at]
    order = np.argsort(end - first, kind="stable")
    ids, at, end, far = ids[order], at[order], end[order], (end - first)[order]
    steps = np.searchsorted(far, np.arange(1, (far[-1] if len(far) else 0) + 2))
    reached = np.full(len(codes) + 1, -1, np.int64)
    reached[start] = -2
    for x, y in zip(steps[:-1].tolist(), steps[1:].tolist(), strict=True):
        i, p, e = ids[x:y], reached[at[x:y]], end[x:y]
        ok = p == -2
        ask = np.flatnonzero(p >= 0)
        if len(ask):
            ok[ask] = model.pairs.fit(p[ask], i[ask])
        reached[e[ok]] = i[ok]
    reached = reached.tolist()
    out = []
    for s, n in zip(start.tolist(), size.tolist(), strict=True):
        e, back = s + n, []
        while e > s:
            i = reached[e]
            if i >= model.size:
                back += [model.byte[b] for b in reversed(chr(i - model.size).encode())]
                e -= 1
            else:
                back.append(i)
                e -= int(model.length[i])
        out.append(back[::-1])
    return out


def segments_of(text: str) -> list[str]:
    """Segments of a text that isn't empty, each with its blanks before it; a single blank is left
    out.  One that begins with a line feed has none: no piece holds a line feed."""
    if BLANK in text:
        text = text.replace(BLANK, " ")
    # The model puts a blank before the text.  After this, one sign " " stands before every part,
    # for a blank, or for nothing if the part begins with a line feed.
    parts = text.replace("\n", " \n").split(" ")
    if text[0] == "\n":
        parts[0] = ""
    if "" not in parts:
        return parts
    out, run = [], 0
    for w in parts:
        if w.startswith("\n"):
            if run:
                out.append(BLANK * run)
            out.append(w)
            run = 0
            continue
        run += 1
        if w:
            out.append(w if run == 1 else BLANK * run + w)
            run = 0
    if run:
        out.append(BLANK * run)
    return out


class Encoder:
    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self):
        self.place: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.used = 0
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)

    def _add(self, new: list[str]):
        got = encode_segments(self.model, [s if s[0] in "\n" + BLANK else BLANK + s for s in new])
        first = len(self.place)
        self.place.update(zip(new, range(first, first + len(new)), strict=True))
        size = np.fromiter(map(len, got), np.int64, len(got))
        need = self.used + int(size.sum())
        if need > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(need, np.int32)])
        if first + len(new) > len(self.at):
            self.at, self.size = (np.concatenate([x, np.zeros(first + len(new), np.int64)]) for x in (self.at, self.size))
        self.flat[self.used:need] = np.fromiter((i for g in got for i in g), np.int32, need - self.used)
        self.at[first:first + len(new)] = self.used + np.cumsum(size) - size
        self.size[first:first + len(new)] = size
        self.used = need

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids per text)."""
        if len(self.place) > KNOWN_SEGMENTS:
            self.clear()
        parts = [segments_of(t) if t else [] for t in texts]
        words = [w for p in parts for w in p]
        new = list(set(words).difference(self.place))
        if new:
            self._add(new)
        order = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        if not len(order):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        size = self.size[order]
        done = np.concatenate([[0], np.cumsum(size)])
        take = np.arange(done[-1], dtype=np.int64) + np.repeat(self.at[order] - done[:-1], size)
        stops = np.cumsum([0, *map(len, parts)])
        return self.flat[take], np.diff(done[stops])


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(Model(path))


def decode_ids(model: Model, ids: np.ndarray) -> str:
    text = b"".join(map(model.raw.__getitem__, ids.tolist())).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def _with_column(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, name])


def _encode_rows(batches, text: str, ids: str, path: str):
    enc = _encoder(path)
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            some = batch.slice(k, 256)
            texts = some.column(some.schema.names.index(text))
            got, per = enc([t or "" for t in texts.to_pylist()])
            at = pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32(), mask=np.append(texts.is_null().to_numpy(zero_copy_only=False), False))
            yield _with_column(some, ids, pa.ListArray.from_arrays(at, pa.array(got, pa.int32())))


def _decode_rows(batches, ids: str, text: str, path: str):
    model = _encoder(path).model
    for batch in batches:
        for k in range(0, batch.num_rows, 512):
            some = batch.slice(k, 512)
            col = some.column(some.schema.names.index(ids))
            yield _with_column(some, text, pa.array(
                [decode_ids(model, x.values.to_numpy()) if x.is_valid else None for x in col], pa.string()))


def _checked_name(df: DataFrame, name: str) -> str:
    if name in df.columns:
        raise ValueError(f"the table already has a column {name}")
    return name


def encode(spark: SparkSession, df: DataFrame, text: str = "text", ids: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """df with a column of piece ids; no shuffle."""
    ship_package(spark)
    path = vocabulary or vocabulary_path(VOCABULARY)
    schema = T.StructType([*df.schema.fields, T.StructField(_checked_name(df, ids), T.ArrayType(T.IntegerType()))])
    return df.mapInArrow(lambda it: _encode_rows(it, text, ids, path), schema)


def decode(spark: SparkSession, df: DataFrame, ids: str = "ids", text: str = "decoded", vocabulary: str | None = None) -> DataFrame:
    """df with a column of the texts of piece ids; no shuffle."""
    ship_package(spark)
    path = vocabulary or vocabulary_path(VOCABULARY)
    schema = T.StructType([*df.schema.fields, T.StructField(_checked_name(df, text), T.StringType())])
    return df.mapInArrow(lambda it: _decode_rows(it, ids, text, path), schema)


def op5_suffix_array_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the ids, comma-joined), decoded_sha256, round_trip."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    both = decode(spark, encode(spark, docs))
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), F.col("text").eqNullSafe(F.col("decoded")).alias("round_trip"))
