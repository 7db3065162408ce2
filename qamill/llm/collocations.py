"""Phrase collocations from stripes.

Texts are lower-cased (A-Z), split into pieces at PIECE_ENDS and into words at
blanks.  A stripe belongs to a prefix of 0 to 3 words: an associative counter of
the words that follow it.  Tasks count stripes over what they read and write
them out whenever they hold HELD entries, packed in BLOCKS blocks by hash of the
prefix; blocks of one number then meet in one place, where stripes of one prefix
are added elementwise.  A stripe is dealt in PARTS parts, over as many blocks, by
the hash of the next word (the same everywhere), so that the stripe of a frequent
prefix isn't held in one place.
The added stripes say all that is asked of a phrase: the entry of its last word
in its prefix's stripe is its frequency, the greatest entry of its own stripe is
the most frequent extension to the right, and extensions to the left are entries
whose last words are the phrase.

Most phrases are rare, and stripes needn't hold them.  A first pass counts the
hashes of all phrases of 1 to 4 words: 2^32 counters, dealt in RANGES ranges of
hashes, of which a task adds up one at a time.  What reaches the stripes is told
by a bit table of fixed size (16 MB), one bit for 32 neighbouring counters, set
if any of them reached ``least``.  It lets some rare phrases through, and more
as the corpus grows, which costs work but changes nothing, as the stripes' counts
decide.

Only entries of at least ``least`` occurrences leave a stripe.  Both halves of
every cut of a candidate are as frequent as itself, so all lookups are joins
among those.  A longer phrase that holds a candidate and 80 % of its
occurrences has a sub-phrase one word longer than the candidate that holds as
many, so only extensions by one word are compared.

Within a slice of some MB equal phrases are found by 64-bit hashes; everything
that leaves a slice is named by its words.

Cases: null, empty or wordless texts give nothing; null lang counts as ``und``,
together with that language.  Repeated rows count each time.  A very long text
is counted in stretches of about CHUNK bytes that overlap by three words.  Empty
table: no rows.  Columns other than text and lang aren't looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from qamill.llm import hashing as H
from qamill.llm.tables import staged
from qamill.session import ship_package

PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
LONGEST = 4
LEAST = 30
COVER = 80
TOP = 2000
#: Parts of a stripe, by words of its prefix.
PARTS = (256, 8, 2, 2)
#: Blocks that stripes are dealt in: a task adds up one at a time.
BLOCKS = 4096
#: Bytes of text whose phrases are hashed at once.
SLICE = 3 << 20
#: Entries that a task holds before it writes its stripes, and hashes before it writes their counts.
HELD, HASHES = 300_000, 6_000_000
CHUNK = 1 << 20
RANGES = 1 << 10
_SPAN = (1 << 32) // RANGES
_SALTS = 256
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_END = np.zeros(256, dtype=bool)
_END[list(PIECE_ENDS)] = True
_SEPARATOR = _END.copy()
_SEPARATOR[[0x20, 0x09]] = True
_CUT = re.compile(b"[ \t" + re.escape(PIECE_ENDS) + b"]")
_PIECE = re.compile(b"[" + re.escape(PIECE_ENDS) + b"]")

HASHED = "range int, gaps binary, counts binary"
STRIPES = "block int, stripes binary"
#: word: an entry (prefix, word, n).  Without one: n is the number of words of the language.
ENTRY = "lang string, prefix binary, word binary, n long"


def stretches(text: bytes) -> Iterator[tuple[bytes, int]]:
    """text in parts of about CHUNK bytes, words whole; with each, how many words at its start repeat the last part's end."""
    a, kept, skip = 0, b"", 0
    while len(text) - a > CHUNK:
        m = _CUT.search(text, a + CHUNK)
        if m is None:
            break
        part = kept + text[a:m.start()]
        yield part, skip
        a = m.start()
        tail = _PIECE.split(part)[-1].split()[1 - LONGEST:]
        kept, skip = b" ".join(tail) + b" ", len(tail)
    yield kept + text[a:], skip


class Slice:
    """Words of some texts, and the hashes of their phrases."""

    def __init__(self, parts: list[tuple[bytes, int, int]], langs: list[str]) -> None:
        """parts: (bytes, number of the language, words that don't count)."""
        self.raw = b"".join(p for p, _, _ in parts).translate(_LOWER)
        offs = np.concatenate([[0], np.cumsum([len(p) for p, _, _ in parts])]).astype(np.int64)
        buf = np.frombuffer(self.raw, dtype=np.uint8)
        self.starts, self.ends, bounds = H.word_spans(buf, offs, _SEPARATOR)
        self.row = np.repeat(np.arange(len(parts)), np.diff(bounds))
        self.lang = np.array([x for _, x, _ in parts], dtype=np.int64)[self.row]
        skip = np.array([x for _, _, x in parts], dtype=np.int64)[self.row]
        self.left = skip - (np.arange(len(self.row)) - bounds[self.row])
        ends = np.cumsum(_END[buf])
        self.joined = (self.row[1:] == self.row[:-1]) & (ends[self.starts[1:]] == ends[self.ends[:-1] - 1]) if len(self.row) else np.zeros(0, bool)
        self.words = H.word_hashes(buf, self.starts, self.ends)
        self.salt = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "big") for x in langs], dtype=H.U64)

    def phrases(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the first words of all phrases of n words that count here, and their hashes."""
        m = max(len(self.words) - n + 1, 0)
        ok = self.left[:m] < n
        for j in range(n - 1):
            ok &= self.joined[j:j + m]
        return np.flatnonzero(ok), H.mix64(H.window_hashes(self.words, n) ^ self.salt[self.lang[:m]])[ok]

    def word(self, i: int) -> bytes:
        return self.raw[self.starts[i]:self.ends[i]]


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Slice, list[str]]]:
    """Slices of (text, lang) batches, and the languages so far."""
    parts, size, langs = [], 0, {}
    for b in batches:
        for text, lang in zip(b.column(0), b.column(1).to_pylist(), strict=True):
            x = langs.setdefault(lang, len(langs))
            for part, skip in stretches(text.as_py()):
                parts.append((part, x, skip))
                size += len(part)
                if size > SLICE:
                    yield Slice(parts, list(langs)), list(langs)
                    parts, size = [], 0
    if parts:
        yield Slice(parts, list(langs)), list(langs)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("string").cast("binary").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")).where(
        F.col("text").isNotNull())


def _planes(x: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes first: the higher ones are mostly zero and pack well."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel()


def frequent_table(spark: SparkSession, docs: DataFrame, least: int):
    """The broadcast bit table of hashes that may belong to a phrase of ``least`` occurrences."""
    most = HASHES

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            u, n = np.unique(np.concatenate(held), return_counts=True)
            at = np.searchsorted(u, np.arange(0, RANGES + 1, dtype=np.int64) * _SPAN)
            used = np.flatnonzero(np.diff(at))
            gaps = [_planes(np.diff(u[at[r]:at[r + 1]].astype(np.int64) - r * _SPAN, prepend=0)) for r in used]
            counts = [_planes(np.minimum(n[at[r]:at[r + 1]], least)) for r in used]
            return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(gaps, pa.binary()), pa.array(counts, pa.binary())],
                                              names=["range", "gaps", "counts"])

        held, size = [], 0
        for s, _ in slices(batches):
            for k in range(1, LONGEST + 1):
                h = (s.phrases(k)[1] >> H.U64(32)).astype(np.uint32)
                held.append(h)
                size += len(h)
            if size > most:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(_SPAN, dtype=np.uint32)

        def bits() -> pa.RecordBatch:
            some = np.packbits((total >= least).reshape(-1, 32).any(axis=1), bitorder="little")
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([some.tobytes()], pa.binary())], names=["range", "bits"])

        for b in batches:
            for r, gaps, counts in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if r != now:
                    if now is not None:
                        yield bits()
                    now = r
                    total[:] = 0
                at = np.cumsum(_from_planes(gaps), dtype=np.int64)
                total[at] = np.minimum(total[at] + _from_planes(counts), least)
        if now is not None:
            yield bits()

    sums = _rows(docs).mapInArrow(hashed, HASHED).repartition("range").sortWithinPartitions("range").mapInArrow(added, "range int, bits binary")
    size = _SPAN // 32 // 8
    table = np.zeros(RANGES * size, dtype=np.uint8)
    for r in sums.collect():
        table[r["range"] * size:(r["range"] + 1) * size] = np.frombuffer(r["bits"], dtype=np.uint8)
    return spark.sparkContext.broadcast(table)


def _packed(held: dict[tuple, int], langs: list[str]) -> pa.RecordBatch:
    """STRIPES rows of counted (language, words before, prefix, word): a line for each stripe, of language, prefix and
    entries.  Neither words nor languages in JSON hold a tab or a line feed, nor words a blank."""
    names = [json.dumps(x).encode() for x in langs]
    one: dict[tuple, list] = {}
    for (lang, n, prefix, word), c in held.items():
        key = (lang, prefix, zlib.crc32(word) % PARTS[n] if word else -1)
        entries = one.get(key)
        if entries is None:
            entries = one[key] = []
        entries.append(b"%b %d" % (word, c) if word else b"%d" % c)
    lines: list[list] = [[] for _ in range(BLOCKS)]
    for (lang, prefix, part), entries in sorted(one.items()):
        at = (zlib.crc32(prefix, zlib.crc32(names[lang])) + part * 0x9E3779B1) % BLOCKS
        lines[at].append(b"\t".join((names[lang], *entries) if part < 0 else (names[lang], prefix, b" ".join(entries))))
    used = [i for i, x in enumerate(lines) if x]
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([zlib.compress(b"\n".join(lines[i]), 3) for i in used], pa.binary())],
                                      names=["block", "stripes"])


def stripes(docs: DataFrame, table) -> DataFrame:
    """STRIPES of the phrases that the bit table lets through, and the number of all words of each language."""
    most = HELD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, int] = {}
        langs: list[str] = []
        for s, langs in slices(batches):
            for k in range(1, LONGEST + 1):
                at, h = s.phrases(k)
                if k == 1:
                    for x, n in enumerate(np.bincount(s.lang[at], minlength=len(langs)).tolist()):
                        held[x, 0, b"", b""] = held.get((x, 0, b"", b""), 0) + n
                place = (h >> H.U64(37)).astype(np.int64)
                may = (table.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                _, first, n = np.unique(h[may], return_index=True, return_counts=True)
                where = at[may][first]
                for i, x, c in zip(where.tolist(), s.lang[where].tolist(), n.tolist(), strict=True):
                    key = (x, k - 1, b" ".join([s.word(i + j) for j in range(k - 1)]), s.word(i + k - 1))
                    held[key] = held.get(key, 0) + c
            if len(held) > most:
                yield _packed(held, langs)
                held.clear()
        if held:
            yield _packed(held, langs)

    return _rows(docs).mapInArrow(run, STRIPES)


def merged(found: DataFrame, least: int) -> DataFrame:
    """Stripes of each block added elementwise: ENTRY rows of at least ``least`` occurrences, and the totals."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries(block: dict[tuple, dict]) -> pa.RecordBatch:
            rows = []
            for (lang, prefix), stripe in block.items():
                name = json.loads(lang)
                rows += [(name, prefix, w, n) for w, n in stripe.items() if w is None or n >= least]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.string(), pa.binary(), pa.binary(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "prefix", "word", "n"])

        now, block = None, {}
        for b in batches:
            for at, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if at != now:
                    if now is not None:
                        yield entries(block)
                    now, block = at, {}
                for line in zlib.decompress(raw.as_py()).split(b"\n"):
                    lang, prefix, *rest = line.split(b"\t")
                    if not rest:
                        total = block.setdefault((lang, b""), {})
                        total[None] = total.get(None, 0) + int(prefix)
                        continue
                    items = rest[0].split(b" ")
                    counts = dict(zip(items[::2], map(int, items[1::2]), strict=True))
                    stripe = block.get((lang, prefix))
                    if stripe is None:
                        block[lang, prefix] = counts
                        continue
                    for w, n in counts.items():
                        stripe[w] = stripe.get(w, 0) + n
        if now is not None:
            yield entries(block)

    return found.repartition("block").sortWithinPartitions("block").mapInArrow(run, ENTRY)


def frequencies(spark: SparkSession, docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, m, a) of all phrases of 1 to LONGEST words with at least ``least`` occurrences, and (lang, n)."""
    ship_package(spark)
    entries = staged(spark, merged(stripes(docs, frequent_table(spark, docs, least)), least), "stripes")
    prefix, word = F.col("prefix").cast("string"), F.col("word").cast("string")
    phrase = F.when(F.length("prefix") == 0, word).otherwise(F.concat(prefix, F.lit(" "), word))
    frequent = entries.where("word is not null").select("lang", phrase.alias("phrase"), F.col("n").alias("a"))
    frequent = frequent.withColumn("m", F.size(F.split("phrase", " ", -1))).select("lang", "phrase", "m", "a")
    return frequent, entries.where("word is null and n > 0").select("lang", "n")


def scored(frequent: DataFrame, cover: int = COVER) -> DataFrame:
    """lang, phrase, a, l, r, score of candidates that no longer phrase covers; the lowest-scoring cut counts."""
    words = F.split("phrase", " ", -1)
    part = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    longer = frequent.where("m >= 3").select("lang", "a", F.explode(F.array(
        F.expr("substring_index(phrase, ' ', m - 1)"), F.expr("substring_index(phrase, ' ', 1 - m)"))).alias("phrase"))
    covers = longer.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    held = frequent.where("m >= 2").join(covers, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (F.col("most").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * cover))
    cuts = held.select("lang", "phrase", "m", "a", words.alias("w"), F.explode(F.expr("sequence(1, m - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("m") - F.col("k")).alias("rest"))
    f = frequent.select("lang", "phrase", "a")
    both = cuts.join(f.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l")), ["lang", "first"]).join(
        f.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"])
    # 2,000,000 a has 27 digits at most; a <= l, r, so the quotient is at most 1,000,000.
    score = F.expr("cast((cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as bigint)")
    best = both.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.score", "cut.k")


def collocations(spark: SparkSession, docs: DataFrame, least: int = LEAST, cover: int = COVER, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, k: the ``top`` phrases of each language, k the number of words before the cut."""
    frequent, totals = frequencies(spark, docs, least)
    found = staged(spark, scored(frequent, cover), "scored")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # The first of each of _SALTS shares of a language, then of these.
    salt = F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))
    few = found.withColumn("salt", salt).withColumn("at", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))).where(F.col("at") <= top)
    ranked = few.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "k")


def op11_stripes_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of every language of documents: lang, rank, phrase, a, l, r, n, score."""
    return collocations(spark, spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("k")


ORACLE = r"""with docs as (
  select coalesce(lang, 'und') as lang, regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]') as pieces from documents where text is not null),
pieces as (select lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') as w from (select lang, unnest(pieces) as p from docs)),
grams as (
  select lang, m, array_to_string(w[i:i + m - 1], ' ') as phrase
  from (select lang, w, m, unnest(range(1, len(w) - m + 2)) as i from pieces, (select unnest([1, 2, 3, 4]) as m) where len(w) >= m)),
f as (select lang, phrase, m, count(*) as a from grams group by all having count(*) >= 30),
totals as (select lang, sum(len(w)) as n from pieces group by lang),
cand as (select *, string_split(phrase, ' ') as w from f where m >= 2),
inner_parts as (
  select lang, array_to_string(w[i:i + k - 1], ' ') as phrase, a
  from (select lang, w, a, k, unnest(range(1, m - k + 2)) as i from cand, (select unnest([2, 3]) as k) where k < m)),
covers as (select lang, phrase, max(a) as most from inner_parts group by lang, phrase),
cuts as (
  select lang, phrase, a, w, m, unnest(range(1, m)) as k from cand left join covers using (lang, phrase)
  where most is null or 100 * cast(most as hugeint) < 80 * cast(a as hugeint)),
scores as (
  select c.lang, c.phrase, c.a, c.k, x.a as l, y.a as r, (2000000 * cast(c.a as hugeint)) // (x.a + y.a) as score
  from cuts c join f x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:c.k], ' ')
  join f y on y.lang = c.lang and y.phrase = array_to_string(c.w[c.k + 1:], ' ')),
best as (select * from scores qualify row_number() over (partition by lang, phrase order by score, k) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from best)
select lang, cast(rank as bigint) as rank, phrase, a, l, r, cast(n as bigint) as n, cast(score as bigint) as score
from ranked join totals using (lang) where rank <= 2000"""
