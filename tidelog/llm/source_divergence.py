"""Source divergence audit by in-mapper stripes.

How differently do the sources of a language use its vocabulary? Every task
folds whole documents into stripes, a hash entry for each (language, term): the
number of documents that hold the term, and its occurrences by source. Stripes are
spilled as rows when a task holds ``STRIPE_ENTRIES`` of them and at its end. Rows
are sorted by key and merged as a stream; terms in too few documents of the
language go. So a term of every document is one row per spill, not per document.

Sums over the merged stripes give each group's total and each language's
vocabulary. Then the stripes emit the divergences directly: the sources of
a language are cut into blocks of ``BLOCK``, each pair of blocks is a tile, and
a task adds up absolute differences of smoothed shares in one dense matrix per
tile, many stripes at a time. A header row, sorted before the stripes of its tile,
brings names and totals, so that nothing is broadcast however many sources there
are. Stripes of a tile are dealt by term over several tasks.

Shares are whole numbers of billionths, from a long division in steps of a
thousand, exact while a total is below 9.2e15.

Defined cases: null text, language or source is the empty one; a text without
terms makes its group occur; a language without kept terms has pairs of value 0;
a language of one source has no pairs; rows that share an id, or repeat, are
documents of their own; a very long text is folded in slices that cut no term;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import give_back, text_batches, written

MIN_DOCS = 30
SMOOTHING = 5
UNITS = 1_000_000_000
RANKS = 50
STRIPE_ENTRIES = 300_000    # entries of a task's stripes before they are spilled
BLOCK = 256                 # sources in a block
CHUNK = 512                 # stripes compared at once
STRIPES_PER_TASK = 4_000
ROWS = 20_000               # rows of a batch of stripes
SLICE = 1 << 22

_LETTERS = bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
# letters in lower case, everything else a blank; bytes of other letters stay
_FOLD = bytes(ord(chr(i).lower()) if i < 0x80 else i for i in range(256)).translate(
    bytes(i if i in _LETTERS else 0x20 for i in range(256)))

_STRIPE = "lang string, term binary, docs long, stripe array<struct<source:string,count:long>>"


def terms(raw: bytes) -> list[bytes]:
    """Terms of a UTF-8 text: runs of letters of A to Z, in lower case, and of
    characters beyond ASCII."""
    return raw.translate(_FOLD).split()


def _slices(raw: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, about ``SLICE`` bytes at a time."""
    if len(raw) <= SLICE:
        yield terms(raw)
        return
    folded, lo = raw.translate(_FOLD), 0
    while lo < len(folded):
        hi = folded.find(b" ", lo + SLICE)
        hi = len(folded) if hi < 0 else hi
        yield folded[lo:hi].split()
        lo = hi


class Stripes:
    """Stripes of one task."""

    def __init__(self):
        self.docs: dict[str, Counter] = defaultdict(Counter)
        self.counts: dict[str, dict[str, Counter]] = defaultdict(lambda: defaultdict(Counter))

    def add(self, lang: str, source: str, raw: bytes) -> None:
        counts = self.counts[lang][source]
        if len(raw) <= SLICE:
            found = terms(raw)
            counts.update(found)
            self.docs[lang].update(set(found))
            return
        seen: set[bytes] = set()
        for found in _slices(raw):
            counts.update(found)
            seen.update(found)
        self.docs[lang].update(seen)

    def entries(self) -> int:
        return sum(len(c) for by in self.counts.values() for c in by.values())

    def spill(self) -> Iterator[pa.RecordBatch]:
        """All stripes as rows. A row without a term names the groups there are."""
        for lang, by in self.counts.items():
            names = pa.array(list(by), pa.string())
            yield _rows([lang], [None], [0], pa.array([0, len(by)], pa.int32()), names, np.zeros(len(by), dtype=np.int64))
            docs = self.docs[lang]
            if not docs:
                continue
            at = dict(zip(docs, range(len(docs)), strict=True))
            term = np.concatenate([np.fromiter(map(at.__getitem__, c), np.int64, len(c)) for c in by.values()])
            count = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for c in by.values()])
            source = np.repeat(np.arange(len(by)), [len(c) for c in by.values()])
            order = np.argsort(term, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(docs)))])
            whole = _rows([lang] * len(docs), list(docs), np.fromiter(docs.values(), np.int64, len(docs)),
                          pa.array(ends, pa.int32()), names.take(pa.array(source[order])), count[order])
            for lo in range(0, len(docs), ROWS):
                yield whole.slice(lo, ROWS)
        self.docs.clear()
        self.counts.clear()


def _rows(lang, term, docs, ends: pa.Array, source: pa.Array, count: np.ndarray) -> pa.RecordBatch:
    """Stripe rows; stripe i has the entries from ``ends[i]`` to ``ends[i + 1]``."""
    stripe = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([source, pa.array(count)], ["source", "count"]))
    return pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.string()), pa.array(term, pa.binary()), pa.array(docs, pa.int64()), stripe],
        names=["lang", "term", "docs", "stripe"])


class _Entries:
    """The entries of some stripes: row, code of the source, and count of each."""

    def __init__(self, stripe: pa.ListArray):
        flat = stripe.flatten()
        coded = flat.field("source").dictionary_encode()
        self.names = coded.dictionary
        self.code = coded.indices.to_numpy(zero_copy_only=False)
        self.count = flat.field("count").to_numpy(zero_copy_only=False)
        self.row = np.repeat(np.arange(len(stripe)), stripe.value_lengths().to_numpy(zero_copy_only=False))


def _in_large_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= ROWS:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def stripes(docs: DataFrame, entries: int = STRIPE_ENTRIES) -> DataFrame:
    """Spilled stripes of ``docs(text, lang, source)``."""
    text_batches(docs.sparkSession)
    often = min(SLICE, 16 * entries)    # counting entries is cheap, but not for each text

    def run(batches):
        held, since = Stripes(), 0
        for b in batches:
            langs, sources = b.column("lang").to_pylist(), b.column("source").to_pylist()
            for lang, source, raw in zip(langs, sources, b.column("text").cast(pa.binary()).to_pylist(), strict=True):
                held.add(lang, source, raw)
                since += len(raw)
                if since > often:
                    since = 0
                    if held.entries() > entries:
                        yield from held.spill()
        yield from held.spill()
        give_back()

    filled = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    return filled.mapInArrow(run, _STRIPE)


def merged_stripes(docs: DataFrame, min_docs: int = MIN_DOCS, entries: int = STRIPE_ENTRIES) -> DataFrame:
    """One row per kept (lang, term), and one per language without a term that
    names its groups."""
    def merge(t: pa.Table, last: bool):
        """Merged rows of the runs of equal keys, and the rows of the last run
        if it may go on."""
        lang, term, docs, stripe = (t.column(c).combine_chunks() for c in ("lang", "term", "docs", "stripe"))
        is_group = pc.is_null(term).to_numpy(zero_copy_only=False)
        key = pc.fill_null(term, b"")       # no term is empty
        new = np.ones(len(lang), dtype=bool)
        new[1:] = pc.or_(pc.not_equal(lang[1:], lang[:-1]), pc.not_equal(key[1:], key[:-1])).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(new)
        rest = None
        if not last:
            rest = t.slice(starts[-1])
            starts, n = starts[:-1], starts[-1]
        else:
            n = len(lang)
        if not len(starts):
            return None, rest
        total = np.add.reduceat(docs.to_numpy(zero_copy_only=False)[:n], starts)
        keep = (total >= min_docs) | is_group[starts]
        run = np.repeat(np.cumsum(keep) - 1, np.diff(np.append(starts, n)))    # place of a row's run among the kept
        rows = np.flatnonzero(np.repeat(keep, np.diff(np.append(starts, n))))
        if not len(rows):
            return None, rest
        e = _Entries(stripe.take(pa.array(rows)))
        place = run[rows][e.row] * len(e.names) + e.code
        order = np.argsort(place, kind="stable")
        firsts = np.flatnonzero(np.append(True, np.diff(place[order]) != 0))
        count = np.add.reduceat(e.count[order], firsts)
        owner, code = np.divmod(place[order][firsts], len(e.names))
        ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=int(keep.sum())))])
        at = pa.array(starts[keep])
        return _rows(lang.take(at), term.take(at), total[keep], pa.array(ends, pa.int32()),
                     e.names.take(pa.array(code)), count), rest

    def run(batches):
        rest = None
        for t in _in_large_batches(batches):
            t = t if rest is None else pa.concat_tables([rest, t])
            merged, rest = merge(t, False)
            if merged is not None:
                yield merged
        if rest is not None:
            merged, _ = merge(rest, True)
            if merged is not None:
                yield merged
        give_back()

    dealt = stripes(docs, entries).repartition("lang", "term").sortWithinPartitions("lang", "term")
    return dealt.mapInArrow(run, _STRIPE)


# ---------------------------------------------------------------------------
# divergences
# ---------------------------------------------------------------------------

def shares(counts: np.ndarray, totals: np.ndarray, vocabulary: int) -> np.ndarray:
    """1 + floor(UNITS * (count + SMOOTHING) / (total + SMOOTHING * vocabulary)),
    exactly: a long division by three digits of a thousand."""
    below = totals + SMOOTHING * vocabulary
    out, rest = np.divmod(counts + SMOOTHING, below)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, below)
        out = out * 1000 + digit
    return out + 1


class _Tile:
    """Sums of one pair of source blocks of a language."""

    def __init__(self, header: dict, ranks: int):
        self.lang, self.first, self.ranks = header["lang"], header["salt"] == 0, ranks
        self.vocabulary, self.total = header["vocabulary"], header["total"]
        sides = [[e for e in header["sources"] if e["block"] == t] for t in sorted(set(header["tile"]))]
        self.names = [[e["source"] for e in side] for side in sides]
        self.totals = [np.array([e["total"] for e in side], dtype=np.int64) for side in sides]
        self.place = [{n: i for i, n in enumerate(side)} for side in self.names]
        self.sums = np.zeros((len(sides[0]), len(sides[-1])), dtype=np.int64)
        self.same = len(sides) == 1
        self.seen = False

    def _dense(self, side: int, e: _Entries, n: int) -> np.ndarray:
        at = np.array([self.place[side].get(s, -1) for s in e.names.to_pylist()], dtype=np.int64)[e.code]
        here = at >= 0
        out = np.zeros((n, len(self.names[side])), dtype=np.int64)
        out[e.row[here], at[here]] = e.count[here]
        return out

    def compare(self, term: pa.Array, stripe: pa.ListArray):
        """Adds stripes to the sums; rows of the terms that a source uses more."""
        self.seen = True
        n, e = len(term), _Entries(stripe)
        counts = self._dense(0, e, n)
        p = shares(counts, self.totals[0], self.vocabulary)
        q = p if self.same else shares(self._dense(1, e, n), self.totals[1], self.vocabulary)
        for i in range(len(self.names[0])):
            self.sums[i] += np.abs(p[:, i:i + 1] - q).sum(axis=0)
        if not self.same:       # each block of sources is in one such tile
            return
        whole = np.zeros(n, dtype=np.int64)
        np.add.at(whole, e.row, e.count)
        more = np.where(counts > 0, p - shares(whole, np.int64(self.total), self.vocabulary)[:, None], 0)
        for j, name in enumerate(self.names[0]):
            value = more[:, j]
            if n > self.ranks:      # what so many of these stripes exceed is in no report
                value = np.where(value >= np.partition(value, -self.ranks)[-self.ranks], value, 0)
            rows = np.flatnonzero(value > 0)
            if len(rows):
                yield _emitted(self.lang, [name] * len(rows), "term",
                               term.take(pa.array(rows)).cast(pa.string()), value[rows])

    def pairs(self):
        if not (self.seen or self.first):
            return
        a, b = self.names[0], self.names[-1]
        for i, name in enumerate(a):
            other = [j for j in range(len(b)) if not (self.same and i == j)]
            names, value = [b[j] for j in other], self.sums[i][other]
            if not names:
                continue
            yield _emitted(self.lang, [name] * len(names), "pair", names, value)
            if not self.same:
                yield _emitted(self.lang, names, "pair", [name] * len(names), value)


_EMITTED = "lang string, source string, part string, item string, value long"


def _emitted(lang: str, source: list[str], part: str, item, value: np.ndarray) -> pa.RecordBatch:
    n = len(source)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * n, pa.string()), pa.array(source, pa.string()), pa.array([part] * n, pa.string()),
         pa.array(item, pa.string()), pa.array(value, pa.int64())], names=["lang", "source", "part", "item", "value"])


def _emit(ranks: int):
    def run(batches):
        tile = None
        for b in batches:
            term, stripe = b.column("term"), b.column("stripe")
            heads = np.flatnonzero(pc.is_null(term).to_numpy(zero_copy_only=False)).tolist()
            for lo, hi in zip([0, *heads], [*heads, b.num_rows], strict=True):
                if lo == hi:        # nothing before the first header
                    continue
                if lo in heads:
                    if tile:
                        yield from tile.pairs()
                    tile = _Tile(b.slice(lo, 1).to_pylist()[0], ranks)
                    lo += 1
                for at in range(lo, hi, CHUNK):
                    size = min(CHUNK, hi - at)
                    yield from tile.compare(term.slice(at, size), stripe.slice(at, size))
        if tile:
            yield from tile.pairs()
        give_back()
    return run


def divergences(docs: DataFrame, min_docs: int = MIN_DOCS, ranks: int = RANKS,
                entries: int = STRIPE_ENTRIES) -> DataFrame:
    """(lang, source, part, item, value, rank) of ``docs(text, lang, source)``."""
    merged = written(merged_stripes(docs, min_docs, entries), "stripes")
    kept = merged.where("term IS NOT NULL")
    counted = merged.select("lang", "term", F.explode("stripe").alias("e")).select("lang", "term", "e.*")
    groups = counted.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    vocabulary = merged.groupBy("lang").agg(F.count("term").alias("vocabulary"))
    in_lang = Window.partitionBy("lang").orderBy("source")
    groups = written(groups.withColumn("block", F.floor((F.row_number().over(in_lang) - 1) / BLOCK).cast("int")),
                     "stripe-groups")
    blocks = groups.groupBy("lang", "block").agg(
        F.collect_list(F.struct("source", "total", "block")).alias("sources"), F.sum("total").alias("total"))
    langs = blocks.groupBy("lang").agg(F.sum("total").alias("total"), F.count(F.lit(1)).cast("int").alias("n_blocks"))
    tasks = max(1, ceil(kept.count() / STRIPES_PER_TASK))
    # header rows: the one or two blocks of a tile, once for each of its tasks
    tile = langs.join(vocabulary, "lang").select(
        "*", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("i")).select(
        "*", F.explode(F.sequence(F.col("i"), F.col("n_blocks") - 1)).alias("j"))
    left = blocks.select("lang", F.col("block").alias("i"), F.col("sources").alias("left"))
    right = blocks.select("lang", F.col("block").alias("j"), F.col("sources").alias("right"))
    headers = tile.join(left, ["lang", "i"]).join(right, ["lang", "j"]).select(
        "lang", F.array("i", "j").alias("tile"), F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("salt"),
        F.lit(None).cast("binary").alias("term"), F.lit(None).cast(kept.schema["stripe"].dataType).alias("stripe"),
        "vocabulary", "total",
        F.when(F.col("i") == F.col("j"), F.col("left")).otherwise(F.concat("left", "right")).alias("sources"))
    sent = kept.join(langs.select("lang", "n_blocks"), "lang").select(
        "lang", "term", "stripe", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("i"), "n_blocks").select(
        "lang", "term", "stripe", "i", F.explode(F.sequence(F.col("i"), F.col("n_blocks") - 1)).alias("j")).select(
        "lang", F.array("i", "j").alias("tile"),
        F.pmod(F.xxhash64("term"), F.lit(tasks)).cast("int").alias("salt"), "term", "stripe",
        F.lit(None).cast("long").alias("vocabulary"), F.lit(None).cast("long").alias("total"),
        F.lit(None).cast(headers.schema["sources"].dataType).alias("sources"))
    # nulls first: the header opens its tile
    tiles = headers.unionByName(sent).repartition("lang", "tile", "salt").sortWithinPartitions(
        "lang", "tile", "salt", F.asc_nulls_first("term"))
    emitted = written(tiles.mapInArrow(_emit(ranks), _EMITTED), "divergences")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = (emitted.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
             .withColumn("rank", F.row_number().over(best)))
    used = emitted.where("part = 'term'").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= ranks)
    return pairs.unionByName(used)


def op12_source_divergence(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang", "source")
    return divergences(docs)


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (
  SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
v AS (
  SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT id) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN v USING (lang, term) GROUP BY ALL),
size AS (SELECT lang, count(*) AS v, sum(n) AS n FROM v GROUP BY lang),
total AS (SELECT lang, source, coalesce(sum(n), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
q AS (
  SELECT v.lang, term, 1 + (1000000000 * (v.n::HUGEINT + 5)) // (size.n + 5 * size.v) AS q
  FROM v JOIN size USING (lang)),
p AS (
  SELECT total.lang, total.source, v.term, coalesce(c.n, 0) AS n,
         1 + (1000000000 * (coalesce(c.n, 0)::HUGEINT + 5)) // (total.n + 5 * size.v) AS p
  FROM total JOIN size USING (lang) JOIN v ON v.lang = total.lang
  LEFT JOIN c ON c.lang = total.lang AND c.source = total.source AND c.term = v.term),
pair AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(f, 0) AS f
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
parts AS (
  SELECT lang, source, 'pair' AS part, item, f FROM every
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY f DESC, encode(item)) AS rank FROM parts)
SELECT lang, source, part, item, CAST(f AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""
