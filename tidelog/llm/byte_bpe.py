"""Byte-level BPE: encoding and decoding by DuckDB queries in each partition.

A rank file gives the vocabulary; every way to write a token as two others is
a row of the merge table (left, right, merged), and the merged id is the rank.
A piece of text starts as one token per byte. A recursive query joins the
pieces' neighbouring positions with the merge table and contracts the leftmost
pair of minimum rank of every piece, until no pair joins. Decoding joins
positions with the vocabulary and aggregates the bytes in position order.

A worker holds one in-memory DuckDB database, limited in memory, and memos of
bounded size for texts between blanks: a cut before a blank that follows a
non-blank never parts a match of the split pattern, so what stands between two
such cuts is split and encoded by itself. Texts where a blank follows white
space are split whole.

The recursion holds a copy of a piece per step, so a query takes pieces by the
sum of their squared lengths, and pieces longer than ``LONG`` bytes are cut into
blocks. Blocks are encoded by themselves and joined at seams. A seam holds if the
tokens beside it, joined and encoded, are the same two tokens; tokens of which
all neighbours hold so are the encoding of the whole: contraction restricted to
two neighbours takes the same pairs in the same order, so the first pair across
a seam would be taken there as well. Where a seam doesn't hold, some tokens on
either side are encoded as one piece, and its edges are the new seams; the reach
doubles until all hold. Only texts that repeat with a short period move edges
far. Such a piece is contracted in a table, in steps: all leftmost
non-overlapping pairs of the minimum rank up to the first one whose merged
token would rank lower with a neighbour, which is the same result.

Defined cases: a null text is empty; an empty text has no ids; rows that share
a doc_id are encoded each by itself; a null doc_id is kept.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import give_back, text_batches

LONG = 64               # bytes
BLOCK, BLOCK_OF_THREES = 64, 48     # bytes; of text in letters of three bytes
MEMO = 400_000          # entries of a worker's memo
CHUNK = 20_000          # pieces of one query
SQUARES = 16_000_000    # squared bytes of one query's pieces
MEMORY = "300MB"
SLICE = 1_000_000       # ids decoded at a time

ENCODE = """
WITH RECURSIVE s(w, toks) AS (
  SELECT w, list(tok ORDER BY p) FROM positions GROUP BY w
  UNION ALL
  (WITH pos AS (SELECT w, toks, unnest(range(1, len(toks))) AS p FROM s),
   best AS (SELECT pos.w, min(CAST(m.merged AS BIGINT) * 4294967296 + pos.p) AS k
            FROM pos JOIN merges m ON m.l = toks[p] AND m.r = toks[p + 1] GROUP BY pos.w)
   SELECT s.w, toks[:(k % 4294967296) - 1] || [CAST(k // 4294967296 AS INTEGER)] || toks[(k % 4294967296) + 2:]
   FROM s JOIN best ON best.w = s.w))
SELECT w, arg_min(toks, len(toks)) AS toks FROM s GROUP BY w ORDER BY w
"""

STEP = """
WITH n AS (SELECT p, tok, lag(tok) OVER o AS l, lead(tok) OVER o AS r, lead(tok, 2) OVER o AS rr, row_number() OVER o AS i
           FROM state WINDOW o AS (ORDER BY p)),
c AS (SELECT i, n.l, rr, m.merged FROM n JOIN merges m ON m.l = n.tok AND m.r = n.r),
h AS (SELECT i, l, rr, merged, i - row_number() OVER (ORDER BY i) AS island FROM c
      WHERE merged = (SELECT min(merged) FROM c)),
k AS (SELECT i, l, rr, merged FROM (SELECT *, row_number() OVER (PARTITION BY island ORDER BY i) AS nth FROM h)
      WHERE nth % 2 = 1),
risky AS (SELECT min(k.i) AS i FROM k JOIN merges m
          ON m.merged < k.merged AND (m.l = k.merged AND m.r IN (k.rr, k.merged) OR m.r = k.merged AND m.l = k.l)),
g AS (SELECT i, merged FROM k WHERE i <= coalesce((SELECT i FROM risky), i))
SELECT n.p, coalesce(a.merged, n.tok) AS tok
FROM n LEFT JOIN g a ON a.i = n.i LEFT JOIN g b ON b.i = n.i - 1 WHERE b.i IS NULL
"""

DECODE = """
SELECT from_hex(string_agg(v.hex, '' ORDER BY w, p)) AS raw
FROM positions JOIN vocab v ON v.tok = positions.tok
"""


def _listed(ids: bytes) -> list[int]:
    return np.frombuffer(ids, dtype="<u4").tolist()


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex
        with open(path, "rb") as fh:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, fh)}
        self.find = regex.compile(pattern).findall
        self.iter = regex.compile(pattern).finditer
        self.after_space = regex.compile(r"\s ").search
        self.token = {i: b for b, i in self.ranks.items()}
        left, right, merged = [], [], []
        for b, m in self.ranks.items():
            for k in range(1, len(b)):
                l, r = self.ranks.get(b[:k]), self.ranks.get(b[k:])
                if l is not None and r is not None:
                    left.append(l)
                    right.append(r)
                    merged.append(m)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        int_ = pa.int32()
        self._table("merges", l=pa.array(left, int_), r=pa.array(right, int_), merged=pa.array(merged, int_))
        self._table("vocab", tok=pa.array(list(self.ranks.values()), int_),
                    hex=pa.array([b.hex() for b in self.ranks]))
        self.bytes = np.array([self.ranks.get(bytes([i]), -1) for i in range(256)], dtype=np.int32)
        self.spaced = np.zeros(max(self.ranks.values()) + 1, dtype=bool)
        self.spaced[[i for b, i in self.ranks.items() if b[:1] == b" "]] = True
        self.length = np.zeros(len(self.spaced), dtype=np.int64)
        self.length[list(self.ranks.values())] = [len(b) for b in self.ranks]
        self.words: dict[str, tuple[bytes, bytes]] = {}    # match of the pattern: ids, bytes decoded from them
        self.chunks: dict[str, tuple[bytes, bytes]] = {}   # text after a blank: the same
        self.segments: dict[bytes, bytes] = {}             # ids: bytes
        self.seams: dict[tuple[int, int], bool] = {}       # two tokens: whether they stay apart
        self.passing: set[str] = set()                     # long texts, to be forgotten

    def _table(self, name: str, **columns) -> None:
        arrow = pa.table(columns)  # noqa: F841  read by name
        self.con.execute(f"CREATE OR REPLACE TEMP TABLE {name} AS SELECT * FROM arrow")

    def _positions(self, rows: list[np.ndarray], name: str = "positions") -> None:
        size = np.array([len(r) for r in rows])
        start = np.repeat(np.cumsum(size) - size, size)
        self._table(name, w=np.repeat(np.arange(len(rows), dtype=np.int32), size),
                    p=(np.arange(size.sum()) - start + 1).astype(np.int64),
                    tok=np.concatenate(rows).astype(np.int32))

    def _contract(self, pieces: list[bytes]) -> list[bytes]:
        """Little-endian ids of each piece, by the recursive query."""
        out: list[bytes] = []
        for own in _groups([max(len(b) ** 2, SQUARES // CHUNK) for b in pieces], SQUARES):
            self._positions([self.bytes[np.frombuffer(b, dtype=np.uint8)] for b in pieces[own]])
            lists = self.con.sql(ENCODE).to_arrow_table()["toks"].combine_chunks()
            flat = np.asarray(lists.flatten(), dtype="<u4").tobytes()
            ends = (4 * np.cumsum(np.asarray(lists.value_lengths()))).tolist()
            out += [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        return out

    def _stepwise(self, piece: bytes) -> list[int]:
        """Ids of a piece of any length, contracted in a table."""
        self._positions([self.bytes[np.frombuffer(piece, dtype=np.uint8)]], "state")
        size = -1
        while size != (size := self.con.execute("SELECT count(*) FROM state").fetchone()[0]):
            self.con.execute(f"CREATE OR REPLACE TEMP TABLE state AS {STEP}")
        return self.con.execute("SELECT tok FROM state ORDER BY p").fetchnumpy()["tok"].tolist()

    def _ids(self, pieces: set[bytes]) -> dict[bytes, list[int]]:
        short = [b for b in pieces if len(b) <= 4 * LONG]
        got = dict(zip(short, map(_listed, self._contract(short)), strict=True))
        return got | {b: self._stepwise(b) for b in pieces if len(b) > 4 * LONG}

    def _learn_seams(self, pairs: set[tuple[int, int]]) -> None:
        new = [p for p in pairs if p not in self.seams]
        got = self._contract([self.token[a] + self.token[b] for a, b in new])
        self.seams.update((p, tuple(_listed(ids)) == p) for p, ids in zip(new, got, strict=True))

    def _blockwise(self, pieces: list[bytes]) -> list[bytes]:
        """Little-endian ids of each piece, from blocks joined at seams that hold."""
        blocks = []
        for b in pieces:
            n = BLOCK_OF_THREES if 0xE0 <= b[0] < 0xF0 else BLOCK
            blocks.append([b[i:i + n] for i in range(0, len(b), n)])
        ids = self._ids({x for own in blocks for x in own})
        rows = [[t for x in own for t in ids[x]] for own in blocks]
        seams = [np.cumsum([len(ids[x]) for x in own[:-1]]).tolist() for own in blocks]
        reach = 4
        while any(seams):
            self._learn_seams({(t[i - 1], t[i]) for t, own in zip(rows, seams, strict=True) for i in own})
            spans: list[list[tuple[int, int]]] = []
            for t, own in zip(rows, seams, strict=True):
                spans.append([])
                for i in own:
                    if not self.seams[t[i - 1], t[i]]:
                        lo, hi = max(0, i - reach), min(len(t), i + reach)
                        if spans[-1] and lo <= spans[-1][-1][1]:
                            lo = spans[-1].pop()[0]
                        spans[-1].append((lo, hi))
            raw = [[b"".join(map(self.token.__getitem__, t[lo:hi])) for lo, hi in own]
                   for t, own in zip(rows, spans, strict=True)]
            ids = self._ids({x for own in raw for x in own})
            for n, (t, own) in enumerate(zip(rows, spans, strict=True)):
                row, at, seams[n] = [], 0, []
                for (lo, hi), x in zip(own, raw[n], strict=True):
                    row += t[at:lo]
                    seams[n] += [len(row)] if lo else []
                    row += ids[x]
                    seams[n] += [len(row)] if hi < len(t) else []
                    at = hi
                rows[n] = row + t[at:]
            reach *= 2
        return [np.array(t, dtype="<u4").tobytes() for t in rows]

    def _learn_words(self, new: set[str]) -> None:
        ids: dict[str, bytes] = {}
        todo = []
        for w in new:
            b = w.encode()
            whole = self.ranks.get(b)
            if whole is not None:
                ids[w] = whole.to_bytes(4, "little")
            else:
                todo.append((w, b))
        short, long = [x for x in todo if len(x[1]) <= LONG], [x for x in todo if len(x[1]) > LONG]
        ids.update(zip([w for w, _ in short], self._contract([b for _, b in short]), strict=True))
        if long:
            ids.update(zip([w for w, _ in long], self._blockwise([b for _, b in long]), strict=True))
            self.passing.update(w for w, _ in long)
        self.words.update(zip(ids, zip(ids.values(), self._decoded(list(ids.values())), strict=True), strict=True))

    def _joined(self, words: list[str]) -> tuple[bytes, bytes]:
        both = [self.words[w] for w in words]
        return b"".join([x[0] for x in both]), b"".join([x[1] for x in both])

    def _trim(self) -> None:
        """What came first is what is frequent: it stays when a memo is full.
        Long texts go at once, as memos are bounded by entries."""
        for w in self.passing:
            self.words.pop(w, None)
            self.chunks.pop(w, None)
        self.passing = set()
        for name in ("words", "chunks", "segments", "seams"):
            memo = getattr(self, name)
            if len(memo) > MEMO:
                setattr(self, name, dict(islice(memo.items(), MEMO // 2)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        return [ids for ids, _ in self.encode_decode(texts)]

    def encode_decode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of each text and the bytes decoded from them."""
        self._trim()
        plain = [bool(t) and not t.startswith(" ") and self.after_space(t) is None for t in texts]
        split = [t.split(" ") if ok else None for t, ok in zip(texts, plain, strict=True)]
        seen = set()
        for cs in split:
            seen.update(cs[1:] if cs else ())
        new = [c for c in seen if c not in self.chunks]
        found = [self.find(" " + c) for c in new]
        self._learn_words({w for ws in found for w in ws if w not in self.words}
                          | {w for cs in split if cs for w in self.find(cs[0]) if w not in self.words})
        self.chunks.update(zip(new, map(self._joined, found), strict=True))
        if len(self.passing) or max(map(len, new), default=0) > 4 * LONG:
            self.passing.update(c for c in new if len(c) > LONG)
        get = self.chunks.__getitem__
        out = []
        for t, cs in zip(texts, split, strict=True):
            if cs:
                parts = [self._joined(self.find(cs[0])), *map(get, cs[1:])]
            else:
                parts, it = [], self.iter(t)
                while some := [m.group() for m in islice(it, 100_000)]:
                    self._learn_words({w for w in some if w not in self.words})
                    parts.append(self._joined(some))
            out.append((b"".join([x[0] for x in parts]), b"".join([x[1] for x in parts])))
        return out

    def _decoded(self, ids: list[bytes]) -> list[bytes]:
        """Bytes of each sequence of ids, by the ordered aggregation."""
        out: list[bytes] = []
        for i in range(0, len(ids), CHUNK):
            part = ids[i:i + CHUNK]
            self._positions([np.frombuffer(s, dtype="<u4") for s in part])
            raw = self.con.execute(DECODE).fetchone()[0]
            size = np.add.reduceat(self.length[np.frombuffer(b"".join(part), dtype="<u4")], np.cumsum(
                [0, *[len(s) // 4 for s in part[:-1]]]))
            ends = np.cumsum(size).tolist()
            out += [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        return out

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """Bytes of each sequence of ids, cut before tokens that start with a blank."""
        self._trim()
        split = []
        for raw in ids:
            parts = []
            for lo in range(0, len(raw), 4 * SLICE):
                own = raw[lo:lo + 4 * SLICE]
                cuts = (4 * np.flatnonzero(self.spaced[np.frombuffer(own, dtype="<u4")])).tolist()
                edges = [0, *[c for c in cuts[:1] if c], *cuts[1:], len(own)]
                parts += [own[a:b] for a, b in zip(edges, edges[1:], strict=False)]
            split.append(parts)
        seen = set()
        for parts in split:
            seen.update(parts)
        new = [s for s in seen if s and s not in self.segments]
        self.segments.update(zip(new, self._decoded(new), strict=True))
        self.segments[b""] = b""
        get = self.segments.__getitem__
        return [b"".join(map(get, parts)) for parts in split]


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """This worker's codec; its database and memos serve every task."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def _groups(sizes: list[int], most: int) -> Iterator[slice]:
    lo = total = 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > most:
            yield slice(lo, i)
            lo, total = i, 0
        total += n
    if len(sizes) > lo:
        yield slice(lo, len(sizes))


def _mapped(df: DataFrame, id_col: str, col: str, out: str, f: Callable, empty, most: int) -> DataFrame:
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            values = [empty if v is None else v for v in b.column(1).to_pylist()]
            for own in _groups([len(v) for v in values], most):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(own.start, own.stop - own.start), pa.array(f(values[own]), pa.binary())],
                    names=["id", out])
        give_back()

    text_batches(df.sparkSession)
    return (df.select(F.col(id_col).alias("id"), F.col(col).alias("v"))
            .mapInArrow(run, f"id {kind}, {out} binary").withColumnRenamed("id", id_col))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): token ids of each text as little-endian unsigned 32-bit integers."""
    return _mapped(docs, id_col, text_col, "ids", lambda v: codec(path, pattern).encode(v), "", 2_000_000)


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, raw): the bytes that each sequence of ids stands for."""
    return _mapped(encoded, id_col, ids_col, "raw", lambda v: codec(path, pattern).decode(v), b"", 8_000_000)


def encode_decode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(id, ids, raw): both directions in one pass over the texts."""
    text_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        own_codec = codec(path, pattern)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for own in _groups([len(t) for t in texts], 2_000_000):
                both = own_codec.encode_decode(texts[own])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(own.start, own.stop - own.start), pa.array([x[0] for x in both], pa.binary()),
                     pa.array([x[1] for x in both], pa.binary())], names=["id", "ids", "raw"])
        give_back()

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {kind}, ids binary, raw binary").withColumnRenamed("id", id_col))


def op6_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    both = encode_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("raw", 256).alias("decoded_sha256"))
