"""Best-fit packing of tokenised documents by length patterns.

A document is its token ids and one end id. Longer ones than a sequence are
cut into full pieces and a rest. Pieces are packed by length only, so the plan
is made from the histogram of lengths, whose size is bounded by the sequence
length, never by the corpus:

1. Lengths are rounded up to a grid. Patterns of at most three grid lengths
   that fill a sequence are enumerated, and non-negative least squares fits
   their repeat counts to the grid histogram. The counts are rounded down.
2. Each pattern takes real lengths of its grid cells, the longest first, and as
   the last of several the longest that fits the room exactly left.
3. What is left is packed best-fit decreasing, first into the room the
   patterns leave, then into new sequences. Sequences of equal room and equal
   lengths to place are handled as counts.

The plan gives each length a list of slots with ranges of ranks. A piece gets
its slot by its rank among the pieces of its length: its rank in its task plus
the counts of the tasks before, so a length that a third of all pieces share
is not gathered anywhere.

Defined cases: a null text is empty, an empty text is its end id alone; rows
that share a doc_id are pieces of their own; a null doc_id is kept.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import give_back, text_batches, written

SEQUENCE = 4096
END_ID = 1
GRID = 64          # cells of the length grid
WORDS_KEPT = 300_000   # bound of each memo of a worker
LONGEST = 100          # bytes of a word or chunk that a memo keeps
BATCH = 2_000_000      # characters tokenised at once, or one text

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long"


def _pieces_of(data: bytes | np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The pieces of ``data`` that lie one after the other and end at ``ends``."""
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.Array.from_buffers(kind, len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _flat(pieces: pa.Array) -> tuple[np.ndarray, pa.Buffer]:
    """Offsets and bytes of an array that ``take`` made."""
    _, offsets, data = pieces.buffers()
    return np.frombuffer(offsets, np.int64)[:len(pieces) + 1] if len(pieces) else np.zeros(1, np.int64), data


class ChunkTokenizer:
    """Token ids of texts, by distinct chunk between blanks and line ends.

    The tokenizer's normaliser turns white space into blanks and its
    pre-tokenizer splits there, so chunks are encoded independently, each
    distinct one of a batch once. Chunks of Latin letters are split on, as the
    pre-tokenizer's own pattern does, into words; words not in the memo are
    encoded many at a time and told apart by the word-end mark of their last
    id. They are in the normaliser's form already, which is left out. Any other
    chunk is encoded by itself, as is one that holds the literal of an added
    token, such as ``<|endoftext|>``. The memos keep what came first, which is
    what is frequent, when they are full.

    Chunks and words are Arrow arrays, each with the blank behind it, and ids
    are gathered by ``take``, so no Python object is made per chunk."""

    # fixed value: the split pattern of the tokenizer file
    WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    LATIN = 0x250      # code points below are split here
    SPACE, LETTER, DIGIT, MARK = range(4)

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer, pre_tokenizers
        from tokenizers.normalizers import Sequence
        self.tok = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        # for words: nothing to normalise, and a blank, written so by the byte level, between them;
        # the model is shared, and no added token is a word
        self.word_tok = Tokenizer(self.tok.model)
        self.word_tok.normalizer = Sequence([])
        self.word_tok.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            pre_tokenizers.Split("\u0120", "removed")])
        latin = [chr(c) for c in range(self.LATIN)]
        self.kinds = np.array([self.SPACE if regex.match(r"\s", c) else self.LETTER if regex.match(r"\p{L}", c)
                               else self.DIGIT if regex.match(r"\p{N}", c) else self.MARK for c in latin], np.uint8)
        # those of them whose small letter is not
        self.far = np.array([ord(c) for c in latin if max(map(ord, c.lower())) >= self.LATIN], np.uint32)
        self.words = pa.array([], pa.large_string())
        self.word_ids = pa.array([], pa.large_binary())
        self.others: dict[str, bytes] = {}

    def _encode(self, tok, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, dtype="<u4") for e in tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _split(self, chunks: str) -> tuple[pa.Array, np.ndarray]:
        """Words of ``chunks``, each with a blank behind it, and how many of
        them lie before the end of each chunk."""
        codes = np.frombuffer(chunks.lower().encode("utf-32-le"), "<u4")
        kind = self.kinds[codes]
        # two code points of room, so that a look ahead stays inside
        before, after = np.concatenate([[self.SPACE], kind[:-1]]), np.concatenate([codes, [32, 32]])
        first = (kind != self.SPACE) & ((kind != before) | (kind == self.DIGIT))
        # an apostrophe that begins its run of marks, and the letters it takes
        quote = np.flatnonzero(first & (codes == ord("'")))
        x, y = after[quote + 1], after[quote + 2]
        one = quote[np.isin(x, [ord(c) for c in "stmd"])]
        two = quote[((x == ord("r")) & (y == ord("e"))) | ((x == ord("v")) & (y == ord("e")))
                    | ((x == ord("l")) & (y == ord("l")))]
        for at, n in ((one, 1), (two, 2)):
            first[at + 1] = False
            rest = at + 1 + n
            first[rest[kind[rest] == self.LETTER]] = True
        starts = np.flatnonzero(first)
        held = kind != self.SPACE
        spaced = np.insert(codes[held], np.cumsum(held)[starts] - 1, 32)
        data = np.roll(spaced, -1).astype("<u4").tobytes().decode("utf-32-le").encode()
        ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 32) + 1
        return _pieces_of(data, ends, pa.large_string()), np.searchsorted(starts, np.flatnonzero(codes == 32))

    def _encode_words(self, words: list[str]) -> pa.Array:
        """Ids of each of ``words``, which have a blank behind each."""
        parts = [self._encode(self.word_tok, ["".join(words[i:i + 200])])[0] for i in range(0, len(words), 200)]
        ids = np.concatenate([np.zeros(0, "<u4"), *parts])
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words):
            raise ValueError(f"{len(words)} words were encoded as {len(ends)}")
        return _pieces_of(ids.tobytes(), 4 * ends, pa.large_binary())

    def _latin(self, chunks: str) -> pa.Array:
        """Ids of each of ``chunks``, which have a blank behind each."""
        words, upto = self._split(chunks)
        words = words.dictionary_encode()
        known = pc.index_in(words.dictionary, value_set=self.words)
        new = words.dictionary.filter(known.is_null())
        new_ids = self._encode_words(new.to_pylist())
        place = known.fill_null(-1).to_numpy().astype(np.int64)
        place[place < 0] = len(self.words) + np.arange(len(new))
        all_ids = pa.concat_arrays([self.word_ids, new_ids])
        offsets, data = _flat(all_ids.take(pa.array(place[words.indices.to_numpy()])))
        short = pc.less_equal(pc.binary_length(new), LONGEST)
        self.words = pa.concat_arrays([self.words, new.filter(short)])
        self.word_ids = pa.concat_arrays([self.word_ids, new_ids.filter(short)])
        return _pieces_of(data, offsets[upto], pa.large_binary())

    def _other(self, chunks: list[str]) -> pa.Array:
        new = [c for c in chunks if c not in self.others]
        made = {}
        for i in range(0, len(new), 500):
            part = new[i:i + 500]
            made.update(zip(part, (e.tobytes() for e in self._encode(self.tok, part)), strict=True))
        ids = pa.array([made[c] if c in made else self.others[c] for c in chunks], pa.large_binary())
        self.others.update((c, e) for c, e in made.items() if len(c) <= LONGEST)
        return ids

    def trim(self) -> None:
        if len(self.words) > WORDS_KEPT:
            # copied, for a slice would hold the whole
            first = pa.array(np.arange(WORDS_KEPT // 2))
            self.words, self.word_ids = self.words.take(first), self.word_ids.take(first)
        if len(self.others) > WORDS_KEPT:
            self.others = dict(islice(self.others.items(), WORDS_KEPT // 2))

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        if not texts:
            return []
        self.trim()
        raw = [t.encode() for t in texts]
        text_ends = np.cumsum([len(r) + 1 for r in raw])
        data = b" ".join([*raw, b""]).replace(b"\n", b" ")
        ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 32) + 1
        chunks = _pieces_of(data, ends, pa.large_string()).dictionary_encode()
        distinct = _flat(chunks.dictionary)[1].to_pybytes().decode()
        codes = np.frombuffer(distinct.encode("utf-32-le"), "<u4")
        chunk_ends = np.flatnonzero(codes == 32)
        other = np.zeros(len(chunk_ends), dtype=bool)
        other[np.searchsorted(chunk_ends, np.flatnonzero((codes >= self.LATIN) | np.isin(codes, self.far)))] = True
        for t in self.added:
            if t in distinct:
                other |= pc.match_substring(chunks.dictionary, t).to_numpy(zero_copy_only=False)
        apart = [c[:-1] for c in chunks.dictionary.filter(pa.array(other)).to_pylist()]
        if apart:
            distinct = codes[~np.repeat(other, np.diff(chunk_ends, prepend=-1))].tobytes().decode("utf-32-le")
        by_chunk = pa.concat_arrays([self._latin(distinct), self._other(apart)])
        place = np.cumsum(~other) - 1
        place[other] = len(other) - len(apart) + np.arange(len(apart))
        offsets, flat = _flat(by_chunk.take(pa.array(place[chunks.indices.to_numpy()])))
        cuts = np.concatenate([[0], offsets[np.searchsorted(ends, text_ends) + 1]]).tolist()
        flat = memoryview(flat) if flat else b""
        return [bytes(flat[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]


_TOKENIZERS: dict[str, ChunkTokenizer] = {}


def tokenizer(path: str) -> ChunkTokenizer:
    """This worker's tokenizer; its memos serve every task of the worker."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = ChunkTokenizer(path)
    return _TOKENIZERS[path]


def _batches(batches: Iterator[pa.RecordBatch], most: int = BATCH) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of the rows, of at most ``most`` characters, or of one text."""
    ids, texts, size = [], [], 0
    for b in batches:
        for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            t = t or ""
            # a text and the blank behind it
            if texts and size + len(t) + 1 > most:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(d)
            texts.append(t)
            size += len(t) + 1
    if texts:
        yield ids, texts


def tokenised_pieces(docs: DataFrame, path: str, sequence: int = SEQUENCE) -> DataFrame:
    """One row per piece, with the task that made it and its rank among that
    task's pieces of its length."""
    text_batches(docs.sparkSession)
    end = np.asarray([END_ID], dtype="<u4").tobytes()

    def run(batches):
        tok = tokenizer(path)
        task = TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for ids, texts in _batches(batches):
            out: dict[str, list] = {k: [] for k in ("d", "p", "s", "n", "c", "r")}
            for d, raw in zip(ids, tok.ids(texts), strict=True):
                raw += end
                n = len(raw) // 4
                for k, s in enumerate(range(0, n, sequence)):
                    part = raw[4 * s:4 * (s + sequence)]
                    size = len(part) // 4
                    for c, v in zip("dpsncr", (d, k, s, size, zlib.crc32(part), seen[size]), strict=True):
                        out[c].append(v)
                    seen[size] += 1
            yield pa.RecordBatch.from_arrays([
                pa.array(out["d"], pa.int64()), pa.array(out["p"], pa.int32()),
                pa.array(out["s"], pa.int64()), pa.array(out["n"], pa.int64()),
                pa.array(out["c"], pa.int64()), pa.array([task] * len(out["d"]), pa.int32()),
                pa.array(out["r"], pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "rank"])
        tok.trim()
        give_back()

    return docs.mapInArrow(run, _PIECES)


# ---------------------------------------------------------------------------
# the plan: driver work bounded by the histogram
# ---------------------------------------------------------------------------

def patterns(cells: int = GRID) -> list[tuple[int, ...]]:
    """Multisets of one to three cell lengths that sum to ``cells``, longest first."""
    out = [(cells,)]
    out += [(a, cells - a) for a in range((cells + 1) // 2, cells)]
    out += [(a, b, cells - a - b) for a in range(1, cells) for b in range(1, a + 1)
            if 1 <= cells - a - b <= b]
    return out


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 3000) -> np.ndarray:
    """Non-negative least squares by accelerated projected gradient."""
    step = 1.0 / max(np.linalg.norm(a, 2) ** 2, 1e-12)
    x = y = np.zeros(a.shape[1])
    t = 1.0
    for _ in range(rounds):
        z = np.maximum(0.0, y - step * (a.T @ (a @ y - b)))
        t, was = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        y, x = z + (was - 1) / t * (z - x), z
    return x


def plan(histogram: dict[int, int], sequence: int = SEQUENCE, cells: int = GRID) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences), using up ``histogram``."""
    left = {n: c for n, c in histogram.items() if c > 0}
    cell = -(-sequence // cells)
    cells = sequence // cell            # whole cells that fit
    by_cell: dict[int, list[int]] = defaultdict(list)
    for n in sorted(left):
        by_cell[-(-n // cell)].append(n)    # beyond the last cell: left to the residue
    pats = patterns(cells)
    a = np.zeros((cells, len(pats)))
    for j, p in enumerate(pats):
        for c in p:
            a[c - 1, j] += 1
    b = np.array([sum(left[n] for n in by_cell[c + 1]) for c in range(cells)], dtype=float)
    fit = np.floor(nnls(a, b / max(b.max(), 1.0)) * max(b.max(), 1.0) + 1e-6).astype(np.int64)

    open_: dict[tuple[int, ...], int] = defaultdict(int)
    have = np.zeros(sequence + 1, dtype=np.int64)
    for n, c in left.items():
        have[n] = c

    def take(pattern: tuple[int, ...], most: int) -> int:
        """Sequences made of ``pattern``: the longest pieces of its cells, and
        as the last of several the longest piece that fits the room."""
        got: list[int] = []
        for k, c in enumerate(pattern):
            last = k and k == len(pattern) - 1
            lo, hi = ((c - 1) * cell + 1, sequence - sum(got)) if last else ((c - 1) * cell + 1, c * cell)
            there = np.flatnonzero(have[lo:hi + 1])
            if not len(there):
                break
            got.append(lo + int(there[-1]))
            have[got[-1]] -= 1
        for n in got:
            have[n] += 1
        if len(got) < len(pattern):
            return 0
        many = min(most, *[int(have[n]) // got.count(n) for n in got])
        for n in got:
            have[n] -= many
        open_[tuple(got)] += many
        return many

    for j in sorted(range(len(pats)), key=lambda j: -int(fit[j])):
        todo = int(fit[j])
        while todo > 0 and (made := take(pats[j], todo)):
            todo -= made
    left = {n: int(have[n]) for n in left}

    # best-fit decreasing over counts: rooms[r] holds the sequences with r ids of room
    rooms: dict[int, dict[tuple[int, ...], int]] = defaultdict(lambda: defaultdict(int))
    for p, c in open_.items():
        rooms[sequence - sum(p)][p] += c
    for n in sorted((n for n in left if left[n]), reverse=True):
        todo = left[n]
        while todo:
            r = min((r for r in rooms if r >= n and rooms[r]), default=None)
            if r is None:
                per = min(sequence // n, todo)
                many = todo // per
                p = (n,) * per
                rooms[sequence - n * per][p] += many
                todo -= many * per
                continue
            p, c = next(iter(rooms[r].items()))
            many = min(c, todo)
            rooms[r][p] -= many
            if not rooms[r][p]:
                del rooms[r][p]
            rooms[r - n][p + (n,)] += many
            todo -= many
        left[n] = 0
    return [(p, c) for per in rooms.values() for p, c in per.items() if c]


def slots(packed: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, first sequence, offset), by first rank."""
    used: dict[int, int] = defaultdict(int)
    out: dict[int, list] = defaultdict(list)
    base = 0
    for lengths, count in packed:
        at = 0
        for n in lengths:
            out[n].append((used[n], base, at))
            used[n] += count
            at += n
        base += count
    return {n: np.array(v, dtype=np.int64) for n, v in out.items()}


def pack(docs: DataFrame, path: str, sequence: int = SEQUENCE, cells: int = GRID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of the
    pieces of ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    pieces = written(tokenised_pieces(docs.select("doc_id", "text"), path, sequence), "pieces")
    counts = written(pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    # at most one row per possible length
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(slots(plan(histogram, sequence, cells)))
    from pyspark.sql import Window
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # the counts grow with the tasks, so they are not left to be broadcast
    placed = pieces.join(starts.hint("merge"), ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("rank")).alias("rank"))

    def place(batches):
        per = table.value
        for b in batches:
            n = b.column("length").to_numpy()
            rank = b.column("rank").to_numpy()
            seq = np.empty(len(n), dtype=np.int64)
            off = np.empty(len(n), dtype=np.int64)
            order = np.argsort(n, kind="stable")
            cuts = np.flatnonzero(np.diff(n[order])) + 1
            for own in np.split(order, cuts) if len(n) else []:
                t = per[int(n[own[0]])]
                k = np.searchsorted(t[:, 0], rank[own], side="right") - 1
                seq[own] = t[k, 1] + rank[own] - t[k, 0]
                off[own] = t[k, 2]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
                + [pa.array(seq), pa.array(off)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return placed.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                    "sequence_id long, offset long")


def op9_pattern_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))
