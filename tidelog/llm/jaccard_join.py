"""Jaccard join of n-gram sets by PartEnum signatures, and its components.

A text is the set of its distinct word shingles, as 64-bit hashes. Two sets
link when their Jaccard similarity is at least ``NUM / DEN``. Sets of one size
band, or of two neighbouring ones, meet in an instance of PartEnum: similar
sets of sizes s and t differ in at most (DEN - NUM) / (DEN + NUM) * (s + t)
features, k in all. The domain of features is parted by hash into first-level
parts and each of these into ``N2`` sub-parts; the subsets of ``N2 - K2``
sub-parts are enumerated, and each subset gives a signature: the hash of the
set's features in it. With enough first-level parts, k differences can't spoil
all of them, so a similar pair shares a signature.

Empty projections are no signatures, as all small sets would share them. That
is exact by counting: k differences spoil at most ``spoiled(k)`` signatures, so
a set with more non-empty ones keeps a shared one. A set with fewer has each
single feature as a signature as well, of which a similar pair always shares
one. The same count deals with signatures that very many sets share: a set
that has more spare signatures than frequent ones doesn't need the latter. The
others meet on their frequent signatures: first with the smallest set of each
signature, in a join, and then, where members of a signature are not yet in one
component, with all members of other components, in blocks of bounded size.

Equal sets are one class from the start. Signatures travel as byte blocks, one
per task and bucket, whose number follows the corpus; a signature that is
frequent in a task leaves only a mark in its bucket. A block names a set by
some bits of its id, and a signature by some of its hash; what collides is one
candidate more. Candidates whose sketches, counts of features by hash, can't
overlap enough are dropped, links are decided on the whole sets, and components
come from star contraction over the links.

Defined cases: a null text, and one without words, has an empty set and no
links; fewer than ``size`` words are one shingle; rows with a null id are left
out; rows that share an id are one node.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, islice
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import give_back, text_batches, written
from tidelog.llm.components import connected_components

SIZE = 5
NUM, DEN = 75, 100
N2, K2 = 2, 1
WIDEN = 1.2               # first-level parts over the least number
FREQUENT = 16             # members beyond which a signature is frequent
BUCKET_ENTRIES = 500_000  # signatures of a bucket, on average
FLUSH = 1_500_000         # signatures a task holds before it writes blocks
BLOCK = 256               # sets of a block of a family
BATCH_ENTRIES = 250_000   # signatures of the blocks a task writes at a time
GROUP = 60_000            # features whose signatures are made at a time
WORDS_KEPT = 100_000      # word hashes a worker holds in a task
WORDS_LEFT = 60_000       # ... and between tasks
KEY_BITS = 39             # of a set's id, as blocks name it

U = np.uint64


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


# ---------------------------------------------------------------------------
# sets
# ---------------------------------------------------------------------------

class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _Words()


def _trim_words(most: int) -> None:
    """Halves the memo beyond ``most``; what came first is what is frequent."""
    global _WORDS
    if len(_WORDS) > most:
        _WORDS = _Words(islice(_WORDS.items(), most // 2))


def shingle_set(text: str | None, size: int = SIZE) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles of a text: words
    are runs of anything but blanks and control white space, A-Z in lower case."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.empty(0, dtype=U)
    _trim_words(WORDS_KEPT)
    w = np.fromiter(map(_WORDS.__getitem__, words), dtype=U, count=len(words))
    n = max(1, len(w) - size + 1)
    h = np.full(n, min(size, len(w)), dtype=U)
    for i in range(min(size, len(w))):
        h = (h + w[i:i + n]) * U(0x9E3779B97F4A7C15 + 2 * i)
        h ^= h >> U(29)
    return np.unique(_mix(h))


def set_id(features: np.ndarray) -> int:
    import xxhash
    return xxhash.xxh3_64_intdigest(features.tobytes()) - (1 << 63)


def set_key(sid):
    """The bits of a set's id by which blocks name it; joins find the id again."""
    return (sid >> (64 - KEY_BITS)) & ((1 << KEY_BITS) - 1)


def set_key_column(sid: Column) -> Column:
    return F.shiftrightunsigned(sid, 64 - KEY_BITS)


def sketch(features: np.ndarray) -> bytes:
    """Counts of the features by hash, about two in a cell."""
    cells = 1 << max(6, (len(features) // 2).bit_length())
    count = np.bincount((features & U(cells - 1)).astype(np.int64), minlength=cells)
    # a full byte would hide members: such cells make the sketch two bytes wide
    return count.astype(np.uint8).tobytes() if count.max() < 256 else b"w" + count.astype(np.uint16).tobytes()


def _counts(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.uint8) if len(raw) % 2 == 0 else np.frombuffer(raw[1:], dtype=np.uint16)


def may_be_similar(a: bytes, b: bytes) -> bool:
    """Whether the cells' smaller counts, which bound the intersection, leave
    the sets of two sketches similar."""
    a, b = _counts(a).astype(np.int64), _counts(b).astype(np.int64)
    while len(a) > len(b):
        a = a.reshape(2, -1).sum(0)
    while len(b) > len(a):
        b = b.reshape(2, -1).sum(0)
    both = np.minimum(a, b).sum()
    return bool(DEN * both >= NUM * (a.sum() + b.sum() - both))


# ---------------------------------------------------------------------------
# signatures
# ---------------------------------------------------------------------------

@lru_cache(maxsize=4096)
def band_of(size: int) -> int:
    return next(i for i, (lo, hi) in enumerate(bands(size)) if lo <= size <= hi)


@lru_cache(maxsize=4096)
def bands(largest: int) -> tuple[tuple[int, int], ...]:
    """Size ranges [l, l * DEN / NUM], up to the one that holds ``largest`` and the next."""
    out, lo = [], 1
    while not out or out[-1][0] <= largest:
        out.append((lo, lo * DEN // NUM))
        lo = out[-1][1] + 1
    return (*out, (lo, lo * DEN // NUM))


def differences(total: int) -> int:
    """Most features in which two similar sets of ``total`` features together differ."""
    return total * (DEN - NUM) // (DEN + NUM)


@lru_cache(maxsize=4096)
def first_parts(band: int, top: int) -> int:
    k = differences(2 * top)
    return 1 if k == 0 else int(np.ceil(WIDEN * (k + 1) / (K2 + 1)))


def spoiled(k: int, parts: int) -> int:
    """Most signatures that ``k`` features can touch: the first in a
    first-level part touches most, the next less."""
    take, total = N2 - K2, 0
    for j in range(N2):
        hits = min(k, parts)
        total += hits * comb(N2 - 1 - j, take - 1)
        k -= hits
    return total


_SUBSETS = list(combinations(range(N2), N2 - K2))


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of non-empty sets in both their instances: the set's number,
    the instance (0: its own band, 1: the next), the signature; and per set and
    instance how many it can spare (-1: none, its single features are included)."""
    size = np.array([len(x) for x in sets])
    features = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)), size)
    out, spares = [], []
    for which in (0, 1):
        band = np.array([band_of(int(n)) + which for n in size])
        top = np.array([bands(int(n))[b][1] for n, b in zip(size, band, strict=True)])
        parts = np.array([first_parts(int(b), int(t)) for b, t in zip(band, top, strict=True)])
        salt = _mix(band.astype(U) * U(0x9E3779B97F4A7C15) + U(1))
        start = np.cumsum(parts) - parts
        place = _mix(features ^ salt[of])
        cell = (place >> U(32)) * (parts * N2).astype(U)[of] >> U(32)
        total = np.zeros(int(parts.sum()) * N2, dtype=U)
        np.add.at(total, cell.astype(np.int64) + (start * N2)[of], _mix(place + U(1)))
        # one row per first-level part, numbered within its set
        total = total.reshape(-1, N2)
        owner = np.repeat(np.arange(len(sets)), parts)
        number = (np.arange(len(owner)) - start[owner]).astype(U)
        had = np.zeros(len(sets), dtype=np.int64)
        for j, subset in enumerate(_SUBSETS):
            own = total[:, subset].sum(1, dtype=U)
            hit = np.flatnonzero(own)
            who = owner[hit]
            out.append((who, np.full(len(who), which), _mix(
                own[hit] + (number[hit] * U(len(_SUBSETS)) + U(j)) * U(0xD6E8FEB86659FD93) + salt[who])))
            had += np.bincount(who, minlength=len(sets))
        spare = np.array([h - spoiled(differences(int(n) + min(int(t), int(n) * DEN // NUM)), int(p)) - 1
                          for h, n, t, p in zip(had, size, top, parts, strict=True)])
        short = (spare < 0)[of]
        out.append((of[short], np.full(int(short.sum()), which),
                    _mix(features[short] * U(0xC2B2AE3D27D4EB4F) + salt[of[short]])))
        spares.append(np.maximum(spare, -1))
    who, which, sig = (np.concatenate(c) for c in zip(*out, strict=True))
    return who, which, sig, np.stack(spares)


# ---------------------------------------------------------------------------
# blocks of signatures
# ---------------------------------------------------------------------------

# A block's entries: who, the set's key with the instance as lowest bit, in 5
# bytes, and 32 bits of the signature; the bucket holds more bits of it.
_BLOCK = pa.schema([("bucket", pa.int32()), ("kind", pa.int8()), ("who", pa.binary()), ("high", pa.binary()),
                    ("sig", pa.binary()), ("of", pa.binary())])
_BLOCK_DDL = "bucket int, kind tinyint, who binary, high binary, sig binary, of binary"
ENTRIES, MARKS, DIRECT, SPARES = 0, 1, 2, 3


def _block_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _BLOCK, strict=True)], schema=_BLOCK)


def _blocks(made: list[list[np.ndarray]], buckets: int) -> Iterator[pa.RecordBatch]:
    """Blocks of entries (who, sig) and of spares (owner, spare + 1), by bucket.

    ``made`` has the pieces of these four columns, and is emptied: a worker
    shares its executor's memory, so nothing is held here twice for long."""
    who, sig, owner, spare = (np.concatenate(made.pop(0)) for _ in range(4))
    order = np.argsort(sig, kind="stable")
    who = who[order]
    sig = sig[order]
    del order
    run = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1], True])
    size = np.diff(run)
    often = np.repeat(size > FREQUENT, size)
    marks = run[:-1][size > FREQUENT]
    del run, size
    bucket = lambda v: ((v >> U(32)) * U(buckets) >> U(32)).astype(np.int32)

    def block(kind: int, to: int, who: np.ndarray, sig: np.ndarray) -> tuple:
        # a signature's own bucket, where the block is elsewhere
        of = bucket(sig).tobytes() if kind == DIRECT else b""
        return (to, kind, who.astype(np.uint32).tobytes(), (who >> U(32)).astype(np.uint8).tobytes(),
                sig.astype(np.uint32).tobytes(), of)

    def dealt(kind: int, to: np.ndarray, who: np.ndarray, sig: np.ndarray) -> Iterator[tuple]:
        by = np.argsort(to, kind="stable")
        for own in np.split(by, np.flatnonzero(np.diff(to[by])) + 1) if len(to) else []:
            yield block(kind, int(to[own[0]]), who[own], sig[own])

    def blocks() -> Iterator[tuple]:
        # a bucket is a range of signatures
        edge = np.append(np.searchsorted(sig, np.array([-(-(i << 32) // buckets) << 32 for i in range(buckets)], U)), len(sig))
        for i in np.flatnonzero(np.diff(edge)):
            own = slice(edge[i], edge[i + 1])
            rare = ~often[own]
            if rare.any():
                yield block(ENTRIES, int(i), who[own][rare], sig[own][rare])
        # frequent here: members go where their own hash says, the bucket gets a mark
        yield from dealt(DIRECT, bucket(_mix(who[often])), who[often], sig[often])
        yield from dealt(MARKS, bucket(sig[marks]), who[marks], sig[marks])
        yield from dealt(SPARES, bucket(_mix(owner)), owner, spare)

    rows, held = [], 0
    for row in blocks():
        rows.append(row)
        held += len(row[2]) // 4
        if held >= BATCH_ENTRIES:
            yield _block_batch(rows)
            rows, held = [], 0
    if rows:
        yield _block_batch(rows)


def _signature_blocks(docs: DataFrame, buckets: int, size: int) -> DataFrame:
    def run(batches):
        sets, keys, held, seen = [], [], 0, set()
        made: list[list[np.ndarray]] = [[], [], [], []]

        def grouped() -> int:
            n, which, s, spare = signatures(sets)
            key = np.array(keys, dtype=U) * U(2)
            for column, new in zip(made, (key[n] + which.astype(U), s, np.concatenate([key, key + U(1)]),
                                          spare.ravel() + 1), strict=True):
                column.append(new)
            sets.clear()
            keys.clear()
            return len(s)

        features = 0
        for b in batches:
            for text in b.column(0).to_pylist():
                x = shingle_set(text, size)
                if not len(x) or (sid := set_id(x)) in seen:
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(sid)
                sets.append(x)
                keys.append(set_key(sid))
                features += len(x)
                if features >= GROUP:
                    held += grouped()
                    features = 0
                if held >= FLUSH:
                    yield from _blocks(made, buckets)
                    made, held = [[], [], [], []], 0
        if sets:
            grouped()
        if made[0]:
            yield from _blocks(made, buckets)
        _trim_words(WORDS_LEFT)
        give_back()

    return docs.mapInArrow(run, _BLOCK_DDL)


_FOUND = pa.schema([("hot", pa.bool_()), ("x", pa.int64()), ("y", pa.int64()), ("which", pa.int32())])


def _candidates(blocks: pa.Table) -> pa.Table:
    """Of one bucket: pairs of set keys (x, y) that share a signature, and for
    frequent signatures (hot) rows of signature x, set key y and instance. The
    spares of sets pass through, with hot null: spare x, set key y, instance."""
    parts = {k: [] for k in ("kind", "who", "sig", "of")}
    for r in blocks.to_batches():
        for i in range(r.num_rows):
            read = lambda c, t, r=r, i=i: np.frombuffer(r.column(c)[i].as_buffer(), dtype=t)
            sig = read("sig", np.uint32)
            kind = r.column("kind")[i].as_py()
            parts["kind"].append(np.full(len(sig), kind, dtype=np.int8))
            parts["who"].append(read("who", np.uint32).astype(np.int64) | read("high", np.uint8).astype(np.int64) << 32)
            parts["sig"].append(sig)
            parts["of"].append(read("of", np.int32) if kind == DIRECT
                               else np.full(len(sig), r.column("bucket")[i].as_py(), dtype=np.int32))
    kind, who, sig, of = (np.concatenate(parts[k]) for k in ("kind", "who", "sig", "of"))
    named = of.astype(np.int64) << 32 | sig
    direct = kind == DIRECT
    spare = kind == SPARES
    out = [(True, named[direct], who[direct] >> 1, who[direct] & 1),
           (None, sig[spare].astype(np.int64) - 1, who[spare] >> 1, who[spare] & 1)]
    marks = np.unique(sig[kind == MARKS])
    own = kind == ENTRIES
    who, sig, named = who[own], sig[own], named[own]
    order = np.lexsort((who, sig))
    who, sig, named = who[order], sig[order], named[order]
    new = np.r_[True, (np.diff(sig) != 0) | (np.diff(who) != 0)] if len(sig) else np.zeros(0, dtype=bool)
    who, sig, named = who[new], sig[new], named[new]
    edge = np.flatnonzero(np.r_[True, np.diff(sig) != 0]) if len(sig) else np.zeros(0, dtype=np.int64)
    size = np.diff(np.r_[edge, len(sig)])
    frequent = (size > FREQUENT) | np.isin(sig[edge], marks)
    hot = np.repeat(frequent, size)
    out.append((True, named[hot], who[hot] >> 1, who[hot] & 1))
    key = who >> 1
    pairs = []
    for m in range(2, FREQUENT + 1):
        at = edge[(size == m) & ~frequent]
        for i, j in combinations(range(m), 2) if len(at) else []:
            pairs.append(np.stack([key[at + i], key[at + j]], 1))
    if pairs:
        p = np.concatenate(pairs)
        p = np.unique(p[p[:, 0] != p[:, 1]], axis=0)
        out.append((False, p[:, 0], p[:, 1], np.zeros(len(p), dtype=np.int64)))
    return pa.concat_tables(pa.table(
        [pa.array([o[0]] * len(o[1]), pa.bool_()), pa.array(o[1]), pa.array(o[2]), pa.array(o[3].astype(np.int32))],
        schema=_FOUND) for o in out)


# ---------------------------------------------------------------------------
# links
# ---------------------------------------------------------------------------

def set_table(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, n_shingles, sid, sketch) of ``docs(doc_id, text)``; the last
    two are null for an empty set."""
    def run(batches):
        for b in batches:
            ids = b.column(0).to_pylist()
            sets = [shingle_set(t, size) for t in b.column(1).to_pylist()]
            for lo in range(0, len(sets), 500):
                own = sets[lo:lo + 500]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids[lo:lo + 500], pa.int64()),
                    "n_shingles": pa.array([len(x) for x in own], pa.int64()),
                    "sid": pa.array([set_id(x) if len(x) else None for x in own], pa.int64()),
                    "sketch": pa.array([sketch(x) if len(x) else None for x in own], pa.binary())})
        _trim_words(WORDS_LEFT)
        give_back()
    return docs.mapInArrow(run, "doc_id long, n_shingles long, sid long, sketch binary")


def _near(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of ``pairs(x, y)``, of set ids, that sizes and sketches leave."""
    def keep(batches):
        for b in batches:
            ok = [may_be_similar(p.as_py(), q.as_py()) for p, q in zip(b.column(2), b.column(3), strict=True)]
            yield b.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    side = lambda c: nodes.select(*[F.col(k).alias(f"{k}_{c}" if k != "sid" else c) for k in ("sid", "n", "sketch")])
    return (pairs.join(side("x"), "x").join(side("y"), "y")
            .where(F.least("n_x", "n_y") * DEN >= F.greatest("n_x", "n_y") * NUM)
            .select("x", "y", "sketch_x", "sketch_y").mapInArrow(keep, "x long, y long"))


def _similar(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """The rows of ``pairs(x, y)`` whose whole sets are similar. ``nodes(sid,
    node, n, sketch)`` names a document of each set."""
    pairs = written(_near(pairs, nodes), "near")
    # written, so that its true size decides how the texts are met
    asked = written(pairs.select(F.col("x").alias("sid")).union(pairs.select("y")).distinct().join(
        nodes.select("sid", "node"), "sid"), "asked")

    def features(batches):
        for b in batches:
            sets = [shingle_set(t, size) for t in b.column(1).to_pylist()]
            right = [len(x) > 0 and set_id(x) == s for x, s in zip(sets, b.column(0).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).filter(pa.array(right, pa.bool_())),
                 pa.array([x.tobytes() for x, ok in zip(sets, right, strict=True) if ok], pa.binary())],
                names=["sid", "features"])
        _trim_words(WORDS_LEFT)
        give_back()

    sets = (docs.join(asked.select(F.col("node").alias("doc_id"), "sid"), "doc_id").select("sid", "text")
            .mapInArrow(features, "sid long, features binary").dropDuplicates(["sid"]))

    def verify(batches):
        for b in batches:
            ok = []
            for a, c in zip(b.column(2), b.column(3), strict=True):
                a, c = (np.frombuffer(v.as_buffer(), dtype=U) for v in (a, c))
                both = len(np.intersect1d(a, c, assume_unique=True))
                ok.append(DEN * both >= NUM * (len(a) + len(c) - both))
            yield b.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return (pairs.join(sets.select(F.col("sid").alias("x"), F.col("features").alias("fx")), "x")
            .join(sets.select(F.col("sid").alias("y"), F.col("features").alias("fy")), "y")
            .select("x", "y", "fx", "fy").mapInArrow(verify, "x long, y long"))


def _needed(hot: DataFrame, spare: DataFrame, nodes: DataFrame) -> DataFrame:
    """(sig, sid, n) of the hot rows (sig, key, which) that sets can't do
    without; ``spare`` has (key, which, spare)."""
    rows = hot.distinct()
    had = rows.groupBy("key", "which").agg(F.count(F.lit(1)).alias("had"))
    least = spare.groupBy("key", "which").agg(F.min("spare").alias("spare"))
    short = had.join(least, ["key", "which"]).where("had > spare").select("key").distinct()
    return rows.join(short, "key").join(nodes.select("key", "sid", "n"), "key").select("sig", "sid", "n").distinct()


def _compare(units: pa.Table) -> pa.Table:
    """Pairs of one unit, a block with itself or with another, that have
    different labels and whose sizes and sketches leave them similar."""
    blocks = []
    for i in range(units.num_rows):
        sid, label = (np.frombuffer(units.column(c)[i].as_buffer(), dtype=np.int64) for c in ("sids", "labels"))
        counts = [_counts(v) for v in units.column("sketches")[i].as_py()]
        blocks.append({cells: (sid[own], label[own], np.stack([counts[k] for k in own]).astype(np.int32))
                       for cells in {len(c) for c in counts}
                       for own in [np.array([k for k, c in enumerate(counts) if len(c) == cells])]})
    out = []
    for sid_a, label_a, a in blocks[0].values():
        for sid_b, label_b, b in blocks[-1].values():
            cells = min(a.shape[1], b.shape[1])
            fold = lambda m: m.reshape(len(m), -1, cells).sum(1)  # noqa: B023, E731
            fa, fb = fold(a), fold(b)
            na, nb = fa.sum(1), fb.sum(1)
            for k in range(len(fa)):
                rows = np.flatnonzero((label_b != label_a[k]) & (np.minimum(na[k], nb).astype(np.int64) * DEN
                                                                 >= np.maximum(na[k], nb).astype(np.int64) * NUM))
                both = np.minimum(fa[k], fb[rows]).sum(1).astype(np.int64)
                rows = rows[DEN * both >= NUM * (na[k] + nb[rows] - both)]
                out += [(min(x, y), max(x, y)) for x, y in zip([int(sid_a[k])] * len(rows), sid_b[rows].tolist(), strict=True)]
    x, y = zip(*sorted(set(out)), strict=True) if out else ((), ())
    return pa.table({"x": pa.array(x, pa.int64()), "y": pa.array(y, pa.int64())})


def _between(apart: DataFrame, nodes: DataFrame) -> DataFrame:
    """Candidates between the components of ``apart(sig, sid, n, label)``.

    Sets that share frequent signatures, directly or by others, are a family.
    Its members are dealt into blocks of bounded size, which are compared two
    at a time by sketch; only what the sketches leave becomes a row."""
    least = apart.groupBy("sig").agg(F.min("sid").alias("a"))
    family = connected_components(apart.join(least, "sig").select("a", F.col("sid").alias("b")))
    of = apart.select("sid", "label").distinct().join(
        family.select(F.col("node").alias("sid"), F.col("label").alias("family")), "sid")
    sizes = of.groupBy("family").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    members = of.join(sizes, "family").join(nodes.select("sid", "sketch"), "sid").withColumn(
        "block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))

    def packed(table: pa.Table) -> pa.Table:
        column = lambda c: table.column(c).combine_chunks()
        return pa.table({
            "family": column("family")[:1], "block": column("block")[:1], "blocks": column("blocks")[:1],
            "sids": pa.array([column("sid").to_numpy().tobytes()], pa.binary()),
            "labels": pa.array([column("label").to_numpy().tobytes()], pa.binary()),
            "sketches": pa.array([column("sketch").to_pylist()], pa.list_(pa.binary()))})

    blocks = members.groupBy("family", "block").applyInArrow(
        packed, "family long, block int, blocks int, sids binary, labels binary, sketches array<binary>")
    units = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "family", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "sids", "labels", "sketches")
    return units.groupBy("family", "lo", "hi").applyInArrow(_compare, "x long, y long")


def classes(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, n_shingles, component_id) of ``docs(doc_id, text)``."""
    text_batches(docs.sparkSession)
    docs = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = written(set_table(docs, size), "sets")
    nodes = written(sets.where("sid IS NOT NULL").groupBy("sid").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"),
        F.first("sketch").alias("sketch")).withColumn(
            "key", set_key_column(F.col("sid"))), "nodes")
    total = nodes.agg(F.sum("n")).first()[0] or 0
    buckets = max(12, -(-int(total) // BUCKET_ENTRIES))
    found = written(_signature_blocks(docs.select("text"), buckets, size).groupBy("bucket")
                    .applyInArrow(_candidates, "hot boolean, x long, y long, which int"), "candidates")

    hot = written(_needed(
        found.where("hot").select(F.col("x").alias("sig"), F.col("y").alias("key"), "which"),
        found.where("hot IS NULL").select(F.col("x").alias("spare"), F.col("y").alias("key"), "which"), nodes), "frequent")
    least = hot.groupBy("sig").agg(F.min("sid").alias("x"))
    first = hot.join(least, "sig").where("x < sid").select("x", F.col("sid").alias("y"))
    keys = found.where("NOT hot").select(F.col("x").alias("kx"), F.col("y").alias("ky")).distinct()
    named = lambda k, c: nodes.select(F.col("key").alias(k), F.col("sid").alias(c))
    pairs = keys.join(named("kx", "x"), "kx").join(named("ky", "y"), "ky").select(
        F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    links = written(_similar(pairs.union(first).distinct(), nodes, docs, size), "similar")

    # members of a frequent signature that are still apart
    label = connected_components(links.toDF("a", "b")).select(F.col("node").alias("sid"), "label")
    apart = hot.join(label, "sid", "left").select("sig", "sid", "n", F.coalesce("label", "sid").alias("label"))
    mixed = apart.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("sig")
    apart = written(apart.join(mixed, "sig"), "apart")
    links = links.union(_similar(_between(apart, nodes), nodes, docs, size))

    names = nodes.select("sid", "node")
    by_doc = (links.join(names.select(F.col("sid").alias("x"), F.col("node").alias("a")), "x")
              .join(names.select(F.col("sid").alias("y"), F.col("node").alias("b")), "y").select("a", "b"))
    label = connected_components(by_doc)
    of_set = names.join(label, "node", "left").select("sid", F.coalesce("label", "node").alias("component_id"))
    return (sets.select("doc_id", "n_shingles", "sid").join(of_set, "sid", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def op1_partenum_join(spark, sf_dir: str) -> DataFrame:
    return classes(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM i JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.doc_id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.c AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY 1) m ON m.doc_id = d.doc_id
"""
