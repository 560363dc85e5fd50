"""Document fingerprints by Order MinHash, which are sensitive to edits.

A text's k-mers are runs of ``K`` tokens: words, but of words of more than
``LONG`` characters, and of runs of letters of scripts written without blanks,
the overlapping pieces of ``PIECE`` characters (shorter runs whole). Each is numbered by its occurrence in
the text, so that repetition counts. Every numbered k-mer gets a hash. Each of
``POINTS`` order functions ranks the k-mers by the distance of their hash from
a point on the ring of hashes, upwards, and selects the ``L`` minimal ones;
their k-mers are put in text order, and the hash of that tuple is one part of
the fingerprint. A part survives an edit if both k-mers and their order do.
The likeness of two fingerprints is the share of equal parts.

Built-in column functions only. All points read one sorted array per text: the
points are sorted in as marks, so a text costs two sorts, whatever the number
of points. A sorted element packs 36 bits of hash and 28 bits of position.

Defined cases: a null text is empty; texts without a word have the same
fingerprint of zeros; a text of fewer than ``L`` k-mers repeats them; the first
k-mers are shorter than ``K`` tokens, so any word makes one; beyond 2**28 words
positions start again. Rows with a null doc_id have no place in the order and
are left out; rows that share one are rows of their own with the same next
document, the one of least first characters among those of the next id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import written

K = 2
L = 2
POINTS = 32
LONG = 40
PIECE = 4
# scripts written without blanks between words
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsBopomofo}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}\p{IsYi}"
BEFORE_UNSPACED = 0xE00     # no letter of these scripts comes before
BITS = 28
MASK = (1 << BITS) - 1
PART = 8        # hex digits


def _let(value: Column, f) -> Column:
    """``f`` of a value that is computed once."""
    return F.transform(F.array(value), f)[0]


def _low(x: Column) -> Column:
    return x.bitwiseAND(F.lit(MASK).cast("long"))


def _packed(hash_: Column, low: Column) -> Column:
    return hash_.bitwiseAND(F.lit(~MASK).cast("long")).bitwiseOR(low)


def _numbered(kmers: Column) -> Column:
    """Hash of each occurrence-numbered k-mer, with its position + 1 below."""
    by_kmer = F.sort_array(F.transform(kmers, lambda h, i: _packed(h, F.pmod(i, F.lit(MASK)).cast("long"))))
    high = lambda x: F.shiftright(x, BITS)

    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (high(s[i]) != high(F.get(s, i - 1))))
        return _let(starts, lambda at: F.flatten(F.transform(at, lambda a, j: F.transform(
            F.slice(s, a + 1, F.coalesce(F.get(at, j + 1), F.size(s)) - a),
            lambda x, o: _packed(F.xxhash64(high(x), o), _low(x) + 1)))))

    return _let(by_kmer, runs)


def _parts(kmers: Column) -> Column:
    """The fingerprint of a non-empty array of k-mer hashes."""
    marks = F.array(*[F.lit(-(1 << 63) + b * ((1 << 64) // POINTS)).cast("long") for b in range(POINTS)])

    def pick(ring: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(ring) - 1), lambda i: _low(ring[i]) == 0)
        own = F.filter(ring, lambda x: _low(x) != 0)
        place = lambda e, i, t: (_low(e[F.pmod(i + t, F.size(e))]) - 1).cast("int")
        # before mark b stand b marks and at[b] - b k-mers
        part = lambda e, i, b: _let(F.array_sort(F.array(*[place(e, i - b, t) for t in range(L)])),
                                    lambda p: F.lpad(F.lower(F.hex(F.xxhash64(*[kmers[p[t]] for t in range(L)])
                                                                   .bitwiseAND(F.lit((1 << 4 * PART) - 1)))), PART, "0"))
        return _let(own, lambda e: F.array_join(F.transform(at, lambda i, b: part(e, i, b)), ""))

    return _let(F.sort_array(F.concat(_numbered(kmers), marks)), pick)


def _tokens(text: Column) -> Column:
    """Words of a text, with overlapping pieces of those that hold no blanks
    where other texts have them."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    cut = lambda r: F.rlike(r, F.lit(rf"^[{UNSPACED}]|^(?s:.{{{LONG + 1}}})"))
    pieces = lambda r: _let(F.when(cut(r), F.regexp_extract_all(
        r, F.lit(rf"(?s)(?=(.{{{PIECE}}})).", ), F.lit(1))).otherwise(F.array()), lambda ps: F.when(
            F.size(ps) > 0, ps).otherwise(F.array(r)))
    runs = lambda w: F.regexp_extract_all(w, F.lit(rf"[{UNSPACED}]+|[^{UNSPACED}]+"), F.lit(0))
    # the first tests are cheap, and most texts pass no more of them
    mixed = lambda ws: (F.rlike(text, F.lit(rf"[\x{{{BEFORE_UNSPACED:x}}}-\x{{10ffff}}]"))
                        & F.rlike(text, F.lit(f"[{UNSPACED}]")) | F.exists(ws, lambda w: F.octet_length(w) > LONG))
    return _let(words, lambda ws: F.when(mixed(ws), F.flatten(F.transform(F.flatten(F.transform(ws, runs)), pieces)))
                .otherwise(ws))


def fingerprint(text: Column) -> Column:
    """Order MinHash of a text as a string of ``POINTS`` parts of 8 hex digits."""
    kmers = lambda ws: F.transform(ws, lambda w, i: F.xxhash64(
        *[F.get(ws, i - k) for k in range(K - 1, 0, -1)], w))
    return _let(_tokens(text), lambda ws: F.when(F.size(ws) > 0, _let(kmers(ws), _parts))
                .otherwise(F.lit("0" * (PART * POINTS))))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal parts of two fingerprints."""
    same = [F.when(F.substring(a, 1 + PART * i, PART) == F.substring(b, 1 + PART * i, PART), 1).otherwise(0)
            for i in range(POINTS)]
    return sum(same[1:], same[0]) / float(POINTS)


def next_ids(docs: DataFrame) -> DataFrame:
    """(doc_id, n, next_id) of each distinct id of ``docs(doc_id, n)``: the
    next larger id, after the last the first; ``n`` is the largest of an id.

    Ids are dealt by range and written with their part, so only one row per
    part meets in one task."""
    ids = written(docs.groupBy("doc_id").agg(F.max("n").alias("n")).repartitionByRange("doc_id")
                  .select("doc_id", "n", F.spark_partition_id().alias("part")), "ids-in-order")
    heads = ids.groupBy("part").agg(F.min("doc_id").alias("head"))
    order = Window.orderBy("part")
    after = heads.select("part", F.coalesce(
        F.lead("head").over(order), F.first("head").over(order)).alias("next_head"))
    own = Window.partitionBy("part").orderBy("doc_id")
    return (ids.select("*", F.lead("doc_id").over(own).alias("follower")).join(after, "part")
            .select("doc_id", "n", F.coalesce("follower", "next_head").alias("next_id")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, fingerprint) of every text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col), text.alias(text_col), fingerprint(text).alias("fingerprint"))


def compare_with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_prefix, fingerprint, next_fingerprint) of
    ``docs(doc_id, text)``: each text with the fingerprint of the next document
    and as many of its first code points as a quarter of the text has."""
    docs = docs.where("doc_id IS NOT NULL")
    marked = fingerprints(docs)
    order = next_ids(docs.select("doc_id", F.coalesce(F.char_length("text"), F.lit(0)).alias("n")))
    asked = order.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("prev_id"),
                         F.floor(F.col("n") / 4).cast("int").alias("take"))
    sent = marked.join(asked, "doc_id").select(
        "doc_id", "prev_id", F.col("text").substr(F.lit(1), F.col("take")).alias("next_prefix"),
        F.col("fingerprint").alias("next_fingerprint"))
    one = Window.partitionBy("doc_id").orderBy("next_prefix", "next_fingerprint")
    sent = (sent.withColumn("nth", F.row_number().over(one)).where("nth = 1")
            .select(F.col("prev_id").alias("doc_id"), "next_prefix", "next_fingerprint"))
    return marked.join(sent, "doc_id")


def op4_order_minhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), n - cut), F.col("next_prefix").substr(F.lit(1), cut))
    both = (compare_with_next(docs).select(
        "doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "fingerprint", "next_fingerprint")
        .select("*", fingerprint(F.col("edited")).alias("edited_fingerprint")))
    return both.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
