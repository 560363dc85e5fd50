"""Each operator against a brute-force version, and on the cases its docstring defines."""

import hashlib
import random
import re
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string"
LONG = " ".join(f"w{i}" for i in range(30_000))


def _docs(spark, texts, start=0):
    return spark.createDataFrame([(start + i, t) for i, t in enumerate(texts)], DOCS)


def _by_id(df, col):
    return {r["doc_id"]: r[col] for r in df.collect()}


# -- 1: n-gram Jaccard join ---------------------------------------------------

def _brute_components(texts):
    sets = {}
    for i, t in texts.items():
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in texts}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            label[y] = x
    return {i: (len(sets[i]), root(i)) for i in texts}


def _near_copies(seed, n_groups=12, size=30):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 4)))
    notice = " ".join(word() for _ in range(12))
    texts = []
    for g in range(n_groups):
        base = [word() for _ in range(rnd.choice((3, 6, 12, 30, 80, 250)))]
        for _ in range(size if g < 3 else 3):
            own = list(base)
            for _ in range(rnd.randint(0, max(1, len(own) // 40))):
                own[rnd.randrange(len(own))] = word()
            texts.append(" ".join(own) + (" " + notice if rnd.random() < 0.5 else ""))
    texts += [" ".join(word() for _ in range(8)) + " " + notice for _ in range(60)]
    rnd.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join_equals_brute_force(spark, seed, monkeypatch):
    from tidelog.llm import jaccard_join
    monkeypatch.setattr(jaccard_join, "BUCKET_ENTRIES", 500)
    texts = [*_near_copies(seed), None, "", " \t\n", "one", "ONE", "a b c d", "a b c d e", LONG, LONG + " tail",
             "x y z", "É f g h i", "é f g h i"]
    docs = _docs(spark, texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.classes(docs).collect()}
    assert got == _brute_components(dict(enumerate(texts)))


def test_signatures_are_shared_within_the_bound():
    from tidelog.llm.jaccard_join import may_be_similar, signatures, sketch
    rng = np.random.default_rng(3)
    for size in (1, 2, 3, 4, 5, 8, 13, 40, 120, 700, 3000):
        for _ in range(20):
            a = rng.integers(1, 2 ** 63, size, dtype=np.uint64)
            cut = int(rng.integers(0, size // 7 + 1))
            b = np.concatenate([a[cut:], rng.integers(1, 2 ** 63, cut, dtype=np.uint64)])
            a, b = np.unique(a), np.unique(b)
            both = len(np.intersect1d(a, b))
            if 100 * both < 75 * (len(a) + len(b) - both):
                continue
            who, _, sig, _ = signatures([a, b])
            assert set(sig[who == 0]) & set(sig[who == 1])
            assert may_be_similar(sketch(a), sketch(b))


def test_signature_blocks_take_little_memory():
    """A task's signatures, all buckets' blocks of several flushes, peak at a
    fraction of what was held when sorting and writing copied them whole."""
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa
    from tidelog.llm import jaccard_join
    rng = random.Random(7)
    texts = [" ".join(str(rng.randrange(10 ** 9)) for _ in range(1000)) for _ in range(2500)]
    batches = [pa.RecordBatch.from_pydict({"text": texts[i:i + 100]}) for i in range(0, len(texts), 100)]
    run = jaccard_join._signature_blocks(SimpleNamespace(mapInArrow=lambda f, ddl: f), 50, 5)
    rows = {kind: 0 for kind in range(4)}
    tracemalloc.start()
    try:
        for b in run(iter(batches)):
            for kind, sig, bucket in zip(*(b.column(c).to_pylist() for c in ("kind", "sig", "bucket")), strict=True):
                assert 0 <= bucket < 50
                rows[kind] += len(sig) // 4
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows[jaccard_join.ENTRIES] > jaccard_join.FLUSH
    assert rows[jaccard_join.SPARES] == 2 * len(texts)
    assert peak < 110e6, peak


def test_jaccard_join_of_odd_tables(spark):
    from tidelog.llm.jaccard_join import classes
    assert classes(spark.createDataFrame([], DOCS)).collect() == []
    rows = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (None, "a b c"), (2, "a b c")], DOCS)
    got = sorted(tuple(r) for r in classes(rows).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (2, 1, 1)]


def test_components_of_chains_and_stars(spark):
    from tidelog.llm.components import connected_components
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)]
    random.Random(4).shuffle(edges)
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1300)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_convergence_check_beyond_a_long(spark):
    from tidelog.llm.components import _total
    values = [2 ** 63 - 1, 2 ** 63 - 2, 2 ** 62, -5]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert int(df.agg(_total(F.col("v"))).first()[0]) == sum(values) > 2 ** 63


# -- 2: chat formatting -------------------------------------------------------

def test_preferences(spark):
    from tidelog.llm.preferences import format_preferences, reply_pairs
    schema = "pair long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>"
    a, b, c = ("user", "hi"), ("assistant", "yes"), ("assistant", "né")
    rows = [(1, [a, b], [a, c]), (2, [a, b], [a, b]), (3, None, [a]), (4, [], []), (5, [(None, None), b], [(None, None), c, a])]
    got = {r.pair: r for r in format_preferences(spark.createDataFrame(rows, schema)).collect()}
    assert (got[1].prompt, got[1].n_prompt_turns) == ("<|user|>\nhi<|end|>\n", 1)
    assert got[1].chosen == "<|assistant|>\nyes<|end|>\n"
    assert got[1].chosen_mask == "0" * 14 + "1" * 11
    assert got[1].rejected_mask == "0" * 14 + "1" * 10 and len(got[1].rejected) == 24
    assert (got[2].n_prompt_turns, got[2].chosen, got[2].rejected) == (2, "", "")
    assert (got[3].prompt, got[3].chosen, got[3].rejected_mask) == ("", "", "0" * len(got[3].rejected))
    assert got[4].prompt == "" and got[5].n_prompt_turns == 1
    turns = spark.createDataFrame(
        [(4, 0, "user", "q"), (4, 1, "assistant", "x"), (4, 2, "user", "more"), (5, 0, "user", "z"),
         (5, 1, "assistant", "y"), (6, 0, "user", None), (None, 0, "user", "lost"), (4, 0, "user", "q")],
        "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in reply_pairs(turns).collect()}
    assert [tuple(t) for t in got[4].chosen] == [("user", "q"), ("user", "q"), ("assistant", "x")]
    assert [tuple(t) for t in got[4].rejected] == [("user", "q"), ("user", "q"), ("assistant", "y")]
    assert got[6].chosen == got[6].rejected and sorted(got) == [4, 5, 6]


# -- 3: line windows ----------------------------------------------------------

def _brute_lines(texts):
    seen, out = set(), {}
    for i in sorted(texts):
        t = texts[i]
        if t is None:
            out[i] = None
            continue
        ls = t.split("\n")
        gone = set()
        for p in range(len(ls) - 2):
            w = tuple(ls[p:p + 3])
            if all(x.strip(" ") == "" for x in w):
                continue
            if w in seen:
                gone |= {p, p + 1, p + 2}
            seen.add(w)
        out[i] = "\n".join(x for p, x in enumerate(ls) if p not in gone)
    return out


def test_line_windows_equal_brute_force(spark):
    from tidelog.llm.line_dedup import dedup_lines
    rnd = random.Random(5)
    texts = ["\n".join(rnd.choice(["a", "b", "c", "", " "]) for _ in range(rnd.randint(0, 9))) for _ in range(150)]
    texts += [None, "", "x", "x\ny", "x\ny\nz", "q\nx\ny\nz\nr", "\n\n\n\n", "k\nk\nk\nk\nk", "\n".join(LONG.split(" ")), "\n".join(LONG.split(" "))]
    got = dedup_lines(_docs(spark, texts).withColumn("n_lines", F.lit("clash")))
    assert _by_id(got, "text") == _brute_lines(dict(enumerate(texts)))
    assert got.columns == ["doc_id", "text", "n_lines", "n_removed"]
    twice = spark.createDataFrame([(1, "a\nb\nc"), (1, "a\nb\nc"), (None, "a\nb\nc")], DOCS)
    assert sorted((r.doc_id or 0, r.text) for r in dedup_lines(twice).collect()) == [(0, "a\nb\nc"), (1, ""), (1, "")]
    assert dedup_lines(spark.createDataFrame([], DOCS)).count() == 0


# -- 4: order minhash ---------------------------------------------------------

def test_order_minhash(spark, tmp_path):
    from tidelog.llm.order_minhash import fingerprint, likeness, op4_order_minhash
    rnd = random.Random(6)
    words = [f"v{rnd.randrange(10 ** 6)}" for _ in range(400)]
    base = " ".join(words)
    near = " ".join([*words[:180], "other", *words[181:]])
    turned = " ".join(words[200:] + words[:200])
    df = spark.createDataFrame([(base, x) for x in (base, near, turned, " ".join(reversed(words)), "", LONG)], "a string, b string")
    got = [r[0] for r in df.select(likeness(fingerprint(F.col("a")), fingerprint(F.col("b")))).collect()]
    assert got[0] == 1.0 and 0.8 < got[1] < 1.0 and got[4] == 0.0 and got[5] == 0.0
    assert got[2] < got[1]        # same words in another order are further off
    assert got[3] < 0.1
    texts = ["a b c d", "", None, "a b c d", "Zß漢字 q", LONG, "one", " ", "w w w w w w"]
    rows = [(3 * i, t) for i, t in enumerate(texts)] + [(None, "no place")]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op4_order_minhash(spark, str(tmp_path)).collect()}
    assert sorted(got) == [3 * i for i in range(len(texts))]
    full = [t or "" for t in texts]
    for i, t in enumerate(full):
        cut, after = len(t) // 4, full[(i + 1) % len(full)]
        r = got[3 * i]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256((t[:len(t) - cut] + after[:cut]).encode()).hexdigest()
    assert got[0].fingerprint == got[9].fingerprint != got[3].fingerprint
    assert got[3].near_next == 1.0 and got[3].fingerprint == got[6].fingerprint      # both without a word


def test_order_minhash_of_empty_table_and_shared_ids(spark, tmp_path):
    from tidelog.llm.order_minhash import op4_order_minhash
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/e/documents.parquet")
    assert op4_order_minhash(spark, f"{tmp_path}/e").count() == 0
    spark.createDataFrame([(1, "aaaa"), (2, "bbbb"), (2, "abcd")], DOCS).write.parquet(f"{tmp_path}/t/documents.parquet")
    got = sorted((r.doc_id, r.edited_sha256) for r in op4_order_minhash(spark, f"{tmp_path}/t").collect())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == sorted([(1, sha("aaaa")), (2, sha("bbba")), (2, sha("abca"))])


def _brute_order_minhash(tokens):
    """Order MinHash by its definition, point by point."""
    from xxhash import xxh64_intdigest as xx
    top, low = 1 << 64, 1 << 28
    signed = lambda h: h - top if h >> 63 else h
    kmers = [xx(w.encode(), xx(tokens[i - 1].encode(), 42) if i else 42) for i, w in enumerate(tokens)]
    seen, marked = {}, []
    for i, h in enumerate(kmers):
        high = signed(h) >> 28
        seen[high] = nth = seen.get(high, -1) + 1
        marked.append(((xx(nth.to_bytes(4, "little"), xx(high.to_bytes(8, "little", signed=True), 42)) & ~(low - 1)) + i + 1, i))
    parts = []
    for b in range(32):
        point = ((1 << 63) + b * (1 << 59)) % top
        near = sorted(((h - point) % top, i) for h, i in marked)
        order = sorted(near[t % len(near)][1] for t in range(2))
        h = 42
        for i in order:
            h = xx(kmers[i].to_bytes(8, "little"), h)
        parts.append(f"{h & 0xffffffff:08x}")
    return "".join(parts)


def test_order_minhash_equals_its_definition(spark):
    from tidelog.llm.order_minhash import fingerprint
    rnd = random.Random(11)
    texts = [["w%d" % rnd.randrange(n) for _ in range(n * 2)] for n in (1, 2, 3, 10, 60, 300)] + [["a"], ["a"] * 50, ["é", "—"]]
    d = _docs(spark, ["  ".join(t) for t in texts])
    got = _by_id(d.select("doc_id", fingerprint(F.col("text")).alias("f")), "f")
    assert got == {i: _brute_order_minhash(t) for i, t in enumerate(texts)}
    # pieces of long words and of scripts without blanks
    cut = _docs(spark, ["x" * 42 + " y", "ab 漢字仮名 c", "ก" * 6, "“quoted” — …", "é" * 25])
    got = _by_id(cut.select("doc_id", fingerprint(F.col("text")).alias("f")), "f")
    assert got == {i: _brute_order_minhash(t) for i, t in enumerate([
        ["xxxx"] * 39 + ["y"], ["ab", "漢字仮名", "c"], ["กกกก"] * 3, ["“quoted”", "—", "…"], ["é" * 25]])}


def test_order_minhash_of_texts_without_blanks(spark):
    from tidelog.llm.order_minhash import fingerprint, likeness
    rnd = random.Random(16)
    make = lambda lo, hi, n: "".join(chr(rnd.randint(lo, hi)) for _ in range(n))
    rows = []
    for lo, hi in ((0x4E00, 0x9FA5), (0x3041, 0x3096), (0x20000, 0x2A000), (0x61, 0x7A)):
        t = make(lo, hi, 400)
        rows += [(t, t[:300] + make(lo, hi, 100)), (t, t[:200] + "\u3002" + t[201:]), (t, make(lo, hi, 400))]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [r[0] for r in df.select(likeness(fingerprint(F.col("a")), fingerprint(F.col("b")))).collect()]
    for i in range(0, len(got), 3):
        assert 0.2 < got[i] < 1 and 0.7 < got[i + 1] and got[i + 2] < 0.1, got


# -- 5: pseudonyms ------------------------------------------------------------

def _luhn(s):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 % 10 + int(c) * 2 // 10 for i, c in enumerate(reversed(s))) % 10 == 0


def test_pseudonyms_keep_format_and_links(spark):
    from tidelog.llm.pseudonyms import pseudonymise
    texts = ["pay 4111111111111111 or 4111-1111-1111-1111.", "again 4111111111111111", "not 4111111111111112",
             "call +1 (017) 555-7713 now", "ip 144.137.247.239, v 999.1.1.1", "mail é.55@mail9.example.com",
             "ssn 123-45-6789 not 000-45-6789", "on 2024-02-29, 29/02/2024, 29.02.2024 not 2023-02-29",
             'token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde"', None, "", "clean 12 text", LONG]
    got = _by_id(pseudonymise(_docs(spark, texts)), "text")
    one, two = re.findall(r"[\d-]{16,}", got[0])
    assert one == re.findall(r"\d{16}", got[1])[0] == two.rstrip("-").replace("-", "") and _luhn(one)
    assert one != "4111111111111111" and re.fullmatch(r"\d{4}-\d{4}-\d{4}-\d{4}", two.rstrip("."))
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} now", got[3]) and got[3] != texts[3]
    ip = re.fullmatch(r"ip ([\d.]+), v 999\.1\.1\.1", got[4])[1]
    assert ip != "144.137.247.239" and all(int(x) < 256 for x in ip.split("."))
    assert re.fullmatch(r"mail é\.\d\d@mail9\.example\.com", got[5]) and got[5] != texts[5]
    assert re.fullmatch(r"ssn \d{3}-\d{2}-\d{4} not 000-45-6789", got[6]) and "123-45" not in got[6]
    a, b, c, bad = re.findall(r"\d+[-/.]\d+[-/.]\d+", got[7])
    assert (a[:4], a[5:7], a[8:]) == (b[6:], b[3:5], b[:2]) == (c[6:], c[3:5], c[:2]) and bad == "2023-02-29"
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', got[8]) and got[8] != texts[8]
    for i in (2, 9, 10, 11, 12):
        assert got[i] == texts[i]
    assert pseudonymise(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("kind,values", [
    ("ipv4", [f"10.{i % 7}.{i // 250}.{i % 250}" for i in range(1500)]),
    ("iso_date", [f"{y}-{m:02d}-{d:02d}" for y in (1900, 1999, 2000, 2099) for m in range(1, 13) for d in (1, 9, 28)]),
    ("phone", [f"+1 ({i % 1000:03d}) 555-{i:04d}" for i in range(1500)]),
    ("ssn", [f"{a:03d}-01-{b:04d}" for a in (1, 665, 667, 899) for b in range(1, 200)]),
    ("mail", [f"{a}{i}@x.com" for a in ("ab", "ba", "") for i in range(400)]),
])
def test_pseudonyms_are_one_to_one(spark, kind, values):
    from tidelog.llm.pseudonyms import pseudonym
    df = spark.createDataFrame([(v,) for v in sorted(set(values))], "v string")
    got = [r[0] for r in df.select(pseudonym(F.col("v"), kind)).collect()]
    assert len(set(got)) == len(got)
    assert got == [r[0] for r in df.select(pseudonym(F.col("v"), kind)).collect()]    # in every plan the same
    other = [r[0] for r in df.select(pseudonym(F.col("v"), kind, "another key")).collect()]
    assert sum(a != b for a, b in zip(got, other, strict=True)) > 0.9 * len(got)


def test_pseudonyms_of_forms_the_fixture_does_not_plant(spark):
    from tidelog.llm.pseudonyms import pseudonym, pseudonymise
    texts = ["+15551234567", "(555) 123-4567", "555-123-4567", "+1-555-123-4567", "+44 20 7946 0958", "1.555.123.4567",
             "020 7946 0958", "12/25/2023", "1/2/2020", "2020/01/02", "2020-1-2", "5/25/2021", "31.5.2021", "12.25.2023",
             "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "AT61 1904 3002 3457 3201"]
    left = ["DE88 3704 0044 0532 0130 00", "30/2/2020", "13/13/2020", "2020/13/01", "2/30/2020", "1.2.3", "155-123-4567", None]
    got = _by_id(pseudonymise(_docs(spark, [f"see {x} EUR" for x in texts] + left)), "text")
    shape = lambda t: re.sub("[A-Z]", "A", re.sub("[0-9]", "0", t))
    for i, x in enumerate(texts):
        new = re.fullmatch("see (.*) EUR", got[i])[1]
        assert new != x and shape(new) == shape(x), x
        if x[:2].isalpha():
            c = new.replace(" ", "")
            assert new[:2] == x[:2] and int("".join(str(int(ch, 36)) for ch in c[4:] + c[:4])) % 97 == 1
    assert got[0][4:6] == "+1" and got[4][4:7] == "+44" and got[6][4] == "0" and got[1][5] in "23456789"
    assert int(got[7][7:9]) > 12 and 1 <= int(got[7][4:6]) <= 12 and "0" not in got[8].split()[1].split("/")[:2]
    assert re.sub("[^0-9]", "", got[0]) == re.sub("[^0-9]", "", got[3])
    assert [got[len(texts) + i] for i in range(len(left))] == left
    for kind, values in {
            "slash_date": [f"{a}/{b}/2020" for a in range(1, 13) for b in range(1, 29)] + [f"{m:02d}/{d}/1999" for m in range(1, 13) for d in (13, 20, 28)],
            "phone": [f"{200 + i}-555-{i:04d}" for i in range(700)] + [f"+4420{i:08d}" for i in range(300)],
            "iban": [f"DE{98 - int(f'{i:018d}131400') % 97:02d}{i:018d}" for i in range(300)]}.items():
        df = spark.createDataFrame([(v,) for v in values], "v string")
        new = [r[0] for r in df.select(pseudonym(F.col("v"), kind)).collect()]
        assert len(set(new)) == len(set(values)) and sum(a != b for a, b in zip(new, values, strict=True)) > 0.9 * len(values)


# -- 6: byte-level BPE --------------------------------------------------------

def test_byte_bpe_equals_tiktoken(spark):
    import public_tokenizers as P
    import tiktoken

    from tidelog.llm.byte_bpe import Codec, decode, encode, encode_decode
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = Codec(path, P.PATTERN).ranks
    tik = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(7)
    texts = ["", None, "  a  b \n c  ", "a" * 1000, "ab" * 700, " lead", "trail ", "foo \nbar  baz", "don't I'll ''s",
             "é" * 300 + " 中文字符" * 60, "\x85 \xa0 a　 b \x1c c", "🙂‍👩‍👧 ok", "<|endoftext|> hi", "=-" * 300,
             "".join(rnd.choice("abcde  '\n.,12é中") for _ in range(4000)),
             "".join(rnd.choice("abcdefghijklmnop") for _ in range(2500)), LONG, "a b", "a b"]
    docs = _docs(spark, texts)
    want = {i: np.array(tik.encode_ordinary(t or ""), dtype="<u4").tobytes() for i, t in enumerate(texts)}
    ids = encode(docs, path, P.PATTERN)
    assert _by_id(ids, "ids") == want
    assert _by_id(decode(ids, path, P.PATTERN), "raw") == {i: (t or "").encode() for i, t in enumerate(texts)}
    both = encode_decode(docs, path, P.PATTERN)
    assert _by_id(both, "ids") == want and _by_id(both, "raw") == {i: (t or "").encode() for i, t in enumerate(texts)}
    assert encode(spark.createDataFrame([], DOCS), path, P.PATTERN).count() == 0


# -- 7: licence scans ---------------------------------------------------------

def test_license_scan(spark):
    from tidelog.llm.licenses import TEMPLATES, scan
    texts = ["some words of prose before it\n" + TEMPLATES["Apache-2.0"] + "\nand more prose after it", "LICENSED under the apache licence, version 2.0",
             TEMPLATES["ISC"].replace(" for any ", "\nfor any "), "Released under the MIT License", None, "", "one", LONG,
             TEMPLATES["MIT"] + "\n" + TEMPLATES["GPL-3.0"]]
    got = {r.doc_id: [(m.line, m.license) for m in r.matches] for r in scan(_docs(spark, texts)).collect()}
    assert got[0] == [(2, "Apache-2.0")] and got[2][0] == (0, "ISC") and got[3] == [(1, "MIT")]
    assert {(1, "MIT"), (2, "GPL-3.0")} <= set(got[8])
    assert [got[i] for i in (4, 5, 6, 7)] == [[]] * 4


def test_license_texts_and_wrapped_notices(spark):
    from tidelog.llm.licenses import TEMPLATES, TEXTS, scan
    full = dict(TEXTS)
    prose = "some words of prose\nthat say nothing here"
    wrap = lambda t, n: [" ".join(t.split()[i:i + n]) for i in range(0, len(t.split()), n)]
    held = lambda lines, mark="# ": "\n".join([prose, *[mark + x for x in lines], "", "def f(): pass", prose])
    bsd = ["Use of this source code is governed by a BSD-style", "license that can be found in the LICENSE file."]
    mit, isc = full["MIT"].strip().split("\n"), wrap(TEMPLATES["ISC"], 12)
    gpl = next(t for n, t in TEXTS if n == "GPL-3.0" and len(t) > 10_000).strip().split("\n")
    texts = [held(bsd, "// "), held(isc), held(mit, " * "), held(gpl, ""), held([*mit, *isc, *bsd]),
             "\n".join([prose, TEMPLATES["MIT"], prose]), held(["Use of this source code", "is free to all"])]
    got = {r.doc_id: [(m.line, m.last, m.license) for m in r.matches if m.line] for r in scan(_docs(spark, texts)).collect()}
    assert got[0] == [(3, 4, "BSD-3-Clause")]
    assert got[1] == [(3, 2 + len(isc), "ISC")]
    assert got[2] == [(3, 2 + len(mit), "MIT")]
    assert (3, 2 + len(gpl), "GPL-3.0") in got[3] and {x[2] for x in got[3]} == {"GPL-3.0"}
    a = 2 + len(mit)
    assert got[4] == [(3, a, "MIT"), (a + 1, a + len(isc), "ISC"), (a + len(isc) + 1, a + len(isc) + 2, "BSD-3-Clause")]
    assert got[5] == [(3, 3, "MIT")] and got[6] == []


# -- 8: exact top-k -----------------------------------------------------------

def test_topk_equals_brute_force(spark):
    from tidelog.llm.topk_search import search
    rng = np.random.default_rng(8)
    x = rng.normal(0, 0.2, (900, 16)).round(3)
    x[100:400] = x[7]                       # ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(10_000, None), (10_100, [1.0] * 15 + [None]), (10_200, [float("nan")] * 16), (10_300, [float("inf")] * 16),
             (None, [1.0] * 16), (20_000, [1.0] * 3), (20_001, [2.0] * 3), (30_000, []), (40_000, [1e30] * 16), rows[5]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in search(
        df, lambda c: c % 100 == 0, shard_rows=128, query_block=4).collect()}
    top = 1 << 60
    whole = {i: [max(-top, min(top, int(np.floor(e * 1024)))) for e in v] for i, v in rows
             if i is not None and v and all(e is not None and np.isfinite(e) for e in v)}
    want = {}
    for q in (i for i in whole if i % 100 == 0):
        s = sorted((-max(1 - 2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(whole[q], v, strict=True)))), i)
                   for i, v in whole.items() if i != q and len(v) == len(whole[q]))
        want.update({(q, k): (i, -m) for k, (m, i) in enumerate(s[:10], 1)})
    assert got == want
    assert search(spark.createDataFrame([], "vec_id long, embedding array<double>"), lambda c: c % 100 == 0).count() == 0


def test_topk_copies_nothing_per_shard(spark, monkeypatch):
    # queries were copied once per shard, and all copies sent to the driver for a broadcast
    from tidelog.llm import topk_search
    monkeypatch.setattr(topk_search, "SHARD_PARTS", 3)
    monkeypatch.setattr(topk_search, "PART_BLOCKS", 2)
    rng = np.random.default_rng(88)
    x = rng.normal(0, 0.2, (700, 8))
    x[50:250] = x[3]                        # ties over many shards
    x[300:310] *= 300                       # shards of integers of 2, 4 and 8 bytes
    x[400] *= 1e7
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(i, (-x[i + 1]).tolist()) for i in range(0, 700, 50)] + rows[:20]     # ids of two vectors; rows that come twice
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk_search.search(df, lambda c: c % 20 == 0, shard_rows=16, query_block=4)
    got = sorted(map(tuple, found.collect()))
    whole = sorted({(i, tuple(int(np.floor(e * 1024)) for e in v)) for i, v in rows})
    want = []
    for q, u in whole:
        if q % 20 == 0:
            s = sorted((-max(1 - 2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(u, v, strict=True)))), i)
                       for i, v in whole if i != q)
            want += [(q, k, i, -m) for k, (m, i) in enumerate(s[:10], 1)]
    assert got == sorted(want)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "CartesianProduct" in plan
    assert "Broadcast" not in plan and "Generate" not in plan


def test_topk_proves_rows_out_by_earlier_shards():
    from tidelog.llm.topk_search import Shard
    rng = np.random.default_rng(89)
    for low, high in ((-300, 300), (0, 300), (100_000_000, 100_000_300), (-130_000_000, 130_000_000)):
        x = rng.integers(low, high, (2000, 24))
        q = rng.integers(low, high, 24)
        shard, score = Shard(np.arange(2000), x), x @ q
        for at in (1, 10, 100):
            want = np.lexsort((np.arange(2000), -score))[:min(at, 10)]
            ids, best = shard.top(-1, q, 10, np.sort(score)[-at])
            assert ids[:len(want)].tolist() == want.tolist() and best[:len(want)].tolist() == score[want].tolist()
        assert len(shard.possible(q, 10)) >= 10 and len(shard.possible(q, 10, 9.0 * np.abs(score).max())) == 0


# -- 9: packing ---------------------------------------------------------------

def _check_packing(rows, texts, sequence):
    import public_tokenizers as P
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = set()
    for d, t in texts:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        for k, s in enumerate(range(0, len(ids), sequence)):
            part = np.array(ids[s:s + sequence], dtype="<u4")
            want.add((d, k, s, len(part), zlib.crc32(part.tobytes())))
    assert {tuple(r[:5]) for r in rows} == want
    by = {}
    for r in rows:
        by.setdefault(r[5], []).append((r[6], r[3]))
    for own in by.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= sequence
    return len(by), sum(r[3] for r in rows)


def test_chunk_tokenizer_equals_the_plain_one():
    import public_tokenizers as P
    from tokenizers import Tokenizer

    from tidelog.llm.packing import ChunkTokenizer
    path = P.path("word_bpe_49k.json")
    plain, tok = Tokenizer.from_file(path), ChunkTokenizer(path)
    rnd = random.Random(9)
    # apostrophes, white space of all kinds, digits, small letters that are longer or beyond Latin, added tokens
    few = [*"abstmdrevlSTLM'''''  \n\t\r!?.12 \u00e9\u00c9\u00df\xa0\u0130\u0301\u4e2d\u017f\x1c\x85\u00bd\u00aa\u212a\u1e9e\u03a3",
           "<|endoftext|>", "<|startoftext|>"]
    latin = [chr(c) for c in range(1, 0x250)] + list("'' \n    ") * 20
    for batch in range(30):
        texts = ["".join(rnd.choices(few if batch % 2 else latin, k=rnd.randint(0, 80))) for _ in range(100)]
        texts += ["", " ", "\n \n", "a" * rnd.randint(1, 3000), "." * rnd.randint(1, 3000)]
        for t, raw in zip(texts, tok.ids(texts), strict=True):
            assert np.frombuffer(raw, "<u4").tolist() == plain.encode(t, add_special_tokens=False).ids, t
        if batch % 7 == 6:
            tok.trim()
    assert tok.ids([]) == []


def test_chunk_tokenizer_makes_nothing_per_chunk():
    # known chunks cost much less than taking their ids from a dict one by one
    import time

    import public_tokenizers as P

    from tidelog.llm.packing import ChunkTokenizer
    rnd = random.Random(4)
    words = ["".join(rnd.choices("aeioustnr", k=8)) for _ in range(20_000)]
    texts = [" ".join(rnd.choices(words, k=500)) for _ in range(1500)]
    tok = ChunkTokenizer(P.path("word_bpe_49k.json"))
    first = tok.ids(texts)
    memo = dict(zip(words, tok.ids(words), strict=True))

    def one_by_one():
        split = [t.split(" ") for t in texts]
        assert set().union(*split) <= memo.keys()
        return [b"".join(map(memo.__getitem__, cs)) for cs in split]

    took = {"ids": [], "one by one": []}
    for _ in range(5):
        for name, f in (("ids", lambda: tok.ids(texts)), ("one by one", one_by_one)):
            began = time.process_time()
            assert f() == first
            took[name].append(time.process_time() - began)
    assert min(took["ids"]) < 0.6 * min(took["one by one"]), took


def test_packing_is_gapless_and_tight(spark):
    import public_tokenizers as P

    from tidelog.llm.packing import pack
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    path = P.path("word_bpe_49k.json")
    rows = [tuple(r) for r in pack(d.repartition(5, "doc_id"), path).collect()]
    n, total = _check_packing(rows, [tuple(r) for r in d.collect()], 4096)
    assert n <= -(-total // 4096) * 1.01 + 2
    texts = [None, "", "a", "a", LONG, "İ ǅ \tx 中文 <|endoftext|> ½²", "don't 's !'s a,b. c! É? 1. 中.",
             "a<|endoftext|>b x<|startoftext|>y <|ENDOFTEXT|> <|endoftext|><|endoftext|>.", "\x1c \x85"]
    odd = _docs(spark, texts)
    rows = [tuple(r) for r in pack(odd, path, sequence=64, cells=8).collect()]
    _check_packing(rows, list(enumerate(texts)), 64)
    assert pack(spark.createDataFrame([], DOCS), path).count() == 0


def test_plan_uses_up_the_histogram():
    from tidelog.llm.packing import plan
    rnd = random.Random(9)
    for sequence, cells in ((100, 8), (4096, 64), (7, 64)):
        hist = {rnd.randint(1, sequence): rnd.randint(1, 50) for _ in range(60)} | {sequence: 3}
        used = {}
        for lengths, count in plan(hist, sequence, cells):
            assert sum(lengths) <= sequence and count > 0
            for n in lengths:
                used[n] = used.get(n, 0) + count
        assert used == hist


# -- 10: language -------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    from tidelog.llm.language_id import op10_language_id
    got = op10_language_id(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = got.join(docs, "doc_id").select("doc_id", "held_out", "lang_pred", "score", "lang").collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)


def test_language_of_odd_texts(spark):
    from tidelog.llm.language_id import fit, held_out, predict
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = fit(docs.where(~held_out("doc_id")))
    texts = [None, "", "123 !!", "\n", "the and of the", LONG]
    got = {r.doc_id: (r.lang_pred, r.score) for r in predict(
        _docs(spark, texts).withColumn("score", F.lit("clash")), model).collect()}
    assert [got[i] for i in range(4)] == [("und", 0.0)] * 4
    assert got[4][0] in {"en", "de", "fr", "es"} and 0 <= got[5][1] <= 1
    none = fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert predict(_docs(spark, ["abc"]), none).first().lang_pred == "und"
    one = fit(spark.createDataFrame([(1, "abc", "xx"), (2, None, "xx"), (None, "d", "yy")], "doc_id long, text string, lang string"))
    assert predict(_docs(spark, ["abc"]), one).first().lang_pred == "xx"


def test_language_sample_is_made_by_one_python_worker(spark, monkeypatch):
    """A filter on the sample's vectors made them twice, and took each task
    two workers, which stay in the executor's memory."""
    from pyspark.sql.classic.dataframe import DataFrame
    from tidelog.llm.language_id import fit
    plans, plain = [], DataFrame.toPandas
    monkeypatch.setattr(DataFrame, "toPandas", lambda df: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or plain(df))
    rows = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, "12 34", "en"), (4, "", "fr")]
    model = fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert [p.count("ArrowEvalPython") for p in plans] == [1]
    assert model.families == ["germanic"] and model.members["germanic"] == ["de", "en"]
