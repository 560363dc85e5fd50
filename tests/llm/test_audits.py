"""Source mixing and the two audits: against brute force, and on the cases their docstrings define."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, id long, part string, size int"


def _table(spark, rows, parts=None):
    """``rows`` of (doc_id, text, lang, source) with columns of names the operators use themselves."""
    df = spark.createDataFrame([(*r, 7, "x", 1) for r in rows], DOCS)
    return df.repartition(parts) if parts else df


def _corpus(seed, n=600):
    rnd = random.Random(seed)
    vocabulary = [rnd.choice(("", "é", "A", "ß", "漢")) + "".join(rnd.choice("abC") for _ in range(3)) for _ in range(60)]
    texts = [" ".join(rnd.choice(vocabulary[: rnd.choice((10, 60))]) for _ in range(rnd.choice((1, 5, 60, 400))))
             + rnd.choice(("", " #", " A B C D E F", "-1é_x")) for _ in range(n // 2)]
    texts += [rnd.choice(texts) for _ in range(n - len(texts))]
    texts[:8] = [None, "", " \t\n", "x", None, "A", "#", "word " * 3000]
    return [(i if i % 17 else None, t, rnd.choice(("en", "fr", None, "")), rnd.choice(("s1", "s1", "s2", "Z", "é", None, "")))
            for i, t in enumerate(texts)]


# -- 11: mixing ---------------------------------------------------------------

def _brute_targets(size, weights=(5, 2, 1), most=3):
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [s for s in size if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), sum(size.values())
    while True:
        rest = total - sum(most * size[s] for s in full)
        open_ = [s for s in order if s not in full]
        level = rest / max(1, sum(weight[s] for s in open_))
        above = {s for s in open_ if level * weight[s] > most * size[s]}
        if not above:
            return {s: most * size[s] if s in full else level * weight[s] for s in order}
        full |= above


def _words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_mix_targets_and_copies(spark):
    from tidelog.llm.source_mix import mix
    rows = _corpus(1)
    rows += [(10_000 + i, "w " * 40, "en", f"small{i}") for i in range(3)] + [(20_000, None, None, "none")]
    got = mix(_table(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r[0]: r for r in rows if r[0] is not None}
    size, words = Counter(), Counter()
    for r in rows:
        size[r[3]] += len(_words(r[1]))
    want = _brute_targets(size)
    largest = defaultdict(int)
    for g in got:
        if g.doc_id is None:
            continue
        row = by_id[g.doc_id]
        assert g.size == len(_words(row[1])) and g.source_size == size[row[3]]
        assert g.target == pytest.approx(want[row[3]], rel=1e-9, abs=1e-6)
        assert g.taken == g.copies * g.size <= 3 * g.size
        if g.size:
            assert abs(g.copies - g.target / g.source_size) < 1 + 1e-6
    for r in rows:
        largest[r[3]] = max(largest[r[3]], len(_words(r[1])))
    # the sources of rows without an id are told by their target
    for g in got:
        words[round(g.target, 6)] += g.taken
    for s, t in want.items():
        same = [x for x in want if round(want[x], 6) == round(t, 6)]
        assert abs(words[round(t, 6)] - t * len(same)) <= sum(largest[x] for x in same) + 1e-6


def test_mix_agrees_over_splits_and_deep_trees(spark, monkeypatch):
    from tidelog.llm import source_mix
    monkeypatch.setattr(source_mix, "BLOCK_ROWS", 10)
    monkeypatch.setattr(source_mix, "FAN_IN", 3)
    rows = [(i, "w " * (1 + i * 7 % 50), "en", "hot" if i % 3 else f"s{i % 5}") for i in range(900)]
    a = source_mix.mix(_table(spark, rows, 3)).collect()
    b = source_mix.mix(_table(spark, rows, 11)).collect()
    assert sorted(map(str, a)) == sorted(map(str, b))
    taken, target = Counter(), {}
    for g in a:
        s = rows[g.doc_id][3]
        taken[s] += g.taken
        target[s] = g.target
    assert all(abs(taken[s] - target[s]) <= 50 for s in target)


def test_mix_of_nothing(spark):
    from tidelog.llm.source_mix import mix
    assert mix(_table(spark, [])).collect() == []
    got = mix(_table(spark, [(1, None, "en", "a"), (2, "", "en", None)])).collect()
    assert sorted((g.doc_id, g.size, g.target, g.taken) for g in got) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_meetings_keep_mass_and_expectation():
    from tidelog.llm.source_mix import meet
    rnd = random.Random(5)
    for _ in range(300):
        ma, mb = rnd.choice((1, 3, 50, 7000)), rnd.choice((1, 4, 50, 9000))
        a, b = rnd.uniform(0.01, 0.99), rnd.uniform(0.01, 0.99)
        up, down = min(ma * a, mb * (1 - b)), min(mb * b, ma * (1 - a))
        gives, takes = meet(ma, a, mb, b, 0.0), meet(ma, a, mb, b, 1 - 1e-12)
        for x, y in (gives, takes):
            assert ma * x + mb * y == pytest.approx(ma * a + mb * b)
            assert x in (0.0, 1.0) or y in (0.0, 1.0)
        p = down / (up + down)
        assert p * gives[0] + (1 - p) * takes[0] == pytest.approx(a)


def test_rates_hold_on_average():
    from tidelog.llm.source_mix import settle
    rnd = random.Random(9)
    mass = [rnd.choice((1, 10, 200)) for _ in range(12)]
    sums = np.zeros(12)
    for _ in range(4000):
        prob = [0.3] * 12
        left = settle([0] * 12, mass, prob, [rnd.getrandbits(63) for _ in mass], 0)
        if left >= 0:
            prob[left] = float(rnd.random() < prob[left])
        sums += prob
    assert abs(sums / 4000 - 0.3).max() < 0.04


# -- 12: source divergence ----------------------------------------------------

def _brute_divergence(rows, least, ranks=50):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    low = lambda t: re.sub("[A-Z]", lambda m: m.group().lower(), t)
    docs, count, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = term.findall(low(text or ""))
        docs[lang].update(set(found))
        count[lang, source].update(found)
    out = []
    share = lambda n, total, v: 1 + 1_000_000_000 * (n + 5) // (total + 5 * v)
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= least]
        totals = {s: sum(count[lang, s][t] for t in kept) for x, s in groups if x == lang}
        p = {s: {t: share(count[lang, s][t], totals[s], len(kept)) for t in kept} for s in totals}
        whole = {t: sum(count[lang, s][t] for s in totals) for t in kept}
        q = {t: share(whole[t], sum(totals.values()), len(kept)) for t in kept}
        mine = p[source]
        pairs = [(-sum(abs(mine[t] - p[s][t]) for t in kept), s.encode(), s) for s in totals if s != source]
        used = [(-(mine[t] - q[t]), t.encode(), t) for t in kept if count[lang, source][t] and mine[t] > q[t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(used)[:ranks])):
            out += [(lang, source, part, item, -f, i + 1) for i, (f, _, item) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_divergence_equals_brute_force(spark, monkeypatch, small):
    """Also with spills, blocks and tasks of a few entries."""
    from tidelog.llm import source_divergence as op
    if small:
        for name, value in (("BLOCK", 2), ("STRIPES_PER_TASK", 9)):
            monkeypatch.setattr(op, name, value)
    rows = _corpus(3)
    got = op.divergences(_table(spark, rows, 5), min_docs=9, ranks=12, entries=20 if small else 10 ** 6).collect()
    assert sorted(map(tuple, got)) == _brute_divergence(rows, 9, 12)


def test_stripes_fold_long_texts_in_slices(monkeypatch):
    from tidelog.llm import source_divergence as op
    raw = " ".join(f"Wörd{'abcdefgh'[i % 8] * (1 + i % 5)} x{i}y" for i in range(500)).encode()
    whole = op.Stripes()
    whole.add("en", "s", raw)
    monkeypatch.setattr(op, "SLICE", 100)
    cut = op.Stripes()
    cut.add("en", "s", raw)
    assert cut.docs == whole.docs and cut.counts == whole.counts and len(whole.docs["en"]) == 42


def test_divergence_without_kept_terms(spark):
    from tidelog.llm.source_divergence import divergences
    rows = [(1, "a b", "en", "x"), (2, None, "en", "y"), (3, "ü", None, None)]
    assert sorted(map(tuple, divergences(_table(spark, rows)).collect())) == [
        ("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
    assert divergences(_table(spark, [])).collect() == []


def test_shares_are_exact_for_large_counts():
    from tidelog.llm.source_divergence import shares
    rnd = random.Random(2)
    counts = [rnd.randrange(10 ** rnd.randint(1, 14)) for _ in range(500)]
    total, v = sum(counts) % (9 * 10 ** 15), 500
    total = max(total, max(counts))
    got = shares(np.array(counts), np.int64(total), v).tolist()
    assert got == [1 + 1_000_000_000 * (c + 5) // (total + 5 * v) for c in counts]


# -- 13: filter interactions --------------------------------------------------

def _brute_interactions(rows, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for d, t, _, _ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    fails = defaultdict(list)
    for d, t, _, source in rows:
        t = t or ""
        w = _words(t)
        bad = set()
        if len(w) < 50:
            bad.add("A")
        if 100 * len(set(w)) < 65 * len(w):
            bad.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t):
            bad.add("C")
        if re.search(r"[#$%&*|]", t):
            bad.add("D")
        if d is not None and d > least[t]:
            bad.add("E")
        fails[source or ""].append((bad, d in good, d in toxic))
    out = []
    orders = ["".join(p) for p in permutations("ABCDE")]
    for part, docs in fails.items():
        shapley = Counter()
        rows_ = []
        for o in orders:
            gone = [min((o.index(f) for f in bad), default=9) for bad, _, _ in docs]
            for k, f in enumerate(o):
                here = [d for d, g in zip(docs, gone, strict=True) if g == k]
                shapley[f] += len(here)
                rows_.append((part, o, k + 1, f, sum(g > k for g in gone), len(here),
                              sum(f in d[0] and g < k for d, g in zip(docs, gone, strict=True)),
                              sum(d[0] == {f} for d in docs), sum(d[1] for d in here), sum(d[2] for d in here)))
        out += [(*r[:3], *r[4:], shapley[r[3]]) for r in rows_]
    return sorted(out)


def test_failures_of_long_texts_in_slices(monkeypatch):
    from tidelog.llm import filter_audit as op
    raws = [(t or "").encode() for _, t, _, _ in _corpus(8)] + [b"x" * 900 + b" y z " + b"q" * 70]
    want = [op.failed(r) for r in raws]
    monkeypatch.setattr(op, "SLICE", 16)
    assert [op.failed(r) for r in raws] == want


def test_interactions_equal_brute_force(spark):
    from tidelog.llm import filter_audit as op
    rows = _corpus(4) + [(5, "again", None, None), (5, "again", "en", "s1")]
    rnd = random.Random(6)
    labels = [(rnd.choice((None, *range(600))), rnd.choice((0, 1, None)), rnd.choice((0, 1, None))) for _ in range(500)]
    got = op.interactions(_table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert sorted(map(tuple, got.collect())) == _brute_interactions(rows, labels)


def test_interactions_of_nothing(spark):
    from tidelog.llm.filter_audit import interactions
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interactions(_table(spark, []), labels).collect() == []
    one = interactions(_table(spark, [(1, None, None, None)]), labels).collect()
    assert len(one) == 600 and {r.part for r in one} == {""}


def test_min_plus_steps():
    from tidelog.llm.filter_audit import FILTERS, MASKS, ORDERS, removal_steps
    steps = removal_steps()
    for m in range(MASKS):
        for j, o in enumerate(ORDERS):
            assert steps[m, j] == min((o.index(FILTERS[k]) + 1 for k in range(5) if m >> k & 1), default=6)


def test_long_words_are_not_cut():
    from tidelog.llm import filter_audit, source_divergence
    raw = (b"a" * 40 + b" ") * 30 + b"b" * 500 + b" c"
    for module, at in ((filter_audit, 16), (source_divergence, 16)):
        was, module.SLICE = module.SLICE, at
        try:
            if module is filter_audit:
                got = [w for s in module._slices(raw) for w in s.split()]
            else:
                got = [w for s in module._slices(raw) for w in s]
            assert got == raw.split()
        finally:
            module.SLICE = was
