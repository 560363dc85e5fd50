"""Licence scans against every unit looked at by itself, and on long inputs."""

import math
import random
import re

from tidelog.llm.licenses import TEXTS, WORD, scan, template_bigrams

DOCS = "doc_id long, text string"


def _plain_scan(text, templates, threshold):
    """All lines, the whole text and all runs of lines against all templates."""
    if text is None:
        return []
    ratio = threshold / (2 - threshold)
    named = [(i, n, set(template_bigrams(t)), len(re.findall(WORD, t.lower()))) for i, (n, t) in enumerate(sorted(templates))]
    lines = [re.findall(WORD, x.lower()) for x in text.split("\n")]
    grams = lambda w: {f"{a} {b}" for a, b in zip(w, w[1:], strict=False)}

    def dice(own, g):
        if math.ceil(ratio * len(g)) <= len(own) <= math.floor(len(g) / ratio):
            return 2.0 * len(own & g) / (len(own) + len(g))
        return 0.0

    def scores(w):
        return [(-d, n, i) for i, n, g, _ in named if (d := dice(grams(w), g)) >= threshold]
    alone = [scores(w) for w in lines]
    out = [(k + 1, k + 1, *min(s)[:2]) for k, s in enumerate(alone) if s]
    if len(lines) == 1:
        return sorted((a, b, round(-s, 9), n) for a, b, s, n in out)
    words = [w for x in lines for w in x]
    if whole := scores(words):
        out.append((0, 0, *min(whole)[:2]))
    ends = [sum(map(len, lines[:k + 1])) for k in range(len(lines))]
    runs = []
    for number, name, g, size in named:
        for i, w in enumerate(lines):
            a = ends[i] - len(w)
            if not grams(words[a:ends[i] + 1]) & g or not w:
                continue
            best = (0.0, -1)
            for j in range(i + 1, len(lines)):
                if lines[j] and ends[j] - a <= math.floor(size / ratio):
                    best = max(best, (dice(grams(words[a:ends[j]]), g), j))
            d, j = best
            beaten = any(s[2] == number and s[0] <= -d for own in alone[i:j + 1] for s in own)
            if d >= threshold and not beaten and (a, ends[j]) != (0, len(words)):
                runs.append((-d, name, i, j, a, ends[j], number, len(g)))
    kept = []
    for r in sorted(runs):
        if not any(k[4] < r[5] and r[4] < k[5] and min(k[7], r[7]) >= ratio * max(k[7], r[7]) for k in kept):
            kept.append(r)
    out += [(r[2] + 1, r[3] + 1, r[0], r[1]) for r in kept]
    return sorted((a, b, round(-s, 9), n) for a, b, s, n in out)


def test_scan_equals_every_unit_by_itself(spark):
    r = random.Random(7)
    words = lambda n: r.choices("abcdefgh", k=n)
    x, y = " ".join(words(8)), " ".join(words(14))
    templates = [("X", x), ("Y", y), ("Z", " ".join(words(30))), ("Y2", f"{y} {x}")]

    def text():
        own = []
        for _ in range(r.randrange(1, 6)):
            own += words(r.randrange(0, 6)) if r.random() < 0.4 else [
                w for w in r.choice(templates)[1].split() if r.random() < 0.95]
        return "".join(w + (r.choice(["\n", "\n\n", " \n"]) if r.random() < 0.25 else " ") for w in own)
    texts = [text() for _ in range(700)] + ["", "\n\n", "a", None, x, f"{x}\n{x}\n{x}", f"\n{y}\n\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    several = 0
    for row in scan(docs, {}, 0.7, texts=templates).collect():
        got = [(m.line, m.last, round(m.score, 9), m.license) for m in row.matches]
        assert got == _plain_scan(texts[row.doc_id], templates, 0.7), texts[row.doc_id]
        several += any(a < b for a, b, _, _ in got)
    assert several > 100


def test_licence_texts_in_a_row_and_in_a_long_text(spark):
    gpl = max((t for n, t in TEXTS if n == "GPL-3.0"), key=len)
    mit = next(t for n, t in TEXTS if n == "MIT")
    r = random.Random(1)
    filler = "\n".join(" ".join(f"w{r.randrange(5000)}" for _ in range(10)) for _ in range(10_000))
    for text, runs in (("hello", []), ("\n".join([gpl] * 4), ["GPL-3.0"] * 4), (f"{filler}\n{mit}\n{filler}", ["MIT"])):
        row = scan(spark.createDataFrame([(1, text)], DOCS)).collect()[0]
        assert [m.license for m in row.matches if m.last - m.line > 12] == runs
