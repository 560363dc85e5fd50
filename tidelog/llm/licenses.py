"""Licence scans: text compared with templates by Dice over word bigrams.

A text is normalised to lower-case words of letters, digits and dots inside
numbers. Its units are its lines, the whole text if it has several, and runs of
consecutive lines. A unit's set of word bigrams is compared with each
template's; the Dice coefficient is twice the number of shared bigrams over the
sum of both sizes. It can only reach the threshold t if the sizes' ratio is at
least t / (2 - t), and then the unit holds that share of the template's bigrams
too. So a document is compared only with templates of which it holds so many
bigrams. Of a long template a part of the bigrams is looked for first: as many
as a match can't miss, and some more.

Templates are short notices, and the texts and headers in ``licence_texts``. A
run may have as many words as the template over that ratio. Every run of such a
length is looked at that begins in a line with a bigram of the template (others
score less than the run without that line); of the runs from one line the best
counts, and of equal ones the longest. A run is a match if it scores more than each of its lines for the same
template, and if no better run overlaps it whose template's size is within that
ratio: so the header inside a licence's text is a match of its own, and a
run of GPL text is not one of LGPL text too.

Built-in column functions only, row by row, without a shuffle but for the sum
over the units of a document; the templates are a parameter, and part of the
plan as literals.

Defined cases: a null or empty text has no match; a unit of one word has no
bigram and no match; of several matches of a line or the whole text the best
score counts, ties to the first name; a run of all words of a text is the whole
text, and no unit of its own; repeated rows are scanned each by itself.
"""

from __future__ import annotations

import math
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

# Short licence notices by identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
           "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

# Licence texts and headers: (identifier, text)
TEXTS = [(p.name.split("--")[0], p.read_text()) for p in sorted(Path(__file__).with_name("licence_texts").glob("*.txt"))]

WORD = r"[a-z0-9]+(?:\.[0-9]+)*"


def template_bigrams(text: str) -> list[str]:
    words = re.findall(WORD, text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def _let(value: Column, f) -> Column:
    return F.transform(F.array(value), f)[0]


def _words(unit: Column) -> Column:
    return F.regexp_extract_all(F.lower(unit), F.lit(WORD), F.lit(0))


def _bigrams(words: Column) -> Column:
    return F.array_distinct(F.transform(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
                                        lambda w, i: F.concat_ws(" ", words[i], w)))


def _template(number: int, name: str, text: str, threshold: float) -> tuple[Column, list[str]]:
    """A template as a literal struct, and its bigrams to look for first."""
    grams = template_bigrams(text)
    ratio = threshold / (2 - threshold)
    low, high = math.ceil(ratio * len(grams)), math.floor(len(grams) / ratio)
    # a match misses len(grams) - low bigrams at most; long ones are rarer
    first = sorted(grams, key=lambda g: (-len(g), g))[:max(60, len(grams) - low + len(grams) // 20)]
    words = math.floor(len(re.findall(WORD, text.lower())) / ratio)
    listed = lambda g: F.split(F.lit("\n".join(g)), "\n")
    return F.struct(
        F.lit(number).alias("number"), F.lit(name).alias("license"), listed(grams).alias("grams"),
        listed(first).alias("first"), F.lit(len(first) - (len(grams) - low)).alias("need"), F.lit(low).alias("low"),
        F.lit(high).alias("high"), F.lit(words).alias("words")), first


def _scores(own: Column, candidates: Column, threshold: float) -> Column:
    """array of struct(score, license, number), scores negative, of the
    templates that a unit's bigrams match."""
    near = F.filter(candidates, lambda t: F.size(own).between(t["low"], t["high"]))
    scored = F.transform(near, lambda t: F.struct(
        (-2.0 * F.size(F.array_intersect(own, t["grams"])) / (F.size(own) + F.size(t["grams"]))).alias("score"),
        t["license"].alias("license"), t["number"].alias("number")))
    return F.filter(scored, lambda s: s["score"] <= -threshold)


def _lines(ws: Column) -> Column:
    """struct(line, from, to) of each line that has words: the words before it,
    and those up to its end."""
    last = lambda n: F.filter(F.transform(n, lambda i, p: F.when(
        i != F.coalesce(F.get(n, p + 1), F.lit(-1)), F.struct(i.alias("line"), (p + 1).alias("to")))),
        lambda e: e.isNotNull())
    return _let(F.flatten(F.transform(ws, lambda w, i: F.transform(w, lambda _: i))), lambda n: _let(
        last(n), lambda es: F.transform(es, lambda e, k: F.struct(
            e["line"].alias("line"), F.coalesce(F.get(es, k - 1)["to"], F.lit(0)).alias("from"), e["to"].alias("to")))))


def _groups(words: Column) -> Column:
    """struct(gram, kind, places) of each distinct bigram, in their order; a
    place is (at, was): the number of the first word, and the one of the same
    bigram's occurrence before (0 if there is none)."""
    listed = F.transform(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.struct(
        F.concat_ws(" ", words[i], w).alias("gram"), (i + 1).alias("at")))
    heads = lambda s: F.filter(F.transform(s, lambda x, i: F.when(
        ~x["gram"].eqNullSafe(F.get(s, i - 1)["gram"]), i)), lambda i: i.isNotNull())
    places = lambda own: F.transform(own, lambda x, j: F.struct(
        x["at"].alias("at"), F.coalesce(F.get(own, j - 1)["at"], F.lit(0)).alias("was")))
    return _let(F.array_sort(listed), lambda s: _let(heads(s), lambda hs: F.transform(hs, lambda h, k: F.struct(
        s[h]["gram"].alias("gram"), F.lit(1).alias("kind"), _let(
            F.slice(s, h + 1, F.coalesce(F.get(hs, k + 1), F.size(s)) - h), places).alias("places")))))


def _marked(groups: Column, hits: Column) -> Column:
    """struct(at, was, hit) of each word but the last with the one after, in
    text order; a hit is a bigram of ``hits``. Both are sorted together, so
    that a bigram that is hit follows its like."""
    none = F.array().cast("array<struct<at:int,was:int>>")
    known = F.transform(hits, lambda g: F.struct(g.alias("gram"), F.lit(0).alias("kind"), none.alias("places")))
    return _let(F.array_sort(F.concat(groups, known)), lambda gs: F.array_sort(F.flatten(F.transform(
        gs, lambda g, i: _let(g["gram"].eqNullSafe(F.get(gs, i - 1)["gram"]), lambda hit: F.transform(
            g["places"], lambda x: F.struct(x["at"].alias("at"), x["was"].alias("was"), hit.alias("hit"))))))))


def _counted(lines: Column, tokens: Column) -> Column:
    """``lines`` with what a run needs to count their bigrams: how many occur
    for the first time in the text, and the place before of each other one, of
    all and of hits; the same of the bigram that leads into the line."""
    first = lambda own, f: F.size(F.filter(own, lambda x: f(x) & (x["was"] == 0)))
    again = lambda own, f: F.transform(F.filter(own, lambda x: f(x) & (x["was"] > 0)), lambda x: x["was"])
    every, hit = lambda x: F.lit(True), lambda x: x["hit"]
    return F.transform(lines, lambda l: _let(F.slice(tokens, l["from"] + 1, l["to"] - l["from"] - 1), lambda own: F.struct(
        l["line"].alias("line"), l["from"].alias("from"), l["to"].alias("to"),
        first(own, every).alias("new"), first(own, hit).alias("new_hits"),
        again(own, every).alias("was"), again(own, hit).alias("was_hits"), F.get(tokens, l["from"] - 1).alias("lead"))))


def _runs(groups: Column, lines: Column, place: Column, scores: Column, t: Column, threshold: float) -> Column:
    """struct(score, license, line, last, from, to, number, size) of the best run
    of the template ``t`` from each line. ``place`` has the index in ``lines`` of
    each word, ``scores`` what each line alone scores."""
    since = lambda was, a: F.size(F.filter(was, lambda w: w <= a))

    def best(rows: Column, k: Column) -> Column:
        a = rows[k]["from"]
        start = F.struct((rows[k]["new"] + since(rows[k]["was"], a)).alias("own"),
                         (rows[k]["new_hits"] + since(rows[k]["was_hits"], a)).alias("both"),
                         F.lit(0.0).alias("score"), F.lit(-1).alias("last"), F.lit(0).alias("to"))
        end = F.coalesce(F.get(place, a + t["words"] - 1), F.size(rows) - 1)

        def step(s: Column, r: Column) -> Column:
            lead = F.when(r["lead"]["was"] <= a, 1).otherwise(0)
            counted = F.struct(
                (s["own"] + r["new"] + since(r["was"], a) + lead).alias("own"),
                (s["both"] + r["new_hits"] + since(r["was_hits"], a) + F.when(r["lead"]["hit"], lead).otherwise(0)).alias("both"))
            return _let(counted, lambda c: _let(F.when(
                (r["to"] - a <= t["words"]) & c["own"].between(t["low"], t["high"]),
                2.0 * c["both"] / (c["own"] + F.size(t["grams"]))).otherwise(0.0), lambda d: F.struct(
                    c["own"].alias("own"), c["both"].alias("both"), F.greatest(d, s["score"]).alias("score"),
                    F.when(d >= s["score"], r["line"]).otherwise(s["last"]).alias("last"),
                    F.when(d >= s["score"], r["to"]).otherwise(s["to"]).alias("to"))))

        return F.aggregate(F.slice(rows, k + 2, end - k), start, step, lambda s: F.struct(
            (-s["score"]).alias("score"), t["license"].alias("license"), rows[k]["line"].alias("line"),
            s["last"].alias("last"), a.alias("from"), s["to"].alias("to"), t["number"].alias("number"),
            F.size(t["grams"]).alias("size")))

    def begins(hits: Column, rows: Column) -> Column:
        """Lines with a hit from which as many follow as a match needs."""
        lined = F.transform(hits, lambda x, p: F.struct(place[x["at"] - 1].alias("k"), p.alias("p")))
        return _let(lined, lambda ls: F.transform(F.filter(ls, lambda x: ~x["k"].eqNullSafe(F.get(ls, x["p"] - 1)["k"]) & (
            F.get(hits, x["p"] + t["low"] - 1)["at"] <= rows[x["k"]]["from"] + t["words"] - 1)), lambda x: x["k"]))

    def found(tokens: Column) -> Column:
        whole = lambda r: (r["from"] == 0) & (r["to"] == F.size(tokens) + 1)
        beaten = lambda r: F.exists(F.slice(scores, r["line"] + 1, r["last"] - r["line"] + 1), lambda own: F.exists(
            own, lambda s: (s["number"] == t["number"]) & (s["score"] <= r["score"])))
        return _let(_counted(lines, tokens), lambda rows: _let(F.filter(tokens, lambda x: x["hit"]), lambda hits: F.filter(
            F.transform(begins(hits, rows), lambda k: best(rows, k)),
            lambda r: (r["score"] <= -threshold) & ~whole(r) & ~beaten(r))))

    # a match holds at least ``low`` of the template's bigrams
    return _let(F.array_intersect(F.transform(groups, lambda g: g["gram"]), t["grams"]), lambda hits: F.when(
        F.size(hits) >= t["low"], _let(_marked(groups, hits), found)))


def _chosen(runs: Column, threshold: float) -> Column:
    """``runs`` without those that a better one stands in the way of."""
    ratio = threshold / (2 - threshold)
    over = lambda a, b: (a["from"] < b["to"]) & (b["from"] < a["to"]) & (
        F.least(a["size"], b["size"]) >= ratio * F.greatest(a["size"], b["size"]))
    return _let(F.array_sort(runs), lambda rs: F.aggregate(rs, F.slice(rs, 1, 0), lambda kept, r: F.when(
        F.exists(kept, lambda k: over(k, r)), kept).otherwise(F.concat(kept, F.array(r)))))


def _matches(ws: Column, words: Column, candidates: Column, threshold: float) -> Column:
    """Matches of the text with the lines of words ``ws``, together ``words``."""
    scores = lambda w: _let(_bigrams(w), lambda own: _scores(own, candidates, threshold))
    match = lambda line, last, s: F.struct(
        line.alias("line"), last.alias("last"), (-s["score"]).alias("score"), s["license"].alias("license"))
    best = lambda own: F.array_min(F.transform(own, lambda s: F.struct(s["score"], s["license"])))

    def all_units(groups: Column, filled: Column, lines: Column) -> Column:
        of_lines = F.filter(F.transform(lines, lambda own, i: F.when(F.size(own) > 0, _let(
            best(own), lambda s: match(i + 1, i + 1, s)))), lambda m: m.isNotNull())
        of_all = _let(scores(words), lambda own: F.when(F.size(own) > 0, F.array(_let(
            best(own), lambda s: match(F.lit(0), F.lit(0), s)))).otherwise(F.slice(of_lines, 1, 0)))
        place = F.flatten(F.transform(filled, lambda l, k: F.array_repeat(k, l["to"] - l["from"])))
        runs = _let(place, lambda at: F.flatten(F.filter(F.transform(
            candidates, lambda t: _runs(groups, filled, at, lines, t, threshold)), lambda r: r.isNotNull())))
        of_runs = F.transform(_chosen(runs, threshold), lambda r: match(r["line"] + 1, r["last"] + 1, r))
        return F.when(F.size(ws) > 1, F.array_sort(F.concat(of_all, of_lines, of_runs))).otherwise(of_lines)

    return _let(_groups(words), lambda g: _let(_lines(ws), lambda f: _let(
        F.transform(ws, scores), lambda ls: all_units(g, f, ls))))


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD,
         id_col: str = "doc_id", text_col: str = "text", texts: list[tuple[str, str]] | None = None) -> DataFrame:
    """(id, matches) per row: array of (line, last, score, license) in text
    order, from the first to the last line of the unit; lines count from 1,
    and 0 is the whole text. ``texts`` are more templates, ``TEXTS`` if None."""
    named = sorted([*templates.items(), *(TEXTS if texts is None else texts)])
    built = [_template(i, n, t, threshold) for i, (n, t) in enumerate(named)]
    known = F.array(*[t for t, _ in built])
    looked_for = sorted({g for _, first in built for g in first})

    def matches(ws: Column, words: Column) -> Column:
        hits = F.filter(_bigrams(words), lambda g: g.isin(looked_for))
        candidates = _let(hits, lambda h: F.filter(known, lambda t: (F.size(h) >= t["need"]) & (
            F.size(F.array_intersect(h, t["first"])) >= t["need"])))
        return _let(candidates, lambda c: F.when(F.size(c) > 0, _matches(ws, words, c, threshold)))

    lines = F.transform(F.split(F.col(text_col), "\n"), _words)
    return docs.select(F.col(id_col), F.coalesce(
        F.when(F.col(text_col).isNotNull(), _let(lines, lambda ws: _let(F.flatten(ws), lambda w: matches(ws, w)))),
        F.array().cast("array<struct<line:int,last:int,score:double,license:string>>")).alias("matches"))


def op7_license_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    best = F.array_min(F.transform("matches", lambda m: F.struct(
        (-m["score"]).alias("s"), m["license"].alias("l"), m["line"].alias("n"))))
    return scan(docs).select(
        "doc_id", F.size("matches").cast("long").alias("n_matches"), best["l"].alias("license"),
        F.coalesce(F.round(-best["s"], 9), F.lit(0.0)).alias("score"),
        F.coalesce(best["n"], F.lit(-1)).cast("long").alias("line"))


def _oracle() -> str:
    rows = ", ".join(f"('{n}', '{t}')" for n, t in sorted(TEMPLATES.items()))
    grams = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    words = "regexp_extract_all(lower({}), '" + WORD + "')"
    return f"""
WITH t AS (SELECT name, {grams} AS g FROM (SELECT name, {words.format('body')} AS w FROM (VALUES {rows}) v(name, body))),
ls AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
u AS (SELECT doc_id, unnest(l) AS unit, unnest(range(1, len(l) + 1)) AS line FROM ls
      UNION ALL SELECT doc_id, text, 0 FROM ls WHERE len(l) > 1),
w AS (SELECT doc_id, line, {words.format('unit')} AS w FROM u),
b AS (SELECT doc_id, line, {grams} AS g FROM w WHERE len(w) >= 2 OR line = 0),
s AS (SELECT doc_id, line, name, 2.0 * len(list_intersect(b.g, t.g)) / (len(b.g) + len(t.g)) AS score
      FROM b JOIN t ON len(b.g) BETWEEN ceil(len(t.g) * {THRESHOLD} / (2 - {THRESHOLD}))
                                  AND floor(len(t.g) / ({THRESHOLD} / (2 - {THRESHOLD})))),
m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY score DESC, name) AS r
                     FROM s WHERE score >= {THRESHOLD}) WHERE r = 1),
p AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n,
             row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, name, line) AS k FROM m)
SELECT d.doc_id, CAST(coalesce(p.n, 0) AS BIGINT) AS n_matches, p.name AS license, coalesce(round(p.score, 9), 0) AS score,
       CAST(coalesce(p.line, -1) AS BIGINT) AS line
FROM documents d LEFT JOIN p ON p.doc_id = d.doc_id AND p.k = 1
"""


ORACLE = _oracle()
