"""Language identification in two steps: family, then language within it.

A text becomes hashed counts of letter n-grams (one to three letters, words
bounded by a blank), damped by log and scaled to unit length. Linear support
vector machines against the rest pick the family; one-versus-one linear
machines separate the languages of that family, by votes, then margins.

The machines are fitted on a bounded sample: of each language about
``per_language`` labelled training rows, chosen by a hash of the id. The
sample's vectors are made on the executors; the driver fits at most
``per_language`` times the number of languages of them. Prediction reads whole
texts and nothing but the text.

Defined cases: a null text or one without a letter is ``und`` with score 0;
without any training row everything is ``und``; rows with a null language or
id do not train; repeated rows are predicted each by itself, and train each by
itself. A very long text is counted slice by slice.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import text_batches

DIMS = 4096
SLICE = 100_000    # characters counted at a time
PER_LANGUAGE = 500
UNKNOWN = "und"
HELD_OUT = 2       # remainder of crc32(id) by 4 that never trains

# Language codes by family. A code not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bg", "mk"),
    "indic": ("hi", "bn", "mr", "gu", "pa", "ur", "ne"),
    "turkic": ("tr", "az", "kk", "uz"),
    "uralic": ("fi", "et", "hu"),
    "baltic": ("lt", "lv"),
    "cjk": ("zh", "ja", "ko"),
}


def family_of(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang in codes), lang)


# ---------------------------------------------------------------------------
# features
# ---------------------------------------------------------------------------

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def _mix(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(40)) & np.uint64(DIMS - 1)


def features(text: str | None) -> np.ndarray | None:
    """Unit vector of a text's letter n-grams; None without any letter."""
    if not text:
        return None
    text = text.lower()
    n = np.zeros(DIMS, dtype=np.int64)
    seen, before, last = False, False, np.array([32], dtype=np.uint64)

    def add(c: np.ndarray, own: bool = True) -> np.ndarray:
        """Counts what ends in ``c``, which follows ``last``."""
        c = np.concatenate([last, c])
        pair = c[:-1] * np.uint64(0x1F3D5B79) + c[1:]
        three = pair[:-1] * np.uint64(0x2545F491) + c[2:]
        for x in (c[len(last):] if own else c[:0], pair[len(last) - 1:], three):
            n[:] += np.bincount(_mix(x).astype(np.int64), minlength=DIMS)
        return c[-2:]

    for i in range(0, len(text), SLICE):
        codes = np.frombuffer(text[i:i + SLICE].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _letters()[codes]
        seen |= bool(letter.any())
        # every run of other characters is one blank; a blank on either end
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] |= before
        before = bool(letter[-1])
        last = add(np.where(letter, codes, 32)[keep].astype(np.uint64))
    if not seen:
        return None
    add(np.array([32], dtype=np.uint64), False)
    x = np.log1p(n).astype(np.float32)
    return x / np.linalg.norm(x)


# ---------------------------------------------------------------------------
# fitting
# ---------------------------------------------------------------------------

def fit_machine(x: np.ndarray, y: np.ndarray, c: float = 20.0, rounds: int = 200) -> np.ndarray:
    """Weights (last: bias) of a linear machine with squared hinge loss, both
    classes weighing the same; ``y`` is 1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)]).astype(np.float32, copy=False)
    y = y.astype(np.float32)
    per = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32) * np.float32(c)
    step = np.float32(1.0 / (1.0 + 2 * c * 2.0))
    w = v = np.zeros(x.shape[1], dtype=np.float32)
    t = 1.0
    for _ in range(rounds):
        slack = np.maximum(np.float32(0), 1 - y * (x @ v))
        z = v - step * (v - 2 * (x.T @ (per * slack * y)))
        t, was = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v, w = z + np.float32((was - 1) / t) * (z - w), z
    return w.astype(np.float32)


class Model:
    """Fitted machines: ``weights`` has one column per family, then per pair."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        names = np.array(langs, dtype=object)
        family = np.array([family_of(l) for l in langs], dtype=object)
        self.families = sorted(set(family))
        self.members = {f: sorted(set(names[family == f])) for f in self.families}
        columns = []
        if len(self.families) > 1:
            columns += [fit_machine(x, np.where(family == f, 1.0, -1.0)) for f in self.families]
        self.pairs: dict[tuple[str, str], int] = {}
        for f in self.families:
            for a, b in combinations(self.members[f], 2):
                own = (names == a) | (names == b)
                self.pairs[a, b] = len(columns)
                columns.append(fit_machine(x[own], np.where(names[own] == a, 1.0, -1.0)))
        self.weights = np.stack(columns, 1) if columns else np.zeros((DIMS + 1, 0), dtype=np.float32)

    def predict(self, text: str | None) -> tuple[str, float]:
        x = features(text) if self.families else None
        if x is None:
            return UNKNOWN, 0.0
        m = x @ self.weights[:-1] + self.weights[-1]
        sure = np.inf
        family = self.families[0]
        if len(self.families) > 1:
            order = np.argsort(-m[:len(self.families)], kind="stable")
            family = self.families[order[0]]
            sure = float(m[order[0]] - m[order[1]]) / 2
        members = self.members[family]
        votes = {l: [0, 0.0, np.inf] for l in members}
        for a, b in combinations(members, 2):
            d = float(m[self.pairs[a, b]])
            for l, own in ((a, d), (b, -d)):
                v = votes[l]
                v[0] += own > 0
                v[1] += own
                v[2] = min(v[2], own)
        best = min(members, key=lambda l: (-votes[l][0], -votes[l][1], l))
        sure = min(sure, votes[best][2])
        return best, 1.0 if sure == np.inf else float(max(0.0, np.tanh(sure)))


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == HELD_OUT, F.lit(False))


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = PER_LANGUAGE) -> Model:
    """Fit on about ``per_language`` rows of each language of ``labelled``."""
    text_batches(labelled.sparkSession)
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
                           ).where("id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    # one row per language
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Model(np.zeros((0, DIMS), dtype=np.float32), [])
    unit = F.pmod(F.xxhash64(F.col("id")), F.lit(1 << 30)) / float(1 << 30)
    share = F.element_at(F.create_map(*[F.lit(v) for l, n in sorted(counts.items())
                                        for v in (l, min(1.0, per_language / n))]), F.col("lang"))

    @F.pandas_udf("binary")
    def vector(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if (x := features(t)) is None else x.tobytes())

    # texts without a letter are left out here: a filter on x would make every
    # vector twice, each task in two Python workers
    got = rows.where(unit < share).select("id", "lang", vector("text").alias("x")).toPandas()
    got = got[got.x.notna()].sort_values(["id", "lang"], kind="stable")
    if got.empty:
        return Model(np.zeros((0, DIMS), dtype=np.float32), [])
    return Model(np.stack([np.frombuffer(b, dtype=np.float32) for b in got.x]), list(got.lang))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` in place of any such columns."""
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        own = shared.value
        return pd.DataFrame([own.predict(t) for t in texts], columns=["lang_pred", "score"])

    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    return docs.select(*kept, run(F.col(text_col)).alias("__lang")).select(
        *kept, F.col("__lang.lang_pred"), F.col("__lang.score"))


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out("doc_id")))
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
