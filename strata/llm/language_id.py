"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts the n-grams (1 to 3 code points of the lower-cased text, runs
of other than letters as one space) by language, in 2**15 buckets. The matrix
of log probabilities (languages x buckets) is broadcast, and texts are scored
in numpy by summing the columns of their n-grams. The score is the posterior;
it is near 1 after a few words, whatever they are. How well a text fits its
language is told by ``fit``: its mean log probability per n-gram less what the
n-grams of the training rows reach (each without its own count), in standard
deviations of theirs, with ``SHORT / sqrt(n)`` added for a text of n n-grams.

The classifier is fitted on a bounded sample: of each language
``docs_per_lang`` training documents are expected, chosen by a hash of their
id; languages with fewer give all. Priors count all training documents.

Edge cases: a null text, or one without letters, is ``und`` with score 0; so
is every text if there is no training row. Rows without a language are not
learned from. Equal scores: the first language in order of its name. The
languages are few (their number, not the corpus, sizes the matrix). Extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import pieces, text_bytes, texts

BUCKETS = 1 << 15
NGRAMS = 3
DOCS_PER_LANG = 4000
SHORT = 5.0
_CHUNK = 1 << 18
_SHIFT = np.uint32(32 - 15)
_LETTER: list[np.ndarray] = []


def _points(text: str) -> np.ndarray:
    """Lower-cased code points, runs of non-letters as one space, framed by spaces."""
    if not _LETTER:
        _LETTER.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    p = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _LETTER[0][p]
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]  # the first of a run of non-letters
    return np.where(letter, p, np.uint32(32))[keep]


def grams(text: str) -> np.ndarray:
    """Buckets of all n-grams; empty if the text has no letter."""
    p = _points(text)
    if len(p) < 2:
        return np.zeros(0, np.int64)
    x = (p + np.uint32(1)) * np.uint32(0x9E3779B1)
    out, h = [], x
    for n in range(1, NGRAMS + 1):
        if n > 1:
            h = (h[: len(h) - 1] ^ (h[: len(h) - 1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + x[n - 1 :]
        y = (h ^ (h >> np.uint32(16))) * np.uint32(0xC2B2AE35)
        out.append(y >> _SHIFT)
    return np.concatenate(out).astype(np.int64)


def _parts(text: str) -> Iterator[str]:
    for at in range(0, max(1, len(text)), _CHUNK):
        yield text[at : at + _CHUNK]


class Model:
    """Languages (sorted), log priors and log probabilities by bucket."""

    def __init__(self, langs: list[str], priors: np.ndarray, counts: np.ndarray):
        self.langs = langs
        n = priors.astype(np.float64) + 1
        self.prior = np.log(n / n.sum()) if len(langs) else n
        smooth = counts + 0.5
        self.logp = np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)
        held = np.log(np.maximum(counts - 0.5, 0.5) / smooth.sum(axis=1, keepdims=True))
        share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
        self.mean = (share * held).sum(axis=1)
        self.spread = np.sqrt(np.maximum((share * held**2).sum(axis=1) - self.mean**2, 1e-12))

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.judge(text)[:2]

    def judge(self, text: str | None) -> tuple[str, float, float | None]:
        """The language, its score and the text's fit (none for ``und``)."""
        if not text or not self.langs:
            return "und", 0.0, None
        total, seen = self.prior.copy(), 0
        for part in _parts(text):
            g = grams(part)
            seen += len(g)
            for i, row in enumerate(self.logp):
                total[i] += row.take(g).sum(dtype=np.float64)
        if not seen:
            return "und", 0.0, None
        best = int(total.argmax())
        fit_ = ((total[best] - self.prior[best]) / seen - self.mean[best]) / self.spread[best] + SHORT / np.sqrt(seen)
        return self.langs[best], float(1 / np.exp(total - total[best]).sum()), float(fit_)


def held_out(doc_id) -> F.Column:
    """Documents that training never sees."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_lang: int = DOCS_PER_LANG) -> Model:
    """Learn from rows with a text and a language that are not held out (a
    null id is not held out)."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.filter(F.col("t").isNotNull() & F.col("lang").isNotNull() & ~F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
    priors = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(priors)
    if not langs:
        return Model([], np.zeros(0), np.zeros((0, BUCKETS)))
    rate = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, docs_per_lang / priors[k])))])
    draw = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.filter(draw < rate[F.col("lang")]).select("lang", F.col("t").cast("binary").alias("text"))
    number = {k: i for i, k in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), BUCKETS), np.int64)
        for b in pieces(batches):
            for lang, t in zip(b.column("lang").to_pylist(), texts(b.column("text"))):
                for part in _parts(t):
                    total[number[lang]] += np.bincount(grams(part), minlength=BUCKETS)
        lang, bucket = np.nonzero(total)
        if len(lang):
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(bucket, pa.int32()), pa.array(total[lang, bucket], pa.int64())], names=["lang", "bucket", "n"])

    # at most languages x buckets rows, whatever the corpus
    got = sample.mapInArrow(count, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(langs), BUCKETS))
    counts[got["lang"].to_numpy(), got["bucket"].to_numpy()] = got["n"].to_numpy()
    return Model(langs, np.array([priors[k] for k in langs], np.float64), counts)


def predicted(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score: from the text alone."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in pieces(batches):
            found = [m.predict(t) for t in texts(b.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return text_bytes(df, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")


def with_language(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` with one more column ``_lang`` (struct of lang_pred, score and fit)."""
    from pyspark.sql import types as T

    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("fit", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in pieces(batches, text_col):
            found = [dict(zip(("lang_pred", "score", "fit"), m.judge(t))) for t in b.column(text_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, kind)], names=[*b.schema.names, "_lang"])

    lang = T.StructType().add("lang_pred", "string").add("score", "double").add("fit", "double")
    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("_lang", lang)]))
