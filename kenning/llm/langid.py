"""Language identification by error-correcting output codes.

Each language has a codeword; each bit of the code is predicted by a binary classifier over hashed byte n-grams of the
lower-cased letters. A classifier's weights are log odds of the n-gram between the languages whose bit is set and the
others, from n-gram counts of all labelled training texts: the counts are summed by Spark, and what reaches the driver
is one number per language and n-gram bucket, whatever the corpus. Decoding takes the codeword with the least logistic
loss over the bits; texts whose two best codewords are close are flagged as ambiguous.

Held out: documents whose crc32(doc_id as text) mod 4 is 2 are never learned from. A null doc_id is neither held out
nor learned from. Only the text is an input of a prediction.

Confidence grows with the number of n-grams up to SATURATION of them an order: a margin is the mean weight of all the
text's n-grams, times that number or their own number if it is less. No text is cut.

Defined results: null texts and texts without a letter are `und` with score 0; so is every text if no language was
learned; ties go to the alphabetically first language; repeated rows give equal rows; very long texts are read whole, in
time and memory in proportion to their length; an empty table gives an empty result; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kenning.llm.common import columns

#: Buckets of an n-gram order; the orders; the n-grams after which more text adds no confidence.
BUCKETS, ORDERS, SATURATION = 1 << 13, (1, 2, 3, 4), 200
_MULTIPLIER = np.uint32(2654435761)
_PLAIN = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))
_LETTER = regex.compile(r"\p{L}")


def features(text: str) -> np.ndarray:
    """Counts by bucket, orders one after another."""
    raw = b" " + b" ".join(text.lower().encode("utf-8").translate(_PLAIN).split()) + b" "
    b = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
    out, gram = np.zeros(BUCKETS * len(ORDERS), dtype=np.float64), b
    for k, n in enumerate(ORDERS):
        if n > 1:
            gram = (gram[:-1] << np.uint32(8)) | b[n - 1 :]
        if len(gram):
            out[k * BUCKETS : (k + 1) * BUCKETS] = np.bincount((gram * _MULTIPLIER) >> np.uint32(19), minlength=BUCKETS)
    return out


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def codewords(n: int) -> np.ndarray:
    """n codewords of +1 and -1: all dichotomies up to 7 classes, else the random ones of 30 draws whose two nearest are farthest apart; fixed by n."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 7:
        columns = [[1] + [1 if k >> i & 1 else -1 for i in range(n - 1)] for k in range(2 ** (n - 1) - 1)]
        return np.array(columns).T
    random = np.random.default_rng(n)
    bits = int(15 * np.ceil(np.log2(n)))
    best, most = None, -1
    for _ in range(30):
        code = random.choice([-1, 1], (n, bits))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        apart = (code.shape[1] - code @ code.T) // 2  # of all pairs of codewords
        least = int(apart[~np.eye(n, dtype=bool)].min())
        if least > most:
            best, most = code, least
    return best


class Model:
    def __init__(self, languages: list[str], counts: np.ndarray, smoothing: float = 0.5):
        """counts: a row per language."""
        self.languages = languages
        self.code = codewords(len(languages))
        if not languages:
            return
        shares = []
        for k in range(len(ORDERS)):
            part = counts[:, k * BUCKETS : (k + 1) * BUCKETS] + smoothing
            shares.append(part / part.sum(axis=1, keepdims=True))
        share = np.concatenate(shares, axis=1)
        weights = []
        for column in self.code.T:
            one, other = share[column > 0], share[column < 0]
            weights.append(np.log(one.mean(axis=0)) - np.log(other.mean(axis=0)) if len(one) and len(other) else np.zeros(share.shape[1]))
        self.weights = np.ascontiguousarray(np.array(weights).T)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether it is ambiguous."""
        if not text or not self.languages or not _LETTER.search(text):
            return "und", 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        x = features(text)
        total = x.sum()
        margin = (x @ self.weights) / total * min(total / len(ORDERS), SATURATION)
        loss = np.logaddexp(0.0, -self.code * np.clip(margin, -30, 30)).sum(axis=1)
        order = np.argsort(loss, kind="stable")
        near = np.exp(-(loss - loss[order[0]]) / self.code.shape[1] * 4)
        score = float(near[order[0]] / near.sum())
        return self.languages[order[0]], score, bool(loss[order[1]] - loss[order[0]] < 0.1 * self.code.shape[1])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts over all texts with a language that aren't held out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x = features(text)
                n = x.sum()
                if n:
                    # A text counts with the square root of its length, so a few huge ones don't make a language.
                    sums.setdefault(lang, np.zeros(len(x)))
                    sums[lang] += np.rint(x * (1000.0 / np.sqrt(n)))
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(total[at].astype(np.int64))], names=["lang", "bucket", "n"])

    docs = columns(docs, doc_id=id_col, text=text_col, lang=lang_col)
    id_col, text_col, lang_col = docs.columns
    labelled = docs.filter(F.col(id_col).isNotNull() & ~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counted = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "lang string, bucket int, n long")
    rows = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows["lang"].unique().tolist())
    counts = np.zeros((len(languages), BUCKETS * len(ORDERS)))
    row = {lang: k for k, lang in enumerate(languages)}
    counts[[row[x] for x in rows["lang"]], rows["bucket"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy()
    return Model(languages, counts)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score, ambiguous."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = columns(docs, doc_id=id_col, text=text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            found = [m.predict(t) for t in batch.column(2).to_pylist()]
            lang, score, unclear = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(unclear, pa.bool_())], names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    slim = docs.select("doc_id", held_out().alias("held_out"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, ambiguous boolean")
