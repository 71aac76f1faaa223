"""Language identification by prediction by partial matching.

Every language has a byte model of contexts of up to ``ORDER`` bytes with frozen counts. A byte is
coded in the longest context that has been met; a context that lacks it codes an escape, with as
many counts as it has different bytes (method C), and the next shorter context goes on without the
bytes that the longer ones have ruled out. The shortest code over all languages names the language.
Code lengths are exact sums over every byte of the text.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import utf8

ORDER = 3
# The bounded sample that the models are fitted on: documents of a language and bytes of each.
SAMPLE_DOCS = 400
SAMPLE_BYTES = 4_000
PIECES = 8
UNKNOWN = "und"
SLICE_BYTES = 256 << 10

_PAD = b"\n" * ORDER
_ASCII_LETTER = re.compile(rb"[A-Za-z]")
PREDICTED = "lang string, score double, bits double"


class Level:
    """Contexts of one length: sorted codes of context and byte with counts, totals of each context."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.grams, self.counts = grams, counts.astype(np.float64)
        context = grams >> np.uint64(8)
        self.contexts, where = np.unique(context, return_inverse=True)
        self.where = where
        self.total = np.bincount(where, self.counts, len(self.contexts))
        self.kinds = np.bincount(where, minlength=len(self.contexts)).astype(np.float64)

    @staticmethod
    def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
        return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), dtype=bool)


class Model:
    """Context tree of one language."""

    def __init__(self, texts: list[bytes], order: int = ORDER):
        codes = np.concatenate([gram_codes(t)[0] for t in texts]) if texts else np.zeros(0, np.uint64)
        self.levels = []
        for k in range(order + 1):
            grams, counts = np.unique(codes & np.uint64((1 << 8 * (k + 1)) - 1), return_counts=True)
            self.levels.append(Level(grams, counts))
        # What a longer context leaves of the next shorter one: counts and kinds of the other bytes.
        self.left = [None]
        for k in range(1, order + 1):
            short, long = self.levels[k - 1], self.levels[k]
            mask = np.uint64((1 << 8 * k) - 1)
            at, _ = Level.find(short.grams, long.grams & mask)
            parent, _ = Level.find(short.contexts, (long.contexts & mask) >> np.uint64(0) & np.uint64((1 << 8 * (k - 1)) - 1))
            used = np.bincount(long.where, short.counts[at], len(long.contexts))
            self.left.append((short.total[parent] - used, short.kinds[parent] - long.kinds))

    def bits(self, codes: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each code in the context of the bytes before it."""
        cost = np.zeros(len(codes))
        rows = np.arange(len(codes))
        came = np.full(len(codes), -1)  # the longer context that has escaped, if any
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            gram = codes[rows] & np.uint64((1 << 8 * (k + 1)) - 1)
            at, known = Level.find(level.contexts, gram >> np.uint64(8))
            place, seen = Level.find(level.grams, gram)
            if not len(level.grams):
                continue
            total, kinds = level.total[at], level.kinds[at]
            if k + 1 < len(self.levels):
                total_left, kinds_left = self.left[k + 1]
                escaped = came >= 0
                total = np.where(escaped, total_left[came] if len(total_left) else total, total)
                kinds = np.where(escaped, kinds_left[came] if len(kinds_left) else kinds, kinds)
            known &= kinds > 0  # a context without bytes that are not ruled out codes nothing
            seen &= known
            whole = np.where(known, total + kinds, 1.0)
            cost[rows] += np.where(seen, np.log2(whole) - np.log2(level.counts[place]),
                                   np.where(known, np.log2(whole) - np.log2(np.maximum(kinds, 1.0)), 0.0))
            # A context that ruled everything out still stands for what it has ruled out.
            met = Level.find(level.contexts, gram >> np.uint64(8))[1]
            came = np.where(met, at, -1)[~seen]
            rows = rows[~seen]
        cost[rows] += np.log2(256 - (self.levels[0].kinds.sum() if len(self.levels[0].grams) else 0))
        return cost


def gram_codes(text: bytes) -> tuple[np.ndarray, int]:
    """For every byte of a text the code of itself and the ``ORDER`` bytes before it."""
    data = np.frombuffer(_PAD + text, dtype=np.uint8).astype(np.uint64)
    n = len(text)
    code = np.zeros(n, dtype=np.uint64)
    for i in range(ORDER + 1):
        code = (code << np.uint64(8)) | data[i:i + n]
    return code, n


def code_lengths(models: list[Model], texts: list[bytes]) -> np.ndarray:
    """Bits of every text under every model. Equal codes of a batch are looked up once."""
    if not texts:
        return np.zeros((0, len(models)))
    codes = [gram_codes(t)[0] for t in texts]
    sizes = np.array([len(c) for c in codes])
    kinds, where = np.unique(np.concatenate(codes), return_inverse=True)
    doc = np.repeat(np.arange(len(texts)), sizes)
    return np.stack([np.bincount(doc, m.bits(kinds)[where], len(texts)) for m in models], axis=1)


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text)) or not text.isascii() and any(c.isalpha() for c in text.decode())


def _pieces(text: Column, draw: Column) -> Column:
    """Up to ``SAMPLE_BYTES`` of a text: the whole of a short one, of a longer one ``PIECES`` pieces, each
    at a hashed place in its part of the text."""
    size, n = F.octet_length(text), SAMPLE_BYTES // PIECES
    part = (size - n) / PIECES

    def piece(i: Column) -> Column:
        share = F.pmod(F.xxhash64(draw, i), F.lit(1_000_003)) / F.lit(1_000_003.0)
        return F.substring(text, (F.floor(part * (i + share)) + 1).cast("int"), F.lit(n))

    return F.when(size <= SAMPLE_BYTES, F.array(text)).otherwise(
        F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), piece))


def fit(docs: DataFrame, held_out: Column) -> dict[str, Model]:
    """A model for every non-null ``lang`` of documents that are not held out.

    At most ``SAMPLE_DOCS`` documents of a language, chosen by a stable hash, with ``SAMPLE_BYTES`` of
    each, taken all over its text: the driver holds no more than this for each language.
    """
    draw = F.xxhash64("doc_id", "text")
    known = docs.select("doc_id", "text", "lang", held_out.alias("_out"), draw.alias("_draw")).filter(
        "NOT _out AND lang IS NOT NULL AND length(text) > 0").drop("_out")
    # The draws alone are ranked; a bounded number of them then fetches the texts from the scan.
    order = Window.partitionBy("lang").orderBy("_draw")
    wanted = known.select("lang", "_draw").distinct().withColumn("_n", F.row_number().over(order)).filter(
        F.col("_n") <= SAMPLE_DOCS).select(F.col("lang").alias("_lang"), F.col("_draw").alias("_key"))
    found = known.join(F.broadcast(wanted), (F.col("lang") == F.col("_lang")) & (F.col("_draw") == F.col("_key")))
    # Rows that are repeated whole count once.
    rows = found.select("lang", "_draw", _pieces(F.col("text").cast("binary"), F.col("_draw")).alias("pieces")).dropDuplicates(
        ["lang", "_draw"]).orderBy("lang", "_draw").collect()
    texts: dict[str, list[bytes]] = {}
    for r in rows:
        texts.setdefault(r.lang, []).extend(bytes(p) for p in r.pieces)
    return {lang: Model(texts[lang]) for lang in sorted(texts)}


def held_out_column() -> Column:
    """Documents that no model learns from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def predictor(models: dict[str, Model]):
    """A column function of the text's bytes: ``lang, score, bits`` (a byte, under the best model).

    Null or empty text and text without a letter give ``und`` and score 0. Equal code lengths go to
    the language that sorts first. The score is the best language's share of the probabilities.
    """
    names, trees = list(models), list(models.values())

    @F.pandas_udf(PREDICTED)
    def predict(texts):
        import pandas as pd

        out = []
        start = 0
        texts = texts.tolist()
        while start < len(texts):
            stop, size = start, 0
            while stop < len(texts) and (stop == start or size + len(texts[stop]) <= SLICE_BYTES):
                size += len(texts[stop])
                stop += 1
            part = texts[start:stop]
            bits = code_lengths(trees, part) if trees else None
            for i, text in enumerate(part):
                if bits is None or not has_letter(text):
                    out.append((UNKNOWN, 0.0, None))
                    continue
                best = int(np.argmin(bits[i]))
                share = 1.0 / float(np.exp2(np.maximum(bits[i][best] - bits[i], -1000.0)).sum())
                out.append((names[best], share, float(bits[i][best]) / len(text)))
            start = stop
        return pd.DataFrame(out, columns=["lang", "score", "bits"]).astype({"bits": "float64", "score": "float64"})

    return predict


def identify(docs: DataFrame, models: dict[str, Model]) -> DataFrame:
    """``docs`` with ``predicted`` (``lang, score, bits``) from ``text`` alone; all columns are kept.

    Every byte of every text is scored. Repeated rows get equal results, an empty table gives none.
    """
    # A filter on a deterministic function would be pushed below and score every text a second time.
    return docs.withColumn("predicted", predictor(models).asNondeterministic()(utf8(F.col("text"))))
