"""Language ID in two steps: the family first, then one-versus-one linear SVMs inside the family.

Features are hashed letter trigrams of the whole text, as square roots of their shares.  Models are
fitted on the driver on at most SAMPLE labelled rows, a fixed bound; prediction runs in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webcorpus.llm.hashing import mix, text_slices

UNKNOWN = "und"
#: Languages by family; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
}
FEATURES = 4096
SAMPLE = 4000       # labelled rows at most, shared evenly by the languages
ROWS = 2000         # rows whose features are held at once
APART = 5           # of the sample one row in so many is not learned from, but sets the level of rejection,
REJECTED = 0.001    # which all but this share of these rows reach
SHORT = 24          # bytes
SETTLED = 1e-5      # a fit ends when no weight moves by more than this


def letters_only(data: np.ndarray) -> np.ndarray:
    """Lower-case bytes with a space for each ASCII byte that is no letter."""
    table = np.arange(256, dtype=np.uint8)
    table[:128] = 0x20
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    out = table[data]
    # Two-byte Latin capitals, U+00C0 to U+00DE.
    at = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)) + 1
    out[at] += 0x20
    return out


def features_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Unit vectors, one per row; all zero for a row without letters."""
    n_rows = len(offsets) - 1
    clean = letters_only(data).astype(np.uint64)
    row = np.repeat(np.arange(n_rows), np.diff(offsets))
    if len(clean) < 3:
        return np.zeros((n_rows, FEATURES), dtype=np.float32)
    gram = clean[:-2] | (clean[1:-1] << np.uint64(8)) | (clean[2:] << np.uint64(16))
    inside = (row[:-2] == row[2:]) & (clean[1:-1] != 0x20) & ((clean[:-2] != 0x20) | (clean[2:] != 0x20))
    cell = row[:-2][inside] * FEATURES + (mix(gram[inside]) % np.uint64(FEATURES)).astype(np.int64)
    counts = np.bincount(cell, minlength=n_rows * FEATURES).reshape(n_rows, FEATURES)
    total = counts.sum(axis=1, keepdims=True)
    return np.sqrt(counts / np.maximum(total, 1)).astype(np.float32)


def row_blocks(column: pa.Array):
    """(first row, data, offsets) of at most ROWS rows."""
    for at, data, offsets in text_slices(column):
        for r in range(0, len(offsets) - 1, ROWS):
            part = offsets[r : r + ROWS + 1]
            yield at + r, data[part[0] : part[-1]], part - part[0]


def has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "ignore"))


def fit_svm(parts: list[np.ndarray], positive: list[bool], steps: int = 150, penalty: float = 1e-4) -> np.ndarray:
    """Weights and bias of a linear SVM with squared hinge loss over blocks of rows, each of one class.

    The blocks are views and are never copied or joined.  Both classes weigh the same.
    """
    n = [sum(len(x) for x, p in zip(parts, positive) if p == side) for side in (False, True)]
    width = parts[0].shape[1]
    w = look = np.zeros(width + 1, dtype=np.float32)
    # The loss is smooth with constant 2 for unit rows and a bias: accelerated gradient descent.
    rate, momentum = np.float32(1 / (4 + penalty)), 1.0
    for _ in range(steps):
        slope = np.float32(penalty) * look
        for x, p in zip(parts, positive):
            y, share = (1, 0.5 / n[1]) if p else (-1, 0.5 / n[0])
            pull = np.float32(share * y) * np.maximum(0, 1 - y * (x @ look[:-1] + look[-1]))
            slope[:-1] -= 2 * (pull @ x)
            slope[-1] -= 2 * pull.sum()
        new = look - rate * slope
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        look = new + np.float32((momentum - 1) / after) * (new - w)
        moved, w, momentum = np.abs(new - w).max(), new, after
        if moved < SETTLED:
            break
    return w


class Model:
    """Family classifiers (one against the rest) and pairwise classifiers inside each family."""

    def __init__(self, x: np.ndarray, languages: list[str], families: dict, apart: np.ndarray):
        """`languages` has the language of each row of `x`, in order; rows `apart` set the level of rejection."""
        self.languages = sorted(set(languages))
        family_of = {code: name for name, codes in families.items() for code in codes}
        own = [family_of.get(code, code) for code in self.languages]
        self.families = sorted(set(own))
        self.family = np.array([self.families.index(f) for f in own], dtype=np.int64)
        border = np.searchsorted(languages, [*self.languages, chr(0x10FFFF)])
        rows = [x[a:b] for a, b in zip(border[:-1], border[1:])]
        several = len(self.families) > 1
        self.by_family = [fit_svm(rows, list(self.family == f)) for f in range(len(self.families))] if several else []
        self.pairs = [p for p in combinations(range(len(self.languages)), 2) if self.family[p[0]] == self.family[p[1]]]
        self.by_pair = [fit_svm([rows[a], rows[b]], [True, False]) for a, b in self.pairs]
        # What all but a share of REJECTED of the rows reach that were not learned from.
        self.level = float(np.quantile(self.predict(apart)[1], REJECTED)) if len(apart) and self.languages else 0.0

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language, score) per row; the score is that of the weaker of the two steps."""
        n = len(x)
        margin = np.full(n, 4.0)
        family = np.zeros(n, dtype=np.int64)
        if self.by_family:
            w = np.array(self.by_family)
            value = x @ w[:, :-1].T + w[:, -1]
            family = value.argmax(axis=1)
            margin = value[np.arange(n), family]
        inside = self.family[None, :] == family[:, None]
        votes = np.where(inside, 0.0, -1e9)
        least = np.full((n, len(self.languages)), 4.0)
        if self.pairs:
            w = np.array(self.by_pair)
            value = x @ w[:, :-1].T + w[:, -1]
            for (a, b), v in zip(self.pairs, value.T):
                votes[:, a] += (v >= 0) + 1e-3 * np.tanh(v)
                votes[:, b] += (v < 0) - 1e-3 * np.tanh(v)
                least[:, a] = np.minimum(least[:, a], v)
                least[:, b] = np.minimum(least[:, b], -v)
        best = votes.argmax(axis=1)
        return best, 1 / (1 + np.exp(-2 * np.minimum(margin, least[np.arange(n), best])))


def held_out(id_col: str):
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(5)) == 0


def fit(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", families=None) -> Model:
    """Fits on labelled rows that are not held out: SAMPLE different texts at most, those of least hash in each language.

    Copies of a text count once, so that a hot text takes no other's place, and the choice is the same
    however the rows are split.
    """
    print_ = F.xxhash64(text_col, F.lit(8))
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col)).select(
        F.col(lang_col).cast("string").alias("lang"), print_.alias("print"), F.col(text_col).alias("text")
    )
    counts = {r[0]: r[1] for r in known.groupBy("lang").agg(F.approx_count_distinct("print")).collect()}
    each = SAMPLE // max(len(counts), 1)
    share = F.lit(0.0)
    for code, n in sorted(counts.items()):
        share = F.when(F.col("lang") == code, 1.5 * each / max(n, 1) + 0.01).otherwise(share)
    luck = F.pmod(F.col("print"), F.lit(1 << 30)) / float(1 << 30)
    some = known.where(luck < share).groupBy("lang", "print").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("print", F.lit(1 << 30)), "print"))
    chosen = some.withColumn("rank", rank).where(F.col("rank") <= each).select("lang", "print", "text")

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in row_blocks(batch.column("text")):
                x = features_of(data, offsets).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(at, len(x)) for c in ("lang", "print")]
                    + [pa.array([r.tobytes() for r in x], pa.binary())], ["lang", "print", "x"]
                )

    rows = chosen.mapInArrow(sample, "lang string, print long, x binary").collect()
    rows = sorted((r["print"] % APART == 0, r["lang"], r["print"], r["x"]) for r in rows)
    x = np.empty((len(rows), FEATURES), dtype=np.float32)
    for r, (*_, body) in enumerate(rows):
        x[r] = np.frombuffer(body, dtype=np.float16)
    codes = [code for apart, code, *_ in rows if not apart]
    return Model(x[: len(codes)], codes, families or FAMILIES, x[len(codes) :])


def identify_language(docs: DataFrame, model: Model | None = None, id_col="doc_id", text_col="text", lang_col="lang") -> DataFrame:
    """Adds held_out, lang_pred, score (0 to 1) and rejected to all columns of `docs`.

    `und` with score 0 where the text is null or has no letter, or where nothing was learned.
    Rejected: `und`, or a score under the model's `level`, which almost all labelled rows reach; a text
    of fewer than SHORT bytes says too little to be rejected by its score.  Long texts count whole.  Columns of `docs` with
    the added names are replaced.  An empty table gives none.
    """
    model = model or fit(docs, id_col, text_col, lang_col)
    added = {"lang_pred": "string", "score": "double", "held_out": "boolean", "rejected": "boolean"}
    keep = [c for c in docs.columns if c not in added]
    base = docs.select(*[F.col(f"`{c}`") for c in keep], held_out(id_col).alias("held_out"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, scores = [], []
            for _, data, offsets in row_blocks(batch.column(text_col)):
                x = features_of(data, offsets)
                if model.languages:
                    best, score = model.predict(x)
                else:
                    best, score = np.zeros(len(x), np.int64), np.zeros(len(x))
                small = data | 0x20
                letters = np.concatenate(([0], np.cumsum((small >= 97) & (small <= 122))))[offsets]
                for r, bare in enumerate(letters[1:] == letters[:-1]):
                    if not model.languages or (bare and not has_letter(data[offsets[r] : offsets[r + 1]].tobytes())):
                        codes.append(UNKNOWN)
                        score[r] = 0.0
                    else:
                        codes.append(model.languages[best[r]])
                scores.append(score)
            columns = [*batch.columns, pa.array(codes, pa.string()), pa.array(np.concatenate(scores) if scores else [], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "lang_pred", "score"])

    fields = ", ".join(f"`{n}` {t}" for n, t in base.dtypes)
    out = base.mapInArrow(predict, f"{fields}, lang_pred string, score double")
    odd = (F.col("score") < model.level) & (F.octet_length(text_col) >= SHORT)
    return out.withColumn("rejected", (F.col("lang_pred") == UNKNOWN) | odd)
