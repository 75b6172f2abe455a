"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewell.llm.kernels import flat, slices

UNKNOWN = "und"
PIECE = 1 << 20
COUNTS = "lang string, gram bigint, n bigint"
_BITS = 21


@cache
def _letters() -> np.ndarray:
    """For every code point: 0, or 2 plus the lower-case letter."""
    out = np.zeros(0x110000, np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            out[cp] = (ord(low) if len(low) == 1 else cp) + 2
    return out


def _marks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all rows with a 1 for each non-letter and before every row, and their rows."""
    text = data.tobytes().decode("utf-8")
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    begin = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    sizes = np.diff(begin) + 2
    row = np.repeat(np.arange(len(sizes)), sizes)
    out = np.ones(len(row), np.uint32)
    inside = np.ones(len(row), bool)
    ends = np.cumsum(sizes)
    inside[ends - 1] = inside[ends - sizes] = False
    out[inside] = np.maximum(_letters()[points], 1)
    return out, row


def gram_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, gram, count) of the n-grams of one to three signs, ascending.

    A gram is three 21-bit signs: 0 none, 1 word edge, otherwise 2 plus the letter. Words are padded
    with an edge on both sides; a gram holds a letter and has edges only at its ends.
    """
    return _grams(*_marks(data, offsets))


def _grams(signs: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`gram_counts` of rows given as signs."""
    alphabet = np.flatnonzero(np.bincount(signs)).astype(np.uint64)
    small = np.zeros(int(signs.max()) + 1 if len(signs) else 2, np.uint64)
    small[alphabet.astype(np.int64)] = np.arange(1, len(alphabet) + 1)
    bits = max(1, int(len(alphabet)).bit_length())
    one = small[signs]
    letter = signs > 1
    key = row.astype(np.uint64) << np.uint64(3 * bits)
    high, middle = one << np.uint64(2 * bits), one << np.uint64(bits)
    same = row[1:] == row[:-1]
    pair = (letter[1:] | letter[:-1]) & same
    triple = letter[1:-1] & same[1:] & same[:-1]
    keys = np.concatenate(
        [
            (key | high)[letter],
            (key[:-1] | high[:-1] | middle[1:])[pair],
            (key[:-2] | high[:-2] | middle[1:-1] | one[2:])[triple],
        ]
    )
    keys.sort()
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(new, len(keys)))
    keys = keys[new]
    full = np.concatenate([[0], alphabet]).astype(np.uint64)
    mask = np.uint64((1 << bits) - 1)
    gram = np.zeros(len(keys), np.uint64)
    for k in range(3):
        sign = full[((keys >> np.uint64((2 - k) * bits)) & mask).astype(np.int64)]
        gram |= sign << np.uint64((2 - k) * _BITS)
    return (keys >> np.uint64(3 * bits)).astype(np.int64), gram, counts


def _merged(grams: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    kinds, at = np.unique(np.concatenate(grams), return_inverse=True)
    return kinds, np.bincount(at, np.concatenate(counts), len(kinds)).astype(np.int64)


def _by_piece(data: np.ndarray, offsets: np.ndarray):
    """:func:`gram_counts` of row ranges. A very long text is counted in pieces: each piece sees the two
    signs before it, whose own grams are taken off again, so that a cut may fall anywhere."""
    for i, j in slices(offsets, PIECE):
        low, high = int(offsets[i]), int(offsets[j])
        if j > i + 1 or high - low <= 2 * PIECE:
            yield i, j, *gram_counts(data[low:high], offsets[i : j + 1] - low)
            continue
        grams, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        lead = np.ones(1, np.uint32)  # the edge before the text
        while low < high:
            end = min(high, low + PIECE)
            while end < high and data[end] & 0xC0 == 0x80:
                end += 1
            signs = np.concatenate([lead, _marks(data[low:end], np.array([0, end - low]))[0][1 : None if end == high else -1]])
            _, more, n = _grams(signs, np.zeros(len(signs), np.int64))
            _, less, m = _grams(lead, np.zeros(len(lead), np.int64))
            grams, counts = _merged([grams, more, less], [counts, n, -m])
            grams, counts = grams[counts > 0], counts[counts > 0]
            low, lead = end, signs[-2:]
        yield i, j, np.zeros(len(grams), np.int64), grams, counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gram counts per language of one task; only distinct grams are held."""
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        data, offsets = flat(batch["text"])
        langs = batch["lang"].dictionary_encode()
        names, code = langs.dictionary.to_pylist(), langs.indices.to_numpy()
        for i, j, row, gram, count in _by_piece(data, offsets):
            of = code[i:j][row]
            for k in np.unique(of).tolist():
                mine = of == k
                grams, counts = held.get(names[k], (gram[:0], count[:0]))
                held[names[k]] = _merged([grams, gram[mine]], [counts, count[mine]])
    for name, (grams, counts) in held.items():
        yield pa.record_batch(
            [pa.array([name] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(counts)], ["lang", "gram", "n"]
        )


def fit_profiles(docs: DataFrame, size: int = 300) -> DataFrame:
    """The ``size`` most frequent n-grams of every language, ranked from 0: ``lang, gram, rank``.

    All rows with a language count, each with all of its text.
    """
    known = docs.where(F.col("lang").isNotNull()).select("lang", "text")
    counts = known.mapInArrow(_count, COUNTS).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return counts.withColumn("rank", rank - 1).where(F.col("rank") < size).select("lang", "gram", "rank")


class Profiles:
    """Profiles as one matrix of ranks; a missing gram has the rank ``size``."""

    def __init__(self, table: pd.DataFrame, size: int) -> None:
        self.size = size
        self.langs = sorted(table["lang"].unique())
        self.grams = np.unique(table["gram"].to_numpy().astype(np.uint64))
        self.ranks = np.full((len(self.langs), len(self.grams) + 1), -1, np.int64)
        for k, lang in enumerate(self.langs):
            own = table[table["lang"] == lang]
            self.ranks[k, np.searchsorted(self.grams, own["gram"].to_numpy().astype(np.uint64))] = own["rank"]

    def distances(self, row: np.ndarray, gram: np.ndarray, count: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Out-of-place distance of every row to every language, and the number of ranked grams."""
        most = int(count.max()) if len(count) else 0
        place, bits = max(1, len(row).bit_length()), max(1, most.bit_length())
        order = row.astype(np.uint64) << np.uint64(bits + place)
        order |= (most - count).astype(np.uint64) << np.uint64(place)
        order |= np.arange(len(row), dtype=np.uint64)
        order.sort()
        order = (order & np.uint64((1 << place) - 1)).astype(np.int64)
        first = np.searchsorted(row, np.arange(n_rows + 1))
        rank = np.arange(len(row)) - first[:-1][row]
        top = rank < self.size
        row, rank, gram = row[top], rank[top], gram[order[top]]
        at = np.searchsorted(self.grams, gram)
        if len(self.grams):
            at[self.grams[np.minimum(at, len(self.grams) - 1)] != gram] = len(self.grams)
        out = np.empty((len(self.langs), n_rows))
        for k in range(len(self.langs)):
            theirs = self.ranks[k][at]
            out[k] = np.bincount(row, np.where(theirs < 0, self.size, np.abs(theirs - rank)), n_rows)
        return out, np.bincount(row, minlength=n_rows)


def _predict(profiles: Profiles):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*profiles.langs, UNKNOWN], object)
        for batch in batches:
            data, offsets = flat(batch["text"])
            for i, j, row, gram, count in _by_piece(data, offsets):
                best, score = np.full(j - i, -1), np.zeros(j - i)
                if profiles.langs:
                    far, used = profiles.distances(row, gram, count, j - i)
                    some = used > 0
                    best[some] = far.argmin(0)[some]
                    score[some] = 1 - far.min(0)[some] / (used[some] * profiles.size)
                columns = [batch[c].slice(i, j - i) for c in batch.schema.names if c != "text"]
                found = [pa.array(names[best].tolist(), pa.string()), pa.array(score)]
                kept = [c for c in batch.schema.names if c != "text"]
                yield pa.record_batch([*columns, *found], [*kept, "lang_pred", "score"])

    return run


def predict_language(docs: DataFrame, profiles: DataFrame, size: int = 300) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to the other columns of ``docs``; ``text`` is left out.

    The document's ``size`` most frequent n-grams are compared with each profile; a gram missing
    from the profile is out of place by ``size``. The nearest language wins, ties go to the first
    in alphabetical order. ``score`` is 1 minus the distance over the largest possible distance. A
    text without letters (or null) is ``und`` with score 0, and so is every text if there are no
    profiles. The profiles, ``size`` rows a language, are sent to every executor.
    """
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType

    model = Profiles(profiles.toPandas(), size)
    kept = [f for f in docs.schema.fields if f.name != "text"]
    schema = StructType([*kept, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.mapInArrow(_predict(model), schema)


def held_out(doc_id: str = "doc_id", folds: int = 4, fold: int = 2):
    """Is the document kept from learning? False for a null id, which isn't learned from either."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def identify(docs: DataFrame, size: int = 300) -> DataFrame:
    """Learn from the documents outside the held-out fold and predict all: ``doc_id, held_out, lang_pred, score``.

    Prediction reads the text alone. Rows with a null id or null language are predicted but not learned from.
    """
    learn = docs.where(~held_out() & F.col("doc_id").isNotNull())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return predict_language(rows, fit_profiles(learn, size), size)


def _keep(profiles: Profiles, min_score: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch["doc"]
            names = [doc.type.field(k).name for k in range(doc.type.num_fields)]
            data, offsets = flat(doc.flatten()[names.index("text")])
            near = np.zeros(batch.num_rows, bool)
            for i, j, row, gram, count in _by_piece(data, offsets):
                if profiles.langs:
                    far, used = profiles.distances(row, gram, count, j - i)
                    near[i:j] = (used > 0) & (far.min(0) <= (1 - min_score) * used * profiles.size)
            yield batch.filter(pa.array(near))

    return run


def keep_identified(docs: DataFrame, profiles: DataFrame, min_score: float = 0.25, size: int = 300) -> DataFrame:
    """The rows of ``docs`` whose text is in a known language: it has a letter and scores ``min_score`` or more.

    Every column is kept and none can clash; null texts are rejected.
    """
    model = Profiles(profiles.toPandas(), size)
    rows = docs.select(F.struct("*").alias("doc"))
    return rows.mapInArrow(_keep(model, min_score), rows.schema).select("doc.*")
