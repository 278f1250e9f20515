"""Language identification, words first.

A known word is scored by its log frequency in each language. A word that is not known is scored by
its longest known character n-grams, shorter ones only where no longer one is known.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabweave.llm.common import fold, small_slices

SAMPLE_PER_LANGUAGE = 5_000  # expected training documents per language at most
WORDS = 20_000  # known words per language
GRAMS = 5_000  # known n-grams per language and length
ORDERS = (4, 3, 2, 1)
CACHED = 200_000  # unknown words whose scores a worker keeps
STEP = 10_000
UNDETERMINED = "und"

_WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def has_letter(words: list[str]) -> bool:
    return any(c.isalpha() for w in words for c in w)


def grams_of(word: str, n: int) -> list[str]:
    padded = f"^{word}$" if n > 1 else word
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


@dataclass
class LanguageModel:
    """Log frequencies by language; index 0 of ``tables`` holds words, index n the n-grams of length n."""

    languages: list[str]
    tables: dict[int, dict[str, int]]
    scores: dict[int, np.ndarray]
    _rows: dict[str, int] = field(default_factory=dict, repr=False)
    _matrix: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_rows": {}, "_matrix": None}

    def _total(self, words: list[str]) -> np.ndarray:
        """Sum of the words' scores; scores of unknown words are kept in the rows behind the known ones."""
        total = np.zeros(len(self.languages))
        for start in range(0, len(words), STEP):
            part = words[start : start + STEP]
            if self._matrix is None or len(self._rows) + len(part) > len(self._matrix):
                self._rows = dict(self.tables[0])
                self._matrix = np.concatenate([self.scores[0], np.empty((CACHED, len(self.languages)))])
            at = list(map(self._rows.get, part))
            if None in at:
                for i, row in enumerate(at):
                    if row is None:
                        at[i] = self._remember(part[i])
            total += self._matrix[at].sum(axis=0)
        return total

    def _remember(self, word: str) -> int:
        row = self._rows.setdefault(word, len(self._rows))
        self._matrix[row] = self._backed_off(word)
        return row

    def _backed_off(self, word: str) -> np.ndarray:
        for n in ORDERS:
            known = [at for g in grams_of(word, n) if (at := self.tables[n].get(g)) is not None]
            if known:
                return self.scores[n][known].mean(axis=0)
        return np.zeros(len(self.languages))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and its share among all; ties go to the first name. ``und`` without a letter."""
        words = words_of(text) if text else []
        if not self.languages or not words or not (words[0].isalpha() or has_letter(words)):
            return UNDETERMINED, 0.0
        total = self._total(words)
        best = int(np.argmax(total))
        return self.languages[best], float(1.0 / np.exp(total - total[best]).sum())


def fit_languages(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", per_language: int = SAMPLE_PER_LANGUAGE
) -> LanguageModel:
    """Fit on the rows given, which need a text and a language, at most about ``per_language`` of each language.

    The sample is drawn by hash. Words and n-grams are counted per task and summed by Spark; the driver gets
    the ``WORDS`` and ``GRAMS`` most frequent ones of each language.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    )
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        empty = {n: {} for n in (0, *ORDERS)}
        return LanguageModel([], empty, {n: np.zeros((0, 0)) for n in empty})
    share = F.lit(0.0)
    for lang in languages:
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, per_language / sizes[lang]))).otherwise(share)
    drawn = F.pmod(F.xxhash64("text", F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sampled = known.where(drawn < share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_slices(whole, "text", 4 << 20):
                per_lang: dict[str, Counter] = {}
                for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    per_lang.setdefault(lang, Counter()).update(words_of(text))
                rows: list[tuple[str, int, str, int]] = []
                for lang, words in per_lang.items():
                    rows += [(lang, 0, w, c) for w, c in words.items()]
                    for n in ORDERS:
                        grams: Counter = Counter()
                        for w, c in words.items():
                            for g in grams_of(w, n):
                                grams[g] += c
                        rows += [(lang, n, g, c) for g, c in grams.items()]
                if rows:
                    columns = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[0]), pa.array(columns[1], pa.int32()), pa.array(columns[2]), pa.array(columns[3], pa.int64())],
                        ["lang", "kind", "gram", "n"],
                    )

    counts = (
        sampled.mapInArrow(count, "lang string, kind int, gram string, n long")
        .groupBy("lang", "kind", "gram")
        .agg(F.sum("n").alias("n"))
    )
    totals = {(r["lang"], r["kind"]): (r["s"], r["v"]) for r in counts.groupBy("lang", "kind").agg(
        F.sum("n").alias("s"), F.count(F.lit(1)).alias("v")).collect()}
    frequent = Window.partitionBy("lang", "kind").orderBy(F.col("n").desc(), "gram")
    top = counts.withColumn("rank", F.row_number().over(frequent)).where(f"rank <= {max(WORDS, GRAMS)}")
    chosen = top.where(f"rank <= if(kind = 0, {WORDS}, {GRAMS})").select("kind", "gram").distinct()
    rows = counts.join(chosen, ["kind", "gram"], "left_semi").toArrow()
    return _assemble(languages, totals, rows)


def _assemble(languages: list[str], totals: dict, rows: pa.Table) -> LanguageModel:
    tables: dict[int, dict[str, int]] = {n: {} for n in (0, *ORDERS)}
    entries: dict[int, list[tuple[int, int, int]]] = {n: [] for n in tables}
    place = {lang: i for i, lang in enumerate(languages)}
    for lang, kind, gram, n in zip(*(rows[c].to_pylist() for c in ("lang", "kind", "gram", "n")), strict=True):
        at = tables[kind].setdefault(gram, len(tables[kind]))
        entries[kind].append((at, place[lang], n))
    scores = {}
    for kind, table in tables.items():
        counts = np.zeros((len(table), len(languages)))
        for at, lang, n in entries[kind]:
            counts[at, lang] = n
        size = np.array([totals.get((lang, kind), (0, 0)) for lang in languages], dtype=np.float64).reshape(-1, 2)
        scores[kind] = np.log((counts + 0.5) / (size[:, 0] + 0.5 * (size[:, 1] + 1)))
    return LanguageModel(languages, tables, scores)


def predict_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for every row; a text that is null or has no letter is ``und`` with score 0.

    Only the text is an input. The model is bounded (``fit_languages``) and travels with the tasks. Null or repeated ids
    are rows like any other; an empty table gives no rows; other columns are not read.
    """

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_slices(whole, "text", 4 << 20):
                found = [model.predict(t) for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                    ["doc_id", "lang_pred", "score"],
                )

    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double")


def is_held_out(id_col: str = "doc_id"):
    return fold(id_col, 5) == 0
