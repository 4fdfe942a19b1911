"""Language identification by compression.

Each language has a raw-content zstandard dictionary made of a bounded sample of its
texts: of the ``sample_rows`` documents with a letter and the smallest hashed ids, up to
``sample_chars`` characters of their words, in ``pieces`` pieces spread evenly over the
whole text. The ``dictionary_bytes`` are shared by all of them: every piece is cut to the same
length, the longest that fits. A text is taken as its lower-case words, cut into blocks of
``block_bytes`` and encoded whole with every dictionary; the language with the smallest total wins. Where two totals are equal, the share of the text's words that stand in
a dictionary decides by up to half a byte. ``margin`` is how much larger the second total
is; below ``min_margin`` the text is rejected.

Null texts and texts without a letter are ``und``, with score 0, and rejected. Rows without
text, letter or language teach nothing. With nothing to learn from, all is ``und``. Rows
without a ``doc_id`` are left out of predictions; ``keep_identified`` drops them. Labels,
sources and ids never enter a prediction. The dictionaries are sent to the
tasks: one of at most ``dictionary_bytes`` for each language there is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cashcycle.llm.tables import texts

UNKNOWN = "und"
_NO_LETTERS = regex.compile(r"[^\p{L}\p{M}']+")


def _letters(text: str) -> bytes:
    return _NO_LETTERS.sub(" ", text.lower()).encode("utf-8", "replace")


@dataclass(frozen=True)
class LanguageOptions:
    sample_rows: int = 300
    sample_chars: int = 2048
    pieces: int = 8
    dictionary_bytes: int = 1 << 16
    block_bytes: int = 4096
    level: int = 4
    min_margin: float = 0.001


def dictionaries(train: DataFrame, options: LanguageOptions) -> dict[str, bytes]:
    """One dictionary per language of ``train`` (doc_id, text, lang)."""
    words = F.trim(F.regexp_replace(F.col("text").cast("string"), r"[^\p{L}\p{M}']+", " "))
    usable = train.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), words.alias("words")
    )
    usable = usable.filter(F.col("lang").isNotNull() & F.col("words").rlike(r"\p{L}"))
    spread = usable.select("doc_id", "lang", _pieces(options).alias("parts"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "parts")
    chosen = spread.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= options.sample_rows)
    whole = chosen.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "parts"))).alias("sample"))
    found = {}
    for row in whole.orderBy("lang").toLocalIterator():  # sample_rows * sample_chars at most, each
        found[row.lang] = _shared([_letters(p) for x in row.sample for p in x.parts], options.dictionary_bytes)
    return found


def _pieces(options: LanguageOptions):
    """A text's words whole, or as many pieces of them, from its begin to its end."""
    size, gaps = options.sample_chars // options.pieces, options.pieces - 1
    starts = F.sequence(F.lit(0), F.lit(gaps))
    room = F.length("words") - size
    cut = F.transform(starts, lambda k: F.substr("words", 1 + F.floor(k * room / gaps).cast("int"), F.lit(size)))
    return F.when(F.length("words") <= options.sample_chars, F.array("words")).otherwise(cut)


def _shared(parts: list[bytes], room: int) -> bytes:
    """The parts, each cut to the longest length at which all fit into ``room``, spaces included."""
    lengths = np.array([len(p) + 1 for p in parts])
    low, high = 0, int(lengths.max())
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if np.minimum(lengths, middle).sum() <= room else (low, middle - 1)
    return b" ".join(p[: max(0, low - 1)] for p in parts)[:room]


class Identifier:
    """Encodes texts with every dictionary."""

    def __init__(self, known: dict[str, bytes], options: LanguageOptions):
        self.options = options
        self.langs = sorted(known)
        self.words = [set(known[lang].split()) for lang in self.langs]
        self.compressors = []
        for lang in self.langs:
            parameters = zstandard.ZstdCompressionParameters.from_level(
                options.level,
                source_size=options.block_bytes,
                dict_size=len(known[lang]),
                min_match=3,
                write_content_size=0,
                write_dict_id=0,
            )
            raw = zstandard.ZstdCompressionDict(known[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=raw, compression_params=parameters))

    def totals(self, text: str) -> np.ndarray:
        data = _letters(text)
        step = self.options.block_bytes
        blocks = [data[k : k + step] for k in range(0, len(data), step)]
        totals = np.array([sum(len(c.compress(b)) for b in blocks) for c in self.compressors], float)
        if len(totals) > 1 and np.diff(np.sort(totals)[:2])[0] == 0:
            words = data.split()
            shares = [sum(w in known for w in words) / max(1, len(words)) for known in self.words]
            totals -= 0.5 * np.array(shares)
        return totals

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score, margin."""
        if not self.langs or text is None or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0
        totals = self.totals(text)
        best = int(totals.argmin())
        score = 1 / np.exp(-np.minimum(totals - totals[best], 700) / 2).sum()
        rest = np.delete(totals, best)
        margin = (rest.min() - totals[best]) / totals[best] if len(rest) else 1.0
        return self.langs[best], float(score), float(margin)


def identify(docs: DataFrame, train: DataFrame, options: LanguageOptions | None = None) -> DataFrame:
    """(doc_id, lang_pred, score, margin, rejected) of every document."""
    options = options or LanguageOptions()
    known = docs.sparkSession.sparkContext.broadcast(dictionaries(train, options))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = Identifier(known.value, options)
        for batch in batches:
            found = [identifier.predict(t.as_py()) for t in batch.column("text")]
            langs, scores, margins = zip(*found, strict=True) if found else ((), (), ())
            rejected = [m < options.min_margin for m in margins]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(margins, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                ["doc_id", "lang_pred", "score", "margin", "rejected"],
            )

    return texts(docs).mapInArrow(
        run, "doc_id long, lang_pred string, score double, margin double, rejected boolean"
    )


def keep_identified(docs: DataFrame, train: DataFrame, options: LanguageOptions | None = None) -> DataFrame:
    """``docs`` without those whose language is not clear, unchanged otherwise."""
    options = options or LanguageOptions()
    known = docs.sparkSession.sparkContext.broadcast(dictionaries(train, options))

    @F.pandas_udf("boolean")
    def clear(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        identifier = Identifier(known.value, options)
        for column in columns:
            found = (identifier.predict(t) for t in column)
            yield pd.Series([lang != UNKNOWN and m >= options.min_margin for lang, _, m in found], dtype=bool)

    return docs.filter(F.col("doc_id").isNotNull() & clear("text"))
