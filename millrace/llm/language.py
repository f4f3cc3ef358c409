"""Language identification by compression.

Each language's dictionary is raw content: excerpts of its training texts. A
text is cut into chunks, every chunk is compressed with every dictionary, and
the language whose dictionary gives the smallest total wins. Chunks keep a
long text from being its own best dictionary. A text is rejected if the
runner-up comes too close, or if it has nothing to tell a language by.

Defined results: a null text, or one without a letter, is ``und`` with score 0
and rejected; equal sizes go to the language that sorts first; very long texts
are compressed chunk by chunk; repeated rows and null ids are classified like
others; an empty table gives no rows; without training rows all is ``und``.
Columns of the input other than those named are kept out of the result of
``identify``; ``keep_identified`` keeps them all. It also keeps rejected texts
with fewer than ``SHORT_BYTES`` bytes of letters: they are too short to tell.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.tables import slices

#: Rows a language's dictionary is drawn from at most, and what is taken of a long text. With
#: texts of over 1024 ASCII characters, 63 of them fill a dictionary.
SAMPLE_ROWS, PIECES, PIECE_CHARS = 256, 4, 256
#: Bytes of a dictionary at most, and of a chunk.
DICTIONARY_BYTES, CHUNK_BYTES = 64 << 10, 1024
#: Short matches tell languages apart: compression searches for three bytes or more.
SEARCH = {
    "window_log": 17,
    "chain_log": 16,
    "hash_log": 16,
    "search_log": 3,
    "min_match": 3,
    "target_length": 16,
    "strategy": zstandard.STRATEGY_GREEDY,
}
#: Bytes of letters and gaps below which no margin can be expected of a text.
SHORT_BYTES = 32
#: A text is rejected if the runner-up needs less than this share more, or so few bytes more.
LEAST_SHARE, LEAST_BYTES = 0.005, 1
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
#: What tells languages apart: letters and the gaps between words.
GAPS = re.compile(r"[\W\d_]+")

Models = dict[str, bytes]


def train(
    labelled: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    rows: int = SAMPLE_ROWS,
) -> Models:
    """A dictionary per language, from a bounded sample of its texts.

    Of each language, the ``rows`` texts with the smallest hash of their id are
    taken; the limit applies in every task before the shuffle. The result is
    bounded by the number of languages times ``DICTIONARY_BYTES``.
    """
    usable = labelled.select(
        F.col(lang).cast("string").alias("lang"),
        F.xxhash64(F.col(doc_id).cast("string"), F.col(text)).alias("pick"),
        excerpt(F.col(text)).alias("part"),
    ).where(F.col("lang").isNotNull() & F.col("part").rlike(r"\p{L}"))
    order = Window.partitionBy("lang").orderBy("pick", "part")
    sample = usable.withColumn("n", F.row_number().over(order)).where(F.col("n") <= rows)
    parts: dict[str, list[tuple[int, str]]] = {}
    for row in sample.select("lang", "n", "part").collect():
        parts.setdefault(row["lang"], []).append((row["n"], row["part"]))
    return {
        name: filled([plain(part) for _, part in sorted(own)]) for name, own in sorted(parts.items())
    }


def excerpt(text: Column) -> Column:
    """Pieces spread evenly over the whole of a text, which is taken whole if it is short."""
    spare = F.length(text) - PIECES * PIECE_CHARS
    starts = F.transform(
        F.sequence(F.lit(0), F.lit(PIECES - 1)),
        lambda i: (i * (PIECE_CHARS + F.floor(spare / (PIECES - 1))) + 1).cast("int"),
    )
    pieces = F.transform(starts, lambda at: F.substring(text, at, F.lit(PIECE_CHARS)))
    return F.when(spare > 0, F.array_join(pieces, " ")).otherwise(text)


def filled(excerpts: list[str]) -> bytes:
    """Whole excerpts, one after the other, until the next would not fit (one at least)."""
    content = b""
    for part in excerpts:
        more = (b" " if content else b"") + part.encode()
        if content and len(content) + len(more) > DICTIONARY_BYTES:
            break
        content += more
    return content


def plain(text: str) -> str:
    return GAPS.sub(" ", text.lower()).strip()


def encodable(text: str) -> bytes:
    return plain(text).encode("utf-8", "replace")


@lru_cache(maxsize=4)
def compressors(models: tuple[tuple[str, bytes], ...]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    made = []
    for name, content in models:
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        options = zstandard.ZstdCompressionParameters(
            **SEARCH, write_content_size=False, write_dict_id=False
        )
        data.precompute_compress(compression_params=options)
        made.append((name, zstandard.ZstdCompressor(dict_data=data, compression_params=options)))
    return made


def judge(text: str | None, models: tuple[tuple[str, bytes], ...]) -> tuple[str, float, bool]:
    """Language, score from 0 to 1, and whether the text is rejected."""
    if not models or not text or not LETTER.search(text):
        return UNKNOWN, 0.0, True
    data = encodable(text)
    chunks = [data[n : n + CHUNK_BYTES] for n in range(0, len(data), CHUNK_BYTES)]
    sizes = sorted(
        (sum(len(coder.compress(chunk)) for chunk in chunks), name)
        for name, coder in compressors(models)
    )
    best, name = sizes[0]
    if len(sizes) == 1:
        return name, 1.0, False
    margin = sizes[1][0] - best
    rejected = margin < LEAST_BYTES or margin < LEAST_SHARE * best
    return name, 1.0 - 0.5 ** (1 + margin * 50.0 / max(best, 50)), rejected


def too_short(text: str | None) -> bool:
    """Whether a text has letters, but not enough to tell a language by."""
    return bool(text) and bool(LETTER.search(text)) and len(encodable(text)) < SHORT_BYTES


def identify(
    docs: DataFrame, models: Models, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, lang_pred, score and rejected."""
    fixed = tuple(sorted(models.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [judge(content.as_py(), fixed) for content in batch.column(1)]
            names, scores, rejected = list(zip(*found)) or ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(names, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    chosen = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    return chosen.mapInArrow(
        run, "doc_id long, lang_pred string, score double, rejected boolean"
    )


def keep_identified(docs: DataFrame, models: Models, text: str = "text") -> DataFrame:
    """The rows whose language is told clearly or that are too short to tell, with all columns."""
    fixed = tuple(sorted(models.items()))

    def stays(content: str | None) -> bool:
        return not judge(content, fixed)[2] or bool(fixed) and too_short(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            kept = [stays(content.as_py()) for content in batch.column(text)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
