"""Language identification by compression.

Each language has a zstandard raw-content dictionary: pieces of labelled texts. A text is encoded with
every language's dictionary, in chunks of CHUNK_BYTES so that a long text's own repetitions don't hide the
dictionary, and belongs to the language whose dictionary makes it smallest. The score is the share of the
runner-up's size that the best saves; a text whose score is under a margin is rejected.

The dictionaries are the only thing learned. They hold pieces of at most SAMPLE_TEXTS texts for each language, chosen
by a hash of the id, so their size doesn't grow with the corpus. A piece is PIECE_CHARS characters from a place that
the hash chooses as well, or the text if it is shorter. Whole texts of any length are classified. Null texts and texts without a letter are undetermined, with score 0; so is everything if
nothing is learned. Ties go to the language first in code point order. Repeated rows
get equal results. An empty table gives an empty one. All columns come back in a struct, so they may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The bound of the sample: texts of each language, and characters of each.
SAMPLE_TEXTS, PIECE_CHARS = 128, 1000
#: A text is encoded in chunks of so many bytes.
CHUNK_BYTES = 2048
LEVEL = 6
#: Scores under this are rejected.
MARGIN = 0.005
UNDETERMINED = "und"
_OTHER = re.compile(r"[\W\d_]+")


def learned_dictionaries(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", texts: int = SAMPLE_TEXTS, piece_chars: int = PIECE_CHARS) -> dict[str, bytes]:
    """A dictionary for each language from at most `texts` texts of it; the same for the same rows in any order."""
    h, text = F.xxhash64(F.col(id_col)), F.col(text_col)
    start = F.pmod(h, F.greatest(F.char_length(text) - piece_chars, F.lit(0)) + 1).cast("int")
    rows = labelled.filter(F.col(lang_col).isNotNull() & text.isNotNull()).select(F.col(lang_col).alias("lang"), h.alias("h"), F.substring(text, start + 1, F.lit(piece_chars)).alias("piece"))
    order = Window.partitionBy("lang").orderBy("h", "piece")
    found = rows.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= texts).collect()
    out: dict[str, dict[str, None]] = {}
    for row in sorted(found, key=lambda r: (r["lang"], -r["k"])):  # the end of a dictionary is cheapest to refer to
        out.setdefault(row["lang"], {})[row["piece"]] = None
    return {lang: "\n".join(map(folded, pieces)).encode() for lang, pieces in out.items()}


def compressors(dictionaries: dict[str, bytes], level: int = LEVEL) -> dict[str, zstandard.ZstdCompressor]:
    out = {}
    for lang in sorted(dictionaries):
        data = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        params = zstandard.ZstdCompressionParameters.from_level(level, source_size=CHUNK_BYTES, dict_size=len(dictionaries[lang]), write_content_size=False, write_dict_id=False)
        data.precompute_compress(compression_params=params)
        out[lang] = zstandard.ZstdCompressor(dict_data=data, compression_params=params)
    return out


def folded(text: str) -> str:
    """Lower case, with one space for each run of other signs than letters: what tells languages apart."""
    return _OTHER.sub(" ", text.lower())


def classified(text: str, coders: dict[str, zstandard.ZstdCompressor]) -> tuple[str, float]:
    raw = folded(text).encode()
    chunks = [raw[a : a + CHUNK_BYTES] for a in range(0, len(raw), CHUNK_BYTES)]
    sizes = sorted((sum(len(coder.compress(x)) for x in chunks), lang) for lang, coder in coders.items())
    if not sizes:
        return UNDETERMINED, 0.0
    if len(sizes) == 1:
        return sizes[0][1], 1.0
    return sizes[0][1], 1 - sizes[0][0] / sizes[1][0]


def predictor(dictionaries: dict[str, bytes], level: int = LEVEL):
    """A function of a text column to (lang, score)."""

    @F.arrow_udf("lang string, score double")
    def predict(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coders = compressors(dictionaries, level)
        for part in parts:
            found = [classified(x.as_py(), coders) if x.is_valid else (UNDETERMINED, 0.0) for x in part]
            yield pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["lang", "score"])

    def of(text: Column) -> Column:
        return predict(F.when(text.rlike(r"\p{L}"), text))

    return of


def identified(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", margin: float = MARGIN) -> DataFrame:
    """(row, lang, score, accepted): each row of docs as a struct with its predicted language.

    accepted is false for undetermined texts and for scores under the margin.
    """
    predict = predictor(learned_dictionaries(labelled, id_col, text_col, lang_col))
    rows = docs.select(F.struct("*").alias("row"), predict(F.col(text_col)).alias("p"))
    return rows.select("row", F.col("p.lang").alias("lang"), F.col("p.score").alias("score"), ((F.col("p.lang") != UNDETERMINED) & (F.col("p.score") >= margin)).alias("accepted"))
