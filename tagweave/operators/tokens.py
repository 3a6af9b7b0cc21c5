"""Document assembly and tokenisation with character offsets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions._util import as_col
from ..functions.text import TOKEN_PATTERN, shrink, text_or_empty
from .pair_grid import BATCH_BYTES

# Rows of an Arrow batch of tokens.
SPANS_AT_ONCE = 1 << 17

# Fixed value: a token with the white space before it; these tile the text but for white space at its end.
PIECE_PATTERN = r"[\t\n\x0B\f\r ]*(?:" + TOKEN_PATTERN + ")"


def assemble(df: DataFrame, text_col: str = "text", cleanup: str = "shrink") -> DataFrame:
    """Add ``document``: the text cleaned (``shrink``) or as is (``disabled``)."""
    if cleanup == "shrink":
        doc = shrink(text_or_empty(text_col))
    elif cleanup == "disabled":
        doc = text_or_empty(text_col)
    else:
        raise ValueError(f"Unknown cleanup mode: {cleanup}")
    return df.withColumn("document", doc)


def token_spans(df: DataFrame, id_col: str, text_col: str = "document") -> DataFrame:
    """One row per token: ``(id, pos, begin, end, token)``, offsets 0-based, end inclusive.

    The text is cut into pieces that tile it (tokens with the white space before them);
    a token ends where the lengths of the pieces up to its own add up to. The sums are made with numpy on Arrow
    batches of pieces, whole rows each. The work is linear in the number of pieces; nothing shuffles, and rows with the same id are kept apart.
    """
    pieces = F.regexp_extract_all(text_or_empty(text_col), F.lit(PIECE_PATTERN), F.lit(0))
    rows = df.select(F.col(id_col).alias("id"), pieces.alias("_p"))
    out = StructType([rows.schema["id"], *(StructField(c, IntegerType()) for c in ("pos", "begin", "end")), StructField("token", StringType())])

    def spans(batches):
        for batch in batches:
            lists = batch.column(1)
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            flat = lists.flatten()
            for at in range(0, len(flat), SPANS_AT_ONCE):
                if not at:  # a row's pieces may lie in several slices, so its sums are made over all of them first
                    ends = np.cumsum(pc.utf8_length(flat).to_numpy(), dtype=np.int64)
                    first = np.cumsum(sizes) - sizes
                    base = np.append(0, ends)[first]
                own, piece = owner[at:at + SPANS_AT_ONCE], flat.slice(at, SPANS_AT_ONCE)
                token = pc.utf8_ltrim(piece, characters="\t\n\x0b\f\r ")
                end = ends[at:at + SPANS_AT_ONCE] - base[own]
                begin = end - pc.utf8_length(token).to_numpy()
                pos = np.arange(at, at + len(own)) - first[own]
                numbers = [pa.array(x.astype(np.int32)) for x in (pos, begin, end - 1)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own)), *numbers, token], names=out.names)

    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return rows.mapInArrow(spans, out)


def finish(annotations) -> Column:
    """Annotation array -> its results joined by blanks (the finisher)."""
    return F.array_join(F.transform(as_col(annotations), lambda a: a["result"]), " ")
