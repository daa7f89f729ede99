"""Token counts of whole texts by compiled transducers (see :mod:`railwatch.llm.bpe`)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railwatch.llm.blocks import slabs
from railwatch.sources.staging import ship_package


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_tokens`` for every row of ``docs``, in one pass without a shuffle.

    ``vocabulary`` is a byte-level BPE file that every executor has at this path.  Counts are those
    of its library without added tokens; a special token's string inside a text is that one token.

    Null and empty texts have no bytes and no tokens.  Null ids, repeated ids and repeated rows pass
    through one to one.  Other columns of ``docs``, whatever their names, are not carried.  A very
    long text is one slab of its own.  An empty table gives an empty result.
    """
    ship_package(docs.sparkSession)
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType),
        T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
    ])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from railwatch.llm.bpe import encoder

        machine = encoder(vocabulary, False)
        for batch in batches:
            sizes, tokens = [], []
            for slab in slabs(batch.column(1)):
                sizes.append(np.diff(slab.offsets))
                tokens.append(machine.count(slab))
            if sizes:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.concatenate(sizes)), pa.array(np.concatenate(tokens))],
                    names=["id", "n_bytes", "n_tokens"],
                )

    counted = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(count, schema)
    return counted.withColumnRenamed("id", id_col)
