"""Optional tagger hook (L2).

The default Korean path is the lexicon join of ``terms``. When a real
morphological tagger is available, it can be plugged in here: the tagger is
built once per task by ``factory()`` and applied to Arrow batches with
``mapInPandas``, so Spark still partitions the work and no rows pass through
the driver. The tagger itself is the caller's (no library is bundled).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

Tagger = Callable[[str], list[str]]


def tagger_terms(df: DataFrame, cols: list[str], factory: Callable[[], Tagger],
                 name: Callable[[str], str] = lambda c: f"{c}_korean_nouns") -> DataFrame:
    """Add ``name(c)`` = tagger(text) for each column; NULL or blank -> []."""
    out_schema = T.StructType(df.schema.fields + [T.StructField(name(c), T.ArrayType(T.StringType()), False)
                                                  for c in cols])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tag = factory()
        for pdf in batches:
            for c in cols:
                pdf[name(c)] = [list(tag(t)) if isinstance(t, str) and t.strip() else [] for t in pdf[c]]
            yield pdf

    return df.mapInPandas(run, out_schema)
