"""Record cleaning."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lauter.functions import text


def clean(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Fix encoding, strip, nullify and truncate every string column.

    Other types pass through; no row is added or dropped. The two steps are
    separate projections so that the first result is computed once per row.
    """
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    chosen = strings if columns is None else [c for c in strings if c in set(columns)]
    if not chosen:
        return df
    trimmed = df.withColumns({c: text.tidy(F.col(f"`{c}`")) for c in chosen})
    return trimmed.withColumns(
        {c: text.truncate(text.nullify(F.col(f"`{c}`")), c) for c in chosen}
    )
