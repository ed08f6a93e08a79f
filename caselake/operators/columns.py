"""Column names and lineage columns."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.functions.identity import record_hash

# The five lineage columns, in order.
LINEAGE = ("_ingested_at", "_ingest_date", "_source_file", "_batch_id", "_record_hash")


def clean_name(name: str) -> str:
    """Lower case, runs of white space to ``_``, everything else but ``a-z0-9_`` dropped."""
    joined = "_".join(name.split()).lower()
    return re.sub("[^a-z0-9_]", "", joined)


def clean_column_names(df: DataFrame) -> DataFrame:
    """Rename every column by :func:`clean_name`; two columns ending up equal is an error."""
    names = [clean_name(c) for c in df.columns]
    twice = sorted(n for n, count in Counter(names).items() if count > 1 or not n)
    if twice:
        raise ValueError(f"column names collide or vanish after cleaning: {twice}")
    return df.toDF(*names)


def with_lineage(
    df: DataFrame,
    batch_id: str,
    ingested_at: Column | None = None,
    source: Column | None = None,
    safe_hash: bool = False,
) -> DataFrame:
    """Add ingest time and date, source file, batch id and record hash.

    ``source`` defaults to the file each row was read from, which only file
    scans know; pass a literal for other inputs. The hash covers all columns
    but these five, which are replaced if the input has them.
    """
    when = F.current_timestamp() if ingested_at is None else ingested_at
    data = [c for c in df.columns if c not in LINEAGE]
    return df.withColumns(
        {
            "_ingested_at": when,
            "_ingest_date": F.to_date(when),
            "_source_file": F.col("_metadata.file_path") if source is None else source,
            "_batch_id": F.lit(batch_id),
            "_record_hash": record_hash(data, safe=safe_hash),
        }
    )


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast by name; a value that does not fit becomes NULL under any ANSI setting."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def null_defaults(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
