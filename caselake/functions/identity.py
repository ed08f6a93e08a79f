"""Row identity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from caselake import constants as K


def record_hash(columns: Sequence[str], safe: bool = False) -> Column:
    """SHA-256 over the listed columns.

    The default joins the text forms with a separator and NULL as '', so NULL
    and '' share a hash, and so do rows that differ only in where a separator
    falls. ``safe=True`` hashes a JSON form that keeps them apart.
    """
    if safe:
        whole = F.struct(*[F.col(f"`{c}`") for c in columns])
        return F.sha2(F.to_json(whole, {"ignoreNullFields": "false"}), 256)
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws(K.HASH_SEPARATOR, *texts), 256)
