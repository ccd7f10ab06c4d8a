"""JSON path helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from playstats.schemas import ARTIST_CREDIT_DDL


def credit_genres(credit) -> Column:
    """Genre names of an artist credit: ``$[*].artist.genres[*].name``.

    Returns an array (never NULL) of the non-NULL names in document order,
    repeats kept. A credit that is NULL, ``[]``, has ``genres: null`` or
    lacks ``genres`` contributes nothing. ``flatten`` is NULL if any inner
    array is NULL, hence the ``coalesce``.
    """
    c = F.col(credit) if isinstance(credit, str) else credit
    parsed = F.from_json(c, ARTIST_CREDIT_DDL)
    per_artist = F.transform(
        parsed,
        lambda x: F.coalesce(
            F.transform(x["artist"]["genres"], lambda g: g["name"]),
            F.array().cast("array<string>"),
        ),
    )
    names = F.filter(F.flatten(per_artist), lambda n: n.isNotNull())
    return F.coalesce(names, F.array().cast("array<string>"))


def json_scalar(c, path: str, cast: str | None = None) -> Column:
    """Scalar at a JSON path (``$.k``), optionally cast."""
    v = F.get_json_object(F.col(c) if isinstance(c, str) else c, path)
    return v.cast(cast) if cast else v
