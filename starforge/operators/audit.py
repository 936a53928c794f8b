"""Audits without an extra job: the row count (A5) and the texts that a
parser could not read (C1-C6) are counted while the DataFrame is written
(or otherwise acted on)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observe_rows(df: DataFrame, name: str | None = None) -> tuple[DataFrame, Observation]:
    """Return ``(df', obs)``; after the first action on ``df'``,
    ``obs.get['rows']`` holds its row count."""
    obs = Observation(name or f"rows_{uuid.uuid4().hex[:8]}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def row_count(df: DataFrame) -> int:
    """Plain row count (an action of its own)."""
    return df.count()


class ParseAudit:
    """Per column, how many rows held text that the parser turned into NULL
    (NULL and blank text are missing values, not failures).

    ``watch`` keeps the texts beside the parsed columns up to the counters
    only, so the job that writes the result counts them in its one scan; one
    audit watches one DataFrame.  ``failures()`` is known after that write.
    """

    def __init__(self) -> None:
        self._obs = Observation(f"parse_{uuid.uuid4().hex[:8]}")
        self._names: list[str] | None = None

    def watch(self, df: DataFrame, parsed: dict[str, Column], texts: dict[str, Column]) -> DataFrame:
        """``parsed`` (name -> expression over ``df``) as a DataFrame; the
        columns named in ``texts`` (name -> source text) are watched."""
        if self._names is not None:
            raise ValueError("this audit already watches a DataFrame")
        self._names = list(texts)
        beside = [c.cast("string").alias(f"__text_{i}") for i, c in enumerate(texts.values())]
        both = df.select(*[e.alias(n) for n, e in parsed.items()], *beside)
        failed = [F.count_if((F.trim(f"__text_{i}") != "") & F.col(f"`{n}`").isNull()).alias(f"n_{i}")
                  for i, n in enumerate(texts)]
        return (both.observe(self._obs, *failed) if failed else both).select(*[f"`{n}`" for n in parsed])

    def failures(self) -> dict[str, int]:
        if not self._names:
            return {}
        got = self._obs.get
        return {n: int(got[f"n_{i}"]) for i, n in enumerate(self._names)}
