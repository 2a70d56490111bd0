"""What a job has finished, so that a job that was ended goes on where it stopped.

Every stage has a one-row table beside the job's output, written after the stage's own: the digest of the
job's input and settings, and what the stage adds to the summary. It is emptied before the stage starts, so
half-written output is never taken for finished, nor that of another input or of other settings.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revaudit.sources.writers import write_parquet

_DIGEST = "job_digest"


def job_digest(raw: DataFrame, *more: object) -> str:
    """A digest of all rows in any order, the schema, and the given settings; takes one pass over the rows.

    Rows are added up by two hashes of their JSON form, which keeps nulls and column borders apart.
    """
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns]), {"ignoreNullFields": "false"})
    hashes = [F.xxhash64(F.lit(salt), row).cast("decimal(38,0)") for salt in (1, 2)]
    sums = raw.agg(F.count(F.lit(1)).alias("n"), *[F.sum(h).alias(f"h{i}") for i, h in enumerate(hashes)])
    told = "|".join([raw.schema.json(), *map(repr, more)])
    parts = [F.lit(told), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sums.columns]]
    return sums.select(F.sha2(F.concat_ws("|", *parts), 256)).first()[0]


class Manifest:
    def __init__(self, spark: SparkSession, base: str, digest: str) -> None:
        self._spark, self._base, self._digest = spark, f"{base}/finished", digest

    def _write(self, stage: str, digest: str, added: dict[str, Column]) -> None:
        columns = [F.lit(digest).alias(_DIGEST), *[c.alias(name) for name, c in added.items()]]
        write_parquet(self._spark.range(1).select(*columns).coalesce(1), f"{self._base}/{stage}")

    def begin(self, stage: str) -> None:
        self._write(stage, "", {})

    def finish(self, stage: str, added: dict[str, Column]) -> None:
        self._write(stage, self._digest, added)

    def found(self, stage: str) -> dict[str, Column] | None:
        """What a finished stage adds to the summary; None if it must run."""
        try:
            noted = self._spark.read.parquet(f"{self._base}/{stage}")
        except AnalysisException:  # never begun, or ended while the note was being replaced
            return None
        row = noted.first()
        if row is None or row[_DIGEST] != self._digest:
            return None
        return {f.name: F.lit(row[f.name]).cast(f.dataType) for f in noted.schema if f.name != _DIGEST}
