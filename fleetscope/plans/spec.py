"""Binding of a job to its test inputs and its DuckDB oracle.

A ``Spec`` names input frames as SQL over the driver's tables and the estate views
(the same text is used by Spark and as CTEs of the oracle), a ``build`` function
that runs the job with the DataFrame API, and the oracle query body.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from fleetscope.sources import fixtures


@dataclass
class Spec:
    build: Callable[..., DataFrame]
    inputs: dict[str, str] = field(default_factory=dict)
    oracle: str | None = None
    needs_spark: bool = False
    name: str | None = None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        texts = list(self.inputs.values()) + ([self.oracle] if self.oracle else [])
        views = sorted({v for t in texts for v in fixtures.referenced(t, fixtures.VIEWS)})
        base = {b for t in list(self.inputs.values()) + [fixtures.VIEWS[v] for v in views]
                for b in fixtures.referenced(t, fixtures.BASE_TABLES)}
        fixtures.register_tables(spark, sf_dir, sorted(base))
        for v in views:
            spark.sql(fixtures.VIEWS[v]).createOrReplaceTempView(v)
        frames = {alias: spark.sql(text) for alias, text in self.inputs.items()}
        out = self.build(spark, **frames) if self.needs_spark else self.build(**frames)
        return normalize_types(out)

    def oracle_sql(self) -> str | None:
        if self.oracle is None:
            return None
        body = self.oracle.strip()
        if self.inputs:
            ctes = ",\n".join(f"{a} as ({t.strip()})" for a, t in self.inputs.items())
            if body.lower().startswith("with "):
                body = f"with {ctes},\n{body[5:]}"
            else:
                body = f"with {ctes}\n{body}"
        body = fixtures.with_views(body)
        from fleetscope.plans.oracle_casts import CASTS
        casts = CASTS.get(self.name or "", {})
        if casts:
            rep = ", ".join(f'cast("{c}" as {t}) as "{c}"' for c, t in sorted(casts.items()))
            body = f"select * replace ({rep}) from (\n{body}\n) __oracle"
        return body


def normalize_types(df: DataFrame) -> DataFrame:
    """Report-level types: zoned timestamps become zone-less (same wall clock in the UTC
    session, as the landed files carry no zone), so results do not depend on the reader's
    time zone."""
    cols = []
    changed = False
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, TimestampType):
            cols.append(c.cast("timestamp_ntz").alias(f.name))
            changed = True
        else:
            cols.append(c)
    return df.select(*cols) if changed else df
