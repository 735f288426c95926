"""Runs of stages that take over what is still right of earlier runs, and publish all of it or nothing."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from . import snapshots as K


@dataclass(frozen=True)
class Stage:
    """A table made by ``make`` of the tables it ``needs`` (inputs, or earlier stages) and ``settings``.

    ``version`` is to be raised when ``make`` comes to mean something else.
    """

    name: str
    needs: tuple[str, ...]
    make: Callable[..., DataFrame]
    settings: dict[str, Any] = field(default_factory=dict)
    version: int = 1


@dataclass(frozen=True)
class Done:
    """What a run says of a stage: the key of its output, whether that was there, its number of rows and digest."""

    stage: str
    key: str
    reused: bool
    rows: int
    digest: str


def key_of(stage: Stage, digests: dict[str, str]) -> str:
    """Depends on the stage's settings and version and on the content of what it needs, and on nothing else."""
    said = [stage.name, stage.version, sorted(stage.settings.items()), [[n, digests[n]] for n in stage.needs]]
    return hashlib.sha256(json.dumps(said, sort_keys=True, default=str).encode()).hexdigest()


def run_stages(spark: SparkSession, root: str, inputs: dict[str, DataFrame], stages: Iterable[Stage]) -> tuple[dict[str, DataFrame], list[Done]]:
    """The tables of all stages, in order, and what was done for each.

    A stage's output is kept below ``root`` by its key and named complete by a note put last,
    so a run that was broken off goes on where it stopped. A changed input, setting or
    version runs its stage again; stages that follow run again only if what they need
    came out different. Inputs are digested as multisets of rows, whatever their files.
    """
    tables, digests, done = dict(inputs), {n: K.table_digest(t).first()["digest"] for n, t in inputs.items()}, []
    for stage in stages:
        key = key_of(stage, digests)
        at = f"{root}/stages/{stage.name}/{key}"
        note = K.read_note(spark, f"{at}/done.json")
        reused = note is not None
        if note is None:
            rows = stage.make(*[tables[n] for n in stage.needs], **stage.settings)
            rows.write.mode("overwrite").parquet(f"{at}/rows")  # what a broken run left is no use
            own = K.table_digest(spark.read.schema(rows.schema).parquet(f"{at}/rows").select(*rows.columns)).first()
            note = {"rows": own["rows"], "digest": own["digest"], "schema": rows.schema.json()}
            K.write_note(spark, f"{at}/done.json", note)
        schema = StructType.fromJson(json.loads(note["schema"]))
        tables[stage.name] = spark.read.schema(schema).parquet(f"{at}/rows").select(*schema.names)
        digests[stage.name] = note["digest"]
        done.append(Done(stage.name, key, reused, note["rows"], note["digest"]))
    return {s: t for s, t in tables.items() if s not in inputs}, done


def publish_run(spark: SparkSession, root: str, inputs: dict[str, DataFrame], stages: Iterable[Stage], **options) -> tuple[str, list[Done]]:
    """A run whose tables are published as one generation, under one manifest, or not at all.

    The claim is made first: a writer that begins later makes this one's publishing fail, and
    what was published stays.
    """
    claimed = K.claim(spark, root)
    tables, done = run_stages(spark, root, inputs, stages)
    return K.publish(tables, root, claimed=claimed, **options), done
