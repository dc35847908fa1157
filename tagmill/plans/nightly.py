"""The nightly chain: landed snapshots in, dated datasets and feeds out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.documents import build_documents
from ..operators.pairs import compare_pairs, pair_scores
from ..operators.ranking import SCORES, custom_rank
from ..operators.snapshots import removed_keys, snapshot_diff
from ..operators.subjects import eligible_subjects, enrich_subjects, subject_aliases, subject_list
from ..operators.tags import tag_table
from ..session import counted
from ..sources.ledger import Ledger
from ..sources.readers import latest_snapshot, line_key, list_files, read_jsonlines, read_tsv
from ..sources.writers import (
    DOCUMENTS_PER_FILE,
    LINES_PER_FILE,
    dated_path,
    write_csv,
    write_jsonlines,
    write_numbered,
    write_tsv,
)


@dataclass(frozen=True)
class Paths:
    """Where snapshots lie. ``records``, ``stats`` and ``archive`` are files or folders of JSON lines; those not given are the
    newest landed below ``landed`` under these names. Outputs go below ``output``. The chain knows from its ledger there what
    the last night has read and written; previous ones are named only to have it compare with others."""

    output: str
    records: str | None = None
    stats: str | None = None
    archive: str | None = None
    landed: str | None = None
    previous_records: str | None = None
    previous_subjects: str | None = None


def newest(spark: SparkSession, folder: str, prefix: str, n: int = 1) -> str | None:
    """Path of the n-th newest snapshot in a folder."""
    found = latest_snapshot(list_files(spark, folder), prefix, n).first()
    return found["path"] if found else None


def _chosen_inputs(spark: SparkSession, paths: Paths, ledger: Ledger) -> dict[str, str]:
    """The snapshots that this night reads. They are written to the ledger first, so a night that is taken up again
    reads the same ones, whatever has landed since."""
    given = {name: getattr(paths, name) for name in ("records", "stats", "archive")}
    entry = ledger.done.get("night")
    known = dict(entry["inputs"]) if entry else {}
    chosen = {name: path or known.get(name) for name, path in given.items()}
    for name in [n for n, path in chosen.items() if path is None and paths.landed]:
        chosen[name] = newest(spark, paths.landed, name)
    missing = [name for name, path in chosen.items() if path is None]
    if missing:
        raise FileNotFoundError(f"no snapshot of {', '.join(missing)} below {paths.landed}")
    if chosen != known:
        ledger.commit("night", chosen)
    return chosen


def run_pipeline(
    spark: SparkSession,
    paths: Paths,
    as_of: dt.date,
    mapping: Mapping[str, str] | None = None,
    media: str | None = "anime",
    min_ratings: int = 50,
    **ranking,
) -> dict[str, int]:
    """Run every job of the chain; returns rows written per dataset.

    Each dataset is written once, entered in the ledger below the output, and read back by later jobs, as in separate
    runs. A night that broke is taken up at the first dataset without an entry; a dataset whose inputs or settings have
    changed since is made anew.
    """
    out, ledger = paths.output.rstrip("/"), Ledger(spark, paths.output, as_of)
    inputs = _chosen_inputs(spark, paths, ledger)
    # What the last finished night has read and written, before this one adds to it.
    last_update, last_subjects = ledger.before("collections_update"), ledger.before("subject_archive")
    previous_records = paths.previous_records or (last_update["inputs"]["records"] if last_update else None)
    previous_subjects = paths.previous_subjects or (last_subjects["path"] if last_subjects else None)
    rows: dict[str, int] = {}

    def settings(**values) -> dict[str, str]:
        return {name: repr(value) for name, value in values.items()}

    conversion = settings(mapping=sorted(mapping.items()) if mapping else None)
    chosen = settings(media=media, min_ratings=min_ratings)
    ranked_by = settings(**ranking)

    def publish(name: str, given: Mapping, make, write=None, read=None, shown: bool = False) -> DataFrame:
        """A dataset as JSON lines, or as ``write`` and ``read`` say; ``shown`` datasets are counted in the result."""

        def stored(df: DataFrame) -> tuple[str, int]:
            observed, seen = counted(df, name)
            path = dated_path(f"{out}/{name}", as_of)
            if write:
                write(observed, path)
            else:
                write_jsonlines(observed, f"{out}/{name}", as_of)
            return path, seen.get["rows"]

        df = ledger.publish(name, given, make, stored, read or (lambda path, schema: read_jsonlines(spark, path, schema)))
        if shown:
            rows[name] = ledger.done[name]["rows"]
        return df

    def parquet(df: DataFrame, path: str) -> None:
        df.write.mode("overwrite").parquet(path)

    def read_parquet(path: str, schema) -> DataFrame:
        return spark.read.schema(schema).parquet(path)

    def read_text(path: str, schema) -> DataFrame:
        return spark.read.option("recursiveFileLookup", "true").text(path)

    stats = read_jsonlines(spark, inputs["stats"], schemas.SUBJECT_API)
    archive = read_jsonlines(spark, inputs["archive"], schemas.SUBJECT_ARCHIVE)
    on_records = {"records": inputs["records"]}
    on_subjects = {"stats": inputs["stats"], "archive": inputs["archive"]}

    records = publish("collections", on_records, lambda: _used_records(spark, inputs["records"]), parquet, read_parquet)
    subjects = publish("subject_archive", on_subjects, lambda: enrich_subjects(stats, archive), shown=True)
    publish(
        "subject_entity", {"archive": inputs["archive"]} | conversion, lambda: subject_aliases(archive, mapping=mapping), shown=True
    )
    on_tags = on_records | {"archive": inputs["archive"]} | conversion
    tags = publish("tags", on_tags, lambda: tag_table(records, archive, mapping), shown=True)

    on_pairs = on_records | on_subjects | chosen
    ranked = publish(
        "subject_tsv", on_subjects | chosen, lambda: subject_list(eligible_subjects(subjects, media, min_ratings)), write_tsv,
        lambda path, schema: read_tsv(spark, path, schema),
    )
    pairs = publish("pairs", on_pairs, lambda: compare_pairs(records, subjects, media, min_ratings), parquet, read_parquet)
    for score in SCORES:
        publish(
            f"pair_{score}", on_pairs, lambda score=score: pair_scores(pairs, score), write_tsv,
            lambda path, schema: read_tsv(spark, path, schema),
        )
    merged = publish(
        "customrank", on_pairs | ranked_by, lambda: custom_rank(pairs, ranked, **ranking),
        lambda df, path: write_csv(df, path, ["name", "rank_custom", "rank_site", "subjectname"]),
        lambda path, _: spark.read.schema(schemas.RANKING).csv(path, header=True, escape='"'),
    )

    publish(
        "subject_comprehensive", on_pairs | on_tags | ranked_by, lambda: build_documents(subjects, tags, merged, as_of),
        lambda df, path: write_numbered(df, path, DOCUMENTS_PER_FILE),
        lambda path, schema: spark.read.schema(schema).option("recursiveFileLookup", "true").json(path), shown=True,
    )
    if previous_subjects:
        gone = on_subjects | {"previous": previous_subjects}
        before = read_jsonlines(spark, previous_subjects, schemas.SUBJECTS)
        publish("subject_del", gone, lambda: removed_keys(before, subjects, "id"), shown=True)

    lines = _keyed_lines(spark, inputs["records"])
    before = _keyed_lines(spark, previous_records) if previous_records else None
    upserts, deletes = snapshot_diff(lines if before is None else before, lines, "id")
    if before is not None:
        publish("collections_del", on_records | {"previous": previous_records}, lambda: deletes, shown=True)
    # Last, as its entry says which records the deletes of the next night are compared with.
    publish(
        "collections_update", on_records, lambda: upserts.select(F.col("line").alias("value")),
        lambda df, path: write_numbered(df, path, LINES_PER_FILE, "text"), read_text,
    )
    return rows


def _used_records(spark: SparkSession, path: str) -> DataFrame:
    """The record columns the jobs use, parsed from JSON once; each job then reads only its own."""
    return read_jsonlines(spark, path, schemas.COLLECTIONS).select("user_id", "user_order", "subject_id", "rate", "tags")


def _keyed_lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).select(F.col("value").alias("line"))
    return lines.withColumn("id", line_key(F.col("line"), ["subject_id", "user_order"]))
