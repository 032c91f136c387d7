"""The daily batch: landing → bronze → silver → gold, under batch control.

Table layout under one lake root (all parquet):

    bronze/            partitioned by batch_id       (replace per batch)
    silver/            partitioned by ingesta_date   (guarded upsert)
    gold/dim_<name>/   unpartitioned                 (insert-only, stable keys)
    gold/fact/         partitioned by ingesta_date   (replace per batch)
    gold/audit/        partitioned by ingesta_date   (replace per batch)
    gold/price_moves/  partitioned by fecha          (replace per day)
    gold/last_prices/  a folder as_of=<day>/v<n> each (the last few days' states)
    control/           partitioned by batch_id       (one partition per batch)

Rerunning a failed or repeated batch converges to the same tables: bronze, fact
and move partitions are replaced, the silver merge is guarded by batch id,
dimensions only insert keys they have not seen, and a price state is a folder of
its own that a rerun writes anew from the state before it.  Each of these writes is
published at once (``sources.versions``): a crash leaves the table as it was before.
One driver at a time works on a batch: it holds the batch's lease, which expires if
it dies (``claim_batch``).  Batches may come in
any order: a late one recomputes the moves of the products it holds.  Work is
distributed throughout; the driver only sees batch ids, folder names, one-row
gates and the largest issued key of each dimension.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import schemas as SC
from shelfwise import constants as K
from shelfwise.operators.filters import BatchGateError, enforce_gate
from shelfwise.plans import analytics as A
from shelfwise.plans import control as C
from shelfwise.plans import gold as G
from shelfwise.plans import silver as S
from shelfwise.session import (delete_path, path_exists, publish_file, read_text, scratch_table, subfolders,
                               subpaths)
from shelfwise.sources import landing as L
from shelfwise.sources import tables as TB
from shelfwise.sources import versions as V

ISO = "%Y-%m-%d"


@dataclass(frozen=True)
class Lake:
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def bronze(self) -> str:
        return self.path("bronze")

    @property
    def silver(self) -> str:
        return self.path("silver")

    @property
    def fact(self) -> str:
        return self.path("gold/fact")

    @property
    def audit(self) -> str:
        return self.path("gold/audit")

    @property
    def control(self) -> str:
        return self.path("control")

    def dim(self, name: str) -> str:
        return self.path(f"gold/dim_{name}")


def _check_batch_id(batch_id: str) -> dt.date:
    if not batch_id:
        raise ValueError("batch_id is required (no implicit 'today')")
    return dt.datetime.strptime(batch_id, ISO).date()


# --- control -------------------------------------------------------------------------

def read_control(spark: SparkSession, lake: Lake) -> DataFrame | None:
    if not TB.table_exists(spark, lake.control):
        return None
    return TB.read_table(spark, lake.control, SC.CONTROL)


def _write_control(spark: SparkSession, lake: Lake, new_state: DataFrame, batch_id: str) -> None:
    rows = new_state.filter(F.col("batch_id") == batch_id).select(*SC.CONTROL.fieldNames())
    TB.replace_partitions(rows, lake.control, ["batch_id"])


def _empty_control(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SC.CONTROL)


def mark_started(spark: SparkSession, lake: Lake, batch_id: str) -> None:
    ctl = read_control(spark, lake)
    ctl = ctl if ctl is not None else _empty_control(spark)
    ids = spark.createDataFrame([(batch_id,)], "batch_id string")
    # a rerun starts over, whatever the last run came to
    every = (K.STATUS_FAILED, K.STATUS_COMPLETED, K.STATUS_IN_PROGRESS)
    _write_control(spark, lake, C.start_batches(ctl.filter(F.col("batch_id") == batch_id), ids, every),
                   batch_id)


def mark_completed(spark: SparkSession, lake: Lake, batch_id: str) -> None:
    ctl = read_control(spark, lake).filter(F.col("batch_id") == batch_id)
    ids = spark.createDataFrame([(batch_id,)], "batch_id string")
    _write_control(spark, lake, C.complete_batches(ctl, ids), batch_id)


def mark_failed(spark: SparkSession, lake: Lake, batch_id: str, message: str) -> None:
    ctl = read_control(spark, lake).filter(F.col("batch_id") == batch_id)
    _write_control(spark, lake, C.fail_batches(ctl, F.lit(True), message), batch_id)


def next_batch_id(spark: SparkSession, landing_base: str, lake: Lake,
                  glob: str = "*.json") -> str | None:
    files = L.landing_files(spark, landing_base, glob=glob)
    return C.next_batch(files, read_control(spark, lake)).first()["siguiente_batch"]


# --- the lease of a batch -------------------------------------------------------------

class BatchClaimedError(RuntimeError):
    """Another driver is at work on the batch."""


def claim_batch(spark: SparkSession, lake: Lake, batch_id: str, owner: str, hours: float = 6.0,
                clock: Callable[[], float] = time.time) -> str:
    """Take the batch for ``owner``; returns the lease, for ``release_batch``.

    Leases of a batch are numbered files, each made by an exclusive create, so of
    two drivers that start at once one gets the number and the other raises
    ``BatchClaimedError``.  A lease whose time is over, or that was given back, may
    be followed by the next one; an owner may take its own batch again.
    """
    folder = lake.path(f"claims/{batch_id}")
    names = subpaths(spark, folder)
    last = max((n for n in names if n.endswith(".json")), default=None)
    if last is not None and f"{last}.released" not in names:
        held = json.loads(read_text(spark, f"{folder}/{last}"))
        if held["owner"] != owner and held["until"] > clock():
            raise BatchClaimedError(f"batch {batch_id} is held by {held['owner']} until {held['until']:.0f}")
    number = 1 if last is None else int(last.removesuffix(".json")) + 1
    lease = f"{folder}/{number:06d}.json"
    if not publish_file(spark, lease, json.dumps({"owner": owner, "until": clock() + 3600 * hours})):
        raise BatchClaimedError(f"batch {batch_id} has just been taken by another driver")
    return lease


def release_batch(spark: SparkSession, lease: str) -> None:
    """Give a lease back."""
    publish_file(spark, f"{lease}.released", "")


# --- layers ------------------------------------------------------------------------------

def load_bronze(spark: SparkSession, landing_base: str, lake: Lake, batch_id: str, *,
                glob: str = "*.json", mode: str = "replace") -> bool:
    """Read the batch's landing folder and write its bronze partition."""
    day = _check_batch_id(batch_id)
    # The declared schema keeps this batch's partition compatible when
    # inference degrades a type (all-empty arrays).
    hints = declared_bronze(spark, lake)
    scratch: list[str] = []
    try:
        df = L.read_landing(spark, landing_base, batch_id=batch_id, glob=glob, type_hints=hints, scratch=scratch)
        df = df.withColumn("ingesta_date", F.lit(day))
        written = TB.write_batch(spark, df, lake.bronze, batch_id, mode=mode)
        _declare_bronze(spark, lake, batch_id, hints, df.schema)
        return written
    finally:
        for place in scratch:
            delete_path(spark, place)


def declared_bronze(spark: SparkSession, lake: Lake) -> T.StructType | None:
    """Bronze columns and types seen so far, the richest type of each."""
    path = lake.path("bronze_schema")
    versions = [v for v in subfolders(spark, path) if path_exists(spark, f"{path}/{v}/_SUCCESS")]
    if not versions:
        return None
    text = spark.read.text(f"{path}/{versions[-1]}", wholetext=True).first()
    return T.StructType.fromJson(json.loads(text[0]))


def _declare_bronze(spark: SparkSession, lake: Lake, batch_id: str, known: T.StructType | None,
                    seen: T.StructType) -> None:
    """A new version of the declared schema, if this batch adds to it."""
    types = {f.name: f.dataType for f in known.fields} if known else {}
    for f in seen.fields:
        types[f.name] = L.widen(types[f.name], f.dataType) if f.name in types else f.dataType
    now = T.StructType([T.StructField(n, t, True) for n, t in types.items()])
    if known is None or now != known:
        path = lake.path("bronze_schema")
        version = len(subfolders(spark, path))
        spark.createDataFrame([(now.json(),)], "value string").coalesce(1) \
            .write.text(f"{path}/v{version:06d}-{batch_id}")


def load_silver(spark: SparkSession, lake: Lake, batch_id: str, reading: Observation | None = None
                ) -> DataFrame:
    """Build the batch's snapshot from bronze and upsert it into silver.

    Guard: an existing row is replaced only by a source row whose batch id is
    not older; the created timestamp of an existing row is kept.  ``reading`` counts,
    while the snapshot is built, the rows read and the values that each cast rejects.
    """
    _check_batch_id(batch_id)
    bronze = TB.read_partition(spark, lake.bronze, "batch_id", batch_id)
    enforce_gate(bronze, ["productid"], "ingesta_date")
    now = F.current_timestamp()
    snap = (S.build_silver(bronze, reading=reading)
            .withColumn("created_timestamp", now).withColumn("updated_timestamp", now)
            .select(*SC.SILVER.fieldNames()))
    TB.merge_into_table(spark, lake.silver, snap, ["productid", "ingesta_date"], "ingesta_date",
                        guard=lambda t, s: s("batch_id") >= t("batch_id"),
                        keep_cols=["created_timestamp"], touched={"updated_timestamp": now},
                        schema=SC.SILVER)
    return silver_of(spark, lake, batch_id)


def silver_of(spark: SparkSession, lake: Lake, batch_id: str) -> DataFrame:
    """The batch's snapshot rows: its date partition alone, and in it the rows
    that are this batch's."""
    day = _check_batch_id(batch_id)
    silver = TB.read_table(spark, lake.silver, SC.SILVER, only=("ingesta_date", [day])).filter(
        F.col("ingesta_date") == F.lit(day))
    return TB.scan_batch(silver, "batch_id", batch_id)


def _dimension(spark: SparkSession, lake: Lake, name: str) -> DataFrame | None:
    p = lake.dim(name)
    return TB.read_table(spark, p, SC.DIMENSION_SCHEMAS[name]) if TB.table_exists(spark, p) else None


def load_gold(spark: SparkSession, lake: Lake, batch_id: str, *, fact_mode: str = "replace"
              ) -> dict[str, int]:
    """Insert new dimension members, then replace the batch's fact and audit
    partitions.  Returns the rows of the batch in silver, fact and audit.

    The batch must not be empty nor hold a NULL product or date, and every
    silver row must end up in the fact or in the audit; else this raises.
    """
    day = _check_batch_id(batch_id)
    with scratch_table(silver_of(spark, lake, batch_id), "silver-batch") as src:
        enforce_gate(src, ["productid"], "ingesta_date")
        if TB.create_if_missing(spark, lake.dim("etiquetado"), SC.DIM_ETIQUETADO):
            TB.append_table(G.label_junk(spark), lake.dim("etiquetado"))
        dims = {}
        for name, (key, nk, builder) in G.DIMENSIONS.items():
            old = _dimension(spark, lake, name)
            with scratch_table(G.new_members(old, builder(src), nk), f"new-{name}") as rows:
                new = G.number_members(old, rows, key, nk)
                TB.append_table(new.select(*SC.DIMENSION_SCHEMAS[name].fieldNames()), lake.dim(name))
            dims[name] = _dimension(spark, lake, name)
        dims["etiquetado"] = _dimension(spark, lake, "etiquetado")
        if fact_mode == "skip" and TB.table_exists(spark, lake.fact) and TB.batch_exists_in(
                spark, lake.fact, "ingesta_date", day, SC.FACT):
            return {"fact": -1}
        # The batch's partitions are rewritten even when empty (no stale rows).
        fact = G.fact_rows(src, dims).select(*[c for c in SC.FACT.fieldNames() if c != "ingesta_date"])
        TB.overwrite_partition(fact, lake.fact, "ingesta_date", day)
        audit = G.audit_rows(src, dims).select(*[c for c in SC.AUDIT.fieldNames()
                                                 if c != "ingesta_date"])
        TB.overwrite_partition(audit, lake.audit, "ingesta_date", day)
        counts = {"silver": src.count()}
    for name, path, schema in (("fact", lake.fact, SC.FACT), ("audit", lake.audit, SC.AUDIT)):
        counts[name] = TB.read_table(spark, path, schema, only=("ingesta_date", [day])).count()
    if counts["silver"] != counts["fact"] + counts["audit"]:
        raise BatchGateError(f"batch {batch_id} does not add up: {counts}")
    return counts


#: Price states kept; older ones are deleted.
STATES_KEPT = 3


def _states(spark: SparkSession, lake: Lake) -> dict[dt.date, str]:
    """Day → folder of its newest complete price state, oldest day first."""
    root, out = lake.path("gold/last_prices"), {}
    for name in subfolders(spark, root):
        whole = [v for v in subfolders(spark, f"{root}/{name}")
                 if path_exists(spark, f"{root}/{name}/{v}/_SUCCESS")]
        if name.startswith("as_of=") and whole:
            out[dt.date.fromisoformat(name.removeprefix("as_of="))] = f"{root}/{name}/{whole[-1]}"
    return out


def _write_state(spark: SparkSession, lake: Lake, day: dt.date, state: DataFrame) -> None:
    """Write a day's state beside its older versions, which go only when the new
    one is complete."""
    folder = lake.path(f"gold/last_prices/as_of={day}")
    older = subfolders(spark, folder)
    version = 1 + max((int(v.removeprefix("v")) for v in older), default=0)
    state.write.parquet(f"{folder}/v{version:06d}")
    for v in older:
        delete_path(spark, f"{folder}/{v}")


def load_price_moves(spark: SparkSession, lake: Lake, batch_id: str) -> None:
    """Write the batch's price moves without rescanning history.

    ``gold/last_prices/as_of=<day>`` holds each product's latest valid price up
    to that day.  A batch newer than all states joins the newest one before it
    and writes the state of its own day; rerunning it does the same again.
    A late batch (there is a state of a later day) changes two days of each of
    its products: its own, and the next day with a valid price.  Both are
    recomputed from the products' history in silver, and the later states take
    over its prices where they are the later ones.  A state is never written in
    place, so a crash leaves the one before it.
    """
    day = _check_batch_id(batch_id)
    moves_path = lake.path("gold/price_moves")
    states = _states(spark, lake)
    batch = silver_of(spark, lake, batch_id)
    now = batch.filter(F.col("precio_valido")).select(
        "productid", F.lit(day).alias("fecha"), F.col("precio_regular").alias("precio"))
    later = [d for d in states if d > day]
    if later:
        _late_moves(spark, lake, batch, moves_path)
        for d in later:
            _write_state(spark, lake, d, _latest_prices(spark.read.parquet(states[d]), now))
        return
    earlier = [d for d in states if d < day]
    before = spark.read.parquet(states[earlier[-1]]) if earlier else None
    moves, _ = A.next_price_moves(before, batch, date_col="ingesta_date")
    TB.overwrite_partition(moves.drop("fecha"), moves_path, "fecha", day)
    _write_state(spark, lake, day, now if before is None else _latest_prices(before, now))
    for old in earlier[:-STATES_KEPT + 1]:
        delete_path(spark, lake.path(f"gold/last_prices/as_of={old}"))


def _latest_prices(state: DataFrame, now: DataFrame) -> DataFrame:
    """For each product the price of its later day."""
    newest = F.max(F.struct("fecha", "precio")).alias("_p")
    return state.unionByName(now).groupBy("productid").agg(newest).select("productid", "_p.*")


def _late_moves(spark: SparkSession, lake: Lake, batch: DataFrame, moves_path: str) -> None:
    """Recompute the moves that a late batch adds or changes."""
    silver = TB.read_table(spark, lake.silver, SC.SILVER)
    with scratch_table(batch.select("productid", "ingesta_date").distinct(), "late-products") as late:
        day = late.select("ingesta_date").first()[0]
        ids = late.select("productid")
        history = silver.join(ids, "productid", "left_semi")
        later = history.filter(F.col("precio_valido") & (F.col("ingesta_date") > F.lit(day)))
        following = later.groupBy("productid").agg(F.min("ingesta_date").alias("fecha"))
        moved = A.price_moves(history, date_col="ingesta_date")
        with scratch_table(following, "late-following") as after:
            days = [day, *[r[0] for r in after.select("fecha").distinct().collect()]]  # one for each batch at most
            changed = after.unionByName(ids.withColumn("fecha", F.lit(day))).distinct()
            rows = moved.join(changed, ["productid", "fecha"], "left_semi")
            base = V.current(spark, moves_path)
            if base is not None:
                old = V.read_version(spark, moves_path, base, only=("fecha", days))
                rows = old.join(changed, ["productid", "fecha"], "left_anti").select(*rows.columns) \
                    .unionByName(rows)
            # all days in one version: the other products' moves are there before and after
            TB.overwrite_partitions(rows, moves_path, "fecha", days, base)


def require_complete(spark: SparkSession, landing_base: str, batch_id: str, expected: list[str],
                     glob: str = "*.json") -> None:
    """Raise unless the batch has a file of every expected section."""
    files = L.landing_files(spark, landing_base, glob=glob).filter(F.col("batch_id") == batch_id)
    found = L.landing_completeness(files, expected).first()
    if found is None or not found["completo"]:
        missing = sorted(expected) if found is None else found["faltantes"]
        raise L.LandingError(f"batch {batch_id} lacks the sections {missing}")


class BatchCounts(dict):
    """Rows of each stage; ``rejects``: for each cast column the values that were
    there and could not be read as its type."""
    rejects: dict[str, int]


def run_daily_batch(spark: SparkSession, landing_base: str, lake: Lake, batch_id: str, *,
                    glob: str = "*.json", expected_sections: list[str] | None = None,
                    owner: str | None = None) -> BatchCounts:
    """One batch end to end under control: IN_PROGRESS → COMPLETED, or FAILED.

    With ``expected_sections`` the batch fails while any of them is missing, and
    is taken up again by the next run.  Returns the rows of each stage, with the
    rejected values.  Raises ``BatchClaimedError``, and changes nothing, while another
    ``owner`` (default: one for each call) holds the batch.
    """
    _check_batch_id(batch_id)
    lease = claim_batch(spark, lake, batch_id, owner or uuid.uuid4().hex)
    try:
        mark_started(spark, lake, batch_id)
        try:
            if expected_sections is not None:
                require_complete(spark, landing_base, batch_id, expected_sections, glob)
            load_bronze(spark, landing_base, lake, batch_id, glob=glob)
            seen = Observation("silver")
            load_silver(spark, lake, batch_id, seen)
            counts = BatchCounts(bronze=seen.get["rows_read"])
            counts.rejects = {c: n for c, n in seen.get.items() if c in S.CASTS}
            counts |= load_gold(spark, lake, batch_id)
            load_price_moves(spark, lake, batch_id)
        except Exception as e:
            mark_failed(spark, lake, batch_id, f"{type(e).__name__}: {e}")
            raise
        mark_completed(spark, lake, batch_id)
        return counts
    finally:
        release_batch(spark, lease)


def vacuum(spark: SparkSession, lake: Lake, keep: int = 2, older_than_hours: float = 24 * 7) -> None:
    """Delete files of the lake's tables that only older versions need."""
    dims = [lake.dim(n) for n in SC.DIMENSION_SCHEMAS]
    for path in (lake.bronze, lake.silver, lake.fact, lake.audit, lake.control,
                 lake.path("gold/price_moves"), *dims):
        V.vacuum(spark, path, keep, older_than_hours)


class PendingBatchesFailed(RuntimeError):
    pass


def run_pending(spark: SparkSession, landing_base: str, lake: Lake, *, glob: str = "*.json",
                max_batches: int | None = None, expected_sections: list[str] | None = None) -> list[str]:
    """Process pending landing batches oldest first; returns the ids processed.

    A batch that fails does not hold up the others: it stays FAILED, the next
    ones run, and ``PendingBatchesFailed`` names it at the end.
    """
    files = L.landing_files(spark, landing_base, glob=glob)
    pending = C.pending_batches(files, read_control(spark, lake))
    ids = sorted(r[0] for r in pending.collect())  # one for each day not yet loaded
    done, failed = [], {}
    for b in ids[:max_batches]:
        try:
            run_daily_batch(spark, landing_base, lake, b, glob=glob, expected_sections=expected_sections)
            done.append(b)
        except Exception as e:  # noqa: BLE001 - whatever it was is in the control table, and raised below
            failed[b] = e
    if failed:
        raise PendingBatchesFailed(f"done {done}, failed {failed}") from next(iter(failed.values()))
    return done


def register_views(spark: SparkSession, lake: Lake) -> list[str]:
    """Temp views over the lake's tables for SQL users (``silver``, ``fact``,
    ``audit``, ``control``, ``dim_<name>``); returns the names registered."""
    tables = {"silver": (lake.silver, SC.SILVER), "fact": (lake.fact, SC.FACT),
              "audit": (lake.audit, SC.AUDIT), "control": (lake.control, SC.CONTROL)}
    tables.update({f"dim_{n}": (lake.dim(n), s) for n, s in SC.DIMENSION_SCHEMAS.items()})
    done = []
    for name, (path, schema) in tables.items():
        if TB.table_exists(spark, path):
            TB.read_table(spark, path, schema).createOrReplaceTempView(name)
            done.append(name)
    return done
