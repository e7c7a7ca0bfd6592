"""Incremental rounds and run status on Structured Streaming; each has a batch twin on the same rules."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from attestra.functions.columns import case, lookup
from attestra.operators.joins import append_new
from attestra.operators.ranking import cap_rounds, first_rows

# Log markers and what they say about a run.
STATUS_MARKERS = (
    ("Step 1 — Crawl", "crawling"), ("Step 2 —", "reviewing"), ("Step 3 —", "reviewing"),
    ("Step 4 —", "reviewing"), ("Step 5 —", "reviewing"), ("Step 6 —", "reviewing"),
)
SOURCE_CAPS = {  # source -> (rows per round, rows in total)
    "europe_pmc": (20, 200), "openalex_grounding": (4, 24), "openalex_risk": (4, 24), "clinical_trials": (30, 100), "chembl_mechanism": (10, 20),
    "chembl_activity": (15, 50), "pubchem_bioassay": (2, 8), "openfda_drug_label": (5, 30), "openfda_faers": (1, 1), "kegg_pathway": (10, 40),
}


def discover_round(new: DataFrame, stored: DataFrame, by: Sequence[str], source: str, key: str, order: Sequence, caps: Mapping[str, tuple[int, int]] = SOURCE_CAPS) -> DataFrame:
    """One batch round: keys stored for the item drop out, the first row of a key stays, then the per-source caps."""
    fresh = append_new(new, stored, key, by)
    once = first_rows(fresh.filter(F.col(key).isNotNull()), [*by, key], order).unionByName(fresh.filter(F.col(key).isNull()))
    return cap_rounds(once, stored, {k: b for k, (b, _) in caps.items()}, {k: t for k, (_, t) in caps.items()}, by, source, order)


class _Discover(StatefulProcessor):
    """Seen keys of one item and its row counts by source; keys live in a map state, so no call loads them all."""

    def __init__(self, source: str, key: str, caps: Mapping[str, tuple[int, int]], default: tuple[int, int]):
        self.source, self.key, self.caps, self.default = source, key, dict(caps), default

    def init(self, handle: StatefulProcessorHandle) -> None:
        one = lambda n: StructType([StructField(n, StringType())])
        self.seen = handle.getMapState("seen", one("key"), StructType([StructField("n", IntegerType())]))
        self.counts = handle.getMapState("counts", one("source"), StructType([StructField("n", IntegerType())]))

    def _have(self, source) -> int:
        return self.counts.getValue((source,))[0] if self.counts.containsKey((source,)) else 0

    def _store(self, key, source, have: int) -> None:
        if key is not None:
            self.seen.updateValue((key,), (1,))
        self.counts.updateValue((source,), (have + 1,))

    def handleInitialState(self, key, initial: pd.DataFrame, timer_values) -> None:
        for k, s in zip(initial[self.key], initial[self.source], strict=True):
            s = "" if s is None else s
            self._store(k, s, self._have(s))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        taken: Counter = Counter()
        met: set = set()  # a key's first row of the round counts, whether the cap lets it in or not
        for pdf in rows:
            keep = []
            for i, (k, s) in enumerate(zip(pdf[self.key], pdf[self.source], strict=True)):
                s = "" if s is None else s
                if k is not None and (k in met or self.seen.containsKey((k,))):
                    continue
                met.add(k)
                batch, total = self.caps.get(s, self.default)
                have = self._have(s)
                if taken[s] < batch and have < total:
                    self._store(k, s, have)
                    taken[s] += 1
                    keep.append(i)
            if keep:
                yield pdf.iloc[keep]

    def close(self) -> None:
        pass


def discover_stream(rows: DataFrame, item: str, source: str, key: str = "material_key", caps: Mapping[str, tuple[int, int]] = SOURCE_CAPS, default: tuple[int, int] = (20, 200),
                    stored: DataFrame | None = None) -> DataFrame:
    """Streaming rounds: one micro-batch is one round, seeded from the stored rows. Needs the RocksDB state store."""
    seed = None if stored is None else stored.select(item, source, key).groupBy(item)
    return rows.groupBy(item).transformWithStateInPandas(_Discover(source, key, caps, default), rows.schema, "Append", "None", initialState=seed)


def round_meta(rows: DataFrame, round_col: str, by: Sequence[str], source: str, caps: Mapping[str, tuple[int, int]] = SOURCE_CAPS, default: int = 20) -> DataFrame:
    """New rows per round and source, and whether the source had fewer than its batch."""
    agg = rows.groupBy(*by, round_col, source).agg(F.count("*").alias("new_rows"))
    return agg.withColumn("exhausted", F.col("new_rows") < F.coalesce(lookup({k: b for k, (b, _) in caps.items()}, F.col(source)), F.lit(default)))


def write_rounds(rows: DataFrame, target: str, tag, checkpoint: str):
    """Every round is tagged and appended; replays of a batch id overwrite their own folder, so a lost task repeats nothing."""

    def one(batch: DataFrame, batch_id: int) -> None:
        tag(batch).write.mode("overwrite").parquet(f"{target}/round={batch_id}")

    return rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def line_status(line: str = "line"):
    return case(*[(F.contains(F.col(line), F.lit(m)), s) for m, s in STATUS_MARKERS])


def status_changes(lines: DataFrame, run: str = "run_id", order: Sequence = ("ts", "event_id"), line: str = "line", exits: DataFrame | None = None) -> DataFrame:
    """Status events of every run, only where the status changes; the exit code gives the last one.

    The previous status comes from a window inside time blocks of a run plus the last status of the blocks before.
    """
    marked = lines.withColumn("status", line_status(line)).filter("status IS NOT NULL").withColumn("_block", F.floor(F.col(order[0]).cast("timestamp").cast("double") / 3600))
    w = Window.partitionBy(run, "_block").orderBy(*order)
    inside = marked.withColumn("_prev", F.lag("status").over(w))
    ends = marked.groupBy(run, "_block").agg(F.max_by("status", F.struct(*order)).alias("_last"))
    carried = ends.withColumn("_carry", F.lag("_last").over(Window.partitionBy(run).orderBy("_block"))).select(run, "_block", "_carry")
    joined = inside.join(carried, [run, "_block"])
    events = joined.filter(~F.col("status").eqNullSafe(F.coalesce("_prev", "_carry"))).select(run, *order, "status")
    if exits is None:
        return events
    return events.unionByName(exits.select(run, *order, F.when(F.col("exit_code") == 0, "done").otherwise("crashed").alias("status")))


class _Status(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", StructType([StructField("status", StringType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        now = self.last.get()[0] if self.last.exists() else None
        for pdf in rows:
            pdf = pdf.sort_values(["ts", "event_id"])
            out = []
            for i, s in enumerate(pdf["status"]):
                if s != now:
                    now = s
                    out.append(i)
            if out:
                yield pdf.iloc[out]
        if now is not None:
            self.last.update((now,))

    def close(self) -> None:
        pass


def status_stream(lines: DataFrame) -> DataFrame:
    """Streaming form over (run_id, ts, event_id, line): an event per change of status."""
    marked = lines.withColumn("status", line_status()).filter("status IS NOT NULL").select("run_id", "ts", "event_id", "status")
    return marked.groupBy("run_id").transformWithStateInPandas(_Status(), marked.schema, "Append", "None")


def current_status(events: DataFrame, run: str = "run_id", order: Sequence = ("ts", "event_id")) -> DataFrame:
    """The row per run that an upsert of all events leaves."""
    return events.groupBy(run).agg(F.min(order[0]).alias("started_at"), F.max(order[0]).alias("updated_at"), F.max_by("status", F.struct(*order)).alias("status"))
