"""Re-polling as a stream: newly landed pages update the tables.

Two streams share one ``TableStore``: fixture pages (``start_fixture_stream``)
and player history pages (``start_history_stream``).  A commit that loses a
race with the other stream is redone on the new state (another run has published
then, so the runs together always get on).  A page that cannot be parsed fails the
micro-batch, naming the file.

Fixture stream:

``readStream`` watches the fixtures landing folder; every micro-batch holds the
pages landed since the previous one.  ``foreachBatch``:

1. upserts the raw fixtures by fixture ``id`` into a keyed ``fixtures`` table with their
   landing time (``_metadata.file_modification_time``, then path); the newer page wins,
   in a batch and across batches, so a page that arrives late can't go back in time;
2. adds the changed fixtures' deltas to the stored sums per team (``team_sums``) and ranks
   ``team_info`` from them (``operators.maintained``);
3. refreshes ``fixture_info`` by difference: only gameweeks whose rows changed are written;
4. publishes all versions in one commit that also records the batch id.

History stream: a page is a player's whole history, so the newest page per player counts;
``history_pages`` keeps each player's newest landing time, and older pages change nothing.

A batch replayed after a failure between the commit and the stream checkpoint
finds its id already committed and is skipped, so replays change nothing.
There is no event-time state to keep: each batch is a snapshot update, so no
watermark is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as SC
from ..operators import gameweeks as GW
from ..operators import maintained as MT
from ..operators import standings as ST
from ..operators.difference import stage_changes
from ..operators.merge import latest_per_key
from ..sinks.tables import CommitConflict, TableStore
from ..sources import snapshot as SN

BATCH_KEY = "fixture_stream_batch"
HISTORY_BATCH_KEY = "history_stream_batch"
FIXTURES_KEY = ["id"]

LANDED_FIELD = T.StructField(SN.LANDED, T.StructType([T.StructField("time", T.TimestampType()), T.StructField("path", T.StringType())]))
STORED_FIXTURES = T.StructType([*SC.parsed(SC.FIXTURE).fields, LANDED_FIELD])
TEAM_SUMS = T.StructType([T.StructField(c, T.LongType()) for c in MT.SUM_COLUMNS])
HISTORY_PAGES = T.StructType([T.StructField("element", T.LongType()), LANDED_FIELD])


def _landed():
    """When and where the row's file landed; later files compare greater."""
    return F.struct(F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("path")).cast(LANDED_FIELD.dataType)


def _persisted(batch: DataFrame, fn):
    """A micro-batch is used by several actions: keep its parsed rows between
    them (lost blocks are recomputed from the landed files, which stay)."""
    batch = batch.persist()
    try:
        return fn(batch)
    finally:
        batch.unpersist()


def _with_retry(step):
    """Run ``step`` (stage + commit against the current state) until it commits."""
    while True:
        try:
            return step()
        except CommitConflict:
            continue


def fixture_batch(spark: SparkSession, store: TableStore, teams: DataFrame):
    def apply(batch: DataFrame, batch_id: int) -> None:
        _persisted(batch, lambda b: _with_retry(lambda: step(b, batch_id)))

    def step(batch: DataFrame, batch_id: int) -> None:
        state = store.state()
        if state["meta"].get(BATCH_KEY, -1) >= batch_id:
            return
        rows = SN.parsable(batch).withColumn(SN.LANDED, _landed())
        scanned = SN.conform(rows, SC.parsed(SC.FIXTURE), keep=[SN.LANDED]).filter(F.col("event").isNotNull())
        v_raw = store.stage_upsert("fixtures", scanned, FIXTURES_KEY, STORED_FIXTURES,
                                   on_duplicate="latest", order_by=[SN.LANDED], newer=SN.LANDED)
        fixtures = spark.read.schema(STORED_FIXTURES).parquet(store.path("fixtures", v_raw))
        if "team_sums" in state["tables"]:
            old, new = MT.replaced_rows(store.read("fixtures", STORED_FIXTURES),
                                        latest_per_key(scanned, FIXTURES_KEY, [SN.LANDED]), FIXTURES_KEY, SN.LANDED)
            sums = MT.apply_changes(store.read("team_sums", TEAM_SUMS), ST.fixture_frame(old), ST.fixture_frame(new))
        else:
            sums = MT.team_sums(ST.fixture_frame(fixtures))
        v_sums = store.stage("team_sums", sums)
        sums = spark.read.schema(TEAM_SUMS).parquet(store.path("team_sums", v_sums))
        v_team = store.stage_upsert("team_info", ST.league_from_sums(sums, teams), SC.TEAM_INFO_KEY, SC.TEAM_INFO)
        v_fix = stage_changes(store, "fixture_info", ST.fixture_info(fixtures), SC.FIXTURE_INFO, "gameweek_id")
        store.commit({"fixtures": v_raw, "team_sums": v_sums, "fixture_info": v_fix, "team_info": v_team},
                     meta={BATCH_KEY: batch_id}, base_seq=state["seq"])

    return apply


def start_fixture_stream(spark: SparkSession, fixtures_landing: str, teams: DataFrame,
                         store: TableStore, checkpoint_location: str,
                         available_now: bool = True, multi_line: bool = True,
                         max_files_per_trigger: int | None = None):
    reader = spark.readStream.schema(SN.with_corrupt(SC.FIXTURE)).option("multiLine", multi_line) \
        .option("columnNameOfCorruptRecord", SN.CORRUPT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(fixtures_landing).select("*", "_metadata")
    writer = stream.writeStream.foreachBatch(fixture_batch(spark, store, teams)) \
        .option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime="1 minute")
    return writer.start()


def history_batch(spark: SparkSession, store: TableStore, on_duplicate: str = "latest"):
    """Micro-batch of element-summary pages → partitioned upsert of player_gw_stats.

    A page holds a player's whole history, so the games per (player, gameweek) are counted
    within the batch, and only a player's newest page counts: the newest file per player
    is found on the (file, player) pairs, at most one row per landed file, files older than
    the player's newest known one are left out, and the rows are kept by a semi join with
    that list (which Spark broadcasts if its measured size is small).
    """
    order = ["kickoff_time", "fixture"]

    def step(batch: DataFrame, batch_id: int) -> None:
        state = store.state()
        if state["meta"].get(HISTORY_BATCH_KEY, -1) >= batch_id:
            return
        pages = SN.parsable(batch).select(_landed().alias(SN.LANDED), F.inline("history"))
        rows = SN.conform(pages, SC.parsed(SC.HISTORY), keep=[SN.LANDED])
        known = store.read("history_pages", HISTORY_PAGES).select("element", F.col(SN.LANDED).alias("_known"))
        newest = rows.where("element is not null").groupBy("element").agg(F.max(SN.LANDED).alias(SN.LANDED)) \
            .join(known, "element", "left").where(F.coalesce(F.col(SN.LANDED) >= F.col("_known"), F.lit(True))).drop("_known")
        v_pages = store.stage_upsert("history_pages", newest, ["element"], HISTORY_PAGES)
        rows = rows.join(newest, ["element", SN.LANDED], "left_semi")
        stats = GW.player_gw_stats(rows, keep=order)
        v = store.stage_upsert_partitions(
            "player_gw_stats", stats, SC.PLAYER_GW_STATS_KEY, SC.PLAYER_GW_STATS, "gameweek_id",
            on_duplicate=on_duplicate, order_by=order if on_duplicate == "latest" else None)
        store.commit({"player_gw_stats": v, "history_pages": v_pages}, meta={HISTORY_BATCH_KEY: batch_id},
                     base_seq=state["seq"])

    return lambda batch, batch_id: _persisted(
        batch, lambda b: _with_retry(lambda: step(b, batch_id)))


def start_history_stream(spark: SparkSession, history_landing: str, store: TableStore,
                         checkpoint_location: str, available_now: bool = True,
                         multi_line: bool = True, on_duplicate: str = "latest",
                         max_files_per_trigger: int | None = None):
    reader = spark.readStream.schema(SN.with_corrupt(SC.ELEMENT_SUMMARY)).option("multiLine", multi_line) \
        .option("columnNameOfCorruptRecord", SN.CORRUPT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(history_landing).select("*", "_metadata")
    writer = stream.writeStream.foreachBatch(history_batch(spark, store, on_duplicate)) \
        .option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime="1 minute")
    return writer.start()
