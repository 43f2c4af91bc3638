"""End-to-end batch jobs over landed JSON, one per result table family.

Each job reads the landed pages with declared schemas, builds its tables with
the operators, writes dated CSV snapshots if asked, stages new table versions
and publishes them with ONE commit (all-or-nothing for the run).  Every job is
re-runnable: a rerun over the same pages leaves the published tables equal.

Landed JSON is parsed once per run: the scanned rows are checkpointed (to the
shared folder named by ``spark.checkpoint.dir``) and every later step — counting,
table versions, CSV snapshots, the partitions a merge touches — reads that copy.
A page that landed twice counts once: of every fixture and every player the newest
file is used.
Large intermediate results are also cut from their lineage by being written as
a table version first (e.g. ``fixture_info``), and later steps read that version.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .. import schemas as SC
from ..session import ensure_checkpoint_dir
from ..operators import gameweeks as GW
from ..operators import players as PL
from ..operators import standings as ST
from ..operators.difference import stage_changes
from ..sinks.files import with_row_index, write_csv, write_snapshot
from ..sinks.tables import CommitConflict, TableStore
from ..sources import snapshot as SN


@dataclass
class Landing:
    """Where the polled API responses are landed (folders or glob patterns)."""
    bootstrap: str
    fixtures: str | None = None
    history: str | None = None
    multi_line: bool = True
    strict: bool = False


def _boot(spark: SparkSession, landing: Landing, *arrays: str) -> DataFrame:
    """The given arrays of the bootstrap documents, parsed once."""
    return _parsed_once(spark, SN.read_bootstrap(spark, landing.bootstrap, landing.multi_line, landing.strict).select(*arrays))


def _parsed_once(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Reliable checkpoint: a lost executor re-reads the checkpoint, not the JSON."""
    ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def fixture_job(spark: SparkSession, landing: Landing, store: TableStore,
                snapshot_date: dt.date | str | None = None, csv_base: str | None = None,
                gameweeks: tuple[int, int] | None = None) -> int:
    """``fixture_info`` (full refresh) + ``team_info`` (upsert by team), one commit."""
    teams = SN.scan_teams(SN.bootstrap_array(_boot(spark, landing, "teams"), "teams"), landing.strict)
    fixtures = SN.newest_landed(_parsed_once(spark, SN.scan_fixtures(
        SN.read_fixture_pages(spark, landing.fixtures, landing.multi_line, landing.strict, landed=True),
        gameweeks, landing.strict, keep=[SN.LANDED])), "id")
    info = ST.fixture_info(fixtures)
    table = ST.league_from_scored(info, teams)
    v_team = store.stage_upsert("team_info", table, SC.TEAM_INFO_KEY, SC.TEAM_INFO)
    if csv_base:
        write_csv(ST.result_counts(info), f"{csv_base}/results")
        write_snapshot(spark.read.parquet(store.path("team_info", v_team)).orderBy("team_id"),
                       f"{csv_base}/team_data", snapshot_date or dt.date.today())
        write_snapshot(ST.score_fixtures(ST.fixture_frame(fixtures)),
                       f"{csv_base}/gameweek_fixtures", snapshot_date or dt.date.today())
    # Partitioned by gameweek: only gameweeks whose rows differ from the stored ones are written.
    while True:
        seq = store.state()["seq"]
        try:
            return store.commit({"fixture_info": stage_changes(store, "fixture_info", info, SC.FIXTURE_INFO, "gameweek_id"),
                                 "team_info": v_team}, base_seq=seq)
        except CommitConflict:  # another run has published: compare with what it wrote
            v_team = store.stage_upsert("team_info", table, SC.TEAM_INFO_KEY, SC.TEAM_INFO)


def player_job(spark: SparkSession, landing: Landing, store: TableStore,
               snapshot_date: dt.date | str | None = None, csv_base: str | None = None) -> int:
    """``player_info`` (upsert by player)."""
    boot = _boot(spark, landing, "elements", "element_types")
    players = PL.player_info(SN.scan_elements(SN.bootstrap_array(boot, "elements"), landing.strict),
                             SN.scan_positions(SN.bootstrap_array(boot, "element_types"),
                                               landing.strict), landing.strict)
    v = store.stage_upsert("player_info", players, SC.PLAYER_INFO_KEY, SC.PLAYER_INFO)
    if csv_base:
        write_snapshot(players, f"{csv_base}/player_info", snapshot_date or dt.date.today(),
                       bom=True)
    return store.commit({"player_info": v})


def player_gw_job(spark: SparkSession, landing: Landing, store: TableStore,
                  snapshot_date: dt.date | str | None = None, csv_base: str | None = None,
                  players: tuple[int, int] | None = None, on_duplicate: str = "error") -> int:
    """``player_gw_stats`` (upsert by player, gameweek, opponent).

    Two games against one opponent in one gameweek share a key; by default that
    is an error (as a keyed insert would be).  ``on_duplicate="latest"`` keeps
    the later game (by kickoff time, then fixture id).
    """
    hist = SN.newest_landed(_parsed_once(spark, SN.scan_history(
        SN.read_history_pages(spark, landing.history, landing.multi_line, landing.strict, landed=True),
        players, landing.strict, keep=[SN.LANDED])), "element")
    keep = ["kickoff_time", "fixture"]
    stats = _parsed_once(spark, GW.player_gw_stats(hist, keep=keep, strict=landing.strict))
    # Partitioned by gameweek: a run rewrites only the gameweeks it brings.
    v = store.stage_upsert_partitions(
        "player_gw_stats", stats, SC.PLAYER_GW_STATS_KEY, SC.PLAYER_GW_STATS, "gameweek_id",
        on_duplicate=on_duplicate, order_by=keep if on_duplicate == "latest" else None)
    if csv_base:
        write_snapshot(stats.drop(*keep), f"{csv_base}/player_gw_stats",
                       snapshot_date or dt.date.today(), bom=True)
    seq = store.commit({"player_gw_stats": v})
    return store.compact_if_needed("player_gw_stats", SC.PLAYER_GW_STATS) or seq


def gameweek_job(spark: SparkSession, landing: Landing, store: TableStore,
                 csv_base: str | None = None, with_index: bool = False) -> int:
    """``gw_stats`` (upsert by gameweek id); the CSV is written after the commit."""
    events = SN.scan_gameweeks(SN.bootstrap_array(_boot(spark, landing, "events"), "events"), landing.strict)
    stats = GW.gw_stats(events, landing.strict)
    seq = store.commit({"gw_stats": store.stage_upsert("gw_stats", stats, SC.GW_STATS_KEY,
                                                       SC.GW_STATS)})
    if csv_base:
        out = with_row_index(stats, ["id"]) if with_index else stats
        write_csv(out, f"{csv_base}/events")
    return seq
