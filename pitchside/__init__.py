"""pitchside — league and player statistics on Spark.

Sub-packages:
  sources    landed JSON snapshots and the driver's test tables
  functions  column expressions (match points, results, flags, casts)
  operators  DataFrame operators (projection, standings, players, gameweeks, merge)
  sinks      CSV / Parquet / JDBC writers and the versioned table publisher
  plans      end-to-end jobs and the registry of named queries
  streaming  landing-folder stream that feeds the keyed merge
"""

__version__ = "0.1.0"
