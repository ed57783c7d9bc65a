"""Monthly, point-in-time credit-risk data marts on Spark.

Layers: raw monthly snapshots (bronze), typed and cleaned tables (silver), a
label store and a feature store (gold), and profiles of all of them.  Every
public function takes DataFrames and returns a DataFrame; all snapshots are
processed in one pass.
"""
